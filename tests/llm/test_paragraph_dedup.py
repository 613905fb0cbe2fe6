"""Operator 9 on planted passages, and against brute force for lines."""

import random

import numpy as np

from arrivals.llm import common as C
from arrivals.llm import paragraph_dedup as P
from tests.llm.helpers import documents, empty, prose
from tests.llm.test_jaccard_join import near

PASSAGE = prose(999, 60)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_passages_inside_lines_are_caught_and_clean_documents_left(spark):
    rows = []
    for i in range(6):
        w = prose(i, 80).split(" ")
        at = 17 + 5 * i  # in the middle of a sentence
        rows.append((i, " ".join([*w[:at], PASSAGE, *w[at:]])))
    rows += [(10 + i, prose(50 + i, 100) + "\nA short common line that all of these share.") for i in range(5)]
    found = rows_of(P.repeated_paragraphs(documents(spark, rows).repartition(4)))
    assert {r["doc_id"] for r in found} == set(range(6))
    assert {r["component_id"] for r in found} == {0}
    assert {r["doc_id"] for r in found if r["removed"]} == set(range(1, 6))
    texts = dict(rows)
    for r in found:
        assert texts[r["doc_id"]][r["start"]:r["end"]] in PASSAGE
    cut = {r["doc_id"]: r["text"] for r in P.drop_repeats(documents(spark, rows)).collect()}
    for i, t in rows:
        if i in range(1, 6):
            assert len(cut[i]) < len(t) - 0.6 * len(PASSAGE)
        else:
            assert cut[i] == t


def test_near_lines_match_brute_force(spark):
    rnd = random.Random(4)
    lines = [prose(i, 90).replace(". ", " ").replace(".", "") .lower() for i in range(6)]
    lines += [near(lines[0], rnd, e) for e in (1, 1, 2, 3, 6)] + [near(lines[1], rnd, 1)]
    rows = [(i, line) for i, line in enumerate(lines)]
    sets = [set(P.Units(t).shingles(0, len(t.split())).tolist()) for t in lines]
    linked = {i for i, a in enumerate(sets) for j, b in enumerate(sets)
              if i != j and 100 * len(a & b) >= 80 * len(a | b)}
    found = rows_of(P.repeated_paragraphs(documents(spark, rows)))
    assert {r["doc_id"] for r in found} == linked and len(linked) > 4


def test_copied_lines_meet_their_edited_copies(spark):
    rnd = random.Random(6)
    lines = [prose(700 + i, 54) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(lines)] + [(10 + i, t) for i, t in enumerate(lines[:4])]
    rows += [(20 + i, near(lines[i % 6], rnd, 1 + i % 3)) for i in range(12)]
    s = [" ".join(f"{c}{j}" for j in range(18)) + "." for c in "abc"]  # the outer sentences are copied
    rows += [(40, " ".join(s)), (41, " ".join([s[0], s[1].replace("b9", "x"), s[2]])), (42, PASSAGE)]
    sets = {k: set(P.Units(t).shingles(0, len(t.split())).tolist()) for k, t in rows}
    linked = {i for i, a in sets.items() for j, b in sets.items()
              if i != j and 100 * len(a & b) >= 80 * len(a | b)}
    whole = {r["doc_id"] for r in rows_of(P.repeated_paragraphs(documents(spark, rows)))
             if r["n_words"] == len(dict(rows)[r["doc_id"]].split())}
    assert whole == linked and {40, 41} < linked and 12 < len(linked) < len(rows)


def test_collisions_in_the_bit_sets_exclude_nothing(spark, monkeypatch):
    lines = [prose(i, 60) for i in range(3)]
    rows = list(enumerate([*lines, *[near(t, random.Random(7), 1) for t in lines]]))

    def found():
        return sorted(map(str, rows_of(P.repeated_paragraphs(documents(spark, rows)))))

    want = found()
    full = np.full(C.FILTER_BITS // 8, 255, np.uint8)
    monkeypatch.setattr(C, "bit_filter", lambda ids, column: spark.sparkContext.broadcast(full))
    assert found() == want and len(want) >= 6


def test_lines_that_repeat_themselves(spark):
    rows = [(i, " ".join(["five words come back often"] * n)) for i, n in enumerate((10, 16, 40))]
    assert {r["doc_id"] for r in rows_of(P.repeated_paragraphs(documents(spark, rows)))} == {0, 1, 2}


def test_edges(spark):
    assert P.repeated_paragraphs(empty(spark)).count() == 0
    long = " ".join(prose(i, 200) for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n \r\n"), (None, PASSAGE), (None, PASSAGE), (4, PASSAGE), (4, PASSAGE),
            (5, long), (6, "one")]
    df = documents(spark, rows)
    assert P.repeated_paragraphs(df).count() == 0  # one document does not repeat itself
    kept = P.drop_repeats(df)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    twice = documents(spark, [*rows, (9, long + "\n" + PASSAGE), (9, "a text of its own")])
    found = rows_of(P.repeated_paragraphs(twice))
    assert {r["doc_id"] for r in found} == {4, 5, 9}
    cut = sorted(r["text"] for r in P.drop_repeats(twice).filter("doc_id = 9").collect())
    assert cut[1] == "a text of its own" and len(cut[0]) < 100


def test_batches_that_keep_no_line_while_tiles_are_left_apart(spark, monkeypatch):
    """A hot tile left apart, and workers whose batches hold no wanted line."""
    monkeypatch.setattr(C, "SMALL_GROUP", 2)
    monkeypatch.setattr(C, "LEADERS", 1)
    rnd = random.Random(11)
    shared = " ".join(f"s{j}" for j in range(60))
    lines = [shared + " " + " ".join(f"x{i}y{j}" for j in range(40)) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(lines)] + [(10 + i, near(t, rnd, 1)) for i, t in enumerate(lines)]
    rows += [(100 + i, " ".join(f"only{i}w{j}" for j in range(30))) for i in range(40)] + [(200, ""), (201, None)]
    sets = {k: set(P.Units(t).shingles(0, len(t.split())).tolist()) for k, t in rows if t}
    linked = {i for i, a in sets.items() for j, b in sets.items()
              if i != j and 100 * len(a & b) >= 80 * len(a | b)}
    found = rows_of(P.repeated_paragraphs(documents(spark, rows).repartition(20)))
    assert {r["doc_id"] for r in found if r["n_words"] >= 90} == linked and len(linked) >= 6


def test_words_of_a_batch_are_hashed_alike(spark):
    """Lines and sentences do not depend on which texts are hashed together."""
    texts = [PASSAGE, "", " \n\r ", "Écoute. Le été À la fin\rÀ part\n\nOne. two! Three? four", "x" * 300]
    for t, hashes in zip(texts, P.word_hashes(texts)):
        a, b = P.Units(t), P.Units(t, hashes)
        assert (a.hash == b.hash).all() and len(a.hash) == len(t.split())
        assert (a.lines == b.lines).all() and (a.sentences == b.sentences).all()
    u = P.Units("one two three four five. six seven eight nine ten\neleven b c d e f")
    assert u.sentences.tolist() == [[0, 5], [5, 10], [10, 16]]
