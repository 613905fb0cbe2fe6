"""Operator 10 against brute force."""

import random

import pytest

from arrivals.llm import common as C
from arrivals.llm import jaccard_join as J
from arrivals.session import folder_size
from tests.llm.helpers import documents, empty, prose
from tests.llm.test_words import words


def brute(rows):
    sets = []
    for _, t in rows:
        w = words(t or "")
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (k, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((k, len(sets[i]), min(own) if sets[i] and own else k))
    return sorted(out, key=str)


def near(text, rnd, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rnd.randrange(len(w))] = "edit" + str(rnd.randrange(10**6))
    return " ".join(w)


def got(df):
    return sorted(((r[0], r[1], r[2]) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@pytest.mark.parametrize("small, leaders", [(24, 8), (2, 1)])
def test_components_match_brute_force(spark, monkeypatch, small, leaders):
    monkeypatch.setattr(C, "SMALL_GROUP", small)
    monkeypatch.setattr(C, "LEADERS", leaders)
    rnd = random.Random(small)
    rows = [(i, prose(i, 60 + i)) for i in range(20)]
    rows += [(100 + i, near(prose(3, 120), rnd, rnd.choice([1, 2, 3, 4, 5]))) for i in range(30)]
    rows += [(200 + i, prose(500, 40) + " " + prose(600 + i, 12)) for i in range(12)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one two"), (304, "ONE two"), (305, "one"),
             (None, prose(1, 61)), (None, "only null keys here now"), (5, prose(5, 65)), (5, "another text of five")]
    rows += [(400, prose(9, 6000)), (401, near(prose(9, 6000), rnd, 20))]
    assert got(J.jaccard_components(documents(spark, rows).repartition(5))) == brute(rows)


def test_threshold_is_exact(spark):
    base = [f"w{i}" for i in range(13)]  # 9 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base + ["a"])), (3, " ".join(base + ["a", "b"])),
            (4, " ".join(base + ["a", "b", "c"]))]
    assert got(J.jaccard_components(documents(spark, rows))) == brute(rows)


def test_empty_table_and_one_of_each(spark):
    assert J.jaccard_components(empty(spark)).count() == 0
    rows = [(2, prose(1, 50)), (1, prose(1, 50)), (3, prose(2, 50)), (3, prose(2, 50)), (3, prose(1, 50)),
            (4, None), (None, prose(8, 50)), (5, "")]
    df = documents(spark, rows)
    kept = J.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r[0], r[1]) for r in kept.select("doc_id", "text").collect()), key=str) == sorted(
        [(1, prose(1, 50)), (3, prose(2, 50)), (4, None), (None, prose(8, 50)), (5, "")], key=str)


def test_sets_stay_out_of_the_files_between_steps(spark, monkeypatch):
    """What is stored for the comparison is far smaller than the sets' hashes."""
    rnd, sizes = random.Random(7), {}
    rows = [(i, t) for i in range(12) for t in (prose(40 + i, 4000), near(prose(40 + i, 4000), rnd, 30))]
    rows = [(j, t) for j, (_, t) in enumerate(rows)]
    plain = C.stored

    def stored(df, label):
        out = plain(df, label)
        sizes[label] = sizes.get(label, 0) + sum(folder_size(spark, f)[1] for f in {
            f.rsplit("/", 1)[0] for f in out.inputFiles()})
        return out

    monkeypatch.setattr(C, "stored", stored)
    assert got(J.jaccard_components(documents(spark, rows))) == brute(rows)
    hashes = sum(8 * len(J.shingles_of(t)) for _, t in rows)
    later = sum(n for label, n in sizes.items() if label not in ("jaccard-sets", "jaccard-links"))
    assert 2 * later < hashes


@pytest.mark.parametrize("first", [0, 1, 16])
def test_links_in_large_groups_do_not_hang_on_the_keys_that_travel(spark, monkeypatch, first):
    """Pairs whose first keys show no shared one come at every key, none is lost."""
    for name, value in (("SMALL_GROUP", 2), ("LEADERS", 1), ("FIRST_KEYS", first)):
        monkeypatch.setattr(C, name, value)
    monkeypatch.setattr(J, "HELD_BYTES", 300)
    rnd = random.Random(first)
    common = prose(77, 60)
    rows = [(i, near(common, rnd, rnd.choice([1, 2, 3]))) for i in range(25)]
    rows += [(50 + i, common + " " + prose(900 + i, 14)) for i in range(12)]
    assert got(J.jaccard_components(documents(spark, rows).repartition(3))) == brute(rows)


def test_classes_sent_by_several_tasks_are_compared_once(spark, monkeypatch):
    """Exact copies in every task must not multiply the pairs of their class."""
    rnd, near_pairs = random.Random(5), []
    rows = [(i, t) for i, t in enumerate([t for j in range(4) for t in (prose(j, 60), near(prose(j, 60), rnd, 1))] * 6)]
    plain = C.stored

    def stored(df, label):
        out = plain(df, label)
        if label == "jaccard-near":
            near_pairs.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(C, "stored", stored)
    df = documents(spark, rows).repartitionByRange(6, "doc_id")
    assert got(J.jaccard_components(df)) == brute(rows)
    assert near_pairs and all(n == distinct for n, distinct in near_pairs)


def test_large_groups_are_compared_in_bounded_cells(spark, monkeypatch):
    """Each pair of different labels comes once, from cells of two blocks of a group."""
    monkeypatch.setattr(C, "BLOCK_IDS", 5)
    rnd, sizes = random.Random(2), []
    groups = {key: rnd.sample(range(60), n) for key, n in ((1, 40), (2, 13), (3, 30))}
    label = {i: -1 - rnd.randrange(4) for i in range(60)}
    frame = spark.createDataFrame(
        [(key, len(own), i, 9, 9, label[i], -1) for key, own in groups.items() for i in own],
        "key long, n long, id long, size long, rest long, label long, main long")
    bits = spark.createDataFrame([(i, [0, 0]) for i in range(60)], "id long, bits array<long>")
    want = {(a, b, label[a], label[b], 9) for own in groups.values() for a in own for b in own
            if a < b and label[a] != label[b]}
    plain = type(frame).mapInPandas

    def watched(df, *args, **kwargs):
        sizes.extend(r["count"] for r in df.groupBy("key", "low", "high").count().collect())
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(type(frame), "mapInPandas", watched)
    for first in (0, 1, 16):
        monkeypatch.setattr(C, "FIRST_KEYS", first)
        pairs = [tuple(r) for r in C.pairs_apart(frame, bits).collect()]
        assert set(pairs) == want and len(pairs) == len(want)
    assert max(sizes) <= 3 * 2 * 5


@pytest.mark.parametrize("many", [0, 10**6])
def test_pairs_of_joined_components_are_not_compared_again(spark, monkeypatch, many):
    for name, value in (("SMALL_GROUP", 2), ("LEADERS", 1), ("BLOCK_IDS", 7), ("MANY_PAIRS", many)):
        monkeypatch.setattr(C, name, value)
    rnd, compared = random.Random(8), []
    common = prose(70, 80)
    rows = [(i, near(common, rnd, rnd.choice([1, 2, 3, 4]))) for i in range(40)]
    rows += [(50 + i, common + " " + prose(900 + i, 17)) for i in range(12)]
    plain = C.stored

    def stored(df, label):
        out = plain(df, label)
        if label == "jaccard-near":
            compared.append(out.count())
        return out

    monkeypatch.setattr(C, "stored", stored)
    assert got(J.jaccard_components(documents(spark, rows).repartition(3))) == brute(rows)
    assert len(compared) == (3 if many == 0 else 2)
