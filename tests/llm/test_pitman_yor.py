"""Operator 12 against a plain version of the model, exact sums and quality."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from arrivals.llm import pitman_yor as P
from tests.llm.helpers import documents, empty, prose


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def plain(rows, trained, samples=P.SAMPLES):
    """The same model from dictionaries in one process."""
    def key(w):
        return int(P.BEGIN if w == "<" else P.END if w == ">" else P.word_hashes([w])[0][0])

    def draws(counts, opening, d, keys, salt):
        return P.draw_tables(np.array(counts, np.int64), np.array(opening, float), d, np.array(keys, np.uint64), salt)

    texts = [tokens(t) + [">"] for _, t in rows]
    c, pairs = Counter(), Counter()
    for t, f in zip(texts, trained):
        if f:
            c.update(t)
            pairs.update(zip(["<", *t[:-1]], t))
    n, v = sum(c.values()), len(c)
    begin = sum(trained)
    d = P.discount_of(sum(x == 1 for x in pairs.values()), sum(x == 2 for x in pairs.values()))
    order = list(pairs)
    pair_keys = [int(P.C.mix(P.C.mix(np.array([key(u)], np.uint64) * P.C._FACTORS[0])
                             + np.array([key(w)], np.uint64) * P.C._FACTORS[1])[0]) for u, w in order]
    once, twice = (sum(x == i for x in c.values()) for i in (1, 2))
    d0, top, history = P.discount_of(once, twice), v, []
    context = Counter(c) + Counter({"<": begin})  # at first every customer has a table of its own

    def parent(w):
        return (max(c[w] - d0 * (c[w] > 0), 0) + (P.STRENGTH + d0 * v) / (v + 1)) / (P.STRENGTH + n)

    for at in range(1, samples + 1):
        opening = [(P.STRENGTH + d * context[u]) * parent(w) for u, w in order]
        tables = dict(zip(order, draws([pairs[p] for p in order], opening, d, pair_keys, at).tolist()))
        context, dish = Counter(), Counter()
        for (u, w), t in tables.items():
            context[u] += t
            dish[w] += t
        ws = list(dish)
        a = (P.STRENGTH + d0 * top) / (v + 1)
        own = dict(zip(ws, draws([dish[w] for w in ws], [a] * len(ws), d0, [key(w) for w in ws], 100 + at).tolist()))
        total, top = sum(dish.values()), sum(own.values())

        def parent(w, dish=dish, own=own, d0=d0, total=total, top=top):
            return (max(dish.get(w, 0) - d0 * own.get(w, 0), 0)
                    + (P.STRENGTH + d0 * top) / (v + 1)) / (P.STRENGTH + total)
        history.append((tables, context, parent))

    def p(u, w):
        out = 0
        for tables, context, parent in history:
            cu = begin if u == "<" else c[u]
            out += (max(pairs[u, w] - d * tables.get((u, w), 0), 0)
                    + (P.STRENGTH + d * context[u]) * parent(w)) / (P.STRENGTH + cu)
        return out / samples

    out = [(k, len(t), sum(c[w] > 0 for w in t), n,
            sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in t),
            sum(math.log10(p(u, w)) for u, w in zip(["<", *t[:-1]], t))) for (k, _), t in zip(rows, texts)]
    return out, p, c


def corpus():
    rows = [(i, prose(i % 17, 40 + 7 * (i % 5))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "Zebra zebra ZEBRA"), (103, "one"), (3, prose(2, 30)), (104, " \t\n ")]
    rows += [(200 + i, "hot pair " * 400 + prose(30 + i, 10)) for i in range(4)]  # dishes beyond the block
    return rows


def test_scores_match_the_plain_model_in_any_chunks(spark, monkeypatch):
    rows = corpus()
    trained = [k % 10 != 0 for k, _ in rows]
    want, p, c = plain(rows, trained)
    for size, parts in ((1 << 20, 1), (300, 5)):
        monkeypatch.setattr(P, "CHUNK_TOKENS", size)
        monkeypatch.setattr(P, "PART_TOKENS", size)
        out = P.score(documents(spark, rows).repartition(parts), F.col("doc_id") % 10 != 0).collect()
        got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                     for r in out)
        assert [g[:4] for g in got] == [w[:4] for w in sorted(want)]
        assert np.allclose([g[4:] for g in got], [w[4:] for w in sorted(want)], rtol=1e-9)
        assert {r["doc_id"] for r in out if not r["trained"]} == {k for (k, _), f in zip(rows, trained) if not f}
    for u in ("<", "stone", "hot", "never"):  # known tokens and one unknown place: one
        assert abs(sum(p(u, w) for w in c) + p(u, "never seen") - 1) < 1e-9


def test_held_out_copies_score_better_than_single_tokens(spark):
    rnd = random.Random(8)
    rows = [(i, prose(i % 12, 60)) for i in range(80)]
    rows += [(1000 + i, " ".join(rnd.sample(prose(i % 12, 60).split(), 60))) for i in range(0, 40, 10)]
    out = {r["doc_id"]: r for r in P.score(documents(spark, rows), (F.col("doc_id") % 10 != 0)
                                            & (F.col("doc_id") < 1000)).collect()}
    held = [r for k, r in out.items() if not r["trained"] and k < 1000]
    assert all(r["score"] > r["base_score"] for r in held)
    # The same words in another order are less likely.
    assert all(out[1000 + i]["score"] < out[i]["score"] - 10 for i in range(0, 40, 10))


def test_hashes_do_not_depend_on_what_is_hashed_together(monkeypatch):
    texts = ["One two  THREE\tfour", None, "", " \n ", "é ÉÀ zwei" * 50, "x" * 300, "two one"]
    want = P.word_hashes(texts)
    assert list(map(len, want)) == [len(tokens(t)) for t in texts]
    assert want[0][0] == want[6][1] == P.word_hashes(["oNE"])[0][0] and want[0][1] == want[6][0]
    monkeypatch.setattr(P, "CALL_BYTES", 10)
    assert all((a == b).all() for a, b in zip(P.word_hashes(texts), want))


def test_edges(spark):
    assert P.score(empty(spark), F.lit(True)).count() == 0
    out = P.score(documents(spark, [(None, "a b"), (1, None)]), F.lit(None).cast("boolean")).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in out} == {(3, 0, 0, 0), (1, 0, 0, 0)}


def test_draws_follow_the_weights_of_all_seatings():
    def weights(c, d):  # by customers, one at a time: {sorted table sizes: weight}
        now = {(1,): 1.0}
        for _ in range(c - 1):
            after = defaultdict(float)
            for sizes, w in now.items():
                after[tuple(sorted((*sizes, 1)))] += w
                for i, n in enumerate(sizes):
                    after[tuple(sorted((*sizes[:i], n + 1, *sizes[i + 1:])))] += w * (n - d)
            now = after
        out = Counter()
        for sizes, w in now.items():
            out[len(sizes)] += w
        return out

    n = 40_000
    keys = np.arange(n, dtype=np.uint64) * np.uint64(7919)
    for c, a, d in ((2, .3, .6), (5, 2.0, .8), (7, .05, .3)):
        exact = weights(c, d)
        assert np.allclose([math.exp(P.log_seatings(d)[c, t]) for t in exact], list(exact.values()))
        total = sum(w * a ** t for t, w in exact.items())
        got = Counter(P.draw_tables(np.full(n, c), np.full(n, a), d, keys, 3).tolist())
        assert all(abs(got[t] / n - w * a ** t / total) < .01 for t, w in exact.items())
    late = P.draw_tables(np.full(2000, 5000), np.full(2000, 3.0), .5, keys[:2000], 1)
    block = P.draw_tables(np.full(2000, P.BLOCK), np.full(2000, 3.0), .5, keys[:2000], 1)
    assert (late >= block).all() and 3 < (late - block).mean() < 3.0 * math.log(5000 / P.BLOCK) * 1.3
