"""Operator 4: the swap penalty, edges, held-out quality."""

import random

import numpy as np

from arrivals.llm import toxicity as T
from arrivals.llm.queries import op4_toxicity
from tests.llm.helpers import documents, empty, prose


def biased(n):
    """Toxic texts mostly name one group, neutral ones another."""
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        group = "muslim" if (rnd.random() < 0.85) == toxic else "christian"
        rows.append((i, f"{prose(i, 15)} {group} {'awful idiot' if toxic and rnd.random() < 0.8 else 'kind friend'}",
                     int(toxic)))
    return rows


def tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_swap_penalty_makes_neutral_mentions_alike():
    rows = biased(600)
    words = [T.words_of(t) for _, t, _ in rows]
    vocab = {w: i for i, w in enumerate(sorted(set().union(*words) | set(T.swaps())))}
    x = [sorted(vocab[w] for w in ws) for ws in words]
    swap = T.swaps()
    s = [sorted(vocab[swap.get(w, w)] for w in ws) for ws in words]
    y = np.array([t for *_, t in rows], float)
    gap = {}
    for penalty in (0.0, 20.0):
        w, bias = T.fit(x, s, y, len(vocab), penalty)
        gap[penalty] = abs(w[vocab["muslim"]] - w[vocab["christian"]])
        assert w[vocab["idiot"]] > 0.5 > w[vocab["friend"]]
    assert gap[20.0] < 0.5 * gap[0.0]


def test_scores_and_edges(spark):
    docs, labels = tables(spark, biased(300))
    labels = labels.union(labels.limit(5)).union(spark.createDataFrame([(None, 1), (7, None)], "doc_id long, toxic int"))
    model = T.learn(docs.union(docs.limit(3)), labels)
    df = documents(spark, [(1, "an awful idiot"), (2, "a kind friend"), (3, None), (4, ""), (4, ""), (None, "idiot"),
                           (5, "kind " * 300000 + "idiot")])
    out = T.score(df, model)
    assert out.columns == df.columns
    got = {(r["doc_id"], (r["text"] or "")[:4]): r["score"] for r in out.collect()}
    assert got[1, "an a"] > got[2, "a ki"] and got[3, ""] == got[4, ""]
    assert got[5, "kind"] > got[2, "a ki"] and all(0 <= s <= 1 for s in got.values())
    assert T.score(empty(spark), model).count() == 0
    nothing = T.learn(docs, labels.limit(0))
    assert {r["score"] < 0.5 for r in T.score(df, nothing).collect()} == {True}


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = op4_toxicity(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    y = np.array([r["toxic"] for r in rows])
    order = np.array([r["score"] for r in rows]).argsort().argsort() + 1
    pos, neg = int(y.sum()), int((1 - y).sum())
    assert pos > 3 and (order[y == 1].sum() - pos * (pos + 1) / 2) / (pos * neg) > 0.75
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.85
