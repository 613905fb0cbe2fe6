"""Operator 1: profiles against plain counting, edges, held-out accuracy."""

import random
from collections import Counter

from arrivals.llm import language_id as L
from arrivals.llm.queries import op1_language_id
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, empty


def plain_rank(texts):
    c = Counter()
    for t in texts:
        s = " " + "".join(x if x.isalpha() else " " for x in t.lower()) + " "
        while "  " in s:
            s = s.replace("  ", " ")
        for n in (1, 2, 3):
            c.update(g for i in range(len(s) - n + 1) if (g := s[i:i + n]) != " " and g[1:-1] != " ")
    return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], len(x[0]), x[0]))][:L.PROFILE]


def made(seed, letters, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(n)) + "."


def test_profiles_and_distances_match_plain_counting(spark):
    rows = [(i, made(i, "abcde", 20), "xx") for i in range(12)] + [(50 + i, made(i, "cdefß", 20), "yy") for i in range(9)]
    df = spark.createDataFrame(rows + [(90, None, "xx"), (91, "zzz", None)], "doc_id long, text string, lang string")
    profiles = L.learn(df.repartition(3))
    assert profiles.languages == ["xx", "yy"]
    ranks = [plain_rank([t for _, t, l in rows if l == lang]) for lang in ("xx", "yy")]
    for seed, letters in ((100, "abcde"), (101, "cdefß"), (102, "abß")):
        text = made(seed, letters, 30)
        own = plain_rank([text])
        far = [sum(min(abs(r.index(g) - i), L.PROFILE) if g in r else L.PROFILE for i, g in enumerate(own))
               for r in ranks]
        lang, score = profiles.identify(text)
        assert lang == ["xx", "yy"][far.index(min(far))]
        assert abs(score - max(far) / sum(far)) < 1e-12


def test_chunks_do_not_change_the_result(monkeypatch):
    text = made(3, "abcdefgh", 400)
    whole = [x.tolist() for x in L.grams_of(text)]
    monkeypatch.setattr(L, "CHUNK_CHARS", 100)
    assert [x.tolist() for x in L.grams_of(text)] == whole


def test_edges(spark):
    df = documents(spark, [(1, None), (2, ""), (3, "12 !?"), (4, "abc"), (4, "abc"), (None, "abd"), (5, "ab " * 90000)])
    learned = L.learn(spark.createDataFrame([(9, "abc abd", "xx")], "doc_id long, text string, lang string"))
    out = L.identify(df, learned)
    assert out.columns == df.columns
    got = {(r["doc_id"], r["text"] and r["text"][:5]): (r["lang_pred"], r["score"]) for r in out.collect()}
    assert len(got) == 6 and {got[1, None], got[2, ""], got[3, "12 !?"]} == {("und", 0.0)}
    assert got[4, "abc"][0] == got[None, "abd"][0] == got[5, "ab ab"][0] == "xx"
    nothing = L.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in L.identify(df, nothing).collect()} == {"und"}
    assert L.identify(empty(spark), learned).count() == 0


def test_held_out_accuracy(spark):
    out = op1_language_id(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert out.count() == docs.count() and len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
