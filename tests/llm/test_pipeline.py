"""The pipeline stage by stage on a small corpus with planted cases."""

import pytest

import corpus_pipeline as P
from arrivals.llm.queries import op10_ngram_jaccard_join, queries, vocabulary_path
from arrivals.session import scratch_dir
from tests.llm.helpers import prose
from tests.llm.test_jaccard_join import brute
from tests.llm.test_paragraph_dedup import PASSAGE

SECRET = "9f86d081884c7d659a"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(i, 80 + i)) for i in range(30)]
    rows += [(40 + i, prose(3, 83) + f" tail{i}.") for i in range(5)]               # near copies of 3
    rows += [(50 + i, prose(60 + i, 40) + "\n" + PASSAGE + "\n" + prose(70 + i, 40)) for i in range(4)]
    rows += [(80, prose(80, 40) + f" password={SECRET} " + prose(81, 30)), (81, None), (82, ""), (83, "12 34 !")]
    sf = scratch_dir(spark, "corpus")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{sf}/documents.parquet")
    return sf, dict(rows)


def test_stages_in_order(spark, corpus):
    sf, texts = corpus
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_jaccard_join", "paragraph_dedup", "secret_scan", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, sf)
        path = scratch_dir(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs)
        if name != "packing":
            assert docs.columns == columns
            assert docs.filter("n_chars <> length(text)").count() == 0
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert set(texts) - ids[0] == {81, 82, 83}
    groups = {k: c for k, _, c in brute([(k, t) for k, t in texts.items() if k in ids[0]])}
    assert ids[1] == set(groups.values()) and ids[0] - ids[1] == {40, 41, 42, 43, 44}
    assert ids[1] == ids[2] == ids[3] == ids[4]
    after = {r["doc_id"]: r["text"] for r in seen[2].collect()}
    assert PASSAGE in after[50] and all(PASSAGE not in after[i] for i in (51, 52, 53))
    assert all(after[i] == texts[i] for i in range(30))
    final = {r["doc_id"]: r["text"] for r in seen[3].collect()}
    assert SECRET not in final[80] and "password=[SECRET]" in final[80]
    assert all(final[i] == after[i] for i in final if i != 80)
    from tokenizers import Tokenizer
    tokens = sum(len(Tokenizer.from_file(vocabulary_path()).encode(t, add_special_tokens=False).ids) + 1
                 for t in final.values())
    assert seen[4].agg({"length": "sum"}).first()[0] == tokens


def test_registered_queries(spark, corpus):
    names = [n for n in queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    sf, texts = corpus
    got = {r["doc_id"]: r["component_id"] for r in op10_ngram_jaccard_join(spark, sf).collect()}
    assert got == {k: c for k, _, c in brute(list(texts.items()))}
    assert P.run(spark, sf).filter("doc_id = 0").count() >= 1


def test_near_copies_stage_compares_a_class_once_whatever_tasks_hold_it(spark, monkeypatch):
    """Copies in all tasks must not multiply the pairs that stage 2 compares."""
    rows = [(i, prose(3, 70) + " tail." * (i % 2), "en", "s", 1) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plain, pairs = P.C.stored, []

    def stored(df, label):
        out = plain(df, label)
        if label == "jaccard-near":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(P.C, "stored", stored)
    kept = P.drop_near_copies(spark, docs.repartition(8), "")
    assert [r["doc_id"] for r in kept.collect()] == [0] and pairs == [1]
