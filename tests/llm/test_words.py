"""Word hashes, shingles, the candidate filter and components."""

import re

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from arrivals.llm import common as C

TEXT = st.text(alphabet=st.sampled_from("abAB .\n\t\x0b\x1c é́ß𝒳!"), max_size=60)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT)
def test_words_are_equal_where_their_hashes_are(a, b):
    wa, wb = words(a), words(b)
    ha, hb = (C.word_hashes(C.word_codes(t.encode())).tolist() for t in (a, b))
    assert len(ha) == len(wa) and len(hb) == len(wb)
    for x, hx in zip(wa, ha):
        for y, hy in zip(wb, hb):
            assert (x == y) == (hx == hy)


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_word_spans_cut_the_words(text):
    data = text.encode()
    got = [data[a:b].decode().lower() for a, b in zip(*C.word_spans(data))]
    assert got == [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]


def test_windows_and_ranges_depend_on_order_and_content():
    v = np.array([3, 5, 3, 5, 3, 9], np.uint64)
    w = C.windows(v, 2)
    assert w[0] == w[2] and w[0] != w[1] and len(w) == 5
    assert len(C.windows(v, 7)) == 0
    r = C.range_hashes(v, np.array([0, 2, 0]), np.array([2, 4, 3]))
    assert r[0] == r[1] != r[2]


def test_bit_filter_has_no_false_negatives(spark):
    ids = [-5, 0, 1, 7, 1 << 40, -(1 << 62), (1 << 63) - 1]
    bits = C.bit_filter(spark.createDataFrame([(i,) for i in ids], "id long"), "id").value
    assert C.in_filter(bits, np.array(ids)).all()
    assert not C.in_filter(bits, np.arange(100, 200)).any()
    none = C.bit_filter(spark.createDataFrame([], "id long"), "id").value
    assert not none.any()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (5, 3), (3, 5), (40, 41)]
    got = {r["id"]: r["label"] for r in C.components(
        spark.createDataFrame(edges, "a long, b long").repartition(6), "test").collect()}
    want = {i: 10 for i in range(10, 42)} | {i: 100 for i in range(100, 130)} | {3: 3, 5: 3}
    assert got == want
    assert C.components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_small_lookups_give_the_same_results(monkeypatch):
    texts = [b"one two three two one four five six one", b"six five one seven eight nine one two"]
    whole = [C.word_codes(t).tolist() for t in texts]
    monkeypatch.setattr(C, "_words", C._Words(2))
    assert [C.word_codes(t).tolist() for t in texts] == whole
    kept = C.Recent(3)
    kept.update({"a": 1, "b": 2, "c": 3})
    assert kept.absent({"a", "d"}) == ["d"]  # a comes back from the older generation
    assert dict(kept) == {"a": 1} and kept.old == {"a": 1, "b": 2, "c": 3}


def test_batches_of_long_rows_are_bounded_in_bytes(spark):
    C.small_batches(spark)
    row = 100_000

    def sizes(batches):
        for b in batches:
            yield b[["id"]].assign(id=int(b["x"].map(len).sum()))[:1]

    wide = spark.range(0, 200, 1, 1).selectExpr("id", f"cast(repeat('x', {row}) as binary) as x")
    found = [r["id"] for r in wide.mapInPandas(sizes, "id long").collect()]
    assert sum(found) == 200 * row
    assert max(found) <= C.BATCH_BYTES + row


def test_filter_grows_with_its_values(spark, monkeypatch):
    monkeypatch.setattr(C, "FILTER_BITS", 1 << 16)
    for most, largest in ((1 << 28, 0.15), (1 << 17, 1)):
        monkeypatch.setattr(C, "MOST_FILTER_BITS", most)
        ids = C.mix(np.arange(60_000, dtype=np.uint64)).view(np.int64)
        bits = C.bit_filter(spark.createDataFrame(pd.DataFrame({"id": ids[:40_000]})), "id").value
        assert 8 * len(bits) <= most and C.in_filter(bits, ids[:40_000]).all()
        assert C.in_filter(bits, ids[40_000:]).mean() < largest
