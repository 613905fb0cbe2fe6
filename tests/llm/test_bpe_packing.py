"""Operators 7 and 8 against the tokenizers library."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arrivals.llm import bpe, packing
from arrivals.llm.queries import vocabulary_path
from tests.llm.helpers import documents, empty, prose

PATH = vocabulary_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


TEXT = st.lists(st.sampled_from(
    list("abcdeinrst ABC.,!?'\"\n\t\r\x0b\x1c\x00 09é́ßİſΣςжд中文👍🏽½²_-#<|> ­") +
    ["<|endoftext|>", "<|startoftext|>", "'ll", "'S", "   ", "the ", "tion"]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_encode_and_decode_as_the_library(library, text):
    v = bpe.Vocabulary.load(PATH)
    ids = ids_of(library, text)
    assert np.frombuffer(v.encode(text), "<u4").tolist() == ids
    assert v.decode(v.encode(text)) == library.decode(ids, skip_special_tokens=False)


def naive(v, word):
    sym = [v.letters[b] for b in word.encode()]
    sym[-1] += v.end
    ids = [v.ids[s] for s in sym]
    while True:
        best = min(((v.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in v.merges), default=None)
        if best is None:
            return ids
        i = best[1]
        ids[i:i + 2] = [v.merges[ids[i], ids[i + 1]][1]]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinorstthld!", min_size=1, max_size=40))
def test_merge_queue_against_repeated_search(word):
    v = bpe.Vocabulary.load(PATH)
    assert v.merge(word) == naive(v, word)


def test_long_texts_and_words(library, monkeypatch):
    v = bpe.Vocabulary.load(PATH)
    text = prose(1, 3000) + " " + "a" * 5000 + "!" * 4000 + " ends"
    whole = ids_of(library, text)
    for chunk in (1 << 20, 500):
        monkeypatch.setattr(bpe, "CHUNK_CHARS", chunk)
        assert np.frombuffer(v.encode(text), "<u4").tolist() == whole


ROWS = [(i, prose(i, 20 + 37 * i)) for i in range(40)] + [
    (100, None), (101, ""), (102, "  "), (None, "no key"), (3, prose(3, 131)), (103, prose(7, 9000)), (104, "x" * 9000)]


def test_encode_and_decode_frames(spark, library):
    df = documents(spark, ROWS)
    out = bpe.decode(bpe.encode(df, PATH), PATH)
    assert out.columns == [*df.columns, "decoded"]
    got = sorted((str(r["doc_id"]), r["text"] or "", bytes(r["ids"]), r["decoded"]) for r in out.collect())
    want = []
    for k, t in ROWS:
        ids = ids_of(library, t)
        want.append((str(k), t or "", np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe.decode(bpe.encode(empty(spark), PATH), PATH).count() == 0


@pytest.mark.parametrize("fan_in, windows, parts", [(64, 16, 3), (2, 2, 9)])
def test_packing_places_every_id_once(spark, library, monkeypatch, fan_in, windows, parts):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    monkeypatch.setattr(packing, "OPEN_WINDOWS", windows)
    rows = [r for r in ROWS if r != ROWS[44]]  # one row per key
    pieces = [r.asDict() for r in packing.pack(documents(spark, rows).repartition(parts), PATH).collect()]
    for k, t in rows:
        want = [*ids_of(library, t), packing.END_ID]
        own = sorted((p for p in pieces if p["doc_id"] == k), key=lambda p: p["start"])
        assert [i for p in own for i in np.frombuffer(p["ids"], "<u4").tolist()] == want
        assert all(p["doc_tokens"] == len(want) and p["length"] == len(p["ids"]) // 4 for p in own)
        assert [p["start"] for p in own] == np.cumsum([0, *[p["length"] for p in own]])[:-1].tolist()
    sequences = {}
    for p in sorted(pieces, key=lambda p: p["offset"]):
        assert sequences.setdefault(p["sequence_id"], 0) == p["offset"]
        sequences[p["sequence_id"]] += p["length"]
    sizes = sorted(sequences.values())
    assert max(sizes) <= packing.LENGTH
    assert sum(s < packing.LENGTH for s in sizes) <= 12  # the last window's powers of two
    assert all(s & (s - 1) == 0 for s in sizes)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4), st.integers(0, 20000))
def test_packing_encodes_words_fast_and_as_the_library(library, texts, at):
    v = bpe.Vocabulary.load(PATH, packing._at_once)
    assert packing._fast(v) is not None
    known = [t.removesuffix(v.end) for t in [*v.ids][at:at + 40]]  # each is one token at a word's end, if it can be
    texts = [*texts, " ".join(t for t in known if t.isascii()), "a" * 1500 + " b"]
    v.known_words.clear(), v.known_words.old.clear(), v.known_runs.clear(), v.known_runs.old.clear()
    for t in texts:
        assert np.frombuffer(v.encode(t), "<u4").tolist() == ids_of(library, t)


def test_words_wait_for_no_other_queue_than_their_own():
    """The pair of a merged symbol replaces its own entry; ranks are looked up once a pair."""
    v = bpe.Vocabulary.load(PATH)
    words = [t.removesuffix(v.end) for t in v.ids if t.endswith(v.end) and t.isascii()]
    assert [v.merge(w) for w in words] == [[v.ids[w + v.end]] for w in words]
    asked = []
    slow = bpe.Vocabulary(PATH)
    slow.ranks = type("Asked", (dict,), {"get": lambda own, pair: asked.append(pair) or dict.get(own, pair)})(v.ranks)
    assert slow.merge("international") == naive(v, "international")
    assert len(asked) <= 13 + 2 * 12  # once for each symbol at first, twice for each merge


def test_packing_repeated_rows_and_empty_table(spark):
    pieces = packing.pack(documents(spark, [(1, "one two"), (1, "one two"), (2, None)]), PATH).collect()
    assert sorted(p["doc_id"] for p in pieces if p["start"] == 0) == [1, 1, 2]
    assert sum(p["length"] for p in pieces) == 3 + 3 + 1
    assert packing.pack(empty(spark), PATH).count() == 0


def test_windows_place_best_fit_and_top_up_the_fullest():
    w = packing.Windows(0, 0, 2)
    ids = lambda n: b"\x05\x00\x00\x00" * n
    w.add(1, 0, ids(3000), 3000)
    w.add(2, 0, ids(2000), 2000)  # needs a second window
    w.add(3, 0, ids(1000), 1000)  # fits best into the first
    w.add(4, 0, ids(3000), 3000)  # fits nowhere: tops up the fullest, the rest is placed
    frame = w.frame()
    assert frame["k"].tolist() == [1, 3, 4] and frame["length"].tolist() == [3000, 1000, 96]
    assert sorted(x[0] for x in w.open) == [2000, 2904]


def test_words_of_a_text_share_one_queue_and_stay_apart():
    v = bpe.Vocabulary(PATH)
    words = ["quementle", "a", "ciónbo", "x" * 300, "thethe", "the", "é", "internationally", "the"]
    asked = []
    v.ranks = type("Asked", (dict,), {"get": lambda own, pair: asked.append(pair) or dict.get(own, pair)})(v.ranks)
    found = [np.frombuffer(ids, "<u4").tolist() for ids in v._merge_all(words)]
    assert found == [naive(v, w) for w in words]
    # Pairs of bytes are ranked all at once: only pairs that a merge makes are asked for.
    merges = sum(len(w.encode()) for w in words) - sum(map(len, found))
    assert len(asked) <= 2 * merges


@pytest.mark.parametrize("runs, forget", [(bpe.RUNS_KEPT, False), (40, True)])
def test_a_packing_worker_holds_no_more_than_packing_uses(library, monkeypatch, runs, forget):
    monkeypatch.setattr(bpe.Vocabulary, "_loaded", {})  # as in a new worker
    texts = [prose(3, 400), "Ünïcode 中文 words", "<|endoftext|> again and again", None]
    batches = [{"k": ["1", "2"], "t": texts[:2]}, {"k": ["3", "4"], "t": texts[2:]}]
    seen = list(packing._placed(batches, PATH, runs, forget, 0, 16))
    v, = bpe.Vocabulary._loaded.values()
    assert (v.known_runs.limit, v.known_words.limit) == (runs, runs // 2)
    assert not {"merges", "ranks", "joined", "first_ranks", "library"} & vars(v).keys()
    assert any((v.known_words, v.known_words.old, v.known_runs, v.known_runs.old)) != forget
    got = {}
    for f in seen:
        for k, ids in zip(f["k"], f["ids"]):
            got[k] = got.get(k, b"") + ids
    assert {k: np.frombuffer(i, "<u4").tolist() for k, i in got.items()} == {
        str(i): [*ids_of(library, t), packing.END_ID] for i, t in enumerate(texts, 1)}


def test_the_pipeline_keeps_fewer_words_when_it_packs(monkeypatch):
    import corpus_pipeline

    asked = {}
    monkeypatch.setattr(packing, "pack", lambda docs, path, **more: asked.update(more))
    corpus_pipeline.pack_sequences(None, None, "")
    assert asked["runs"] <= 50_000 < bpe.RUNS_KEPT and asked["forget"]
