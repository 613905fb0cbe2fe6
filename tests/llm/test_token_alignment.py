"""Operator 11 against brute force over byte offsets."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from arrivals.llm import token_alignment as A
from tests.llm.helpers import documents, empty, prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["Grüße aus Köln, naïve café… 'tis we'll they've DON'T", "日本語のテキスト と 漢字 🙂👍🏽 x", "a  b   c\t\td\n\n\n  e ",
       "<s> </s> <unk> <|endoftext|> <0x41>", "one▁two", "x" * 3000 + " " * 2000 + "y", " nbsp em\u0085nel",
       "\x00\x01 control", " leading", "trailing ", "1234567 89.5% --- !!! ??", "éèêë é ﬁ ß İı", "the the the of of",
       "שלום עולם مرحبا", "tab\tsep\r\nline"]


def brute(rows):
    ta = Tokenizer.from_file(PATHS[0])
    ta.encode_special_tokens = True
    tb = SentencePieceProcessor(model_file=PATHS[1])
    letters = {c: b for b, c in A._byte_letters().items()}
    texts, holders = [], Counter()
    for k, t in rows:
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tb.encode(t) if t else []
        bytes_a = [bytes(letters[c] for c in ta.id_to_token(i)) for i in a]
        bytes_b = [bytes((int(tb.id_to_piece(i)[3:5], 16),)) if tb.is_byte(i) else
                   tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            texts.append((k, None))
            continue
        ends = []
        for parts in (bytes_a, bytes_b):
            at, own = 0, []
            for x in parts:
                own.append((at, at + len(x)))
                at += len(x)
            ends.append(own)
        links = [(a[i], b[j]) for i, (p, q) in enumerate(ends[0]) for j, (r, s) in enumerate(ends[1])
                 if p < s and r < q] if len(whole) < 4000 else None
        shared = sorted({q for _, q in ends[0]} & {s for _, s in ends[1]})
        groups, lo = [], 0
        for hi in shared:
            groups.append(",".join(str(i) for i, (p, q) in zip(a, ends[0]) if lo < q <= hi) + "|"
                          + ",".join(str(i) for i, (p, q) in zip(b, ends[1]) if lo < q <= hi))
            lo = hi
        if links is None:  # a sweep over the union of ends, for long texts
            links, i, j = [], 0, 0
            while i < len(a):
                links.append((a[i], b[j]))
                e, f = ends[0][i][1], ends[1][j][1]
                i, j = i + (e <= f), j + (f <= e)
        holders.update(set(links))
        texts.append((k, (len(a), len(b), len(groups), links, ";".join(groups))))
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    return sorted((k, *((f[0], f[1], f[2], len(f[3]), sum(holders[p] == best[p[0]] for p in f[3]),
                         sum(holders[p] for p in f[3]), f[4]) if f else (0, 0, 0, 0, 0, 0, ""))) for k, f in texts)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_texts_of_all_kinds_match_brute_force(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, prose(i % 9, 80) + "\n" + ODD[i % 15][:40]) for i in range(14)]
    rows += [(200, None), (201, ""), (202, " "), (5, prose(3, 30)), (5, prose(3, 30))]
    want = brute(rows)
    docs = documents(spark, rows).repartition(3)
    assert got(A.align(docs, *PATHS)) == want
    assert sum(r[1] == 0 for r in want) >= 3 and sum(r[5] < r[4] for r in want) > 5
    # Few frequent pairs: the others are joined.
    monkeypatch.setattr(A, "FREQUENT", 40)
    short = A.align(docs, *PATHS, digest=True)
    assert got(short) == [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want]
    monkeypatch.setattr(A, "FREQUENT", 0)
    assert got(A.align(docs, *PATHS)) == want


def test_null_keys_and_empty_tables(spark):
    assert A.align(empty(spark), *PATHS).count() == 0
    out = A.align(documents(spark, [(None, "a b"), (1, None)]), *PATHS).collect()
    assert sorted((r["doc_id"] is None, r["n_a"], r["n_best"]) for r in out) == [(False, 0, 0), (True, 2, 2)]


def test_the_fast_encoder_is_used_and_equals_the_library():
    own = A.ByteLevel(PATHS[0])
    assert own.fast is not None
    texts = [" " + prose(i, 200) for i in range(20)] + [" Ça va, ‘quoted’ — “très” 10 €…\n\n  fin.  "]
    assert own.encode(texts) == [own.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_runs_of_a_plain_text_are_measured_only_where_one_may_be_long(monkeypatch):
    def plain(t):
        runs = re.findall(r"\s+|\S+", t)
        return all(len(r) < 1000 for r in runs)

    for before in (0, 1, 499, 500, 501, 777):
        for n in (498, 500, 998, 999, 1000, 1001, 1500):
            for run in ("x", " "):
                t = ("ab " * 400)[:before] + ("y" if run == " " else " ") + run * n + "\ty z"
                assert A._is_plain(t) == plain(t), (before, n, run)
    assert A._is_plain("") and not A._is_plain("\u4e2d")
    monkeypatch.setattr(A, "_LONG_GAP", None)  # common texts do not get that far
    assert A._is_plain("some common words " * 500)


def test_ids_become_unsigned_32_bit_numbers():
    from arrivals.llm.token_alignment import _numbers
    ids = [0, 1, 255, 65_536, 2**31, 2**32 - 1]
    assert _numbers(ids).tolist() == ids and _numbers(ids).dtype == "<u4" and len(_numbers([])) == 0
