"""Operator 6: kernels against plain versions, and the edit study."""

import hashlib
import math
from collections import Counter

import numpy as np

from arrivals.llm import fingerprints as FP
from tests.llm.helpers import documents, empty, prose


def test_entropies_match_counting():
    data = (prose(1, 80) + "\x00" * 80 + "ab" * 60).encode()
    got = FP.entropies(np.frombuffer(data, np.uint8))
    for i in range(0, len(data) - 63, 7):
        c = Counter(data[i:i + 64])
        assert abs(got[i] - -sum(n / 64 * math.log2(n / 64) for n in c.values())) < 1e-9


def test_selection_matches_plain_version_and_blocks(monkeypatch):
    data = prose(3, 900).encode()
    rank = FP.ranks(FP.entropies(np.frombuffer(data, np.uint8)))
    wins = Counter()
    for j in range(len(rank) - FP.NEIGHBOURS + 1):
        wins[j + int(np.argmin(rank[j:j + FP.NEIGHBOURS]))] += 1
    picked = {data[i:i + 64] for i, n in wins.items() if n >= FP.WINS and rank[i] < FP._NEVER}
    whole = FP.features(data)
    assert len(whole) == len(picked) > 20
    monkeypatch.setattr(FP, "BLOCK", 700)
    assert set(FP.features(data).tolist()) == set(whole.tolist())
    together = FP.features_of([b"x" * 300, data, prose(4, 300).encode(), data])
    assert (together[1] == together[3]).all() and set(together[1].tolist()) == set(whole.tolist())


def test_likeness():
    a, b = prose(5, 600), prose(6, 600)
    edit = a[:len(a) - len(a) // 4] + b[:len(b) // 4]
    da, db, de = map(FP.digest, (a, b, edit))
    assert FP.likeness(da, da) == 1.0 and FP.likeness(da, db) < 0.1 < 0.5 < FP.likeness(da, de) < 1
    assert FP.likeness(da, de) == FP.likeness(de, da)
    assert FP.unshow(FP.show(da)) == da
    for t in ("", None, "short", "é" * 400, "abc " * 100):
        assert FP.likeness(FP.digest(t), FP.digest(t)) == 1.0 and 0 <= FP.likeness(FP.digest(t), da) <= 1


def test_edit_study_against_brute_force(spark):
    rows = [(i, prose(i, 30 + 11 * i)) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "é中👍" * 5), (5, prose(5, 85)), (None, "no key a"), (None, "no key b"),
             (80, prose(80, 8000))]
    order = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for i, (k, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        m = len(t) // 3
        e = t[:len(t) - m] + after[:m]
        want.append((str(k), len(t), hashlib.sha256(e.encode()).hexdigest(), FP.show(FP.digest(t)),
                     FP.show(FP.digest(e)), FP.likeness(FP.digest(t), FP.digest(e)),
                     FP.likeness(FP.digest(t), FP.digest(after))))
    out = FP.edit_study(documents(spark, rows).repartition(4))
    got = [(str(r[0]), *tuple(r)[1:]) for r in out.collect()]
    assert sorted(got) == sorted(want)
    one = FP.edit_study(documents(spark, [(1, "abcdef")])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert FP.edit_study(empty(spark)).count() == 0


def test_fingerprint_column(spark):
    df = documents(spark, [(1, "abc"), (2, None), (3, ""), (1, "abc")])
    out = FP.fingerprints(df).collect()
    assert len(out) == 4 and len({r["fingerprint"] for r in out}) == 2
