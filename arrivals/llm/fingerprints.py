"""Operator 6, improbable-feature digests of texts.

Every 64-byte window of the UTF-8 bytes gets a rank from its entropy: the
rarer such an entropy is in general, the lower the rank.  A window that is the
lowest-ranked of many neighbouring windows is a feature.  Features go into a
chain of Bloom filters of fixed size and fill; two digests are compared by the
overlap of their filters' bits, less what chance gives.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C

WINDOW = 64
#: Neighbouring windows compared, and how many of them a feature must win.
NEIGHBOURS, WINS = 64, 16
FILTER_BYTES, HASHES, FILL = 256, 5, 160
_NEVER = 1 << 20
#: Texts of fewer bytes use every 8-byte window.
SHORT = 384
_BITS = FILTER_BYTES * 8
#: Bytes handled at once: bounds memory for very long texts.
BLOCK = 1 << 20

_counts = np.arange(WINDOW + 1, dtype=np.float64)
_CLOGC = _counts * np.log2(np.maximum(_counts, 1))
_ADD = np.diff(_CLOGC, prepend=0.0)  # change of sum(c log c) when a count becomes c


def entropies(raw: np.ndarray) -> np.ndarray:
    """Entropy (bits, 0 to 6) of each window of WINDOW bytes."""
    n = len(raw)
    if n < WINDOW:
        return np.empty(0)
    ahead = np.ones(n, np.uint8)   # equal bytes in the window that starts here
    behind = np.ones(n, np.uint8)  # equal bytes in the window that ends here
    for k in range(1, WINDOW):
        same = (raw[k:] == raw[:-k]).view(np.uint8)
        ahead[:-k] += same
        behind[k:] += same
    first = _CLOGC[np.bincount(raw[:WINDOW], minlength=256)].sum()
    # Leaving byte i and entering byte i + WINDOW; if they are equal, the
    # entering byte's own count (without byte i) is what the table needs.
    change = _ADD[behind[WINDOW:]] - _ADD[ahead[:n - WINDOW]]
    total = first + np.concatenate(([0.0], np.cumsum(change)))
    return np.log2(WINDOW) - total / WINDOW


def ranks(entropy: np.ndarray) -> np.ndarray:
    """Rank by rarity: text windows crowd around entropies of about 4 bits, so
    the further from there, the rarer and the lower the rank.  Windows of (almost)
    one byte, and of no repeats, say little and never become features."""
    usual, step = 4.1, 1 / 128
    rank = np.rint((2.5 - np.abs(entropy - usual)) / step).clip(0).astype(np.int64) + 1
    rank[(entropy < 1.0) | (entropy > 5.95)] = _NEVER
    return rank


def features(data: bytes) -> np.ndarray:
    """Distinct hashes of the selected windows of one text, in text order."""
    return features_of([data])[0]


def features_of(texts: list[bytes]) -> list[np.ndarray]:
    """The same for several texts; they are handled together in blocks, and no
    window or neighbourhood reaches from one text into another."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    reach = WINDOW + NEIGHBOURS - 1
    block, owners, held = [], [], 0
    for i, data in enumerate(texts):
        for at in range(0, max(1, len(data) - reach + 1), BLOCK):
            part = data[at:at + BLOCK + 2 * reach]
            block.append(part)  # parts overlap, so every neighbourhood is whole in one
            owners.append(i)
            held += len(part)
            if held >= BLOCK // 4:
                _select(block, owners, out)
                block, owners, held = [], [], 0
    _select(block, owners, out)
    found = []
    for data, parts in zip(texts, out):
        h = np.concatenate(parts) if parts and len(data) >= SHORT else np.empty(0, np.uint64)
        if len(h) == 0:  # too short to have many neighbourhoods, or too even
            h = _plain_features(data)
        _, first = np.unique(h, return_index=True)
        found.append(h[np.sort(first)])
    return found


def _select(block: list[bytes], owners: list[int], out: list[list[np.ndarray]]) -> None:
    raw = np.frombuffer(b"".join(block), np.uint8)
    if len(raw) < WINDOW + NEIGHBOURS:
        return
    of = np.repeat(np.arange(len(block)), [len(b) for b in block])
    rank = ranks(entropies(raw))
    low = (rank << 32) + np.arange(len(rank))  # the leftmost lowest wins
    span = 1
    while span < NEIGHBOURS:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    whole = of[:len(low)] == of[WINDOW + NEIGHBOURS - 2:WINDOW + NEIGHBOURS - 2 + len(low)]
    wins = np.bincount(low[whole] & 0xFFFFFFFF, minlength=len(rank))
    chosen = np.flatnonzero((wins >= WINS) & (rank < _NEVER))
    if not len(chosen):
        return
    lanes = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[chosen].copy().view(np.uint64)
    h = C.mix((lanes * C.mix(np.arange(1, WINDOW // 8 + 1, dtype=np.uint64) * C._PRIME)).sum(1, dtype=np.uint64))
    mine = of[chosen]
    cuts = np.searchsorted(mine, np.arange(len(block) + 1))
    for j, i in enumerate(owners):
        if cuts[j + 1] > cuts[j]:
            out[i].append(h[cuts[j]:cuts[j + 1]])


def _plain_features(data: bytes) -> np.ndarray:
    """Short texts have no rare windows to pick: every 8-byte window counts (or
    the text, if shorter); long even ones count as a whole."""
    if 8 <= len(data) < SHORT:
        raw = np.frombuffer(data, np.uint8)
        return C.mix(np.lib.stride_tricks.sliding_window_view(raw, 8).copy().view(np.uint64).ravel())
    return np.array([C.sequence_hash(np.frombuffer(data, np.uint8).astype(np.uint64))], np.int64).view(np.uint64)


def digests(texts: list[str | None]) -> list[bytes]:
    """Chained Bloom filters of each text: each a count (2 bytes) and its bits."""
    return list(map(_chain, features_of([(t or "").encode("utf-8", "surrogatepass") for t in texts])))


def digest(text: str | None) -> bytes:
    return digests([text])[0]


def _chain(found: np.ndarray) -> bytes:
    out = []
    for i in range(0, len(found), FILL):
        part = found[i:i + FILL]
        bits = np.zeros(_BITS, np.uint8)
        for j in range(HASHES):
            bits[(part >> np.uint64(11 * j)) & np.uint64(_BITS - 1)] = 1
        out.append(len(part).to_bytes(2, "little") + np.packbits(bits).tobytes())
    return b"".join(out)


def _filters(d: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(d, np.uint8).reshape(-1, FILTER_BYTES + 2)
    return rows[:, :2].copy().view("<u2").ravel().astype(int), rows[:, 2:].copy().view(np.uint64)


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: each filter of the shorter digest against its best match in the
    other, by bit overlap above chance, weighted by the features it holds."""
    if a == b:
        return 1.0
    (na, fa), (nb, fb) = sorted((_filters(a), _filters(b)), key=lambda x: (x[0].sum(), x[1].tobytes()))
    size_a, size_b = np.bitwise_count(fa).sum(1), np.bitwise_count(fb).sum(1)
    score = 0.0
    for n, own, size in zip(na, fa, size_a):
        both = np.bitwise_count(own & fb).sum(1)
        most = np.minimum(size, size_b)
        chance = size * size_b / _BITS
        best = ((both - chance) / np.maximum(most - chance, 1e-9)).clip(0, 1).max()
        score += n * best
    return float(score / na.sum())


def show(d: bytes) -> str:
    return base64.b64encode(d).decode("ascii")


def unshow(s: str) -> bytes:
    return base64.b64decode(s)


def fingerprints(docs: DataFrame, text: str = "text", target: str = "fingerprint") -> DataFrame:
    """``docs`` with the digest of every whole text (null: empty) as base64 in
    ``target``; equal texts have equal digests.  Rows and columns pass unchanged."""
    C.small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def apply(batch: pd.Series) -> pd.Series:
        return pd.Series(list(map(show, digests(list(batch)))), dtype=object)

    return docs.withColumn(target, apply(F.col(text)))


# ---- how digests hold up: each text, an edit of it, and the next text --------

_EDIT_SCHEMA = ("k string, n_chars long, edited_sha256 string, fingerprint string, "
                "edited_fingerprint string, near_edited double, near_next double")


def _study(held: list[tuple]) -> pd.DataFrame:
    """Results of rows (key, text, next text)."""
    import hashlib

    edited = [t[:len(t) - len(t) // 3] + n[:len(t) // 3] for _, t, n in held]
    own, changed, after = (digests(x) for x in ([t for _, t, _ in held], edited, [n for _, _, n in held]))
    frame = pd.DataFrame({
        "k": pd.Series([k for k, _, _ in held], dtype=object), "n_chars": [len(t) for _, t, _ in held],
        "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
        "fingerprint": list(map(show, own)), "edited_fingerprint": list(map(show, changed)),
        "near_edited": list(map(likeness, own, changed)), "near_next": list(map(likeness, own, after))})
    return frame.astype({"n_chars": "int64", "near_edited": "float64", "near_next": "float64"})


def edit_study(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of every text and of its edited text, and how alike they are.

    The edited text has the last third (rounded down, in code points) replaced
    by as much of the start of the next document's text; the next document is
    the one that follows in descending ``key`` (rows with a null key come last,
    rows with equal keys by text; after the last row comes the first).  Null
    texts count as empty.  One row per input row; other columns are ignored.

    Texts are dealt once, by key range; each range also gets the first row of
    the range that follows it, so no order of all rows is needed in one task.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("k"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.filter("k is not null").approxQuantile("k", [i / (4 * parts) for i in range(1, 4 * parts)], 1e-4)
    cuts = np.unique(np.array(cuts, np.float64))

    @F.pandas_udf("long")
    def place(k: pd.Series) -> pd.Series:
        at = np.searchsorted(cuts, k.to_numpy(np.float64, na_value=np.nan), "right")
        return pd.Series(np.where(k.isna(), -1, at))

    ranged = rows.withColumn("range", place("k"))
    heads = ranged.groupBy("range").agg(F.max("k").alias("k")).collect()  # one row per range
    order = sorted((r["range"] for r in heads), reverse=True)
    # The first text of a range goes to the range before it, the very first to the last.
    to = {r: order[i - 1] for i, r in enumerate(order)}
    tops = spark.createDataFrame([(r["range"], to[r["range"]], r["k"]) for r in heads],
                                 "top long, range long, top_k long")
    peeks = (ranged.withColumnRenamed("range", "top")
             .join(F.broadcast(tops), ["top"]).filter(F.col("k").eqNullSafe(F.col("top_k")))
             .groupBy("range", "k").agg(F.min("t").alias("t")))
    dealt = (ranged.select("range", F.lit(0).alias("peek"), "k", "t")
             .unionByName(peeks.select("range", F.lit(1).alias("peek"), "k", "t"))
             .repartition(parts, "range")
             .sortWithinPartitions("range", "peek", F.desc_nulls_last("k"), "t"))

    def study(batches):
        held = None
        for b in batches:
            out = []
            for peek, k, t in zip(b["peek"], b["k"], b["t"]):
                if held is not None:
                    out.append((*held, t))
                held = None if peek else (k, t)
            if out:
                yield _study(out)

    # Keys travel as text: pandas would turn longs with nulls into doubles.
    out = dealt.select("peek", F.col("k").cast("string").alias("k"), "t").mapInPandas(study, _EDIT_SCHEMA)
    return out.withColumn("k", F.col("k").cast("long")).withColumnRenamed("k", key)
