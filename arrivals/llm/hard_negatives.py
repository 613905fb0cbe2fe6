"""Operator 13, hard negatives by a residue-number-system matrix product.

Vectors are floored to integers.  Each block of scores is one float32 product
per small prime of the component residues, exact because a sum of ``SEGMENT``
products of residues stays below 2**24; the signed scores come back by Chinese
remaindering.  The first pass finds each anchor's positives, the second the
other labels' rows whose scores lie in a window below each positive's score.
Anchors and rows meet in a grid of cells of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals.llm import common as C

SCALE = 256
EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
#: Dimensions that one float32 product sums, and the greatest prime whose
#: centred residues allow it: SEGMENT * ((PRIME - 1) / 2)**2 < 2**24.
SEGMENT, PRIME = 256, 509
#: Score bounds up to here are reconstructed in 64-bit integers; larger ones
#: take Python's integers.
EXACT = 1 << 52
#: Anchors and rows of one cell at most; rows that make another cell worth while.
CELL_ANCHORS, CELL_ROWS, LEAST_ROWS = 8192, 65_536, 2048
#: Scores held at once.
TILE_ANCHORS, TILE_ROWS = 256, 4096
_LONG = (-(1 << 63), (1 << 63) - 1)


def primes(bound: int) -> list[int]:
    """The greatest primes up to ``PRIME`` whose product exceeds 2 * bound + 1."""
    out, product, n = [], 1, PRIME
    while product <= 2 * bound + 1:
        if all(n % d for d in range(2, math.isqrt(n) + 1)):
            out.append(n)
            product *= n
        n -= 1
    return out


def integers(vectors, width: int) -> np.ndarray:
    """floor(SCALE * x) as doubles, shorter vectors ending in zeros."""
    out = np.zeros((len(vectors), width))
    for r, v in enumerate(vectors):
        out[r, :len(v)] = np.asarray(v, np.float64)
    with np.errstate(over="ignore"):
        return np.floor(out * SCALE)


def score_bound(a: np.ndarray, c: np.ndarray) -> int:
    """No inner product of a row of ``a`` with one of ``c`` is larger (Cauchy-Schwarz)."""
    with np.errstate(over="ignore"):
        most = np.sqrt((a * a).sum(1).max(initial=0.0)) * np.sqrt((c * c).sum(1).max(initial=0.0))
    return int(most * (1 + 1e-9)) + 1 if math.isfinite(most) else 1 << 2000


class Residues:
    """Component matrices modulo several primes, as float32."""

    def __init__(self, m: np.ndarray, moduli: list[int]):
        self.moduli = moduli
        self.parts = []
        for p in moduli:
            r = np.mod(m, p)
            self.parts.append(np.where(r > p // 2, r - p, r).astype(np.float32))

    def rows(self, at: slice) -> list[np.ndarray]:
        return [part[at] for part in self.parts]


def products(a: list[np.ndarray], c: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact signed inner products from residue matrices: one float32 product
    per prime, then mixed-radix digits of the Chinese remainder."""
    digits: list[np.ndarray] = []
    total = np.zeros((len(a[0]), len(c[0])), np.int64)
    weight = 1
    for i, p in enumerate(moduli):
        r = np.zeros(total.shape, np.int32)
        for at in range(0, a[i].shape[1], SEGMENT):
            r += np.mod((a[i][:, at:at + SEGMENT] @ c[i][:, at:at + SEGMENT].T).astype(np.int32), p)
        for q, d in zip(moduli, digits):
            r = np.mod((r - d) * pow(q, -1, p), p)
        r = np.mod(r, p)
        digits.append(r)
        total += r.astype(np.int64) * weight
        weight *= p
    return np.where(total > weight // 2, total - weight, total)


def _long_integers(m: np.ndarray) -> np.ndarray:
    return np.array([[int(x) if math.isfinite(x) else int(math.copysign(1, x)) * (1 << 1030) for x in row]
                     for row in m], object).reshape(m.shape)


def tiles(a: np.ndarray, c: np.ndarray):
    """(first anchor, first row, scores) of every tile of the scores of ``a``
    with ``c``; scores beyond a long are limited to its range."""
    bound = score_bound(a, c)
    exact = bound < EXACT
    if exact:
        moduli = primes(bound)
        ra, rc = Residues(a, moduli), Residues(c, moduli)
    for i in range(0, len(a), TILE_ANCHORS):
        for j in range(0, len(c), TILE_ROWS):
            own, other = slice(i, i + TILE_ANCHORS), slice(j, j + TILE_ROWS)
            if exact:
                yield i, j, products(ra.rows(own), rc.rows(other), moduli)
            else:
                whole = _long_integers(a[own]) @ _long_integers(c[other]).T
                yield i, j, np.clip(whole, *_LONG).astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id (~s orders
    descending without overflow)."""
    if len(scores) > 8 * k:
        least = -np.partition(~scores, k - 1)[k - 1] - 1
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], ~scores[at]))[:k]]
    return np.lexsort((ids, ~scores))[:k]


def _columns(frame: pd.DataFrame, width: int):
    return frame["id"].to_numpy(np.int64), frame["y"].to_numpy(np.int64), integers(frame["v"], width)


def mine(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label",
         every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose key is divisible by ``every``.  An anchor's
    positives are its first ``positives`` other rows of the same label by
    integer inner product, ties to the smaller key.  For each anchor and
    positive the first ``negatives`` rows of other labels follow whose score
    is ``low`` to ``high`` percent of the positive's.

    Rows with a null key, label or vector, or a null or non-finite component
    take no part.  Shorter vectors count as ending in zeros; an empty vector
    scores 0 with everything.  Rows that repeat a key are all candidates, none
    is its own key's positive; a repeated anchor answers once, by its least
    (label, vector).  Scores are limited to the range of a long.  An empty
    table, and one without anchors, gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = (vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("y"),
                           F.col(column).alias("v"))
            .filter("id is not null and y is not null and v is not null")
            .filter(~F.exists(F.col("v").cast("array<double>"),
                              lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("d"),
                     F.count_if(F.pmod("id", F.lit(every)) == 0).alias("anchors")).first()
    width = max(1, facts["d"])
    cores = spark.sparkContext.defaultParallelism
    across = max(-(-facts["n"] // CELL_ROWS), min(cores, -(-facts["n"] // LEAST_ROWS)), 1)
    down = max(-(-facts["anchors"] // CELL_ANCHORS), 1)
    # The rows' places in the grid are written down: a rerun task cannot deal them anew.
    laid = C.stored(rows.withColumn("column", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(across))
                                    .cast("int")), "negatives-rows")
    anchors = (laid.filter(F.pmod("id", F.lit(every)) == 0).groupBy("id")
               .agg(F.min(F.struct("y", "v")).alias("own")).select("id", "own.y", "own.v")
               .withColumn("row", F.pmod(F.xxhash64("id"), F.lit(down)).cast("int")))

    def everywhere(df: DataFrame, own: str, other: str, n: int) -> DataFrame:
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).groupBy("row", "column")

    offered = everywhere(laid, "column", "row", down)

    def nearest(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(offered):
            (ids, ys, a), (own, yc, c) = _columns(asked, width), _columns(offered, width)
            for i, j, scores in tiles(a, c):
                for r, s in enumerate(scores):
                    to = slice(j, j + scores.shape[1])
                    at = np.flatnonzero((yc[to] == ys[i + r]) & (own[to] != ids[i + r]))
                    best = at[_first(s[at], own[to][at], positives)]
                    out += zip([ids[i + r]] * len(best), own[to][best].tolist(), s[best].tolist())
        return pd.DataFrame(out, columns=["id", "p_id", "p_score"]).astype("int64")

    first = (everywhere(anchors, "row", "column", across).cogroup(offered)
             .applyInPandas(nearest, "id long, p_id long, p_score long"))
    by = Window.partitionBy("id").orderBy(F.desc("p_score"), "p_id")
    chosen = (first.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= positives)
              .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "p_id", "p_score"))).alias("chosen")))
    asked = C.stored(anchors.join(chosen, "id").withColumns({
        "p_id": F.col("chosen.p_id"), "p_score": F.col("chosen.p_score")}).drop("chosen"), "negatives-anchors")

    def below(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(offered):
            (ids, ys, a), (own, yc, c) = _columns(asked, width), _columns(offered, width)
            goals = [list(zip(p.tolist(), s.tolist())) for p, s in zip(asked["p_id"], asked["p_score"])]
            for i, j, scores in tiles(a, c):
                to = slice(j, j + scores.shape[1])
                for r, s in enumerate(scores):
                    # ceil(low * p / 100) <= s <= floor(high * p / 100), in Python's integers.
                    reach = [(-(-low * p // 100), high * p // 100) for _, p in goals[i + r]]
                    at = np.flatnonzero((yc[to] != ys[i + r]) & (s >= max(min(x for x, _ in reach), _LONG[0]))
                                        & (s <= min(max(x for _, x in reach), _LONG[1])))
                    for place, ((p_id, p), (least, most)) in enumerate(zip(goals[i + r], reach)):
                        if least > most:
                            continue
                        fit = at[(s[at] >= max(least, _LONG[0])) & (s[at] <= min(most, _LONG[1]))]
                        best = fit[_first(s[fit], own[to][fit], negatives)]
                        out += [(ids[i + r], place, p_id, p, n, t)
                                for n, t in zip(own[to][best].tolist(), s[best].tolist())]
        return pd.DataFrame(out, columns=["id", "place", "p_id", "p_score", "n_id", "n_score"]).astype("int64")

    found = (everywhere(asked, "row", "column", across).cogroup(offered)
             .applyInPandas(below, "id long, place long, p_id long, p_score long, n_id long, n_score long"))
    by = Window.partitionBy("id", "place").orderBy(F.desc("n_score"), "n_id")
    return (found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= negatives)
            .select(F.col("id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank",
                    F.col("n_id").alias("negative_id"), F.col("p_score").alias("positive_score"),
                    F.col("n_score").alias("negative_score")))
