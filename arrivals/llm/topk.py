"""Operator 5, exact top-k inner products over norm-sorted vectors.

Components are floored to integers.  Candidates lie in blocks by descending
length.  The longest blocks give each query a first k-th best score; a block
can be skipped when |q| times its greatest length cannot reach it.  Inside a
block, vectors are rotated by the right singular vectors of a sample: the
leading coordinates give a partial sum and the lengths of the rest bound what
is missing (Cauchy-Schwarz).  Survivors are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C

SCALE = 64
TOP = 20
BLOCK, QUERY_BLOCK = 1024, 256
#: Vectors that fit the rotation, and blocks that give the first thresholds.
SAMPLE, SEED_BLOCKS = 4096, 4
#: The rotation cannot change a bound by more than this share of |q||c|.
SLACK = 1e-9
_EXACT = float(1 << 53)


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; Python integers where doubles cannot hold them,
    limited to the range of a long."""
    if not len(q) or not len(c):
        return np.zeros((len(q), len(c)), np.int64)
    most = np.sqrt((q * q).sum(1).max()) * np.sqrt((c * c).sum(1).max())
    if most < _EXACT / 2:
        return (q @ c.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in q], object) @ \
        np.array([[int(x) for x in row] for row in c], object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _matrix(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, width)


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(1))


class Best:
    """The best scores so far of one block of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rotation: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.floor = floor.astype(np.float64)  # scores below are out
        self.lengths = _lengths(vectors)
        self.lead = max(1, rotation.shape[0] // 4)
        turned = vectors @ rotation
        self.head, self.tail = turned[:, :self.lead], _lengths(turned[:, self.lead:])
        self.rotation = rotation
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]

    def visit(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        lengths = _lengths(vectors)
        slack = SLACK * self.lengths * lengths.max() + SLACK
        live = np.flatnonzero(self.lengths * lengths.max() + slack >= self.floor)
        if not len(live):
            return
        turned = vectors @ self.rotation
        bound = (self.head[live] @ turned[:, :self.lead].T
                 + self.tail[live][:, None] * _lengths(turned[:, self.lead:])[None, :])
        keep = bound + slack[live][:, None] >= self.floor[live][:, None]
        use = np.flatnonzero(keep.any(0))
        scores = exact_scores(self.vectors[live], vectors[use])
        keep, own = keep[:, use], ids[use]
        for row, q in enumerate(live):
            ok = keep[row] & (scores[row] >= self.floor[q]) & (own != self.ids[q])
            if ok.any():
                s = np.concatenate((self.found[q][0], scores[row][ok]))
                i = np.concatenate((self.found[q][1], own[ok]))
                first = np.lexsort((i, ~s))[:self.k]  # ~s orders descending without overflow
                self.found[q] = s[first], i[first]
                if len(first) == self.k:
                    self.floor[q] = max(self.floor[q], _below(int(s[first[-1]])))

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({
            "query_id": np.repeat(self.ids, [len(s) for s, _ in self.found]),
            "vec_id": np.concatenate([i for _, i in self.found]),
            "score": np.concatenate([s for s, _ in self.found])})


def _below(score: int) -> float:
    """The largest double that is not above ``score``."""
    f = float(score)
    return f if int(f) <= score else float(np.nextafter(f, -np.inf))


def top_inner_products(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
                       every: int = 20, k: int = TOP) -> DataFrame:
    """(query_id, rank, ``key``, score): the ``k`` greatest integer inner
    products of each query with all vectors but those of its own key, ties to
    the smaller key.  Queries are the rows whose key is divisible by ``every``.

    Rows with a null key, a null vector, or a null or non-finite component take
    no part.  Shorter vectors count as ending in zeros; an empty vector scores
    0.  Rows that repeat a key are all candidates; a repeated query row answers
    once.  Scores are limited to the range of a long.
    """
    spark = vectors.sparkSession
    C.small_batches(spark, 16)
    rows = (vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
            .filter("id is not null and v is not null")
            .filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))))
    facts = rows.agg(F.max(F.size("v")).alias("d"), F.count(F.lit(1)).alias("n")).first()
    schema = f"query_id long, rank int, {key} long, score long"
    if not facts["n"]:
        return spark.createDataFrame([], schema)
    width = max(1, facts["d"])
    whole = rows.select("id", "v")

    def floored(batch: pd.Series) -> np.ndarray:
        out = np.zeros((len(batch), width))
        for r, v in enumerate(batch):
            out[r, :len(v)] = np.floor(np.asarray(v, np.float64) * SCALE)
        return out

    part = max(1, facts["n"] // SAMPLE)
    sample = floored(whole.filter(F.pmod(F.xxhash64("id"), F.lit(part)) == 0).select("v").toPandas()["v"])
    rotation = np.linalg.svd(sample, full_matrices=True)[2].T if len(sample) else np.eye(width)
    if not np.isfinite(rotation).all():
        rotation = np.eye(width)
    rotation = spark.sparkContext.broadcast(rotation)

    def blocks(size: int):
        def build(batches):
            def frame(i, m):
                by = np.argsort(-_lengths(m), kind="stable")
                return pd.DataFrame({"ids": [i[by].tobytes()], "m": [m[by].tobytes()],
                                     "longest": [float(_lengths(m).max())]})

            i, m = np.empty(0, np.int64), np.empty((0, width))
            for b in batches:
                i = np.concatenate((i, b["id"].to_numpy(np.int64)))
                m = np.concatenate((m, floored(b["v"])))
                while len(i) >= size:
                    yield frame(i[:size], m[:size])
                    i, m = i[size:], m[size:]
            if len(i):
                yield frame(i, m)
        return build

    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    kind = "ids binary, m binary, longest double"

    def in_blocks(df: DataFrame, size: int, label: str) -> DataFrame:
        n = max(1, -(-df.count() // (8 * size)))
        sorted_ = (df.withColumn("len", length).repartitionByRange(n, F.desc("len"), "id")
                   .sortWithinPartitions(F.desc("len"), "id").drop("len"))
        return C.stored(sorted_.mapInPandas(blocks(size), kind), label)

    candidates = in_blocks(whole, BLOCK, "topk-vectors")
    queries = in_blocks(whole.filter(F.pmod("id", F.lit(every)) == 0).dropDuplicates(["id"]), QUERY_BLOCK,
                        "topk-queries")
    seeds = [(np.frombuffer(r["ids"], np.int64), _matrix(r["m"], width))
             for r in candidates.orderBy(F.desc("longest")).limit(SEED_BLOCKS).collect()]
    seeds = spark.sparkContext.broadcast(seeds)

    def thresholds(batches):
        for b in batches:
            out = []
            for ids, m in zip(b["ids"], b["m"]):
                i, q = np.frombuffer(ids, np.int64), _matrix(m, width)
                best = Best(i, q, rotation.value, np.full(len(i), -np.inf), k)
                for own, vecs in seeds.value:
                    best.visit(own, vecs)
                reach = best.floor / np.maximum(best.lengths, 1e-300)
                out.append((ids, m, best.floor.tobytes(), float(reach.min()) * (1 - 1e-6) - 1e-6))
            yield pd.DataFrame(out, columns=["q_ids", "q_m", "floor", "reach"])

    slots = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = C.stored(queries.mapInPandas(thresholds, "q_ids binary, q_m binary, floor binary, reach double")
                     .withColumn("block", F.xxhash64("q_ids")), "topk-asked")
    asked = (asked.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
             .repartition(slots, "slot").sortWithinPartitions("slot", "block"))
    offered = (candidates.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int"))
               .repartition(slots, "slot").sortWithinPartitions("slot", F.desc("longest")))
    met = (asked.hint("merge").join(offered, "slot").filter("longest >= reach")
           .select("block", "q_ids", "q_m", "floor", "ids", "m"))

    def search(batches):
        block, best = None, None
        for b in batches:
            for name, q_ids, q_m, floor, ids, m in b.itertuples(index=False):
                if name != block:
                    if best is not None:
                        yield best.frame()
                    block = name
                    best = Best(np.frombuffer(q_ids, np.int64), _matrix(q_m, width), rotation.value,
                                np.frombuffer(floor, np.float64), k)
                best.visit(np.frombuffer(ids, np.int64), _matrix(m, width))
        if best is not None:
            yield best.frame()

    from pyspark.sql import Window

    found = met.mapInPandas(search, "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("vec_id").alias(key), "score"))
