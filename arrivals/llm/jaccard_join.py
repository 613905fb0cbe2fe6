"""Operator 10, n-gram Jaccard join: size-banded tiles with bitmap signatures.

Each text becomes the sorted set of its 5-word shingles (64-bit hashes); equal
sets are one class.  A class sends out only a prefix of its set in one order
for all sets (shingles common in a sample last, then by hash): two sets of
similarity t share one of the first ``n - ceil(t*n) + 1`` shingles of each.
Classes that share such a shingle and lie in size bands that can reach the
threshold are compared, first by their bitmaps (a bit that only A has is a
shingle that only A has, so bit counts bound the overlap from above), then by
exact intersection of their sets.  What travels to that comparison is a text of
each class, compressed, a fraction of the size of its shingles' hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C
from arrivals.llm.pitman_yor import word_hashes

SHINGLE = 5
#: Links need 100 * intersection >= 80 * union.
PERCENT = 80
#: Bits of a signature.
SIGNATURE = 2048
#: The shingle order puts shingles that recur in a sample of about this many
#: documents last.  It only steers the work: any common order gives the same links.
SAMPLE_DOCS = 20_000
COMMON_IN_SAMPLE = 3
COMMON_SHINGLES = 200_000
#: Bytes of texts whose sets a worker holds at once.
HELD_BYTES = 4 << 20


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    return [C.shingle_set(words, SHINGLE) for words in word_hashes(texts)]


def shingles_of(text: str | None) -> np.ndarray:
    return shingle_sets([text])[0]


def class_of(s: np.ndarray) -> int:
    return C.sequence_hash(s)


def prefix_of(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles a partner at the threshold must share one of, in order."""
    n = len(s)
    take = n - -(-n * PERCENT // 100) + 1
    at = np.minimum(np.searchsorted(common, s), max(0, len(common) - 1))
    hot = common[at] == s if len(common) else np.zeros(n, bool)
    rare = s[~hot]
    return rare[:take] if len(rare) >= take else np.concatenate((rare, s[hot][:take - len(rare)]))


def linked(pairs: list[tuple[int, int]], sets: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """The pairs whose sets reach the threshold."""
    out = []
    for x, y in pairs:
        both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        if 100 * both >= PERCENT * (len(sets[x]) + len(sets[y]) - both):
            out.append((x, y))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    bits = np.zeros(SIGNATURE, np.uint8)
    bits[(s >> np.uint64(17)) % np.uint64(SIGNATURE)] = 1
    return np.packbits(bits).view(np.int64)


def common_shingles(docs: DataFrame, text: str) -> np.ndarray:
    """Shingles in several documents of a bounded sample, sorted."""
    n = docs.count()
    part = max(1, n // SAMPLE_DOCS)
    sample = docs.filter(F.pmod(F.xxhash64(F.substring(text, 1, 200), F.length(text)), F.lit(part)) == 0)

    def count(batches):
        for b in batches:
            sets = shingle_sets(b["t"].tolist())
            yield pd.DataFrame({"s": np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)})

    rows = (sample.select(F.col(text).alias("t")).dropDuplicates().mapInPandas(count, "s long")
            .groupBy("s").count().filter(F.col("count") >= COMMON_IN_SAMPLE)
            .orderBy(F.desc("count"), "s").limit(COMMON_SHINGLES).select("s").toArrow())
    return np.sort(rows["s"].to_numpy().astype(np.int64).view(np.uint64))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (``key``, n_shingles, component_id, text_hash).

    ``component_id`` is the smallest key reachable over links, itself
    included.  Null, empty and blank texts have no shingles and no links.
    Rows with the same key are kept; rows with a null key link like others,
    and a component of null keys only has a null id.  ``text_hash`` is xxhash64
    of the text, to tell rows of one key apart.  Other columns are ignored.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    docs = (docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
            .withColumn("row", F.xxhash64("t")))
    common = spark.sparkContext.broadcast(common_shingles(docs, "t"))

    def sets(batches):
        seen: set[int] = set()
        for b in batches:
            out = []
            for k, row, s in zip(b["k"], b["row"], shingle_sets(b["t"].tolist())):
                c = class_of(s) if len(s) else None
                new = c is not None and c not in seen
                if new:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(c)
                out.append((k, row, len(s), c, prefix_of(s, common.value).view(np.int64) if new else None,
                            signature(s) if new else None))
            frame = pd.DataFrame(out, columns=["k", "row", "n", "cls", "keys", "bits"], dtype=object)
            yield frame.astype({"row": "int64", "n": "int64", "cls": "Int64"})

    # Keys travel as text: pandas would turn longs with nulls into doubles.
    sets_of = C.stored(docs.withColumn("k", F.col("k").cast("string")).mapInPandas(
        sets, "k string, row long, n long, cls long, keys array<long>, bits array<long>")
        .withColumn("k", F.col("k").cast("long")), "jaccard-sets")
    senders = sets_of.filter("keys is not null")
    wanted = C.bit_filter(C.met_twice(senders.select(F.explode("keys").alias("key"))), "key")

    def spread(batches):
        for b in batches:
            sizes = b["keys"].map(len).to_numpy(np.int64)
            key = np.concatenate([*b["keys"], np.empty(0, np.int64)]).astype(np.int64)
            pos = np.concatenate([*map(np.arange, sizes), np.empty(0, np.int64)]).astype(np.int64)
            keep = C.in_filter(wanted.value, key)
            frame = pd.DataFrame({c: np.repeat(b[x].to_numpy(np.int64), sizes)[keep]
                                  for c, x in (("id", "cls"), ("size", "n"))})
            yield frame.assign(key=key[keep], rest=frame["size"] - pos[keep])

    # Tiles: a shingle and a size band; a set of band b meets bands b - 1 to b + 1.  In the
    # tile of band b + 1 it meets larger sets, which must share an earlier shingle of it.
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    larger = F.pow(F.lit(100 / PERCENT), band + 1) * (1 - 1e-6)
    tiles = F.when((100 + PERCENT) * F.col("rest") >= PERCENT * (F.col("size") + larger), F.array(band, band + 1))
    members = (senders.select("cls", "n", "keys").mapInPandas(spread, "id long, size long, key long, rest long")
               .select("key", "id", "size", "rest", F.explode(tiles.otherwise(F.array(band))).alias("tile"))
               .select(F.xxhash64("key", "tile").alias("key"), "id", "size", "rest").distinct())

    def may_link(batches):
        for b in batches:
            if len(b):
                x, y = (np.stack(b[c].to_list()).view(np.uint64) for c in ("xb", "yb"))
                sx, sy = b["xn"].to_numpy(), b["yn"].to_numpy()
                most = np.minimum(sx - np.bitwise_count(x & ~y).sum(1), sy - np.bitwise_count(y & ~x).sum(1))
                b = b[(100 + PERCENT) * most >= PERCENT * (sx + sy)]
            yield b[["a", "b"]]

    def link(batches):
        for b in batches:
            pairs, texts, held = [], {}, 0
            for last, (x, y, xt, yt) in enumerate(zip(b["a"], b["b"], b["xt"], b["yt"]), 1):
                for i, packed in ((x, xt), (y, yt)):
                    if i not in texts:
                        texts[i] = zstandard.decompress(packed).decode("utf-8", "surrogatepass")
                        held += len(texts[i])
                pairs.append((x, y))
                if held >= HELD_BYTES or last == len(b):
                    yield pd.DataFrame(linked(pairs, dict(zip(texts, shingle_sets(list(texts.values()))))),
                                       columns=["a", "b"], dtype=np.int64)
                    pairs, texts, held = [], {}, 0

    def joined(pairs: DataFrame, own: DataFrame) -> DataFrame:
        for side, end in (("x", "a"), ("y", "b")):
            pairs = pairs.join(own.select(F.col("id").alias(end), *[
                F.col(c).alias(side + c[0]) for c in own.columns if c != "id"]), end)
        return pairs

    def verify(pairs: DataFrame) -> DataFrame:
        # Several tasks may have sent a class.
        bits = senders.select(F.col("cls").alias("id"), F.col("bits").alias("b"), "n").dropDuplicates(["id"])
        near = C.stored(C.few_tasks(joined(pairs, bits), pairs.count()).mapInPandas(may_link, "a long, b long"),
                        "jaccard-near")
        some = near.count()
        ends = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        rows = C.bit_filter(senders.join(ends, F.col("cls") == F.col("id"), "left_semi")
                            .groupBy("cls").agg(F.min("row").alias("row")), "row")

        def texts(batches):
            seen: set[int] = set()
            for b in batches:
                out = []
                some = b["t"][C.in_filter(rows.value, b["row"].to_numpy(np.int64))].tolist()
                for t, s in zip(some, shingle_sets(some)):
                    c = class_of(s) if len(s) else None
                    if c is not None and c not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(c)
                        out.append((c, zstandard.compress(t.encode("utf-8", "surrogatepass"))))
                yield pd.DataFrame(out, columns=["id", "text"])

        # Any text of a class has its set.
        items = C.stored(docs.select("row", "t").mapInPandas(texts, "id long, text binary"),
                         "jaccard-texts").dropDuplicates(["id"])
        return C.few_tasks(joined(near.distinct(), items), some, 20_000).mapInPandas(link, "a long, b long")

    labels = C.link_groups(members, verify, "jaccard-links",
                           senders.select(F.col("cls").alias("id"), "bits"))
    grouped = (sets_of.filter("cls is not null").select("k", "n", "row", "cls")
               .join(labels.withColumnRenamed("id", "cls"), "cls", "left")
               .select("k", "n", "row", F.coalesce("label", "cls").alias("label")))
    grouped = C.stored(grouped, "jaccard-labels")
    first = grouped.groupBy("label").agg(F.min("k").alias("component_id"))
    alone = sets_of.filter("cls is null").select("k", "n", F.col("k").alias("component_id"), "row")
    return (grouped.join(first, "label").select("k", "n", "component_id", "row").unionByName(alone)
            .select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id",
                    F.col("row").alias("text_hash")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one whose key names
    it.  Of rows that repeat a key and text one stays; rows with a null key,
    and texts without shingles, stay unless such a repeat."""
    own, gone = (C.fresh(x, docs.columns) for x in ("row_hash", "gone"))
    # Stored, as three queries read it.
    found = C.stored(jaccard_components(docs, key, text).select(key, "component_id", F.xxhash64(
        key, "text_hash").alias("row")), "jaccard-found")
    out = found.filter(F.col(key) != F.col("component_id")).select(F.col("row").alias(gone)).distinct()
    again = found.groupBy("row").count().filter("count > 1").select(F.col("row").alias(gone))
    # Only rows that may go, or repeat, are shuffled.
    touched = C.bit_filter(out.union(again), gone)
    named = docs.withColumn(own, F.xxhash64(F.col(key).cast("long"), F.xxhash64(F.col(text).cast("string"))))
    some, others = C.split_by_filter(named, touched, own)
    kept = some.join(out, F.col(own) == F.col(gone), "left_anti").dropDuplicates([own])
    return others.unionByName(kept).drop(own)
