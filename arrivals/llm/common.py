"""Helpers shared by the operators: tables, word hashes, linking, components."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from itertools import filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.session import scratch_dir

#: Rows and bytes per Arrow batch: bound the memory of a Python worker, and of the
#: executor's buffers outside its heap, when texts or sets are long.
BATCH_ROWS, BATCH_BYTES = 512, 2 << 20
#: Bits of a candidate filter: 4 MB, and more for many values, up to 32 MB whatever the size of the input.
FILTER_BITS, MOST_FILTER_BITS = 1 << 25, 1 << 28
#: Bits per value from which a filter grows: about an eighth of other values pass then.
VALUE_BITS = 8
#: Groups up to this size compare all their members; larger ones start from leaders.
SMALL_GROUP = 24
LEADERS = 8
#: Of an id's shared keys, how many travel with it to tell a pair's first one.
FIRST_KEYS = 16
#: A group's members are dealt into blocks of about this many; two blocks at a time are compared.
BLOCK_IDS = 2048
#: Pairs whose signatures are held at once.
HELD_PAIRS = 8192
#: From so many pairs, one between each two components goes before the others.
MANY_PAIRS = 50_000
#: Edges that one task turns into stars.
TASK_EDGES = 250_000

U = np.uint64
_PRIME, _M1, _M2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: the lineage
    ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(stem: str, taken: list[str]) -> str:
    """A column name that no column of the input has."""
    low = {c.lower() for c in taken}
    return stem if stem.lower() not in low else f"{stem}_{uuid.uuid4().hex[:8]}"


# ---- words and shingles --------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


_FACTORS = mix(np.arange(1, 17, dtype=np.uint64) * _PRIME) | U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_INVERSE = U(pow(int(_PRIME), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Words kept per worker and generation.
_WORDS_KEPT = 120_000
#: The two low bits of a word's code: it ends a sentence; it starts with a capital.
ENDS, CAPITAL = U(1), U(2)


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, 1 << 12, 2 * len(_powers[0]))
        for i, base in enumerate((_PRIME, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


class Recent(dict):
    """What a worker has looked up lately, in two generations of at most
    ``limit`` entries; what is used again moves to the younger one."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def make_room(self, n: int) -> bool:
        if len(self) + n <= self.limit:
            return False
        self.old = self.copy()
        self.clear()
        return True

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def absent(self, keys: set) -> list:
        """The keys that must be looked up anew; the caller adds them."""
        new = list(filterfalse(self.__contains__, keys))
        if new and self.make_room(len(new)):
            new = list(keys)
        out = []
        for k in new:
            known = self.old.get(k)
            if known is None:
                out.append(k)
            else:
                self[k] = known
        return out


class _Words(Recent):
    """Codes of words met in this worker: 8 bytes each."""

    def __missing__(self, word: bytes) -> bytes:
        self.make_room(1)
        code = self.old.get(word)
        if code is None:
            low = hashlib.blake2b(word.lower(), digest_size=8).digest()
            capital = 65 <= word[0] <= 90 or (word[0] == 0xC3 and len(word) > 1 and 0x80 <= word[1] <= 0x9E)
            code = bytes((low[0] & 0xFC | 2 * capital | (word[-1] in b".!?"),)) + low[1:]
        self[word] = code
        return code


_words = _Words(_WORDS_KEPT)


def word_codes(data: bytes) -> np.ndarray:
    """Codes of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, in order: a
    62-bit hash of the word with A-Z lower-cased, and two flag bits."""
    return np.frombuffer(b"".join(map(_words.__getitem__, data.split())), "<u8")


def word_hashes(codes: np.ndarray) -> np.ndarray:
    return codes >> U(2)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word."""
    gap = _SPACE[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    return edge[0::2], edge[1::2]


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of ``k`` words, in order (``len(words) - k + 1``)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n] * _FACTORS[0] + U(k)
    for i in range(1, k):
        h += words[i:n + i] * _FACTORS[i]
    return mix(h)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-word shingles; shorter sequences give one shingle."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    return np.unique(windows(words, min(k, len(words))))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, tag: int = 0) -> np.ndarray:
    """A signed 64-bit hash of each range of a sequence of 64-bit values."""
    power, inverse = _power_tables(len(values) + 1)
    summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values) * power[:len(values)])))
    total = (summed[ends] - summed[starts]) * inverse[starts]
    return mix(total + (ends - starts).astype(np.uint64) * _M1 + U(tag * int(_M2) % (1 << 64))).view(np.int64)


def sequence_hash(values: np.ndarray) -> int:
    """One signed 64-bit hash of a sequence of 64-bit values."""
    return int(range_hashes(values, np.array([0]), np.array([len(values)]))[0])


def planes(x: np.ndarray) -> bytes:
    """Integers with their bytes of equal weight side by side, which compresses."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


# ---- a bounded filter of candidates ---------------------------------------

def bit_filter(ids: DataFrame, column: str):
    """Broadcast bit set holding every value of a long column.  It has no false
    negatives; beyond ``MOST_FILTER_BITS`` its size does not grow with the data."""
    spark = ids.sparkSession
    ids = stored(ids.select(column), "filter")
    size, n = FILTER_BITS, ids.count()
    while size < min(MOST_FILTER_BITS, VALUE_BITS * n):
        size *= 2
    slot = F.pmod(F.col(column), F.lit(size)) + 1
    rows = (ids.select(slot.alias("slot")).distinct()
            .groupBy(F.expr("bitmap_bucket_number(slot)").alias("part"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).collect())
    bits = np.zeros(size // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["part"] - 1) * len(part)
        bits[at:at + len(part)] = part[:max(0, len(bits) - at)]
    return spark.sparkContext.broadcast(bits)


def in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values.astype(np.int64) & (8 * len(bits) - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def split_by_filter(docs: DataFrame, bits, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose long ``column`` may be in the filter, and the
    others, which certainly are not and need no shuffle."""
    @F.pandas_udf("boolean")
    def may_be(values: pd.Series) -> pd.Series:
        return pd.Series(in_filter(bits.value, values.to_numpy(np.int64)))

    return docs.filter(may_be(F.col(column))), docs.filter(~may_be(F.col(column)))


# ---- connected components --------------------------------------------------

def _forest(batches):
    """Each task replaces its edges by a star for each tree it sees."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def stars():
        ids = np.fromiter(parent, np.int64, len(parent))
        tops = np.fromiter((root(x) for x in ids.tolist()), np.int64, len(ids))
        return pd.DataFrame({"a": ids[ids != tops], "b": tops[ids != tops]})

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    yield stars()


def few_tasks(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """``df`` in as many tasks as ``rows`` of work need, at least one per core."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def components(edges: DataFrame, label: str) -> DataFrame:
    """(id, label): the smallest id reachable, for every id of ``edges(a, b)``.

    Tasks of at most ``TASK_EDGES`` edges replace their edges by stars.  With
    one task that is the result; else large star and small star steps join the
    tasks' stars over edges that point from the larger to the smaller id, each
    round stored, until the edges are one star per component.
    """
    edges = stored(edges.filter("a <> b").select("a", "b"), label)
    tasks = max(1, -(-edges.count() // TASK_EDGES))

    def points_down(e: DataFrame) -> DataFrame:
        return (e.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .coalesce(tasks).mapInPandas(_forest, "a long, b long"))

    def labelled(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("id"), F.col("b").alias("label")).union(e.select("b", "b").distinct())

    e = stored(points_down(edges), label)
    while tasks > 1:
        # A star: no lower end is itself an upper end, and one lower end for each upper.
        centres = e.select(F.col("b").alias("a")).distinct().join(e, "a", "left_semi")
        many = e.groupBy("a").count().filter("count > 1").select("a")
        if centres.union(many).isEmpty():
            break
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e2 = points_down(large.union(low.select("a", "m")))
        low2 = e2.groupBy("a").agg(F.min("b").alias("m"))
        small = e2.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(points_down(small.union(low2.select("a", "m"))).distinct(), label)
    return labelled(e)


# ---- keys that several senders share -----------------------------------------

def met_twice(keys: DataFrame) -> DataFrame:
    """The ``key`` values that occur more than once; rows of one small column
    travel, and partial aggregates make a hot key small."""
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")


# ---- links between members that share a key --------------------------------

def _rows(lists: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of longs as rows of ``width``, and which places are theirs."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    own = np.arange(width) < sizes[:, None]
    out = np.zeros(own.shape, np.int64)
    out[own] = np.concatenate([*lists, np.empty(0, np.int64)])
    return out, own


def _pairs_of_cell(g: dict[str, np.ndarray]) -> np.ndarray:
    """Rows (a, b, la, lb, most): pairs of a cell's members that may be linked and
    are in different components, of which one at least is not the group's main one.

    Bits that both signatures have, and elements that share a bit of their own
    set, bound the overlap.  A pair is taken at the first of the keys it shares.
    """
    ids, size, rest, label, block, spare, bits, keys, own = (g[c] for c in (
        "id", "size", "rest", "label", "block", "spare", "bits", "keys", "own"))
    minor = label != g["main"]
    first = np.flatnonzero(minor)
    each = max(1, 64 * HELD_PAIRS // len(ids))
    found = [np.empty((0, 5), np.int64)]
    for at in range(0, len(first), each):
        some = first[at:at + each]
        i = some[:, None]
        may = (label[i] != label) & (~minor | (ids[i] < ids)) & (9 * np.minimum(rest[i], rest) >= 4 * (size[i] + size))
        if g["low"][0] != g["high"][0]:
            may &= block[i] != block
        x, y = np.nonzero(may)
        x = some[x]
        for to in range(0, len(x), HELD_PAIRS):
            p, q = x[to:to + HELD_PAIRS], y[to:to + HELD_PAIRS]
            most = np.minimum(spare[p], spare[q]) + np.bitwise_count(bits[p] & bits[q]).sum(1, dtype=np.int64)
            keep = 9 * most >= 4 * (size[p] + size[q])
            p, q, most = p[keep], q[keep], most[keep]
            if len(p) and keys.shape[1]:
                # Only some first keys of an id travel: where they show no shared one, the pair may come again.
                both = ((keys[p][:, :, None] == keys[q][:, None, :]) & own[p][:, :, None] & own[q][:, None, :]).any(2)
                once = ~both.any(1) | (keys[p, both.argmax(1)] == g["key"][0])
                p, q, most = p[once], q[once], most[once]
            p, q = np.where(ids[p] > ids[q], (q, p), (p, q))
            found.append(np.column_stack((ids[p], ids[q], label[p], label[q], most)))
    return np.concatenate(found)


def pairs_apart(known: DataFrame, signatures: DataFrame) -> DataFrame:
    """Distinct pairs (a, b, la, lb, most) of ``known`` (key, n, id, size, rest,
    label, main) that share a key, have different labels and may be linked;
    ``most`` bounds the overlap.  Groups are cut into blocks, and each cell of
    two blocks is compared in one piece, whatever the size of the group."""
    first = F.array_sort(F.collect_list(F.struct((-F.col("rest")).alias("r"), "key")))
    own = (known.groupBy("id").agg(F.slice(F.transform(first, lambda x: x["key"]), 1, FIRST_KEYS).alias("keys"))
           .join(signatures.dropDuplicates(["id"]).select("id", "bits"), "id"))
    side = F.ceil(F.col("n") / BLOCK_IDS)
    cells = (known.withColumn("side", side.cast("long"))
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("side")))
             .withColumn("other", F.explode(F.expr("sequence(0L, side - 1)")))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
             .drop("n", "side", "other").join(own, "id")
             .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high"))

    def compare(batches):
        plain = ("key", "low", "high", "block", "id", "size", "rest", "label", "main")
        held: list[dict[str, np.ndarray]] = []

        def pairs() -> np.ndarray:
            return _pairs_of_cell({c: np.concatenate([h[c] for h in held]) for c in held[0]})

        for b in batches:
            if not len(b):
                continue
            cols = {c: b[c].to_numpy(np.int64) for c in plain}
            bits, (keys, own) = np.stack(b["bits"].to_list()).view(np.uint64), _rows(b["keys"].to_list(), FIRST_KEYS)
            cols |= {"bits": bits, "keys": keys, "own": own,
                     "spare": cols["size"] - np.bitwise_count(bits).sum(1, dtype=np.int64)}
            cell = np.column_stack([cols[c] for c in plain[:3]])
            starts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1), len(b)]
            found = []
            for i, j in zip(starts, starts[1:]):
                if held and any(held[-1][c][0] != cols[c][i] for c in plain[:3]):
                    found.append(pairs())
                    held = []
                held.append({c: v[i:j] for c, v in cols.items()})
            if found:
                yield pd.DataFrame(np.concatenate(found), columns=["a", "b", "la", "lb", "most"])
        if held:
            yield pd.DataFrame(pairs(), columns=["a", "b", "la", "lb", "most"])

    return cells.mapInPandas(compare, "a long, b long, la long, lb long, most long").distinct()


def link_groups(members: DataFrame, verify: Callable[[DataFrame], DataFrame], label: str,
                signatures: DataFrame) -> DataFrame:
    """Components of the links between members that share a key.

    ``members``: distinct (key, id, size, rest); ``rest`` is an upper
    bound of the overlap of two members whose first shared key this is.
    ``verify`` keeps the linked ones of distinct, stored pairs (a, b).  Small groups
    compare all their members.  A large group first compares every member
    with a few leaders; what the links so far leave in different components
    is then compared in full, so no link between components is lost while a
    group of n copies costs about n comparisons.  ``signatures`` (id, bits:
    array of longs) bound the overlap there: a bit that one id has alone
    is an element that it has alone.
    Returns (id, label) of every id that has a link.
    """
    possible = F.expr("9 * least(x.rest, y.rest) >= 4 * (x.size + y.size)")
    sizes_fit = F.expr("9 * least(x.size, y.size) >= 4 * (x.size + y.size)")
    members = stored(members, label)
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = stored(members.join(counts, "key"), label)
    few = sized.filter(F.col("n") <= SMALL_GROUP).drop("n")
    within = (few.alias("x").join(few.alias("y"), F.expr("x.key = y.key and x.id < y.id") & possible)
              .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    many = sized.filter(F.col("n") > SMALL_GROUP)
    leaders = (many.groupBy("key")
               .agg(F.array_distinct(F.array(*[
                   F.min(F.struct(F.xxhash64("id", F.lit(j)), F.struct("id", "size"))).getField("col2")
                   for j in range(LEADERS)])).alias("leaders")))
    # Each member meets the leaders of its largest group only.
    largest = many.groupBy("id", "size").agg(F.max(F.struct("n", "key")).getField("key").alias("key"))
    starred = (largest.join(leaders, "key").select("id", "size", F.explode("leaders").alias("y"))
               .select(F.struct("id", "size").alias("x"), "y").filter("x.id <> y.id").filter(sizes_fit)
               .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")))
    links = stored(verify(stored(within.union(starred).distinct(), label)), label)
    labels = components(links, label)
    if many.isEmpty():
        return labels
    known = (many.join(labels, "id", "left")
             .select("key", "n", "id", "size", "rest", F.coalesce("label", "id").alias("label")))
    apart = (known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                      F.mode("label").alias("main")).filter("lo < hi").select("key", "main"))
    known = stored(known.join(apart, "key"), label)
    if known.isEmpty():
        return labels
    rest = stored(pairs_apart(known, signatures), label)
    n = rest.count()
    if n > MANY_PAIRS:
        # What the likeliest pair of two components links needs no other pair.
        best = stored(rest.groupBy(F.least("la", "lb"), F.greatest("la", "lb"))
                      .agg(F.max(F.struct("most", "a", "b")).alias("p")).select("p.a", "p.b"), label)
        links = stored(links.union(verify(best)), label)
        labels = components(links, label)
        for end in ("a", "b"):
            rest = (rest.join(labels.select(F.col("id").alias(end), F.col("label").alias("now" + end)), end, "left")
                    .withColumn("l" + end, F.coalesce("now" + end, "l" + end)))
        rest = rest.filter("la <> lb").join(best, ["a", "b"], "left_anti")
    later = stored(verify(stored(rest.select("a", "b"), label)), label)
    return labels if later.isEmpty() else components(links.union(later), label)
