"""Operator 9, substring dedup by paragraph MinHash banding.

Paragraphs are lines and, within lines, sentences, so that a passage set into
a longer line is found too.  Equal paragraphs are one class.  One of each class
of lines of at least ``LINE_WORDS`` words sends out MinHash bands of its 5-word
shingles; lines that collide in a band are verified by exact Jaccard similarity
of 0.8 or more and clustered by connected components.  Lines that hold one
common passage all collide; their signatures bound the overlap inside the join,
so that only pairs that may be similar leave it.  Paragraphs whose cluster
spans several documents are joined to passages where they stand side by side;
passages of at least ``PASSAGE_WORDS`` words count, and all but the first
occurrence of each are removed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals.llm import common as C
from arrivals.llm.pitman_yor import word_hashes

SHINGLE, PERCENT = 5, 80
#: 12 bands of 3 rows: two lines of similarity 0.8 collide with probability
#: 1 - (1 - 0.8**3)**12 = 0.9998.
BANDS, ROWS = 12, 3
LINE_WORDS, SENTENCE_WORDS = 20, 5
PASSAGE_WORDS = 30
#: Bits of a line's signature.
SIGNATURE = 512
#: Words between two repeated paragraphs that still belong to one passage.
BRIDGE = 10
_SEEDS = C.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * C._PRIME)
_A, _B = _SEEDS[::2] | np.uint64(1), _SEEDS[1::2]
_LINE, _SENTENCE = 1, 2


class Units:
    """Lines and sentences of a text: word ranges and classes.

    A sentence ends after a word that ends in ``.``, ``!`` or ``?``, or at the
    end of a line.  A single capitalised word inside a sentence starts a new
    one, as where a passage is set into the middle of a sentence.
    """

    def __init__(self, text: str, hashes: np.ndarray | None = None):
        self.data = text.encode("utf-8", "surrogatepass")
        self.hash = word_hashes([text])[0] if hashes is None else hashes
        letters = np.append(np.frombuffer(self.data, np.uint8), np.uint8(0))
        self.start, self.end = C.word_spans(self.data)
        line = np.cumsum((letters == 10) | (letters == 13))[self.start]
        first_line = np.diff(line, prepend=-1) != 0
        first, second, last = letters[self.start], letters[self.start + 1], letters[self.end - 1]
        capital = (first >= 65) & (first <= 90) | (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        head = first_line.copy()
        head[1:] |= ((last == ord(".")) | (last == ord("!")) | (last == ord("?")))[:-1]
        inner = capital & ~head
        if inner.any():
            sentence = np.cumsum(head) - 1
            alone = np.bincount(sentence[inner], minlength=sentence[-1] + 1) == 1
            head |= inner & alone[sentence]
        self.lines, self.sentences = self._ranges(first_line, LINE_WORDS), self._ranges(head, SENTENCE_WORDS)

    @staticmethod
    def _ranges(first: np.ndarray, least: int) -> np.ndarray:
        at = np.flatnonzero(first)
        to = np.append(at[1:], len(first))
        keep = to - at >= least
        return np.column_stack((at[keep], to[keep]))

    def classes(self, kind: int) -> np.ndarray:
        ranges = self.lines if kind == _LINE else self.sentences
        return C.range_hashes(self.hash, ranges[:, 0], ranges[:, 1], kind)

    def places(self, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of word ranges in code points, the end exclusive."""
        letters = np.concatenate(([0], np.cumsum((np.frombuffer(self.data, np.uint8) & 0xC0) != 0x80)))
        return letters[self.start[ranges[:, 0]]], letters[self.end[ranges[:, 1] - 1]]

    def shingles(self, a: int, b: int) -> np.ndarray:
        return C.shingle_set(self.hash[a:b], SHINGLE)

    def bands(self, ranges: np.ndarray) -> np.ndarray:
        """Band keys of lines (rows: lines; columns: BANDS)."""
        if not len(ranges):
            return np.empty((0, BANDS), np.int64)
        every = C.windows(self.hash, SHINGLE)
        # Windows that start at a to z - SHINGLE; the gaps between lines are dropped.
        cuts = np.column_stack((ranges[:, 0], ranges[:, 1] - SHINGLE + 1)).ravel()
        cuts = cuts[:-1] if cuts[-1] >= len(every) else cuts
        least = np.empty((BANDS * ROWS, len(ranges)), np.uint64)
        for at in range(0, BANDS * ROWS, ROWS):  # a band at a time bounds memory
            rows = slice(at, at + ROWS)
            least[rows] = np.minimum.reduceat(every * _A[rows, None] + _B[rows, None], cuts, axis=1)[:, ::2]
        band = least.reshape(BANDS, ROWS, -1)
        keys = (band * C._FACTORS[:ROWS, None]).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)[:, None]
        return C.mix(keys).view(np.int64).T


def signature(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(SIGNATURE, np.uint8)
    bits[(shingles >> np.uint64(17)) % np.uint64(SIGNATURE)] = 1
    return np.packbits(bits).view(np.int64)


def repeated_paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, start, end, n_words, component_id, removed, text_hash): one
row per paragraph that belongs to a passage repeated across documents.

    Offsets are code points, the end exclusive.  ``removed`` is false for the
    first occurrence (by key, then place) of each cluster, true for the
    others.  ``component_id`` is the key of that first occurrence's document.
    Null and empty texts, and rows with a null key, have no rows; rows that
    repeat a key are one document, so they do not repeat one another
    (``text_hash``, xxhash64 of the text, tells their texts apart); other
    columns are ignored.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    rows = (docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
            .filter("k is not null and t is not null").withColumn("row", F.xxhash64("t")))

    def index(batches):
        seen: set[int] = set()
        for b in batches:
            out = []
            for k, row, t, hashes in zip(b["k"], b["row"], b["t"], word_hashes(b["t"].tolist())):
                u = Units(t, hashes)
                lines = u.classes(_LINE)
                fresh = np.array([c not in seen for c in lines.tolist()], bool)
                if len(seen) > 500_000:
                    seen.clear()
                seen.update(lines.tolist())
                ranges = np.concatenate((u.lines, u.sentences))
                start, end = u.places(ranges)
                out.append((k, row, np.concatenate((lines, u.classes(_SENTENCE))), ranges[:, 0], ranges[:, 1], start,
                            end, lines[fresh], u.bands(u.lines[fresh]).ravel()))
            yield pd.DataFrame(out, columns=["k", "row", "every", "a", "z", "start", "end", "fresh", "bands"])

    indexed = C.stored(rows.mapInPandas(
        index, "k long, row long, every array<long>, a array<int>, z array<int>, start array<int>, end array<int>, "
               "fresh array<long>, bands array<long>"), "paragraphs")
    # Classes in two documents or more; partial aggregates make a hot one small.
    copied = C.stored(indexed.select("k", F.explode("every").alias("cls")).groupBy("cls")
                      .agg(F.min("k").alias("lo"), F.max("k").alias("hi")).filter("lo < hi").select("cls"),
                      "paragraph-copies")
    senders = indexed.filter(F.size("fresh") > 0)
    shared = C.bit_filter(C.met_twice(senders.select(F.explode("bands").alias("key"))), "key")

    def spread(batches):
        for b in batches:
            ids, keys = (np.concatenate([*b[c], np.empty(0, np.int64)]).astype(np.int64) for c in b)
            keep = C.in_filter(shared.value, keys)
            yield pd.DataFrame({"key": keys[keep], "id": np.repeat(ids, BANDS)[keep]})

    banded = C.stored(senders.select("fresh", "bands").mapInPandas(spread, "key long, id long").distinct(),
                      "paragraph-bands")
    # Only ids that share a key with another id need their shingles, sizes and signatures.
    met = banded.join(banded.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                       .filter("lo < hi").select("key"), "key", "left_semi")
    wanted = C.bit_filter(met.select("id"), "id")

    def having(batches):
        for b in batches:
            yield b.loc[[bool(C.in_filter(wanted.value, x).any()) for x in b["fresh"]], ["row"]]

    texts = C.bit_filter(senders.select("row", "fresh").mapInPandas(having, "row long"), "row")

    def arrays(batches):
        seen: set[int] = set()
        for b in batches:
            out = []
            own = b["t"][C.in_filter(texts.value, b["row"].to_numpy(np.int64))].tolist()
            for u in map(Units, own, word_hashes(own)):
                classes = u.classes(_LINE)
                for i in np.flatnonzero(C.in_filter(wanted.value, classes)):
                    c = int(classes[i])
                    if c not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(c)
                        items = u.shingles(*u.lines[i])
                        out.append((c, len(items), signature(items), items.tobytes()))
            # Object columns even where nothing is kept: Arrow takes no empty column of doubles for lists.
            yield pd.DataFrame(out, columns=["id", "size", "bits", "items"], dtype=object).astype(
                {"id": "int64", "size": "int64"})

    sets = C.stored(rows.select("row", "t").mapInPandas(
        arrays, "id long, size long, bits array<long>, items binary").dropDuplicates(["id"]), "paragraph-sets")
    members = banded.join(sets.select("id", "size", F.col("size").alias("rest")), "id")

    def alike(batches):
        for b in batches:
            keep = []
            for x, y in zip(b["x"], b["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield b.loc[np.array(keep, bool), ["a", "b"]]

    def verify(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
                .join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b"))
        return C.few_tasks(both, pairs.count(), 20_000).mapInPandas(alike, "a long, b long")

    labels = C.link_groups(members, verify, "paragraph-links", sets.select("id", "bits"))
    flagged = C.stored(copied.select(F.col("cls").alias("id")).join(labels, "id", "full_outer")
                       .select("id", F.coalesce("label", "id").alias("label")), "paragraph-classes")
    repeated = C.bit_filter(flagged.select("id"), "id")

    def find(batches):
        for b in batches:
            sizes = b["every"].map(len).to_numpy(np.int64)
            flat = {c: np.concatenate([*b[c], np.empty(0, np.int64)]).astype(np.int64)
                    for c in ("every", "a", "z", "start", "end")}
            keep = C.in_filter(repeated.value, flat["every"])
            yield pd.DataFrame({**{c: np.repeat(b[c].to_numpy(np.int64), sizes)[keep] for c in ("k", "row")},
                                **{c: v[keep] for c, v in flat.items()}}).rename(columns={"every": "id"})

    places = (indexed.select("k", "row", "every", "a", "z", "start", "end")
              .mapInPandas(find, "k long, row long, id long, a long, z long, start long, end long")
              .distinct().join(flagged, "id").drop("id"))
    places = C.stored(places, "paragraph-places")
    clusters = (places.groupBy("label").agg(F.min(F.struct("k", "a")).alias("first"), F.max("k").alias("hi"))
                .filter("first.k < hi").select("label", "first"))
    own = places.join(clusters, "label")
    # Passages: repeated paragraphs of a document that follow one another.
    by = Window.partitionBy("k", "row").orderBy("a", "z", "label")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    own = (own.withColumn("reach", F.coalesce(F.max("z").over(before), F.lit(-1 - BRIDGE)))
           .withColumn("run", F.sum((F.col("a") > F.col("reach") + BRIDGE).cast("long")).over(by))
           .withColumn("new", F.greatest(F.col("z") - F.greatest("a", "reach"), F.lit(0)))
           .withColumn("words", F.sum("new").over(Window.partitionBy("k", "row", "run")))
           .filter(F.col("words") >= PASSAGE_WORDS))
    return own.select(F.col("k").alias(key), "start", "end", (F.col("z") - F.col("a")).alias("n_words"),
                      F.col("first.k").alias("component_id"),
                      (~((F.col("k") == F.col("first.k")) & (F.col("a") == F.col("first.a")))).alias("removed"),
                      F.col("row").alias("text_hash"))


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the removed paragraphs; columns and rows stay.  What is
    left of a text keeps its own white space, less what stood at a cut's end."""
    found = repeated_paragraphs(docs, key, text).filter("removed")
    own, row, cuts = (C.fresh(x, docs.columns) for x in ("row_hash", "row", "cuts"))
    spans = C.stored(found.groupBy(F.xxhash64(key, "text_hash").alias(row))
                     .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(cuts)), "paragraph-cuts")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, own in zip(texts, spans):
            if t is None or own is None or not len(own):
                out.append(t)
                continue
            kept, at = [], 0
            for s in own:
                if s["start"] > at:
                    kept.append(t[at:s["start"]])
                at = max(at, s["end"])
            kept.append(t[at:])
            out.append("".join(k if i == 0 else k.lstrip(" ") for i, k in enumerate(kept)).strip("\n")
                       if kept else "")
        return pd.Series(out, dtype=object)

    # Only rows that may lose something are shuffled.
    body = F.col(text).cast("string")
    named = docs.withColumn(own, F.xxhash64(F.col(key).cast("long"), F.xxhash64(body)))
    some, others = C.split_by_filter(named, C.bit_filter(spans, row), own)
    changed = (some.join(spans, F.col(own) == F.col(row), "left")
               .withColumn(text, F.when(F.col(cuts).isNull(), F.col(text)).otherwise(cut(body, F.col(cuts)))))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return others.select(*columns).unionByName(changed.select(*columns))
