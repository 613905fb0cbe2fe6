"""Operator 1, language identification by rank-order n-gram profiles.

A profile lists a language's most frequent 1- to 3-grams of letters (words
are bounded by one space).  A text gets the language whose profile has the
least out-of-place distance: the sum over the text's most frequent n-grams of
how far each is from its rank there, at most the profile's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivals.llm import common as C

GRAMS = 3
PROFILE = 400
UNKNOWN = "und"
#: Profiles are learned from about this many texts of each language at most.
LEARN_ROWS = 4000
CHUNK_CHARS = 1 << 20
_SPLIT_BUCKETS = 64
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def grams_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (21 bits a letter, so exact) and their counts."""
    found: tuple[np.ndarray, np.ndarray] | None = None
    at = 0
    while at < len(text):
        to = text.find(" ", at + CHUNK_CHARS)
        to = len(text) if to < 0 else to
        code = np.frombuffer(text[at:to].lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        at = to
        letter = _is_letter()[code]
        if not letter.any():
            continue
        code = np.concatenate(([32], np.where(letter, code, 32), [32]))
        code = code[(code != 32) | np.concatenate(([True], code[:-1] != 32))]
        grams, run = [code[code != 32]], code
        for n in range(1, GRAMS):
            run = (run[:-1] << 21) | code[n:]
            # A space only at either end: no n-gram reaches from word to word.
            grams.append(run[code[1:-1] != 32] if n == 2 else run)
        part = np.unique(np.concatenate(grams), return_counts=True)
        found = part if found is None else _added([found, part])
    return found or (np.empty(0, np.int64), np.empty(0, np.int64))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


def ranked(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams in order, ties by n-gram."""
    if len(counts) > PROFILE:
        least = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:PROFILE]]


@dataclass
class Profiles:
    """Per language: the profile's n-grams in sorted order, and their ranks."""

    languages: list[str]
    grams: list[np.ndarray]
    ranks: list[np.ndarray]

    def identify(self, text: str | None) -> tuple[str, float]:
        order = ranked(*grams_of(text)) if text else np.empty(0, np.int64)
        if len(order) == 0 or not self.languages:
            return UNKNOWN, 0.0
        own = np.arange(len(order))
        far = []
        for grams, ranks in zip(self.grams, self.ranks):
            at = np.minimum(np.searchsorted(grams, order), len(grams) - 1)
            off = np.where(grams[at] == order, np.minimum(np.abs(ranks[at] - own), PROFILE), PROFILE)
            far.append(int(off.sum()))
        by = np.argsort(far, kind="stable")
        best, second = far[by[0]], far[by[1]] if len(by) > 1 else PROFILE * len(order)
        return self.languages[by[0]], (second / (best + second) if best + second else 1.0)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          rows: int = LEARN_ROWS) -> Profiles:
    """Profiles from a sample, by a hash of the key, of about ``rows`` texts of
    each language (all, where there are fewer).  Rows with a null language or
    text teach nothing."""
    C.small_batches(docs.sparkSession)
    source = (docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t"),
                          F.col(lang).cast("string").alias("l")).filter("l is not null and t is not null"))
    # One number per language, like the profiles themselves.
    sizes = {r["l"]: r["n"] for r in source.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Profiles([], [], [])
    part = F.create_map(*[F.lit(x) for l, n in sizes.items() for x in (l, max(1, n // rows))])[F.col("l")]
    sample = source.filter(F.pmod(F.xxhash64("k"), part) == 0)

    def count(batches):
        held: dict[str, list] = {}

        def rows_of(l):
            grams, n = _added(held[l])
            return pd.DataFrame({"l": l, "gram": grams, "n": n})

        for b in batches:
            for t, l in zip(b["t"], b["l"]):
                held.setdefault(l, []).append(grams_of(t))
            for l, parts in held.items():
                if len(parts) > 64:
                    held[l] = [_added(parts)]
            if sum(len(p[0][0]) for p in held.values()) > 2_000_000:
                yield from map(rows_of, held)
                held.clear()
        yield from map(rows_of, held)

    counts = sample.mapInPandas(count, "l string, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n"))
    # Top of each hash bucket first: no task holds all n-grams of a language.
    order = [F.desc("n"), F.asc("gram")]
    bucket = F.pmod(F.xxhash64("gram"), F.lit(_SPLIT_BUCKETS)).alias("b")
    top = counts.select("*", bucket)
    for by in (["l", "b"], ["l"]):
        top = (top.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
               .filter(F.col("rank") <= PROFILE))
    found = top.select("l", "gram", "rank").toPandas()  # PROFILE rows per language
    profiles = Profiles([], [], [])
    for l, own in sorted(found.groupby("l")):
        own = own.sort_values("gram")
        profiles.languages.append(l)
        profiles.grams.append(own["gram"].to_numpy(np.int64))
        profiles.ranks.append(own["rank"].to_numpy(np.int64) - 1)
    return profiles


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves ``remainder``; a null key: false."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def identify(docs: DataFrame, profiles: Profiles, text: str = "text",
             lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of every whole text and a score from 0 to 1:
    the second-best distance over the sum of the best two.  Texts that are null
    or have no letter are ``und`` with score 0, as is everything when nothing
    was learned.  Ties go to the first language by name.  Other columns pass
    unchanged; input columns of the two names are replaced."""
    C.small_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang string, score double")
    def apply(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([known.value.identify(t) for t in batch], columns=["lang", "score"])

    both = C.fresh("identified", docs.columns)
    return (docs.withColumn(both, apply(F.col(text).cast("string")))
            .withColumns({lang_pred: F.col(f"{both}.lang"), score: F.col(f"{both}.score")}).drop(both))
