"""Operator 4, a counterfactual-regularised toxicity classifier.

A logistic model over the words of a text.  For labelled texts that name an
identity group, a copy with the identity terms swapped is made; besides the
usual loss, the squared change of the score between the two is penalised, so
that naming a group does not itself raise the score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C
from arrivals.llm.language_id import held_out

#: Labelled rows that are learned from, at most; chosen by a hash of the key.
LEARN_ROWS = 20_000
WORDS = 4000
MIN_DOCS = 4
RIDGE, SWAP_PENALTY, ROUNDS, RATE = 2e-5, 2.0, 500, 0.2
CHUNK_CHARS = 1 << 20
#: Groups of terms that stand for one another in a neutral mention.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("woman", "man"), ("women", "men"), ("female", "male"),
    ("immigrant", "native", "refugee"), ("disabled", "deaf", "blind"),
)
_WORD = re.compile(r"[^\W\d_]+")


def swaps(groups=IDENTITY_TERMS) -> dict[str, str]:
    return {term: own[(i + 1) % len(own)] for own in groups for i, term in enumerate(own)}


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words of the whole text."""
    found: set[str] = set()
    at = 0
    while text and at < len(text):
        to = text.find(" ", at + CHUNK_CHARS)
        to = len(text) if to < 0 else to
        found.update(_WORD.findall(text[at:to].lower()))
        at = to
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        known = words_of(text).intersection(self.weights)
        z = self.bias + sum(map(self.weights.__getitem__, sorted(known)))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(features: list[list[int]], swapped: list[list[int] | None], labels: np.ndarray, width: int,
        penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent with momentum on the mean log loss,
    the ridge, and ``penalty`` times the mean squared score change on swaps."""
    def flat(lists):
        return (np.repeat(np.arange(len(lists)), [len(x) for x in lists]),
                np.array([i for x in lists for i in x], np.int64))

    row, col = flat(features)
    pairs = [i for i, s in enumerate(swapped) if s is not None]
    prow, pcol = flat([features[i] for i in pairs])
    srow, scol = flat([swapped[i] for i in pairs])
    n, m = max(1, len(labels)), max(1, len(pairs))
    w = np.zeros(width)
    bias = float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    speed, bias_speed = np.zeros(width), 0.0
    scale = 1 / np.sqrt(np.bincount(col, minlength=width) / n + 1e-3)  # rare words learn as fast

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for _ in range(ROUNDS):
        p = sigmoid(bias + np.bincount(row, w[col], len(labels)))
        off = (p - labels) / n
        grad = np.bincount(col, off[row], width) + RIDGE * w
        slope = float(off.sum())
        if pairs:
            a = sigmoid(bias + np.bincount(prow, w[pcol], len(pairs)))
            b = sigmoid(bias + np.bincount(srow, w[scol], len(pairs)))
            change = 2 * penalty * (a - b) / m
            da, db = change * a * (1 - a), change * b * (1 - b)
            grad += np.bincount(pcol, da[prow], width) - np.bincount(scol, db[srow], width)
            slope += float((da - db).sum())
        speed = 0.9 * speed - RATE * scale * grad * 5
        bias_speed = 0.9 * bias_speed - RATE * slope
        w, bias = w + speed, bias + bias_speed
    return w, bias


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          rows: int = LEARN_ROWS, groups=IDENTITY_TERMS) -> Model:
    """A model from at most ``rows`` labelled texts, the first by a hash of the
    key.  Rows with a null key or label teach nothing; of repeated labels the
    highest counts, of repeated texts each."""
    C.small_batches(docs.sparkSession)
    chosen = (labels.select(F.col(key).cast("long").alias("k"), F.col(label).cast("int").alias("y"))
              .filter("k is not null and y is not null").groupBy("k").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("k"), "k").limit(rows))  # at most `rows` ids: fit to broadcast
    source = (docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
              .join(F.broadcast(chosen), "k"))
    swap = swaps(groups)

    def split(batches):
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "words": pd.Series([sorted(words_of(t)) for t in b["t"]], dtype=object)})

    bags = C.stored(source.mapInPandas(split, "y int, words array<string>"), "toxicity-words")
    y = F.col("y") > 0
    n = bags.agg(F.count(F.lit(1)).alias("n"), F.count_if(y).alias("pos")).first()
    if not n["n"]:
        return Model({}, -5.0)
    seen = (bags.select(y.alias("y"), F.explode("words").alias("word")).groupBy("word")
            .agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
            .filter(F.col("pos") + F.col("neg") >= MIN_DOCS))
    rate = (F.log((F.col("pos") + 0.5) / (n["pos"] + 1.0)) - F.log((F.col("neg") + 0.5) / (n["n"] - n["pos"] + 1.0)))
    strength = F.abs(rate) * F.sqrt(F.least("pos", F.lit(1e9)) + F.least("neg", F.lit(1e9)))
    vocab = [r["word"] for r in seen.orderBy(F.desc(strength), "word").limit(WORDS).select("word").collect()]
    vocab = sorted({*vocab, *swap})
    index = {w: i for i, w in enumerate(vocab)}

    def indexed(batches):
        for b in batches:
            out = []
            for y, ws in zip(b["y"], b["words"]):
                ws = set(ws)
                other = {swap.get(w, w) for w in ws}
                out.append((int(y > 0), sorted(index[w] for w in ws if w in index),
                            sorted(index[w] for w in other if w in index) if other != ws else None))
            yield pd.DataFrame(out, columns=["y", "x", "s"])

    rows_ = bags.mapInPandas(indexed, "y int, x array<int>, s array<int>").collect()  # at most `rows`
    w, bias = fit([r["x"] for r in rows_], [r["s"] for r in rows_],
                  np.array([r["y"] for r in rows_], float), len(vocab))
    return Model({word: float(w[i]) for word, i in index.items() if abs(w[i]) > 1e-6}, float(bias))


def score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of every whole text; null and empty
    texts get the score of no words.  Other columns pass unchanged."""
    C.small_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def apply(batch: pd.Series) -> pd.Series:
        return pd.Series([known.value.score(t) for t in batch], dtype="float64")

    return docs.withColumn(score, apply(F.col(text).cast("string")))


__all__ = ["Model", "fit", "held_out", "learn", "score", "swaps", "words_of"]
