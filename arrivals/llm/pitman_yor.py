"""Operator 12, language-model scores by a hierarchical Pitman-Yor model.

Every word is the context of a restaurant whose dishes are the tokens that
follow it; all these restaurants share one parent, whose dishes are the tokens
themselves and whose own parent is uniform.  A table in a context's restaurant
is a customer of the parent.  Seatings are sampled by blocked Gibbs: given the
parent's probabilities and the number of tables of the restaurant, both as of
the round before, the number of tables of each dish is drawn from its exact
conditional, so dishes are independent and a hot context is no group of its
own.  Scores average the predictive probabilities of the sampled seatings.

Texts are stored once as chunks of word numbers.  A round is one exchange:
every chunk sends, for its distinct keys (pairs of words, or words), what it
adds, and gets back the corpus totals in the same order.  Draws depend on the
key and the round alone, so chunks that hold the same key draw the same.
"""

from __future__ import annotations

import math
import re
import uuid
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C
from arrivals.session import scratch_dir

#: Tokens of one chunk, about, and of one part of the keys.
CHUNK_TOKENS, PART_TOKENS = 1 << 19, 1 << 20
#: Bytes of text hashed together, about, and where a long text may be cut.
CALL_BYTES, _GAP = 1 << 18, re.compile(rb"[ \t-\r]")
#: Sampled seatings whose probabilities are averaged, and the strength of all restaurants.
SAMPLES, STRENGTH = 2, 1.0
#: Customers of a dish whose number of tables is drawn in one block; those
#: beyond are seated in steps of an eighth of an octave.
BLOCK = 256
#: The two tokens that are no words: what stands before a text, and its end.
BEGIN, END = np.uint64(1 << 62), np.uint64((1 << 62) + 1)
#: Kinds of keys.
_PAIRS, _WORDS = 0, 1
_CHUNKS = "chunk long, k array<string>, lens binary, train binary, words binary, seq binary, n_tokens long"
_ASKS = "kind int, part long, chunk long, keys binary, added binary"
_REPLIES = "round int, kind int, part long, chunk long, totals binary, s0 long, s1 long, s2 long, s3 long"


# ---- seating ---------------------------------------------------------------

_tables: dict[float, np.ndarray] = {}


def log_seatings(discount: float) -> np.ndarray:
    """[c, t]: log of the summed weight of all seatings of c customers at t
    tables, a table of n weighing (1-d)(2-d)...(n-1-d)."""
    if discount not in _tables:
        out = np.full((BLOCK + 1, BLOCK + 1), -np.inf)
        out[0, 0] = 0.0
        for c in range(BLOCK):
            t = np.arange(BLOCK + 1)
            with np.errstate(divide="ignore"):
                joins = out[c] + np.log(np.maximum(c - t * discount, 0.0))
            opens = np.concatenate(([-np.inf], out[c, :-1]))
            out[c + 1] = np.logaddexp(joins, opens)
        _tables[discount] = out
    return _tables[discount]


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each key; the same everywhere."""
    h = C.mix(keys ^ C.mix(np.full(1, salt + 1, np.uint64) * C._PRIME))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def draw_tables(customers: np.ndarray, opening: np.ndarray, discount: float, keys: np.ndarray,
                salt: int) -> np.ndarray:
    """The number of tables of each dish, drawn from P(t) ~ opening**t * S(c, t).

    ``opening`` is the weight of a new table, (strength + discount * tables of
    the restaurant) * the parent's probability.  Dishes of more than ``BLOCK``
    customers seat the others after the block: in each step the number of new
    tables is Poisson with the step's expected openings.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    weights = log_seatings(discount)
    chance = uniform(keys, 1000 * salt)
    block = np.minimum(customers, BLOCK)
    many = np.flatnonzero(customers > 1)
    many = many[np.argsort(block[many], kind="stable")]
    sizes, starts = np.unique(block[many], return_index=True)
    for c, at, to in zip(sizes.tolist(), starts, [*starts[1:], len(many)]):
        for i in range(at, to, max(1, (1 << 18) // c)):  # bounds the matrix
            own = many[i:min(to, i + max(1, (1 << 18) // c))]
            t = np.arange(1, c + 1)
            w = np.log(opening[own])[:, None] * t + weights[c, 1:c + 1]
            w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), axis=1)
            tables[own] = 1 + (w < (chance[own] * w[:, -1])[:, None]).sum(1)
    seated = np.full(len(customers), float(BLOCK))
    step = 0
    late = np.flatnonzero(customers > BLOCK)
    while len(late):
        step += 1
        to = np.minimum(np.ceil(seated[late] * 2 ** 0.125), customers[late])
        base = opening[late] - discount * tables[late]
        mean = opening[late] * np.log((to + base) / (seated[late] + base))
        new = _poisson(mean, uniform(keys[late], 1000 * salt + step))
        tables[late] += np.minimum(new, to - seated[late]).astype(np.int64)
        seated[late] = to
        late = late[to < customers[late]]
    return tables


def _poisson(mean: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Poisson numbers by inversion; by a normal approximation above a mean of 40."""
    out = np.zeros(len(mean))
    small = mean < 40
    p = np.exp(-np.where(small, mean, 0.0))
    total = p.copy()
    n = 0
    while (more := small & (chance > total)).any() and n < 400:
        n += 1
        p = p * mean / n
        out[more] = n
        total = total + np.where(small, p, 0.0)
    big = np.flatnonzero(~small)
    if len(big):
        z = np.array(list(map(NormalDist().inv_cdf, chance[big].tolist())))
        out[big] = np.maximum(0, np.round(mean[big] + np.sqrt(mean[big]) * z))
    return out


class Parent:
    """The parent restaurant's predictive probabilities in one round."""

    def __init__(self, discount: float, customers: int, tables: int, types: int):
        self.discount, self.scale = discount, STRENGTH + customers
        self.rest = (STRENGTH + discount * tables) / self.scale / (types + 1)

    def __call__(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return np.maximum(customers - self.discount * tables, 0.0) / self.scale + self.rest


def predictive(count, tables, context_count, context_tables, parent, discount: float):
    """p(token | context): its customers less their discounts, and what these
    and the strength leave to the parent."""
    return (np.maximum(count - discount * tables, 0.0)
            + (STRENGTH + discount * context_tables) * parent) / (STRENGTH + context_count)


def discount_of(once: int, twice: int) -> float:
    """The discount that the numbers of keys seen once and twice suggest."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


# ---- chunks ------------------------------------------------------------------

class Chunk:
    """The tokens of some texts, the distinct pairs and words among them."""

    def __init__(self, row):
        self.lens = np.frombuffer(row.lens, "<u4").astype(np.int64)
        self.train = np.frombuffer(row.train, np.uint8).astype(bool)
        self.words = np.frombuffer(row.words, "<u8")
        self.w = C.from_planes(row.seq, "<u4").astype(np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.u = np.concatenate((self.w[:1], self.w[:-1]))
        self.u[self.starts] = 0
        pair = C.mix(C.mix(self.words * C._FACTORS[0])[self.u] + self.words[self.w] * C._FACTORS[1])
        #: Sorted distinct pairs, the words of each, and the pair of each token.
        by = np.argsort(pair)
        pair = pair[by]
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        self.pairs, self.pair_of = pair[new], np.empty(len(pair), np.int64)
        self.pair_of[by] = np.cumsum(new) - 1
        self.pair_u, self.pair_w = self.u[by[new]], self.w[by[new]]
        self.order = np.argsort(self.words, kind="stable")  # of words, as they are sent

    def trained(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of pairs and of words (of BEGIN: texts)."""
        token = np.repeat(self.train, self.lens)
        words = np.bincount(self.w[token], minlength=len(self.words))
        words[0] = self.train.sum()
        return np.bincount(self.pair_of[token], minlength=len(self.pairs)), words


def _sent(kind: int, chunk: int, keys: np.ndarray, added: list[np.ndarray], bits: int):
    """Rows of one chunk: sorted keys and what it adds to each, by part."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for a, z in zip(cuts, [*cuts[1:], len(keys)]):
        yield (kind, int(part[a]), chunk, C.planes(np.diff(keys[a:z], prepend=np.uint64(0))),
               _packed(np.concatenate([x[a:z] for x in added])))


def _packed(x: np.ndarray) -> bytes:
    """Integers of at least 0 in as few bytes as their greatest takes, compressed."""
    size = max(1, 1 << ((int(x.max(initial=0)).bit_length() + 7) // 8 - 1).bit_length())
    return bytes((size,)) + zstandard.compress(C.planes(x.astype(f"<u{size}")), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return C.from_planes(zstandard.decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


class Replies:
    """What a chunk has got back: one array of totals by round and kind."""

    def __init__(self, rows):
        by: dict[tuple[int, int], list] = {}
        for r in rows:
            by.setdefault((r["round"], r["kind"]), []).append((r["part"], r["totals"]))
        self.by = {k: [_unpacked(bytes(b)) for _, b in sorted(v, key=lambda x: x[0])]
                   for k, v in by.items()}

    def get(self, at: int, kind: int, width: int) -> list[np.ndarray]:
        parts = [x.reshape(width, -1) for x in self.by.get((at, kind), [])]
        return list(np.concatenate(parts, axis=1)) if parts else [np.empty(0, np.int64)] * width

    def words(self, at: int, chunk: Chunk, width: int) -> list[np.ndarray]:
        """Totals of words in the chunk's own numbering."""
        out = []
        for x in self.get(at, _WORDS, width):
            own = np.empty(len(x), np.int64)
            own[chunk.order] = x
            out.append(own)
        return out


class Model:
    """What the driver knows of all rounds: a few numbers each."""

    def __init__(self, tokens: int, types: int, discount: float):
        self.tokens, self.types, self.discount = tokens, types, discount
        self.parent_discount = 0.5
        self.parents: list[Parent] = []  # by round

    def seating(self, chunk: Chunk, replies: Replies, at: int, counts: np.ndarray) -> np.ndarray:
        """Tables of the chunk's pairs in round ``at``, drawn given the totals
        of the round before; at first every customer has a table of its own,
        and every dish one in the parent."""
        if at == 1:
            tables = replies.words(0, chunk, 1)[0]
            customers = tables.copy()
            customers[0] = 0  # BEGIN is no dish
            own = np.minimum(customers, 1)
        else:
            tables, customers, own = replies.words(at - 1, chunk, 3)
        parent = self.parents[at - 1](customers, own)
        opening = (STRENGTH + self.discount * tables[chunk.pair_u]) * parent[chunk.pair_w]
        return draw_tables(counts, opening, self.discount, chunk.pairs, at)


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """A 62-bit hash of each word of each text, A-Z lower-cased.  Texts are
    hashed together, long ones in pieces that end before white space."""
    pieces, of = [], []
    for i, t in enumerate(texts):
        data, at = (t or "").encode("utf-8", "surrogatepass"), 0
        while at < len(data) or not at:
            gap = _GAP.search(data, at + CALL_BYTES)
            to = gap.start() if gap else len(data)
            pieces.append(data[at:to])
            of.append(i)
            at = max(to, 1)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    first = size = 0
    for last, piece in enumerate(pieces):
        size += len(piece)
        if size >= CALL_BYTES or last == len(pieces) - 1:
            whole = b" ".join(pieces[first:last + 1])
            start, end = C.word_spans(whole)
            values = np.frombuffer(whole, np.uint8)
            values = (values + 32 * ((values >= 65) & (values <= 90))).astype(np.uint64)
            hashes = C.range_hashes(values, start, end).view(np.uint64) >> np.uint64(2)
            cuts = np.cumsum([len(p) + 1 for p in pieces[first:last]])
            for i, own in zip(of[first:last + 1], np.split(hashes, np.searchsorted(start, cuts))):
                out[i].append(own)
            first, size = last + 1, 0
    return [np.concatenate(own) for own in out]


def _chunks(batches):
    """Texts as word numbers, in chunks; numbers go by falling frequency."""
    from pyspark import TaskContext

    chunk = TaskContext.get().partitionId() << 32
    keys, train, hashes, n = [], [], [], 0

    def row():
        lens = np.array([len(h) + 1 for h in hashes], "<u4")
        ends = np.cumsum(lens.astype(np.int64)) - 1
        flat = np.full(int(lens.sum()), END, np.uint64)
        inside = np.ones(len(flat), bool)
        inside[ends] = False
        flat[inside] = np.concatenate(hashes)
        words, number, times = np.unique(flat, return_inverse=True, return_counts=True)
        by = np.argsort(-times, kind="stable")
        by = np.concatenate((by[words[by] == END], by[words[by] != END]))
        rank = np.empty(len(words), np.int64)
        rank[by] = np.arange(1, len(words) + 1)
        words = np.concatenate(([BEGIN], words[by])).astype("<u8")
        return pd.DataFrame([(chunk, keys, lens.tobytes(), np.array(train, np.uint8).tobytes(), words.tobytes(),
                              C.planes(rank[number].astype("<u4")), len(flat))],
                            columns=[c.split()[0] for c in _CHUNKS.split(", ")])

    for b in batches:
        for k, flag, h in zip(b["k"], b["f"], word_hashes(b["t"].tolist())):
            keys.append(k)
            train.append(bool(flag))
            hashes.append(h)
            n += len(h) + 1
            if n >= CHUNK_TOKENS:
                yield row()
                chunk, keys, train, hashes, n = chunk + 1, [], [], [], 0
    if keys:
        yield row()


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text",
          samples: int = SAMPLES) -> DataFrame:
    """(``key``, trained, n_tokens, n_known, train_tokens, base_score, score), one
    row per row of ``docs``.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one
    end.  The model learns from the rows where ``training`` holds (null: it
    does not) and scores all: ``score`` is the log10 probability of the whole
    text, ``base_score`` that of the smoothed frequencies of single tokens.
    ``n_known`` counts the tokens that occur in training.  Unknown tokens share
    one place beside the known ones in the uniform distribution.

    Null texts count as empty; empty texts have their end alone; without
    training rows every token is unknown; null keys stay; repeated rows are
    texts of their own; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    source = docs.select(F.col(key).cast("long").cast("string").alias("k"),
                         F.coalesce(training, F.lit(False)).alias("f"), F.col(text).cast("string").alias("t"))
    # Bucketed by chunk: the exchanges' replies come to the chunks, which stay where they are.
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"pitman_yor_{uuid.uuid4().hex}"
    (source.mapInPandas(_chunks, _CHUNKS).write.format("parquet").option("compression", "zstd")
     .bucketBy(buckets, "chunk").option("path", scratch_dir(spark, "pitman-yor-chunks")).saveAsTable(name))
    chunks = spark.table(name)
    C.small_batches(spark, 2)
    total = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / PART_TOKENS))))
    replies: list[DataFrame] = []

    def answered(rounds) -> DataFrame:
        """Chunks with what they have got back in ``rounds``."""
        if not rounds:
            return chunks.withColumn("replies", F.lit(None).cast("array<int>"))
        every = reduce(DataFrame.unionByName, [replies[r] for r in rounds])
        own = every.groupBy("chunk").agg(F.collect_list(F.struct("round", "kind", "part", "totals")).alias("replies"))
        return chunks.join(own, "chunk")

    def exchange(at: int, asked, settle) -> list[int]:
        """One round: ``asked`` gives a chunk's rows, ``settle`` a part's
        totals and four sums; returns the sums over all parts."""
        def ask(batches):
            for b in batches:
                for row in b.itertuples(index=False):
                    found = list(asked(row))
                    yield pd.DataFrame(found, columns=["kind", "part", "chunk", "keys", "added"])

        def settled(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("chunk", kind="stable")
            keys = [np.cumsum(C.from_planes(bytes(x), "<u8"), dtype=np.uint64) for x in rows["keys"]]
            added = [_unpacked(bytes(x)).reshape(-1, len(k)) for x, k in zip(rows["added"], keys)]
            ends = np.cumsum(list(map(len, keys)))
            distinct, first, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            sums = []
            for column in np.concatenate(added, axis=1):
                s = np.zeros(len(distinct), np.int64)
                np.add.at(s, number, column)
                sums.append(s)
            back, scalars = settle(int(group[0]), distinct, sums)
            back = [x[number] for x in back]
            if int(group[0]) == _PAIRS:  # the first chunk that holds a pair speaks for it
                speaks = np.zeros(len(number), np.int64)
                speaks[first] = 1
                back.append(speaks)
            out = [(at, int(group[0]), int(group[1]), int(c),
                    _packed(np.concatenate([x[a:z] for x in back])), *(scalars if a == 0 else (0,) * 4))
                   for c, a, z in zip(rows["chunk"], [0, *ends[:-1]], ends)]
            return pd.DataFrame(out, columns=[c.split()[0] for c in _REPLIES.split(", ")])

        got = C.stored(answered(sorted({0, at - 1} if at else ())).mapInPandas(ask, _ASKS).groupBy("kind", "part").applyInPandas(settled, _REPLIES),
                       f"pitman-yor-round{at}")
        replies.append(got)
        sums = got.groupBy("kind").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(4)]).collect()
        by = {r["kind"]: [r[f"s{i}"] for i in range(4)] for r in sums}
        return [x for kind in (_PAIRS, _WORDS) for x in by.get(kind, [0] * 4)]

    # Round 0: counts of pairs and of words.
    def counts_asked(row):
        chunk = Chunk(row)
        pairs, words = chunk.trained()
        yield from _sent(_PAIRS, row.chunk, chunk.pairs, [pairs], bits)
        yield from _sent(_WORDS, row.chunk, chunk.words[chunk.order], [words[chunk.order]], bits)

    def counts_settled(kind, keys, sums):
        s = sums[0][keys != BEGIN]
        return sums, (int(s.sum()), int((s > 0).sum()), int((s == 1).sum()), int((s == 2).sum()))

    found = exchange(0, counts_asked, counts_settled)
    model = Model(found[4], found[5], discount_of(found[2], found[3]))

    def tables_asked(at: int):
        def asked(row):
            chunk, got = Chunk(row), Replies(row.replies)
            counts, speaks = got.get(0, _PAIRS, 2)
            tables = model.seating(chunk, got, at, np.where(speaks == 1, counts, 0))
            n = len(chunk.words)
            as_context = np.bincount(chunk.pair_u, tables, minlength=n).astype(np.int64)
            as_dish = np.bincount(chunk.pair_w, tables, minlength=n).astype(np.int64)
            yield from _sent(_WORDS, row.chunk, chunk.words[chunk.order],
                             [as_context[chunk.order], as_dish[chunk.order]], bits)
        return asked

    def tables_settled(at: int, parent_tables: int):
        opening = (STRENGTH + model.parent_discount * parent_tables) / (model.types + 1)

        def settled(kind, keys, sums):
            own = draw_tables(sums[1], np.full(len(keys), opening), model.parent_discount, keys, 100 + at)
            dish = sums[1]
            return [*sums, own], (int(dish.sum()), int(own.sum()), 0, 0)
        return settled

    model.parent_discount = discount_of(found[6], found[7])
    model.parents.append(Parent(model.parent_discount, model.tokens, model.types, model.types))
    parent_tables = model.types
    for at in range(1, samples + 1):
        found = exchange(at, tables_asked(at), tables_settled(at, parent_tables))[4:]
        parent_tables = found[1]
        model.parents.append(Parent(model.parent_discount, found[0], found[1], model.types))

    def scored(batches):
        for b in batches:
            for row in b.itertuples(index=False):
                chunk, got = Chunk(row), Replies(row.replies)
                counts, _ = got.get(0, _PAIRS, 2)
                seen = got.words(0, chunk, 1)[0]
                mean = np.zeros(len(chunk.pairs))
                for at in range(1, samples + 1):
                    context, customers, own = got.words(at, chunk, 3)
                    mean += predictive(counts, model.seating(chunk, got, at, counts), seen[chunk.pair_u],
                                       context[chunk.pair_u], model.parents[at](customers, own)[chunk.pair_w],
                                       model.discount) / samples
                known = seen > 0
                known[0] = False
                base = np.log10((np.where(known, seen, 0) + 0.1) / (model.tokens + 0.1 * (model.types + 1)))
                by_text = [np.add.reduceat(x, chunk.starts) for x in (
                    known[chunk.w].astype(np.int64), base[chunk.w], np.log10(mean)[chunk.pair_of])]
                yield pd.DataFrame({"k": list(row.k), "trained": chunk.train, "n_tokens": chunk.lens,
                                    "n_known": by_text[0], "train_tokens": model.tokens,
                                    "base_score": by_text[1], "score": by_text[2]})

    result = C.stored(answered(range(samples + 1)).mapInPandas(
        scored, "k string, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double"), "pitman-yor-scores") if total else spark.createDataFrame(
        [], "k string, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    return result.select(F.col("k").cast("long").alias(key), *[c for c in result.columns if c != "k"])
