"""Operator 11, alignment of two tokenizers' tokens over the same texts.

Both tokenise the whole text.  Where a token of each ends at the same byte and
the next token of each begins with a space, the two sequences have an anchor;
anchors cut them into short windows of token ids.  Words recur, so a worker
remembers the alignment of a window (its groups and links) by its ids.
Each text's distinct linked id pairs are kept once with their numbers; their
corpus-wide counts come from one aggregation, and the most frequent ones, a
bounded number, are looked up without a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C
from arrivals.llm.bpe import _byte_letters

#: Windows kept per worker and generation, and the tokens of one that is kept.
WINDOWS_KEPT, WINDOW_TOKENS = 200_000, 48
#: Id pairs, the most frequent ones, that are broadcast: 13 bytes each.
FREQUENT = 1 << 20
#: Pairs that a task counts before it passes them on.
COUNTED = 1 << 21
#: Code points encoded at once.
CALL_CHARS = 1 << 20
#: Fixed value: how byte-level BPE splits a text.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Texts that the fast encoder surely splits as the library does.
_PLAIN = re.compile("[\t\n\r\x20-\x7e -ſ‐-‧€]*")
_LONG, _LONG_GAP = 1000, re.compile(r"\s{1000}")
_HALF = re.compile(r"\s{500}|\S{500}")


def _is_plain(t: str) -> bool:
    if _PLAIN.fullmatch(t) is None:
        return False
    # A run of _LONG holds a half of it that starts at a multiple of that half; most texts have none.
    if all(_HALF.match(t, i) is None for i in range(0, len(t), _LONG // 2)):
        return True
    return _LONG_GAP.search(t) is None and max(map(len, t.split()), default=0) < _LONG


def _steps(x: np.ndarray) -> np.ndarray:
    """The first number, then each less the one before."""
    out = x.copy()
    out[1:] -= x[:-1]
    return out


def _numbers(ids: list[int]) -> np.ndarray:
    """Ids as unsigned 32-bit integers; an array reads a list faster than numpy does."""
    return np.frombuffer(array("I", ids), np.uint32).astype("<u4", copy=False)


#: The two parts of a window's alignment.
_GROUPS, _LINKS = itemgetter(0), itemgetter(1)


class ByteLevel:
    """Byte-level BPE from a tokenizers JSON file; special strings are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        bytes_of = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(map(bytes_of.__getitem__, t)): i for t, i in model["vocab"].items()
                 if all(c in bytes_of for c in t)}
        self.size = 1 + max(model["vocab"].values())
        self.bytes = [b""] * self.size
        for t, i in ranks.items():
            self.bytes[i] = t
        # The fast encoder merges by id, so ids must stand in the order of the merges.
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        single = sorted(i for t, i in ranks.items() if len(t) == 1)
        ordered = (len(single) == 256 and all(x < y for x, y in pairwise([single[-1], *made]))
                   and len(made) + 256 == len(ranks))
        self.fast = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks,
                                      special_tokens={}) if ordered else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.fast.encode_ordinary(t) if self.fast and _is_plain(t)
                else self.library.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """BPE pieces with byte fallback from a sentencepiece model, which puts a
    space before a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        self.bytes = [bytes((int(p[3:5], 16),)) if self.library.is_byte(i) else
                      b"" if self.library.is_control(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(map(self.library.id_to_piece, range(self.size)))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Aligner:
    """Two tokenizers, and the windows this worker has aligned."""

    _loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.shift = (self.b.size - 1).bit_length()
        small = self.shift + (self.a.size - 1).bit_length() <= 32
        self.kind = "<u4" if small else "<u8"
        self.sizes = [np.array(list(map(len, t.bytes)), np.int64) for t in (self.a, self.b)]
        self.spaced = [np.array([x.startswith(b" ") for x in t.bytes]) for t in (self.a, self.b)]
        #: (groups, links) of windows by their ids, as bytes.
        self.windows = C.Recent(WINDOWS_KEPT)
        # Each id as text and what follows it: in its group; at its end; for B at a window's end.
        self.pieces = [f"{i}{mark}" for t, marks in ((self.a, ",|"), (self.b, ",;\n"))
                       for i in range(t.size) for mark in marks]

    @classmethod
    def load(cls, path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in cls._loaded:
            cls._loaded[path_a, path_b] = cls(path_a, path_b)
        return cls._loaded[path_a, path_b]

    def solve(self, windows: list[bytes]) -> list[tuple[str, bytes]]:
        """Groups, as text, and links of windows; all are aligned at once, end to end."""
        ids = np.frombuffer(b"".join(windows), "<u4")
        ends = np.cumsum(list(map(len, windows))) // 4
        of_b = ids >= self.a.size
        a, b = ids[~of_b], ids[of_b] - np.uint32(self.a.size)
        last_b = np.cumsum(of_b)[ends - 1] - 1
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.union1d(end_a, end_b)  # each stretch between ends is one link
        links = (a[np.searchsorted(end_a, ends)].astype(self.kind) << self.shift) | b[np.searchsorted(end_b, ends)]
        cuts = np.searchsorted(ends, end_b[last_b], "right").tolist()
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        mark_a, mark_b = shared[group_a] == end_a, (shared[group_b] == end_b).astype(np.int64)
        mark_b[last_b] = 2
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        piece = np.concatenate((2 * a.astype(np.int64) + mark_a, 2 * self.a.size + 3 * b.astype(np.int64) + mark_b))
        groups = "".join(map(self.pieces.__getitem__, piece[order].tolist())).split("\n")
        data, size = links.tobytes(), links.itemsize
        return [(g, data[size * i:size * j]) for g, i, j in zip(groups, [0, *cuts], cuts)]

    def cut(self, data: bytes, a: list[int], b: list[int]) -> list[bytes] | None:
        """The windows of a text's ids: those of A, then those of B, which count
        on after A's.  None where the ids do not spell ``data``."""
        if not a or not b or any(b"".join(map(t.bytes.__getitem__, ids)) != data for t, ids in ((self.a, a), (self.b, b))):
            return None
        a, b = _numbers(a), _numbers(b)
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        at = np.searchsorted(end_b, end_a)
        i = np.flatnonzero(end_b[at] == end_a)[:-1]  # verified shared ends, less the last
        j = at[i]
        anchor = self.spaced[0][a[i + 1]] & self.spaced[1][b[j + 1]]
        i, j = i[anchor] + 1, j[anchor] + 1
        # A's ids of a window stand after B's of all windows before it, and the other way round.
        ids = np.empty(len(a) + len(b), "<u4")
        starts_a, starts_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        starts_a[i], starts_b[j] = _steps(j), _steps(np.append(i, len(a)))[1:]
        starts_b[0] = i[0] if len(i) else len(a)
        ids[np.arange(len(a)) + np.cumsum(starts_a)] = a
        ids[np.arange(len(b)) + np.cumsum(starts_b)] = b + np.uint32(self.a.size)
        whole, cuts = ids.tobytes(), (4 * (i + j)).tolist()
        return [whole[p:q] for p, q in zip([0, *cuts], [*cuts, len(whole)])]

    def texts(self, texts: list[str | None]):
        """For each text None, or (number of ids of A, of B, groups, links)."""
        whole = [t for t in texts if t]
        coded = iter(zip(whole, self.a.encode([" " + t for t in whole]), self.b.encode(whole)))
        found: list = []
        for t in texts:
            if not t:
                found.append(None)
                continue
            t, a, b = next(coded)
            cuts = self.cut((" " + t).encode("utf-8", "surrogatepass"), a, b)
            found.append(cuts and (len(a), len(b), cuts))
        new = self.windows.absent(set().union(*[f[2] for f in found if f]))
        if new:
            self.windows.update(zip(new, self.solve(new)))
        for f in found:
            if f is None:
                yield None
                continue
            own = [*map(self.windows.__getitem__, f[2])]
            yield f[0], f[1], ";".join(map(_GROUPS, own)), np.frombuffer(b"".join(map(_LINKS, own)), self.kind)
        for w in new:  # long ones are not kept
            if len(w) > 4 * WINDOW_TOKENS:
                del self.windows[w]


def _pairs(frame: pd.DataFrame, kind: str) -> list[np.ndarray]:
    return [np.cumsum(C.from_planes(p, kind), dtype=kind) for p in frame["pairs"]]


_TEXTS = ("k string, row long, n_a long, n_b long, n_groups long, n_links long, groups string, "
          "pairs binary, times binary")


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
          digest: bool = False) -> DataFrame:
    """(``key``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), one
    row per row of ``docs``.

    ``path_a``: a byte-level BPE vocabulary, which encodes a space and the
    text; ``path_b``: a sentencepiece model, which adds that space itself.
    ``groups``: the ids between shared ends as ``a1,a2|b1;a3|b2,b3``; with
    ``digest`` only their SHA-256, to save the space of the strings.  Links
    are the pairs of tokens that share a byte.  A pair of ids counts the rows
    of ``docs`` that hold it; ``n_best`` are the links whose count is the
    highest of their A id, ``count_sum`` the sum of the counts of all links.

    Null and empty texts, and texts whose joined token bytes are not the
    space and the text (such as one with U+2581), have no tokens: zeros and
    an empty string.  Null keys stay; rows that repeat are texts of their own;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    source = docs.select(F.col(key).cast("long").cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    sizes = Aligner.load(path_a, path_b)
    kind, shift = sizes.kind, sizes.shift

    def calls(texts: list):
        """Runs of texts of bounded length together."""
        at = chars = 0
        for i, t in enumerate(texts):
            chars += len(t or "")
            if chars >= CALL_CHARS or i == len(texts) - 1:
                yield texts[at:i + 1]
                at, chars = i + 1, 0

    def tokenise(batches):
        from pyspark import TaskContext

        own = Aligner.load(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            keys = iter(b["k"])
            for texts in calls(b["t"].tolist()):
                for found in own.texts(texts):
                    k, row = next(keys), row + 1
                    if found is None:
                        out.append((k, row, 0, 0, 0, 0, "", b"", b""))
                        continue
                    n_a, n_b, groups, links = found
                    pairs, times = np.unique(links, return_counts=True)
                    out.append((k, row, n_a, n_b, groups.count(";") + 1, len(links),
                                hashlib.sha256(groups.encode()).hexdigest() if digest else groups,
                                C.planes(_steps(pairs)), C.planes(times.astype("<u4"))))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _TEXTS.split(", ")])

    texts = C.stored(source.mapInPandas(tokenise, _TEXTS), "alignment-texts")

    def counted(batches):
        waiting, n = [], 0

        def frame():
            pairs, times = np.unique(np.concatenate([*waiting, np.empty(0, kind)]), return_counts=True)
            return pd.DataFrame({"pair": pairs.astype(np.int64), "n": times})

        for b in batches:
            own = _pairs(b, kind)
            waiting += own
            n += sum(map(len, own))
            if n >= COUNTED:
                yield frame()
                waiting, n = [], 0
        yield frame()

    counts = (texts.select("pairs").mapInPandas(counted, "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")))
    counts = C.stored(counts, "alignment-counts")
    own_a = F.shiftright("pair", shift)
    most = counts.groupBy(own_a.alias("a")).agg(F.max("n").alias("most"))  # one row per id of A
    judged = C.stored(counts.join(F.broadcast(most), own_a == F.col("a"))
                      .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-judged")
    # The least count of the frequent pairs: from a histogram of at most 16 steps a doubling.
    step = F.floor(F.log2("n") * 16).cast("int")
    total, least = 0, 0
    for r in judged.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("n")) \
            .orderBy(F.desc("step")).collect():
        total += r["pairs"]
        if total > FREQUENT:
            break
        least = r["n"]
    all_frequent = total <= FREQUENT

    def packed(batches):
        for b in batches:
            yield pd.DataFrame({c: [b[c].to_numpy(t).tobytes()] for c, t in
                                (("pair", np.int64), ("n", np.int64), ("best", np.bool_))})

    frequent = [r for r in judged.filter(F.col("n") >= least).mapInPandas(
        packed, "pair binary, n binary, best binary").collect()] if total else []
    table = [np.frombuffer(b"".join(bytes(r[c]) for r in frequent), t)
             for c, t in (("pair", np.int64), ("n", np.int64), ("best", np.bool_))]
    order = np.argsort(table[0])
    table = spark.sparkContext.broadcast([table[0][order].astype(kind), table[1][order], table[2][order]])

    def looked_up(b: pd.DataFrame):
        """Rows, pairs and numbers of a batch, flat, and what is known of them."""
        pairs = _pairs(b, kind)
        row = np.repeat(np.arange(len(b)), list(map(len, pairs)))
        pairs = np.concatenate([*pairs, np.empty(0, kind)])
        times = np.concatenate([*(C.from_planes(t, "<u4") for t in b["times"]), np.empty(0, "<u4")]).astype(np.int64)
        keys, n, best = table.value
        at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
        known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
        return row, pairs, times, known, at, n, best

    def summed(batches):
        for b in batches:
            row, _, times, known, at, n, best = looked_up(b)
            row, times, at = row[known], times[known], at[known]
            sums = np.zeros(len(b), np.int64)
            np.add.at(sums, row, times * n[at])
            bests = np.zeros(len(b), np.int64)
            np.add.at(bests, row, times * best[at])
            yield b.drop(columns=["pairs", "times"]).assign(n_best=bests, count_sum=sums)

    columns = [c for c in texts.columns if c not in ("pairs", "times")]
    result = texts.mapInPandas(summed, ", ".join(_TEXTS.split(", ")[:7]) + ", n_best long, count_sum long")
    if not all_frequent:
        def rare(batches):
            for b in batches:
                row, pairs, times, known, *_ = looked_up(b)
                yield pd.DataFrame({"row": b["row"].to_numpy(np.int64)[row][~known],
                                    "pair": pairs[~known].astype(np.int64), "times": times[~known]})

        rest = (texts.select("row", "pairs", "times").mapInPandas(rare, "row long, pair long, times long")
                .join(judged.filter(F.col("n") < least if least else F.lit(True)), "pair").groupBy("row")
                .agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"),
                     F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
        result = result.join(rest, "row", "left").select(
            *columns, *[(F.col(x) + F.coalesce(y, F.lit(0))).alias(x)
                        for x, y in (("n_best", "more_best"), ("count_sum", "more_sum"))])
    return result.select(F.col("k").cast("long").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best",
                         "count_sum", "groups")
