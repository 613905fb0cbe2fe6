"""Operator 7, bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows.  The end of a document goes
to the open window it fills best; when none has room the fullest one is
topped up with the document's next tokens and emitted.  What the tasks leave
open is merged in rounds of a fixed fan-in, and the very last window is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import math
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C
from arrivals.llm.bpe import RUNS_KEPT, Vocabulary, cut_ids

LENGTH = 4096
OPEN_WINDOWS = 16
#: The id that ends every document.
END_ID = 2
#: Tasks (or groups of tasks) whose open windows are merged together.
FAN_IN = 64
#: Code points from which a word is left to the vocabulary's own library.
LONG = 1000

_COLUMNS = ["k", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "part"]
#: Keys travel as text: pandas would turn longs with nulls into doubles.
_SCHEMA = ("k string, start long, length long, ids binary, doc_tokens long, "
           "sequence_id long, offset long, part long")


class Windows:
    """Open windows of one task; a piece is (key, start, ids, doc_tokens)."""

    def __init__(self, first_id: int, part: int, count: int):
        self.next_id, self.part, self.count = first_id, part, count
        self.open: list[list] = []  # [tokens used, pieces]
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple], closed: bool = True) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((key, start, n, ids, total, self.next_id if closed else None, offset,
                              None if closed else self.part))
            offset += n
        self.next_id += closed

    def add(self, key, start: int, ids: bytes, total: int) -> None:
        while len(ids) >= 4 * LENGTH:
            self._emit([(key, start, ids[:4 * LENGTH], total)])
            ids, start = ids[4 * LENGTH:], start + LENGTH
        while ids:
            n = len(ids) // 4
            fits = [w for w in self.open if w[0] + n <= LENGTH]
            if fits:
                window = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.count:
                window = [0, []]
                self.open.append(window)
            else:
                window = max(self.open, key=lambda w: w[0])
                n = LENGTH - window[0]
            window[0] += n
            window[1].append((key, start, ids[:4 * n], total))
            ids, start = ids[4 * n:], start + n
            if window[0] == LENGTH:
                self.open = [w for w in self.open if w is not window]
                self._emit(window[1])

    def leave_open(self) -> None:
        for _, pieces in self.open:
            self._emit(pieces, closed=False)

    def finish(self) -> None:
        """Everything left in windows of full length, then of powers of two."""
        pieces = [p for _, own in sorted(self.open, key=lambda w: -w[0]) for p in own]
        left = sum(len(p[2]) for p in pieces) // 4
        while left:
            room = size = min(LENGTH, 1 << (left.bit_length() - 1))
            taken = []
            while room:
                key, start, ids, total = pieces.pop(0)
                n = min(room, len(ids) // 4)
                taken.append((key, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    pieces.insert(0, (key, start + n, ids[4 * n:], total))
                room -= n
            self._emit(taken)
            left -= size

    def frame(self) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=_COLUMNS, dtype=object)
        self.rows = []
        return out.astype({c: "Int64" for c in _COLUMNS if c not in ("k", "ids")})


def _at_once(own: Vocabulary, words: list[str]) -> list[bytes]:
    """Ids of distinct words: one call for all, cut where a token ends a word."""
    fast = _fast(own)
    if fast is None or max(map(len, words)) >= LONG:
        ids = own.library.encode(" ".join(words), add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary("\n".join([*words, ""]))
    return cut_ids(ids, (np.flatnonzero(own.ends_word[ids]) + 1).tolist())


def _fast(own: Vocabulary):
    """A faster encoder with the same vocabulary, made once: a line feed, which no
    word holds, stands for the mark of a word's end.  It merges by id, so ids
    must stand in the order of the merges, after those of bytes with and without
    the mark; else None."""
    if not hasattr(own, "fast"):
        import tiktoken

        made = [i for _, i in sorted(own.read_merges().values())]
        single = {*own.first, *own.last}
        own.fast = None
        if own.end and len(single) == 512 and len(made) + 512 == len(own.ids) and all(
                x < y for x, y in pairwise([max(single), *made])):
            ranks = {}
            for t, i in own.ids.items():
                body = t.removesuffix(own.end)
                ranks[bytes(map(own.bytes_of.__getitem__, body)) + b"\n" * (body != t)] = i
            own.fast = tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})
    return own.fast


def _placed(batches, path: str, runs: int, forget: bool, part: int, count: int):
    """Pieces of one task's documents."""
    end = END_ID.to_bytes(4, "little")
    windows = Windows(part << 36, part, count)
    vocabulary = Vocabulary.load(path, _at_once, runs)
    try:
        for b in batches:
            for k, t in zip(b["k"], b["t"]):
                ids = vocabulary.encode(t) + end
                windows.add(k, 0, ids, len(ids) // 4)
            yield windows.frame()
    finally:
        if forget:
            vocabulary.forget()
    windows.leave_open()
    yield windows.frame()


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", runs: int = RUNS_KEPT,
         forget: bool = False) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``LENGTH`` ids.

    Returns (``key``, start, length, ids, doc_tokens, sequence_id, offset), one
    row per piece, ids as little-endian unsigned 32-bit integers.  Every id of
    every document lies in exactly one piece.  Null and empty texts have the
    end id alone; a null key stays null; repeated rows are packed each; an
    empty table gives no pieces; other columns are ignored.  A worker keeps the
    ids of up to twice ``runs`` words with their marks, with ``forget`` no longer
    than a task: that takes more time and less memory, and gives the same pieces.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    count = OPEN_WINDOWS

    def first(batches):
        from pyspark import TaskContext

        yield from _placed(batches, path, runs, forget, TaskContext.get().partitionId(), count)

    source = docs.select(F.col(key).cast("long").cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    pieces = C.stored(source.mapInPandas(first, _SCHEMA), "packing")
    closed = pieces.filter("sequence_id is not null")
    left = pieces.filter("sequence_id is null")
    parts = 1 + (left.agg(F.max("part")).first()[0] or 0)
    rounds = max(1, math.ceil(math.log(parts, FAN_IN) - 1e-9))

    def merging(r: int, last: bool):
        def merge(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            windows = Windows((r << 58) + (int(group[0]) << 36), int(group[0]), count)
            rows = rows.sort_values(["part", "k", "start"], kind="stable")
            for k, start, ids, total in zip(rows["k"], rows["start"], rows["ids"], rows["doc_tokens"]):
                windows.add(k, int(start), bytes(ids), int(total))
            windows.finish() if last else windows.leave_open()
            return windows.frame()
        return merge

    for r in range(1, rounds + 1):
        last = r == rounds
        group = F.floor(F.col("part") / FAN_IN).cast("long")
        merged = left.groupBy(group.alias("part_group")).applyInPandas(merging(r, last), _SCHEMA)
        if not last:
            merged = C.stored(merged, "packing-round")
        closed = closed.unionByName(merged.filter("sequence_id is not null"))
        left = merged.filter("sequence_id is null")
    return closed.select(F.col("k").cast("long").alias(key), *_COLUMNS[1:-1])
