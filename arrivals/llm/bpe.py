"""Operator 8, BPE encoding and decoding with a public vocabulary.

Words are merged by a priority queue of merge ranks over a doubly linked list
of their symbols, all new words of a text in one; queue entries whose pair has
changed meanwhile are stale and skipped.  Decoding concatenates the vocabulary's strings.  Words recur, so
each task keeps the ids of words it has merged in a bounded table.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterable
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm import common as C

#: Runs between white space kept per worker and generation; characters handled at once.
RUNS_KEPT = 200_000
CHUNK_CHARS = 1 << 20
#: Texts within these characters need no normalisation beyond lower case;
#: others take the vocabulary's own normaliser and word splitter.
_PLAIN = re.compile(r"[^\x00-\x1b\x20-ɏ]")
#: No symbol: no pair with it is merged.
_NONE = (1 << 32) - 1


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte: itself where it prints, else the
    next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def cut_ids(ids: list[int] | np.ndarray, ends: Iterable[int]) -> list[bytes]:
    """Ids up to each end, from the end before, as little-endian unsigned 32-bit integers."""
    data = np.array(ids, "<u4").tobytes()
    return [data[4 * i:4 * j] for i, j in pairwise(chain((0,), ends))]


class Vocabulary:
    """A byte-level BPE vocabulary with word ends, from a tokenizers JSON file.

    ``missing`` gives the ids of words not met before; by default they are
    merged here.  The tables that merging needs and the vocabulary's own library
    are made when they are first asked for: a worker holds no more than it uses.
    ``runs`` between white space are kept per generation, and half as many words.
    """

    _loaded: dict[tuple, Vocabulary] = {}

    def __init__(self, path: str, missing: Callable[[Vocabulary, list[str]], list[bytes]] | None = None,
                 runs: int = RUNS_KEPT):
        self.path = path
        spec = self._read()
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for text, i in [*self.ids.items(), *self.special.items()]:
            self.strings[i] = text
        self.ends_word = np.array([t.endswith(self.end) for t in self.strings])
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.word = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                                       if p["type"] == "Split"))
        self._rules = json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}})
        self.letters = _byte_letters()
        self.bytes_of = {c: b for b, c in self.letters.items()}
        #: The symbol of a byte inside a word and at its end.
        self.first = [self.ids[self.letters[b]] for b in range(256)]
        self.last = [self.ids[self.letters[b] + self.end] for b in range(256)]
        #: Symbols by code: a byte; 256 more at a word's end; 512 behind it.
        self.symbols = np.array([*self.first, *self.last, _NONE])
        self.missing = missing or Vocabulary._merge_all
        self.known_words = C.Recent(runs // 2)  # ids, 4 bytes each
        self.known_runs = C.Recent(runs)

    def _read(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            return json.load(f)

    def read_merges(self) -> dict[tuple[int, int], tuple[int, int]]:
        """The rank of every pair and the id it makes, read anew."""
        out = {}
        for rank, pair in enumerate(self._read()["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            out[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        return out

    @cached_property
    def merges(self) -> dict[tuple[int, int], tuple[int, int]]:
        return self.read_merges()

    @cached_property
    def ranks(self) -> dict[int, int]:
        """The rank of a pair."""
        return {left << 32 | right: rank for (left, right), (rank, _) in self.merges.items()}

    @cached_property
    def joined(self) -> dict[int, int]:
        """What a rank makes."""
        return dict(self.merges.values())

    @cached_property
    def first_ranks(self) -> np.ndarray:
        """Ranks of the pairs of symbols by their codes; -1: not merged."""
        codes: dict[int, list[int]] = {}
        for c, symbol in enumerate(self.symbols.tolist()):
            codes.setdefault(symbol, []).append(c)
        out = np.full((513, 513), -1)
        for (left, right), (rank, _) in self.merges.items():
            for c in codes.get(left, ()):
                out[c, codes.get(right, [])] = rank
        return out

    @cached_property
    def library(self):
        """The whole tokenizer as the vocabulary's own library has it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    @cached_property
    def splitter(self):
        """The library's normaliser and word splitter, without the vocabulary."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self._rules)

    def forget(self) -> None:
        """Lets go of the words met so far."""
        self.known_words.forget()
        self.known_runs.forget()

    @classmethod
    def load(cls, path: str, missing=None, runs: int = RUNS_KEPT) -> Vocabulary:
        """The vocabulary, read once per worker."""
        key = (path, getattr(missing, "__name__", None), runs)
        if key not in cls._loaded:
            cls._loaded[key] = cls(path, missing, runs)
        return cls._loaded[key]

    # ---- words ------------------------------------------------------------

    def merge(self, word: str) -> list[int]:
        return np.frombuffer(self._merge_all([word])[0], "<u4").tolist()

    def _merge_all(self, words: list[str]) -> list[bytes]:
        """Ids of each word.  All share one list of symbols and one queue: the
        ``_NONE`` behind each word has no rank with any symbol, so words stay apart."""
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        data = np.frombuffer(b"\0".join([*coded, b""]), np.uint8)
        lens = np.fromiter(map(len, coded), np.int64, len(coded))
        ends = np.cumsum(lens + 1) - 1
        last = ends[lens > 0] - 1
        code = data.astype(np.int64)
        code[last] += 256
        code[ends] = 512
        symbol = self.symbols[code].tolist()
        # Ranks of the pairs, by their left end; None or -1: not merged.
        start = np.append(self.first_ranks[code[:-1], code[1:]], np.int64(-1))
        own = start.tolist()
        n = len(own)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        place = n.bit_length()
        here = (1 << place) - 1
        at = np.flatnonzero(start >= 0)
        first = np.sort(start[at] << place | at).tolist()  # the pairs of bytes, in order
        first.append(_NONE << place)
        queue: list[int] = []  # the pairs that merges make
        rank_of, joined, push, pop = self.ranks.get, self.joined, heapq.heappush, heapq.heappop
        took, head = 0, first[0]
        while True:
            if queue and queue[0] < head:
                entry = pop(queue)
            elif took < len(at):
                entry, took = head, took + 1
                head = first[took]
            else:
                break
            i, rank = entry & here, entry >> place
            if own[i] != rank:
                continue  # stale: the pair is no longer there
            j = after[i]
            symbol[i] = new = joined[rank]
            symbol[j], own[j] = -1, None
            after[i] = j = after[j]
            before[j] = i
            own[i] = rank = rank_of(new << 32 | symbol[j])
            if rank is not None:
                push(queue, rank << place | i)
            j = before[i]
            own[j] = rank = rank_of(symbol[j] << 32 | new)
            if rank is not None:
                push(queue, rank << place | j)
        left = np.array(symbol, np.int64)
        kept = left >= 0
        kept[ends] = False
        return cut_ids(left[kept], np.cumsum(kept)[ends].tolist())

    # ---- a text ----------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The words of a text as the vocabulary's own splitter gives them."""
        if _PLAIN.search(text) is None:
            return self.word.findall(text.lower())
        shown = self.splitter.pre_tokenizer.pre_tokenize_str(self.splitter.normalizer.normalize_str(text))
        return [bytes(self.bytes_of[c] for c in w).decode("utf-8", "surrogatepass") for w, _ in shown]

    def _learn_words(self, words: set[str]) -> None:
        new = self.known_words.absent(words)
        if new:
            self.known_words.update(zip(new, self.missing(self, new)))

    def _plain_ids(self, text: str) -> bytes:
        if _PLAIN.search(text) is not None:
            words = self.words(text)
            self._learn_words(set(words))
            return b"".join(map(self.known_words.__getitem__, words))
        # No word reaches over white space: whatever stands between is looked up whole.
        runs = text.lower().split()
        new = self.known_runs.absent(set(runs))
        if new:
            find = self.word.findall
            split = [[r] if r.isalpha() else find(r) for r in new]  # letters alone are one word
            self._learn_words(set(chain.from_iterable(split)))
            known = self.known_words
            for r, words in zip(new, split):
                self.known_runs[r] = known[words[0]] if len(words) == 1 else b"".join(map(known.__getitem__, words))
        return b"".join(map(self.known_runs.__getitem__, runs))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out = []
        at = 0
        while at < len(text):  # in chunks that end before a space
            to = text.find(" ", at + CHUNK_CHARS)
            to = len(text) if to < 0 else to
            for part in (self.split_special.split(text[at:to]) if self.split_special else [text[at:to]]):
                if part in self.special:
                    out.append(np.array([self.special[part]], "<u4").tobytes())
                elif part:
                    out.append(self._plain_ids(part))
            at = to
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text in a new binary column ``ids``
    (little-endian unsigned 32-bit).  Null and empty texts have no ids.  All
    other columns and rows pass unchanged; an input column named ``ids`` is
    replaced."""
    return _mapped(docs, text, ids, lambda b: _encoder(path, b))


def _encoder(path: str, batch: pd.Series) -> list[bytes]:
    vocabulary = Vocabulary.load(path)
    return [vocabulary.encode(t) for t in batch]


def _mapped(docs: DataFrame, source: str, target: str, fn) -> DataFrame:
    C.small_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def apply(batch: pd.Series) -> pd.Series:
        return pd.Series(fn(batch), dtype=object)

    return docs.withColumn(target, apply(F.col(source)))


def decode(coded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the decoded string of ``ids`` in a new column ``text``;
    null ids give an empty string."""
    C.small_batches(coded.sparkSession)

    @F.pandas_udf("string")
    def apply(batch: pd.Series) -> pd.Series:
        vocabulary = Vocabulary.load(path)
        return pd.Series([vocabulary.decode(bytes(i)) if i is not None else "" for i in batch], dtype=object)

    return coded.withColumn(text, apply(F.col(ids)))
