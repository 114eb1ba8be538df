"""Periodic runs of words: stretches that repeat a shorter stretch twice or more, and texts with the repeats taken out.

A run is a stretch of words with smallest period q and at least max(``LEAST_WORDS``, 2 q) words that no neighbouring word
extends. All runs of a text are found by internal pattern matching.

*Dictionary*: ranks of all stretches of 2, 4, 8 ... words by prefix doubling, which ends in a suffix array; equal stretches of
one of these lengths lie side by side in it. *Blocks*: stretches of 2^k words that begin at multiples of 2^(k-1). A run with
period p holds such a block whose copy p words further on lies in the run too, with 2^k < p or so: level k looks for the periods
from 1.5 * 2^k - 1 up to where level k + 1 begins, the lowest level also for all shorter ones. *Queries*: a wavelet tree over the
suffix array gives the next occurrence of a block beyond some place (range successor), so that only its neighbourhood of three
block lengths is looked at, wherever else the block occurs. *Progressions*: occurrences that overlap by half or more have a
constant distance; such a progression is followed as a whole, its end found by one comparison. *Candidates*: the distance from a
block to an occurrence; the dictionary says how far its period reaches to both sides.

A task works on many texts at once, put one after the other with a separator of its own behind each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import rows_mapper

LEAST_WORDS = 12
#: Level of the smallest blocks: four words. Runs of at least LEAST_WORDS words hold one, whatever their period.
LOWEST = 2
#: Words that a task looks at together; a longer text is looked at by itself.
BATCH_WORDS = 200_000
#: Candidates that are compared at a time.
CANDIDATES = 1 << 20


class Dictionary:
    """Ranks of the stretches of 2^k words, and the suffix array. ``words`` ends with a number that occurs once."""

    def __init__(self, words: np.ndarray, longest: int):
        n = len(words)
        self.suffixes = np.argsort(words, kind="stable")
        ordered = words[self.suffixes]
        rank = np.empty(n, np.int32)
        slots, new = np.arange(n), np.r_[True, ordered[1:] != ordered[:-1]]
        shared = self._assign(rank, slots, new, self.suffixes)
        self.ranks = [rank]
        # Only stretches that are not alone are sorted further; one that reaches the end of the words is alone.
        while len(shared) and (1 << (len(self.ranks) - 1)) < longest:
            rank = self.ranks[-1]
            at = self.suffixes[shared]
            key = rank[at].astype(np.int64) * n + rank[at + (1 << (len(self.ranks) - 1))]
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            self.suffixes[shared] = at
            rank = rank.copy()
            shared = self._assign(rank, shared, np.r_[True, key[1:] != key[:-1]], at)
            self.ranks.append(rank)

    @staticmethod
    def _assign(rank: np.ndarray, slots: np.ndarray, new: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank each position ``at`` by the first slot of its group; the slots of groups of two and more."""
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(slots)])
        rank[at] = np.repeat(slots[starts], sizes)
        return slots[np.repeat(sizes > 1, sizes)]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from positions a and b > a on."""
        i, j = a.copy(), b.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            step = (self.ranks[k][i] == self.ranks[k][j]).astype(np.int64) << k
            i += step
            j += step
        return i - a

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal before positions a and b > a."""
        i, j = a.copy(), b.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            size = 1 << k
            room = i >= size
            step = (room & (self.ranks[k][np.where(room, i - size, 0)] == self.ranks[k][np.where(room, j - size, 1)])).astype(np.int64) << k
            i -= step
            j -= step
        return a - i


class WaveletTree:
    """A sequence of numbers, for the next larger number within a range; one array of zero counts per bit."""

    def __init__(self, numbers: np.ndarray, below: int):
        self.bits = max(1, int(below).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            one = (numbers >> bit) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one, dtype=np.int64)]))
            numbers = np.concatenate([numbers[~one], numbers[one]])

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest number of at least ``least`` at places low to high - 1, and -1 where there is none."""
        l, r, smaller = low, high, np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            zl, zr = zeros[l], zeros[r]
            one = (least >> (self.bits - 1 - level)) & 1 == 1
            smaller += np.where(one, zr - zl, 0)
            l, r = np.where(one, zeros[-1] + l - zl, zl), np.where(one, zeros[-1] + r - zr, zr)
        found = smaller < high - low
        l, r, k = low[found], high[found], smaller[found]
        value = np.zeros(len(l), np.int64)
        for level, zeros in enumerate(self.zeros):
            zl, zr = zeros[l], zeros[r]
            one = k >= zr - zl
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            k = np.where(one, k - (zr - zl), k)
            l, r = np.where(one, zeros[-1] + l - zl, zl), np.where(one, zeros[-1] + r - zr, zr)
        out = np.full(len(low), -1, np.int64)
        out[found] = value
        return out


def periods_of(level: int) -> tuple[int, int]:
    """The smallest and the largest period that blocks of a level look for."""
    return 1 if level == LOWEST else 3 * (1 << level) // 2 - 1, 3 * (1 << level) - 2


def _occurrences(words: Dictionary, tree: WaveletTree, places: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of a level, and where they occur again at a distance that is a period of the level."""
    size = 1 << level
    rank = words.ranks[level]
    ordered = rank[words.suffixes]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    ends = np.r_[starts[1:], len(ordered)]
    b = np.arange(0, len(rank), size // 2)
    group = np.searchsorted(starts, rank[b])
    again = ends[group] - starts[group] > 1
    b, low, high = b[again], places[starts[group[again]]], places[ends[group[again]]]
    shortest, longest = periods_of(level)
    least = np.minimum(b + shortest, len(rank))
    while len(b):
        at = tree.successor(low, high, least)
        near = (at >= 0) & (at <= b + longest)
        b, low, high, at = b[near], low[near], high[near], at[near]
        following = tree.successor(low, high, at + 1)
        gap = following - at
        # Occurrences that overlap by half or more go on at this distance as long as the period of the block does.
        steps = (following >= 0) & (gap <= size // 2)
        yield b[~steps], at[~steps]
        least = at + 1
        if steps.any():
            first, o, d = b[steps], at[steps], gap[steps]
            more = (words.ahead(o, o + d) + d - size) // d
            least[steps] = o + d * more + 1
            # Where the period of the block reaches from the block to its occurrence, no larger one is the smallest.
            other = words.ahead(first, first + d) + d < o + size - first
            own = ~other & (d >= shortest)
            yield first[own], first[own] + d[own]
            first, o, d, more = first[other], o[other], d[other], np.minimum(more, (first + longest - o) // d)[other]
            at_once = np.cumsum(more + 1) // CANDIDATES
            for part in np.split(np.arange(len(first)), np.flatnonzero(np.diff(at_once)) + 1):
                n = more[part] + 1
                j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield np.repeat(first[part], n), np.repeat(o[part], n) + j * np.repeat(d[part], n)


def find_runs(words: np.ndarray, longest: int, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period. ``words`` are texts of numbers, none longer than
    ``longest``, each followed by a number that occurs nowhere else."""
    if least_words < LEAST_WORDS:
        raise ValueError(f"runs of fewer than {LEAST_WORDS} words may hold no block")
    found = [np.empty((0, 3), np.int64)]
    if longest >= least_words:
        dictionary = Dictionary(words, longest)
        top = len(dictionary.ranks)
        if top > LOWEST:
            ordered = dictionary.ranks[LOWEST][dictionary.suffixes]
            new = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            sizes = np.diff(np.r_[new, len(ordered)])
            kept = np.repeat(sizes > 1, sizes)
            tree = WaveletTree(dictionary.suffixes[kept], len(words))
            places = np.concatenate([[0], np.cumsum(kept)])
            for level in range(LOWEST, top):
                if 2 * periods_of(level)[0] > longest:
                    break
                for b, at in _occurrences(dictionary, tree, places, level):
                    p = at - b
                    start, end = b - dictionary.behind(b, at), at + dictionary.ahead(b, at)
                    run = end - start >= np.maximum(least_words, 2 * p)
                    found.append(np.unique(np.stack([start, end, p], axis=1)[run], axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    # Of the periods of one stretch the smallest comes first.
    rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]] if len(rows) else rows
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document; every tenth one, chosen by its id, repeats a stretch of its own from some place on."""
    n, draw = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if draw is None or draw % 10 or not n:
        return words
    draw //= 10
    a = draw % n
    p = 1 + (n - a) // (3 + draw % 8)
    rest = words[a : a + p]
    return words[:a] + (rest * (-(-(n - a) // p)))[: n - a]


def _batch_runs(texts: list[list[bytes]], least_words: int) -> list[np.ndarray]:
    """The runs of every text, as rows (start, end, period)."""
    numbers: dict[bytes, int] = {}
    flat = [numbers.setdefault(w, len(numbers)) for words in texts for w in words]
    sizes = np.array([len(words) for words in texts])
    ends = np.cumsum(sizes + 1)
    all_words = np.empty(ends[-1], np.int64)
    separator = np.zeros(ends[-1], dtype=bool)
    separator[ends - 1] = True
    all_words[~separator] = flat
    all_words[ends - 1] = len(numbers) + np.arange(len(texts))
    rows = find_runs(all_words, int(sizes.max()), least_words)
    first = ends - sizes - 1
    of = np.searchsorted(ends, rows[:, 0], side="right")
    rows[:, :2] -= first[of][:, None]
    return np.split(rows, np.searchsorted(of, np.arange(1, len(texts))))


def _described(doc_id: int | None, words: list[bytes], rows: np.ndarray) -> tuple:
    runs = [(int(s), int(e - s), int(p)) for s, e, p in rows]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, rows[:, 0] + rows[:, 2], 1)
        np.add.at(change, rows[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return doc_id, runs, *best, b" ".join(words)


def periodic_runs(
    docs: DataFrame, least_words: int = LEAST_WORDS, repeat: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (array of start, length, period), start, length and period of the longest run
    (of equally long ones the first, then that of the smaller period), and collapsed, the text of the words that no run holds
    after its first period, joined by spaces.

    Words are what ASCII white space parts. With ``repeat``, every tenth document is changed by ``repeated`` beforehand. A null,
    empty or short text has no runs and four nulls; a document with a null id is never changed. Repeated rows come out repeated.
    Very long texts are looked at whole, in some 200 bytes a word. Other columns are not read. An empty table gives no rows. One
    pass without a shuffle.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple[int | None, list[bytes]]] = []
        n = 0

        def done() -> Iterator[tuple]:
            for (doc_id, words), found in zip(held, _batch_runs([words for _, words in held], least_words), strict=True):
                yield _described(doc_id, words, found)

        for doc_id, text in rows:
            words = (text or "").encode("utf-8", "surrogatepass").split()
            held.append((doc_id, repeated(doc_id, words) if repeat else words))
            n += len(words) + 1
            if n >= BATCH_WORDS:
                yield from done()
                held, n = [], 0
        if held:
            yield from done()

    def texts(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, runs, start, length, period, collapsed in each(rows):
            listed = [{"start": s, "length": n, "period": p} for s, n, p in runs]
            yield doc_id, listed, start, length, period, collapsed.decode("utf-8", "surrogatepass")

    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    best = [(name, pa.int64()) for name in ("start", "length", "period")]
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), *best, ("collapsed", pa.string())])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows_mapper(texts, schema),
        "doc_id long, runs array<struct<start: long, length: long, period: long>>, start long, length long, period long, collapsed string",
    )
