"""Benchmark decontamination: SimHashed windows, multi-index Hamming blocks, exact similarity.

*Windows.* Every benchmark item has windows of nearly its own size, and documents are read through windows of the same sizes.
Sizes are taken from a ladder, so that there are few, and documents are read at every ``STRIDE``-th word only: an item has a
window at each of ``STRIDE`` offsets instead, so that wherever a passage begins one pair of windows lies exactly alike.
*Blocks.* A fingerprint has four blocks of 16 bits. Two fingerprints that differ in at most eleven bits have a block that
differs in at most two, so an index of the items' blocks and all their neighbours within two bits finds every window within
eleven bits. A passage with a few words changed mostly has a window so near. *Verification.* The candidate's passage, as long
as the item, is compared with the item by the weighted Jaccard similarity of their five-word shingles, weights being how often
a shingle occurs.

Documents are neither shuffled nor collected. The items are broadcast in blocks of bounded size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import WordHashes, chained, rows_mapper, words_of

RADIUS = 11
STRIDE = 4
SHINGLE = 5
SIMILARITY = 0.8
#: Words per feature of a fingerprint.
FEATURE = 2
SMALLEST = 8
GROWTH = 1.25
BLOCKS, BLOCK_BITS = 4, 16
#: Bits in which a block's indexed neighbours differ from it, at most.
NEIGHBOURS = 2
#: Bytes of item texts in one broadcast. An index has some 9 KB an item.
BLOCK_BYTES = 4 << 20
#: Words of a document that are worked on at once, besides the overlap.
CHUNK = 1 << 13


def window_of(words: int) -> tuple[int, int]:
    """Size of the windows of an item with so many words, and the number of offsets they start at."""
    if words < SMALLEST + STRIDE - 1:
        return words, 1
    size = SMALLEST
    while int(size * GROWTH) + STRIDE - 1 <= words:
        size = int(size * GROWTH)
    return size, STRIDE


def bits_before(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set among the features before each place, (features + 1, 64)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64), dtype=np.uint16 if len(hashes) < 1 << 15 else np.int32)
    np.cumsum(bits, axis=0, out=out[1:], dtype=out.dtype)
    return out


def features(hashes: np.ndarray) -> np.ndarray:
    return chained(hashes, FEATURE) if len(hashes) >= FEATURE else hashes


def window_prints(before: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the windows of ``n`` features that begin at ``starts``: a bit is 1 if set in over half of them."""
    ones = before[starts + n] - before[starts]
    return np.packbits(ones > n // 2, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def similarity(a: list[str], b: list[str]) -> float:
    """Weighted Jaccard similarity of the shingles of two word lists; the whole list where it is shorter than a shingle."""

    def shingles(words: list[str]) -> Counter:
        return Counter(tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))

    x, y = shingles(a), shingles(b)
    both = sum((x & y).values())
    return both / max(1, sum(x.values()) + sum(y.values()) - both)


@dataclass
class BlockIndex:
    """The windows of one size: fingerprints with item and offset, and where each block value occurs among them."""

    size: int
    stride: int
    prints: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    first: list[np.ndarray]
    entries: list[np.ndarray]
    #: Which values of each block occur at all.
    seen: list[np.ndarray]

    @classmethod
    def build(cls, size: int, stride: int, prints: np.ndarray, items: np.ndarray, offsets: np.ndarray) -> BlockIndex:
        near = np.array([sum(1 << i for i in bits) for n in range(NEIGHBOURS + 1) for bits in combinations(range(BLOCK_BITS), n)])
        first, entries = [], []
        for b in range(BLOCKS):
            value = ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)).astype(np.int64)
            keys = (value[:, None] ^ near).ravel()
            order = np.argsort(keys, kind="stable")
            first.append(np.searchsorted(keys[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int32))
            entries.append((order // len(near)).astype(np.int32))
        return cls(size, stride, prints, items, offsets, first, entries, [np.diff(x) > 0 for x in first])

    def search(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs within the radius: query, entry, distance."""
        queries, found = [], []
        values = np.ascontiguousarray(prints, "<u8").view("<u2").reshape(-1, BLOCKS)
        for b in range(BLOCKS):
            some = np.flatnonzero(self.seen[b][values[:, b]])
            value = values[some, b].astype(np.int64)
            low = self.first[b][value].astype(np.int64)
            n = self.first[b][value + 1] - low
            queries.append(np.repeat(some, n))
            found.append(self.entries[b][np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())])
        q, e = np.concatenate(queries), np.concatenate(found)
        d = np.bitwise_count(prints[q] ^ self.prints[e])
        near = d <= radius
        pairs = np.unique(q[near].astype(np.int64) * len(self.prints) + e[near]) if near.any() else np.empty(0, np.int64)
        q, e = pairs // max(1, len(self.prints)), pairs % max(1, len(self.prints))
        return q, e, np.bitwise_count(prints[q] ^ self.prints[e])


def build_indexes(items: list[list[str]]) -> list[BlockIndex]:
    """One index per window size of the items' words; items without words have none."""
    hasher, groups = WordHashes(), {}
    for number, words in enumerate(items):
        if words:
            size, offsets = window_of(len(words))
            n = max(1, size - FEATURE + 1)
            starts = np.arange(offsets)
            prints = window_prints(bits_before(features(hasher.of(words))), starts, n)
            groups.setdefault((size, offsets), []).append((prints, np.full(offsets, number), starts))
    return [BlockIndex.build(*key, *(np.concatenate(x) for x in zip(*found, strict=True))) for key, found in sorted(groups.items())]


def _search_segments(segments: list[tuple[int, int, int, np.ndarray]], indexes: list[BlockIndex], radius: int) -> Iterator[tuple]:
    """(document, item, place, distance) of the windows of segments (document, first word, starts, hashes).

    The segments lie end to end in one array; windows begin at the first ``starts`` words of a segment and end inside it.
    """
    lengths = np.array([len(x[3]) for x in segments])
    begins = np.cumsum(lengths) - lengths
    owners, firsts = (np.array([x[i] for x in segments]) for i in (0, 1))
    starts_allowed = np.array([x[2] for x in segments])
    hashes = np.concatenate([x[3] for x in segments])
    before = {True: bits_before(features(hashes))}
    for index in indexes:
        paired = index.size >= FEATURE
        if paired not in before:
            before[paired] = bits_before(hashes)
        n = np.maximum(0, -(-np.minimum(starts_allowed, lengths - index.size + 1) // index.stride))
        segment = np.repeat(np.arange(len(segments)), n)
        within = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * index.stride
        if len(segment):
            prints = window_prints(before[paired], begins[segment] + within, index.size - FEATURE + 1 if paired else index.size)
            q, e, d = index.search(prints, radius)
            places = firsts[segment[q]] + within[q] - index.offsets[e]
            yield from zip(owners[segment[q]].tolist(), index.items[e].tolist(), places.tolist(), d.tolist(), strict=True)


def candidates(documents: list[list[str]], hasher: WordHashes, indexes: list[BlockIndex], radius: int) -> Iterator[tuple]:
    """(document, item, place of the passage, distance) of every window within the radius.

    A place may lie before the text, where only the later part of the item fits. Documents are searched together, and long
    ones in overlapping segments, so that a search step works on about ``CHUNK`` words whatever the documents' lengths.
    """
    if not indexes:
        return
    overlap = max(index.size for index in indexes)
    step = -(-max(CHUNK, overlap) // STRIDE) * STRIDE
    held, size = [], 0
    for number, words in enumerate(documents):
        hashes = hasher.of(words)
        for begin in range(0, len(words), step):
            part = hashes[begin : begin + step + overlap]
            held.append((number, begin, step, part))
            size += len(part)
            if size >= CHUNK:
                yield from _search_segments(held, indexes, radius)
                held, size = [], 0
    if held:
        yield from _search_segments(held, indexes, radius)


def matches(
    documents: list[list[str]], hasher: WordHashes, items: list[list[str]], indexes: list[BlockIndex], radius: int, least: float
) -> Iterator[tuple[int, int, int, int, int, float]]:
    """(document, item, start, length, distance, similarity) of verified passages; of overlapping ones of an item the best."""
    nearest: dict[tuple[int, int, int], int] = {}
    for document, item, place, distance in candidates(documents, hasher, indexes, radius):
        key = (document, item, max(0, place))
        nearest[key] = min(distance, nearest.get(key, distance))
    found: dict[tuple[int, int], list] = {}
    for (document, item, place), distance in nearest.items():
        words = documents[document]
        length = min(len(items[item]), len(words) - place)
        value = similarity(words[place : place + length], items[item])
        if value >= least:
            found.setdefault((document, item), []).append((-value, distance, place, length))
    for document, item in sorted(found):
        taken: list[tuple[int, int]] = []
        for value, distance, place, length in sorted(found[document, item]):
            if all(place >= b or place + length <= a for a, b in taken):
                taken.append((place, place + length))
                yield document, item, place, length, distance, -value


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64())]
    + [("distance", pa.int32()), ("similarity", pa.float64())]
)
COLUMNS = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILARITY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per passage of a document that is like a benchmark item.

    Columns: doc_id, item_id, start_word and n_words of the passage among the document's words, distance of the fingerprints of
    their nearest windows, similarity. Every passage with a window within ``radius`` bits and a similarity of at least ``least``
    is found; the README says how many others there are. Items without words match nothing, nor do documents without words,
    null texts included. Repeated items and repeated documents give their rows each; ids may be null. Other columns are not
    read. No items or no documents: no rows.
    """
    widest = (NEIGHBOURS + 1) * BLOCKS - 1
    if radius > widest:
        raise ValueError(f"{BLOCKS} blocks with their neighbours within {NEIGHBOURS} bits find up to {widest} bits, not {radius}")
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    # An item that repeats is looked for once, however often it is there.
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("n"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        ids, words = [(row["item_id"], row["n"]) for row in rows], [words_of(row["text"]) for row in rows]
        shared = spark.sparkContext.broadcast((ids, words, build_indexes(words)))

        def each(documents: Iterator[tuple], shared=shared) -> Iterator[tuple]:
            ids, words, indexes = shared.value
            hasher, names, texts, size = WordHashes(), [], [], 0

            def searched() -> Iterator[tuple]:
                for document, item, *rest in matches(texts, hasher, words, indexes, radius, least):
                    item_id, n = ids[item]
                    for _ in range(n):
                        yield names[document], item_id, *rest

            for doc_id, text in documents:
                names.append(doc_id)
                texts.append(words_of(text))
                size += len(texts[-1])
                if size >= CHUNK or len(texts) >= 4096:
                    yield from searched()
                    names, texts, size = [], [], 0
            yield from searched()

        found = texts.mapInArrow(rows_mapper(each, SCHEMA), COLUMNS)
        out = found if out is None else out.unionByName(found)
    return out
