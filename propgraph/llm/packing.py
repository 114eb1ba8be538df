"""Packing of tokenized examples into training sequences: vector bin packing by the dot-product heuristic.

An example is a prompt, whose tokens bear no loss, and a response, whose tokens do, followed by one end id. A sequence has
three limits at once: tokens, segments (pieces of examples) and loss-bearing tokens. An example longer than a sequence is
cut; its full sequences are done at once. The rest waits in a pool, and bins are filled one after the other: of the pieces
that fit, the one with the largest dot product of its sizes and the bin's free room, both as shares of the limits, goes in
next. Where nothing fits any more but tokens, segments and loss are left, a piece is cut to fill the room. What is left when
a task ends goes into sequences whose lengths are powers of two, which need no padding.

Each task packs what it reads: no shuffle, no state shared between tasks, memory bounded by the pool.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import to_batch

CAPACITY = 1024
MAX_SEGMENTS = 64
POOL = 1024
END_ID = 0
#: Words whose ids a worker remembers.
CACHE_WORDS = 500_000

SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    + [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss_tokens", pa.int64())]
)
COLUMNS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)

# Fixed value: the pattern by which byte-level tokenizers of this kind cut texts.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ODD_SPACE = re.compile(r"\s (?:\s|\Z)")


class Encoder:
    """Token ids of texts as little-endian bytes, by the tokenizer file; equal to encoding each text as a whole.

    A byte-level tokenizer first cuts a text by a pattern, and always before a space that a visible character follows; it then
    works on each cut alone. So the ids of a text are those of its space-separated words, and a word's ids are computed once.
    Words go to an encoder made from the file's vocabulary that has little overhead on short texts. Texts with runs of white
    space in which a space stands between others, texts with one of the tokenizer's special strings, and all texts of a
    tokenizer of another kind are encoded as a whole by the tokenizer itself.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.short = word_encoder(json.loads(self.tokenizer.to_str()))
        self.cache_words = cache_words
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.cache_words:
            self.words.clear()
        out = []
        for text in texts:
            if self.short is None or _ODD_SPACE.search(text) or any(s in text for s in self.special):
                out.append(self._whole(text))
                continue
            # A word keeps its space in front; only the first word of a text has none.
            words = _words(text)
            try:
                out.append(b"".join(map(self.words.__getitem__, words)))
            except KeyError:
                encode = self.short.encode_ordinary
                for word in set(words).difference(self.words):
                    self.words[word] = np.array(encode(word), dtype="<u4").tobytes()
                out.append(b"".join(map(self.words.__getitem__, words)))
        return out


def word_encoder(parts: dict):
    """An encoder of short texts from the parts of a byte-level tokenizer file; None for one of another kind.

    It takes a token's id for its rank, so the file's merges must stand in the order of the ids they make.
    """
    import tiktoken

    first, model = parts.get("pre_tokenizer") or {}, parts["model"]
    plain = first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True)
    if not plain or parts.get("normalizer") or model.get("type") != "BPE":
        return None
    # Byte-level files write a byte as a visible character: itself, or one from 256 on, in order.
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in parts.get("added_tokens", [])}
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made) or any(c not in vocabulary for c in byte_of):
        return None
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    return tiktoken.Encoding("words", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer: the tasks of a worker share what it has learnt."""
    return Encoder(path)


def _words(text: str) -> list[str]:
    first, *rest = text.split(" ")
    return [first, *(" " + word for word in rest)]


@dataclass
class Limits:
    """What one sequence may hold."""

    tokens: int = CAPACITY
    segments: int = MAX_SEGMENTS
    loss: int = CAPACITY

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("a sequence must have room for one token, one segment and one loss-bearing token")


class Packer:
    """Packs pieces (example, start, tokens, loss from) into sequences; ``place`` gives finished sequences.

    ``loss_from`` is the place in the piece where its loss-bearing tokens begin: they run to its end.
    """

    def __init__(self, limits: Limits, pool: int = POOL) -> None:
        self.limits, self.size = limits, pool
        self.owner: list = []  # (example, start) of each waiting piece
        self.need = np.empty((0, 2), dtype=np.int64)  # tokens, loss
        self.added: list[tuple[int, int]] = []

    def add(self, example, tokens: int, prompt: int) -> Iterator[list[tuple]]:
        """``prompt``: number of leading tokens without loss. Yields the sequences that become full."""
        cap, start = self.limits, 0
        while tokens - start > 0:
            # The longest piece that fits an empty sequence.
            room = min(cap.tokens, max(0, prompt - start) + cap.loss)
            length = min(room, tokens - start)
            loss = max(0, start + length - max(start, prompt))
            if length == cap.tokens:
                yield [(example, start, length, loss)]
            else:
                self.owner.append((example, start))
                self.added.append((length, loss))
            start += length
        if len(self.owner) >= 2 * self.size:
            yield from self.fill(self.size)

    def fill(self, leave: int) -> Iterator[list[tuple]]:
        """Fill sequences until ``leave`` pieces or fewer wait; the rest of a cut piece waits again."""
        need = np.concatenate([self.need, np.array(self.added, dtype=np.int64).reshape(-1, 2)])
        self.added = []
        owner, limits = self.owner, self.limits
        scale = np.array([limits.tokens, limits.loss], dtype=float)
        share = np.c_[need / scale, np.full(len(need), 1 / limits.segments)]
        waiting = np.ones(len(need), dtype=bool)
        count = len(need)
        while count > leave:
            # The room left is enough for a whole sequence only if the waiting tokens are; the last ones wait.
            if need[waiting, 0].sum() < limits.tokens and leave:
                break
            sequence, tokens, loss, segments = [], limits.tokens, limits.loss, limits.segments
            while tokens and segments and count:
                fits = waiting & (need[:, 0] <= tokens) & (need[:, 1] <= loss)
                free = np.array([tokens / limits.tokens, loss / limits.loss, segments / limits.segments])
                if fits.any():
                    best = int(np.argmax(np.where(fits, share @ free, -1.0)))
                    take, borne = int(need[best, 0]), int(need[best, 1])
                else:
                    # Cut the piece from which most tokens fit: all of its prompt, and loss-bearing tokens as far as allowed.
                    could = np.where(waiting, np.minimum(need[:, 0] - need[:, 1] + loss, tokens), 0)
                    best = int(np.argmax(could))
                    take = int(min(could[best], need[best, 0]))
                    if take <= 0:
                        break
                    borne = max(0, take - int(need[best, 0] - need[best, 1]))
                example, start = owner[best]
                sequence.append((example, start, take, borne))
                tokens, loss, segments = tokens - take, loss - borne, segments - 1
                if take == need[best, 0]:
                    waiting[best] = False
                    count -= 1
                else:
                    owner[best] = (example, start + take)
                    need[best] -= (take, borne)
                    share[best, :2] = need[best] / scale
            yield from self.cut_up(sequence)
        self.owner = [owner[i] for i in np.flatnonzero(waiting)]
        self.need = need[waiting]

    def finish(self) -> Iterator[list[tuple]]:
        """Empty the pool."""
        yield from self.fill(0)

    def cut_up(self, sequence: list[tuple]) -> Iterator[list[tuple]]:
        """A sequence as it is if it is full, and else, where a limit or the end of the pool left room in it, in sequences
        whose lengths are powers of two, which need no padding."""
        total = sum(piece[2] for piece in sequence)
        if total == self.limits.tokens:
            yield sequence
            return
        part, room = [], 1 << (total.bit_length() - 1)
        for example, start, length, loss in sequence:
            while length:
                take = min(room, length)
                borne = max(0, take - (length - loss))
                part.append((example, start, take, borne))
                start, length, loss, room, total = start + take, length - take, loss - borne, room - take, total - take
                if not room:
                    yield part
                    part, room = [], 1 << (total.bit_length() - 1) if total else 0


def pack(
    examples: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    response: str | Column = "text",
    prompt: str | Column | None = None,
    limits: Limits | None = None,
    pool: int = POOL,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    An example's ids are those of its prompt, then of its response, then id 0; the last two bear loss. Null and empty texts
    have no ids but the end id. Every id lies in exactly one piece; rows that repeat are packed as often as they occur, and a
    null id stays null. Other columns are not read. An empty table gives no rows. Sequence ids are unique; they name the task
    and the sequence in it.
    """
    limits = limits or Limits()
    texts = [F.lit("") if prompt is None else (F.col(prompt) if isinstance(prompt, str) else prompt)]
    texts.append(F.col(response) if isinstance(response, str) else response)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, number = encoder(tokenizer_path), Packer(limits, pool), TaskContext.get().partitionId() << 33
        end = np.array([END_ID], dtype="<u4").tobytes()
        held: dict[int, list] = {}  # examples with pieces that wait: id, ids, pieces not yet placed
        out: list[tuple] = []
        serial = 0

        def rows(sequences: Iterator[list[tuple]]) -> None:
            nonlocal number
            for sequence in sequences:
                offset = 0
                for example, start, length, loss in sequence:
                    doc_id, ids, left = held[example]
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    out.append((doc_id, start, length, crc, len(ids) // 4, number, offset, loss))
                    offset += length
                    held[example][2] = left - length
                    if left == length:
                        del held[example]
                number += 1

        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                ids, prompts, responses = (c.to_pylist() for c in batch.slice(first, 64).columns)
                for doc_id, a, b in zip(ids, encode(prompts), encode(responses), strict=True):
                    data = a + b + end
                    held[serial] = [doc_id, data, len(data) // 4]
                    rows(packer.add(serial, len(data) // 4, len(a) // 4))
                    serial += 1
                if len(out) >= 4096:
                    yield to_batch(out, SCHEMA)
                    out.clear()
        rows(packer.finish())
        if out:
            yield to_batch(out, SCHEMA)

    empty = F.lit("")
    return examples.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(texts[0].cast("string"), empty).alias("prompt"),
        F.coalesce(texts[1].cast("string"), empty).alias("response"),
    ).mapInArrow(task, COLUMNS)
