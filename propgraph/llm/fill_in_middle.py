"""Fill-in-the-middle: texts cut into prefix, middle and suffix at token boundaries and laid out for training.

A token is a run of the letters A-Z and a-z, or any other single code point. The places of the two cuts are ranks of token
boundaries, drawn from a hash of the document's id, so that every run and every partitioning cuts a document alike.

*Rank index*: the offset of a boundary is looked up by its rank in a learned index. A greedy cone fits segments to all
boundary offsets of the text, each a straight line off by at most ``EPSILON`` code points; what is left between line and
offset is stored, one byte per boundary. A cut is predicted by its segment and corrected by its residual, so it is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import rows_mapper

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many stay plain, and of a hundred that are cut so many have the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: How far a segment's line may be off; with its rounding it fits a residual of one byte.
EPSILON = 100
#: Boundaries that the fit looks at first when it begins a segment; then twice as many, and so on.
LOOK_AHEAD = 256


def boundaries(text: str) -> np.ndarray:
    """Offsets of all token boundaries in code points, 0 first; the boundary of rank r comes after r tokens."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = ((codes | 32) - 97) < 26  # unsigned: what is below "a" becomes very large
    end = np.ones(len(codes), dtype=bool)
    if len(codes):
        end[:-1] = ~(letter[:-1] & letter[1:])
    return np.concatenate([[0], np.flatnonzero(end) + 1])


@dataclass(frozen=True)
class RankIndex:
    """Offsets by rank: the first rank, offset and slope of every segment, and each rank's residual."""

    first: np.ndarray
    start: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predict(self, rank: np.ndarray | int) -> np.ndarray:
        """Where the segments' lines say that the boundary is."""
        s = np.searchsorted(self.first, rank, side="right") - 1
        return self.start[s] + np.rint(self.slope[s] * (rank - self.first[s])).astype(np.int64)

    def offset(self, rank: int) -> int:
        """Where the boundary is."""
        return int(self.predict(rank) + self.residual[rank])


def _segment(offsets: np.ndarray, first: int, epsilon: int) -> tuple[int, float]:
    """The rank after the longest segment that begins at rank ``first``, and its slope."""
    low, high, at, width = -np.inf, np.inf, first + 1, LOOK_AHEAD
    while at < len(offsets):
        to = min(len(offsets), at + width)
        run, rise = np.arange(at - first, to - first), offsets[at:to] - offsets[first]
        # Slopes between low and high pass all boundaries so far.
        lows = np.maximum.accumulate(np.maximum((rise - epsilon) / run, low))
        highs = np.minimum.accumulate(np.minimum((rise + epsilon) / run, high))
        good = int(np.searchsorted(lows > highs, True))
        if good:
            low, high = lows[good - 1], highs[good - 1]
        at += good
        if good < len(run):
            break
        width *= 2
    return at, (low + high) / 2 if at > first + 1 else 0.0


def fit(offsets: np.ndarray, epsilon: int = EPSILON) -> RankIndex:
    """The rank index of ascending offsets, the first of which is there at least."""
    first, slope = [0], []
    while first[-1] < len(offsets):
        end, found = _segment(offsets, first[-1], epsilon)
        first.append(end)
        slope.append(found)
    ranks = np.array(first[:-1])
    lines = RankIndex(ranks, offsets[ranks], np.array(slope), np.empty(0, np.int8))
    residual = offsets - lines.predict(np.arange(len(offsets)))
    return RankIndex(lines.first, lines.start, lines.slope, residual.astype(np.min_scalar_type(-epsilon - 1)))


def draws(doc_id: int | None) -> list[int]:
    """Four 32-bit numbers that belong to a document."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(doc_id: int | None, text: str | None, plain_percent: int, spm_percent: int, epsilon: int) -> tuple:
    """(tokens, form, code points of the prefix, of the middle, output) of one text."""
    text = text or ""
    index = fit(boundaries(text), epsilon)
    n = len(index.residual) - 1
    one, two, three, four = draws(doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or three % 100 >= 100 - plain_percent:
        return n, "plain", None, None, text
    a, b = sorted((index.offset(one % (n + 1)), index.offset(two % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if four % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
    epsilon: int = EPSILON,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    form is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle). A null or empty text, and one that holds one
    of the marks, is plain, with null lengths; a null id draws like one of its own. Repeated rows come out repeated, each
    alike. Very long texts are cut like others, with memory for some ten bytes per code point. Other columns are not read. An
    empty table gives no rows. One pass without a shuffle.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield (doc_id, *cut(doc_id, text, plain_percent, spm_percent, epsilon))

    fields = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64())]
    schema = pa.schema([*fields, ("middle_chars", pa.int64()), ("output", pa.string())])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows_mapper(each, schema), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from. No part holds a mark, so each mark's first place is its own."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        body = F.substr(body, F.length(one) + len(second) + 1)
        two = F.substring_index(body, MIDDLE, 1)
        return one, two, F.substr(body, F.length(two) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
