"""Helpers shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propgraph.session import scratch_path

FOLDS = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of the ids that no model may learn from; false for a null id, which has no label either."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % FOLDS == 0, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, and no lineage behind it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_mapper(function: Callable[[Iterator[tuple]], Iterator[tuple]], schema: pa.Schema, rows: int = 2048, size: int = 16 << 20):
    """A ``mapInArrow`` function from one over row tuples.

    Output goes out in batches of at most ``rows`` rows, and earlier when their texts reach ``size`` bytes or characters,
    so that long texts do not add up to a large batch.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tuples() -> Iterator[tuple]:
            for batch in batches:
                # Slices, so that a batch of long texts is not held as Python objects as a whole.
                for start in range(0, batch.num_rows, 256):
                    yield from zip(*(column.to_pylist() for column in batch.slice(start, 256).columns), strict=True)

        out: list[tuple] = []
        held = 0
        for row in function(tuples()):
            out.append(row)
            held += sum(len(cell) for cell in row if isinstance(cell, str | bytes))
            if len(out) >= rows or held >= size:
                yield to_batch(out, schema)
                out, held = [], 0
        if out:
            yield to_batch(out, schema)

    return mapped


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """``label_id, y`` of the labelled ids outside the held-out fold; of several labels of an id the largest."""
    return (
        labels.select("doc_id", label)
        .where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(label).cast("int").alias("y"))
    )


def labelled_rows(docs: DataFrame, known: DataFrame, inputs: list[str], columns: list[Column] | None = None) -> DataFrame:
    """doc_id, y and ``inputs``, or ``columns`` computed from these, of the documents in ``known``; a repeated document once, with
    the least of its rows."""
    rows = (
        docs.select("doc_id", *inputs)
        .join(known, F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "y", *(columns or inputs))
    )
    return rows.groupBy("doc_id").agg(F.min(F.struct(*rows.columns[1:])).alias("row")).select("doc_id", "row.*")


#: Bits of one row of a bitmap, as Spark's bitmap functions make them, rows of a bitmap at most (8 MB), and its bits per id.
BITMAP_BITS = 1 << 15
BITMAP_ROWS = 1 << 11
BITS_PER_ID = 16


def rows_of_ids(docs: DataFrame, ids: DataFrame, key: str, n: int) -> DataFrame:
    """All rows of ``docs`` whose doc_id is one of the ``n`` ids in ``ids[key]``, and a few of other ids: about one in sixteen up
    to four million ids, more beyond. Meant to go before a join with ``ids``, which then moves few rows that it drops.

    Each id sets the bit of a bitmap that its hash points to; the bitmap, of bounded size, is broadcast.
    """
    bits = BITMAP_BITS * max(1, min(BITMAP_ROWS, -(-n * BITS_PER_ID // BITMAP_BITS)))
    place, row, marks = (free_name(docs, name) for name in ("bit_place", "bit_row", "bit_marks"))

    def placed(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(bits)) + 1

    bitmap = (
        ids.select(placed(key).alias(place))
        .groupBy(F.bitmap_bucket_number(place).alias(row))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(marks))
    )
    position = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring(marks, F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = (F.bitmap_bucket_number(place) == F.col(row)) & (F.getbit(byte, position % 8) == 1)
    return docs.withColumn(place, placed("doc_id")).join(F.broadcast(bitmap), marked, "left_semi").drop(place)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, inputs: list[str], bound: int, columns: list[Column] | None = None
) -> list:
    """At most ``bound`` labelled rows of ``docs`` outside the held-out fold: doc_id, label y and the columns ``inputs``, or
    ``columns`` computed from these for the chosen rows only.

    Which rows is decided by a hash of the id alone, so every run and every partitioning learns from the same ones. A
    document labelled more than once counts with its largest label, a repeated document once, with the least of its rows; that is
    settled before rows reach the driver, whatever the number of repeats.
    """
    chosen = known_labels(labels, label).orderBy(F.xxhash64("label_id"), "label_id").limit(bound)
    return sorted(labelled_rows(docs, F.broadcast(chosen), inputs, columns).collect(), key=lambda r: r["doc_id"])


def least_hashes(ids: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """The ``most`` rows of every group whose keys have the least hashes; ``ids`` has these two columns, and distinct rows.

    Rows are counted by the first ten bits of their hash, and only those up to where ``most`` are reached are put in order.
    """
    hashed = ids.withColumn("hash", F.xxhash64(key))
    bits = F.shiftright("hash", 54)
    counts = hashed.groupBy(F.col(group).alias("g"), bits.alias("bits")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("g").orderBy("bits")) - F.col("n")
    last = counts.withColumn("before", before).where(F.col("before") < most).groupBy("g").agg(F.max("bits").alias("last"))
    some = hashed.join(last, (F.col(group) == F.col("g")) & (bits <= F.col("last")))
    place = F.row_number().over(Window.partitionBy(group).orderBy("hash", key))
    return some.select(group, key, place.alias("place")).where(F.col("place") <= most).drop("place")


def first_per_group(df: DataFrame, group: str, order: list[Column], most: int, salts: int = 64) -> DataFrame:
    """The first ``most`` rows of every group, with their place from 1 on as ``place``.

    They are picked among the first of each of ``salts`` parts of the group, so that no task sorts a whole group.
    """
    salt = F.pmod(F.xxhash64(*(c for c in df.columns if c != group)), F.lit(salts))
    parts = Window.partitionBy(group, salt).orderBy(*order)
    some = df.withColumn("place", F.row_number().over(parts)).where(F.col("place") <= most).drop("place")
    return some.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= most)


#: Words whose hashes a task remembers.
CACHE_WORDS = 400_000
WORD = re.compile(r"\w+")


class WordHashes(dict):
    """Word -> its 64-bit hash; forgets all when it has grown too large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: str | None) -> list[str]:
    """Lower-case words of letters, digits and underscores; none for a null text."""
    return WORD.findall((text or "").lower())


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of ``n`` words from the hashes of words; one fewer per further word of the run."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : len(hashes) - n + 1 + i]
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))
