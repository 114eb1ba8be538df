"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical after every run of ASCII white space becomes one space. Copies are combined in
three stages, and every stage compares whole contents, never digests alone:

1. *local*: each task combines the copies it reads; what leaves it is one row per content, with the ids of its copies;
2. *salted*: these rows meet by digest and salt, so that the copies of a frequent text are spread over ``salts`` tasks;
3. *global*: the winners of the salts, at most ``salts`` per content, meet by digest.

The ids of the copies stay with the salted rows; only the winners go on. Contents travel compressed, which keeps equal
contents equal and different ones different.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import free_name, rows_mapper, stored

SALTS = 64
LOCAL_BYTES = 64 << 20
LOCAL_IDS = 100_000


def normalised(text: str | Column) -> Column:
    """A text with every run of ASCII white space as one space; null is the empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(column.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _null_last(value: int | None) -> tuple:
    return (value is None, value or 0)


def _local(salts: int, local_bytes: int):
    def combine(rows: Iterator[tuple]) -> Iterator[tuple]:
        salt = TaskContext.get().partitionId() % salts
        pack = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        held: OrderedDict = OrderedDict()
        size = 0

        def row(key, ids):
            return key[0], salt, min(ids, key=_null_last), len(ids), ids, key[1]

        for doc_id, digest, text in rows:
            key = (digest, pack(text.encode()))
            ids = held.get(key)
            if ids is None:
                held[key] = [doc_id]
                size += len(key[1]) + 200
            else:
                ids.append(doc_id)
                size += 32
                held.move_to_end(key)
                if len(ids) >= LOCAL_IDS:
                    size -= len(key[1]) + 200 + 32 * (len(ids) - 1)
                    yield row(key, held.pop(key))
            # The contents not seen for longest leave first; a later copy of one of them just makes another row.
            while size > local_bytes and held:
                old, ids = held.popitem(last=False)
                size -= len(old[1]) + 200 + 32 * (len(ids) - 1)
                yield row(old, ids)
        for key, ids in held.items():
            yield row(key, ids)

    return combine


def _salted(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows come by digest and smallest id. The first row of a content is its winner and goes on with the content."""
    digest, winners = None, {}
    for row_digest, least, n, ids, content in rows:
        if row_digest != digest:
            digest, winners = row_digest, {}
        new = content not in winners
        winner = winners.setdefault(content, least)
        yield digest, winner, n, ids, content if new else None


def _global(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Winners come by digest and id: the first of a content is the row that stays."""
    digest, winners, last = None, {}, ()
    for row_digest, least, content in rows:
        if row_digest != digest:
            digest, winners = row_digest, {}
        keep = winners.setdefault(content, least)
        # Rows that repeat an id win in several salts; their mapping is wanted once.
        if (digest, least, keep) != last:
            last = (digest, least, keep)
            yield last


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, local_bytes: int = LOCAL_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    A null text is the empty text and equal to it. Of equal texts the smallest id stays; a null id comes after all others
    and stays only where every copy has none. Rows that repeat an id and a text count once each and carry the same
    result. Other columns are not read, whatever their names. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(text_col).alias("text")).select(
        "doc_id", F.sha2("text", 256).alias("digest"), "text"
    )
    local = rows.mapInArrow(
        rows_mapper(
            _local(salts, local_bytes),
            pa.schema(
                [("digest", pa.string()), ("salt", pa.int32()), ("least", pa.int64()), ("n", pa.int64())]
                + [("ids", pa.list_(pa.int64())), ("content", pa.binary())]
            ),
        ),
        "digest string, salt int, least long, n long, ids array<long>, content binary",
    )
    salted = stored(
        local.repartition("digest", "salt")
        .sortWithinPartitions("digest", F.col("least").asc_nulls_last())
        .select("digest", "least", "n", "ids", "content")
        .mapInArrow(
            rows_mapper(
                _salted,
                pa.schema(
                    [("digest", pa.string()), ("salt_keep", pa.int64()), ("n", pa.int64())]
                    + [("ids", pa.list_(pa.int64())), ("content", pa.binary())]
                ),
            ),
            "digest string, salt_keep long, n long, ids array<long>, content binary",
        ),
        "dedup-salted",
    )
    winners = (
        salted.where("content IS NOT NULL")
        .select("digest", "salt_keep", "content")
        .repartition("digest")
        .sortWithinPartitions("digest", F.col("salt_keep").asc_nulls_last())
        .mapInArrow(
            rows_mapper(_global, pa.schema([("w_digest", pa.string()), ("w_keep", pa.int64()), ("keep_id", pa.int64())])),
            "w_digest string, w_keep long, keep_id long",
        )
    )
    members = stored(
        salted.select("digest", "salt_keep", "n", "ids").join(
            winners, (F.col("digest") == F.col("w_digest")) & F.col("salt_keep").eqNullSafe(F.col("w_keep"))
        ).select("digest", "keep_id", "n", "ids"),
        "dedup-members",
    )
    sizes = members.groupBy(F.col("digest").alias("s_digest"), F.col("keep_id").alias("s_keep")).agg(
        F.sum("n").alias("group_size")
    )
    return (
        members.join(sizes, (F.col("digest") == F.col("s_digest")) & F.col("keep_id").eqNullSafe(F.col("s_keep")))
        .select(F.explode("ids").alias("doc_id"), "keep_id", "group_size", "digest")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
    )


def without_rows(docs: DataFrame, dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``dropped``; rows of ids in ``repeated`` that are alike in id and text stay once.

    ``dropped`` and ``repeated`` have one column, doc_id. Texts are shuffled for repeated ids only.
    """
    kept = docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return kept
    name = free_name(docs, "_again")
    again = repeated.select(F.col("doc_id").alias(name)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(name))
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, same, "left_anti").unionByName(once)


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) whose text has no copy with a smaller id.

    Of rows alike in id and text one stays. A row without id goes if a copy of its text has one; of copies that all lack
    an id one stays.
    """
    groups = stored(exact_groups(docs, salts=salts), "dedup-groups")
    repeated = groups.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    named = without_rows(docs.where("doc_id IS NOT NULL"), groups.where("NOT kept AND doc_id IS NOT NULL"), repeated)
    nameless = docs.where("doc_id IS NULL")
    if nameless.isEmpty():
        return named
    digest = free_name(docs, "_digest")
    alone = groups.where("keep_id IS NULL").select(F.col("text_sha256").alias(digest)).distinct()
    once = (
        nameless.withColumn(digest, F.sha2(normalised("text"), 256))
        .join(alone, digest, "left_semi")
        .dropDuplicates([digest])
        .select(*docs.columns)
    )
    return named.unionByName(once)
