"""Input tables: delimited text, external tables, SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Storage names of an external table and the data source that reads them.
STORED_AS = {"textfile": "csv", "csvfile": "csv", "orc": "orc"}

Columns = Sequence[tuple[str, str]]


def ddl(columns: Columns) -> str:
    return ", ".join(f"`{name}` {data_type}" for name, data_type in columns)


def read_delimited(spark: SparkSession, path: str, columns: Columns, delimiter: str = ",") -> DataFrame:
    """Read delimited text without a header line. The schema is declared, so nothing is scanned to infer it; a cell that
    does not fit its type is null."""
    return spark.read.schema(StructType.fromDDL(ddl(columns))).option("sep", delimiter).option("header", False).csv(path)


CORRUPT = "__line"


def read_delimited_rejects(
    spark: SparkSession, path: str, columns: Columns, delimiter: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Read delimited text as ``read_delimited`` does, apart: the rows that fit, and ``line, file`` of those that do not.

    A line does not fit if a cell does not fit its type, or if it has too few or too many cells; empty cells are null and fit.
    """
    if any(name.lower() == CORRUPT for name, _ in columns):
        raise ValueError(f"{CORRUPT} is a reserved name")
    # Lines are parsed as a column of a text table: a CSV scan looks at the cells that a query needs only, so that a line would
    # fit in one query and not in another.
    options = {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).where(F.col("value") != "")
    parsed = F.from_csv("value", f"{ddl(columns)}, `{CORRUPT}` string", options)
    rows = lines.select(F.input_file_name().alias("__file"), F.inline(F.array(parsed)))
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "__file")
    return good, rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), F.col("__file").alias("file"))


def create_table(
    spark: SparkSession, path: str, table: str, columns: Columns, stored_as: str = "textfile", delimiter: str = ","
) -> DataFrame:
    """Register files as an external table if it does not exist, and return the table."""
    if stored_as not in STORED_AS:
        raise ValueError(f"stored_as must be one of {sorted(STORED_AS)}")
    source = STORED_AS[stored_as]
    options = ""
    if source == "csv":
        escaped = delimiter.replace("\\", "\\\\").replace("'", "\\'")
        options = f"OPTIONS (sep '{escaped}', header 'false')"
    escaped_path = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl(columns)}) USING {source} {options} LOCATION '{escaped_path}'"
    )
    return spark.table(table)


def sql(spark: SparkSession, query: str, database: str | None = None) -> DataFrame:
    """Run a SQL query, in the given database if one is named."""
    if database is None:
        return spark.sql(query)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(query)
    finally:
        spark.catalog.setCurrentDatabase(before)
