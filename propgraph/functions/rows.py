"""Helper for projections with shared parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, keep: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Select ``keep`` and compute ``columns``, which later filters and projections then use as they are.

    A plain projection would be repeated inside every filter that the optimizer pushes below it, once per use of a column;
    with costly parts (parsing, taking values out of documents) that multiplies the work and the generated code.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select(*keep, F.inline(F.array(row)))
