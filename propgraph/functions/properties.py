"""Property maps of graph elements as column expressions.

Properties of elements in flight are a ``MAP<STRING, VARIANT>``: names are free and every value keeps its own type. A
property that is present with a JSON null is still present.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

PROPERTIES_TYPE = "map<string,variant>"


def pack_properties(columns: Mapping[str, Column]) -> Column:
    """Typed columns to a property map; a null cell is an absent property."""
    entries: list[Column] = []
    for name, column in columns.items():
        entries += [F.lit(name), column.cast("variant")]
    if not entries:
        entries = [F.lit(""), F.lit(None).cast("variant")]
    return F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())


def has_property(properties: Column, name: str) -> Column:
    return F.coalesce(F.map_contains_key(properties, F.lit(name)), F.lit(False))


def get_property(properties: Column, name: str, data_type: str = "string", required: bool = False) -> Column:
    """One property as ``data_type``. An absent one is null, or an error if ``required``."""
    value = F.try_variant_get(F.try_element_at(properties, F.lit(name)), "$", data_type)
    if not required:
        return value
    missing = F.raise_error(F.lit(f"element has no property `{name}`"))
    return F.when(has_property(properties, name), value).otherwise(missing)


def set_property(properties: Column, name: str, value: Column) -> Column:
    """Add or replace one property."""
    others = F.map_filter(properties, lambda key, _: key != F.lit(name))
    return F.map_concat(others, F.create_map(F.lit(name), value.cast("variant")))


def without(properties: Column, *names: str) -> Column:
    return F.map_filter(properties, lambda key, _: ~key.isin(*names))


def canonical_text(properties: Column) -> Column:
    """JSON text that is equal for equal property maps: a variant object writes its names in sorted order."""
    return F.to_json(F.to_variant_object(properties))
