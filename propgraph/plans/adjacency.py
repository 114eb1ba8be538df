"""A graph in Spark's bucketed tables, for matches that join edges where they lie.

Vertices of a label are bucketed by uid, edges twice: by the uid of their source and by that of their target. All have the same
number of buckets, so a hop from either end joins vertices and edges bucket by bucket, without an exchange, and ids that are
written into a pattern prune buckets on both sides of the join. Edges without one of their endpoints match nothing and are left
out, so an end of a hop whose properties are not wanted (``Node(..., properties=False)``) needs no join at all.

A bucket is one task, so the edges of hubs would make a bucket that nothing can split. Edges of vertices with more than
``rows_per_task`` of them are kept in a table of their own beside the bucketed one, and joined as any table is.

The tables are in a database of the catalog, under their labels' names, so SQL sees them too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propgraph.graph import PropertyGraph, table_names
from propgraph.operators.skew import PIECES, ROWS_PER_TASK, heavy_keys
from propgraph.session import delete_path, scratch_path

SIDES = {"src": "out", "dst": "in"}


class BucketedGraph(PropertyGraph):
    """A graph in bucketed tables; it does not change."""

    whole = True

    def __init__(self, spark: SparkSession, database: str, vertices: dict[str, str], edges: dict[str, dict[str, list[str]]]):
        self.spark, self.database, self.edge_names = spark, database, edges
        tables = {label: [self._table(name) for name in names["src"]] for label, names in edges.items()}
        super().__init__(
            {label: self._table(name) for label, name in vertices.items()},
            {label: parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) for label, parts in tables.items()},
        )

    def _table(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}`")

    def edge_parts(self, label: str | None, side: str) -> list[DataFrame]:
        """The edges as they are bucketed by the uid at ``side``, and those of hubs, if there are any."""
        return super().edge_parts(label, side) if label is None else [self._table(name) for name in self.edge_names[label][side]]

    def drop(self) -> None:
        """Remove the database with all its tables."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")


def bucket_graph(
    spark: SparkSession, graph: PropertyGraph, database: str, buckets: int, location: str | None = None, rows_per_task: int = ROWS_PER_TASK
) -> BucketedGraph:
    """Write a graph's tables into a new database, below ``location`` if one is given; an error if it exists already.

    Every edge table is shuffled to its source buckets and to its target buckets, once each.
    """
    if buckets < 1:
        raise ValueError("at least one bucket")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE `{database}`{place}")

    def write(rows: DataFrame, name: str, key: str) -> None:
        # One task writes a bucket, in one file.
        writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.format("parquet").saveAsTable(f"`{database}`.`{name}`")

    vertices = {label: f"vertex_{name}" for label, name in table_names(list(graph.vertex_tables)).items()}
    for label, name in vertices.items():
        write(graph.vertex_tables[label], name, "uid")
    ids = graph.vertex_ids()
    edges: dict[str, dict[str, list[str]]] = {}
    for label, name in table_names(list(graph.edge_tables)).items():
        rows = graph.edge_tables[label]
        for side in SIDES:
            ends = ids.withColumnsRenamed({"label": f"{side}_label", "uid": f"{side}_uid"})
            rows = rows.join(ends, [f"{side}_label", f"{side}_uid"], "left_semi").select(*rows.columns)
        path = scratch_path(spark, "edges")
        rows.write.parquet(path)
        rows, edges[label] = spark.read.schema(rows.schema).parquet(path), {}
        for side, way in SIDES.items():
            key, table = f"{side}_uid", f"edge_{name}_{way}"
            heavy = heavy_keys(rows, [key], rows_per_task).drop(PIECES)
            edges[label][side] = [table]
            if heavy.isEmpty():
                write(rows, table, key)
            else:
                write(rows.join(heavy, key, "left_anti").select(*rows.columns), table, key)
                hubs = rows.join(heavy, key, "left_semi").select(*rows.columns)
                hubs.write.format("parquet").saveAsTable(f"`{database}`.`{table}_hubs`")
                edges[label][side].append(f"{table}_hubs")
        delete_path(spark, path)
    return BucketedGraph(spark, database, vertices, edges)
