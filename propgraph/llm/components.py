"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import stored


def _with_least(pairs: DataFrame, hubs: bool) -> DataFrame:
    """Rows (u, v) with m, the smallest of u and all its neighbours v.

    The smallest is aggregated before the shuffle and joined back. Where nodes may have very many neighbours (``hubs``) it is
    written first: a join that shared the aggregate's partitioning could not be split by adaptive execution.
    """
    least = pairs.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("least"))
    least = stored(least, "least") if hubs else least
    return pairs.join(least, F.col("u") == F.col("k")).select("u", "v", F.least("u", "least").alias("m"))


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node that can be reached.

    Each round writes its edges to the shared folder, so lineage stays one round long and a lost executor costs at most
    that. The number of rounds grows with the logarithm of the longest path. Links of a node with itself are ignored; no
    links give no rows.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = _signature(edges)
    while before[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, hubs=True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # After the large step a node is linked to smaller ones by few edges: those to the smallest of each neighbourhood.
        small = _with_least(large, hubs=False)
        star = (
            small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = stored(star, "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("v").agg(F.lit(1).alias("one")).select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
