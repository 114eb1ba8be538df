"""PageRank and personalized PageRank over a view.

One round is: ranks -> join with the out-edges -> sum per target vertex. Contract:

    r'(v) = (1 - d) * t(v) + d * (sum over edges u->v of r(u) * w / out(u) + t(v) * dangling)

with t(v) = 1/N for all vertices (PageRank) or 1/|S| on the sources and 0 elsewhere (personalized), start r = t, a fixed
number of rounds, parallel edges counted by weight, self-loops kept. Ranks add up to 1.

The restart is the same number s for all sources in a round, so it is kept apart: with x(0) = 1 on the sources and

    x'(v) = d * sum over edges u->v of x(u) * w / out(u)

the ranks after n rounds are s(n-1) x(0) + s(n-2) x(1) + ... + s(0) x(n-1) + s(-1) x(n), where s(-1) = 1/|S| and s(i) follows
from the dangling mass of the first i + 1 of these vectors. What no path of k edges reaches has no row in x(k), and only rows
move in a round: vertices without edges into them are silent after the first one, and few sources reach few vertices at first.

At scale: the edges are shuffled, sorted and cached once, by source; those of sources with many targets by target, so that their sums
are complete where they are made and these sources, of which there cannot be many, are sent to all tasks. A round moves one row
per reached vertex to the edges and one partial sum per target and task back. The vectors are written to the shared scratch folder,
which cuts the lineage and survives the loss of executors; the dangling mass is observed in that write, so no round makes a
second pass. With a ``run_path`` small files beside them say which rounds are whole, so that a run whose driver was lost goes on
after its last whole round, and a finished run can be carried on to more rounds.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from propgraph.graph import vertex_id
from propgraph.operators.match import check_limit, filter_uids, top_k
from propgraph.plans.views import GraphView, MaterializedView, materialize
from propgraph.session import child_names, delete_path, read_text, scratch_path, shuffle_partitions, sized_session, write_once

EDGES_PER_PIECE = 1_000_000

# Edges to a task at most, where the partitions that the session sets hold more.
EDGES_PER_TASK = 4_000_000

# A source with more targets than this for each task has its edges laid out by target. With at most EDGES_PER_TASK edges to a task
# there are at most WIDE_SOURCES of these, however large the graph is.
TARGETS_PER_TASK = 4
WIDE_SOURCES = EDGES_PER_TASK // TARGETS_PER_TASK


def rank_key() -> Column:
    """Ranks are ordered by this, descending, then by id; rounded, because the last digits of a distributed sum are not
    reproducible."""
    return F.round("rank", 10)


def pagerank(
    spark: SparkSession,
    view: GraphView,
    damping_factor: float = 0.85,
    rounds: int = 10,
    limit: int | str | None = None,
    view_path: str | None = None,
    reuse: bool = True,
    edges_per_piece: int = EDGES_PER_PIECE,
    run_path: str | None = None,
) -> DataFrame:
    """``vid, label, uid, rank`` by rank descending. A run with a ``run_path`` goes on where an earlier one of the same
    materialized view and arguments ended; give it a ``view_path``, since another build of the view is another run."""
    check_limit(limit)
    graph = materialize(spark, view, view_path, reuse, edges_per_piece)
    return _run(spark, graph, None, damping_factor, rounds, limit, edges_per_piece, run_path)


def personalized_pagerank(
    spark: SparkSession,
    view: GraphView,
    sources: DataFrame,
    damping_factor: float = 0.85,
    rounds: int = 10,
    limit: int | str | None = None,
    view_path: str | None = None,
    reuse: bool = True,
    edges_per_piece: int = EDGES_PER_PIECE,
    run_path: str | None = None,
) -> DataFrame:
    """As ``pagerank``, with restarts at the sources: a table with ``uid`` and optionally ``label``; ids that the view does
    not have are ignored, and no source at all gives an empty result."""
    check_limit(limit)
    graph = materialize(spark, view, view_path, reuse, edges_per_piece)
    ids = filter_uids(graph.vertices, sources).select("id")
    return _run(spark, graph, ids, damping_factor, rounds, limit, edges_per_piece, run_path)


def _run_name(graph: MaterializedView, sources: DataFrame | None, damping: float, edges_per_piece: int) -> str:
    """A name that runs have in common whose rounds have equal ranks."""
    starts = None
    if sources is not None:
        starts = tuple(sources.agg(F.count("*"), F.bit_xor(F.xxhash64("id")), F.sum(F.xxhash64("id") % (1 << 40))).first())
    return hashlib.sha256(repr((graph.path, starts, damping, edges_per_piece, "vectors")).encode()).hexdigest()[:16]


def _whole_rounds(spark: SparkSession, folder: str) -> list[float]:
    """The dangling masses that the whole rounds of a run have left, in order."""
    names = (re.fullmatch(r"round=(\d+)\.json", name) for name in child_names(spark, folder))
    noted, masses = {int(name[1]) for name in names if name}, []
    while len(masses) in noted:
        masses.append(json.loads(read_text(spark, f"{folder}/round={len(masses)}.json"))["dangling"])
    return masses


def _restarts(share: float, damping: float, dangling: list[float]) -> list[float]:
    """s(-1), s(0), ..., one more than the dangling masses of x(0), x(1), ... given."""
    restarts = [share]
    for i in range(len(dangling)):
        mass = sum(restarts[i - k] * dangling[k] for k in range(i + 1))
        restarts.append(((1.0 - damping) + damping * mass) * share)
    return restarts


def _run(
    spark: SparkSession,
    graph: MaterializedView,
    sources: DataFrame | None,
    damping: float,
    rounds: int,
    limit: int | str | None,
    edges_per_piece: int = EDGES_PER_PIECE,
    run_path: str | None = None,
) -> DataFrame:
    if rounds < 0:
        raise ValueError("rounds must not be negative")
    if not 0 <= damping <= 1:
        raise ValueError("damping_factor must be between 0 and 1")
    scratch, masses = scratch_path(spark, "pagerank"), []
    kept = run_path is not None
    if kept:
        folder = f"{run_path.rstrip('/')}/{_run_name(graph, sources, damping, edges_per_piece)}"
        masses = _whole_rounds(spark, folder)
        # A run of more rounds than wanted is left as it is: such a run starts anew, elsewhere.
        kept = len(masses) <= rounds
        scratch, masses = (folder, masses) if kept else (scratch, [])
    n_edges = graph.edges.count()
    session = sized_session(spark, n_edges, most_per_partition=EDGES_PER_TASK)
    partitions = shuffle_partitions(session)
    view_edges = session.read.schema(graph.edges.schema).parquet(f"{graph.path}/edges")
    vertices = session.read.schema(graph.vertices.schema).parquet(f"{graph.path}/vertices").select("id")
    # Per vertex, fixed over the rounds: out-weight (null if dangling), number of targets, teleport flag.
    out = view_edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("out"), F.count(F.lit(1)).alias("targets"))
    fixed = vertices.repartition(partitions, "id").join(out, "id", "left")
    if sources is None:
        fixed = fixed.withColumn("source", F.lit(True))
    else:
        listed = scratch_path(spark, "pagerank-sources")
        sources.write.parquet(listed)
        flagged = session.read.schema(sources.schema).parquet(listed).withColumn("source", F.lit(True))
        fixed = fixed.join(flagged, "id", "left")
    fixed = (
        fixed.select("id", "out", "targets", F.coalesce("source", F.lit(False)).alias("source"))
        .sortWithinPartitions("id")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    is_wide = F.col("targets") > min(edges_per_piece, TARGETS_PER_TASK * partitions)
    laid_out = []
    try:
        totals = fixed.agg(
            F.count(F.when(F.col("source"), 1)).alias("sources"),
            F.count(F.when(F.col("source") & F.col("out").isNull(), 1)).alias("dangling"),
            F.count(F.when(is_wide, 1)).alias("wide"),
        ).first()
        if totals["sources"] == 0:
            return spark.createDataFrame([], "vid string, label string, uid string, rank double")
        laid_out += _lay_out(view_edges, fixed.where(is_wide), totals["wide"], partitions)
        start = fixed.where("source").select("id", "out", "targets", F.lit(1.0).alias("x"))
        schema = start.schema
        reached = session.read.schema(schema).parquet(f"{scratch}/{len(masses) - 1}") if masses else start
        for i in range(len(masses), rounds):
            if kept:
                delete_path(spark, f"{scratch}/{i}")  # what a lost driver left of a round
            mass = Observation()
            _round(reached, laid_out, fixed, damping, is_wide, totals["wide"]).observe(
                mass, F.sum(F.when(F.col("out").isNull(), F.col("x"))).alias("dangling")
            ).write.parquet(f"{scratch}/{i}")
            masses.append(mass.get["dangling"] or 0.0)
            reached = session.read.schema(schema).parquet(f"{scratch}/{i}")
            if kept:
                write_once(spark, f"{scratch}/round={i}.json", json.dumps({"dangling": masses[i]}))
        restarts = _restarts(1.0 / totals["sources"], damping, [totals["dangling"], *masses][:rounds])
        vectors = [session.read.schema(schema).parquet(f"{scratch}/{i}") for i in range(rounds)]
        ranked = scratch_path(spark, "ranks")
        _ranks(fixed, vectors, restarts).write.parquet(ranked)
    finally:
        for table in (fixed, *laid_out):
            if table is not None:
                table.unpersist()
    if not kept:
        delete_path(spark, scratch)
    ranks = spark.read.schema("id bigint, rank double").parquet(ranked)
    named = graph.vertices.join(ranks, "id").select(
        vertex_id(F.col("label"), F.col("uid")).alias("vid"), "label", "uid", "rank"
    )
    # The rounded rank is a column, else a sort would round in each comparison.
    return top_k(named.withColumn("__order", rank_key()), [F.desc("__order"), F.asc("vid")], limit).drop("__order")


def _sent_to_all(wide: DataFrame, n_wide: int) -> DataFrame:
    """A row per wide source, for a join; more than expected, as a small ``edges_per_piece`` may give, are not broadcast."""
    return F.broadcast(wide) if n_wide <= WIDE_SOURCES else wide


def _lay_out(edges: DataFrame, wide: DataFrame, n_wide: int, partitions: int) -> tuple[DataFrame, DataFrame | None]:
    """The edges of most sources, by source, and those of the ``wide`` ones, by target; None if there are none of these."""
    by_source, by_target = edges, None
    if n_wide:
        wide = _sent_to_all(wide.select(F.col("id").alias("src")), n_wide)
        by_source, by_target = edges.join(wide, "src", "left_anti"), edges.join(wide, "src", "left_semi")
        by_target = by_target.repartition(partitions, "dst").sortWithinPartitions("dst").persist(StorageLevel.MEMORY_AND_DISK)
    by_source = by_source.repartition(partitions, "src").sortWithinPartitions("src").persist(StorageLevel.MEMORY_AND_DISK)
    return by_source, by_target


def _round(
    reached: DataFrame,
    laid_out: Sequence[DataFrame | None],
    fixed: DataFrame,
    damping: float,
    is_wide: Column,
    n_wide: int,
) -> DataFrame:
    """The vector after one more round, where it is not 0: ``id, out, targets, x``."""
    shares = reached.where("x > 0 AND out IS NOT NULL")
    share = F.col("id").alias("src"), (F.col("x") / F.col("out")).alias("share")
    by_source, by_target = laid_out
    sent = [by_source.join(shares.where(~is_wide).select(*share), "src")]
    if by_target is not None:
        wide = shares.where(is_wide).select(*share)
        sent.append(by_target.join(_sent_to_all(wide, n_wide), "src"))
    parts = [rows.select(F.col("dst").alias("id"), (F.col("share") * F.col("w")).alias("x")) for rows in sent]
    received = reduce(DataFrame.unionByName, parts).groupBy("id").agg((F.lit(damping) * F.sum("x")).alias("x"))
    return fixed.join(received, "id").select("id", "out", "targets", "x")


def _ranks(fixed: DataFrame, vectors: Sequence[DataFrame], restarts: Sequence[float]) -> DataFrame:
    """``id, rank`` of all vertices: each vector by the restart that it has gone on from, ``restarts`` from s(-1) on."""
    first, *others = reversed(restarts)
    ranks = fixed.select("id", F.when(F.col("source"), F.lit(first)).otherwise(0.0).alias("rank"))
    if not vectors:
        return ranks
    parts = [x.select("id", (F.col("x") * F.lit(s)).alias("part")) for x, s in zip(vectors, others, strict=True)]
    parts = reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("part").alias("part"))
    return ranks.join(parts, "id", "left").select("id", (F.col("rank") + F.coalesce("part", F.lit(0.0))).alias("rank"))
