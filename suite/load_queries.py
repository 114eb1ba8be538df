"""Sources, graph definition, bulk upsert and schema discovery."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph import schema as S
from propgraph.functions.properties import PROPERTIES_TYPE
from propgraph import Node, match
from propgraph.operators.load import load_edges, load_vertices
from propgraph.operators.profile import (
    profile_edges,
    profile_elements,
    profile_endpoints,
    profile_vertices,
    schema_from_data,
)
from propgraph.session import path_exists, scratch_path
from propgraph.sources.tables import create_table, read_delimited, read_delimited_rejects, sql
from propgraph.storage import StoredGraph
from suite.tables import graph, read

CUSTOMER_COLUMNS = [
    ("c_custkey", "bigint"),
    ("c_name", "string"),
    ("c_nationkey", "int"),
    ("c_acctbal", "double"),
    ("c_mktsegment", "string"),
]


def _table_name() -> str:
    return f"external_{uuid.uuid4().hex}"


# --- sources --------------------------------------------------------------------------------------------------------


def csv_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files without header as an external table; a second create of the same name changes nothing."""
    path = scratch_path(spark, "csv")
    read(spark, sf_dir, "customer").write.option("sep", "|").csv(path)
    name = _table_name()
    create_table(spark, path, name, CUSTOMER_COLUMNS, "textfile", "|")
    return create_table(spark, path, name, CUSTOMER_COLUMNS, "textfile", "|")


def orc_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    read(spark, sf_dir, "customer").write.orc(path)
    return create_table(spark, path, _table_name(), CUSTOMER_COLUMNS, "orc")


def read_delimited_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as comma separated text, read with a declared schema."""
    path = scratch_path(spark, "lines")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    lines.write.csv(path)
    columns = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_returnflag", "string")]
    return read_delimited(spark, path, columns)


def read_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text in which some quantities are no numbers and some lines lack a cell: what fits, and what does not."""
    path = scratch_path(spark, "lines")
    cells = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")]
    cells[2] = F.when(F.col("l_linenumber") == 2, "n/a").otherwise(cells[2])
    line = F.when(F.col("l_linenumber") == 5, F.concat_ws(",", *cells[:3])).otherwise(F.concat_ws(",", *cells))
    read(spark, sf_dir, "lineitem").select(line).write.text(path)
    columns = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_returnflag", "string")]
    good, rejects = read_delimited_rejects(spark, path, columns)
    kept = good.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("total"))
    return kept.select(F.lit(None).cast("string").alias("line"), "l_returnflag", "n", "total").unionByName(
        rejects.select("line", F.lit(None).cast("string").alias("l_returnflag"), F.lit(1).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("total"))
    )


def sql_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL on a registered table, in a named database."""
    name = _table_name()
    spark.sql(f"CREATE TABLE default.{name} USING parquet LOCATION '{sf_dir}/lineitem.parquet'")
    return sql(
        spark,
        f"SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM {name}"
        " WHERE l_discount > 0.02 GROUP BY l_returnflag, l_linestatus",
        database="default",
    )


# --- loads ----------------------------------------------------------------------------------------------------------


def _party_graph(spark: SparkSession) -> StoredGraph:
    return StoredGraph.create(
        spark,
        scratch_path(spark, "graph"),
        "parties",
        {
            "Party": [("name", "string"), ("balance", "double"), ("segment", "string"), ("last_total", "double")],
            "Part": [],
        },
        {"TRADES": [("quantity", "double"), ("price", "double")]},
        shards=3,
    )


def _load_parties(spark: SparkSession, sf_dir: str):
    """Suppliers, then customers over the same ids, then their orders, many per customer, the latest counts."""
    g = _party_graph(spark)
    loads = []
    for table, mapping, order in [
        ("supplier", [("__uid", "s_suppkey"), ("name", "s_name"), ("balance", "s_acctbal")], []),
        (
            "customer",
            [("__uid", "uid"), ("name", "c_name"), ("balance", "c_acctbal"), ("segment", "c_mktsegment")],
            [],
        ),
        ("orders", [("__uid", "o_custkey"), ("last_total", "o_totalprice")], ["o_orderdate", "o_orderkey"]),
    ]:
        source = read(spark, sf_dir, table)
        if table == "customer":
            source = source.withColumn("uid", F.when(F.col("c_custkey") % 10 != 7, F.col("c_custkey")))
        result = load_vertices(g, source, "Party", mapping, order)
        g = result.graph
        loads.append(result.report.withColumn("source", F.lit(table)))
    return g, loads


def vertex_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, _ = _load_parties(spark, sf_dir)
    return g.vertex_tables["Party"]


def _load_names(spark: SparkSession, sf_dir: str):
    """Parts by brand and container: properties named like a load's own words, and texts that are no numbers.

    The second load has a text where the first one had a number: the number stays.
    """
    g = StoredGraph.create(
        spark,
        scratch_path(spark, "graph"),
        "names",
        {"Item": [("reason", "string"), ("label", "string"), ("tags", "string"), ("size", "int")]},
        {},
        shards=2,
    )
    part = read(spark, sf_dir, "part")
    mapping = [("__uid", "p_partkey"), ("reason", "p_brand"), ("label", "p_type"), ("tags", "p_name"), ("size", "size")]
    first = load_vertices(g, part.withColumn("size", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("string")).otherwise("many")), "Item", mapping)
    later = part.where("p_partkey % 3 = 0").withColumn("size", F.when(F.col("p_partkey") % 2 == 0, F.lit("100")).otherwise("few"))
    second = load_vertices(first.graph, later, "Item", [mapping[0], mapping[4]])
    return second.graph, [first.report.withColumn("load", F.lit(1)), second.report.withColumn("load", F.lit(2))]


def vertex_upsert_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, _ = _load_names(spark, sf_dir)
    return match(g, Node("a", "Item")).select("a_uid", "a_reason", "a_label_property", "a_tags", "a_size")


def load_report_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, (first, second) = _load_names(spark, sf_dir)
    return first.unionByName(second).select("load", "outcome", F.coalesce("reason", F.lit("")).alias("reason"), "n")


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, loads = _load_parties(spark, sf_dir)
    report = loads[0].unionByName(loads[1]).unionByName(loads[2])
    return report.select("source", "outcome", F.coalesce("reason", F.lit("")).alias("reason"), "n")


def _load_trades(spark: SparkSession, sf_dir: str):
    """Line items as edges without edge id, so that they repeat keys; then prices again, by ship date."""
    g = _party_graph(spark)
    lines = read(spark, sf_dir, "lineitem").withColumn("party", F.lit("Party"))
    keys = [("__usid", "l_suppkey"), ("__udid", "l_partkey"), ("__uslabels", "[party]"), ("__udlabels", "['Part']")]
    first = load_edges(g, lines, "TRADES", [*keys, ("quantity", "l_quantity"), ("price", "l_extendedprice")])
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    late = lines.where(F.col("l_returnflag") != "A")
    return load_edges(first.graph, late, "TRADES", [*keys, ("price", "l_extendedprice")], order)


def edge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_trades(spark, sf_dir).graph.edge_tables["TRADES"]


def edge_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No party and no part is loaded, so all endpoints are missing."""
    report = _load_trades(spark, sf_dir).report
    return report.select("label", "outcome", F.coalesce("reason", F.lit("")).alias("reason"), "n")


def graph_create_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Define a graph, load it, describe it, drop it; rows per label and whether anything is left."""
    g = _party_graph(spark)
    g = load_vertices(g, read(spark, sf_dir, "customer"), "Party", [("__uid", "c_custkey")]).graph
    g = load_vertices(g, read(spark, sf_dir, "part"), "Part", [("__uid", "p_partkey")]).graph
    g = StoredGraph.open(spark, g.root)
    counts = g.vertex_ids().groupBy("label").count().collect()
    g.drop()
    left = path_exists(spark, g.root)
    return spark.createDataFrame(
        [(r["label"], r["count"], left) for r in counts], "label string, n bigint, left_over boolean"
    )


# --- schema ---------------------------------------------------------------------------------------------------------


def schema_profile_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_vertices(graph(spark, sf_dir))


def schema_profile_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_edges(graph(spark, sf_dir))


def schema_profile_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_endpoints(graph(spark, sf_dir))


def schema_profile_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free properties: the JSON objects of the events, by event type."""
    properties = F.try_variant_get(F.try_parse_json("props"), "$", PROPERTIES_TYPE)
    events = read(spark, sf_dir, "events").select(F.col("event_type").alias("label"), properties.alias("properties"))
    return profile_elements(events)


def schema_from_data_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discovered schema document, flattened again."""
    entry = "struct<label:string,fields:array<string>,src_dst_labels:array<struct<src:string,dst:string>>>"
    parsed = schema_from_data(graph(spark, sf_dir)).select(
        F.from_json("value", f"vertices array<{entry}>, edges array<{entry}>").alias("s")
    )
    parts = [
        parsed.select(F.lit(kind).alias("kind"), F.explode(f"s.{kind}").alias("e")) for kind in ("vertices", "edges")
    ]
    pairs = F.transform("e.src_dst_labels", lambda p: F.concat(p["src"], F.lit("->"), p["dst"]))
    return parts[0].unionByName(parts[1]).select(
        "kind",
        "e.label",
        F.array_join("e.fields", ",").alias("fields"),
        F.coalesce(F.array_join(pairs, ","), F.lit("")).alias("pairs"),
    )


def _order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schema document per order; some lack an entry, some give their numbers as text."""
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_json(
            F.struct(
                F.when(key % 11 != 3, (key % 20).cast("int")).alias(S.VERSION),
                F.concat(F.lit("graph é "), key).alias(S.GRAPH_NAME),
                F.when(key % 13 != 5, F.lit("native")).alias(S.INDEX_TYPE),
                F.when(key % 17 != 2, (key % 7).cast("string")).alias(S.REPLICATION),
                F.when(key % 19 == 4, F.lit("many")).otherwise((key % 5 + 1).cast("string")).alias(S.SHARDS),
                F.array(
                    F.struct(F.lit(1).alias(S.LABEL_INDEX), F.col("o_orderstatus").alias(S.LABEL_VALUE)),
                    F.struct(F.lit(300).alias(S.LABEL_INDEX), F.col("o_orderpriority").alias(S.LABEL_VALUE)),
                ).alias(S.VERTEX_TABLES),
                F.array(
                    F.struct((key % 4096).alias(S.LABEL_INDEX), F.lit("E").alias(S.LABEL_VALUE)),
                ).alias(S.EDGE_TABLES),
                F.when(key % 2 == 0, F.lit("SM4")).alias(S.ENCRYPTION),
                F.when(key % 3 == 0, F.lit(True)).alias(S.INDEX_SEPARATED),
            )
        ).alias("doc"),
    )


def schema_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse the documents, write them back, parse those: every good one comes out the same."""
    parsed = S.parse_schema_documents(_order_documents(spark, sf_dir), "doc")
    again = parsed.select("o_orderkey", "reason", F.when(F.col("reason").isNull(), S.schema_documents(parsed)).alias("doc2"))
    second = S.parse_schema_documents(again.withColumnRenamed("reason", "first_reason"), "doc2")
    return second.select(
        "o_orderkey",
        "version",
        "name",
        "replication",
        "shards",
        F.col("encryption_type").alias("encryption"),
        "index_separated",
        F.coalesce("first_reason", "reason").alias("reason"),
    )


def schema_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All label tables of the good documents, counted."""
    parsed = S.parse_schema_documents(_order_documents(spark, sf_dir), "doc").where("reason IS NULL")
    return (
        S.explode_labels(parsed).groupBy("kind", "label_index", "label_value").agg(F.count(F.lit(1)).alias("n"))
    )


def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label indexes to names; the indexes above the nations' are unknown."""
    nations = read(spark, sf_dir, "nation").select(
        F.lit("vertex").alias("kind"), F.col("n_nationkey").alias("label_index"), F.col("n_name").alias("label_value")
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 30).cast("int").alias("label_index"))
    return S.resolve_labels(orders, "label_index", nations, "vertex", "label")


_PARTY_SQL = """
s AS (SELECT CAST(s_suppkey AS VARCHAR) AS uid, s_name AS name, s_acctbal AS balance FROM supplier),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
      FROM customer WHERE c_custkey % 10 <> 7),
sc AS (SELECT coalesce(c.uid, s.uid) AS uid, CASE WHEN c.uid IS NULL THEN s.name ELSE c.name END AS name,
              CASE WHEN c.uid IS NULL THEN s.balance ELSE c.balance END AS balance, c.segment
       FROM s FULL JOIN c ON c.uid = s.uid),
o AS (SELECT CAST(o_custkey AS VARCHAR) AS uid, o_totalprice AS last_total FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders)
      WHERE k = 1)
"""

_TRADES_SQL = """
a AS (SELECT l_suppkey, l_partkey, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey
                                     ORDER BY l_quantity DESC, l_extendedprice DESC) AS k FROM lineitem) WHERE k = 1),
b AS (SELECT l_suppkey, l_partkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
                                     l_linenumber DESC, l_extendedprice DESC) AS k
        FROM lineitem WHERE l_returnflag <> 'A') WHERE k = 1)
"""

QUERIES = {
    "csv_external_table": (csv_external_table, "SELECT * FROM customer"),
    "orc_external_table": (orc_external_table, "SELECT * FROM customer"),
    "read_delimited": (read_delimited_text, "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"),
    "read_delimited_rejects": (
        read_rejects,
        """SELECT CAST(NULL AS VARCHAR) AS line, l_returnflag, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS total
           FROM lineitem WHERE l_linenumber NOT IN (2, 5) GROUP BY l_returnflag
           UNION ALL SELECT CASE WHEN l_linenumber = 5 THEN concat_ws(',', l_orderkey, l_linenumber, l_partkey)
                                 ELSE concat_ws(',', l_orderkey, l_linenumber, 'n/a', l_returnflag) END, NULL, 1, 0
           FROM lineitem WHERE l_linenumber IN (2, 5)""",
    ),
    "sql_scan": (
        sql_scan,
        """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
           WHERE l_discount > 0.02 GROUP BY ALL""",
    ),
    "vertex_upsert": (
        vertex_upsert,
        f"""WITH {_PARTY_SQL}
            SELECT coalesce(sc.uid, o.uid) AS uid, name, balance, segment, last_total
            FROM sc FULL JOIN o ON o.uid = sc.uid""",
    ),
    "load_report": (
        load_report,
        f"""WITH {_PARTY_SQL}, r AS (
              SELECT 'supplier' AS source, 'inserted' AS outcome, '' AS reason, count(*) AS n FROM s
              UNION ALL SELECT 'supplier', 'updated', '', 0
              UNION ALL SELECT 'supplier', 'superseded', '', 0
              UNION ALL SELECT 'customer', 'inserted', '', count(*) FROM c WHERE uid NOT IN (SELECT uid FROM s)
              UNION ALL SELECT 'customer', 'updated', '', count(*) FROM c WHERE uid IN (SELECT uid FROM s)
              UNION ALL SELECT 'customer', 'superseded', '', 0
              UNION ALL SELECT 'customer', 'rejected', 'no_uid', count(*) FROM customer WHERE c_custkey % 10 = 7
              UNION ALL SELECT 'orders', 'inserted', '', count(*) FROM o WHERE uid NOT IN (SELECT uid FROM sc)
              UNION ALL SELECT 'orders', 'updated', '', count(*) FROM o WHERE uid IN (SELECT uid FROM sc)
              UNION ALL SELECT 'orders', 'superseded', '', (SELECT count(*) FROM orders) - (SELECT count(*) FROM o))
            SELECT source, outcome, reason, CAST(n AS BIGINT) AS n FROM r""",
    ),
    "vertex_upsert_names": (
        vertex_upsert_names,
        """SELECT CAST(p_partkey AS VARCHAR) AS a_uid, p_brand AS a_reason, p_type AS a_label_property, p_name AS a_tags,
                  CAST(CASE WHEN p_partkey % 6 = 0 THEN 100 WHEN p_partkey % 7 <> 0 THEN p_size END AS INTEGER) AS a_size FROM part""",
    ),
    "load_report_names": (
        load_report_names,
        """SELECT CAST(load AS INTEGER) AS load, outcome, reason, CAST(n AS BIGINT) AS n FROM (
             SELECT 1 AS load, 'inserted' AS outcome, '' AS reason, count(*) AS n FROM part
             UNION ALL SELECT 1, 'updated', '', 0 UNION ALL SELECT 1, 'superseded', '', 0
             UNION ALL SELECT 1, 'cell does not fit', 'size', count(*) FROM part WHERE p_partkey % 7 = 0 HAVING count(*) > 0
             UNION ALL SELECT 2, 'inserted', '', 0 UNION ALL SELECT 2, 'superseded', '', 0
             UNION ALL SELECT 2, 'updated', '', count(*) FROM part WHERE p_partkey % 3 = 0
             UNION ALL SELECT 2, 'cell does not fit', 'size', count(*) FROM part
                       WHERE p_partkey % 3 = 0 AND p_partkey % 2 <> 0 HAVING count(*) > 0)""",
    ),
    "edge_upsert": (
        edge_upsert,
        f"""WITH {_TRADES_SQL}
            SELECT 'Party' AS src_label, CAST(a.l_suppkey AS VARCHAR) AS src_uid, 'Part' AS dst_label,
                   CAST(a.l_partkey AS VARCHAR) AS dst_uid, '' AS euid, a.l_quantity AS quantity,
                   CASE WHEN b.l_suppkey IS NULL THEN a.l_extendedprice ELSE b.l_extendedprice END AS price
            FROM a LEFT JOIN b ON b.l_suppkey = a.l_suppkey AND b.l_partkey = a.l_partkey""",
    ),
    "edge_load_report": (
        edge_load_report,
        f"""WITH {_TRADES_SQL}
            SELECT 'TRADES' AS label, outcome, reason, CAST(n AS BIGINT) AS n FROM (
              SELECT 'inserted' AS outcome, '' AS reason, 0 AS n
              UNION ALL SELECT 'updated', '', (SELECT count(*) FROM b)
              UNION ALL SELECT 'superseded', '', (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'A') - (SELECT count(*) FROM b)
              UNION ALL SELECT 'dangling', 'no_src_vertex', (SELECT count(*) FROM b)
              UNION ALL SELECT 'dangling', 'no_dst_vertex', (SELECT count(*) FROM b))""",
    ),
    "graph_create_drop": (
        graph_create_drop,
        """SELECT 'Party' AS label, count(*) AS n, false AS left_over FROM customer
           UNION ALL SELECT 'Part', count(*), false FROM part""",
    ),
    "schema_profile_vertices": (
        schema_profile_vertices,
        """SELECT * FROM (
             SELECT 'Region' AS label, 'r_name' AS field, count(r_name) AS n FROM region
             UNION ALL SELECT 'Nation', 'n_name', count(n_name) FROM nation
             UNION ALL SELECT 'Customer', 'c_name', count(c_name) FROM customer
             UNION ALL SELECT 'Customer', 'c_acctbal', count(c_acctbal) FROM customer
             UNION ALL SELECT 'Customer', 'c_mktsegment', count(c_mktsegment) FROM customer
             UNION ALL SELECT 'Supplier', 's_name', count(s_name) FROM supplier
             UNION ALL SELECT 'Supplier', 's_acctbal', count(s_acctbal) FROM supplier
             UNION ALL SELECT 'Part', 'p_name', count(p_name) FROM part
             UNION ALL SELECT 'Part', 'p_brand', count(p_brand) FROM part
             UNION ALL SELECT 'Part', 'p_type', count(p_type) FROM part
             UNION ALL SELECT 'Part', 'p_size', count(p_size) FROM part
             UNION ALL SELECT 'Part', 'p_retailprice', count(p_retailprice) FROM part
             UNION ALL SELECT 'Order', 'o_orderstatus', count(o_orderstatus) FROM orders
             UNION ALL SELECT 'Order', 'o_totalprice', count(o_totalprice) FROM orders
             UNION ALL SELECT 'Order', 'o_day', count(o_orderdate) FROM orders
             UNION ALL SELECT 'Order', 'o_orderpriority', count(o_orderpriority) FROM orders) WHERE n > 0""",
    ),
    "schema_profile_edges": (
        schema_profile_edges,
        """SELECT * FROM (
             SELECT 'PLACED' AS label, 'day' AS field, count(o_orderdate) AS n FROM orders
             UNION ALL SELECT 'PLACED', 'o_totalprice', count(o_totalprice) FROM orders
             UNION ALL SELECT 'CONTAINS', 'l_quantity', count(l_quantity) FROM lineitem
             UNION ALL SELECT 'CONTAINS', 'l_returnflag', count(l_returnflag) FROM lineitem
             UNION ALL SELECT 'SUPPLIED_BY', 'l_extendedprice', count(l_extendedprice) FROM lineitem) WHERE n > 0""",
    ),
    "schema_profile_endpoints": (
        schema_profile_endpoints,
        """SELECT 'IN_REGION' AS label, 'Nation' AS src_label, 'Region' AS dst_label, count(*) AS n FROM nation
           UNION ALL SELECT 'IN_NATION', 'Customer', 'Nation', count(*) FROM customer
           UNION ALL SELECT 'IN_NATION', 'Supplier', 'Nation', count(*) FROM supplier
           UNION ALL SELECT 'PLACED', 'Customer', 'Order', count(*) FROM orders
           UNION ALL SELECT 'CONTAINS', 'Order', 'Part', count(*) FROM lineitem
           UNION ALL SELECT 'SUPPLIED_BY', 'Part', 'Supplier', count(*) FROM lineitem
           UNION ALL SELECT 'SUPPLIES', 'Supplier', 'Part', count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)""",
    ),
    "schema_profile_elements": (
        schema_profile_elements,
        """SELECT label, field, count(*) AS n FROM (
             SELECT event_type AS label, unnest(json_keys(props)) AS field FROM events) GROUP BY label, field""",
    ),
    "schema_from_data": (
        schema_from_data_document,
        """SELECT * FROM (VALUES
             ('vertices', 'Region', 'r_name', ''), ('vertices', 'Nation', 'n_name', ''),
             ('vertices', 'Customer', 'c_acctbal,c_mktsegment,c_name', ''), ('vertices', 'Supplier', 's_acctbal,s_name', ''),
             ('vertices', 'Part', 'p_brand,p_name,p_retailprice,p_size,p_type', ''),
             ('vertices', 'Order', 'o_day,o_orderpriority,o_orderstatus,o_totalprice', ''), ('vertices', 'User', '', ''),
             ('edges', 'IN_REGION', '', 'Nation->Region'), ('edges', 'IN_NATION', '', 'Customer->Nation,Supplier->Nation'),
             ('edges', 'PLACED', 'day,o_totalprice', 'Customer->Order'),
             ('edges', 'CONTAINS', 'l_quantity,l_returnflag', 'Order->Part'),
             ('edges', 'SUPPLIED_BY', 'l_extendedprice', 'Part->Supplier'), ('edges', 'SUPPLIES', '', 'Supplier->Part')
           ) t(kind, label, fields, pairs)""",
    ),
    "schema_document": (
        schema_document,
        """WITH r AS (SELECT o_orderkey, o_orderkey AS k, CASE
               WHEN o_orderkey % 11 = 3 THEN 'no_version' WHEN o_orderkey % 13 = 5 THEN 'no_index_type'
               WHEN o_orderkey % 17 = 2 THEN 'no_replication_number' WHEN o_orderkey % 19 = 4 THEN 'bad_shard_number' END AS reason
             FROM orders)
           SELECT o_orderkey, CASE WHEN reason IS NULL THEN CAST(k % 20 AS INTEGER) END AS version,
                  CASE WHEN reason IS NULL THEN 'graph é ' || k END AS name,
                  CASE WHEN reason IS NULL THEN CAST(k % 7 AS INTEGER) END AS replication,
                  CASE WHEN reason IS NULL THEN CAST(k % 5 + 1 AS INTEGER) END AS shards,
                  CASE WHEN reason IS NULL AND k % 2 = 0 THEN 'SM4' END AS encryption,
                  CASE WHEN reason IS NULL AND k % 3 = 0 THEN true END AS index_separated, reason FROM r""",
    ),
    "schema_labels": (
        schema_labels,
        """WITH g AS (SELECT * FROM orders WHERE o_orderkey % 11 <> 3 AND o_orderkey % 13 <> 5 AND o_orderkey % 17 <> 2
                      AND o_orderkey % 19 <> 4)
           SELECT 'vertex' AS kind, 1 AS label_index, o_orderstatus AS label_value, count(*) AS n FROM g GROUP BY ALL
           UNION ALL SELECT 'vertex', 300, o_orderpriority, count(*) FROM g GROUP BY ALL
           UNION ALL SELECT 'edge', CAST(o_orderkey % 4096 AS INTEGER), 'E', count(*) FROM g GROUP BY ALL""",
    ),
    "label_lookup": (
        label_lookup,
        """SELECT o_orderkey, CAST(o_custkey % 30 AS INTEGER) AS label_index, n_name AS label
           FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30""",
    ),
}
