"""Entity keys, documents and tagged results to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.functions import keys as K
from propgraph.functions.properties import get_property
from propgraph.operators.decode import (
    decode_edges,
    decode_path_elements,
    decode_paths,
    decode_result,
    decode_vertices,
    explode_path,
    rejects_by_reason,
    split,
)
from propgraph.operators.elements import distinct_paths, key_report, keys_to_uids, path_length, path_lengths
from suite.tables import read

VERTEX_LABELS = {1: "Customer", 258: "Order"}
EDGE_INDEX = 3


def customer_key(key: Column) -> Column:
    """Customers on 4096 shards, label 1, inner ids beyond 32 bits."""
    return K.vertex_key(key % 4096, F.lit(1), key * 1_000_003 + 255)


def order_key(key: Column) -> Column:
    return K.vertex_key(key * 7 % 4096, F.lit(258), key)


# --- keys -----------------------------------------------------------------------------------------------------------


def key_decode_v18(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = read(spark, sf_dir, "customer").select("c_custkey", customer_key(F.col("c_custkey")).alias("key"))
    return keys.select(
        "c_custkey",
        K.key_text(F.col("key")).alias("rk"),
        K.shard_id(F.col("key")).alias("shard_id"),
        K.label_index(F.col("key")).alias("label_index"),
        K.inner_id(F.col("key")).alias("inner_id"),
    )


def key_shard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_custkey")
    keys = read(spark, sf_dir, "orders").select(K.vertex_key(key % 4096, key % 3 + 1, F.col("o_orderkey")).alias("key"))
    return key_report(keys, K.shard_id(F.col("key")), K.label_index(F.col("key")))


def key_decode_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User ids with non-ASCII text; label indexes with the high bit of both bytes in use."""
    uid = F.concat(F.lit("pièce "), F.col("p_partkey"))
    keys = read(spark, sf_dir, "part").select(
        "p_partkey", K.legacy_vertex_key(uid, F.col("p_partkey") * 37 % 65536).alias("key")
    )
    return keys.select(
        "p_partkey",
        K.legacy_uid(F.col("key")).alias("uid"),
        K.legacy_label_index(F.col("key")).alias("label_index"),
        F.size("key").alias("n_bytes"),
    )


def _edge_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of PLACED edges: both endpoints and some bytes more."""
    tail = F.array(F.lit(EDGE_INDEX), F.lit(-1))
    orders = read(spark, sf_dir, "orders").withColumns(
        {"start": customer_key(F.col("o_custkey")), "end": order_key(F.col("o_orderkey"))}
    )
    return orders.withColumn("key", F.concat("start", "end", tail))


def edge_key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _edge_keys(spark, sf_dir)
    start, end = K.start_key(F.col("key")), K.end_key(F.col("key"))
    return keys.select(
        "o_orderkey",
        K.shard_id(start).alias("start_shard"),
        K.inner_id(start).alias("start_inner"),
        K.label_index(end).alias("end_label"),
        K.inner_id(F.col("key"), K.VERTEX_KEY_BYTES).alias("end_inner"),
        F.size("key").alias("n_bytes"),
    )


def key_to_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the row key of their customer, translated to the customer's id."""
    rk = K.key_text(customer_key(F.col("c_custkey")))
    vertices = read(spark, sf_dir, "customer").select(rk.alias("rk"), F.col("c_name").alias("uid"))
    result = read(spark, sf_dir, "orders").select("o_orderkey", K.key_text(customer_key(F.col("o_custkey"))).alias("vertex"))
    return keys_to_uids(result, "vertex", vertices, rows_per_task=5).select("o_orderkey", "uid")


# --- documents ------------------------------------------------------------------------------------------------------


def _customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.when(F.col("c_acctbal") < 0, F.array(F.lit("debt"), F.col("c_mktsegment")))
    properties = F.struct(
        F.concat(F.lit("c"), "c_custkey").alias("__uid"),
        tags.alias("__tags"),
        "c_name",
        "c_acctbal",
        F.struct(F.col("c_nationkey").alias("nation")).alias("home"),
    )
    document = F.struct(
        F.array(F.lit("Customer"), F.lit("Other")).alias("labels"),
        customer_key(F.col("c_custkey")).alias("entityKey"),
        properties.alias("properties"),
    )
    return read(spark, sf_dir, "customer").select("c_custkey", F.to_json(document).alias("doc"))


def decode_vertex_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split(decode_vertices(_customer_documents(spark, sf_dir), "doc"))
    properties = F.col("properties")
    return good.select(
        "c_custkey",
        "label",
        "uid",
        F.array_join("tags", ",").alias("tags"),
        get_property(properties, "c_name").alias("c_name"),
        get_property(properties, "c_acctbal", "double").alias("c_acctbal"),
        F.try_variant_get(properties["home"], "$.nation", "int").alias("nation"),
        F.array_join(F.map_keys(properties), ",").alias("names"),
        "rk",
    ).withColumn("rk", F.size(F.split("rk", " ")).cast("int"))


def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents spoiled in every way; all others decode."""
    k = F.col("c_custkey") % 10
    spoiled = (
        F.when(k == 0, F.lit("{not json"))
        .when(k == 1, F.regexp_replace("doc", '"labels":\\["Customer","Other"\\],', ""))
        .when(k == 2, F.regexp_replace("doc", '"labels":\\["Customer","Other"\\]', '"labels":[]'))
        .when(k == 3, F.regexp_replace("doc", '"__uid"', '"uid"'))
        .when(k == 4, F.regexp_replace("doc", '"properties"', '"props"'))
        .when(k == 5, F.regexp_replace("doc", '"entityKey"', '"key"'))
        .otherwise(F.col("doc"))
    )
    documents = _customer_documents(spark, sf_dir).withColumn("doc", spoiled)
    return rejects_by_reason(decode_vertices(documents, "doc"))


def _edge_document(properties: list, start: Column, end: Column, key: Column) -> Column:
    return F.struct(
        F.array(F.lit("PLACED")).alias("labels"),
        key.alias("entityKey"),
        start.alias("startKey"),
        end.alias("endKey"),
        F.struct(*properties).alias("properties"),
    )


def _placed_document() -> Column:
    properties = [
        F.concat(F.lit("c"), "o_custkey").alias("__srcuid"),
        F.concat(F.lit("o"), "o_orderkey").alias("__dstuid"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("e"), "o_orderkey")).alias("__uid"),
        "o_totalprice",
        "o_orderpriority",
    ]
    return _edge_document(properties, F.col("start"), F.col("end"), F.col("key"))


def _decoded_edges(decoded: DataFrame) -> DataFrame:
    good, _ = split(decoded)
    return good.select(
        "o_orderkey",
        "label",
        "euid",
        F.col("src.label").alias("src_label"),
        F.col("src.uid").alias("src_uid"),
        F.col("dst.label").alias("dst_label"),
        F.col("dst.uid").alias("dst_uid"),
        get_property(F.col("properties"), "o_totalprice", "double").alias("o_totalprice"),
        F.array_join(F.map_keys("properties"), ",").alias("names"),
    )


def decode_edges_v18(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _edge_keys(spark, sf_dir).select("o_orderkey", F.to_json(_placed_document()).alias("doc"))
    return _decoded_edges(decode_edges(documents, "doc", 18, VERTEX_LABELS))


def decode_edges_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = K.legacy_vertex_key(F.concat(F.lit("né "), "o_custkey"), F.lit(1))
    end = K.legacy_vertex_key(F.concat(F.lit("o"), "o_orderkey"), F.lit(258))
    properties = [F.lit("e").alias("__uid"), F.col("o_totalprice")]
    document = _edge_document(properties, start, end, F.col("key"))
    documents = _edge_keys(spark, sf_dir).select("o_orderkey", F.to_json(document).alias("doc"))
    return _decoded_edges(decode_edges(documents, "doc", 17, VERTEX_LABELS))


def decode_mixed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of both key formats in one table, and some whose version nobody knows."""
    start = K.legacy_vertex_key(F.concat(F.lit("né "), "o_custkey"), F.lit(1))
    end = K.legacy_vertex_key(F.concat(F.lit("o"), "o_orderkey"), F.lit(258))
    old = _edge_document([F.lit("e").alias("__uid"), F.lit("kept").alias("__srcuid"), F.col("o_totalprice")], start, end, F.col("key"))
    k = F.col("o_orderkey") % 5
    version = F.when(k == 0, 17).when(k == 1, 12).when(k == 2, 18).when(k == 3, 19)
    documents = _edge_keys(spark, sf_dir).select(
        "o_orderkey", version.alias("version"), F.when(version < 18, F.to_json(old)).otherwise(F.to_json(_placed_document())).alias("doc")
    )
    decoded = decode_edges(documents, "doc", F.col("version"), VERTEX_LABELS)
    return decoded.select(
        *("o_orderkey", "version", "label", "euid", "reason"),
        F.col("src.label").alias("src_label"),
        F.col("src.uid").alias("src_uid"),
        F.col("dst.label").alias("dst_label"),
        F.col("dst.uid").alias("dst_uid"),
        F.array_join(F.map_keys("properties"), ",").alias("names"),
    )


def edge_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge documents without endpoint key or id, or with a label index nobody declared."""
    k = F.col("o_orderkey") % 7
    doc = F.to_json(_placed_document())
    spoiled = (
        F.when(k == 0, F.regexp_replace(doc, '"startKey"', '"start"'))
        .when(k == 1, F.regexp_replace(doc, '"endKey":', '"endKey":[],"x":'))
        .when(k == 2, F.regexp_replace(doc, '"__srcuid"', '"srcuid"'))
        .when(k == 3, F.regexp_replace(doc, '"__dstuid"', '"dstuid"'))
        .when(k == 4, F.regexp_replace(doc, '"startKey":', '"startKey":[0,2,3,4,5,6,7,8],"x":'))
        .when(k == 5, F.regexp_replace(doc, '"endKey":', '"endKey":[0,2,3,4,5,6,7,8],"x":'))
        .otherwise(doc)
    )
    documents = _edge_keys(spark, sf_dir).select("o_orderkey", spoiled.alias("doc"))
    return rejects_by_reason(decode_edges(documents, "doc", 18, VERTEX_LABELS))


def _vertex_document(label: str, uid: Column, key: Column) -> Column:
    return F.struct(F.array(F.lit(label)).alias("labels"), key.alias("entityKey"), F.struct(uid.alias("__uid")).alias("properties"))


def path_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as paths customer, PLACED, order."""
    parts = [
        F.to_json(_vertex_document("Customer", F.concat(F.lit("c"), "o_custkey"), F.col("start"))),
        F.to_json(_placed_document()),
        F.to_json(_vertex_document("Order", F.concat(F.lit("o"), "o_orderkey"), F.col("end"))),
    ]
    doc = F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    return _edge_keys(spark, sf_dir).select("o_orderkey", doc.alias("doc"))


def decode_path_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split(decode_path_elements(path_documents(spark, sf_dir), "doc", 18, VERTEX_LABELS))
    return good.select(
        "o_orderkey",
        "pos",
        "kind",
        F.coalesce("vertex.label", "edge.label").alias("label"),
        F.coalesce("vertex.uid", "edge.euid").alias("id"),
        F.coalesce("edge.src.uid", F.lit("")).alias("src_uid"),
    )


def decoded_path_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths as documents, every second one twice: the same path again is no new path."""
    documents = path_documents(spark, sf_dir)
    doubled = documents.unionByName(documents.where("o_orderkey % 2 = 0"))
    good, _ = split(decode_paths(doubled, "doc", 18, VERTEX_LABELS))
    distinct = distinct_paths(good)
    return distinct.select("o_orderkey", path_length(F.col("path")).alias("length"))


def decoded_path_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split(decode_paths(path_documents(spark, sf_dir), "doc", 18, VERTEX_LABELS))
    return path_lengths(explode_path(good), ["o_orderkey"])


# --- tagged results -------------------------------------------------------------------------------------------------


def decode_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cells by their tags; a cell that does not fit is null and named."""
    text = read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("event_id") % 5 == 0, F.lit("oops")).otherwise(F.col("user_id").cast("string")).alias("user"),
        F.col("value").cast("string").alias("value"),
        (F.col("value") > 50).cast("string").alias("big"),
        F.col("event_type").alias("kind"),
    )
    tags = {"id": "long", "user": "int", "value": "double", "big": "boolean", "kind": "string"}
    decoded = decode_result(text, tags)
    return decoded.withColumn("bad_cells", F.array_join("bad_cells", ","))


def decode_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as JSON lists and back; every entry."""
    text = read(spark, sf_dir, "embeddings").select(
        F.col("vec_id"), F.to_json(F.col("embedding").cast("array<double>")).alias("list")
    )
    decoded = decode_result(text, {"list": "CruxType:List<double>"})
    return decoded.select("vec_id", F.posexplode("list").alias("pos", "value"))


def decode_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' property objects as maps, and a map with number keys."""
    text = read(spark, sf_dir, "events").select(
        "event_id",
        F.col("props").alias("named"),
        F.to_json(F.create_map(F.col("event_id").cast("string"), F.array("user_id", "user_id"))).alias("numbered"),
    )
    decoded = decode_result(text, {"named": "CruxType:Map<string,long>", "numbered": "CruxType:Map<long,CruxType:List<long>>"})
    return decoded.select(
        "event_id",
        F.try_element_at("named", F.lit("k")).alias("k"),
        F.map_keys("numbered")[0].alias("key"),
        F.try_element_at("numbered", F.col("event_id"))[1].alias("user"),
    )


def decode_result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole result: number, float, edge, list of vertices, path, and a map of lists per row. Numbers, edges, lists and paths
    are spoiled in some rows; paths have one, three or five elements."""
    customer = F.to_json(_vertex_document("Customer", F.concat(F.lit("c"), "o_custkey"), F.col("start")))
    order = F.to_json(_vertex_document("Order", F.concat(F.lit("o"), "o_orderkey"), F.col("end")))
    edge, k = F.to_json(_placed_document()), F.col("o_orderkey")
    longest = F.when(k % 4 == 1, F.concat_ws(",", customer, edge, order)).when(k % 4 == 2, F.concat_ws(",", customer, edge, order, edge, order))
    path = F.concat(F.lit("["), F.coalesce(longest, customer), F.lit("]"))
    documents = _edge_keys(spark, sf_dir).select(
        F.when(k % 7 == 0, "many").otherwise(k.cast("string")).alias("n"),
        F.concat((k % 100).cast("string"), F.lit(".5")).alias("x"),
        F.when(k % 7 == 1, F.lit("{}")).when(k % 7 == 2, F.lit(None)).otherwise(edge).alias("f"),
        F.when(k % 7 == 3, F.lit("17")).otherwise(F.concat(F.lit("["), order, F.lit("]"))).alias("l"),
        F.when(k % 7 == 4, F.regexp_replace(path, '"entityKey"', '"key"')).otherwise(path).alias("p"),
        F.concat(F.lit('{"a":['), k.cast("string"), F.lit("],\"b\":[1,2]}")).alias("m"),
        F.col("o_orderkey").alias("o"),
    )
    tags = {"n": "long", "x": "float", "f": "GraphRelation", "l": "CruxType:List<CruxType:Node>", "p": "CruxType:Path"}
    tags["m"] = "CruxType:Map<string,CruxType:List<long>>"
    decoded = decode_result(documents, tags, 18, VERTEX_LABELS)
    return decoded.select(
        *("o", "n"),
        F.col("x").cast("double").alias("x"),
        F.col("f.src.uid").alias("src_uid"),
        F.col("f.dst.label").alias("dst_label"),
        F.col("l")[0]["uid"].alias("uid"),
        path_length(F.col("p")).alias("length"),
        F.get("p", F.size("p") - 1)["vertex"]["uid"].alias("last"),
        F.col("m")["a"][0].alias("m"),
        F.array_join("bad_cells", ",").alias("bad"),
    )


_EDGE_SQL = """SELECT o_orderkey, 'PLACED' AS label, {euid} AS euid, 'Customer' AS src_label, {src} AS src_uid,
                      'Order' AS dst_label, 'o' || o_orderkey AS dst_uid, o_totalprice, {names} AS names FROM orders"""

QUERIES = {
    "key_decode_v18": (
        key_decode_v18,
        """WITH k AS (SELECT c_custkey, c_custkey % 4096 AS s, c_custkey * 1000003 + 255 AS i FROM customer),
           p AS (SELECT *, CAST(s AS HUGEINT) * 4503599627370496 + 1099511627776 + i AS packed FROM k)
           SELECT c_custkey, array_to_string(list_transform([56, 48, 40, 32, 24, 16, 8, 0], lambda b:
                    CASE WHEN (packed >> b) & 255 > 127 THEN ((packed >> b) & 255) - 256 ELSE (packed >> b) & 255 END), ' ') AS rk,
                  s AS shard_id, CAST(1 AS BIGINT) AS label_index, i AS inner_id FROM p""",
    ),
    "key_shard_report": (
        key_shard_report,
        """SELECT o_custkey % 4096 AS shard_id, o_custkey % 3 + 1 AS label_index, count(*) AS n FROM orders GROUP BY ALL""",
    ),
    "key_decode_legacy": (
        key_decode_legacy,
        """SELECT p_partkey, 'pièce ' || p_partkey AS uid, p_partkey * 37 % 65536 AS label_index,
                  CAST(strlen('pièce ' || p_partkey) + 2 AS INTEGER) AS n_bytes FROM part""",
    ),
    "edge_key_split": (
        edge_key_split,
        """SELECT o_orderkey, o_custkey % 4096 AS start_shard, o_custkey * 1000003 + 255 AS start_inner,
                  CAST(258 AS BIGINT) AS end_label, o_orderkey AS end_inner, 18 AS n_bytes FROM orders""",
    ),
    "key_to_uid": (key_to_uid, "SELECT o_orderkey, c_name AS uid FROM orders LEFT JOIN customer ON c_custkey = o_custkey"),
    "decode_vertices": (
        decode_vertex_documents,
        """SELECT c_custkey, 'Customer' AS label, 'c' || c_custkey AS uid,
                  CASE WHEN c_acctbal < 0 THEN 'debt,' || c_mktsegment ELSE '' END AS tags, c_name, c_acctbal,
                  c_nationkey AS nation, 'c_acctbal,c_name,home' AS names, 8 AS rk FROM customer""",
    ),
    "decode_rejects": (
        decode_rejects,
        """SELECT reason, count(*) AS n FROM (SELECT CASE c_custkey % 10 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'no_label'
             WHEN 2 THEN 'no_label' WHEN 3 THEN 'no_uid' WHEN 4 THEN 'no_properties' WHEN 5 THEN 'no_key' END AS reason
           FROM customer) WHERE reason IS NOT NULL GROUP BY reason""",
    ),
    "decode_edges_v18": (
        decode_edges_v18,
        _EDGE_SQL.format(
            euid="CASE WHEN o_orderkey % 2 = 0 THEN 'e' || o_orderkey ELSE '' END",
            src="'c' || o_custkey",
            names="'o_orderpriority,o_totalprice'",
        ),
    ),
    "decode_edges_legacy": (
        decode_edges_legacy,
        _EDGE_SQL.format(euid="'e'", src="'né ' || o_custkey", names="'o_totalprice'"),
    ),
    "decode_mixed_versions": (
        decode_mixed_versions,
        """WITH v AS (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 17 WHEN 1 THEN 12 WHEN 2 THEN 18 WHEN 3 THEN 19 END AS version FROM orders)
           SELECT o_orderkey, version, 'PLACED' AS label,
                  CASE WHEN version < 18 THEN 'e' WHEN o_orderkey % 2 = 0 THEN 'e' || o_orderkey ELSE '' END AS euid,
                  CASE WHEN version IS NULL THEN 'no_version' END AS reason,
                  CASE WHEN version IS NOT NULL THEN 'Customer' END AS src_label,
                  CASE WHEN version < 18 THEN 'né ' || o_custkey WHEN version >= 18 THEN 'c' || o_custkey END AS src_uid,
                  CASE WHEN version IS NOT NULL THEN 'Order' END AS dst_label,
                  CASE WHEN version IS NOT NULL THEN 'o' || o_orderkey END AS dst_uid,
                  CASE WHEN version < 18 THEN '__srcuid,o_totalprice' WHEN version >= 18 THEN 'o_orderpriority,o_totalprice' END AS names
           FROM v""",
    ),
    "decode_edge_rejects": (
        edge_rejects,
        """SELECT reason, count(*) AS n FROM (SELECT CASE o_orderkey % 7 WHEN 0 THEN 'no_start_key' WHEN 1 THEN 'no_end_key'
             WHEN 2 THEN 'no_src_uid' WHEN 3 THEN 'no_dst_uid' WHEN 4 THEN 'unknown_start_label'
             WHEN 5 THEN 'unknown_end_label' END AS reason FROM orders) WHERE reason IS NOT NULL GROUP BY reason""",
    ),
    "decode_paths": (
        decode_path_documents,
        """SELECT o_orderkey, 0 AS pos, 'vertex' AS kind, 'Customer' AS label, 'c' || o_custkey AS id, '' AS src_uid FROM orders
           UNION ALL SELECT o_orderkey, 1, 'edge', 'PLACED',
             CASE WHEN o_orderkey % 2 = 0 THEN 'e' || o_orderkey ELSE '' END, 'c' || o_custkey FROM orders
           UNION ALL SELECT o_orderkey, 2, 'vertex', 'Order', 'o' || o_orderkey, '' FROM orders""",
    ),
    "decoded_path_distinct": (decoded_path_distinct, "SELECT o_orderkey, 3 AS length FROM orders"),
    "path_lengths": (decoded_path_lengths, "SELECT o_orderkey, CAST(3 AS BIGINT) AS length FROM orders"),
    "decode_scalars": (
        decode_scalars,
        """SELECT event_id AS id, CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS INTEGER) END AS user, value,
                  value > 50 AS big, event_type AS kind, CASE WHEN event_id % 5 = 0 THEN 'user' ELSE '' END AS bad_cells
           FROM events""",
    ),
    "decode_lists": (
        decode_lists,
        """SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, CAST(embedding[pos] AS DOUBLE) AS value
           FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""",
    ),
    "decode_maps": (
        decode_maps,
        """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id AS key, user_id AS user FROM events""",
    ),
    "decode_result": (
        decode_result_table,
        """SELECT o_orderkey AS o, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS n,
                  CAST(o_orderkey % 100 AS DOUBLE) + 0.5 AS x,
                  CASE WHEN o_orderkey % 7 NOT IN (1, 2) THEN 'c' || o_custkey END AS src_uid,
                  CASE WHEN o_orderkey % 7 NOT IN (1, 2) THEN 'Order' END AS dst_label,
                  CASE WHEN o_orderkey % 7 <> 3 THEN 'o' || o_orderkey END AS uid,
                  CASE WHEN o_orderkey % 7 <> 4 THEN CASE o_orderkey % 4 WHEN 1 THEN 3 WHEN 2 THEN 5 ELSE 1 END END AS length,
                  CASE WHEN o_orderkey % 7 <> 4 THEN CASE WHEN o_orderkey % 4 IN (1, 2) THEN 'o' || o_orderkey ELSE 'c' || o_custkey END END AS last,
                  o_orderkey AS m,
                  CASE o_orderkey % 7 WHEN 0 THEN 'n' WHEN 1 THEN 'f' WHEN 3 THEN 'l' WHEN 4 THEN 'p' ELSE '' END AS bad
           FROM orders""",
    ),
}
