"""Graph documents and tagged results to typed tables.

A document is parsed once, with its schema declared and its free properties as a VARIANT, and taken apart with column
expressions, so a decode job is a single pass without shuffle. Bad documents never fail a job: every decoder gives a ``reason`` beside the value, and ``split`` gives the good
rows and the rejects.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.functions import keys as K
from propgraph.functions.properties import PROPERTIES_TYPE, without
from propgraph.functions.rows import compute_once
from propgraph.schema import label_column

# Names of the element documents and of the reserved properties.
LABELS, ENTITY_KEY, PROPERTIES, START_KEY, END_KEY = "labels", "entityKey", "properties", "startKey", "endKey"
UID, TAGS, SOURCE_UID, TARGET_UID = "__uid", "__tags", "__srcuid", "__dstuid"

# Result type tags.
SCALAR_TAGS = {"boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double"}
VERTEX_TAGS = ("CruxType:Node", "GraphNode")
EDGE_TAGS = ("CruxType:Relation", "GraphRelation")
PATH_TAG = "CruxType:Path"
LIST_TAG = "CruxType:List"
MAP_TAG = "CruxType:Map"

CORRUPT = "_corrupt"
DOCUMENT_TYPE = (
    f"struct<{LABELS}:array<string>,{ENTITY_KEY}:array<int>,{START_KEY}:array<int>,{END_KEY}:array<int>,"
    f"{PROPERTIES}:variant,{CORRUPT}:string>"
)
STUB_TYPE = "struct<label:string,uid:string,rk:string>"
VERTEX_TYPE = (
    "struct<label:string,uid:string,tags:array<string>,properties:map<string,variant>,"
    "entity_key:array<int>,rk:string,reason:string>"
)
EDGE_TYPE = (
    f"struct<label:string,euid:string,src:{STUB_TYPE},dst:{STUB_TYPE},tags:array<string>,"
    "properties:map<string,variant>,entity_key:array<int>,rk:string,reason:string>"
)

Labels = Mapping[int, str]
#: The schema version of documents: one for all, or a column of the table that holds each document's own.
Version = int | Column
Parts = dict[str, Column]
Step = Callable[[Parts], Parts]


def split(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects of a decode job."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def _document(text: Column, data_type: str = DOCUMENT_TYPE) -> Column:
    return F.from_json(text, data_type, {"columnNameOfCorruptRecord": CORRUPT})


def _reserved(properties: Column, name: str, data_type: str = "string") -> Column:
    return F.try_variant_get(properties, f"$.{name}", data_type)


def _take_apart(doc: Column) -> Parts:
    """The parts that all elements have. ``bad`` tells text that is not a document at all from one that lacks something."""
    properties = doc[PROPERTIES]
    return {
        "label": F.get(doc[LABELS], F.lit(0)),
        "euid": _reserved(properties, UID),
        "tags": F.coalesce(_reserved(properties, TAGS, "array<string>"), F.array().cast("array<string>")),
        "properties": F.try_variant_get(properties, "$", PROPERTIES_TYPE),
        "entity_key": doc[ENTITY_KEY],
        "missing": doc.isNull(),
        "bad": F.coalesce(
            doc[CORRUPT].isNotNull() & doc[LABELS].isNull() & doc[ENTITY_KEY].isNull() & properties.isNull(), F.lit(False)
        ),
    }


def _none() -> Column:
    return F.lit(None).cast("string")


# --- elements -------------------------------------------------------------------------------------------------------
#
# A decoder is a list of steps; each computes columns from those of the steps before. Over a table a step is one
# projection, over an array one ``transform``, so that every part of a document is taken out of it once.


def _vertex_steps() -> list[Step]:
    """A document ``doc`` to ``label, uid, tags, properties, entity_key, rk, reason``."""

    def take_apart(p: Parts) -> Parts:
        return _take_apart(p["doc"])

    def finish(p: Parts) -> Parts:
        reason = (
            F.when(p["missing"], _none())
            .when(p["bad"], "bad_json")
            .when(p["label"].isNull(), "no_label")
            .when(p["properties"].isNull(), "no_properties")
            .when(p["euid"].isNull(), "no_uid")
            .when(p["entity_key"].isNull(), "no_key")
        )
        return {
            "label": p["label"],
            "uid": p["euid"],
            "tags": F.when(~p["missing"], p["tags"]),
            "properties": without(p["properties"], UID, TAGS),
            "entity_key": p["entity_key"],
            "rk": K.key_text(p["entity_key"]),
            "reason": reason,
        }

    return [take_apart, finish]


def _edge_steps(version: Version, vertex_labels: Labels) -> list[Step]:
    """A document ``doc`` to ``label, euid, src, dst, tags, properties, entity_key, rk, reason``.

    With packed keys the endpoint ids are properties and the key bits give the label index; a legacy endpoint key holds
    both. Where the version is a column, each row is read as its own version says.
    """
    packed = version >= K.PACKED_KEYS_SINCE
    unknown = version.isNull() if isinstance(version, Column) else F.lit(False)

    def by_version(new: Callable[[], Column], old: Callable[[], Column]) -> Column:
        if isinstance(packed, Column):
            return F.when(packed, new()).when(~packed, old())
        return new() if packed else old()

    def take_apart(p: Parts) -> Parts:
        doc = p["doc"]
        return {
            **_take_apart(doc),
            "start": doc[START_KEY],
            "end": doc[END_KEY],
            "src_uid": by_version(lambda: _reserved(doc[PROPERTIES], SOURCE_UID), lambda: K.legacy_uid(doc[START_KEY])),
            "dst_uid": by_version(lambda: _reserved(doc[PROPERTIES], TARGET_UID), lambda: K.legacy_uid(doc[END_KEY])),
        }

    def read_keys(p: Parts) -> Parts:
        ends = {"src_index": p["start"], "dst_index": p["end"]}
        found = {n: by_version(lambda k=k: K.label_index(k), lambda k=k: K.legacy_label_index(k)) for n, k in ends.items()}
        return {**p, **found}

    def look_up(p: Parts) -> Parts:
        return {
            **p,
            "src_label": label_column(p["src_index"], vertex_labels),
            "dst_label": label_column(p["dst_index"], vertex_labels),
        }

    def finish(p: Parts) -> Parts:
        reason = (
            F.when(p["missing"], _none())
            .when(p["bad"], "bad_json")
            .when(p["label"].isNull(), "no_label")
            .when(p["entity_key"].isNull(), "no_key")
            .when(p["properties"].isNull(), "no_properties")
            .when(unknown, "no_version")
            .when(p["src_index"].isNull(), "no_start_key")
            .when(p["src_uid"].isNull(), "no_src_uid")
            .when(p["src_label"].isNull(), "unknown_start_label")
            .when(p["dst_index"].isNull(), "no_end_key")
            .when(p["dst_uid"].isNull(), "no_dst_uid")
            .when(p["dst_label"].isNull(), "unknown_end_label")
        )

        def stub(side: str, endpoint_key: Column) -> Column:
            return F.struct(
                p[f"{side}_label"].alias("label"), p[f"{side}_uid"].alias("uid"), K.key_text(endpoint_key).alias("rk")
            )

        return {
            "label": p["label"],
            "euid": F.when(~p["missing"], F.coalesce(p["euid"], F.lit(""))),
            "src": stub("src", K.start_key(p["entity_key"])),
            "dst": stub("dst", K.end_key(p["entity_key"])),
            "tags": F.when(~p["missing"], p["tags"]),
            "properties": by_version(
                lambda: without(p["properties"], UID, TAGS, SOURCE_UID, TARGET_UID), lambda: without(p["properties"], UID, TAGS)
            ),
            "entity_key": p["entity_key"],
            "rk": K.key_text(p["entity_key"]),
            "reason": reason,
        }

    return [take_apart, read_keys, look_up, finish]


def _over_table(df: DataFrame, column: str, steps: list[Step]) -> DataFrame:
    """Run a decoder over a text column, which its result replaces."""
    others = [c for c in df.columns if c != column]
    df = df.select(*others, _document(F.col(column)).alias("__doc"))
    parts = steps[0]({"doc": F.col("__doc")})
    df = compute_once(df, others, {f"__{name}": c for name, c in parts.items()})
    for step in steps[1:]:
        parts = step({name: F.col(f"__{name}") for name in parts})
        df = df.select(*others, *(c.alias(f"__{name}") for name, c in parts.items()))
    return df.select(*others, *(F.col(f"__{name}").alias(name) for name in parts))


def _over_array(docs: Column, steps: list[Step]) -> Column:
    """Run a decoder over an array of documents; gives an array of structs."""

    def apply(step: Step, names: list[str] | None) -> Callable[[Column], Column]:
        def one(element: Column) -> Column:
            parts = step({"doc": element} if names is None else {name: element[name] for name in names})
            found[:] = parts
            return F.struct(*(c.alias(name) for name, c in parts.items()))

        return one

    found: list[str] = []
    names = None
    for step in steps:
        docs = F.transform(docs, apply(step, names))
        names = list(found)
    return docs


def decode_vertices(df: DataFrame, column: str) -> DataFrame:
    """A column of vertex documents to vertex columns and ``reason``; other columns stay."""
    return _over_table(df, column, _vertex_steps())


def decode_edges(df: DataFrame, column: str, version: Version, vertex_labels: Labels) -> DataFrame:
    """A column of edge documents to edge columns and ``reason``; other columns stay.

    A table may mix documents of several versions if another column of it says which version each has.
    """
    return _over_table(df, column, _edge_steps(version, vertex_labels))


def vertex_array(docs: Column) -> Column:
    """An array of parsed vertex documents to an array of vertices with ``reason``."""
    return _over_array(docs, _vertex_steps())


def edge_array(docs: Column, version: Version, vertex_labels: Labels) -> Column:
    """An array of parsed edge documents to an array of edges with ``reason``."""
    return _over_array(docs, _edge_steps(version, vertex_labels))


def _take(parts: Column, odd: bool) -> Column:
    return F.filter(parts, lambda _, i: i % 2 == (1 if odd else 0))


def path_elements(parts: Column, version: Version, vertex_labels: Labels) -> Column:
    """A parsed path document, an array, to an array of ``pos, kind, vertex, edge``: even position vertex, odd edge."""
    no_edge, no_vertex = F.lit(None).cast(EDGE_TYPE).alias("edge"), F.lit(None).cast(VERTEX_TYPE).alias("vertex")

    def two(pair: Column, i: Column) -> Column:
        """A vertex and the edge after it."""
        return F.array(
            F.struct((i * 2).alias("pos"), F.lit("vertex").alias("kind"), pair["vertex"].alias("vertex"), no_edge),
            F.struct((i * 2 + 1).alias("pos"), F.lit("edge").alias("kind"), no_vertex, pair["edge"].alias("edge")),
        )

    vertices, edges = vertex_array(_take(parts, odd=False)), edge_array(_take(parts, odd=True), version, vertex_labels)
    pairs = F.arrays_zip(vertices.alias("vertex"), edges.alias("edge"))
    # The last vertex of a path has no edge after it.
    return F.slice(F.flatten(F.transform(pairs, two)), F.lit(1), F.size(parts))


def path_problem(path: Column) -> Column:
    """Why a decoded path is bad: its first element with a reason."""
    problems = F.transform(
        path,
        lambda e: F.when(e["kind"] == "vertex", _problem(e["vertex"])).otherwise(_problem(e["edge"])),
    )
    return F.get(F.filter(problems, lambda r: r.isNotNull()), F.lit(0))


def _problem(element: Column) -> Column:
    return F.when(element["label"].isNull() & element["reason"].isNull(), "no_element").otherwise(element["reason"])


def decode_paths(df: DataFrame, column: str, version: Version, vertex_labels: Labels) -> DataFrame:
    """A column of path documents to a ``path`` array and ``reason``; other columns stay."""
    others = [c for c in df.columns if c != column]
    text = F.col(column)
    parsed = df.select(
        *others,
        _document(text, f"array<{DOCUMENT_TYPE}>").alias("__parts"),
        text.isNull().alias("__missing"),
        text.rlike(r"^\s*\[").alias("__is_array"),
    )
    path = F.when(F.col("__is_array"), path_elements(F.col("__parts"), version, vertex_labels))
    flags = {c: F.col(c) for c in ("__missing", "__is_array")}
    decoded = compute_once(parsed, others, {"path": path, "__parsed": F.col("__parts").isNotNull(), **flags})
    reason = (
        F.when(F.col("__missing"), _none())
        .when(~F.col("__parsed"), "bad_json")
        .when(~F.col("__is_array"), "not_a_path")
        .otherwise(path_problem(F.col("path")))
    )
    return decoded.select(*others, "path", reason.alias("reason"))


def decode_path_elements(df: DataFrame, column: str, version: Version, vertex_labels: Labels) -> DataFrame:
    """A column of path documents to its elements, one row each: ``pos, kind, vertex, edge`` and the element's ``reason``.

    For results that are used element by element; ``decode_paths`` keeps a path in one row. Text that is no path gives one
    row with its reason.
    """
    others = [c for c in df.columns if c != column]
    text = F.col(column)
    problem = F.when(~F.col("__parsed"), "bad_json").when(~F.col("__is_array"), "not_a_path")
    parsed = df.select(
        *others, _document(text, f"array<{DOCUMENT_TYPE}>").alias("__parts"), text.rlike(r"^\s*\[").alias("__is_array")
    ).withColumn("__parsed", F.col("__parts").isNotNull() | F.col("__is_array").isNull())
    rows = parsed.select(
        *others,
        problem.alias("__problem"),
        F.posexplode_outer(F.when(F.col("__is_array"), F.col("__parts"))).alias("pos", "__doc"),
    ).where(F.col("pos").isNotNull() | F.col("__problem").isNotNull())
    keep = [*others, "__problem", "pos"]
    take_apart, *look_up, finish_edge = _edge_steps(version, vertex_labels)
    *_, finish_vertex = _vertex_steps()
    parts = take_apart({"doc": F.col("__doc")})
    rows = compute_once(rows, keep, {f"__{name}": c for name, c in parts.items()})
    for step in look_up:
        parts = step({name: F.col(f"__{name}") for name in parts})
        rows = rows.select(*keep, *(c.alias(f"__{name}") for name, c in parts.items()))
    parts = {name: F.col(f"__{name}") for name in parts}
    vertex, edge = finish_vertex(parts), finish_edge(parts)
    is_vertex = F.col("pos") % 2 == 0
    missing = F.col("pos").isNotNull() & F.col("__missing")
    return rows.select(
        *others,
        "pos",
        F.when(is_vertex, "vertex").when(~is_vertex, "edge").alias("kind"),
        F.when(is_vertex, F.struct(*(c.alias(name) for name, c in vertex.items() if name != "reason"))).alias("vertex"),
        F.when(~is_vertex, F.struct(*(c.alias(name) for name, c in edge.items() if name != "reason"))).alias("edge"),
        F.when(F.col("__problem").isNotNull(), F.col("__problem"))
        .when(missing, "no_element")
        .when(is_vertex, vertex["reason"])
        .otherwise(edge["reason"])
        .alias("reason"),
    )


def explode_path(df: DataFrame, column: str = "path") -> DataFrame:
    """Paths in long form: one row per element with ``pos, kind, vertex, edge``."""
    return df.withColumn("__element", F.explode(column)).select("*", "__element.*").drop("__element", column)


# --- results whose columns carry a type tag -------------------------------------------------------------------------


def _inner(tag: str, outer: str) -> list[str]:
    """Arguments of ``outer<A,B>``, split at the commas that are not nested."""
    text = tag[len(outer) :].strip()
    if not (text.startswith("<") and text.endswith(">")):
        raise ValueError(f"not a type tag: {tag}")
    depth, arguments = 0, [""]
    for char in text[1:-1]:
        depth += {"<": 1, ">": -1}.get(char, 0)
        if char == "," and depth == 0:
            arguments.append("")
        else:
            arguments[-1] += char
    return [a.strip() for a in arguments]


def _good(element: Column) -> Column:
    """The element, or null if it is bad."""
    return F.when(element["reason"].isNull() & element["label"].isNotNull(), element)


def _good_path(text: Column, version: int, vertex_labels: Labels) -> Column:
    """The path of a document, or null if it is bad."""
    parts = F.when(text.rlike(r"^\s*\["), _document(text, f"array<{DOCUMENT_TYPE}>"))
    paths = F.transform(F.array(parts), lambda p: path_elements(p, version, vertex_labels))
    return F.get(F.filter(paths, lambda p: p.isNotNull() & path_problem(p).isNull()), F.lit(0))


def tagged_value(value: Column, tag: str, version: int, vertex_labels: Labels) -> Column:
    """A JSON value (VARIANT) as the type its tag names; null if it does not fit."""
    if tag in SCALAR_TAGS:
        return F.try_variant_get(value, "$", SCALAR_TAGS[tag])
    if tag in VERTEX_TAGS:
        return _good(F.get(vertex_array(F.array(_document(F.to_json(value)))), F.lit(0)))
    if tag in EDGE_TAGS:
        return _good(F.get(edge_array(F.array(_document(F.to_json(value))), version, vertex_labels), F.lit(0)))
    if tag == PATH_TAG:
        return _good_path(F.to_json(value), version, vertex_labels)
    if tag.startswith(LIST_TAG):
        (entry,) = _inner(tag, LIST_TAG)
        entries = F.try_variant_get(value, "$", "array<variant>")
        documents = F.transform(entries, lambda x: _document(F.to_json(x)))
        if entry in VERTEX_TAGS:
            return F.transform(vertex_array(documents), _good)
        if entry in EDGE_TAGS:
            return F.transform(edge_array(documents, version, vertex_labels), _good)
        return F.transform(entries, lambda x: tagged_value(x, entry, version, vertex_labels))
    if tag.startswith(MAP_TAG):
        key_tag, value_tag = _inner(tag, MAP_TAG)
        entries = F.try_variant_get(value, "$", PROPERTIES_TYPE)
        values = F.transform_values(entries, lambda _, x: tagged_value(x, value_tag, version, vertex_labels))
        if key_tag not in SCALAR_TAGS:
            return values
        key_type = SCALAR_TAGS[key_tag]
        new_keys = F.transform(F.map_keys(entries), lambda k: k.try_cast(key_type))
        fits = ~F.exists(new_keys, lambda k: k.isNull()) & (F.size(F.array_distinct(new_keys)) == F.size(new_keys))
        return F.when(fits, F.map_from_arrays(new_keys, F.map_values(values)))
    return F.try_variant_get(value, "$", "string")


def tagged_column(column: Column, tag: str, version: int, vertex_labels: Labels) -> Column:
    """A result column of text cells as the type its tag names. Unknown tags pass through."""
    if tag in SCALAR_TAGS:
        return column.try_cast(SCALAR_TAGS[tag])
    if tag == PATH_TAG:
        return _good_path(column.cast("string"), version, vertex_labels)
    if tag in (*VERTEX_TAGS, *EDGE_TAGS, PATH_TAG) or tag.startswith((LIST_TAG, MAP_TAG)):
        return tagged_value(F.try_parse_json(column.cast("string")), tag, version, vertex_labels)
    return column


def decode_result(
    df: DataFrame, tags: Mapping[str, str], version: int = K.PACKED_KEYS_SINCE, vertex_labels: Labels | None = None
) -> DataFrame:
    """Decode a result table by the type tags of its columns; the tags stay in the field metadata. Without tags the table
    is returned unchanged. ``bad_cells`` lists the columns whose cell did not fit its tag (a null cell stays null)."""
    if not tags:
        return df
    labels = vertex_labels or {}
    columns = df.columns
    df = df.select("*", *(F.col(c).isNotNull().alias(f"__given_{c}") for c in tags))
    for c, tag in tags.items():
        if tag in (*VERTEX_TAGS, *EDGE_TAGS):
            df = _element_column(df, c, _vertex_steps() if tag in VERTEX_TAGS else _edge_steps(version, labels))
    rest = {c: tagged_column(F.col(c), tag, version, labels) for c, tag in tags.items() if tag not in (*VERTEX_TAGS, *EDGE_TAGS)}
    if rest:
        df = compute_once(df, [c for c in df.columns if c not in rest], rest)
    bad = F.array_compact(F.array(*(F.when(F.col(f"__given_{c}") & F.col(c).isNull(), F.lit(c)) for c in tags)))
    tagged = [F.col(c).alias(c, metadata={"graph_type": tags[c]}) if c in tags else F.col(c) for c in columns]
    return df.select(*tagged, bad.alias("bad_cells"))


def _element_column(df: DataFrame, column: str, steps: list[Step]) -> DataFrame:
    """Decode one column of element documents in place; a bad one is null."""
    others = [c for c in df.columns if c != column]
    decoded = _over_table(df.select(F.struct(*others).alias("__row"), column), column, steps)
    element = F.struct(*(c for c in decoded.columns if c != "__row"))
    return decoded.withColumn(column, _good(element)).select("__row.*", column)


def rejects_by_reason(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Number of rejected rows per reason."""
    rejected = df.where(F.col(reason).isNotNull())
    return rejected.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))

