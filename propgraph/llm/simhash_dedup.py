"""Near-duplicate groups: SimHash fingerprints, linked through BK-trees.

*Fingerprints* are 64-bit SimHashes of word shingles. *Shards*: the 64 bits are cut into ``radius + agree`` blocks; two
fingerprints within the radius agree in at least ``agree`` whole blocks, so each fingerprint goes to one shard per choice
of ``agree`` blocks, named by the bits of those blocks, and every link lies inside a shard. *Trees*: each shard is a
BK-tree, children keyed by their Hamming distance to the parent; a search follows only the edges whose key is within the
radius of the distance just measured. The trees of a task are built and searched together, level by level, as arrays.
*Groups* are the connected components of the links.

Fingerprints far apart say more about short texts' common words than about copies, so with a wide radius links can be
verified: each fingerprint then carries a small MinHash sketch of the text's five-word shingles, and two texts are linked only
if the sketches also say that the texts are similar enough. That happens inside the search, so no list of pairs is made.

A tree is not sent to all executors, since the trees together grow with the corpus; it meets its queries in the task of
its shard. A shard with more than ``tree_rows`` fingerprints is cut into parts, and each pair of parts is searched in a
task of its own, so no tree outgrows a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import WordHashes, chained, rows_mapper, stored
from propgraph.llm.components import components
from propgraph.llm.exact_dedup import without_rows

BITS = 64
SEED = 42
RADIUS = 3
AGREE = 2
SHINGLE_WORDS = 3
TREE_ROWS = 20_000
#: Bins of a sketch, and words of its shingles.
BINS = 64
SKETCH_WORDS = 5
#: Fingerprints that a task looks at together, and pairs (query, node) that one search step may hold.
FOREST_ROWS = 200_000
FRONTIER = 2_000_000
#: Large shards named in a broadcast; beyond that they are joined.
BROADCAST_SHARDS = 100_000


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text as a signed 64-bit number; of a text without words it is 0."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    starts = [0]
    for token in tokens:
        starts.append(starts[-1] + len(token) + 1)
    digest = xxhash.xxh64_intdigest
    last = max(1, len(tokens) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    # A fixed number of shingles at a time: a very long text needs no more memory than its words.
    for first in range(0, last, 1 << 16):
        to = min(last, first + (1 << 16))
        if len(tokens) < words:
            hashes = [digest(line, SEED)]
        else:
            hashes = [
                digest(line[a : b - 1], SEED) for a, b in zip(starts[first:to], starts[first + words : to + words], strict=True)
            ]
        codes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(codes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<i8")[0])


def sketch(text: str | None, hasher: WordHashes) -> bytes:
    """A MinHash sketch of a text's five-word shingles: of the smallest hash in each of ``BINS`` bins four bits.

    A bin without a shingle takes those of the next bin that has one. A text of fewer words is one shingle; without words it
    is all zeros.
    """
    hashes = hasher.of((text or "").lower().split())
    if not len(hashes):
        return bytes(BINS // 2)
    runs = chained(hashes, min(SKETCH_WORDS, len(hashes)))
    least = np.full(BINS, ~np.uint64(0))
    np.minimum.at(least, (runs % np.uint64(BINS)).astype(np.int64), runs)
    full = np.flatnonzero(least != ~np.uint64(0))
    least = least[full[np.searchsorted(full, np.arange(BINS)) % len(full)]]
    nibbles = ((least // np.uint64(BINS)) & np.uint64(15)).astype(np.uint8)
    return (nibbles[::2] | (nibbles[1::2] << 4)).tobytes()


def sketch_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarities that rows of sketch bytes suggest, corrected for bins that agree by chance."""
    x = a ^ b
    equal = (((x & 15) == 0).sum(axis=-1) + ((x & 240) == 0).sum(axis=-1)) / BINS
    return (equal - 1 / 16) / (15 / 16)


def fingerprints(
    docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text", sketched: bool = False
) -> DataFrame:
    """doc_id and fp (long) of every row, and the sketch if asked for; null and wordless texts have fingerprint 0."""

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        hasher = WordHashes()
        for doc_id, text in rows:
            found = (doc_id, simhash(text, words))
            yield (*found, sketch(text, hasher)) if sketched else found

    fields = [("doc_id", pa.int64()), ("fp", pa.int64())] + ([("sketch", pa.binary())] if sketched else [])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows_mapper(each, pa.schema(fields), rows=8192), "doc_id long, fp long" + (", sketch binary" if sketched else "")
    )


def block_masks(radius: int, agree: int) -> list[int]:
    """For each choice of ``agree`` of the ``radius + agree`` blocks, the mask of their bits as a signed number."""
    blocks = radius + agree
    if radius < 0 or agree < 1 or blocks > BITS:
        raise ValueError(f"radius {radius} with {agree} equal blocks does not fit {BITS} bits")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    masks = [sum(choice) for choice in combinations(block, agree)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def bk_forest(shard_start: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One BK-tree per shard. ``shard_start[i]``: the first row of the shard of row i, its root.

    Returns the edges in order: parent * 65 + distance, and the child. All trees grow by one level a step: of the rows
    that stand at one node with one distance the first becomes the child, the others go down to it.
    """
    keys, children = [], []
    rows = np.flatnonzero(np.arange(len(fps)) != shard_start)
    at = shard_start[rows]
    while len(rows):
        key = at * (BITS + 1) + _distance(fps[rows], fps[at])
        found, first, back = np.unique(key, return_index=True, return_inverse=True)
        keys.append(found)
        children.append(rows[first])
        down = np.ones(len(rows), dtype=bool)
        down[first] = False
        at = rows[first][back][down]
        rows = rows[down]
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return key[order], child[order]


def bk_search(
    edges: tuple[np.ndarray, np.ndarray], fps: np.ndarray, queries: np.ndarray, roots: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with query > node within the radius, each query searched from its root."""
    keys, children = edges
    hits_q, hits_n = [], []
    q, node = queries, roots
    while len(q):
        d = _distance(fps[q], fps[node])
        hit = (d <= radius) & (q > node)
        hits_q.append(q[hit])
        hits_n.append(node[hit])
        base = node * (BITS + 1)
        low = np.searchsorted(keys, base + np.maximum(d - radius, 0))
        n = np.searchsorted(keys, base + np.minimum(d + radius, BITS), side="right") - low
        step = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        q, node = np.repeat(q, n), children[step]
    return np.concatenate(hits_q), np.concatenate(hits_n)


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of a[i] and b[i]; ``label`` points to the smallest row of a class."""
    while len(a):
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        open_ = high != low
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def forest_links(
    shards: np.ndarray, fps: np.ndarray, radius: int, sketches: np.ndarray | None = None, least: float = 0.0
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected inside each shard: row and smallest row of its class.

    ``shards`` are numbers in ascending order, one per row. At most one link per row comes out, however many pairs of a
    shard lie within the radius.
    """
    n = len(fps)
    first = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if n else np.empty(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    alone = np.repeat(sizes == 1, sizes)
    rows = np.flatnonzero(~alone)  # a shard of one has no pair
    if not len(rows):
        return rows, rows
    sizes = sizes[sizes > 1]
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = fps[rows]
    edges = bk_forest(starts, own)
    label = np.arange(len(rows))
    # Queries by the size of their tree, so that no search step holds more than about FRONTIER pairs.
    work = np.cumsum(np.repeat(sizes, sizes)) // FRONTIER
    for chunk in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(work)) + 1):
        a, b = bk_search(edges, own, chunk, starts[chunk], radius)
        if sketches is not None:
            like = sketch_similarity(sketches[rows[a]], sketches[rows[b]]) >= least
            a, b = a[like], b[like]
        _join_labels(label, a, b)
    moved = np.flatnonzero(label != np.arange(len(rows)))
    return rows[moved], rows[label[moved]]


def _shard_links(radius: int, least: float | None):
    """Rows (shard, part, fp) or (shard, part, fp, sketch) in order of shard and part; whole shards are looked at together,
    many at a time. Links name both ends by fingerprint, and sketch."""
    sides = ["fp"] if least is None else ["fp", "sketch"]
    types = {"fp": pa.int64(), "sketch": pa.binary()}
    schema = pa.schema([(f"{end}_{side}", types[side]) for end in "ab" for side in sides])

    def links(parts: list[list]) -> pa.RecordBatch:
        s, p, f, *sketches = (np.concatenate(x) for x in zip(*parts, strict=True))
        new = np.r_[False, (s[1:] != s[:-1]) | (p[1:] != p[:-1])]
        a, b = forest_links(np.cumsum(new), f.view(np.uint64), radius, *(sketches + [least] if sketches else []))
        columns = []
        for end in (a, b):
            columns.append(pa.array(f[end]))
            columns += [pa.array([row.tobytes() for row in x[end]], type=pa.binary()) for x in sketches]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [column.to_numpy(zero_copy_only=False) for column in batch.columns[:3]]
            if least is not None:
                now.append(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            if n >= FOREST_ROWS:
                # Everything before the last change of shard is whole.
                before = held[-1]
                changes = np.flatnonzero(
                    (now[0] != np.r_[before[0][-1], now[0][:-1]]) | (now[1] != np.r_[before[1][-1], now[1][:-1]])
                )
                if len(changes):
                    cut = changes[0]
                    yield links([*held, [x[:cut] for x in now]])
                    held, n, now = [], 0, [x[cut:] for x in now]
            held.append(now)
            n += len(now[0])
        if n:
            yield links(held)

    return mapped, schema


def near_links(
    prints: DataFrame, radius: int = RADIUS, agree: int = AGREE, tree_rows: int = TREE_ROWS, least: float | None = None
) -> DataFrame:
    """Links (a, b) among the distinct fingerprints whose components are those of all pairs within ``radius`` bits.

    ``prints`` has the column fp, and sketch if ``least`` is given; then a pair is a link only if its sketches suggest a
    similarity of at least ``least``. The ends of a link are named as ``node_of`` does. No pair is lost: see the module's text
    on shards.
    """
    masks = block_masks(radius, agree)
    own = [c for c in ("fp", "sketch") if c in prints.columns]
    choice = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks))))
    # Shards of unlike choices that share a hash would only be searched together, which finds no wrong link.
    shards = prints.select(*own, choice.alias("c")).select(F.xxhash64("c.i", "c.bits").alias("shard"), *own)
    large = stored(
        shards.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > tree_rows).select(F.col("shard").alias("hot"), "n"),
        "simhash-large",
    )
    n_large = large.count()
    if n_large:
        hint = F.broadcast(large) if n_large <= BROADCAST_SHARDS else large
        parts = F.coalesce(F.ceil(F.col("n") / tree_rows).cast("int"), F.lit(1))
        cut = shards.join(hint, F.col("shard") == F.col("hot"), "left").select("shard", *own, parts.alias("parts"))
        mine = F.pmod(F.xxhash64(*own, F.lit(1)), F.col("parts")).cast("int")
        pairs = cut.select("shard", *own, mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        low, high = F.least("mine", "other").cast("long"), F.greatest("mine", "other").cast("long")
        shards = pairs.select("shard", (low * (1 << 31) + high).alias("part"), *own)
    else:
        shards = shards.select("shard", F.lit(0).cast("long").alias("part"), *own)
    search, schema = _shard_links(radius, least)
    columns = ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'long'}" for f in schema)
    found = shards.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(search, columns)
    ends = [node_of([f"{end}_{c}" for c in own]).alias(end) for end in "ab"]
    return stored(found.select(*ends).distinct(), "simhash-links")


def node_of(columns: list[str]) -> Column:
    """The 64-bit name of a fingerprint: itself, or with a sketch the hash of both."""
    return F.col(columns[0]) if len(columns) == 1 else F.xxhash64(*columns)


def near_groups(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    agree: int = AGREE,
    tree_rows: int = TREE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Two documents are linked when their fingerprints differ in at most ``radius`` bits; component_id is the smallest id
    that can be reached over links. With ``least``, a link also needs sketches that suggest a five-word similarity of at least
    ``least``. A null, empty or wordless text has the fingerprint zero, linked like any other. A row
    with a null id is a member but names no component; one where every id is null has a null component_id. Repeated rows
    stay repeated. Other columns are not read. An empty table gives no rows.
    """
    # The table of fingerprints is read several times.
    prints = stored(fingerprints(docs, words, id_col, text_col, least is not None), "simhash-prints")
    own = ["fp"] if least is None else ["fp", "sketch"]
    distinct = stored(prints.groupBy(*own).agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(near_links(distinct.select(*own), radius, agree, tree_rows, least))
    linked = distinct.select(node_of(own).alias("name"), "first").join(roots, F.col("name") == F.col("node"), "left").select(
        "name", "first", F.coalesce("root", "name").alias("class")
    )
    # Classes are few rows beside the documents: one per distinct fingerprint. The table of ids is written, since a join that
    # shares the aggregate's partitioning could not be split where one class has very many members.
    ids = stored(linked.groupBy("class").agg(F.min("first").alias("component_id")), "simhash-ids")
    classes = linked.join(ids, "class").select("name", "component_id")
    return prints.join(classes, node_of(own) == F.col("name")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(groups: DataFrame) -> Column:
    """Whether a row of ``near_groups`` is the one of its component that stays."""
    return F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))


def drop_near_copies(docs: DataFrame, words: int, radius: int, agree: int = AGREE, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component.

    Rows without an id stay, since none of them can stand for a group. Of rows alike in id and text one stays.
    """
    groups = stored(near_groups(docs, words, radius, agree, least=least), "simhash-groups")
    repeated = groups.where(keep_one(groups) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"))
    return without_rows(docs, groups.where(~keep_one(groups)), repeated.where("n > 1").select("doc_id"))
