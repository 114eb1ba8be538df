"""Near-duplicate vectors by cosine: binary codes of randomly rotated vectors find pairs, exact cosines decide.

*Codes*: a vector of length 1 is turned by random rotations, and the code holds the signs of all coordinates. Beside it stands a
correction factor for each rotation, the inner product of the turned vector and its code as a vector of length 1. *Estimate*:
the inner product of a code and another turned vector, divided by the code's factor, has the two vectors' inner product as its
mean, and errs by about sqrt(1 - cosine^2) * sqrt(1 - factor^2) / factor / sqrt(dimensions - 1). A pair whose estimate plus
``CONFIDENCE`` times that error stays below the bound is dropped, for every other pair the cosine is computed in double precision.

*Search*, in two steps, so that few vectors move. Codes meet in buckets, one for the bits of each of ``BANDS`` bands of the
code; a vector whose code differs from another one's of its bucket in few enough bits is marked there. Then marked vectors
meet in their buckets in full length, and pairs are estimated and computed. A pair counts in the first band that it shares, so
it counts once. Equal vectors are one vector with a weight. A bucket that holds more than a block is cut into parts, and each
pair of parts is looked at in a task of its own. Tasks give off a sum and at most one link per vector and bucket, no pairs.

Of pairs with cosine 0.95, 96 % share a band, with cosine 0.98 99.8 %. Buckets grow with the corpus: beyond some 10^8 different
vectors take more bits a band, and more bands.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import stored
from propgraph.llm.components import components
from propgraph.llm.simhash_dedup import BROADCAST_SHARDS, _join_labels as join_labels

LEAST_COSINE = 0.95
BANDS, BAND_BITS = 10, 12
#: Standard deviations by which an estimate, or a count of unlike bits, may miss.
CONFIDENCE = 4.0
#: Vectors of a bucket that are looked at together, codes alone and in full length, at most. Buckets of vectors in full length,
#: which have links mostly, are cut into ever more parts before, so that a large group is the work of many tasks: a bucket of
#: n * n * ``PART`` vectors into n parts.
CODE_BLOCK, VECTOR_BLOCK, PART = 16_384, 4_096, 16
#: Pairs that a step of a task holds.
PAIRS = 1 << 21
SEED = 12


def code_words(bands: int, band_bits: int) -> int:
    """64-bit words that hold the bands; none crosses a word."""
    return -(-bands // (64 // band_bits))


@lru_cache(maxsize=8)
def rotations(dimensions: int, turns: int) -> np.ndarray:
    """Random rotations, one above the other."""
    draw = np.random.default_rng([SEED, dimensions])
    found = []
    for _ in range(turns):
        q, r = np.linalg.qr(draw.standard_normal((dimensions, dimensions)))
        found.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(found)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows as vectors of length 1, whatever their size."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors as a matrix, for each number of dimensions; rows without a direction are left out."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        matrix = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        if good.any():
            yield rows[good], matrix[good] + 0.0  # no negative zeros: equal vectors have equal bytes


def digests(matrix: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers per row that name its vector."""
    rows = np.ascontiguousarray(matrix)
    return np.frombuffer(b"".join(hashlib.blake2b(row, digest_size=16).digest() for row in rows), np.int64).reshape(-1, 2)


def coded(matrix: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes as bytes, of as many rotations as fill ``words`` words, and the factors of every rotation."""
    size = matrix.shape[1]
    turned = units(matrix) @ rotations(size, -(-64 * words // size)).T
    factors = np.abs(turned).reshape(len(turned), -1, size).sum(axis=2) / math.sqrt(size)
    return np.packbits(turned > 0, axis=1, bitorder="little"), factors


def estimates(codes: np.ndarray, factors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the inner products of coded vectors with other vectors of length 1, the mean of all rotations."""
    turns, size = factors.shape[1], others.shape[1]
    turned = others @ rotations(size, turns).T
    signs = np.unpackbits(codes, axis=1, bitorder="little")[:, : turns * size].astype(np.float64) * 2 - 1
    scale = np.repeat(1 / (factors * math.sqrt(size) * turns), size, axis=1)
    return (signs * scale) @ turned.T


def margins(factors: np.ndarray, size: int, least: float, confidence: float) -> np.ndarray:
    """By how much the estimate of a pair with cosine ``least`` may be too small."""
    spread = np.sqrt(np.maximum(1 - factors**2, 0)) / factors
    error = np.sqrt((spread**2).sum(axis=1)) / factors.shape[1] / math.sqrt(max(size - 1, 1))
    return confidence * math.sqrt(1 - least**2) * error


def unlike_bits(least: float, bits: int, confidence: float) -> int:
    """Bits in which the codes of two vectors with cosine ``least`` may differ."""
    p = math.acos(least) / math.pi
    return math.ceil(bits * p + confidence * math.sqrt(bits * p * (1 - p)))


# --- columns and tasks -----------------------------------------------------------------------------------------------


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _codes(vectors: DataFrame, words: int) -> DataFrame:
    """vec_id, size, d0, d1, the words s0, s1 ... of the code that are searched, the code and its factors, for all rows that may
    have links."""
    fields = [("vec_id", pa.int64()), ("size", pa.int32()), ("d0", pa.int64()), ("d1", pa.int64())]
    fields += [(f"s{i}", pa.int64()) for i in range(words)] + [("code", pa.binary()), ("factors", pa.binary())]
    schema = pa.schema(fields)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, matrix in matrices(batch.column(1)):
                code, factors = coded(matrix, words)
                name = digests(matrix)
                searched = np.ascontiguousarray(code[:, : 8 * words]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[rows].astype(np.int64)),
                        pa.array(np.full(len(rows), matrix.shape[1], np.int32)),
                        *(pa.array(np.ascontiguousarray(c)) for c in (name[:, 0], name[:, 1], *searched.T)),
                        pa.array([row.tobytes() for row in code], type=pa.binary()),
                        pa.array([row.tobytes() for row in factors.astype(np.float32)], type=pa.binary()),
                    ],
                    schema=schema,
                )

    columns = ", ".join(f"{f.name} { {pa.int64(): 'long', pa.int32(): 'int', pa.binary(): 'binary'}[f.type] }" for f in schema)
    return vectors.where("vec_id IS NOT NULL").mapInArrow(mapped, columns)


def _shard(bands: int, band_bits: int) -> Column:
    """The bucket of every band, as an array of numbers that name size, band and bits."""
    per_word, mask = 64 // band_bits, (1 << band_bits) - 1
    buckets = []
    for band in range(bands):
        bits = F.shiftrightunsigned(f"s{band // per_word}", band % per_word * band_bits).bitwiseAND(F.lit(mask))
        buckets.append((F.col("size").cast("long") * bands + band) * (1 << band_bits) + bits)
    return F.array(*buckets)


def _in_blocks(df: DataFrame, parts_of: Callable[[Column], Column], name: str) -> DataFrame:
    """Add ``part``, the blocks of its bucket that a row belongs to, and ``mine``, the row's own part; one row per block.
    ``parts_of`` gives the number of parts of a bucket from its number of rows."""
    counts = df.groupBy("shard").agg(F.count("*").alias("n"))
    cut_up = counts.select(F.col("shard").alias("hot"), parts_of(F.col("n")).cast("int").alias("parts")).where("parts > 1")
    large = stored(cut_up, name)
    n_large = large.count()
    if not n_large:
        return df.select("*", F.lit(0).cast("long").alias("part"), F.lit(0).alias("mine"))
    hint = F.broadcast(large) if n_large <= BROADCAST_SHARDS else large
    parts = F.coalesce("parts", F.lit(1))
    cut = df.join(hint, F.col("shard") == F.col("hot"), "left").withColumn("parts", parts)
    cut = cut.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    both = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("mine", "other").cast("long"), F.greatest("mine", "other").cast("long")
    return both.select(*df.columns, (low * (1 << 31) + high).alias("part"), "mine")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows with one shard and part, where there are two or more; the rows come in that order."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, part = (batch.column(c).to_numpy() for c in ("shard", "part"))
        edges = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), len(shard)]
        for start, end in zip(edges, edges[1:]):
            if last != (shard[start], part[start]):
                if sum(b.num_rows for b in held) > 1:
                    yield pa.Table.from_batches(held)
                held, last = [], (shard[start], part[start])
            held.append(batch.slice(start, end - start))
    if sum(b.num_rows for b in held) > 1:
        yield pa.Table.from_batches(held)


def _pairs(group: pa.Table, searched: np.ndarray, limit: int, bands: int, band_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group with at most ``limit`` unlike bits that share no earlier band, some at a time."""
    mine, n = group.column("mine").to_numpy(), group.num_rows
    band = (group.column("shard")[0].as_py() >> band_bits) % bands
    whole = mine.min() == mine.max() and group.column("part")[0].as_py() in (0, int(mine[0]) * ((1 << 31) + 1))
    per_word, mask = 64 // band_bits, np.uint64((1 << band_bits) - 1)
    step = max(1, PAIRS // n)
    for first in range(0, n, step):
        rows = np.arange(first, min(n, first + step))
        unlike = np.bitwise_count(searched[rows, None, :] ^ searched[None, :, :]).sum(axis=2, dtype=np.int32)
        near = (unlike <= limit) & (rows[:, None] < np.arange(n)[None, :])
        if not whole:
            near &= mine[rows, None] != mine[None, :]
        a, b = np.nonzero(near)
        a = rows[a]
        x = searched[a] ^ searched[b]
        new = np.ones(len(a), dtype=bool)
        for earlier in range(band):
            new &= (x[:, earlier // per_word] >> np.uint64(earlier % per_word * band_bits)) & mask != 0
        yield a[new], b[new]


def _words_of(group: pa.Table, words: int) -> np.ndarray:
    return np.stack([group.column(f"s{i}").to_numpy() for i in range(words)], axis=1).view(np.uint64)


def _marked(entries: DataFrame, words: int, limit: int, bands: int, band_bits: int) -> DataFrame:
    """(shard, rep) of the entries with a partner in their bucket."""
    schema = pa.schema([("shard", pa.int64()), ("rep", pa.int64())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            found = np.zeros(group.num_rows, dtype=bool)
            for a, b in _pairs(group, _words_of(group, words), limit, bands, band_bits):
                found[a] = found[b] = True
            if found.any():
                chosen = pa.array(np.flatnonzero(found))
                yield from group.select(["shard", "rep"]).take(chosen).cast(schema).combine_chunks().to_batches()

    return entries.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(mapped, "shard long, rep long")


def _linked(rows: DataFrame, words: int, limit: int, bands: int, band_bits: int, least: float, confidence: float) -> DataFrame:
    """(rep, d0, d1, n_links, root) of the vectors with links in a bucket: the weight of their partners, and the smallest rep of
    those that they are connected with inside it."""
    schema = pa.schema([(c, pa.int64()) for c in ("rep", "d0", "d1", "n_links", "root")])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            # Of an id with unlike vectors every vector has come with every code; a digest says which belong together.
            column = group.column("vector").combine_chunks()
            own = np.zeros(group.num_rows, dtype=bool)
            name = np.stack([group.column(c).to_numpy() for c in ("d0", "d1")], axis=1)
            for at, matrix in matrices(column):
                own[at] = (digests(matrix) == name[at]).all(axis=1)
            group = group.filter(pa.array(own)).combine_chunks()
            if group.num_rows < 2:
                continue
            rep = group.column("rep").to_numpy()
            order = np.argsort(rep, kind="stable")
            group, rep = group.take(pa.array(order)), rep[order]
            weight = group.column("n").to_numpy()
            [(_, matrix)] = matrices(group.column("vector").combine_chunks())
            unit, size = units(matrix), matrix.shape[1]
            codes = np.frombuffer(b"".join(group.column("code").to_pylist()), np.uint8).reshape(len(rep), -1)
            factors = np.frombuffer(b"".join(group.column("factors").to_pylist()), np.float32).reshape(len(rep), -1).astype(np.float64)
            margin = margins(factors, size, least, confidence)
            n_links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
            for a, b in _pairs(group, _words_of(group, words), limit, bands, band_bits):
                if not len(a):
                    continue
                from_, to = a[0], a[-1] + 1
                guess = estimates(codes[from_:to], factors[from_:to], unit)[a - from_, b]
                open_ = guess + margin[a] >= least
                a, b = a[open_], b[open_]
                cosine = np.concatenate([np.einsum("ij,ij->i", unit[a[i : i + 65536]], unit[b[i : i + 65536]]) for i in range(0, len(a), 65536)] or [np.empty(0)])
                a, b = a[cosine >= least], b[cosine >= least]
                np.add.at(n_links, a, weight[b])
                np.add.at(n_links, b, weight[a])
                join_labels(label, a, b)
            some = np.flatnonzero(n_links)
            if len(some):
                columns = [group.column(c).to_numpy()[some] for c in ("rep", "d0", "d1")] + [n_links[some], rep[label[some]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return rows.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(
        mapped, "rep long, d0 long, d1 long, n_links long, root long"
    )


def _names(vectors: DataFrame) -> DataFrame:
    """vec_id, linkable, and d0, d1, the name of the vector. A row that cannot have links has a name of its own that no vector
    has, so that such rows are not one key of a join."""
    schema = pa.schema([("vec_id", pa.int64()), ("linkable", pa.bool_()), ("d0", pa.int64()), ("d1", pa.int64())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            name = np.random.default_rng(SEED).integers(-(1 << 62), 1 << 62, (batch.num_rows, 2))
            good = np.zeros(batch.num_rows, dtype=bool)
            for rows, matrix in matrices(batch.column(1)):
                good[rows] = known[rows]
                name[rows] = digests(matrix)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(good), pa.array(name[:, 0].copy()), pa.array(name[:, 1].copy())], schema=schema
            )

    return vectors.mapInArrow(mapped, "vec_id long, linkable boolean, d0 long, d1 long")


def vector_groups(
    df: DataFrame,
    least: float = LEAST_COSINE,
    bands: int = BANDS,
    band_bits: int = BAND_BITS,
    confidence: float = CONFIDENCE,
    code_block: int = CODE_BLOCK,
    vector_block: int = VECTOR_BLOCK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links (other rows whose vectors have a cosine of at least ``least`` with its own),
    component_id (the smallest id that links reach, its own included) and kept (whether it is that id).

    Every link that is reported is exact; some pairs just above the bound are not found, see the module's text. Vectors
    that are null, empty or zero, or hold a null or a number that is not finite, have no links and stay; neither do vectors of
    unlike lengths link. A row with a null id has no links, a null component_id, and is kept. Rows that repeat id and vector
    link with each other; where an id has unlike vectors, each row has the links of its own. Vectors of any length are read
    whole; other columns are not read. An empty table gives no rows.
    """
    if not (0 < least < 1 and bands > 0 and 0 < band_bits <= 32):
        raise ValueError("least lies between 0 and 1, and a band has 1 to 32 bits")
    words = code_words(bands, band_bits)
    limit = unlike_bits(least, 64 * words, confidence)
    searched = [f"s{i}" for i in range(words)]
    vectors = _vectors(df, id_col, vector_col)
    one = [F.first(c).alias(c) for c in ("size", *searched, "code", "factors")]
    reps = _codes(vectors, words).groupBy("d0", "d1").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), *one)
    reps = stored(reps, "vector-codes")

    def code_parts(n: Column) -> Column:
        return F.ceil(n / code_block)

    def vector_parts(n: Column) -> Column:
        return F.greatest(F.ceil(n / vector_block), F.floor(F.sqrt(n / PART)))

    entries = reps.select(F.explode(_shard(bands, band_bits)).alias("shard"), "rep", *searched)
    marks = stored(_marked(_in_blocks(entries, code_parts, "vector-buckets"), words, limit, bands, band_bits).distinct(), "vector-marks")
    # Only now vectors move, those with a mark, each once per id whatever the copies.
    wanted = vectors.join(marks.select(F.col("rep").alias("vec_id")).distinct(), "vec_id", "left_semi")
    wanted = wanted.groupBy(F.col("vec_id").alias("rep"), "vector").agg(F.lit(1).alias("one")).drop("one")
    rows = _in_blocks(marks, vector_parts, "vector-blocks").join(reps, "rep").join(wanted, "rep")
    links = stored(_linked(rows, words, limit, bands, band_bits, least, confidence), "vector-links")

    roots = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    found = links.groupBy("d0", "d1").agg(F.sum("n_links").alias("found"))
    classes = reps.select("d0", "d1", "rep", "n").join(found, ["d0", "d1"], "left").join(roots, F.col("rep") == F.col("node"), "left")
    classes = classes.select("d0", "d1", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    # Written, so that the join below can be split where a vector has very many copies.
    named = _names(vectors).join(stored(classes, "vector-classes"), ["d0", "d1"], "left")
    component = F.when(F.col("linkable"), F.col("root")).otherwise(F.col("vec_id"))
    return named.select(
        "vec_id",
        F.when(F.col("linkable"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
