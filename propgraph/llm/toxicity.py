"""Toxicity: a convolutional text classifier with hashed word embeddings, trained in numpy.

A word's embedding is the sum of a row found by the hash of the word and one found by the hash of its first letters, so that
forms of a word that training did not see are near those it saw. Filters one, two and three words wide slide over the text; each keeps its largest answer anywhere
in the text, and a logistic layer weighs these. Rows that no training text uses are zero: unknown words say nothing.

The score is shifted so that 0.5 is the best cut over all languages in a part of the training rows kept for that; besides,
a threshold is calibrated for each language on the same part.

All labelled rows outside the held-out fold are learned from. Where they are many, Spark cuts them into parts by a hash of the
id; a task trains the network on its part, the networks are averaged, and the next round starts from the average.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import known_labels, labelled_rows, labelled_sample, rows_mapper, rows_of_ids, stored, to_batch

#: Labelled rows that one task learns from; more are learned from in parts. Their texts are learned from whole.
PART_ROWS = 12_000
#: Times that the networks of the parts are averaged.
ROUNDS = 2
#: Rows of a table that are averaged at once.
BLOCK = 1 << 12
BUCKETS = 1 << 16
#: Letters of a word's beginning that have an embedding of their own.
STEM = 4
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Passes over the rows: more where there are few, up to so many steps, or words read.
EPOCHS = 8
STEPS = 2000
WORDS_READ = 20_000_000
#: Shares of words and of stems left out of a training step, and weight decay.
DROPPED = (0.5, 0.2)
DECAY = 1e-3
BATCH = 32
#: Words of a batch of more than one text, with the shorter ones filled up.
BATCH_WORDS = 1 << 16
#: Words of a text that are worked on at once.
CHUNK = 1 << 14
#: Words whose hashes a task remembers.
CACHE_WORDS = 400_000
_WORD = re.compile(r"\w+")


class Hasher(dict):
    """Word -> its two buckets, each below ``BUCKETS``, as one number."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        whole, stem = (zlib.crc32(part.encode("utf-8", "surrogatepass")) % BUCKETS for part in (word, word[:STEM]))
        self[word] = found = whole * BUCKETS + stem
        return found


def word_codes(text: str | None, hasher: Hasher) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(hasher.__getitem__, words), dtype=np.int64, count=len(words))


def packed(codes: np.ndarray) -> bytes:
    """Word codes as they are stored and shuffled; no part of a text is lost."""
    return zlib.compress(codes.astype(np.uint32).tobytes(), 1)


def unpacked(found: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(found), np.uint32).astype(np.int64)


@dataclass
class ConvModel:
    """Weights of the network; ``prior`` is the score if there is nothing to learn from."""

    prior: float | None = None
    tables: list[np.ndarray] = field(default_factory=list)  # two of (BUCKETS + 1, DIM), the last row is padding
    filters: list[np.ndarray] = field(default_factory=list)  # per width (width * DIM, FILTERS)
    biases: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    bias: float = 0.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def pooled(self, whole: np.ndarray, stem: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Largest answers (rows, filters), where each filter found its own, and the embeddings."""
        x = self.tables[0][whole] + self.tables[1][stem]
        values, places = [], []
        for width, w, b in zip(WIDTHS, self.filters, self.biases, strict=True):
            n = x.shape[1] - width + 1
            answer = sum(x[:, i : i + n] @ w[i * DIM : (i + 1) * DIM] for i in range(width)) + b
            place = answer.argmax(axis=1)
            places.append(place)
            values.append(np.maximum(np.take_along_axis(answer, place[:, None], axis=1)[:, 0], 0))
        return np.concatenate(values, axis=1), places, x

    def logit(self, codes: np.ndarray) -> float:
        """Of one whole text, in overlapping chunks: the pool over the chunks is the pool over the text."""
        edge = max(WIDTHS) - 1
        padded = np.concatenate([np.full(edge, -1), codes, np.full(edge, -1)])
        best = np.zeros(len(self.out))
        for start in range(0, max(1, len(padded) - edge), CHUNK):
            best = np.maximum(best, self.pooled(*_buckets(padded[None, start : start + CHUNK + edge]))[0][0])
        return float(best @ self.out + self.bias)

    def score(self, codes: np.ndarray) -> float:
        if self.prior is not None:
            return self.prior
        return float(1 / (1 + np.exp(-np.clip(self.logit(codes) - self.shift, -30, 30))))


def _buckets(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the two tables for word codes; -1 is padding."""
    return np.where(codes < 0, BUCKETS, codes // BUCKETS), np.where(codes < 0, BUCKETS, codes % BUCKETS)


def _padded(texts: list[np.ndarray]) -> np.ndarray:
    edge = max(WIDTHS) - 1
    out = np.full((len(texts), max(map(len, texts)) + 2 * edge), -1, dtype=np.int64)
    for row, codes in zip(out, texts, strict=True):
        row[edge : edge + len(codes)] = codes
    return out


class _Adagrad:
    def __init__(self, shape: tuple, rate: float) -> None:
        self.sums, self.rate = np.full(shape, 1e-4), rate

    def step(self, weight: np.ndarray, gradient: np.ndarray, rows=...) -> None:
        self.sums[rows] += gradient**2
        weight[rows] -= self.rate * gradient / np.sqrt(self.sums[rows])


def untrained(mean: float, random: np.random.Generator) -> ConvModel:
    """Weights to start from; ``mean`` is that of the labels."""
    return ConvModel(
        tables=[random.normal(0, 0.1, (BUCKETS + 1, DIM)) for _ in range(2)],
        filters=[random.normal(0, 0.5, (width * DIM, FILTERS)) for width in WIDTHS],
        biases=[np.full(FILTERS, 0.1) for _ in WIDTHS],
        out=random.normal(0, 0.5, FILTERS * len(WIDTHS)),
        bias=float(np.log((mean + 1e-6) / (1 - mean + 1e-6))),
    )


def seen_buckets(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each table the rows that the texts use, as a mask."""
    known = np.unique(np.concatenate(texts))
    seen = [np.zeros(BUCKETS + 1, dtype=bool) for _ in range(2)]
    for mask, bucket in zip(seen, (known // BUCKETS, known % BUCKETS), strict=True):
        mask[bucket] = True
    return seen


def fit(texts: list[np.ndarray], y: np.ndarray, epochs: int | None = None, seed: int = 1) -> ConvModel:
    """Train on word codes and labels 0 or 1, batch by batch, texts of like length together."""
    random = np.random.default_rng(seed)
    model = untrained(y.mean(), random)
    for table, seen in zip(model.tables, seen_buckets(texts), strict=True):
        table[~seen] = 0
    learn(model, steps_of(model), texts, y, y.mean(), random, epochs)
    model.tables = [t.astype(np.float32) for t in model.tables]
    return model


def steps_of(model: ConvModel) -> list[_Adagrad]:
    """The step sizes of tables, filters, biases and output layer, in this order."""
    tables = [_Adagrad(t.shape, 0.1) for t in model.tables]
    return [*tables, *(_Adagrad(w.shape, 0.03) for w in (*model.filters, *model.biases, model.out))]


def learn(
    model: ConvModel, steps: list[_Adagrad], texts: list[np.ndarray], y: np.ndarray, mean: float,
    random: np.random.Generator, epochs: int | None = None,
) -> None:
    """Train the model on further rows, and its step sizes; ``mean`` is that of all labels."""
    by_length = np.argsort([len(t) for t in texts], kind="stable")
    batches, start = [], 0
    for i, text in enumerate(by_length):
        # The longest text of a batch comes last.
        if i - start >= BATCH or (i > start and (i - start + 1) * len(texts[text]) > BATCH_WORDS):
            batches.append(by_length[start:i])
            start = i
    batches.append(by_length[start:])
    tables, filters, biases, outs = steps[:2], steps[2 : 2 + len(WIDTHS)], steps[2 + len(WIDTHS) : -1], steps[-1]
    weight = np.where(y > 0, min(4.0, max(1.0, (1 - mean) / max(mean, 1e-6) / 2)), 1.0)
    n_words = sum(len(batch) * len(texts[batch[-1]]) for batch in batches)
    for _ in range(epochs or max(EPOCHS, min(-(-STEPS // len(batches)), WORDS_READ // max(1, n_words)))):
        for chosen in random.permutation(len(batches)):
            rows = batches[chosen]
            buckets = _buckets(_padded([texts[i] for i in rows]))
            # Words and stems left out by chance: no single row of a table may carry a decision.
            for bucket, share in zip(buckets, DROPPED, strict=True):
                bucket[random.random(bucket.shape) < share] = BUCKETS
            pool, places, x = model.pooled(*buckets)
            p = 1 / (1 + np.exp(-np.clip(pool @ model.out + model.bias, -30, 30)))
            error = weight[rows] * (p - y[rows]) / len(rows)
            back = error[:, None] * model.out * (pool > 0)
            outs.step(model.out, pool.T @ error + 1e-4 * model.out)
            model.bias -= 0.1 * float(error.sum())
            touched, grads = ([], []), []
            line = np.arange(len(rows))[:, None]
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                dw = np.empty_like(model.filters[k])
                for i in range(width):
                    part = slice(i * DIM, (i + 1) * DIM)
                    seen = x[line, places[k] + i]  # rows, filters, DIM
                    dw[part] = np.einsum("bf,bfd->df", g, seen)
                    for found, bucket in zip(touched, buckets, strict=True):
                        found.append(bucket[line, places[k] + i].ravel())
                    grads.append((g[:, :, None] * model.filters[k][part].T[None]).reshape(-1, DIM))
                filters[k].step(model.filters[k], dw + 1e-4 * model.filters[k])
                biases[k].step(model.biases[k], g.sum(axis=0))
            grad = np.concatenate(grads)
            for table, step, found in zip(model.tables, tables, touched, strict=True):
                bucket = np.concatenate(found)
                real = (bucket < BUCKETS) & grad.any(axis=1)
                unique, back_to = np.unique(bucket[real], return_inverse=True)
                total = np.zeros((len(unique), DIM))
                np.add.at(total, back_to, grad[real])
                step.step(table, total + DECAY * table[unique], unique)


def best_cut(logits: np.ndarray, y: np.ndarray, counts: np.ndarray | None = None) -> float | None:
    """The logit at which both labels are equally likely, by a logistic curve through the rows; None if a label is missing.

    The curve has a small penalty on its slope, so that it also has one for labels that a cut parts completely. ``counts`` says
    how many rows each stands for.
    """
    if not len(y) or y.min() == y.max():
        return None
    center, scale = logits.mean(), logits.std() + 1e-9
    if counts is not None:
        center = np.average(logits, weights=counts)
        scale = np.sqrt(np.average((logits - center) ** 2, weights=counts)) + 1e-9
    n = np.ones(len(y)) if counts is None else counts
    x = np.c_[(logits - center) / scale, np.ones(len(y))]
    w, ridge = np.zeros(2), np.array([0.1, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.diag(ridge)
        w = w - np.linalg.solve(hessian, x.T @ (n * (p - y)) + ridge * w)
    return float(center - scale * w[1] / w[0]) if w[0] > 1e-6 else None


def train_model(texts: list[np.ndarray], y: np.ndarray, langs: list[str | None]) -> ConvModel:
    """Fit on four fifths of the rows, calibrate the cuts on the rest."""
    if not len(y):
        return ConvModel(prior=0.0)
    if y.min() == y.max():
        return ConvModel(prior=float(y[0]))
    part = np.arange(len(y)) % 5 == 0
    if y[part].min() == y[part].max() or y[~part].min() == y[~part].max():
        part[:] = False
    rest = np.flatnonzero(~part)
    model = fit([texts[i] for i in rest], y[rest])
    check = np.flatnonzero(part)
    logits = np.array([model.logit(texts[i]) for i in check])
    calibrate(model, logits, y[check], [langs[i] for i in check])
    return model


def calibrate(model: ConvModel, logits: np.ndarray, y: np.ndarray, langs: list[str | None], counts: np.ndarray | None = None) -> None:
    """Set the shift of the scores and the thresholds by language from rows that the model was not trained on."""
    cut = best_cut(logits, y, counts) if len(y) else None
    model.shift = 0.0 if cut is None else cut
    for lang in sorted({x for x in langs if x is not None}):
        own = [k for k, x in enumerate(langs) if x == lang]
        cut = best_cut(logits[own], y[own], None if counts is None else counts[own])
        if cut is not None:
            model.thresholds[lang] = float(1 / (1 + np.exp(-np.clip(cut - model.shift, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = PART_ROWS) -> ConvModel:
    """A model of ``labels[label]`` (0 or 1) from all labelled documents outside the held-out fold, in parts of about ``bound``.

    Without labels every score is 0; if only one label occurs, every score is that label. Languages serve the thresholds
    alone, never the network. Whole texts are learned from, however long, null and empty ones as texts without words.
    """
    known = known_labels(labels, label)
    n = known.count()
    if n > bound:
        # Texts without a label are not moved.
        some = rows_of_ids(docs.select("doc_id", "text", "lang"), known, "label_id", n)
        return train_in_parts(labelled_rows(some, known, ["text", "lang"]), -(-n // bound))
    rows = labelled_sample(docs, labels, label, ["text", "lang"], bound)
    hasher = Hasher()
    texts = [word_codes(row["text"], hasher) for row in rows]
    return train_model(texts, np.array([float(row["y"] > 0) for row in rows]), [row["lang"] for row in rows])


def train_in_parts(rows: DataFrame, parts: int) -> ConvModel:
    """The model of ``doc_id, y, text, lang``. Tasks train on a part each, from the same weights; these are averaged as many times
    as there are rounds. The driver sees weights, and the rows kept for the cuts as counts of hundredths of their logits."""

    def each(found: Iterator[tuple]) -> Iterator[tuple]:
        hasher = Hasher()
        for doc_id, y, text, lang in found:
            yield doc_id, int(y > 0), packed(word_codes(text, hasher)), lang

    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("codes", pa.binary()), ("lang", pa.string())])
    columns = [F.col("doc_id").cast("long"), "y", F.col("text").cast("string"), F.col("lang").cast("string")]
    coded = rows.select(*columns).mapInArrow(rows_mapper(each, schema), "doc_id long, y int, codes binary, lang string")
    place = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).cast("int")
    checked = F.pmod(F.xxhash64("doc_id", F.lit("cut")), F.lit(5)) == 0
    coded = stored(coded.withColumns({"part": place, "checked": checked}), "toxicity-rows")
    totals = {r["checked"]: r for r in coded.groupBy("checked").agg(F.count("*").alias("n"), F.sum("y").alias("s")).collect()}
    n, s = (sum(r[c] for r in totals.values()) for c in ("n", "s"))
    if s in (0, n):
        return ConvModel(prior=float(s > 0))
    if any(k not in totals or totals[k]["s"] in (0, totals[k]["n"]) for k in (True, False)):
        coded, totals = coded.withColumn("checked", F.lit(False)), {False: {"n": n, "s": s}}
    mean = totals[False]["s"] / totals[False]["n"]
    model = untrained(mean, np.random.default_rng(1))
    steps = steps_of(model)
    seen = [np.zeros(BUCKETS + 1, dtype=bool) for _ in range(2)]
    for number in range(ROUNDS):
        model, steps, seen = _round(coded.where("NOT checked"), model, steps, mean, number)
    for table, mask in zip(model.tables, seen, strict=True):
        table[~mask] = 0
    model.tables = [t.astype(np.float32) for t in model.tables]

    def logits(found: Iterator[tuple]) -> Iterator[tuple]:
        for y, codes, lang in found:
            yield y, lang, round(100 * model.logit(unpacked(codes)))

    schema = pa.schema([("y", pa.int32()), ("lang", pa.string()), ("logit", pa.int64())])
    scored = coded.where("checked").select("y", "codes", "lang").mapInArrow(rows_mapper(logits, schema), "y int, lang string, logit long")
    counts = scored.groupBy("lang", "y", "logit").count().orderBy("lang", "y", "logit").collect()
    value, y, times = (np.array([float(r[c]) for r in counts]) for c in ("logit", "y", "count"))
    calibrate(model, value / 100, y, [r["lang"] for r in counts], times)
    return model


def _weights(model: ConvModel) -> list[np.ndarray]:
    return [*model.tables, *model.filters, *model.biases, model.out]


def _round(rows: DataFrame, model: ConvModel, steps: list[_Adagrad], mean: float, number: int) -> tuple:
    """Model, step sizes and used rows of the tables after a round: means over the parts, of a table's row over those that use it."""

    def part(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        texts = [unpacked(c) for c in table["codes"].to_pylist()]
        y = np.array(table["y"].to_pylist(), dtype=float)
        key = table["part"][0].as_py()
        # A task may have several parts; each starts from the same weights.
        own, own_steps = deepcopy((model, steps))
        learn(own, own_steps, texts, y, mean, np.random.default_rng([number, key]), max(1, EPOCHS // ROUNDS))
        seen = seen_buckets(texts)
        out = []
        for i, (weight, step) in enumerate(zip(_weights(own), own_steps, strict=True)):
            used = seen[i] if i < len(seen) else np.ones(len(weight), dtype=bool)
            for start in range(0, len(weight), BLOCK):
                rows_used = np.flatnonzero(used[start : start + BLOCK]).astype(np.int32)
                if len(rows_used):
                    found = [x[start + rows_used].astype(np.float32).tobytes() for x in (weight, step.sums)]
                    out.append((i, start, key, rows_used.tobytes(), *found))
        out.append((-1, 0, key, b"", np.float32(own.bias).tobytes(), np.float32(0).tobytes()))
        return pa.Table.from_batches([to_batch(out, _STATE)])

    def averaged(table: pa.Table) -> pa.Table:
        found = table.sort_by("part").to_pylist()
        i, start = found[0]["weights"], found[0]["start"]
        if i < 0:
            values = np.float32(np.mean([np.frombuffer(r["value"], np.float32)[0] for r in found], dtype=float))
            return pa.Table.from_batches([to_batch([(i, start, 0, b"", values.tobytes(), b"")], _STATE)])
        shape = (min(BLOCK, len(_weights(model)[i]) - start), *_weights(model)[i].shape[1:])
        count, sums = np.zeros(shape[0]), [np.zeros(shape) for _ in range(2)]
        for r in found:
            used = np.frombuffer(r["used"], np.int32)
            count[used] += 1
            for total, name in zip(sums, ("value", "steps"), strict=True):
                total[used] += np.frombuffer(r[name], np.float32).reshape(len(used), *shape[1:])
        used = np.flatnonzero(count).astype(np.int32)
        times = count[used].reshape(-1, *[1] * (len(shape) - 1))
        means = [(total[used] / times).astype(np.float32).tobytes() for total in sums]
        return pa.Table.from_batches([to_batch([(i, start, 0, used.tobytes(), *means)], _STATE)])

    types = "weights int, start int, part int, used binary, value binary, steps binary"
    trained = rows.select("doc_id", "y", "codes", "part").groupBy("part").applyInArrow(part, types)
    blocks = trained.groupBy("weights", "start").applyInArrow(averaged, types).collect()
    seen = [np.zeros(BUCKETS + 1, dtype=bool) for _ in range(2)]
    for r in blocks:
        if r["weights"] < 0:
            model.bias = float(np.frombuffer(r["value"], np.float32)[0])
            continue
        weight, step = _weights(model)[r["weights"]], steps[r["weights"]]
        used = r["start"] + np.frombuffer(r["used"], np.int32)
        for target, name in ((weight, "value"), (step.sums, "steps")):
            target[used] = np.frombuffer(r[name], np.float32).reshape(len(used), *weight.shape[1:])
        if r["weights"] < len(seen):
            seen[r["weights"]][used] = True
    return model, steps, seen


_STATE = pa.schema(
    [("weights", pa.int32()), ("start", pa.int32()), ("part", pa.int32())]
    + [(name, pa.binary()) for name in ("used", "value", "steps")]
)


def score(docs: DataFrame, model: ConvModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, threshold, toxic.

    The score is that of the whole text, however long; null and empty texts have the score of a text without words. ``threshold`` is that
    of the row's language, 0.5 for null and unknown languages, and ``toxic`` whether the score reaches it. Repeated rows
    stay; other columns are not read. An empty table gives no rows.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        hasher = Hasher()
        for doc_id, text, lang in rows:
            value = model.score(word_codes(text, hasher))
            cut = model.thresholds.get(lang, model.threshold)
            yield doc_id, value, cut, value >= cut

    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("threshold", pa.float64()), ("toxic", pa.bool_())])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(
        rows_mapper(each, schema), "doc_id long, score double, threshold double, toxic boolean"
    )
