"""Toxicity, quality and language: held-out accuracy, equal scores with and without Spark, and odd rows."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from propgraph.llm import langid, quality, toxicity
from propgraph.llm.common import first_per_group, held_out, known_labels, labelled_sample, least_hashes, read, rows_of_ids
from tests.llm.helpers import clashing, documents, sentence

ODD = [(1, None), (2, ""), (3, " \n "), (None, "some text"), (4, "same"), (4, "same"), (5, "12 !?"), (6, "ab " * 60_000), (7, "x" * 150_000)]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts with a mark of toxicity, and some of poor quality."""
    docs, labels = [], []
    for i in range(500):
        toxic, poor = i % 4 == 0, i % 5 == 0
        words = (sentence(i, 8) + " ") * 9 if poor else sentence(i, 60)
        docs.append((i, words + (" zzvile kk" if toxic else " nice")))
        labels.append((i, 0 if poor else 1, int(toxic)))
    return documents(spark, docs), labelled(spark, labels)


def test_fold(spark):
    import zlib

    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_toxicity_learns(corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.score(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert all(abs(r.score - model.score(toxicity.word_codes(r.text, toxicity.Hasher()))) < 1e-12 for r in rows)
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in rows]) > 0.95


def test_a_long_text_is_pooled_as_a_whole(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, toxicity.BUCKETS**2, n) for n in (5, 40, 9, 30)] * 5
    model = toxicity.fit(texts, np.array([1.0, 0, 0, 1] * 5), epochs=2)
    long = np.concatenate(texts * 3)
    whole = model.logit(long)
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    assert model.logit(long) == pytest.approx(whole)


def test_best_cut():
    assert 1 < toxicity.best_cut(np.array([0.0, 1, 2, 3]), np.array([0.0, 0, 1, 1])) < 2
    assert toxicity.best_cut(np.array([0.0, 1]), np.array([1.0, 1])) is None


def test_rules_score_alike_in_spark_and_numpy(corpus):
    docs, labels = corpus
    model = quality.train(docs, labels)
    stats = quality.statistics()
    rows = quality.with_score(docs, model).select("*", *(c.alias(f"s_{n}") for n, c in stats.items())).collect()
    x = np.array([[r[f"s_{n}"] for n in stats] for r in rows])
    assert np.allclose(model.score_rows(x), [r.score for r in rows], atol=1e-9)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in rows]) > 0.97
    assert model.rules and all(len(rule) <= quality.DEPTH for rule in model.rules)


def test_lasso_drops_what_says_nothing():
    rng = np.random.default_rng(2)
    m = rng.integers(0, 2, (600, 12)).astype(float)
    y = (m[:, 3] > 0).astype(float)
    w, _ = quality.fit_lasso(m, y, 0.02)
    assert w[3] > 1 and (np.abs(np.delete(w, 3)) < 0.05).all()


def test_statistics_of_odd_texts(spark):
    rows = documents(spark, ODD).select(*(c.alias(n) for n, c in quality.statistics().items())).collect()
    assert all(v is not None and np.isfinite(v) for r in rows for v in r)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(11, 1, 0), (12, 1, 0)], [(None, 0, 1)]])
def test_little_to_learn_from(spark, rows):
    docs, labels = clashing(documents(spark, ODD)), labelled(spark, rows)
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(scored) == len(ODD) and all(r.score == 0.0 for r in scored)
    plain = documents(spark, ODD)
    assert all(r.score == 1.0 for r in quality.with_score(plain, quality.train(plain, labels)).collect())


def test_odd_rows(spark, corpus):
    docs, labels = corpus
    odd = clashing(documents(spark, ODD))
    ids = sorted((r[0] for r in ODD), key=str)
    scored = toxicity.score(odd, toxicity.train(*corpus)).collect()
    assert sorted((r.doc_id for r in scored), key=str) == ids
    assert len({r.score for r in scored if r.doc_id in (1, 2, 3)}) == 1
    model = quality.train(docs, labels)
    graded = quality.with_score(odd, model, "own_score").collect()
    assert sorted((r.doc_id for r in graded), key=str) == ids
    assert all(0 <= r.score <= 1 for r in scored) and all(0 <= r.own_score <= 1 for r in graded)
    empty = documents(spark, [])
    assert toxicity.score(empty, toxicity.ConvModel(prior=0.0)).count() == 0
    assert quality.with_score(empty, model).count() == 0


def test_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    profiles = langid.train(docs.selectExpr("*", "1 AS c_id", "2 AS c_lang", "3 AS place"))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.identify(docs, profiles).collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.95
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(clashing(documents(spark, ODD)), profiles).collect()}
    assert found[1] == found[2] == found[5] == ("und", 0.0)
    assert all(0 <= score <= 1 for _, score in found.values())
    assert langid.identify(documents(spark, ODD), []).where("lang_pred <> 'und'").isEmpty()
    assert langid.train(documents(spark, [])) == []


def test_ngrams_and_distance_against_plain_python(monkeypatch):
    text = "Ab  c, äb-a 3x ab"
    clean = " ab c äb a x ab "
    want: dict[str, int] = {}
    for n in (1, 2, 3):
        for i in range(len(clean) - n + 1):
            gram = clean[i : i + n]
            if gram != " ":
                want[gram] = want.get(gram, 0) + 1

    def packed(gram):
        key = 0
        for ch in gram:
            key = key << 21 | ord(ch)
        return key

    for chunk in (1 << 18, 4):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        keys, counts = langid.ngrams(text)
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == {packed(g): n for g, n in want.items()}
    order = sorted(want, key=lambda g: (-want[g], packed(g)))
    assert langid.ranked(keys, counts, 5).tolist() == [packed(g) for g in order[:5]]
    profile = np.array([[packed("ab"), 0], [packed("b"), 1], [packed("zz"), 2]])
    profile = profile[np.argsort(profile[:, 0])]
    grams = langid.ranked(keys, counts, 400)
    away = [abs({packed("ab"): 0, packed("b"): 1}[g] - i) if g in (packed("ab"), packed("b")) else langid.PROFILE for i, g in enumerate(grams.tolist())]
    assert langid.distances(grams, [("q", profile[:, 0], profile[:, 1])])[0] == pytest.approx(np.mean(away) / langid.PROFILE)


@pytest.mark.parametrize("name", ["op4_toxicity", "op6_quality", "op10_language"])
def test_queries(spark, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    docs = read(spark, sf_dir, "documents")
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(0 <= r.score <= 1 for r in rows)
    if name != "op10_language":
        cut = 0.5 if name == "op4_toxicity" else 0.3
        assert all(r.predicted == int(r.score >= cut) for r in rows)


def test_long_lines_of_symbols_and_letters(spark):
    """Patterns take a time that grows with the text, whatever is in it."""
    rows = [(1, "#" * 1_000_000 + "a"), (2, "#" * 1_000_000), (3, "=-" * 500_000 + "x y"), (4, "ab" * 500_000 + " c"), (5, "ok #### ok ##a ~~")]
    stats = quality.statistics()
    began = time.monotonic()
    found = {r.doc_id: r for r in documents(spark, rows).select("doc_id", *(c.alias(n) for n, c in stats.items())).collect()}
    assert time.monotonic() - began < 20
    assert found[1].symbol_ends == 0 and found[2].symbol_ends == 1 and found[5].symbol_ends == pytest.approx(2 / 5)


def test_sample_has_one_row_per_id(spark):
    """An id that holds a third of all rows comes to the driver once."""
    docs = documents(spark, [(1, f"text {i % 7}") for i in range(300)] + [(i, f"other {i}") for i in range(2, 600)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 600)], "doc_id long, quality int, toxic int")
    rows = labelled_sample(docs, labels, "quality", ["text"], 10_000)
    ids = [r["doc_id"] for r in rows]
    assert len(ids) == len(set(ids)) == labels.where(~held_out()).count()
    assert [r["text"] for r in rows if r["doc_id"] == 1] in ([], ["text 0"])


def test_first_per_group_like_one_window(spark):
    rows = [(i * 7919 % 1009, "ab"[i % 3 == 0]) for i in range(1009)] + [(5, None), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string")
    got = first_per_group(df, "lang", [F.xxhash64("doc_id"), F.col("doc_id")], 40, salts=4)
    window = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    want = df.withColumn("place", F.row_number().over(window)).where("place <= 40")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    known = df.where("lang IS NOT NULL")
    for most in (1, 40, 5000):
        least = least_hashes(known, "lang", "doc_id", most).select("doc_id", "lang").collect()
        place = F.row_number().over(window)
        want = known.withColumn("place", place).where(F.col("place") <= most).select("doc_id", "lang").collect()
        assert sorted(map(tuple, least)) == sorted(map(tuple, want))


def test_long_texts_are_learned_from(spark):
    """A word of long texts only decides, so they cannot have been left out."""
    choose = random.Random(8)
    words = [sentence(i, 1) for i in range(60)]
    rows, labels = [], []
    for i in range(120):
        text = choose.choices(words, k=3000)
        if i % 2:
            text[2900] = "zzverybad"
        rows.append((i, " ".join(text)))
        labels.append((i, 1, i % 2))
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, marks)).collect()}
    assert np.mean([(scores[i] >= 0.5) == bool(y) for i, _, y in labels]) > 0.9


def test_toxicity_learns_from_all_labelled_rows(spark):
    """Many times more labelled rows than one part has: words that occur in one row only are known to the model, toxic ones that
    no single part has in full are found, and the cuts are those of all rows kept for them."""
    marks = [f"zzvile{k}" for k in range(40)]
    rows = [(i, f"{sentence(i, 12)} own{i} {marks[i % 40] if i % 3 == 0 else 'nice'}") for i in range(3000)]
    docs = documents(spark, rows)
    labels = labelled(spark, [(i, 1, int(i % 3 == 0)) for i, _ in rows])
    model = toxicity.train(docs, labels, bound=400)
    hasher = toxicity.Hasher()
    known = [model.tables[0][toxicity.word_codes(f"own{i}", hasher)[0] // toxicity.BUCKETS].any() for i, _ in rows]
    # Four fifths are not held out, and four fifths of these train the network.
    assert sum(known) > 0.6 * len(rows)
    scored = toxicity.score(docs, model).collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 3 == 0) for r in scored]) > 0.95
    again = toxicity.train(docs.repartition(7), labels, bound=400)
    assert all((a == b).all() for a, b in zip(model.tables, again.tables, strict=True)) and model.shift == again.shift


def test_toxicity_in_parts_with_little_to_learn_from(spark):
    docs = documents(spark, [(i, sentence(i, 5) if i % 7 else None) for i in range(60)])
    for toxic in (0, 1):
        model = toxicity.train(docs, labelled(spark, [(i, 1, toxic) for i in range(60)]), bound=5)
        assert model.prior == toxic
    one = toxicity.train(docs, labelled(spark, [(i, 1, int(i == 6)) for i in range(60)]), bound=5)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, one).collect())


def test_learning_in_parts_moves_labelled_texts_only(spark, monkeypatch):
    """Where one text in ten has a label, the rows that are shuffled are few, and every labelled row is learned from."""
    docs = documents(spark, [(i, f"{sentence(i, 40)} own{i}") for i in range(3000)])
    labels = labelled(spark, [(i, 1, i % 20 // 10) for i in range(0, 3000, 10)])
    handed = []
    joined = toxicity.labelled_rows

    def watched(rows, known, inputs):
        handed.append(rows.count())
        return joined(rows, known, inputs)

    monkeypatch.setattr(toxicity, "labelled_rows", watched)
    monkeypatch.setattr(toxicity, "train_in_parts", lambda rows, parts: (rows.collect(), parts))
    rows, parts = toxicity.train(docs, labels, bound=50)
    want = {r.doc_id: r.toxic for r in labels.where(~held_out()).collect()}
    assert {r.doc_id: r.y for r in rows} == want and len(rows) == len(want) and parts == -(-len(want) // 50)
    assert len(want) <= handed[0] < 0.15 * 3000


def test_packed_codes_are_whole():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5000):
        codes = rng.integers(0, toxicity.BUCKETS**2, n)
        found = toxicity.unpacked(toxicity.packed(codes))
        assert found.dtype == codes.dtype and (found == codes).all()
    repeated = np.tile(rng.integers(0, toxicity.BUCKETS**2, 50), 20)
    assert len(toxicity.packed(repeated)) < len(repeated)


@pytest.mark.parametrize("most", [1, 2, 2048])
def test_rows_of_ids_keeps_every_row_of_the_ids(spark, monkeypatch, most):
    """Repeated rows and a bitmap that is too small for its ids included; rows of other ids are left out where it is not."""
    monkeypatch.setattr("propgraph.llm.common.BITMAP_ROWS", most)
    docs = clashing(documents(spark, [(i * 7919 - 9_000_000, f"text {i}") for i in range(12_000)] + [(7, None)] * 30 + [(None, "x")]))
    docs = docs.withColumns({"bit_place": F.lit(1), "bit_row": F.lit(1), "bit_marks": F.lit(b"x")})
    marks = docs.select("doc_id").where("doc_id % 4 = 0 OR doc_id = 7").distinct().withColumn("toxic", F.lit(0))
    ids = known_labels(marks, "toxic")
    n = ids.count()
    found = rows_of_ids(docs, ids, "label_id", n)
    assert found.columns == docs.columns
    wanted = docs.join(ids.withColumnRenamed("label_id", "doc_id"), "doc_id", "left_semi").select(docs.columns)
    assert wanted.count() > 2300 and wanted.exceptAll(found).isEmpty() and found.exceptAll(docs).isEmpty()
    assert found.count() < wanted.count() + (0.1 if most > 1 else 0.2) * docs.count()
    assert rows_of_ids(docs, ids.where("false"), "label_id", 0).isEmpty()


def test_counted_rows_give_the_cut_of_the_rows(spark):
    logits, y = np.array([0.0, 1, 2, 3, 1]), np.array([0.0, 0, 1, 1, 1])
    times = np.array([3, 1, 4, 2, 1])
    assert toxicity.best_cut(logits, y, times) == pytest.approx(toxicity.best_cut(np.repeat(logits, times), np.repeat(y, times)))
