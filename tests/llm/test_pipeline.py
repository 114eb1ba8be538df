"""The pipeline's stages, each against brute force on its own input, and the registered queries against their SQL."""

from __future__ import annotations

import re

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from propgraph.llm import quality, simhash_dedup
from propgraph.llm.common import read, stored, words_of
from propgraph.llm.queries import QUERIES
from tests.compare import compare, connect
from tests.llm.helpers import classes, documents, sentence

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The documents before and after each stage."""
    docs, out = read(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, sf_dir), "stage")
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "pack"]
    for name, (before, after) in stages.items():
        assert before.columns == COLUMNS
        if name != "pack":
            assert after.columns == COLUMNS
            assert set(ids(after)) <= set(ids(before)) and len(ids(after)) == len(set(ids(after)))


def test_quality(spark, sf_dir, stages):
    before, after = stages["quality"]
    model = quality.train(before, read(spark, sf_dir, "labels"))
    stats = quality.statistics()
    rows = before.select("doc_id", *(c.alias(f"s_{n}") for n, c in stats.items())).collect()
    scores = model.score_rows(np.array([[r[f"s_{n}"] for n in stats] for r in rows]))
    assert ids(after) == sorted(r.doc_id for r, s in zip(rows, scores, strict=True) if s >= 0.3)


def test_exact(stages):
    before, after = stages["exact_dedup"]
    first = {}
    for r in before.collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        first[key] = min(r.doc_id, first.get(key, r.doc_id))
    assert ids(after) == sorted(first.values())


def test_near_copies(stages):
    """Fingerprints of three-word shingles, linked at three bits or fewer: the smallest id of every group stays."""
    before, after = stages["near_dedup"]
    prints = {r.doc_id: simhash_dedup.simhash(r.text) for r in before.collect()}
    group = classes(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert ids(after) == sorted(d for d, first in group.items() if d == first)


def test_decontaminated(spark, sf_dir, stages):
    before, after = stages["decontaminate"]
    items = [f" {' '.join(words_of(r.text))} " for r in read(spark, sf_dir, "benchmark").collect()]
    clean = [r.doc_id for r in before.collect() if not any(i in f" {' '.join(words_of(r.text))} " for i in items)]
    assert ids(after) == sorted(clean)


def test_all_that_is_kept_is_packed(stages):
    before, after = stages["pack"]
    tokens = {}
    for r in after.collect():
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
        assert r.length <= 1024
    assert sorted(tokens) == ids(before)


def test_run(spark, sf_dir, stages):
    total = corpus_pipeline.run(spark, sf_dir).groupBy("doc_id").sum("length").collect()
    assert sorted(r[0] for r in total) == ids(stages["pack"][0])


def test_odd_documents_pass_every_stage(spark, sf_dir):
    """Nulls, empty and very long texts, repeated rows, rows without id, clashing columns; then no documents at all."""
    item = read(spark, sf_dir, "benchmark").where("length(text) > 100").first().text
    rows = [(1, None), (2, ""), (3, "a" * 100_000), (None, "no id here"), (None, "no id here"), (None, item), (4, item)]
    rows += [(5, sentence(1, 50)), (5, sentence(1, 50)), (6, sentence(1, 50)), (7, sentence(2, 20_000))]
    docs = documents(spark, rows)
    for name in ("_score", "_text_hash", "_again", "_digest", "digest", "_statistics", "fingerprint", "component_id", "label_id", "score"):
        docs = docs.selectExpr("*", f"1 AS {name}")
    columns = docs.columns
    for given in (docs, docs.limit(0)):
        now = given
        for name, stage in corpus_pipeline.STAGES[1:]:
            now = stored(stage(spark, now, sf_dir), "odd")
            if name != "pack":
                assert now.columns == columns
            if name == "decontaminate" and given is docs:
                assert sorted((r.doc_id for r in now.collect()), key=str) == sorted([1, 3, 5, 7, None], key=str)
    assert corpus_pipeline.good_quality(spark, docs, sf_dir).columns == columns


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in QUERIES.items() if sql))
def test_sql(spark, sf_dir, name):
    result = compare(spark, connect(sf_dir), sf_dir, *QUERIES[name])
    assert not result["problems"] and result["rows"] > 0


def test_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if re.match(r"op\d+_", x)} and "pipeline" in names
