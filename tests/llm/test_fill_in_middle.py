"""Texts for filling in the middle against cuts made token by token."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from propgraph.llm import fill_in_middle as fim
from propgraph.llm import queries
from tests.llm.helpers import clashing, documents


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((one % (n + 1), two % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or three % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if four % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts(seed, count):
    choose = random.Random(seed)
    for _ in range(count):
        kind = choose.choice(["ab ", "a", "é😀 z\n\0", "<PSM> ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa .\t"])
        yield "".join(choose.choice(kind) for _ in range(choose.randint(0, 400)))


ODD = [None, "", " ", "x", "<P>", "a<M>b", "<", "<P", "S>", "<<S", "word" * 9000, "a b " * 20_000, "\n" * 300]


def test_output_and_restored(spark):
    docs = list(enumerate([*texts(1, 600), *ODD]))
    docs += [(None, "no id at all"), (None, None), (5, docs[5][1]), (-7, "minus seven")]
    made = fim.fill_in_middle(clashing(documents(spark, docs)))
    rows = made.withColumn("text", fim.restored(made.output, made.form)).collect()
    order = lambda r: str(r[:1]) + r[-1]
    assert sorted((tuple(r[:6]) for r in rows), key=order) == sorted((expected(*d) for d in docs), key=order)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    given = {(d, t or "") for d, t in docs}
    assert {(r.doc_id, r.text) for r in rows} == given
    assert fim.fill_in_middle(documents(spark, [])).count() == 0
    plain = fim.fill_in_middle(documents(spark, docs), plain_percent=100).select("form").distinct().collect()
    assert [r.form for r in plain] == ["plain"]


def test_query(spark, tmp_path):
    docs = list(enumerate(texts(3, 100)))
    documents(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {(*e[:5], sha(e[5]), sha(t)) for e, t in ((expected(*d), d[1]) for d in docs)}
    assert {tuple(r) for r in queries.op13_fill_in_middle(spark, str(tmp_path)).collect()} == want


@pytest.mark.parametrize("epsilon", [0, 1, 3, 100])
def test_rank_index(epsilon):
    choose = np.random.default_rng(epsilon)
    for size in (1, 2, 3, 257, 5000):
        for steps in (np.ones(size, int), choose.integers(1, 20, size), (choose.pareto(1.0, size) * 3).astype(int) + 1):
            offsets = np.concatenate([[0], np.cumsum(steps)])
            index = fim.fit(offsets, epsilon)
            assert [index.offset(r) for r in range(len(offsets))] == offsets.tolist()
            assert np.abs(index.residual.astype(int)).max() <= epsilon + 1
            assert index.residual.dtype == np.int8
            assert len(index.first) <= len(offsets)
    assert len(fim.fit(np.arange(0, 30_000, 3), epsilon).first) == 1
