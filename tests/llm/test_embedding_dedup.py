"""Vector groups against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from propgraph.llm import embedding_dedup as emb

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 0) for i, v in rows], schema).repartition(5)


def near(choose, vector, cosine):
    """A vector with about this cosine to a given one."""
    other = choose.standard_normal(len(vector))
    unit = vector / np.linalg.norm(vector)
    other -= other @ unit * unit
    return cosine * unit + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def expected(rows, least=0.95):
    """vec_id -> n_links and component by comparing all pairs, in double precision."""
    units = {}
    for i, v in rows:
        v = np.array([np.nan if x is None else x for x in v or []], np.float32).astype(float) if v is not None else np.empty(0)
        if len(v) and np.isfinite(v).all() and v.any():
            units[i] = v / np.linalg.norm(v)
    links = {i: 0 for i, _ in rows}
    found = {i: i for i, _ in rows}
    for size in {len(v) for v in units.values()}:
        ids = sorted(i for i, v in units.items() if len(v) == size)
        matrix = np.array([units[i] for i in ids])
        linked = matrix @ matrix.T >= least
        for i, row in zip(ids, linked):
            links[i] = int(row.sum()) - 1
        partners = {i: {ids[j] for j in np.flatnonzero(row)} for i, row in zip(ids, linked)}
        for i in ids:  # in ascending order: who is reached first from the smallest id
            reached, todo = {i}, [i] if found[i] == i else []
            while todo:
                new = partners[todo.pop()] - reached
                reached |= new
                todo += new
            for j in reached:
                found[j] = min(found[j], i)
    return {i: (links[i], found[i], found[i] == i) for i in links}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def sample(seed=2, dimensions=64):
    choose = np.random.default_rng(seed)
    rows = [(i, choose.standard_normal(dimensions)) for i in range(200)]
    for n in range(40):  # pairs and chains
        start = rows[n][1]
        for _ in range(1 + n % 3):
            start = near(choose, start, 0.99)
            rows.append((len(rows), start * 10.0 ** (n % 5)))
    center = choose.standard_normal(dimensions)
    rows += [(len(rows) + i, near(choose, center, 0.995)) for i in range(60)]
    rows += [(len(rows) + i, rows[0][1]) for i in range(150)]  # a third are copies
    choose.shuffle(numbers := np.arange(len(rows)))
    return [(int(n) * 3 - 50, v) for n, (_, v) in zip(numbers, rows)]


def test_all_links(spark):
    rows = sample()
    want = expected([(i, v.tolist()) for i, v in rows])
    assert result(emb.vector_groups(table(spark, rows))) == want
    assert sum(not kept for _, _, kept in want.values()) > 200
    # Blocks of a few vectors give the same as whole buckets, and so do further columns.
    df = table(spark, rows)
    for name in ("d0", "rep", "shard", "part", "n", "code", "vector", "n_links", "root"):
        df = df.selectExpr("*", f"'x' AS {name}")
    assert result(emb.vector_groups(df, code_block=7, vector_block=5)) == want


def test_odd_rows(spark):
    base = [1.0, 2.0, 0.0, -1.0]
    odd = [None, [], [0.0] * 4, [float("nan"), 1, 1, 1], [float("inf"), 1, 1, 1], [-0.0, 0, 0, 0]]
    rows = [(i, v) for i, v in enumerate(odd)]
    rows += [(10, base), (11, [2 * x for x in base]), (12, [1e30 * x for x in base]), (13, [1e-30 * x for x in base]), (14, base[:3]), (15, [1.0])]
    rows += [(16, [-3.0]), (17, [9.0]), (18, [-x for x in base]), (19, [-0.0, 0, 1, 0]), (20, [0.0, 0, 1, 0])]
    want = expected(rows)
    df = table(spark, rows)
    with_null = spark.createDataFrame([(30, [1.0, None, 0.0, 0.0], 0), (None, base, 0), (None, None, 0), (10, base, 0), (19, base, 1)], SCHEMA)
    got = emb.vector_groups(df.unionByName(with_null)).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert by_id.pop(None) == [(0, None, True)] * 2 and by_id.pop(30) == [(0, 30, True)]
    # Two more rows with the vector of id 10, one of them under its id, one under an id that has another vector too.
    assert by_id.pop(10) == [(5, 10, True)] * 2
    assert sorted(by_id.pop(19)) == sorted([(1, 19, True), (5, 10, False)])
    for i in (11, 12, 13):
        assert by_id.pop(i) == [(5, 10, False)]
    assert {i: [want[i]] for i in by_id} == by_id
    assert emb.vector_groups(table(spark, [])).count() == 0
    assert [tuple(r) for r in emb.vector_groups(table(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("dimensions", [16, 64, 300])
def test_recall(spark, dimensions):
    """Pairs just above the bound, each found or not by itself."""
    choose = np.random.default_rng(dimensions)
    pairs = 1000 if dimensions < 100 else 400
    rows, cosines = [], []
    for n in range(pairs):
        a = choose.standard_normal(dimensions)
        cosines.append(choose.choice([0.952, 0.97, 0.94]))
        rows += [(2 * n, a), (2 * n + 1, near(choose, a, cosines[-1]))]
    got = result(emb.vector_groups(table(spark, rows, SCHEMA.replace("float", "double"))))
    units = np.array([v / np.linalg.norm(v) for _, v in rows])
    all_pairs = np.argwhere(np.triu(units @ units.T >= 0.95, 1))
    assert sum(n for n, _, _ in got.values()) >= 0.93 * 2 * len(all_pairs)
    want = expected([(i, v.tolist()) for i, v in rows])
    assert all(n <= want[i][0] for i, (n, _, _) in got.items())


def test_estimates_are_unbiased_and_bounded():
    choose = np.random.default_rng(1)
    x = choose.standard_normal((3000, 64))
    y = np.array([near(choose, v, 0.95) for v in x])
    codes, factors = emb.coded(y, 2)
    guess = np.diag(emb.estimates(codes, factors, emb.units(x)))
    assert abs(guess.mean() - 0.95) < 0.003
    margin = emb.margins(factors, 64, 0.95, emb.CONFIDENCE)
    assert (guess + margin >= 0.95).mean() > 0.999 and margin.max() < 0.15
