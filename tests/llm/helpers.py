"""Small tables for the text operators, and slow versions to compare with."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (doc_id, text) or (doc_id, text, lang) as the table documents."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS).repartition(3)


def clashing(df: DataFrame) -> DataFrame:
    """The table with more columns, named as operators name their own."""
    names = "digest content keep_id kept score fp sketch component_id label y start length salt node root n _score".split()
    for name in names:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def sentence(seed: int, words: int) -> str:
    choose = random.Random(seed)
    return " ".join("".join(choose.choice("abcdefghij") for _ in range(choose.randint(2, 7))) for _ in range(words))


def classes(nodes: list, linked) -> dict:
    """Node -> smallest node of its class under the relation ``linked``, by comparing all pairs."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in parent}
