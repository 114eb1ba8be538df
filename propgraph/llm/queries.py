"""The registered queries of the text operators, each with its SQL where SQL can express it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm import (
    decontaminate,
    embedding_dedup,
    exact_dedup,
    fill_in_middle,
    html_extract,
    langid,
    licenses,
    packing,
    period_runs,
    quality,
    simhash_dedup,
    toxicity,
    warc,
)
from propgraph.llm.common import held_out, read

#: The tokenizer file of the packing query; its place is a parameter of the operator.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(TOKENIZER))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License texts and notices in all documents."""
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents."""
    return simhash_dedup.near_groups(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted, "threshold", "toxic")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that are like a benchmark item."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUALITY_CUT = 0.3


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.with_score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def op7_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""

def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = read(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    records = warc.round_trip(read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH t AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), g AS (SELECT payload_digest, min(page_id) AS first_id FROM t WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT t.page_id, t.payload_bytes, t.payload_digest,
       CASE WHEN g.first_id <> t.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first_id <> t.page_id THEN g.first_id END AS refers_to
FROM t LEFT JOIN g ON t.payload_digest = g.payload_digest AND t.payload_bytes >= 100
"""


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    docs = read(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, every tenth of them made to repeat itself."""
    found = period_runs.periodic_runs(read(spark, sf_dir, "documents"), repeat=True)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.floor(F.lit(1000) * F.col("length") / F.col("period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all vectors by cosine."""
    return embedding_dedup.vector_groups(read(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents laid out for filling in the middle, and what they were restored to."""
    made = fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    restored = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        *("doc_id", "n", "form", "prefix_chars", "middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents
), d AS (
  SELECT doc_id, x, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT doc_id, x, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT doc_id, x, n, form, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid,
         array_to_string(u[b + 1:n], '') AS suf
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM p
"""


QUERIES = {
    "op1_pack": (op1_pack, None),
    "op2_licenses": (op2_licenses, None),
    "op3_near_duplicates": (op3_near_duplicates, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_decontaminate": (op5_decontaminate, None),
    "op6_quality": (op6_quality, None),
    "op7_exact_duplicates": (op7_exact_duplicates, OP7_SQL),
    "op8_main_text": (op8_main_text, None),
    "op9_warc": (op9_warc, OP9_SQL),
    "op10_language": (op10_language, None),
    "op11_period_runs": (op11_period_runs, None),
    "op12_embedding_groups": (op12_embedding_groups, None),
    "op13_fill_in_middle": (op13_fill_in_middle, OP13_SQL),
}
