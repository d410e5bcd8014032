"""The corpus pipeline: documents pass through five stages, each written and read again.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that the stage before it
kept. All stages but the last return the columns of documents; the last returns the mix: words of
documents, to be read by slot and offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transpark.llm.common import shared_path
from transpark.llm.decontaminate import SQL as LEAKS_SQL
from transpark.llm.decontaminate import drop_leaks
from transpark.llm.mixing import EMIT_SQL, emit, mix
from transpark.llm.neardup import components_sql, drop_near_duplicates
from transpark.llm.pii import REDACT_SQL, redact
from transpark.llm.quality import POLICIES, POLICY, keep_good
from transpark.llm.quality import SQL as QUALITY_SQL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the current policy."""
    return keep_good(docs)


def neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars follows the text."""
    return redact(docs, length="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts of the mix, a row for each piece of a document that a slot takes."""
    return emit(docs, mix(docs)[1])


STAGES = [("quality", quality), ("neardup", neardup), ("decontaminate", decontaminate), ("pii", pii), ("mixing", mixing)]


def _over(sql: str, table: str) -> str:
    """The SQL of an operator over another table than documents."""
    return sql.replace("FROM documents", f"FROM {table}")


#: The stages one after another (personal data: the kinds that its SQL states).
ORACLE_SQL = f"""
WITH q1 AS (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM ({QUALITY_SQL}) WHERE fails & {POLICIES[POLICY]} = 0)),
q2 AS (SELECT * FROM q1 WHERE doc_id IN (SELECT doc_id FROM ({_over(components_sql(5), "q1")}) WHERE kept)),
q3 AS (SELECT * FROM q2 WHERE doc_id NOT IN (SELECT doc_id FROM ({_over(LEAKS_SQL, "q2")}))),
q4 AS (SELECT q3.doc_id, q3.source, r.text FROM q3 JOIN ({_over(REDACT_SQL, "q3")}) r USING (doc_id))
SELECT * FROM ({_over(EMIT_SQL, "q4")})
"""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, with each result but the last written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
