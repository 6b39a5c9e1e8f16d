"""Queries of the text and entity operators (problems 1, 4, 7, 8 and 9)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, canonical, matching, truncation, winnow
from lodestone.queries import query
from lodestone.runtime import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
query = partial(query, into=QUERIES, sql_into=SQL)


@query()
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.canonical_rows(table(spark, sf_dir, "cases"), table(spark, sf_dir, "disease_terms")).select("case_row_id", F.col("code").alias("curie"))


@query()
def p1_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.unmatched_report(table(spark, sf_dir, "cases"), table(spark, sf_dir, "disease_terms"))


def _drug_matches(spark: SparkSession, sf_dir: str, sure: float = matching.SURE) -> DataFrame:
    cases, spl = table(spark, sf_dir, "cases"), table(spark, sf_dir, "spl_ingredients")
    open_cases = cases.where(F.coalesce(F.btrim("nda"), F.lit("")).rlike(r"^\s*$"))
    rows = matching.records(open_cases, "cases", "case_row_id", "drugname", "ingredient", "mfr_sndr").unionByName(
        matching.records(spl.where("role = 'active'"), "spl_ingredients", "ingredient_row_id", "product_name", "ingredient_name", "labeler_name")
    )
    return matching.match(rows, matching.targets(table(spark, sf_dir, "drugsfda_products")), sure)


@query()
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drug_matches(spark, sf_dir).select("appl_no", F.col("source").alias("source_table"), "row_id")


@query()
def p4_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every record with a candidate the most probable application, however unsure."""
    return _drug_matches(spark, sf_dir, 0.0).select("appl_no", F.col("source").alias("source_table"), "row_id", "confidence", "settled")


@query()
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, sf_dir, "documents"))


@query()
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


@query()
def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


@query()
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "documents"))


@query()
def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncation_report(table(spark, sf_dir, "documents"))
