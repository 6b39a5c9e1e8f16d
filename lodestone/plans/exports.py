"""Exports: training candidates, node and edge tables, hand-off configurations and reports."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.operators import relational as R
from lodestone.sources.sinks import write_text_file, write_tsv

# Tasks of section codes, and of case indications.
TASKS = {"34067-9": "indication", "34070-3": "contraindication"}
CASE_TASK = "observed_use"


def label_candidates(sections: DataFrame, family: str = "labels") -> DataFrame:
    """Training rows of label sections by task; blank texts and other sections go."""
    tasks = F.create_map(*[F.lit(x) for kv in TASKS.items() for x in kv])
    rows = sections.select(
        S.stripped(F.coalesce(F.nullif(S.stripped(F.col("clean_text")), F.lit("")), F.col("raw_text"))).alias("text"), tasks[F.col("loinc_code")].alias("task"), F.lit(family).alias("source_family"),
        S.text(F.col("spl_document_id")).alias("source_document_id"), S.text(F.col("loinc_code")).alias("source_section"), F.lit("").alias("source_record_id"), S.label_url(F.col("spl_document_id")).alias("source_uri"),
    )
    return rows.where("task is not null and text <> ''")


def case_candidates(cases: DataFrame, family: str = "reports") -> DataFrame:
    """Training rows of case indications; placeholders go."""
    rows = cases.select(
        S.stripped(F.col("indication")).alias("text"), F.lit(CASE_TASK).alias("task"), F.lit(family).alias("source_family"), F.lit("").alias("source_document_id"), F.lit("").alias("source_section"),
        S.text(F.col("source_record_id")).alias("source_record_id"), F.coalesce(S.quarter_url(F.col("quarter")), F.lit("")).alias("source_uri"),
    )
    return rows.where("text <> ''").where(~S.is_placeholder(F.col("text")))


def deduplicated(rows: DataFrame) -> DataFrame:
    """One row per task and text (case and white space aside): the first by family, ids, uri and text."""
    keyed = rows.withColumn("__key", S.dedupe_key(F.col("text")))
    return R.keep_first(keyed, ["task", "__key"], ["source_family", "source_document_id", "source_section", "source_record_id", "source_uri", "text"]).drop("__key")


# Columns of the node and edge tables, in the order other programs read.
NODE_COLUMNS = ("id", "name", "category")
EDGE_COLUMNS = ("id", "subject", "predicate", "object", "subject_name", "object_name", "object_modifier", "knowledge_level", "agent_type", "approval", "N_cases", "supporting_spls")


def export_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes as flat cells, NA for what is missing; of several categories the first."""
    return nodes.select(S.filled(F.col("id")).alias("id"), S.filled(F.col("name")).alias("name"), S.first_cell(F.col("category")).alias("category"))


def export_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges as flat cells with the names of their ends: the node's, for ends without a node the edge's own mention, else NA.

    Lists (approval_ids, has_evidence) are joined by commas; columns that the edges lack give NA. The
    modifier is always NA. Of a repeated node the first non-blank name by alphabet counts.
    """
    names = nodes.where(S.stripped(F.col("id")) != "").groupBy(S.stripped(F.col("id")).alias("id")).agg(F.min(F.when(S.stripped(F.col("name")) != "", S.stripped(F.col("name")))).alias("n"))
    e = edges.withColumns({"__s": S.stripped(F.col("subject")), "__o": S.stripped(F.col("object"))})
    for end in ("__s", "__o"):
        e = e.join(names.select(F.col("id").alias(end), F.coalesce("n", F.lit("NA")).alias(f"{end}_name")), end, "left")
    kind = dict(edges.dtypes)
    said = lambda end: S.filled(F.col(f"original_{end}")) if f"original_{end}" in kind else F.lit("NA")
    cell = lambda c: S.filled(F.col(c)) if c in kind else F.lit("NA")
    cells = lambda c: S.joined_cell(F.col(c)) if kind.get(c, "").startswith("array") else cell(c)
    return e.select(
        cell("id").alias("id"), cell("subject").alias("subject"), cell("predicate").alias("predicate"), cell("object").alias("object"), F.coalesce("__s_name", said("subject")).alias("subject_name"),
        F.coalesce("__o_name", said("object")).alias("object_name"), F.lit("NA").alias("object_modifier"), cell("knowledge_level").alias("knowledge_level"), cell("agent_type").alias("agent_type"),
        cells("approval_ids").alias("approval"), cell("evidence_count").alias("N_cases"), cells("has_evidence").alias("supporting_spls"),
    )


def write_graph_tables(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    write_tsv(export_nodes(nodes), f"{path}/nodes.tsv")
    write_tsv(export_edges(edges, nodes), f"{path}/edges.tsv")


def table_config(table: str, path: str, columns: Sequence[str], predicate: str, lists: Sequence[str] = (), nullable: Sequence[str] = (), allowed: Mapping[str, Sequence[str]] | None = None, universe: Sequence[str] = ()) -> str:
    """A YAML description of a table for a downstream compiler: column letters, list columns, categories to avoid."""
    letters = {c: S.column_letters(i) for i, c in enumerate(columns)}
    q = json.dumps
    out = ["table: " + q(table), "path: " + q(path), "predicate: " + q(predicate), "columns:"]
    for c in columns:
        out.append(f"  {c}:\n    column: {letters[c]}")
        out += [f'    split_by: "|"'] * (c in lists) + ["    nullable: true"] * (c in nullable)  # noqa: F541
    for end, names in sorted((allowed or {}).items()):
        out.append(f"{end}_avoid: [" + ", ".join(q(x) for x in S.avoid_list(names, universe)) + "]")
    return "\n".join(out) + "\n"


def hand_off(spark: SparkSession, configs: Mapping[str, str], path: str, reason: str = "no resolver is configured") -> dict:
    """Writes the configurations and a report that the compilation is deferred."""
    for name, text in sorted(configs.items()):
        write_text_file(spark, f"{path}/{name}.yaml", text)
    report = {"status": "deferred", "reason": reason, "configs": sorted(configs)}
    write_text_file(spark, f"{path}/report.json", json.dumps(report, indent=1, sort_keys=True))
    return report


def build_summary(spark: SparkSession, tables: Mapping[str, int], problems: Mapping[str, int], path: str) -> dict:
    """Writes the summary of a build: rows per table and problems per code."""
    info = {"tables": dict(sorted(tables.items())), "problems": dict(sorted(problems.items())), "ok": not problems}
    write_text_file(spark, path, json.dumps(info, indent=1, sort_keys=True))
    return info
