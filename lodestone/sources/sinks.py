"""Sinks: parquet, TSV, JSON lines, partitioned tables, contract tables with a manifest."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from lodestone.schemas import conform, contract_problems, fingerprint


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with header: `""` for an empty string, nothing for null, quotes doubled."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, escape='"', emptyValue='""', nullValue="")


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with keys in alphabetical order; null fields are left out."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """A small driver-side file on any file system Spark knows, renamed into place."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"cannot rename to {path}")


def manifest(df: DataFrame, columns: Sequence[str], operation: str, inputs: Sequence[str], rows: int | None = None) -> dict:
    """Provenance of a table: operation, inputs, row count and schema fingerprint."""
    return {"operation": operation, "inputs": sorted(inputs), "table": {"rows": df.count() if rows is None else rows, "columns": list(columns), "schema_fingerprint": fingerprint(columns)}}


def write_contract_table(df: DataFrame, path: str, columns: Sequence[str], operation: str, inputs: Sequence[str] = (), order_by: Sequence[str] = ()) -> dict:
    """A table in its contract's columns as TSV, sorted if asked, with a manifest beside it."""
    spark = df.sparkSession
    out = conform(df, columns)
    if problems := contract_problems(out, columns):
        raise ValueError(f"{operation}: {problems}")
    write_tsv(out.orderBy(*order_by) if order_by else out, path)
    rows = spark.read.csv(path, sep="\t", header=True, escape='"', multiLine=True).count()
    info = manifest(out, columns, operation, inputs, rows)
    write_text_file(spark, f"{path}.manifest.json", json.dumps(info, indent=1, sort_keys=True))
    return info


def write_bundle(rows: DataFrame, path: str, counts: Mapping[str, int]) -> None:
    """A training bundle: candidates as JSON lines and a manifest with their counts and hash."""
    from lodestone.sources.store import tree_hash

    write_jsonl(rows, os.path.join(path, "candidates.jsonl"))
    spark = rows.sparkSession
    info = {"counts": dict(sorted(counts.items())), "candidates": tree_hash(spark, os.path.join(path, "candidates.jsonl"))}
    write_text_file(spark, os.path.join(path, "manifest.json"), json.dumps(info, indent=1, sort_keys=True))
