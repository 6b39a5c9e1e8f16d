"""Files as tables: archives, encoding repair, `$`- and tab-delimited extracts, tables by suffix.

A file is read as `(path, name, content)` rows of Spark's binaryFile source; archives become the same
rows, one per member, so every reader takes loose files and members alike. Large plain files should
go through `delimited_files`, which Spark splits by blocks.
"""

from __future__ import annotations

import gzip
import io
import re
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.schemas import conform

FILE = "path string, name string, content binary"
REPORT_FAMILIES = ("DEMO", "DRUG", "INDI", "REAC", "RPSR", "DELETE")
# The id columns after the primary id in a row's record id, by family.
RECORD_KEYS = {"DRUG": ("drug_seq",), "INDI": ("indi_drug_seq", "indi_pt"), "REAC": ("pt",)}
# Canonical columns and the folded source names they may come under.
PRODUCT_ALIASES = {
    "appl_no_raw": ("applicationnumber",), "appl_type": ("appltype", "applicationtype"), "appl_no": ("applno",), "product_no": ("productno",),
    "drug_name": ("drugname", "proprietaryname"), "active_ingredient": ("activeingredient", "nonproprietaryname"), "form": ("form", "dosageformname"),
    "route": ("route", "routename"), "strength": ("strength",), "reference_drug": ("referencedrug",), "reference_standard": ("referencestandard",),
    "product_ndc": ("productndc",), "marketing_status_name": ("marketingstatusname", "marketingstatusdescription"),
}
APPLICATION_ALIASES = {
    "appl_no_raw": ("applicationnumber",), "appl_type": ("appltype",), "appl_no": ("applno",), "sponsor_name": ("sponsorname", "labelername"),
    "common_or_original_name": ("commonororiginalname",), "submission_classification": ("submissionclassification",), "orphan_status": ("orphanstatus",),
}
SUBMISSION_ALIASES = {
    "appl_no_raw": ("applicationnumber",), "appl_type": ("appltype",), "appl_no": ("applno",), "submission_type": ("submissiontype",), "submission_no": ("submissionno",),
    "submission_status": ("submissionstatus",), "submission_status_date": ("submissionstatusdate",), "submission_notes": ("submissionspublicnotes",),
}


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files without a byte, which Spark's scan passes over; lists the folder on the driver."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found, at = [], root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    while at.hasNext():
        status = at.next()
        if status.getLen() == 0 and not status.getPath().getName().startswith(("_", ".")):
            found.append(status.getPath().toString())
    return found


def files(spark: SparkSession, path: str, pattern: str | None = None, with_empty: bool = False) -> DataFrame:
    """`(path, name, content)` of the files under a path, those without content only if asked for."""
    if with_empty:
        none = spark.createDataFrame([(p, p.rpartition("/")[2], b"") for p in empty_files(spark, path)], FILE)
        return files(spark, path, pattern).unionByName(none)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def _members(name: str, data: bytes, depth: int) -> Iterator[tuple[str, bytes]]:
    if name.lower().endswith(".zip") and depth:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for info in z.infolist():
                if not info.is_dir():
                    yield from _members(info.filename, z.read(info), depth - 1)
    else:
        yield name, data


def expand_archives(rows: DataFrame, depth: int = 2) -> DataFrame:
    """Archive rows as one row per member, archives within archives too (to `depth`); others as they are.

    A damaged archive gives one row with null content, so that it shows up instead of failing the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("content", pa.binary())])
        for b in batches:
            for path, name, data in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    for member, content in _members(name, data, depth):  # one member at a time in memory
                        yield pa.RecordBatch.from_pylist([{"path": path, "name": member, "content": content}], schema=schema)
                except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError):
                    yield pa.RecordBatch.from_pylist([{"path": path, "name": name, "content": None}], schema=schema)

    return rows.select("path", "name", "content").mapInArrow(run, FILE)


def repaired_text(data: bytes) -> str:
    """Text of bytes: valid UTF-8 stays, other bytes are read as Windows-1252, its five gaps as U+FFFD."""
    out, rest = [], data
    while rest:
        try:
            out.append(rest.decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(rest[: e.start].decode("utf-8"))
            out.append(rest[e.start : e.end].decode("cp1252", "replace"))
            rest = rest[e.end :]
    return "".join(out)


def lines_of(rows: DataFrame) -> DataFrame:
    """`(path, name, row_no, line)` with encoding repaired, gzip undone and a byte-order mark dropped; row_no from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, name, data in zip(*(c.to_pylist() for c in b.columns)):
                if data and data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                text = repaired_text(data or b"").removeprefix("﻿")
                lines = re.split("\r\n|\n|\r", text)
                if lines and not lines[-1]:
                    lines.pop()
                for at in range(0, len(lines), 50_000):
                    part = lines[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(part)), pa.array([name] * len(part)), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.string())],
                        names=["path", "name", "row_no", "line"],
                    )

    return rows.select("path", "name", "content").mapInArrow(run, "path string, name string, row_no bigint, line string")


def family_and_quarter(name: F.Column) -> tuple[F.Column, F.Column]:
    """Family and quarter `YYQn` in an extract's file name; null where there is none."""
    base = F.upper(F.element_at(F.split(name, "/"), -1))
    family = F.regexp_extract(base, "^(" + "|".join(REPORT_FAMILIES) + ")", 1)
    year, quarter = F.regexp_extract(base, r"(\d{2})Q([1-4])", 1), F.regexp_extract(base, r"(\d{2})Q([1-4])", 2)
    return F.when(family != "", family), F.when(year != "", F.concat(year, F.lit("Q"), quarter))


def parse_delimited(lines: DataFrame, sep: str = "$") -> DataFrame:
    """`(name, row_no, cells map<string, string>)` of delimited lines: header names in lower case, cells trimmed.

    There is no quoting. Cells beyond the header are dropped, missing ones absent; columns without a
    name (a trailing separator) go. The first line of each file is its header.
    """
    cut = lambda c: F.transform(F.split(c, re.escape(sep), -1), S.stripped)
    head = lines.where("row_no = 0").select("path", "name", F.transform(cut("line"), lambda x: F.lower(x)).alias("head"))
    # a file name repeats as often as it has lines, headers are few: join on the pair, AQE picks the side
    body = lines.where("row_no > 0").select("path", "name", "row_no", cut("line").alias("cells")).join(head, ["path", "name"])
    width = F.least(F.size("head"), F.size("cells"))
    pairs = F.arrays_zip(F.slice("head", F.lit(1), width).alias("k"), F.slice("cells", F.lit(1), width).alias("v"))
    named = F.filter(pairs, lambda p: p["k"] != "")
    first = F.filter(named, lambda p, i: (i == 0) | ~F.array_contains(F.transform(F.slice(named, F.lit(1), F.greatest(i, F.lit(1))), lambda q: q["k"]), p["k"]))
    return body.select("path", "name", "row_no", F.map_from_entries(first).alias("cells"))


def report_family(parsed: DataFrame, family: str, columns: Sequence[str]) -> DataFrame:
    """A family's rows with provenance: quarter, source_file, source_record_id, then its columns.

    The key may come as `isr`; rows of files without any key column are left out (see
    extract_warnings). Absent columns are blank.
    """
    fam, quarter = family_and_quarter(F.col("name"))
    rows = parsed.where(fam == family).withColumn("quarter", quarter)
    cell = lambda c: F.coalesce(F.col("cells")[c], F.lit(""))
    key = F.coalesce(F.col("cells")["primaryid"], F.col("cells")["isr"])
    rows = rows.where(key.isNotNull())
    file_id = F.substring(F.sha2(F.col("name"), 256), 1, 12)
    record = S.joined_id(file_id, key, *[cell(k) for k in RECORD_KEYS.get(family, ())])
    return rows.select("quarter", F.col("name").alias("source_file"), record.alias("source_record_id"), "row_no", *[(key if c == "primaryid" else cell(c)).alias(c) for c in columns])


def extract_warnings(lines: DataFrame, members: DataFrame) -> DataFrame:
    """`(quarter, family, code, message, count)` of files without rows (empty_file) or without a key column.

    members lists the files themselves, as one without any byte has no lines.
    """
    fam, quarter = family_and_quarter(F.col("name"))
    seen = lines.groupBy("path", "name").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("row_no") == 0, F.lower("line"))).alias("head"))
    per = members.select("path", "name").where(fam.isNotNull()).join(seen, ["path", "name"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    keyed = F.col("head").rlike(r"(^|\$)\s*(primaryid|isr)\s*(\$|$)")
    code = F.when(F.col("n") < 2, "empty_file").when(~keyed, "missing_primaryid")
    found = per.select(quarter.alias("quarter"), fam.alias("family"), code.alias("code")).where("code is not null")
    message = F.when(F.col("code") == "empty_file", "no data rows").otherwise("no primaryid or isr column")
    return found.groupBy("quarter", "family", "code").agg(F.count(F.lit(1)).alias("count")).select("quarter", "family", "code", message.alias("message"), "count")


def delimited_files(spark: SparkSession, path: str, sep: str = "$") -> DataFrame:
    """Plain delimited files that share a header, read by Spark in splits: all strings, trimmed, names in lower case."""
    df = spark.read.csv(path, sep=sep, header=True, quote="", inferSchema=False, mode="PERMISSIVE", enforceSchema=False)
    keep = [c for c in df.columns if c.strip() and not re.fullmatch(r"_c\d+", c)]
    return df.select(*[S.stripped(F.col(f"`{c}`")).alias(c.strip().lower()) for c in keep], F.col("_metadata.file_name").alias("source_file"))


def fold_name(name: str) -> str:
    """A header without case, blanks, underscores and byte-order mark."""
    return re.sub(r"[\s_﻿]+", "", name).lower()


def canonical_columns(parsed: DataFrame, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """Parsed cells under canonical names; the first alias by listing that a row has wins, others are blank."""
    folded = F.transform_keys("cells", lambda k, _: F.regexp_replace(F.lower(k), "[\\s_﻿]+", ""))
    rows = parsed.withColumn("folded", folded)
    return rows.select("name", "row_no", *[F.coalesce(*[F.col("folded")[a] for a in names], F.lit("")).alias(c) for c, names in aliases.items()])


def table_key(name: F.Column) -> F.Column:
    """products, applications or submissions by the end of a file's stem; null for other tables."""
    stem = F.lower(F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", ""))
    return F.when(stem.rlike("products$|^product$"), "products").when(stem.rlike("applications$|^application$"), "applications").when(stem.rlike("submissions$|^submission$"), "submissions")


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table by its suffix: parquet, TSV (all strings), JSON lines (gzip too); conformed if columns are given."""
    low = path.lower()
    if low.endswith((".tsv", ".tsv.gz")):
        df = spark.read.csv(path, sep="\t", header=True, inferSchema=False, escape='"', emptyValue="")
    elif re.search(r"\.(jsonl|ndjson|json)(\.gz)?$", low):
        df = spark.read.json(path)
    else:
        df = spark.read.parquet(path)
    return conform(df, columns) if columns else df


def find_table(spark: SparkSession, root: str, name: str) -> str | None:
    """Path of a table below a folder: a global parquet before `quarter=` partitions, TSV last; null if none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    for pattern in (f"{name}.parquet", f"quarter=*/{name}.parquet", f"{name}.tsv"):
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(base, pattern))
        if found:
            return f"{root}/{pattern}"
    return None
