"""Product, application and submission tables from their source files, with lookups and warnings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.operators import relational as R
from lodestone.sources import files as X


def _numbered(rows: DataFrame) -> DataFrame:
    parts = S.application_parts(F.col("appl_no_raw"), F.col("appl_type"), F.col("appl_no"))
    cleaned = rows.select(*[S.stripped(F.col(c)).alias(c) if c not in ("row_no", "appl_no_raw", "appl_type", "appl_no") else F.col(c) for c in rows.columns])
    return cleaned.withColumn("__p", parts).drop("appl_no_raw", "appl_type", "appl_no").select("*", "__p.*").drop("__p").withColumnRenamed("name", "source_file")


def product_tables(members: DataFrame) -> dict[str, DataFrame]:
    """products, applications, submissions, lookups and warnings of source files `(path, name, content)`.

    Submissions carry no type of their own: they take it from products, then applications. Row numbers
    in ids count from 2, as the header is row 1.
    """
    lines = X.lines_of(members.where(X.table_key(F.col("name")).isNotNull()))
    parsed = X.parse_delimited(lines, "\t").withColumn("row_no", F.col("row_no") + 1)
    of = lambda key, aliases: _numbered(X.canonical_columns(parsed.where(X.table_key(F.col("name")) == key), aliases))
    products, applications, submissions = of("products", X.PRODUCT_ALIASES), of("applications", X.APPLICATION_ALIASES), of("submissions", X.SUBMISSION_ALIASES)
    products = products.withColumn("source_record_id", S.product_record_id(F.col("appl_type"), F.col("appl_no_stripped"), F.col("product_no"), F.col("product_ndc"), F.col("row_no")))
    applications = applications.withColumn("source_record_id", S.record_id("application", F.col("appl_type"), F.col("appl_no_stripped"), F.col("row_no")))
    submissions = R.inherited(submissions, "appl_no_stripped", "appl_type", [products, applications]).withColumn("appl_no_raw", F.concat("appl_type", "appl_no"))
    submissions = submissions.withColumn("source_record_id", S.record_id("submission", F.col("appl_type"), F.col("appl_no_stripped"), F.col("row_no"), F.col("submission_no")))
    lost = [
        t.where("appl_no = ''").select(F.lit(k).alias("table"), "source_file", F.concat(F.lit("row "), F.col("row_no").cast("string"), F.lit(": missing application number")).alias("message"))
        for k, t in (("products", products), ("applications", applications), ("submissions", submissions))
    ]
    return {"products": products, "applications": applications, "submissions": submissions, "lookups": R.typed_lookups(products, ["source_file", "row_no"]), "warnings": R.union_all(lost)}
