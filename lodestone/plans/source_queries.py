"""Queries for the file sources: tables are written as the files the readers expect, packed and read back.

Each batch of rows becomes one archive (bounded by the batch), with awkward but valid forms: nested
ZIPs, gzip, Windows-1252 lines, trailing separators, old key names, header spellings, two XML dialects.
"""

from __future__ import annotations

import gzip
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from lodestone.functions import scalars as S
from lodestone.operators import textmine as T
from lodestone.plans import products
from lodestone.plans.reference_queries import _collapse, _key, _strip
from lodestone.registry import query
from lodestone.runtime import table
from lodestone.sources import files as X
from lodestone.sources import labels as L
from lodestone.sources import listings

_AMBIGUOUS = re.compile(rb"[\xc2-\xf4][\x80-\xbf]")


def _bytes_of(line: str) -> bytes:
    """The line in Windows-1252 if it can be told from UTF-8, else in UTF-8."""
    try:
        raw = line.encode("cp1252")
    except UnicodeEncodeError:
        return line.encode()
    return line.encode() if _AMBIGUOUS.search(raw) else raw


def _zipped(members: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def _packed(rows: DataFrame, members: Callable[[list[dict]], list[tuple[str, bytes]]], nested: bool = True) -> DataFrame:
    """`(path, name, content)`: one archive of the members made of each batch of rows, within another if nested."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, b in enumerate(batches):
            if b.num_rows:
                data = _zipped(members(b.to_pylist()))
                data = _zipped([("inner.zip", data)]) if nested else data
                yield pa.RecordBatch.from_arrays([pa.array([f"/{part}/{i}.zip"]), pa.array([f"{i}.zip"]), pa.array([data], pa.binary())], names=["path", "name", "content"])

    return rows.mapInArrow(run, X.FILE)


def _report_files(family: str, columns: tuple[str, ...]) -> Callable[[list[dict]], list[tuple[str, bytes]]]:
    """A file per quarter: upper-case header, separators at the end of lines, the key under its old name in every second quarter."""

    def members(rows: list[dict]) -> list[tuple[str, bytes]]:
        by: dict[str, list[bytes]] = {}
        for r in rows:
            quarter = r.pop("quarter")
            head = ["ISR" if c == "primaryid" and quarter[3:] in ("1", "3") else c.upper() for c in columns]
            by.setdefault(quarter, [("$".join(head) + "$").encode()]).append(_bytes_of("$".join(f" {r[c]}\t" for c in columns) + "$"))
        return [(f"ascii/{family}{q}.txt", b"\r\n".join(lines) + b"\r\n") for q, lines in by.items()]

    return members


_LINE = "translate(coalesce({0}, ''), '$' || chr(13) || chr(10) || chr(9), '    ')"
_FAMILY_COLUMNS = {
    "DEMO": {"primaryid": "primaryid", "caseid": "caseid", "occp_cod": "occp_cod", "reporter_country": "reporter_country"},
    "DRUG": {"primaryid": "primaryid", "drug_seq": "drug_seq", "drugname": "drugname", "role_cod": "role_cod", "nda_num": "nda_raw", "prod_ai": "ingredient"},
    "INDI": {"primaryid": "primaryid", "indi_drug_seq": "indi_drug_seq", "indi_pt": "indication"},
}


def _report(family: str) -> None:
    columns = _FAMILY_COLUMNS[family]
    cells = {c: _strip(_LINE.format(of)) for c, of in columns.items()}
    keys = ["primaryid", *X.RECORD_KEYS.get(family, ())]
    record = f"substr(sha256('ascii/{family}' || quarter || '.txt'), 1, 12) || " + " || ".join(f"':' || {cells[k]}" for k in keys)

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "cases").where("quarter is not null").select("quarter", *[F.translate(S.text(F.col(of)), "$\r\n\t", "    ").alias(c) for c, of in columns.items()])
        parsed = X.parse_delimited(X.lines_of(X.expand_archives(_packed(rows, _report_files(family, tuple(columns))), depth=3)))
        return X.report_family(parsed, family, list(columns)).drop("row_no")

    read.__name__ = f"report_files_{family.lower()}"
    query(f"SELECT quarter, 'ascii/{family}' || quarter || '.txt' AS source_file, {record} AS source_record_id, {', '.join(f'{x} AS {c}' for c, x in cells.items())} FROM cases WHERE quarter IS NOT NULL")(read)


for _family in _FAMILY_COLUMNS:
    _report(_family)


# Headers as product files spell them, and the columns they come from.
_PRODUCT_HEADERS = {
    "﻿Application Number": "appl_no_raw", "ApplType": "appl_type", "Appl_No": "appl_no", "ProductNo": "product_no", "Proprietary Name": "drug_name", "ActiveIngredient": "active_ingredient", "DOSAGEFORMNAME": "form",
    "RouteName": "route", "Strength": "strength", "ReferenceDrug": "reference_drug", "Reference_Standard": "reference_standard", "ProductNDC": "product_ndc", "MarketingStatusDescription": "marketing_status_name",
}


def _product_files(rows: list[dict]) -> list[tuple[str, bytes]]:
    """Product and submission files; submissions name the number only, as their type is inherited."""
    lines = ["\t".join(_PRODUCT_HEADERS)] + ["\t".join(r[c] for c in _PRODUCT_HEADERS.values()) for r in rows]
    subs = ["ApplNo\tSubmissionType\tSubmissionNo\tSubmissionsPublicNotes"] + [f"{r['appl_no_stripped']}\tORIG\t{r['product_row_id']}\tcafé “{r['drug_name']}”" for r in rows]
    join = lambda own: b"\n".join([own[0].encode(), *map(_bytes_of, own[1:])])
    return [("x/Products.txt", join(lines)), ("x/Submissions.txt", join(subs)), ("x/readme.txt", b"no table")]


def _product_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    cells = dict.fromkeys([*_PRODUCT_HEADERS.values(), "appl_no_stripped"])
    rows = table(spark, sf_dir, "drugsfda_products").select(*[F.translate(S.text(F.col(c)), "\r\n\t", "   ").alias(c) for c in cells], F.col("product_row_id").cast("string").alias("product_row_id"))
    return products.product_tables(X.expand_archives(_packed(rows, _product_files, nested=False)))


_TSV = lambda c: _strip(f"translate(coalesce({c}, ''), chr(13) || chr(10) || chr(9), '   ')")
_PLAIN = [c for c in _PRODUCT_HEADERS.values() if c not in ("appl_no_raw", "appl_type", "appl_no")]
_NUMBERED = f"""
WITH p AS (SELECT product_row_id, {_TSV('appl_no_raw')} AS r, upper({_TSV('appl_type')}) AS own, regexp_replace({_TSV('appl_no')}, '[^0-9]+', '', 'g') AS other, {', '.join(f'{_TSV(c)} AS {c}' for c in _PLAIN)} FROM drugsfda_products),
q AS (SELECT *, CASE WHEN own <> '' THEN own ELSE upper(regexp_extract(r, '(?i)^(ANDA|NDA|BLA)\\s*([0-9]+)', 1)) END AS k, regexp_extract(r, '(?i)^(ANDA|NDA|BLA)\\s*([0-9]+)', 2) AS t, regexp_replace(r, '[^0-9]+', '', 'g') AS d FROM p),
n AS (SELECT *, CASE WHEN t <> '' THEN t WHEN d <> '' THEN d ELSE other END AS n FROM q),
t AS (SELECT *, k || n AS appl_no_raw, k AS appl_type, n AS appl_no, CASE WHEN regexp_replace(n, '^0+', '') <> '' THEN regexp_replace(n, '^0+', '') ELSE n END AS appl_no_stripped FROM n)
"""


@query(_NUMBERED + f"""SELECT appl_no_raw, appl_type, appl_no, appl_no_stripped, {', '.join(_PLAIN)}, 'x/Products.txt' AS source_file,
  CASE WHEN appl_no_stripped <> '' THEN 'drugsfda:product:' || appl_type || appl_no_stripped || ':' || CASE WHEN product_no <> '' THEN product_no ELSE 'NA' END ELSE '' END AS source_record_id FROM t""")
def product_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a number have ids by their place in the file, which the SQL does not know: they show as blank."""
    p = _product_tables(spark, sf_dir)["products"]
    return p.select("appl_no_raw", "appl_type", "appl_no", "appl_no_stripped", *_PLAIN, "source_file", F.when(F.col("appl_no_stripped") != "", F.col("source_record_id")).otherwise("").alias("source_record_id"))


@query(_NUMBERED + f""", e AS (SELECT appl_no, appl_no_stripped, appl_type, unnest([{{'t': 'proprietary_name', 'v': drug_name}}, {{'t': 'nonproprietary_name', 'v': active_ingredient}}, {{'t': 'product_ndc', 'v': product_ndc}}, {{'t': 'marketing_status', 'v': marketing_status_name}}]
  || list_transform(string_split(active_ingredient, ';'), lambda x: {{'t': 'ingredient', 'v': x}})) AS s FROM t WHERE appl_no_stripped <> '')
SELECT DISTINCT s.t AS lookup_type, lower({_strip('s.v')}) AS term, appl_no_stripped FROM e WHERE {_strip('s.v')} <> ''""")
def product_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _product_tables(spark, sf_dir)["lookups"].select("lookup_type", F.lower("term").alias("term"), "appl_no_stripped")


@query(_NUMBERED + f""", b AS (SELECT appl_no_stripped, count(DISTINCT appl_type) AS kinds, min(appl_type) AS appl_type FROM t WHERE appl_type <> '' AND appl_no_stripped <> '' GROUP BY ALL)
SELECT s.product_row_id::VARCHAR AS submission_no, CASE WHEN b.kinds > 1 THEN 'several' ELSE coalesce(b.appl_type, '') END AS appl_type, 'café “' || translate(coalesce(s.drug_name, ''), chr(13) || chr(10) || chr(9), '   ') || '”' AS submission_notes
FROM drugsfda_products s LEFT JOIN b ON b.appl_no_stripped = regexp_replace(regexp_replace(coalesce(s.appl_no_stripped, ''), '[^0-9]+', '', 'g'), '^0+', '')""")
def submission_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types that submissions inherit; a number with products of several types shows as such."""
    t = _product_tables(spark, sf_dir)
    kinds = t["products"].where("appl_type <> '' and appl_no_stripped <> ''").groupBy("appl_no_stripped").agg(F.count_distinct("appl_type").alias("kinds"))
    s = t["submissions"].join(kinds, "appl_no_stripped", "left")
    return s.select("submission_no", F.when(F.col("kinds") > 1, "several").otherwise(F.col("appl_type")).alias("appl_type"), "submission_notes")


_ILLEGAL = "[^\t\n\r -퟿-�\U00010000-\U0010ffff]"


def _label_files(rows: list[dict]) -> list[tuple[str, bytes]]:
    """Even documents in the plain dialect, odd ones in the namespaced one (gzip)."""
    plain, standard = [], []
    for r in rows:
        text, number = escape(re.sub(_ILLEGAL, " ", r["text"])), str(r["doc_id"])
        a = lambda c: quoteattr(re.sub(_ILLEGAL, " ", r[c]))
        if r["doc_id"] % 2 == 0:
            plain.append(
                f"<document><setId> {escape(r['spl_set_id'])} </setId><approval code='{number}' type='NDA'/><inactiveIngredient name='Lactose' unii='J2B2A4N98G'/>"
                f"<activeIngredient name={a('source')} unii={a('lang')}/><section loinc={a('loinc_code')}><title>T {number}</title> <b>{text}</b></section></document>"
            )
        else:
            code = f"<code code={a('loinc_code')} codeSystem='{L.LOINC_OID}'/>" if r["loinc_code"] else ""
            standard.append(
                f"<document><setId root={a('spl_set_id')}/><approval><id extension='{number}' root='{L.APPLICATION_OID}'/><code code='NDA' codeSystem='{L.APPLICATION_CODES}'/></approval>"
                f"<ingredient classCode='IACT'><ingredientSubstance><code code='J2B2A4N98G'/><name>Lactose</name></ingredientSubstance></ingredient>"
                f"<activeMoiety><activeMoiety><code code={a('lang')}/><name>{escape(re.sub(_ILLEGAL, ' ', r['source']))}</name></activeMoiety></activeMoiety>"
                f"<component><section>{code}<title>T {number}</title><text> {text}</text></section></component></document>"
            )
    return [("prescription/plain.xml", ("<labels>" + "".join(plain) + "</labels>").encode()), ("prescription/standard.xml.gz", gzip.compress(f"<labels xmlns='{L.HL7_NAMESPACE.decode()}'>{''.join(standard)}</labels>".encode()))]


def _label_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    d = table(spark, sf_dir, "documents").select("doc_id", *[S.text(F.col(c)).alias(c) for c in ("spl_set_id", "loinc_code", "source", "lang", "text")])
    return L.label_tables(L.label_documents(X.expand_archives(_packed(d, _label_files), depth=3)))


_XML = lambda c: "regexp_replace(coalesce({}, ''), '[^\\t\\n\\r -\\x{{d7ff}}\\x{{e000}}-\\x{{fffd}}\\x{{10000}}-\\x{{10ffff}}]', ' ', 'g')".format(c)
_NAMES = "CASE coalesce(loinc_code, '') " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.SECTION_NAMES.items()) + " ELSE coalesce(loinc_code, '') END"
_SET = f"CASE WHEN doc_id % 2 = 0 THEN {_strip('spl_set_id')} ELSE lower({_strip('spl_set_id')}) END"
_BODY = _collapse(f"'T ' || doc_id || ' ' || {_XML('text')}")


@query(f"SELECT {_SET} AS spl_set_id, {_SET} || CASE WHEN coalesce(loinc_code, '') <> '' THEN '#' || loinc_code ELSE '' END AS spl_document_id, coalesce(loinc_code, '') AS loinc_code, {_NAMES} AS section_name, 'T ' || doc_id AS section_title, {_BODY} AS clean_text FROM documents")
def label_file_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_tables(spark, sf_dir)["spl_sections"].select("spl_set_id", "spl_document_id", "loinc_code", "section_name", "section_title", "clean_text")


@query(f"SELECT {_SET} AS spl_set_id, doc_id::VARCHAR AS approval_id, doc_id::VARCHAR AS approval_code, 'NDA' AS approval_type FROM documents")
def label_file_approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_tables(spark, sf_dir)["spl_approvals"].select("spl_set_id", "approval_id", "approval_code", "approval_type")


_UNII = "CASE WHEN coalesce(lang, '') <> '' THEN 'UNII:' || lang ELSE '' END"


@query(f"""SELECT {_SET} AS spl_set_id, 'active' AS role, {_strip('source')} AS ingredient_name, {_UNII} AS ingredient_unii, 0::INTEGER AS at FROM documents WHERE doc_id % 2 = 0 OR {_strip('source')} <> ''
UNION ALL SELECT {_SET}, 'inactive', 'Lactose', 'UNII:J2B2A4N98G', CASE WHEN doc_id % 2 = 0 OR {_strip('source')} <> '' THEN 1 ELSE 0 END FROM documents""")
def label_file_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_tables(spark, sf_dir)["spl_ingredients"].select("spl_set_id", "role", "ingredient_name", "ingredient_unii", "at")


@query(f"SELECT {_SET} AS spl_set_id, count(*) AS documents FROM documents WHERE {_strip('spl_set_id')} <> '' GROUP BY ALL")
def label_file_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_tables(spark, sf_dir)["spl_sets"].groupBy("spl_set_id").agg(F.count(F.lit(1)).alias("documents"))


_FILE = "CASE WHEN doc_id % 2 = 0 THEN 'prescription/plain.xml' ELSE 'prescription/standard.xml.gz' END"


@query(f"""SELECT {_SET} || CASE WHEN coalesce(loinc_code, '') <> '' THEN '#' || loinc_code ELSE '' END AS spl_document_id, {_SET} AS spl_set_id, {_FILE} AS xml_path, {_FILE} AS release_file, doc_id::VARCHAR AS approval_code, 'NDA' AS approval_type,
  coalesce(loinc_code, '') AS loinc_code, {_NAMES} AS section_name, {_BODY} AS section_text, {_strip('source')} AS active_ingredient_name, CASE WHEN doc_id % 2 = 0 OR {_strip('source')} <> '' THEN {_UNII} ELSE '' END AS active_ingredient_unii FROM documents""")
def label_file_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_tables(spark, sf_dir)["spl_documents"]


@query("SELECT DISTINCT quarter, 'https://host/x/faers_ascii_20' || substr(quarter, 1, 2) || 'q' || substr(quarter, 4, 1) || '.zip' AS url FROM cases WHERE quarter IS NOT NULL ORDER BY quarter DESC LIMIT 3")
def index_page_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters linked in an index page, the three newest."""
    href = F.concat(F.lit("<a class='z' HREF = \"/x/faers_ascii_20"), F.substring("quarter", 1, 2), F.lit("q"), F.substring("quarter", 4, 1), F.lit(".zip\">zip</a> <a href='faers_xml_2020q1.zip'>"))
    pages = table(spark, sf_dir, "cases").where("quarter is not null").select("quarter").distinct().select(href.alias("html"))
    return listings.newest(listings.discover_quarters(pages, base_url="https://host"), 3)


@query("SELECT (r - 1)::INTEGER AS at, 'https://host/' || n_name || '.zip' AS url FROM (SELECT n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS r FROM nation)")
def release_page_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives linked behind a heading, each once and in page order; links before it do not count."""
    link = F.concat(F.lit("<a href='https://host/"), "n_name", F.lit(".zip'>x</a>"))
    pages = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(link)), " ").alias("links"))
    html = F.concat(F.lit("<a href='https://host/old.zip'>o</a><h2>Full Releases</h2>"), "links", "links")
    return listings.release_archives(pages.select(html.alias("html")), "Full Releases")


@query("SELECT o_orderkey, o_orderdate > TIMESTAMP '2001-08-01' - INTERVAL 7 DAY AS fresh FROM orders")
def fresh_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", listings.is_fresh(F.col("o_orderdate"), F.lit("2001-08-01").cast("timestamp")).alias("fresh"))
