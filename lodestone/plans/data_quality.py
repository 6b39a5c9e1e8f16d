"""Queries on broken, nested, drifting and orphaned records (problems 2, 3, 5 and 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import drift, nested, orphans, rejects
from lodestone.registry import query
from lodestone.runtime import scratch, table


# JSON text is opened wherever a field holds it; the record is the outermost object with a set id
_ONCE = "CASE WHEN json_type({0}) = 'VARCHAR' AND json_valid({0}->>'$') AND json_type(({0}->>'$')::JSON) IN ('OBJECT', 'ARRAY', 'VARCHAR') THEN ({0}->>'$')::JSON ELSE {0} END"


def _opened(x: str) -> str:
    return _ONCE.format("(" + _ONCE.format(x) + ")")


_TAGS = "(" + ", ".join(f"'{t}'" for t in nested.LABEL_TABLES) + ")"
_AT = "CASE WHEN path = '' THEN '' ELSE path || '.' END || k"
_FIELD = """json_extract(j, '$."' || k || '"')"""
OBJECTS = f"""
WITH RECURSIVE roots AS (SELECT record_id, spl_set_id, payload::JSON AS j, 0 AS depth FROM label_records WHERE json_valid(payload)
  UNION ALL SELECT record_id, spl_set_id, {_opened('v')}, depth + 1 FROM (
    SELECT record_id, spl_set_id, depth, unnest(CASE json_type(j) WHEN 'OBJECT' THEN list_transform(json_keys(j), lambda k: {_FIELD}) ELSE j::JSON[] END) AS v
    FROM roots WHERE json_type(j) IN ('OBJECT', 'ARRAY') AND NOT json_exists(j, '$.set_id')) WHERE json_type({_opened('v')}) IN ('OBJECT', 'ARRAY')),
held AS (SELECT record_id, spl_set_id, arg_min(j, depth) AS j FROM roots WHERE json_exists(j, '$.set_id') GROUP BY ALL),
objects AS (SELECT record_id, spl_set_id, '' AS kind, '' AS path, '' AS parent_path, j FROM held
  UNION ALL SELECT record_id, spl_set_id, CASE WHEN s.k IN {_TAGS} THEN s.k WHEN s.k = '' THEN s.t ELSE '' END, s.p, parent_path, s.j FROM (
    SELECT record_id, spl_set_id, CASE WHEN kind <> '' AND json_type(j) = 'OBJECT' THEN path ELSE parent_path END AS parent_path, unnest(children) AS s FROM (
      SELECT *, CASE json_type(j) WHEN 'ARRAY' THEN list_transform(j::JSON[], lambda x, i: {{'k': '', 't': kind, 'p': path || '.' || (i - 1), 'j': x}})
        ELSE flatten(list_transform(json_keys(j), lambda k: list_transform([{_opened(_FIELD)}], lambda v: CASE json_type(v)
          WHEN 'ARRAY' THEN list_transform(v::JSON[], lambda x, i: {{'k': k, 't': '', 'p': {_AT} || '.' || (i - 1), 'j': x}})
          WHEN 'OBJECT' THEN [{{'k': k, 't': '', 'p': {_AT} || CASE WHEN k IN {_TAGS} THEN '.0' ELSE '' END, 'j': v}}] ELSE [] END)[1])) END AS children
      FROM objects)) WHERE json_type(s.j) IN ('OBJECT', 'ARRAY'))
"""


@query(OBJECTS + "SELECT record_id, kind, path, parent_path FROM objects WHERE kind <> '' AND json_type(j) = 'OBJECT'")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.emit_objects(table(spark, sf_dir, "label_records")).select("record_id", "kind", "path", "parent_path")


def label_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The flat tables of the label records, read back from one write partitioned by tag."""
    return nested.stored_tables(nested.emit_objects(table(spark, sf_dir, "label_records")), scratch(spark, "objects"))


def _flat(tag: str) -> None:
    columns = [c.split()[0] for c in nested.LABEL_TABLES[tag].split(", ")]

    def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
        return label_tables(spark, sf_dir)[tag]

    flat.__name__ = f"p2_{tag}"
    query(OBJECTS + f"SELECT record_id, path, parent_path, {', '.join(f'j->>{chr(39)}$.{c}{chr(39)} AS {c}' for c in columns)} FROM objects WHERE kind = '{tag}' AND json_type(j) = 'OBJECT'")(flat)


for _tag in nested.LABEL_TABLES:
    _flat(_tag)


@query()
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(table(spark, sf_dir, "feed_rows"))


# DuckDB numbers array places and quotes odd names in its keys; the fields of the feeds have plain names
_PATH = r"regexp_replace(substr(t.fullkey, 3), '\[[0-9]+\]', '[]', 'g')"


@query(f"""
WITH t AS (SELECT f.feed_id, f.file_id, f.delivered_at, {_PATH} AS path, CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS kind
  FROM (SELECT * FROM feed_rows WHERE json_valid(payload) AND json_type(payload) = 'OBJECT') f, json_tree(f.payload) t WHERE t.type <> 'NULL' AND t.fullkey <> '$'),
n AS (SELECT feed_id, file_id, delivered_at, path, kind, count(*) AS n FROM t GROUP BY ALL),
u AS (SELECT feed_id, path, arg_min(kind, struct_pack(a := delivered_at, b := file_id, c := -n, d := kind)) AS usual FROM n GROUP BY ALL)
SELECT n.feed_id, n.path, n.kind, u.usual, arg_min(n.file_id, struct_pack(a := n.delivered_at, b := n.file_id)) AS file_id, count(*) AS files, sum(n.n)::BIGINT AS "values"
FROM n JOIN u ON n.feed_id = u.feed_id AND n.path = u.path WHERE n.kind <> u.usual GROUP BY n.feed_id, n.path, n.kind, u.usual""")
def p3_alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.alternatives(table(spark, sf_dir, "feed_rows"))


# Names under which the two families deliver their keys and companions (lower case, without `_`).
CASE_FIELDS = {
    "primaryid": "primaryid", "isr": "primaryid", "reportno": "primaryid",
    "caseid": "caseid", "case": "caseid",
    "drugname": "drugname", "indipt": "indi_pt", "reasonforuse": "indi_pt",
    "fdadt": "fda_dt", "received": "fda_dt", "receiptdate": "fda_dt",
    "occpcod": "occp_cod", "reporteroccupation": "occp_cod",
    "reportercountry": "reporter_country", "countrycd": "reporter_country",
    "age": "age", "patientage": "age", "serious": "serious", "isserious": "serious",
    "pt": "pt", "reactions": "pt", "reactionterms": "pt",
}
PRODUCT_FIELDS = {
    "applnoraw": "appl_no_raw", "applno": "appl_no_raw", "applicationno": "appl_no_raw", "applicationnumber": "appl_no_raw",
    "productno": "product_no", "prodnum": "product_no", "drugname": "drug_name", "proprietaryname": "drug_name",
    "activeingredient": "active_ingredient", "substances": "active_ingredient", "form": "form",
    "strength": "strength", "potency": "strength", "referencedrug": "reference_drug", "rld": "reference_drug",
    "marketingstatusname": "marketing_status", "marketingstatus": "marketing_status", "statustext": "marketing_status",
    "approvaldate": "approval_date", "approvedon": "approval_date", "approved": "approval_date",
    "npacks": "n_packs", "packcount": "n_packs", "packs": "n_packs",
}


@query()
def p3_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "feed_rows").where(F.col("file_name").startswith("cases"))
    return drift.unified(feed, drift.chained(feed, CASE_FIELDS))


@query()
def p3_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "feed_rows").where(F.col("file_name").startswith("products"))
    return drift.unified(feed, drift.chained(feed, PRODUCT_FIELDS))


# A field is quoted (quotes inside doubled) or holds no separator and does not start with a quote
_FLD = r'(?:[ \t]*"(?:[^"]|"")*"[ \t]*|[ \t]*(?:[^"$ \t][^$]*)?)'
_TRIM = r"regexp_replace({0}, '^[ \t]+|[ \t]+$', '', 'g')"
_CONTROL = r"[\x00-\x1f\x7f\x{80}-\x{9f}\x{FFFD}]"
_WIDTH = "CASE family " + " ".join(f"WHEN '{f}' THEN {len(c)}" for f, c in rejects.FAMILIES.items()) + " END"


def _wrong(family: str) -> str:
    """SQL: whether a field of the family's values is invalid."""
    out = []
    for i, c in enumerate(rejects.FAMILIES[family], 1):
        if c in rejects.PATTERNS:
            out.append(f"NOT regexp_matches(vals[{i}], '{rejects.PATTERNS[c]}')")
        elif c in rejects.DATES:
            out.append(f"NOT (regexp_matches(vals[{i}], '^[0-9]{{8}}$') AND vals[{i}] >= '00010101' AND try_strptime(vals[{i}], '%Y%m%d') IS NOT NULL)")
    return " OR ".join(out)


_PARSED = f"""
WITH c AS (SELECT line_id, upper(trim(family)) AS family, {_TRIM.format("regexp_replace(" + _TRIM.format("coalesce(line, '')") + ", chr(13) || '$', '')")} AS l FROM raw_lines WHERE coalesce(line_no, 1) <> 0),
f AS (SELECT *, regexp_full_match(l, '(?:{_FLD}[$])*{_FLD}') AS closed, regexp_extract_all(l, '{_FLD}[$]') AS raw FROM c WHERE family IN ({', '.join(f"'{f}'" for f in rejects.FAMILIES)})),
g AS (SELECT *, {_TRIM.format("substr(l, coalesce(list_sum(list_transform(raw, lambda x: length(x))), 0)::BIGINT + 1)")} <> '' AS loose, list_transform(raw, lambda x: {_TRIM.format('substr(x, 1, length(x) - 1)')}) AS cells FROM f),
h AS (SELECT *, list_transform(cells, lambda x: CASE WHEN starts_with(x, '"') THEN {_TRIM.format('substr(x, 2, length(x) - 2)')} ELSE x END) AS bare FROM g),
v AS (SELECT *, list_transform(list_zip(cells, bare), lambda x: CASE WHEN starts_with(x[1], '"') THEN replace(x[2], '""', '"') ELSE x[2] END) AS vals FROM h),
p AS (SELECT line_id, family, vals, CASE WHEN NOT closed THEN 'quoting' WHEN len(raw) <> {_WIDTH} OR loose THEN 'column_count'
  WHEN len(list_filter(bare, lambda x: regexp_matches(x, '{_CONTROL}'))) > 0 THEN 'encoding' WHEN vals[1] = '' THEN 'missing_primaryid'
  WHEN CASE family {' '.join(f"WHEN '{f}' THEN {_wrong(f)}" for f in rejects.FAMILIES)} END THEN 'invalid_value' END AS code FROM v)
"""


@query(_PARSED + "SELECT line_id, code FROM p WHERE code IS NOT NULL")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.rejects(table(spark, sf_dir, "raw_lines"))


@query(_PARSED + f"SELECT family, count(*) AS lines, count(*) FILTER (WHERE code IS NULL) AS loaded, {', '.join(f'count(*) FILTER (WHERE code = {chr(39)}{c}{chr(39)}) AS {c}' for c in rejects.CODES)} FROM p GROUP BY family")
def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.reject_report(table(spark, sf_dir, "raw_lines"))


def _loaded(family: str) -> None:
    def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rejects.loaded(table(spark, sf_dir, "raw_lines"), family)

    loaded.__name__ = f"p5_loaded_{family.lower()}"
    query(_PARSED + f"SELECT line_id, {', '.join(f'vals[{i}] AS {c.lower()}' for i, c in enumerate(rejects.FAMILIES[family], 1))} FROM p WHERE family = '{family}' AND code IS NULL")(loaded)


for _family in rejects.FAMILIES:
    _loaded(_family)


_ID = "CASE WHEN instr({0}, ':') > 0 THEN upper(substr({0}, 1, instr({0}, ':') - 1)) || substr({0}, instr({0}, ':')) ELSE {0} END"
_BARE = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_ORPHANS = f"""
WITH n AS (SELECT {_ID.format('t')} AS k, arrived_at AS a, deleted_at AS x
           FROM (SELECT {_BARE.format('id')} AS t, arrived_at, deleted_at FROM nodes)),
e AS (SELECT DISTINCT id, asserted_at, endpoint, {_ID.format('t')} AS k FROM (
        SELECT id, asserted_at, 'subject' AS endpoint, {_BARE.format('subject')} AS t FROM broken_edges
        UNION ALL SELECT id, asserted_at, 'object', {_BARE.format('object')} FROM broken_edges) WHERE t <> ''),
o AS (SELECT e.*, CASE WHEN NOT EXISTS (SELECT 1 FROM n WHERE n.k = e.k) THEN 'missing'
        WHEN NOT EXISTS (SELECT 1 FROM n WHERE n.k = e.k AND n.a <= e.asserted_at) THEN 'late' ELSE 'deleted' END AS reason
      FROM e WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.k = e.k AND n.a <= e.asserted_at AND (n.x IS NULL OR n.x > e.asserted_at)))
"""


@query(_ORPHANS + "SELECT DISTINCT id, endpoint, reason FROM o")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = orphans.orphan_references(table(spark, sf_dir, "broken_edges"), table(spark, sf_dir, "nodes"))
    return found.select("id", "endpoint", "reason").distinct()


@query(
    _ORPHANS
    + """SELECT endpoint, reason, CASE WHEN asserted_at IS NOT NULL THEN year(asserted_at) || 'Q' || quarter(asserted_at) END AS period,
    count(*) AS orphans, count(DISTINCT k) AS keys FROM (SELECT DISTINCT * FROM o) GROUP BY ALL"""
)
def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_report(table(spark, sf_dir, "broken_edges"), table(spark, sf_dir, "nodes"))
