"""Queries for the three relations over whole tables, with SQL for all of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.operators import quality
from lodestone.operators import relational as R
from lodestone.operators import textmine as T
from lodestone.plans import assertions
from lodestone.plans.data_quality import OBJECTS, label_tables
from lodestone.plans.reference_queries import _STOP, _key, _norm, _strip, _terms
from lodestone.registry import query
from lodestone.runtime import materialize, sorted_side, table

_URL = S.LABEL_URL


def _evidence(spark: SparkSession, sf_dir: str) -> assertions.LabelEvidence:
    """Label evidence from the nested label records, by the flat tables of problem 2; an approval's own code goes before its id."""
    tables = label_tables(spark, sf_dir)
    sets = sorted_side(table(spark, sf_dir, "label_records").select("record_id", "spl_set_id"))
    at = [F.col("record_id").alias("ordinal"), F.col("path").alias("at")]
    coded = S.stripped(F.col("code")) != ""
    approvals = tables["approvals"].join(sets, "record_id").select(
        "spl_set_id", F.when(coded, F.col("code")).otherwise(F.col("approval_id")).alias("approval_id"), F.col("code").alias("approval_code"), F.when(coded, F.col("type")).alias("approval_type"), *at
    )
    ingredients = tables["ingredients"].join(sets, "record_id").select("spl_set_id", F.col("name").alias("ingredient_name"), F.col("unii").alias("ingredient_unii"), "role", *at)
    sections = tables["sections"].join(sets, "record_id").select(
        "spl_set_id", S.document_id(F.col("spl_set_id"), F.col("loinc")).alias("spl_document_id"), F.col("loinc").alias("loinc_code"), F.lit("").alias("clean_text"), F.col("text").alias("raw_text"), *at
    )
    return assertions.label_evidence(approvals, ingredients, sections)


def _cell(name: str) -> str:
    return _strip(f"j->>'$.{name}'")


def _pipe(values: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter({values}, lambda v: v <> ''))), '|')"


_SETS = f"{_strip('spl_set_id')}"
# Evidence: approvals, single ingredients and indication sections of labels
_LABELS = f"""
ap AS (SELECT norm, s, display, min(place) AS place FROM (
  SELECT {_key("CASE WHEN " + _cell('code') + " <> '' THEN " + _cell('code') + " ELSE " + _cell('approval_id') + " END")} AS norm, {_SETS} AS s,
    CASE WHEN {_cell('code')} <> '' THEN {_cell('type')} || {_cell('code')} ELSE {_cell('approval_id')} END AS display, struct_pack(a := record_id, b := path) AS place
  FROM objects WHERE kind = 'approvals' AND json_type(j) = 'OBJECT') WHERE norm <> '' AND s <> '' GROUP BY ALL),
ing AS (SELECT s, lower(name) AS fold, unii, arg_min(name, place) AS name FROM (
  SELECT {_SETS} AS s, {_cell('name')} AS name, {_cell('unii')} AS unii, struct_pack(a := record_id, b := path, c := j->>'$.name') AS place
  FROM objects WHERE kind = 'ingredients' AND json_type(j) = 'OBJECT' AND lower({_cell('role')}) = 'active') WHERE s <> '' AND name <> '' GROUP BY ALL),
one AS (SELECT s, min(name) AS name, min(unii) AS unii FROM ing GROUP BY s HAVING count(*) = 1),
sec AS (SELECT {_SETS} AS s, {_SETS} || '#34067-9' AS doc, {_cell('text')} AS text, record_id, path FROM objects WHERE kind = 'sections' AND json_type(j) = 'OBJECT' AND {_cell('loinc')} = '34067-9' AND {_SETS} <> ''),
said AS (SELECT d.text, t.term_id, t.text AS term, coalesce(t.curie, '') AS curie, coalesce(t.name, t.text) AS name, coalesce(t.category, 'Disease') AS category FROM (SELECT DISTINCT text FROM sec) d JOIN disease_terms t ON contains(lower(d.text), lower(t.text))),
mapped AS (SELECT DISTINCT {_key('appl_no_stripped')} AS norm FROM drugsfda_products WHERE {_strip('active_ingredient')} <> '' AND {_key('appl_no_stripped')} <> ''),
backed AS (SELECT DISTINCT norm FROM ap WHERE s IN (SELECT s FROM sec))
"""
# Candidates of the case table: number and indication with fallback subject, reports and links
_PAIRS = f"""
raw AS (SELECT {_key("CASE WHEN coalesce(nda, '') <> '' THEN nda ELSE nda_raw END")} AS norm, {_strip('indication')} AS object_text, {_strip("CASE WHEN coalesce(ingredient, '') <> '' THEN ingredient ELSE drugname END")} AS subject,
  upper({_strip('quarter')}) AS q, {_strip('primaryid')} AS p, {_strip('source_record_id')} AS record, coalesce(drug_seq, '') AS seq FROM cases),
pairs AS (SELECT norm, object_text, arg_min(subject, struct_pack(a := p, b := seq, c := record, d := subject)) AS fallback, list(record) AS records,
  list(CASE WHEN q <> '' AND p <> '' THEN 'https://fis.fda.gov/content/Exports/faers_ascii_20' || substr(q, 1, 2) || 'q' || substr(q, 4, 1) || '.zip' ELSE '' END) AS urls
  FROM raw WHERE norm <> '' AND object_text <> '' AND NOT regexp_matches(object_text, '{_STOP}') GROUP BY ALL)
"""
_OBJECT = """
obj AS (SELECT o.object_text, arg_min(coalesce(t.curie, ''), t.term_id) AS curie, arg_min(coalesce(t.name, ''), t.term_id) AS name, arg_min(coalesce(t.category, 'Disease'), t.term_id) AS category
  FROM (SELECT DISTINCT object_text FROM pairs) o JOIN disease_terms t ON contains(lower(o.object_text), lower(t.text)) GROUP BY o.object_text),
cand AS (SELECT p.*, coalesce(o.curie, '') AS object_curie, coalesce(o.name, p.object_text) AS object_name, coalesce(o.category, 'Disease') AS object_category FROM pairs p LEFT JOIN obj o USING (object_text))
"""
_FROM_LABELS = """
cand AS (SELECT norm, object_text, object_curie, object_name, object_category, '' AS fallback, []::VARCHAR[] AS records, []::VARCHAR[] AS urls FROM (
  SELECT a.norm, m.term AS object_text, m.curie AS object_curie, m.name AS object_name, m.category AS object_category, row_number() OVER (PARTITION BY a.norm, m.term ORDER BY c.s, c.doc, m.term_id) AS r
  FROM sec c JOIN said m ON m.text = c.text JOIN (SELECT DISTINCT norm, s FROM ap) a ON a.s = c.s) WHERE r = 1)
"""
_NEEDLE = _norm("c.object_text")
_SUPPORT = f"""
asked AS (SELECT c.norm, c.object_text, c.object_curie, {_NEEDLE} AS needle FROM cand c WHERE c.norm IN (SELECT norm FROM mapped) AND {_NEEDLE} <> ''),
sup AS (SELECT DISTINCT c.norm, c.object_text, x.s, x.doc FROM asked c JOIN (SELECT DISTINCT norm, s FROM ap) a USING (norm) JOIN sec x ON x.s = a.s
  WHERE contains(' ' || {_norm('x.text')} || ' ', ' ' || c.needle || ' ')
  OR EXISTS (SELECT 1 FROM said m WHERE m.text = x.text AND c.object_curie <> '' AND m.curie = c.object_curie)
  OR EXISTS (SELECT 1 FROM said m WHERE m.text = x.text AND {_norm('m.term')} = c.needle AND (c.object_curie = '' OR m.curie = ''))),
gathered AS (SELECT u.norm, u.object_text, list(u.s) AS sets, list(u.doc) AS docs, arg_min(o.name, u.s) FILTER (WHERE o.s IS NOT NULL) AS name, arg_min(o.unii, u.s) FILTER (WHERE o.s IS NOT NULL) AS unii
  FROM sup u LEFT JOIN one o ON o.s = u.s GROUP BY u.norm, u.object_text)
"""
_APPROVED = f"""
shown AS (SELECT norm, arg_min(display, struct_pack(a := place, b := display)) AS display FROM ap GROUP BY norm),
rows_ AS (SELECT coalesce(g.name, {_strip('c.fallback')}) AS subject_text, coalesce(g.unii, '') AS subject_curie, c.*, g.sets, g.docs, coalesce(d.display, c.norm) AS display FROM cand c JOIN gathered g USING (norm, object_text) LEFT JOIN shown d USING (norm)),
approved AS (SELECT subject_text, coalesce(arg_min(subject_curie, norm) FILTER (WHERE subject_curie <> ''), '') AS subject_curie, subject_text AS subject_name, 'ChemicalEntity' AS subject_category, 'biolink:treats' AS predicate,
  object_text, coalesce(arg_min(object_curie, norm) FILTER (WHERE object_curie <> ''), '') AS object_curie, arg_min(object_name, norm) AS object_name, arg_min(object_category, norm) AS object_category,
  {_pipe('list(display)')} AS approval_ids, {_pipe(f"list_transform(flatten(list(sets)), lambda s: '{_URL}' || s)")} AS supporting_spl_sets, {_pipe(f"list_transform(flatten(list(docs)), lambda s: '{_URL}' || s)")} AS supporting_spl_documents,
  {_pipe("list_transform(flatten(list(sets)), lambda s: 'dailymed:' || s)")} AS supporting_spl_evidence, 'approved_for_condition' AS clinical_approval_status, 'knowledge_assertion' AS knowledge_level,
  'manual_validation_of_automated_agent' AS agent_type, '{assertions.PRIMARY_SOURCE}' AS primary_knowledge_source, '{assertions.LABEL_SOURCE}|{assertions.REPORT_SOURCE}' AS upstream_resource_ids,
  {_pipe("list_transform(flatten(list(sets)), lambda s: 'dailymed:' || s)")} AS edge_evidence, {_pipe('flatten(list(records))')} AS supporting_faers_records, {_pipe('flatten(list(urls))')} AS supporting_faers_urls
  FROM rows_ WHERE subject_text <> '' GROUP BY subject_text, object_text)
"""
_CASES_CHAIN = OBJECTS + ", " + ", ".join((_LABELS, _PAIRS, _OBJECT, _SUPPORT, _APPROVED))


def _approved(spark: SparkSession, sf_dir: str, evidence: assertions.LabelEvidence | None = None) -> DataFrame:
    return assertions.approved_from_cases(table(spark, sf_dir, "cases"), evidence or _evidence(spark, sf_dir), table(spark, sf_dir, "drugsfda_products"), _terms(spark, sf_dir))


@query(_CASES_CHAIN + "SELECT * FROM approved")
def approved_treats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _approved(spark, sf_dir)


@query(OBJECTS + ", " + ", ".join((_LABELS, _FROM_LABELS, _SUPPORT, _APPROVED)) + "SELECT * FROM approved")
def approved_treats_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence, terms = _evidence(spark, sf_dir), _terms(spark, sf_dir)
    return assertions.approved_treats(assertions.label_candidates(evidence, terms), evidence, table(spark, sf_dir, "drugsfda_products"), terms)


@query(
    OBJECTS + ", " + ", ".join((_LABELS, _PAIRS, _OBJECT, _SUPPORT))
    + f"""SELECT CASE WHEN norm NOT IN (SELECT norm FROM mapped) THEN 'no_product' WHEN norm NOT IN (SELECT norm FROM backed) THEN 'no_label' WHEN g.sets IS NULL THEN 'not_named'
    WHEN g.name IS NULL AND {_strip('c.fallback')} = '' THEN 'no_subject' ELSE 'passed' END AS gate, count(*) AS candidates FROM cand c LEFT JOIN gathered g USING (norm, object_text) GROUP BY gate"""
)
def approval_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.gate_counts(table(spark, sf_dir, "cases"), _evidence(spark, sf_dir), table(spark, sf_dir, "drugsfda_products"), _terms(spark, sf_dir))


# Conditions that the recogniser of the observed relation knows, none within another.
FINDINGS = {"fever": "disease", "neuralgia": "phenotype", "stenosis": "disease", "oedema": "phenotype", "palsy": "disease", "atrophy": "disease", "tumour": "disease"}
_FOUND = "regexp_extract_all(" + _norm("k.indication") + ", '\\b(?:" + "|".join(FINDINGS) + ")\\b')"
_KIND = "CASE said " + " ".join(f"WHEN '{t}' THEN '{assertions.TYPE_CATEGORIES[k]}'" for t, k in FINDINGS.items()) + " END"
_OBSERVED = f"""
rows_o AS (SELECT {_strip('drugname')} AS subject_text, {_strip('indication')} AS indication, {_strip('primaryid')} AS p, {_strip("CASE WHEN coalesce(nda_raw, '') <> '' THEN nda_raw ELSE nda END")} AS r, upper({_strip('quarter')}) AS q, {_strip('source_record_id')} AS record FROM cases),
k AS (SELECT *, {_key('r')} AS norm FROM rows_o WHERE subject_text <> '' AND indication <> '' AND NOT regexp_matches(indication, '{_STOP}')),
numbers AS (SELECT subject_text, indication, list(r) AS ids FROM (SELECT subject_text, indication, norm, min(r) AS r FROM k WHERE norm <> '' GROUP BY ALL) GROUP BY ALL),
uses AS (SELECT subject_text, indication, (count(DISTINCT CASE WHEN p <> '' THEN p END) + count(*) FILTER (WHERE p = ''))::VARCHAR AS case_count, list(record) AS records,
  list(CASE WHEN q <> '' AND p <> '' THEN 'https://fis.fda.gov/content/Exports/faers_ascii_20' || substr(q, 1, 2) || 'q' || substr(q, 4, 1) || '.zip' ELSE '' END) AS urls FROM k GROUP BY ALL),
terms AS (SELECT i.indication, arg_min(t.text, t.term_id) AS term, arg_min(coalesce(t.curie, ''), t.term_id) AS curie, arg_min(t.name, t.term_id) AS name, arg_min(t.category, t.term_id) AS category
  FROM (SELECT DISTINCT indication FROM k) i JOIN disease_terms t ON contains(lower(i.indication), lower(t.text)) GROUP BY i.indication),
mentions AS (SELECT indication, said, {_KIND} AS said_category FROM (SELECT indication, f[1] AS said FROM (SELECT k.indication, {_FOUND} AS f FROM (SELECT DISTINCT indication FROM k) k) WHERE len(f) = 1)),
full_o AS (SELECT u.*, n.ids, coalesce(t.term, m.said, u.indication) AS object_text, coalesce(t.curie, '') AS object_curie, CASE WHEN t.term IS NULL THEN coalesce(m.said, u.indication) ELSE coalesce(t.name, u.indication) END AS object_name,
  CASE WHEN t.term IS NULL THEN coalesce(m.said_category, 'Disease') ELSE coalesce(t.category, 'Disease') END AS object_category
  FROM uses u LEFT JOIN numbers n USING (subject_text, indication) LEFT JOIN terms t USING (indication) LEFT JOIN mentions m USING (indication)),
sure AS (SELECT DISTINCT {_norm('subject_text')} AS s, {_norm('object_text')} AS o FROM approved WHERE {_norm('subject_text')} <> '' AND {_norm('object_text')} <> '')
"""


@query(
    _CASES_CHAIN + ", " + _OBSERVED
    + f"""SELECT subject_text, '' AS subject_curie, subject_text AS subject_name, 'ChemicalEntity' AS subject_category, 'biolink:applied_to_treat' AS predicate, object_text, object_curie, object_name, object_category, case_count,
    CASE WHEN sure.s IS NOT NULL THEN 'approved_for_condition' ELSE 'off_label_use' END AS clinical_approval_status, 'statistical_association' AS knowledge_level, 'manual_validation_of_automated_agent' AS agent_type,
    '{assertions.PRIMARY_SOURCE}' AS primary_knowledge_source, '{assertions.REPORT_SOURCE}|{assertions.LABEL_SOURCE}' AS upstream_resource_ids, coalesce({_pipe('ids')}, '') AS approval_ids, '' AS edge_evidence,
    {_pipe('records')} AS supporting_faers_records, {_pipe('urls')} AS supporting_faers_urls FROM full_o LEFT JOIN sure ON sure.s = {_norm('subject_text')} AND sure.o = {_norm('object_text')}"""
)
def observed_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.observed_uses(table(spark, sf_dir, "cases"), _terms(spark, sf_dir), _approved(spark, sf_dir), T.Gazetteer(FINDINGS).match)


@query(
    OBJECTS + ", " + _LABELS
    + f""", lead AS (SELECT s, lower(arg_min(name, struct_pack(a := place, b := name))) AS drug FROM (SELECT s, name, place FROM (
      SELECT {_SETS} AS s, {_cell('name')} AS name, struct_pack(a := record_id, b := path, c := j->>'$.name') AS place FROM objects WHERE kind = 'ingredients' AND json_type(j) = 'OBJECT' AND lower({_cell('role')}) = 'active') WHERE s <> '' AND name <> '') GROUP BY s)
    SELECT drug, s AS spl_set_id FROM lead WHERE s IN (SELECT {_SETS} FROM objects WHERE kind = 'sections' AND json_type(j) = 'OBJECT' AND {_cell('loinc')} = '34070-3')"""
)
def contraindicated_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.contraindicated_labels(_evidence(spark, sf_dir))


def _gazetteer(spark: SparkSession, sf_dir: str) -> T.Gazetteer:
    """The term list as a gazetteer; a list of conditions is bounded, and refused beyond that."""
    rows = _terms(spark, sf_dir).select("term", "category").limit(200_001).collect()
    if len(rows) > 200_000:
        raise ValueError("the term list is too long to ship to every worker")
    return T.Gazetteer({r["term"]: "disease" if r["category"] == "Disease" else "phenotype" for r in rows})


@query()
def contraindications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.contraindications(_evidence(spark, sf_dir), _gazetteer(spark, sf_dir).match)


@query()
def relation_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken invariants of all three relations (none, if all is well)."""
    evidence, terms = _evidence(spark, sf_dir), _terms(spark, sf_dir)
    approved = materialize(_approved(spark, sf_dir, evidence), "approved")
    observed = assertions.observed_uses(table(spark, sf_dir, "cases"), terms, approved)
    contraindicated = assertions.contraindications(evidence, _gazetteer(spark, sf_dir).match)
    relations = {"approved": approved, "observed_use": materialize(observed, "observed"), "contraindication": materialize(contraindicated, "contraindicated")}
    return R.union_all([quality.invariant_violations(rows, name, assertions.PRIMARY_SOURCE) for name, rows in relations.items()])
