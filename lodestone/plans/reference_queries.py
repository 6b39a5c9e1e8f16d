"""Queries for the engine's own operators over whole tables, each with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.operators import nested, quality
from lodestone.operators import relational as R
from lodestone.operators import textmine as T
from lodestone.plans import assertions, exports
from lodestone.plans.data_quality import OBJECTS
from lodestone.registry import query
from lodestone.runtime import materialize, table
from lodestone.schemas import CASES
from lodestone.sources import listings

# SQL pieces: Unicode white space as a class, stripping, the normal forms
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{_WS}+|{_WS}+$', '', 'g')"


def _norm(x: str) -> str:
    return f"trim(regexp_replace(replace(regexp_replace(lower({x}), '<[^>]*>', ' ', 'g'), '''s', ' '), '[^a-z0-9]+', ' ', 'g'))"


def _key(x: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({x}, ''), '[^0-9]+', '', 'g'), '^0+', '')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


_STOP = "(?i)" + "|".join(S.STOP_PHRASES) + "|^(?:" + "|".join(S.STOP_WHOLE) + r")\z"
_PIECES = r"regexp_extract_all({0}, '(?s)(.*?[.!?;](?:\s+|\z)|.+\z)', 1)"
_SENTENCES = "list_filter(list_transform(" + _PIECES + r", lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"
_URL = S.LABEL_URL


@query(f"SELECT case_row_id, {_strip('drugname')} AS drug, {_strip('indication')} AS indication FROM cases WHERE {_strip('drugname')} <> '' AND {_strip('indication')} <> ''")
def scan_project_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "cases").select("case_row_id", S.stripped(F.col("drugname")).alias("drug"), S.stripped(F.col("indication")).alias("indication"))
    return rows.where("drug <> '' and indication <> ''")


@query(f"""
WITH p AS (SELECT product_row_id, {_strip('appl_no_raw')} AS r FROM drugsfda_products),
q AS (SELECT product_row_id, upper(regexp_extract(r, '(?i)^(ANDA|NDA|BLA)\\s*([0-9]+)', 1)) AS k, regexp_extract(r, '(?i)^(ANDA|NDA|BLA)\\s*([0-9]+)', 2) AS t, regexp_replace(r, '[^0-9]+', '', 'g') AS d, r FROM p),
n AS (SELECT *, CASE WHEN t <> '' THEN t ELSE d END AS n FROM q)
SELECT product_row_id, k || n AS appl_no_raw, k AS appl_type, n AS appl_no, CASE WHEN regexp_replace(n, '^0+', '') <> '' THEN regexp_replace(n, '^0+', '') ELSE n END AS appl_no_stripped,
       {_key('r')} AS join_key FROM n""")
def application_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "drugsfda_products")
    return p.select("product_row_id", S.application_parts(F.col("appl_no_raw")).alias("p"), S.application_key(F.col("appl_no_raw")).alias("join_key")).select("product_row_id", "p.*", "join_key")


@query("""
SELECT case_row_id, coalesce(quarter, '') || ':' || coalesce(primaryid, '') || ':' || coalesce(drug_seq, '') || ':' || coalesce(indication, '') AS record_id,
  'sha256:' || sha256(coalesce(source_file, '') || chr(31) || coalesce(primaryid, '') || chr(31) || coalesce(drug_seq, '')) AS stable_id FROM cases""")
def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases")
    cols = lambda *names: [F.col(n) for n in names]
    return c.select("case_row_id", S.joined_id(*cols("quarter", "primaryid", "drug_seq", "indication")).alias("record_id"), S.stable_id(*cols("source_file", "primaryid", "drug_seq")).alias("stable_id"))


@query("""
SELECT product_row_id, CASE WHEN coalesce(appl_no_stripped, '') <> '' THEN 'drugsfda:product:' || coalesce(appl_type, '') || appl_no_stripped || ':' || CASE WHEN coalesce(product_no, '') <> '' THEN product_no ELSE 'NA' END
  WHEN coalesce(product_ndc, '') <> '' THEN 'drugsfda:product:ndc:' || product_ndc ELSE 'drugsfda:product:row:' || product_row_id END AS record_id FROM drugsfda_products""")
def product_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "drugsfda_products")
    c = [F.col(x) for x in ("appl_type", "appl_no_stripped", "product_no", "product_ndc", "product_row_id")]
    return p.select("product_row_id", S.product_record_id(*c).alias("record_id"))


@query(f"SELECT doc_id, {_norm('text')} AS matching_form, lower({_collapse('text')}) AS dedupe_key FROM documents")
def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.normalize_text(F.col("text")).alias("matching_form"), S.dedupe_key(F.col("text")).alias("dedupe_key"))


@query(f"SELECT quarter, count(*) AS n, count(*) FILTER (WHERE regexp_matches({_strip('indication')}, '{_STOP}')) AS placeholders FROM cases GROUP BY quarter")
def stoplist_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases")
    return c.groupBy("quarter").agg(F.count(F.lit(1)).alias("n"), F.count_if(S.is_placeholder(F.col("indication"))).alias("placeholders"))


@query(f"SELECT doc_id, len({_SENTENCES.format('text')}) AS n, list_sum(list_transform({_SENTENCES.format('text')}, lambda x: length(x)))::BIGINT AS chars FROM documents WHERE text <> '' AND len({_SENTENCES.format('text')}) > 0")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", S.sentences(F.col("text")).alias("s")).where(F.size("s") > 0)
    return d.select("doc_id", F.size("s").cast("long").alias("n"), F.aggregate("s", F.lit(0), lambda a, x: (a + x["end"] - x["start"]).cast("int")).cast("long").alias("chars"))


@query(f"SELECT doc_id, array_to_string(list_filter({_SENTENCES.format('text')}, lambda x: regexp_matches(x, '(?i){T.KEYWORDS}')), ' ') AS kept FROM documents WHERE regexp_matches(text, '(?i){T.KEYWORDS}')")
def keyword_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = "(?i)" + T.KEYWORDS
    return table(spark, sf_dir, "documents").where(F.col("text").rlike(pattern)).select("doc_id", S.keyword_sentences(F.col("text"), pattern).alias("kept"))


@query(f"""
WITH p AS (SELECT doc_id, i, x, (sum(length(x)) OVER (PARTITION BY doc_id ORDER BY i) - length(x))::INTEGER AS before FROM (SELECT doc_id, unnest({_PIECES.format('text')}) AS x, generate_subscripts({_PIECES.format('text')}, 1) AS i FROM documents WHERE text <> '')),
b AS (SELECT doc_id, i, regexp_replace(x, '^\\s+|\\s+$', '', 'g') AS s, (before + length(x) - length(regexp_replace(x, '^\\s+', '')))::INTEGER AS source_start FROM p),
k AS (SELECT doc_id, i, s, source_start, length(s)::INTEGER AS n FROM b WHERE s <> '' AND regexp_matches(s, '(?i){T.KEYWORDS}'))
SELECT doc_id, (sum(n + 1) OVER (PARTITION BY doc_id ORDER BY i) - n - 1)::INTEGER AS start, (sum(n + 1) OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS "end", source_start, source_start + n AS source_end FROM k""")
def keyword_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(S.keyword_spans(F.col("text"), "(?i)" + T.KEYWORDS)).alias("s")).select("doc_id", "s.*")


_HARD, _NEG, _SOFT, _MED = ("(?i)" + p for p in (T.HARD, T.NEGATION, T.SOFT, T.MEDICATION))


@query(f"""
WITH s AS (SELECT doc_id, unnest({_SENTENCES.format('text')}) AS x FROM documents)
SELECT doc_id, count(*) AS sentences, count(*) FILTER (WHERE regexp_matches(x, '{_HARD}')) AS hard, count(*) FILTER (WHERE regexp_matches(x, '{_NEG}')) AS negated,
  count(*) FILTER (WHERE regexp_matches(x, '{_SOFT}')) AS soft, count(*) FILTER (WHERE regexp_matches(x, '{_MED}')) AS medication FROM s GROUP BY doc_id""")
def polarity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "documents").select("doc_id", F.explode(S.sentences(F.col("text"))["text"]).alias("x"))
    count = lambda p: F.count_if(F.col("x").rlike(p))
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sentences"), count(_HARD).alias("hard"), count(_NEG).alias("negated"), count(_SOFT).alias("soft"), count(_MED).alias("medication"))


@query(f"""
SELECT record_id, '{_URL}' || {_strip('spl_set_id')} AS set_url, 'dailymed:' || {_strip('spl_set_id')} AS curie, '{_URL}' || {_strip('spl_set_id')} || '#34067-9' AS document_url FROM label_records WHERE {_strip('spl_set_id')} <> ''""")
def label_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "label_records").where(S.stripped(F.col("spl_set_id")) != "")
    doc = S.document_id(S.stripped(F.col("spl_set_id")), F.lit("34067-9"))
    return r.select("record_id", S.label_url(F.col("spl_set_id")).alias("set_url"), S.label_curie(doc).alias("curie"), S.label_url(doc).alias("document_url"))


@query("SELECT quarter, count(*) AS n, 'https://fis.fda.gov/content/Exports/faers_ascii_20' || substr(quarter, 1, 2) || 'q' || substr(quarter, 4, 1) || '.zip' AS url FROM cases GROUP BY quarter")
def quarter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "cases").groupBy("quarter").agg(F.count(F.lit(1)).alias("n"))
    return n.select("quarter", "n", S.quarter_url(F.col("quarter")).alias("url"))


@query("""SELECT year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter, count(*) AS n FROM orders GROUP BY ALL ORDER BY quarter DESC LIMIT 4""")
def newest_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(S.quarter_label(F.col("o_orderdate")).alias("quarter")).agg(F.count(F.lit(1)).alias("n")).transform(lambda q: listings.newest(q, 4))


_BAR_WS = _WS.replace(r"[\s", r"[|\s")


@query(f"SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{_BAR_WS}+', ' ', 'g')) AS safe, NOT regexp_matches(coalesce(text, ''), '[|\\t\\r\\n]') AS was_safe FROM documents")
def pipe_safe_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.pipe_safe(F.col("text")).alias("safe"), S.is_pipe_safe(F.col("text")).alias("was_safe"))


@query("SELECT DISTINCT source_file, CASE WHEN lower(source_file) LIKE '%.txt' THEN 'text/plain' WHEN lower(source_file) LIKE '%.zip' THEN 'application/zip' WHEN lower(source_file) LIKE '%.tsv' THEN 'text/tab-separated-values' ELSE 'application/octet-stream' END AS media_type FROM (SELECT source_file FROM cases UNION ALL SELECT source_file FROM drugsfda_products UNION ALL SELECT release_file FROM label_records) WHERE source_file IS NOT NULL")
def media_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [table(spark, sf_dir, t).select(F.col(c).alias("source_file")) for t, c in (("cases", "source_file"), ("drugsfda_products", "source_file"), ("label_records", "release_file"))]
    return R.union_all([n.distinct() for n in names]).where("source_file is not null").distinct().select("source_file", S.media_type(F.col("source_file")).alias("media_type"))


@query("""SELECT event_id, CASE WHEN value = 0 THEN '0' ELSE printf('%g', value) END AS shown, CASE WHEN value = 0 THEN '0' ELSE printf('%g', value * 1e9) END AS large, CASE WHEN value = 0 THEN '0' ELSE printf('%g', value / 1e9) END AS small FROM events""")
def number_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    return table(spark, sf_dir, "events").select("event_id", S.general_number(v).alias("shown"), S.general_number(v * 1e9).alias("large"), S.general_number(v / 1e9).alias("small"))


@query("""SELECT category, CASE lower(category) WHEN 'disease' THEN 'disease' WHEN 'phenotypicfeature' THEN 'phenotype' ELSE lower(category) END AS type, count(*) AS n FROM disease_terms GROUP BY category""")
def entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "disease_terms").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return n.select("category", S.canonical_type(F.col("category")).alias("type"), "n")


@query("SELECT event_type, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS k, count(*) AS n FROM events GROUP BY event_type")
def json_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k"))
    return e.groupBy("event_type").agg(F.sum("k").alias("k"), F.count(F.lit(1)).alias("n"))


@query("""SELECT c.case_row_id FROM cases c WHERE NOT EXISTS (SELECT 1 FROM cases d WHERE d.role_cod = 'C' AND d.quarter = c.quarter AND d.primaryid = c.primaryid)""")
def anti_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases").select("case_row_id", "quarter", "primaryid", "role_cod")
    return R.without_deleted(c, c.where("role_cod = 'C'"), ["quarter", "primaryid"]).select("case_row_id")


def _families(c: DataFrame) -> dict[str, DataFrame]:
    key = ["quarter", "primaryid"]
    return {
        "indi": c.select(*key, "indi_drug_seq", F.col("indication").alias("indi_pt")).distinct(), "drug": c.select(*key, "drug_seq", "drugname", F.col("ingredient").alias("prod_ai"), F.col("nda_raw").alias("nda_num"), "role_cod", "source_file").distinct(),
        "demo": c.select(*key, "caseid", "occp_cod", "reporter_country").distinct(), "rpsr": c.select(*key, F.col("source").alias("rpsr_cod")).distinct(), "reac": c.select(*key, F.explode(F.split("effects", r"\$")).alias("pt")),
    }


@query("""
WITH i AS (SELECT DISTINCT quarter, primaryid, indi_drug_seq, indication FROM cases),
d AS (SELECT DISTINCT quarter, primaryid, drug_seq, drugname, ingredient, nda_raw, role_cod, source_file FROM cases),
m AS (SELECT DISTINCT quarter, primaryid, caseid, occp_cod, reporter_country FROM cases), r AS (SELECT DISTINCT quarter, primaryid, source FROM cases),
x AS (SELECT quarter, primaryid, trim(unnest(string_split(effects, '$'))) AS pt FROM cases), e AS (SELECT quarter, primaryid, string_agg(DISTINCT pt, '$' ORDER BY pt) AS effects FROM x WHERE pt <> '' GROUP BY ALL)
SELECT DISTINCT i.quarter, i.primaryid, coalesce(m.caseid, '') AS caseid, coalesce(r.source, '') AS source, coalesce(m.occp_cod, '') AS occp_cod, coalesce(m.reporter_country, '') AS reporter_country,
  coalesce(d.drugname, '') AS drugname, coalesce(d.ingredient, '') AS ingredient, regexp_replace(regexp_replace(coalesce(d.nda_raw, ''), '[^0-9]+', '', 'g'), '^0+', '') AS nda, coalesce(i.indication, '') AS indication, coalesce(e.effects, '') AS effects
FROM i JOIN d ON i.quarter = d.quarter AND i.primaryid = d.primaryid AND i.indi_drug_seq = d.drug_seq
LEFT JOIN m ON i.quarter = m.quarter AND i.primaryid = m.primaryid LEFT JOIN r ON i.quarter = r.quarter AND i.primaryid = r.primaryid LEFT JOIN e ON i.quarter = e.quarter AND i.primaryid = e.primaryid""")
def case_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _families(table(spark, sf_dir, "cases"))
    rows = R.case_join(f["indi"], f["drug"], f["demo"], f["rpsr"], f["reac"])
    return rows.select("quarter", "primaryid", "caseid", "source", "occp_cod", "reporter_country", "drugname", "ingredient", "nda", "indication", "effects")


_SUBSET = ("quarter", "primaryid", "caseid", "drugname", "indication")


@query(f"SELECT case_row_id FROM (SELECT case_row_id, row_number() OVER (PARTITION BY {', '.join(_SUBSET)} ORDER BY coalesce(drug_seq, ''), case_row_id) AS r FROM cases) WHERE r = 1")
def keep_first_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases").select("case_row_id", *_SUBSET, S.text(F.col("drug_seq")).alias("seq"))
    return R.keep_first(c, _SUBSET, ["seq", "case_row_id"]).select("case_row_id")


_DEDUP_KEY = f"CASE WHEN {_strip('caseid')} <> '' THEN {_strip('caseid')} ELSE coalesce(primaryid, '') END"
_RANKED = f"SELECT *, {_DEDUP_KEY} AS dedup_key, max(quarter) OVER (PARTITION BY {_DEDUP_KEY}) AS winning_quarter FROM cases"


@query(f"SELECT case_row_id, quarter FROM ({_RANKED}) WHERE quarter IS NOT DISTINCT FROM winning_quarter")
def latest_wins_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reduce_cases(table(spark, sf_dir, "cases"))[0].select("case_row_id", "quarter")


@query(f"SELECT quarter, primaryid, caseid, dedup_key, winning_quarter, source_record_id FROM ({_RANKED}) WHERE quarter IS DISTINCT FROM winning_quarter")
def latest_wins_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reduce_cases(table(spark, sf_dir, "cases"))[1]


@query("SELECT case_row_id, quarter, CASE WHEN role_cod = 'PS' THEN drugname END AS drugname, CASE WHEN role_cod IS DISTINCT FROM 'PS' THEN route END AS route FROM cases")
def union_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases")
    first = F.col("role_cod").eqNullSafe("PS")
    return R.union_all([c.where(first).select("case_row_id", "quarter", "drugname"), c.where(~first).select("case_row_id", "quarter", "route")])


@query(f"""SELECT reporter_country, count(DISTINCT CASE WHEN {_strip('primaryid')} <> '' THEN {_strip('primaryid')} END) + count(*) FILTER (WHERE {_strip('primaryid')} = '') AS cases FROM cases GROUP BY reporter_country""")
def distinct_case_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "cases").groupBy("reporter_country").agg(R.distinct_or_anonymous(F.col("primaryid")).alias("cases"))


@query(f"""SELECT quarter, primaryid, string_agg(DISTINCT v, '$' ORDER BY v) AS effects FROM (SELECT quarter, primaryid, {_strip('x')} AS v FROM (SELECT quarter, primaryid, unnest(string_split(effects, '$')) AS x FROM cases)) WHERE v <> '' GROUP BY ALL""")
def sorted_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases").select("quarter", "primaryid", F.explode(F.split("effects", r"\$")).alias("pt"))
    return R.pre_aggregated(c, ["quarter", "primaryid"], "pt", "effects")


@query("SELECT r_name, string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def sorted_pipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.groupBy("r_name").agg(S.sorted_join(F.collect_set("n_name")).alias("nations"))


@query(f"""SELECT {_key('nda_raw')} AS norm, {_strip('indication')} AS indication, arg_min(coalesce(drugname, ''), struct_pack(a := coalesce(primaryid, ''), b := coalesce(drug_seq, ''), c := case_row_id)) AS subject
FROM cases WHERE {_key('nda_raw')} <> '' AND {_strip('indication')} <> '' GROUP BY ALL""")
def first_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases").select(S.application_key(F.col("nda_raw")).alias("norm"), S.stripped(F.col("indication")).alias("indication"), *[S.text(F.col(x)).alias(x) for x in ("drugname", "primaryid", "drug_seq")], "case_row_id")
    return c.where("norm <> '' and indication <> ''").groupBy("norm", "indication").agg(R.first_by(F.col("drugname"), F.col("primaryid"), F.col("drug_seq"), F.col("case_row_id")).alias("subject"))


@query(f"""SELECT drugname, string_agg(v, '|' ORDER BY v) AS spellings FROM (SELECT drugname, {_key('nda_raw')} AS k, min({_strip('nda_raw')}) AS v FROM cases WHERE {_key('nda_raw')} <> '' GROUP BY ALL) GROUP BY drugname""")
def min_raw_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.min_raw_per_key(table(spark, sf_dir, "cases"), ["drugname"], S.application_key(F.col("nda_raw")), F.col("nda_raw"), "spellings")
    return rows.select("drugname", F.array_join("spellings", "|").alias("spellings"))


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "disease_terms")
    return t.select(F.col("term_id").alias("ordinal"), F.col("text").alias("term"), "curie", "name", "category")


@query("""SELECT i.indication, count(*) AS terms, arg_min(t.text, t.term_id) AS first_term FROM (SELECT DISTINCT indication FROM cases) i JOIN disease_terms t ON contains(lower(i.indication), lower(t.text)) GROUP BY i.indication""")
def dictionary_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "cases").select("indication").distinct()
    hits = R.dictionary_matches(texts, "indication", _terms(spark, sf_dir), "term", "ordinal").where(F.size("matches") > 0)
    return hits.select("indication", F.size("matches").cast("long").alias("terms"), F.get("matches", F.lit(0))["term"].alias("first_term"))


@query(f"""
WITH n AS (SELECT DISTINCT spl_set_id, {_norm("json_extract_string(payload, '$.ingredients[0].name')")} AS needle FROM label_records WHERE spl_set_id IS NOT NULL AND json_valid(payload))
SELECT d.doc_id, n.needle FROM documents d JOIN n USING (spl_set_id) WHERE n.needle <> '' AND contains(' ' || {_norm('d.text')} || ' ', ' ' || n.needle || ' ')""")
def verbatim_corroboration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ingredient of a label only, as its SQL says; `verbatim_ingredients` looks for all of them."""
    n = table(spark, sf_dir, "label_records").select("spl_set_id", S.normalize_text(F.get_json_object("payload", "$.ingredients[0].name")).alias("needle")).where("needle <> ''").distinct()
    d = table(spark, sf_dir, "documents").select("doc_id", "spl_set_id", S.normalize_text(F.col("text")).alias("text"))
    return d.join(n, "spl_set_id").where(S.contains_words(F.col("text"), F.col("needle"))).select("doc_id", "needle")


@query(OBJECTS + f""", n AS (SELECT DISTINCT spl_set_id, {_norm("j->>'$.name'")} AS needle FROM objects WHERE kind = 'ingredients' AND json_type(j) = 'OBJECT' AND spl_set_id IS NOT NULL)
SELECT DISTINCT d.doc_id, n.needle FROM documents d JOIN n USING (spl_set_id) WHERE n.needle <> '' AND contains(' ' || {_norm('d.text')} || ' ', ' ' || n.needle || ' ')""")
def verbatim_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct `(doc_id, needle)` of texts that name an ingredient of their label, at whatever position, depth and form."""
    r = table(spark, sf_dir, "label_records").where("spl_set_id is not null")
    names = nested.flat_tables(nested.emit_objects(r))["ingredients"].select("record_id", S.normalize_text(F.col("name")).alias("needle")).where("needle <> ''")
    n = names.join(r.select("record_id", "spl_set_id"), "record_id").select("spl_set_id", "needle").distinct()
    d = table(spark, sf_dir, "documents").select("doc_id", "spl_set_id", S.normalize_text(F.col("text")).alias("text"))
    return d.join(n, "spl_set_id").where(S.contains_words(F.col("text"), F.col("needle"))).select("doc_id", "needle").distinct()


@query(f"""SELECT c.quarter, count(*) AS cases, count(*) FILTER (WHERE p.k IS NOT NULL) AS mapped FROM (SELECT quarter, {_key('nda_raw')} AS k FROM cases) c LEFT JOIN (SELECT DISTINCT {_key('appl_no_stripped')} AS k FROM drugsfda_products WHERE {_key('appl_no_stripped')} <> '' AND {_strip('active_ingredient')} <> '') p ON c.k = p.k GROUP BY c.quarter""")
def gate_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = assertions.mapped_numbers(table(spark, sf_dir, "drugsfda_products")).withColumn("there", F.lit(True))
    c = table(spark, sf_dir, "cases").select("quarter", S.application_key(F.col("nda_raw")).alias("norm"))
    return c.join(known, "norm", "left").groupBy("quarter").agg(F.count(F.lit(1)).alias("cases"), F.count_if(F.col("there")).alias("mapped"))


@query(f"SELECT {_key('appl_no_stripped')} AS norm, string_agg(DISTINCT {_strip('active_ingredient')}, '|' ORDER BY {_strip('active_ingredient')}) AS ingredients FROM drugsfda_products WHERE {_key('appl_no_stripped')} <> '' AND {_strip('active_ingredient')} <> '' GROUP BY 1")
def ingredient_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.ingredient_sets(table(spark, sf_dir, "drugsfda_products")).select("norm", F.array_join("ingredients", "|").alias("ingredients"))


@query(f"""
WITH a AS (SELECT DISTINCT {_norm("coalesce(drug_name, '')")} AS d FROM drugsfda_products WHERE {_norm("coalesce(drug_name, '')")} <> '')
SELECT c.drugname AS subject_text, CASE WHEN a.d IS NOT NULL THEN 'approved_for_condition' ELSE 'off_label_use' END AS clinical_approval_status, count(*) AS n FROM cases c LEFT JOIN a ON {_norm('c.drugname')} = a.d GROUP BY ALL""")
def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "drugsfda_products").select(F.col("drug_name").alias("subject_text"), F.col("drug_name").alias("object_text"))
    c = table(spark, sf_dir, "cases").groupBy(F.col("drugname").alias("subject_text")).agg(F.count(F.lit(1)).alias("n"))
    return assertions.with_status(c.withColumn("object_text", F.col("subject_text")), p).select("subject_text", "clinical_approval_status", "n")


@query(f"""
WITH t AS (SELECT appl_no_stripped AS k, arg_min(appl_type, product_row_id) AS v FROM drugsfda_products WHERE coalesce(appl_type, '') <> '' GROUP BY k)
SELECT case_row_id, {_key('nda_raw')} AS appl_no_stripped, coalesce(t.v, '') AS appl_type FROM cases LEFT JOIN t ON t.k = {_key('nda_raw')}""")
def type_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "drugsfda_products").select("appl_no_stripped", "appl_type", F.col("product_row_id").alias("row_no"))
    c = table(spark, sf_dir, "cases").select("case_row_id", S.application_key(F.col("nda_raw")).alias("appl_no_stripped"), F.lit("").alias("appl_type"))
    return R.inherited(c, "appl_no_stripped", "appl_type", [p])


@query(f"""
WITH e AS (SELECT unnest([{{'t': 'proprietary_name', 'v': drug_name, 'at': 0}}, {{'t': 'nonproprietary_name', 'v': active_ingredient, 'at': 0}}, {{'t': 'product_ndc', 'v': product_ndc, 'at': 0}}, {{'t': 'marketing_status', 'v': marketing_status_name, 'at': 0}}]
  || list_transform(string_split(coalesce(active_ingredient, ''), ';'), lambda x, i: {{'t': 'ingredient', 'v': x, 'at': (i - 1)::INTEGER}})) AS s, appl_no, appl_no_stripped, appl_type, product_row_id FROM drugsfda_products WHERE appl_no_stripped <> ''),
f AS (SELECT s.t AS lookup_type, {_strip('s.v')} AS term, s.at AS pos, appl_no, appl_no_stripped, appl_type, product_row_id FROM e WHERE {_strip('s.v')} <> '')
SELECT lookup_type, term, appl_no, appl_no_stripped, appl_type FROM (SELECT *, row_number() OVER (PARTITION BY lookup_type, lower(term), appl_no_stripped ORDER BY product_row_id, pos, term) AS r FROM f) WHERE r = 1""")
def typed_lookup_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.typed_lookups(table(spark, sf_dir, "drugsfda_products"), ["product_row_id"])


@query(f"""SELECT spl_set_id, min(n) AS ingredient FROM (SELECT spl_set_id, lower({_strip('ingredient_name')}) AS n FROM spl_ingredients WHERE lower(role) = 'active') WHERE n <> '' GROUP BY spl_set_id HAVING count(DISTINCT n) = 1""")
def singleton_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "spl_ingredients").where(F.lower("role") == "active").select("spl_set_id", F.lower(S.stripped(F.col("ingredient_name"))).alias("ingredient")).where("ingredient <> ''")
    return R.singletons(i, "spl_set_id", "ingredient")


@query("""
SELECT subject, predicate, coalesce(array_to_string(list_sort(list_distinct(list(object) FILTER (WHERE object IS NOT NULL AND object <> ''))), '|'), '') AS objects, max(asserted_at) AS last_at, coalesce(min(nullif(knowledge_level, '')), '') AS knowledge_level
FROM broken_edges GROUP BY subject, predicate HAVING subject IS NOT NULL AND predicate IS NOT NULL""")
def edge_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "broken_edges").where("subject is not null and predicate is not null").select("subject", "predicate", F.array("object").alias("objects"), F.col("asserted_at").alias("last_at"), "knowledge_level")
    out = R.merged_edges(e, ["subject", "predicate"], ["objects"], maxima=["last_at"], firsts=["knowledge_level"])
    return out.withColumn("objects", F.array_join("objects", "|"))


@query(f"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang, lower({_collapse('text')}) ORDER BY source NULLS FIRST, doc_id) AS r FROM documents) WHERE r = 1""")
def dedupe_sort_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", S.dedupe_key(F.col("text")).alias("k"))
    return R.keep_first(d, ["lang", "k"], ["source", "doc_id"]).select("doc_id")


@query("""SELECT l.lang, s.source, count(d.doc_id) AS n FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL) l CROSS JOIN (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) s LEFT JOIN documents d ON d.lang = l.lang AND d.source = s.source GROUP BY ALL""")
def task_family_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", "source").where("lang is not null and source is not null")
    values = d.agg(F.collect_set("lang").alias("l"), F.collect_set("source").alias("s"))
    domain = values.select(F.explode("l").alias("lang"), "s").select("lang", F.explode("s").alias("source"))
    return quality.task_counts(d, domain, ["lang", "source"])


@query(f"""
WITH t AS (SELECT {_strip('id')} AS t, * FROM nodes),
p AS (SELECT t AS id, unnest(list_filter([CASE WHEN t = '' THEN 'node_missing_id' END, CASE WHEN {_strip('name')} = '' THEN 'node_missing_name' END, CASE WHEN coalesce(len(category), 0) = 0 THEN 'node_missing_category' END,
  CASE WHEN len(list_filter(category, lambda c: c IS NULL OR NOT starts_with(c, '{quality.CATEGORY_PREFIX}'))) > 0 THEN 'node_bad_prefix' END], lambda x: x IS NOT NULL)) AS code FROM t
  UNION ALL SELECT id, 'node_duplicate_id' FROM (SELECT t AS id, row_number() OVER (PARTITION BY t) AS r FROM t WHERE t <> '') WHERE r > 1)
SELECT id, code, count(*) AS n FROM p GROUP BY id, code""")
def node_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.node_problems(table(spark, sf_dir, "nodes")).groupBy("id", "code").agg(F.count(F.lit(1)).alias("n"))


_SUBJ, _OBJ = ("[" + ", ".join(f"'{c}'" for c in names) + "]" for names in (quality.SUBJECTS, quality.OBJECTS))
_NEED = "CASE predicate " + " ".join(f"WHEN '{k}' THEN [{', '.join(repr(u) for u in v)}]" for k, v in quality.UPSTREAM.items()) + " ELSE [] END"


def _clean(x: str) -> str:
    return f"list_filter(list_transform(coalesce({x}, []), lambda c: {_strip('c')}), lambda c: c <> '')"


_PRED = _strip("e.predicate")


@query(f"""
WITH n AS (SELECT {_strip('id')} AS id, list_distinct(flatten(list({_clean('category')}))) AS c FROM nodes WHERE {_strip('id')} <> '' GROUP BY 1),
e AS (SELECT e.* EXCLUDE (predicate), {_PRED} AS predicate, {_PRED} IN ({', '.join(repr(k) for k in quality.UPSTREAM)}) AS known, s.c AS sc, o.c AS oc, {_strip('e.primary_knowledge_source')} = '' AND len(coalesce(sources, [])) = 0 AS bare,
      {_clean("list_concat(list_concat(list_transform(coalesce(sources, []), lambda x: x.resource_id), flatten(list_transform(coalesce(sources, []), lambda x: coalesce(x.upstream_resource_ids, [])))), [primary_knowledge_source])")} AS named
      FROM broken_edges e LEFT JOIN n s ON s.id = {_strip('e.subject')} LEFT JOIN n o ON o.id = {_strip('e.object')}),
p AS (SELECT {_strip('id')} AS id, unnest(list_filter([CASE WHEN {_strip('id')} = '' THEN 'edge_missing_id' END, {', '.join(f"CASE WHEN {_strip(c)} = '' THEN 'edge_missing_{c}' END" for c in quality.REQUIRED)},
  CASE WHEN len({_clean('category')}) = 0 THEN 'edge_missing_category' END, CASE WHEN predicate <> '' AND NOT known THEN 'edge_unknown_predicate' END,
  CASE WHEN {_strip('subject')} <> '' AND sc IS NULL THEN 'edge_dangling_subject' END, CASE WHEN {_strip('object')} <> '' AND oc IS NULL THEN 'edge_dangling_object' END,
  CASE WHEN known AND sc IS NOT NULL AND NOT list_has_any(sc, {_SUBJ}) THEN 'edge_subject_category' END, CASE WHEN known AND oc IS NOT NULL AND NOT list_has_any(oc, {_OBJ}) THEN 'edge_object_category' END,
  CASE WHEN bare THEN 'edge_missing_provenance' END, CASE WHEN NOT bare AND NOT list_contains(named, 'infores:own-approvals') THEN 'edge_missing_provider' END,
  CASE WHEN NOT bare AND len(list_filter({_NEED}, lambda u: NOT list_contains(named, u))) > 0 THEN 'edge_missing_upstream' END], lambda x: x IS NOT NULL)) AS code FROM e
  UNION ALL SELECT id, 'edge_duplicate_id' FROM (SELECT {_strip('id')} AS id, row_number() OVER (PARTITION BY {_strip('id')}) AS r FROM broken_edges) WHERE id <> '' AND r > 1)
SELECT id, code, count(*) AS n FROM p GROUP BY id, code""")
def edge_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.edge_problems(table(spark, sf_dir, "broken_edges"), table(spark, sf_dir, "nodes"), assertions.PRIMARY_SOURCE)
    return found.groupBy("id", "code").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH v AS (SELECT l_orderkey, l_partkey, l_linenumber, unnest(list_filter([CASE WHEN l_discount > 0.09 THEN 'high_discount' END, CASE WHEN l_quantity < 2 THEN 'low_quantity' END, CASE WHEN NOT regexp_matches(l_returnflag, '^[AR]$') THEN 'other_flag' END], lambda x: x IS NOT NULL)) AS code FROM lineitem)
SELECT code, count(*) AS count, arg_min(l_orderkey, struct_pack(a := l_orderkey, b := l_partkey, c := l_linenumber))::VARCHAR AS example FROM v GROUP BY code""")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"high_discount": F.col("l_discount") > 0.09, "low_quantity": F.col("l_quantity") < 2, "other_flag": ~F.col("l_returnflag").rlike("^[AR]$")}
    return quality.violations(table(spark, sf_dir, "lineitem"), checks, F.col("l_orderkey").cast("string"), [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")])


def _cell(x: str) -> str:
    return f"CASE WHEN {_strip(x)} <> '' THEN {_strip(x)} ELSE 'NA' END"


@query(f"SELECT {_cell('id')} AS id, {_cell('name')} AS name, {_cell('category[1]')} AS category FROM nodes")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.export_nodes(table(spark, sf_dir, "nodes"))


@query(f"""
WITH n AS (SELECT {_strip('id')} AS id, coalesce(min(nullif({_strip('name')}, '')), 'NA') AS n FROM nodes WHERE {_strip('id')} <> '' GROUP BY 1)
SELECT {_cell('e.id')} AS id, {_cell('e.subject')} AS subject, {_cell('e.predicate')} AS predicate, {_cell('e.object')} AS object, coalesce(s.n, {_cell("'the ' || e.subject")}) AS subject_name, coalesce(o.n, {_cell("'the ' || e.object")}) AS object_name,
  'NA' AS object_modifier, {_cell('e.knowledge_level')} AS knowledge_level, {_cell('e.agent_type')} AS agent_type, CASE WHEN len(e.sources[1].upstream_resource_ids) > 0 THEN array_to_string(e.sources[1].upstream_resource_ids, ',') ELSE 'NA' END AS approval,
  coalesce(month(e.asserted_at)::VARCHAR, 'NA') AS "N_cases", {_cell('e.primary_knowledge_source')} AS supporting_spls
FROM broken_edges e LEFT JOIN n s ON s.id = {_strip('e.subject')} LEFT JOIN n o ON o.id = {_strip('e.object')}""")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "broken_edges").withColumns({
        "approval_ids": F.get("sources", F.lit(0))["upstream_resource_ids"], "evidence_count": F.month("asserted_at"), "has_evidence": F.col("primary_knowledge_source"),
        "original_subject": F.concat(F.lit("the "), "subject"), "original_object": F.concat(F.lit("the "), "object"),
    })
    return exports.export_edges(e, table(spark, sf_dir, "nodes"))


@query("""SELECT id, array_to_string(list_sort(list_filter(['infores:labels', 'infores:reports'], lambda u: NOT list_contains(flatten(list_transform(coalesce(sources, []), lambda s: coalesce(s.upstream_resource_ids, []))), u))), '|') AS lacking FROM broken_edges""")
def upstream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.upstream_gaps(table(spark, sf_dir, "broken_edges"), ("infores:labels", "infores:reports"))


# Terms for the vocabulary queries, none of which overlaps another in part.
VOCABULARY = ("blurred vision", "weight loss", "dry mouth", "platelet count", "serum creatinine", "starting dose", "night time nausea", "nausea", "patients", "dosis", "behandlung", "grossesse")
TERMS = {**dict.fromkeys(VOCABULARY, "phenotype"), **T.CLINICAL_TERMS}
_ALTERNATIVES = "|".join(sorted(TERMS, key=lambda t: (-len(t), t)))


@query(f"""SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(regexp_extract_all({_norm('text')}, '\\b(?:{_ALTERNATIVES})\\b')) AS term FROM documents) GROUP BY term""")
def vocabulary_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(T.regex_mentions(S.normalize_text(F.col("text")), list(TERMS))).alias("term"))
    return d.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(f"""SELECT doc_id, term, count(*) AS n, min(type) AS type FROM (SELECT doc_id, term, CASE WHEN term IN ({', '.join(repr(t) for t, k in TERMS.items() if k == 'disease')}) THEN 'disease' ELSE 'phenotype' END AS type
  FROM (SELECT doc_id, unnest(regexp_extract_all({_norm('text')}, '\\b(?:{_ALTERNATIVES})\\b')) AS term FROM documents WHERE {_norm('text')} NOT IN ({', '.join(repr(t) for t in T.IGNORED)}))) GROUP BY doc_id, term""")
def gazetteer_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = T.mined(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", T.default_recogniser(TERMS).match)
    return found.select("doc_id", F.explode("mentions").alias("m")).groupBy("doc_id", F.col("m.normalized").alias("term")).agg(F.count(F.lit(1)).alias("n"), F.min("m.type").alias("type"))


@query()
def gazetteer_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    gazetteer = T.default_recogniser(TERMS)
    found = T.mined(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", gazetteer.match)
    return found.select("doc_id", F.explode("mentions").alias("m")).select("doc_id", "m.start", "m.end", "m.text", "m.type", "m.normalized")


@query("""
WITH g AS (SELECT doc_id, instr(text, 'nausea') AS s FROM documents WHERE instr(text, 'nausea') > 0), f AS (SELECT doc_id, instr(text, 'generalised nausea') + 12 AS s FROM documents WHERE instr(text, 'generalised nausea') > 0),
n AS (SELECT count(*) FILTER (WHERE g.s IS NOT NULL AND f.s IS NOT NULL) AS tp, count(*) FILTER (WHERE g.s IS NULL) AS fp, count(*) FILTER (WHERE f.s IS NULL) AS fn FROM g FULL JOIN f ON g.doc_id = f.doc_id AND g.s = f.s)
SELECT tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM n""")
def span_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    gold = d.select("doc_id", F.instr("text", "nausea").alias("start")).where("start > 0")
    found = d.select("doc_id", F.instr("text", "generalised nausea").alias("start")).where("start > 0").withColumn("start", F.col("start") + 12)
    return quality.span_scores(gold, found, ["doc_id", "start"])


@query(f"""
WITH r AS (SELECT {_strip('indication')} AS text, coalesce(source_record_id, '') AS source_record_id FROM cases WHERE {_strip('indication')} <> '' AND NOT regexp_matches({_strip('indication')}, '{_STOP}')),
d AS (SELECT *, row_number() OVER (PARTITION BY lower({_collapse('text')}) ORDER BY source_record_id, text) AS k FROM r)
SELECT 'observed_use' AS task, text, source_record_id FROM d WHERE k = 1""")
def training_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "cases").withColumn("quarter", F.lit(None).cast("string"))
    return exports.deduplicated(exports.case_candidates(c)).select("task", "text", "source_record_id")


@query(f"SELECT {', '.join(f'coalesce({c}::VARCHAR, {chr(39)*2}) AS {c}' for c in CASES)} FROM cases")
def conformed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.schemas import conform

    return conform(table(spark, sf_dir, "cases"), CASES)
