"""The three relations between drugs and conditions, as compositions of operators.

approved: case pairs that pass four gates against products and labels. observed: drug-indication pairs
with distinct case counts and a status. contraindicated: conditions mined from label sections by
polarity. Arrays inside, pipe-joined cells only in the final projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.operators import relational as R
from lodestone.operators import textmine as T
from lodestone.runtime import materialize, sorted_side
from lodestone.schemas import APPROVED, CONTRAINDICATIONS, OBSERVED, conform

PRIMARY_SOURCE, LABEL_SOURCE, REPORT_SOURCE = "infores:own-approvals", "infores:labels", "infores:reports"
TYPE_CATEGORIES = {"disease": "Disease", "phenotype": "PhenotypicFeature"}
Miner = Callable[[str], list[dict]]


@dataclass
class LabelEvidence:
    """The label tables in joinable form; nothing is collected."""

    approvals: DataFrame  # norm, spl_set_id, display, place
    ingredients: DataFrame  # spl_set_id, name, unii, place: distinct active ingredients
    singles: DataFrame  # the same, of labels with exactly one
    sections: DataFrame  # spl_set_id, doc_id, loinc_code, text, ordinal


def label_evidence(approvals: DataFrame, ingredients: DataFrame, sections: DataFrame) -> LabelEvidence:
    """Evidence from the flat label tables; blank keys go, texts prefer the cleaned form.

    An approval shows as type and number. An ingredient counts once per label, name (any case) and
    code, under the name at the first place (ordinal, at) if the table has places; a label is single
    if it has one such ingredient. Places also decide which approval of a number comes first.
    """
    place = lambda df, name: F.struct(*[F.col(c) for c in ("ordinal", "at") if c in df.columns], F.col(name))
    norm = S.application_key(F.coalesce(F.nullif(S.stripped(F.col("approval_id")), F.lit("")), F.col("approval_code")))
    base = F.coalesce(F.nullif(S.stripped(F.col("approval_id")), F.lit("")), S.stripped(F.col("approval_code")))
    a = approvals.select(norm.alias("norm"), S.stripped(F.col("spl_set_id")).alias("spl_set_id"), F.when(base != "", F.concat(S.stripped(F.col("approval_type")), base)).alias("display"), place(approvals, "approval_id").alias("place"))
    a = a.where("norm <> '' and spl_set_id <> ''").withColumn("display", F.coalesce("display", "norm")).groupBy("norm", "spl_set_id", "display").agg(F.min("place").alias("place"))
    i = ingredients.where(F.lower(S.stripped(F.col("role"))) == "active").select(S.stripped(F.col("spl_set_id")).alias("spl_set_id"), S.stripped(F.col("ingredient_name")).alias("name"), S.stripped(F.col("ingredient_unii")).alias("unii"), place(ingredients, "ingredient_name").alias("place"))
    i = i.where("spl_set_id <> '' and name <> ''").groupBy("spl_set_id", F.lower("name").alias("fold"), "unii").agg(F.min_by("name", "place").alias("name"), F.min("place").alias("place")).drop("fold")
    count = i.groupBy("spl_set_id").agg(F.count(F.lit(1)).alias("n"))
    singles = i.join(sorted_side(count.where("n = 1")), "spl_set_id").drop("n")
    own = F.coalesce(F.nullif(S.stripped(F.col("clean_text")), F.lit("")), S.stripped(F.col("raw_text")))
    s = sections.select(
        S.stripped(F.col("spl_set_id")).alias("spl_set_id"), S.stripped(F.col("spl_document_id")).alias("doc_id"), S.stripped(F.col("loinc_code")).alias("loinc_code"), own.alias("text"),
        F.xxhash64("spl_document_id", "raw_text", *[c for c in ("ordinal", "at") if c in sections.columns]).alias("section_id"),
    ).where("spl_set_id <> ''")
    return LabelEvidence(a, i, singles, s)


def _dictionary_object(rows: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """rows with object_curie/name/category (and object_term) of the first dictionary term in the text."""
    hits = R.dictionary_matches(rows, text, terms, "term", "ordinal")
    first = F.get("matches", F.lit(0))
    return hits.withColumn("object_term", first["term"]).withColumn("object_curie", F.coalesce(first["curie"], F.lit(""))).withColumn(
        "object_name", F.coalesce(first["name"], F.col(text))
    ).withColumn("object_category", F.coalesce(first["category"], F.lit("Disease")))


def _case_rows(cases: DataFrame) -> DataFrame:
    """`(norm, object_text, fallback, quarter, primaryid, record, seq)`: rows with a number and an indication that is no placeholder."""
    col = lambda c: S.text(F.col(c)) if c in cases.columns else F.lit("")
    return cases.select(
        S.application_key(F.when(col("nda") != "", col("nda")).otherwise(col("nda_raw"))).alias("norm"), S.stripped(col("indication")).alias("object_text"),
        S.stripped(F.when(col("ingredient") != "", col("ingredient")).otherwise(col("drugname"))).alias("fallback"), F.upper(S.stripped(col("quarter"))).alias("quarter"),
        S.stripped(col("primaryid")).alias("primaryid"), S.stripped(col("source_record_id")).alias("record"), col("drug_seq").alias("seq"),
    ).where("norm <> '' and object_text <> ''").where(~S.is_placeholder(F.col("object_text")))


def case_pairs(cases: DataFrame, quarter_urls: DataFrame | None = None, numbers: DataFrame | None = None) -> DataFrame:
    """`(norm, object_text, fallback, records, urls)` per number and indication, of the given numbers only if there are any.

    The fallback subject is that of the first report by (primaryid, drug_seq, record id), even if it is
    blank. Placeholder indications and blank keys go. quarter_urls `(quarter, url)` overrides the
    derived URLs.
    """
    rows = _case_rows(cases)
    if numbers is not None:
        rows = rows.join(numbers, "norm", "left_semi")
    url = F.when((F.col("quarter") != "") & (F.col("primaryid") != ""), S.quarter_url(F.col("quarter")))
    if quarter_urls is not None:
        rows = rows.join(quarter_urls.select("quarter", F.col("url").alias("known")), "quarter", "left")
        url = F.when((F.col("quarter") != "") & (F.col("primaryid") != ""), F.coalesce("known", S.quarter_url(F.col("quarter"))))
    # sets are combined before the one shuffle, so a hot pair moves its distinct values of each partition only
    first = F.min(F.struct("primaryid", "seq", "record", "fallback"))["fallback"]
    of = lambda c: F.array_sort(F.collect_set(F.when(c != "", c)))
    return rows.groupBy("norm", "object_text").agg(first.alias("fallback"), of(F.col("record")).alias("records"), of(url).alias("urls"))


def case_candidates(cases: DataFrame, terms: DataFrame, quarter_urls: DataFrame | None = None, numbers: DataFrame | None = None) -> DataFrame:
    """case_pairs() with the object's dictionary entry: `(norm, object_text, object_curie, object_name, object_category, fallback, records, urls)`."""
    return _dictionary_object(materialize(case_pairs(cases, quarter_urls, numbers), "pairs"), "object_text", terms).drop("matches", "object_term")


def mapped_numbers(products: DataFrame) -> DataFrame:
    """`norm`: numbers of products with an ingredient (the first gate)."""
    return products.where(S.stripped(F.col("active_ingredient")) != "").select(S.application_key(F.col("appl_no_stripped")).alias("norm")).where("norm <> ''").distinct()


def ingredient_sets(products: DataFrame) -> DataFrame:
    """`(norm, ingredients)`: the distinct ingredient texts of each number's products, sorted."""
    rows = products.select(S.application_key(F.col("appl_no_stripped")).alias("norm"), S.stripped(F.col("active_ingredient")).alias("ingredient"))
    return rows.where("norm <> '' and ingredient <> ''").groupBy("norm").agg(F.array_sort(F.collect_set("ingredient")).alias("ingredients"))


def contraindicated_labels(evidence: LabelEvidence) -> DataFrame:
    """`(drug, spl_set_id)`: labels with a contraindication section by the lower-case name of their first active ingredient."""
    warned = evidence.sections.where("loinc_code = '34070-3'").select("spl_set_id").distinct()
    first = evidence.ingredients.groupBy("spl_set_id").agg(F.min_by("name", F.struct("place", "name")).alias("name"))
    return first.join(warned, "spl_set_id", "left_semi").select(F.lower("name").alias("drug"), "spl_set_id")


def backed_numbers(evidence: LabelEvidence) -> DataFrame:
    """`norm`: numbers of labels with an indication section (the second and third gate)."""
    indicated = evidence.sections.where("loinc_code = '34067-9'").select("spl_set_id").distinct()
    return evidence.approvals.join(sorted_side(indicated), "spl_set_id", "left_semi").select("norm").distinct()


def label_candidates(evidence: LabelEvidence, terms: DataFrame, miner: Miner | None = None) -> DataFrame:
    """Candidates without a case table: dictionary terms and mentions in indication sections of approved labels."""
    numbers = evidence.approvals.select("spl_set_id", "norm").distinct()
    hits = R.dictionary_matches(evidence.sections.where("loinc_code = '34067-9'"), "text", terms, "term", "ordinal")
    at = ["spl_set_id", "doc_id", "section_id"]
    named = hits.select(*at, F.explode("matches").alias("x")).select(*at, F.col("x.ordinal").alias("rank"), F.col("x.term").alias("object_text"), F.col("x.curie").alias("object_curie"), F.col("x.name").alias("object_name"), F.col("x.category").alias("object_category"))
    if miner is not None:
        found = T.mined(hits, "text", miner)
        known = F.transform("matches", lambda x: S.normalize_text(x["term"]))
        behind = F.lit(1 << 40) + F.col("m.start")  # mentions come after a section's dictionary terms
        said = found.select(*at, known.alias("known"), F.explode("mentions").alias("m")).select(*at, "known", behind.alias("rank"), S.normalize_text(F.col("m.text")).alias("object_text"))
        said = said.where((F.col("object_text") != "") & ~F.array_contains("known", F.col("object_text"))).drop("known")
        named = named.unionByName(_dictionary_object(said, "object_text", terms).drop("matches", "object_term"))
    empty = F.array().cast("array<string>")
    first = R.keep_first(named.join(numbers, "spl_set_id"), ["norm", "object_text"], [*at, "rank"]).drop(*at, "rank")
    return first.select("*", F.lit("").alias("fallback"), empty.alias("records"), empty.alias("urls"))


def _marks(candidates: DataFrame, evidence: LabelEvidence, terms: DataFrame, miner: Miner | None = None) -> tuple[DataFrame, DataFrame]:
    """(wanted, given): `(norm, object_text, mark)` that would name a candidate, and `(norm, mark, spl_set_id, docs)` that labels hold.

    A mark is a CURIE, a term, a phrase or a mention with its kind before it, so that candidates and
    labels meet by equality within a number. Texts are searched once each, whatever the number of
    labels that share them or of candidates that ask.
    """
    mark = lambda kind, c: F.concat(F.lit(f"{kind}:"), c)
    docs = evidence.sections.where("loinc_code = '34067-9'").select("spl_set_id", "doc_id", "text").distinct()
    hits = R.dictionary_matches(docs.select("text").distinct(), "text", terms, "term", "ordinal")
    if miner is not None:
        hits = T.mined(hits, "text", miner).withColumn("said", F.transform("mentions", lambda m: S.normalize_text(m["text"])))
    else:
        hits = hits.withColumn("said", F.array().cast("array<string>"))
    own = lambda x, curie, term: F.array(F.when(curie != "", mark("curie", curie)), mark("term", term), F.when(curie == "", mark("bare", term)))
    named = F.flatten(F.transform("matches", lambda x: own(x, F.coalesce(x["curie"], F.lit("")), S.normalize_text(x["term"]))))
    marks = F.array_distinct(F.array_compact(F.concat(named, F.transform("said", lambda m: mark("mention", m)))))
    texts = materialize(hits.select(F.monotonically_increasing_id().alias("text_id"), "text", S.normalize_text(F.col("text")).alias("words"), "said", marks.alias("marks")), "texts")
    curie, needle = F.col("curie"), F.col("needle")
    asked = candidates.select("norm", "object_text", F.coalesce("object_curie", F.lit("")).alias("curie"), S.normalize_text(F.col("object_text")).alias("needle")).where("needle <> ''")
    asked = materialize(asked, "asked")
    # a term counts if its CURIE is the candidate's, or by its text if either has none
    ways = F.array(F.when(curie != "", mark("curie", curie)), F.when(curie == "", mark("term", needle)).otherwise(mark("bare", needle)), mark("phrase", needle))
    wanted = asked.select("norm", "object_text", F.explode(F.array_compact(ways)).alias("mark"))
    if miner is not None:
        parts = R.phrase_matches(asked.select("needle").distinct(), "needle", "needle", texts.select(F.explode("said").alias("phrase")), "phrase")
        wanted = wanted.unionByName(asked.join(sorted_side(parts), "needle").select("norm", "object_text", mark("mention", F.col("phrase")).alias("mark")))
    said = texts.select("text_id", F.explode("marks").alias("mark")).unionByName(
        R.phrase_matches(texts, "text_id", "words", asked, "needle").select("text_id", mark("phrase", needle).alias("mark"))
    )
    labels = evidence.approvals.select("norm", "spl_set_id").distinct()
    at = docs.join(sorted_side(texts.select("text_id", "text")), "text").select("text_id", "spl_set_id", "doc_id")
    given = said.join(sorted_side(at), "text_id").join(sorted_side(labels), "spl_set_id").groupBy("norm", "mark", "spl_set_id").agg(F.collect_set("doc_id").alias("docs"))
    return wanted, given


def corroborated(candidates: DataFrame, evidence: LabelEvidence, terms: DataFrame, miner: Miner | None = None) -> DataFrame:
    """`(norm, object_text, spl_set_id, docs)`: approved labels whose indication section names the candidate's condition.

    Named: by a dictionary term of the same CURIE (or the same text, if either has none), verbatim on
    word bounds, or by a mention that equals the condition or is a part of it.
    """
    wanted, given = _marks(candidates, evidence, terms, miner)
    return wanted.join(sorted_side(given), ["norm", "mark"]).groupBy("norm", "object_text", "spl_set_id").agg(F.array_distinct(F.flatten(F.collect_set("docs"))).alias("docs"))


def _provenance(c: DataFrame) -> DataFrame:
    """Pipe-joined label columns of `sets` and `docs` arrays."""
    curies = S.sorted_join(F.transform(F.concat("sets", "docs"), S.label_curie))
    return c.withColumns({
        "supporting_spl_sets": S.sorted_join(F.transform("sets", S.label_url)), "supporting_spl_documents": S.sorted_join(F.transform("docs", S.label_url)),
        "supporting_spl_evidence": curies, "edge_evidence": curies,
    })


def approved_treats(candidates: DataFrame, evidence: LabelEvidence, products: DataFrame, terms: DataFrame, miner: Miner | None = None) -> DataFrame:
    """The approved relation in its contract's columns.

    Gates in order: the number is that of a product with an ingredient; it has a label with an
    indication section; the section names the condition; there is a subject. The subject is the
    ingredient of the first supporting label with a single one, else the report's own. Candidates are
    best made of the numbers that pass the first gates (approved_from_cases does so).
    """
    passed = materialize(candidates.join(mapped_numbers(products), "norm", "left_semi"), "candidates")
    support = corroborated(passed, evidence, terms, miner)
    single = evidence.singles.select("spl_set_id", F.struct("name", "unii").alias("drug"))
    gathered = support.join(sorted_side(single), "spl_set_id", "left").groupBy("norm", "object_text").agg(
        F.collect_set("spl_set_id").alias("sets"), F.array_distinct(F.flatten(F.collect_list("docs"))).alias("docs"), F.min_by("drug", F.when(F.col("drug").isNotNull(), F.col("spl_set_id"))).alias("drug")
    )
    display = evidence.approvals.groupBy("norm").agg(F.min_by("display", F.struct("place", "display")).alias("display"))
    full = passed.join(sorted_side(gathered), ["norm", "object_text"]).join(display, "norm", "left")
    full = full.withColumn("subject_text", F.coalesce("drug.name", S.stripped(F.col("fallback")))).withColumn("subject_curie", F.coalesce("drug.unii", F.lit(""))).where("subject_text <> ''")
    full = full.withColumn("approval", F.array(F.coalesce("display", "norm")))
    edges = R.merged_edges(full, ["subject_text", "object_text"], ["approval", "sets", "docs", "records", "urls"], firsts=["subject_curie", "object_curie", "object_name", "object_category"], order=["norm"])
    out = _provenance(edges).withColumns({
        "subject_name": F.col("subject_text"), "subject_category": F.lit("ChemicalEntity"), "predicate": F.lit("biolink:treats"), "approval_ids": S.sorted_join(F.col("approval")),
        "supporting_faers_records": S.sorted_join(F.col("records")), "supporting_faers_urls": S.sorted_join(F.col("urls")), "clinical_approval_status": F.lit("approved_for_condition"),
        "knowledge_level": F.lit("knowledge_assertion"), "agent_type": F.lit("manual_validation_of_automated_agent"), "primary_knowledge_source": F.lit(PRIMARY_SOURCE),
        "upstream_resource_ids": F.lit(f"{LABEL_SOURCE}|{REPORT_SOURCE}"),
    })
    return conform(out, APPROVED)


def approved_from_cases(cases: DataFrame, evidence: LabelEvidence, products: DataFrame, terms: DataFrame, miner: Miner | None = None, quarter_urls: DataFrame | None = None) -> DataFrame:
    """approved_treats() of a case table: only rows whose number passes the first gates are grouped and looked up."""
    numbers = mapped_numbers(products).join(backed_numbers(evidence), "norm", "left_semi")
    return approved_treats(case_candidates(cases, terms, quarter_urls, numbers), evidence, products, terms, miner)


def gate_counts(cases: DataFrame, evidence: LabelEvidence, products: DataFrame, terms: DataFrame, miner: Miner | None = None) -> DataFrame:
    """How many candidates of a case table fall at each gate, counted at the first they fail: `(gate, candidates)`.

    Conditions are looked up only for those that pass the gates on numbers; labels are told apart only
    by whether one with a single ingredient is among them, so nothing grows with candidates times labels.
    """
    flag = lambda df, name: df.withColumn(name, F.lit(True))
    first = F.min(F.struct("primaryid", "seq", "record", "fallback"))["fallback"]
    pairs = _case_rows(cases).groupBy("norm", "object_text").agg(first.alias("fallback"))
    pairs = materialize(pairs.join(flag(mapped_numbers(products), "mapped"), "norm", "left").join(flag(backed_numbers(evidence), "backed"), "norm", "left"), "candidates")
    open_pairs = _dictionary_object(pairs.where("mapped and backed").select("norm", "object_text"), "object_text", terms).drop("matches", "object_term")
    wanted, given = _marks(open_pairs, evidence, terms, miner)
    single = flag(evidence.singles.select("spl_set_id").distinct(), "single")
    given = given.join(sorted_side(single), "spl_set_id", "left").groupBy("norm", "mark").agg(F.bool_or(F.col("single").isNotNull()).alias("single"))
    named = wanted.join(sorted_side(given), ["norm", "mark"]).groupBy("norm", "object_text").agg(F.lit(True).alias("named"), F.bool_or("single").alias("single"))
    rows = pairs.join(sorted_side(named), ["norm", "object_text"], "left")
    gate = (
        F.when(F.col("mapped").isNull(), "no_product").when(F.col("backed").isNull(), "no_label").when(F.col("named").isNull(), "not_named")
        .when(~F.col("single") & (S.stripped(F.col("fallback")) == ""), "no_subject").otherwise("passed")
    )
    return rows.groupBy(gate.alias("gate")).agg(F.count(F.lit(1)).alias("candidates"))


def with_status(rows: DataFrame, approved: DataFrame | None) -> DataFrame:
    """rows with clinical_approval_status: whether the normalised pair of subject and object is approved; not_provided without an approved table."""
    if approved is None:
        return rows.withColumn("clinical_approval_status", F.lit("not_provided"))
    keys = {"__s": S.normalize_text(F.col("subject_text")), "__o": S.normalize_text(F.col("object_text"))}
    known = approved.select(*[v.alias(k) for k, v in keys.items()]).where("__s <> '' and __o <> ''").distinct().withColumn("__is", F.lit(True))
    met = rows.withColumns(keys).join(sorted_side(known), list(keys), "left")
    return met.withColumn("clinical_approval_status", F.when(F.col("__is"), "approved_for_condition").otherwise("off_label_use")).drop("__s", "__o", "__is")


def observed_uses(cases: DataFrame, terms: DataFrame, approved: DataFrame | None = None, miner: Miner | None = None, quarter_urls: DataFrame | None = None) -> DataFrame:
    """The observed relation in its contract's columns: a row per drug and indication as reported.

    case_count is the number of distinct primary ids plus the rows without one. The object is the first
    dictionary term in the indication, else its single mention, else the indication. The status says
    whether the normalised pair is approved; without an approved table it is not_provided.
    """
    col = lambda c: S.text(F.col(c)) if c in cases.columns else F.lit("")
    rows = cases.select(
        S.stripped(col("drugname")).alias("subject_text"), S.stripped(col("indication")).alias("indication"), S.stripped(col("primaryid")).alias("primaryid"),
        S.stripped(F.when(col("nda_raw") != "", col("nda_raw")).otherwise(col("nda"))).alias("raw"), F.upper(S.stripped(col("quarter"))).alias("quarter"), S.stripped(col("source_record_id")).alias("record"),
    ).where("subject_text <> '' and indication <> ''").where(~S.is_placeholder(F.col("indication")))
    pair = ["subject_text", "indication"]
    url = S.quarter_url(F.col("quarter"))
    if quarter_urls is not None:
        rows = rows.join(quarter_urls.select("quarter", F.col("url").alias("known")), "quarter", "left")
        url = F.coalesce("known", url)
    rows = rows.withColumn("url", F.when((F.col("quarter") != "") & (F.col("primaryid") != ""), url))
    # sets are combined before the one shuffle; of the spellings of a number the least one counts
    of = lambda c: F.collect_set(F.when(c != "", c))
    number = F.when(F.col("key") != "", F.struct("key", "raw"))
    full = rows.withColumn("key", S.application_key(F.col("raw"))).groupBy(*pair).agg(
        (F.size(of(F.col("primaryid"))) + F.count_if(F.col("primaryid") == "")).alias("case_count"), F.array_sort(of(F.col("record"))).alias("records"), F.array_sort(of(F.col("url"))).alias("urls"), F.array_sort(F.collect_set(number)).alias("__n"),
    )
    least = F.filter("__n", lambda x, i: (i == 0) | (x["key"] != F.get("__n", i - 1)["key"]))
    full = full.withColumn("approval", F.array_sort(F.transform(least, lambda x: x["raw"]))).drop("__n")
    full = _dictionary_object(full, "indication", terms)
    if miner is not None:
        missed = full.where("object_term is null").select(S.normalize_text(F.col("indication")).alias("key")).where("key <> ''").distinct()
        categories = F.create_map(*[F.lit(x) for kv in TYPE_CATEGORIES.items() for x in kv])
        said = T.mined(missed, "key", miner).where(F.size("mentions") == 1).select("key", S.normalize_text(F.get("mentions", F.lit(0))["text"]).alias("said"), categories[F.lower(F.get("mentions", F.lit(0))["type"])].alias("said_category"))
        full = full.join(said.where("said <> '' and said_category is not null"), (S.normalize_text(F.col("indication")) == F.col("key")) & F.col("object_term").isNull(), "left").drop("key")
        full = full.withColumn("object_name", F.coalesce("said", "object_name")).withColumn("object_category", F.coalesce("said_category", "object_category")).withColumn("object_text", F.coalesce("object_term", "said", "indication"))
    else:
        full = full.withColumn("object_text", F.coalesce("object_term", "indication"))
    full = with_status(full, approved)
    out = full.withColumns({
        "subject_curie": F.lit(""), "subject_name": F.col("subject_text"), "subject_category": F.lit("ChemicalEntity"), "predicate": F.lit("biolink:applied_to_treat"),
        "approval_ids": S.sorted_join(F.col("approval")), "edge_evidence": F.lit(""), "supporting_faers_records": S.sorted_join(F.col("records")),
        "supporting_faers_urls": S.sorted_join(F.col("urls")), "knowledge_level": F.lit("statistical_association"),
        "agent_type": F.lit("manual_validation_of_automated_agent"), "primary_knowledge_source": F.lit(PRIMARY_SOURCE), "upstream_resource_ids": F.lit(f"{REPORT_SOURCE}|{LABEL_SOURCE}"),
    })
    return conform(out, OBSERVED)


def contraindications(evidence: LabelEvidence, miner: Miner, keywords: str = T.KEYWORDS) -> DataFrame:
    """The contraindication relation in its contract's columns, from labels with a single active ingredient.

    Sections are keyed by their own id, as a section code may repeat within a label.
    """
    items = T.work_items(evidence.sections, evidence.singles, keywords)
    decided = T.classified(T.mined(items, "text", miner), ["section_id", "spl_set_id", "doc_id"]).where("accepted")
    labels = evidence.approvals.groupBy("spl_set_id").agg(F.array_sort(F.collect_set("display")).alias("approval"))
    rows = decided.join(sorted_side(evidence.singles), "spl_set_id").join(sorted_side(labels), "spl_set_id", "left").select(
        F.col("name").alias("subject_text"), F.col("unii").alias("subject_curie"), S.normalize_text(F.col("m.text")).alias("object_text"), S.pipe_safe(F.col("context_text")).alias("disease_context_text"),
        F.array("spl_set_id").alias("sets"), F.array("doc_id").alias("docs"), F.coalesce("approval", F.array().cast("array<string>")).alias("approval"), F.array(S.pipe_safe(F.col("evidence_text"))).alias("evidence"), F.col("m.score").alias("score"),
    ).where("object_text <> ''")
    edges = R.merged_edges(rows, ["subject_text", "object_text", "disease_context_text"], ["sets", "docs", "approval", "evidence"], maxima=["score"], firsts=["subject_curie"])
    out = _provenance(edges).withColumns({
        "subject_name": F.col("subject_text"), "subject_category": F.lit("ChemicalEntity"), "predicate": F.lit("biolink:contraindicated_in"), "object_curie": F.lit(""), "object_name": F.lit(""),
        "object_category": F.lit(""), "evidence_text": S.sorted_join(F.col("evidence")), "approval_ids": S.sorted_join(F.col("approval")), "source_score": S.general_number(F.col("score")),
        "knowledge_level": F.lit("knowledge_assertion"), "agent_type": F.lit("text_mining_agent"), "primary_knowledge_source": F.lit(PRIMARY_SOURCE), "upstream_resource_ids": F.lit(LABEL_SOURCE),
    })
    return conform(out, CONTRAINDICATIONS)
