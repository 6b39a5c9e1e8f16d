import pytest

from lodestone.operators import quality
from lodestone.operators.textmine import Gazetteer
from lodestone.plans import assertions as A
from lodestone.plans import exports as X
from lodestone.schemas import APPROVED, CONTRAINDICATIONS, OBSERVED

TERMS = [(1, "hypercholesterolemia", "D:1", "Disease"), (2, "headache", "P:2", "PhenotypicFeature"), (3, "pain", "D:3", "Disease"), (4, "asthma", "D:4", "Disease"), (5, "peptic ulcer disease", "D:5", "Disease")]
LABELS = {"S1": ("NDA", "012345", "Examplestatin", "U:1"), "S2": ("NDA", "017977", "Ibuprofen", "U:2"), "S3": ("NDA", "022329", "Omeprazole", "U:3")}
SECTIONS = [
    ("S1", "34067-9", "Examplestatin treats hypercholesterolemia."), ("S1", "34070-3", "Contraindicated in active liver disease."), ("S2", "34067-9", "For headache and pain."), ("S2", "34070-3", "Contraindicated in patients with asthma."),
    ("S3", "34067-9", "For gastroesophageal reflux."), ("S3", "", "Other text."),
]
CASES = [
    ("24Q3", "1001", "1", "Examplestatin", "Examplestatin", "12345", "012345", "hypercholesterolemia", "r1"), ("24Q3", "1002", "1", "Advil", "Ibuprofen", "17977", "017977", "headache", "r2"), ("24Q3", "1003", "1", "Placebo", "None", "", "", "back pain", "r3"),
    ("24Q3", "1004", "1", "Advil", "Ibuprofen", "17977", "017977", "Product used for unknown indication", "r4"), ("24Q3", "1005", "1", "Advil", "Ibuprofen", "17977", "017977", "gout", "r5"), ("24Q3", None, "1", "Placebo", None, None, None, "back pain", None), ("24Q3", "1006", "1", " ", None, None, None, "gout", None),
]


@pytest.fixture
def world(spark):
    terms = spark.createDataFrame([(n, t, c, t, k) for n, t, c, k in TERMS], "ordinal bigint, term string, curie string, name string, category string")
    approvals = spark.createDataFrame([(s, n, n, t) for s, (t, n, _, _) in LABELS.items()], "spl_set_id string, approval_id string, approval_code string, approval_type string")
    ingredients = spark.createDataFrame([(s, i, u, "Active", 0) for s, (_, _, i, u) in LABELS.items()] + [("S1", "Lactose", "U:9", "inactive", 1), ("S1", "EXAMPLESTATIN", "U:1", "active", 2)], "spl_set_id string, ingredient_name string, ingredient_unii string, role string, at int")
    sections = spark.createDataFrame([(s, f"{s}#{x}" if x else s, x, t, t) for s, x, t in SECTIONS], "spl_set_id string, spl_document_id string, loinc_code string, clean_text string, raw_text string")
    cases = spark.createDataFrame(CASES, "quarter string, primaryid string, drug_seq string, drugname string, ingredient string, nda string, nda_raw string, indication string, source_record_id string").selectExpr("*", "'x' AS term", "'y' AS matches")
    products = spark.createDataFrame([("12345", "A"), ("17977", "B"), ("22329", "C"), ("9", None)], "appl_no_stripped string, active_ingredient string")
    return A.label_evidence(approvals, ingredients, sections), cases, products, terms


def pick(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_approved_by_cases(world):
    evidence, cases, products, terms = world
    out = A.approved_treats(A.case_candidates(cases, terms), evidence, products, terms)
    assert tuple(out.columns) == APPROVED
    assert pick(out, "subject_text", "object_text", "approval_ids", "subject_curie", "supporting_spl_evidence", "supporting_faers_records") == [
        ("Examplestatin", "hypercholesterolemia", "NDA012345", "U:1", "dailymed:S1", "r1"), ("Ibuprofen", "headache", "NDA017977", "U:2", "dailymed:S2", "r2"),
    ]
    gates = dict(pick(A.gate_counts(cases, evidence, products, terms), "gate", "candidates"))
    assert gates == {"passed": 2, "not_named": 1}
    assert pick(A.approved_from_cases(cases, evidence, products, terms), *APPROVED) == pick(out, *APPROVED)
    blank = cases.selectExpr(*[c if c not in ("ingredient", "drugname") else f"'' AS {c}" for c in cases.columns])
    several = A.LabelEvidence(evidence.approvals, evidence.ingredients, evidence.singles.limit(0), evidence.sections)
    assert dict(pick(A.gate_counts(blank, several, products, terms), "gate", "candidates")) == {"no_subject": 2, "not_named": 1}


def most_rows(df):
    """The rows of the largest step of a query's last job, as it ran."""
    df.collect()
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        rows = node.metrics().get("numOutputRows")
        most = max(most, rows.get().value() if rows.isDefined() else 0)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return most


@pytest.fixture
def crowd(spark):
    """One number with 60 conditions and 50 labels, of which each names one."""
    word = lambda i: "".join(chr(97 + int(d)) for d in f"{i:02}") + "itis"
    cases = spark.createDataFrame([("24Q3", str(i), "1", "Drug", "", "7", "", f"{word(i)} of the ear", f"r{i}") for i in range(60)], "quarter string, primaryid string, drug_seq string, drugname string, ingredient string, nda string, nda_raw string, indication string, source_record_id string")
    approvals = spark.createDataFrame([(f"S{i}", "7", "7", "NDA") for i in range(50)], "spl_set_id string, approval_id string, approval_code string, approval_type string")
    ingredients = spark.createDataFrame([(f"S{i}", "Drug", "U:1", "active", 0) for i in range(50)], "spl_set_id string, ingredient_name string, ingredient_unii string, role string, at int")
    sections = spark.createDataFrame([(f"S{i}", f"S{i}#34067-9", "34067-9", f"Treats {word(i)} of the ear.", "") for i in range(50)], "spl_set_id string, spl_document_id string, loinc_code string, clean_text string, raw_text string")
    terms = spark.createDataFrame([(1, "bbitis", "D:1", "bbitis", "Disease")], "ordinal bigint, term string, curie string, name string, category string")
    return A.label_evidence(approvals, ingredients, sections), cases, spark.createDataFrame([("7", "A")], "appl_no_stripped string, active_ingredient string"), terms


def test_gates_never_pair_all_candidates_of_a_number_with_all_its_labels(crowd):
    evidence, cases, products, terms = crowd
    gates = A.gate_counts(cases, evidence, products, terms)
    assert dict(pick(gates, "gate", "candidates")) == {"passed": 50, "not_named": 10}
    assert most_rows(gates) < 1000


def test_gates_gather_no_table_on_the_driver(crowd):
    evidence, cases, products, terms = crowd
    gates = A.gate_counts(cases, evidence, products, terms)
    assert "Broadcast" not in gates._jdf.queryExecution().executedPlan().toString()
    matched = A.R.dictionary_matches(cases, "indication", terms, "term", "ordinal")
    assert "Broadcast" not in matched._jdf.queryExecution().executedPlan().toString()


def test_the_approved_relation_never_pairs_all_candidates_of_a_number_with_all_its_labels(crowd):
    evidence, cases, _, terms = crowd
    named = A.corroborated(A.case_candidates(cases, terms), evidence, terms)
    assert pick(named, "norm", "spl_set_id") == sorted(("7", f"S{i}") for i in range(50))
    assert most_rows(named) < 1000


def test_label_candidates_of_a_number_never_meet_all_its_labels(crowd, spark):
    evidence, cases, products, terms = crowd
    listed = [(i, r["indication"].split()[0], f"D:{i}", "x", "Disease") for i, r in enumerate(cases.collect())]
    out = A.approved_treats(A.label_candidates(evidence, spark.createDataFrame(listed, terms.schema)), evidence, products, spark.createDataFrame(listed, terms.schema))
    assert most_rows(out) < 1000
    assert pick(out, "object_text", "supporting_spl_evidence") == sorted((t, f"dailymed:S{i}") for i, t, *_ in listed[:50])


def test_invariants_read_the_labels_and_make_each_relation_once(spark, monkeypatch):
    from lodestone.plans import relation_queries as Q

    calls = []
    for module, name in ((Q, "_evidence"), (Q, "materialize"), (A, "materialize")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, name=name: (calls.append(a[1] if name == "materialize" else name), real(*a))[1])
    assert Q.relation_invariants(spark, "/root/testdata/sf0.001").count() == 0
    assert calls.count("_evidence") == calls.count("approved") == calls.count("candidates") == 1


def test_contracts_are_the_fixed_headers():
    assert "\t".join(APPROVED).startswith("subject_text\tsubject_curie\tsubject_name\tsubject_category\tpredicate\tobject_text\tobject_curie\tobject_name\tobject_category\tapproval_ids\tsupporting_spl_sets")
    assert APPROVED[13:] == ("clinical_approval_status", "knowledge_level", "agent_type", "primary_knowledge_source", "upstream_resource_ids", "edge_evidence", "supporting_faers_records", "supporting_faers_urls")
    assert OBSERVED[9:] == ("case_count", "clinical_approval_status", "knowledge_level", "agent_type", "primary_knowledge_source", "upstream_resource_ids", "approval_ids", "edge_evidence", "supporting_faers_records", "supporting_faers_urls")
    assert CONTRAINDICATIONS[9:] == (
        "disease_context_text", "evidence_text", "supporting_spl_sets", "supporting_spl_documents", "supporting_spl_evidence", "source_score", "knowledge_level", "agent_type", "primary_knowledge_source",
        "upstream_resource_ids", "approval_ids", "edge_evidence",
    )


def test_approved_by_labels(world):
    evidence, _, products, terms = world
    out = A.approved_treats(A.label_candidates(evidence, terms), evidence, products, terms)
    assert pick(out, "subject_text", "object_text") == [("Examplestatin", "hypercholesterolemia"), ("Ibuprofen", "headache"), ("Ibuprofen", "pain")]


def test_mentions_corroborate_the_specific_by_the_general_only(world, spark):
    evidence, cases, products, terms = world
    general = cases.withColumn("indication", cases["indication"]).limit(0).union(cases.where("source_record_id = 'r5'").selectExpr(*[c if c != "indication" else "'severe reflux' AS indication" if c == "indication" else c for c in cases.columns]))
    miner = lambda t: Gazetteer({"reflux": "disease", "gastroesophageal reflux": "disease"}).match(t)
    narrow = general.selectExpr(*[c if c not in ("nda", "nda_raw") else f"'22329' AS {c}" for c in general.columns])
    assert pick(A.approved_treats(A.case_candidates(narrow, terms), evidence, products, terms), "object_text") == []
    only = lambda t: Gazetteer({"reflux": "disease"}).match(t)
    assert pick(A.approved_treats(A.case_candidates(narrow, terms), evidence, products, terms, only), "object_text") == [("severe reflux",)]
    assert pick(A.approved_treats(A.case_candidates(narrow, terms), evidence, products, terms, miner), "object_text") == []


def test_observed(world):
    evidence, cases, products, terms = world
    out = A.observed_uses(cases, terms)
    assert tuple(out.columns) == OBSERVED
    assert pick(out, "subject_text", "object_text", "case_count", "clinical_approval_status") == [
        ("Advil", "gout", "1", "not_provided"), ("Advil", "headache", "1", "not_provided"), ("Examplestatin", "hypercholesterolemia", "1", "not_provided"), ("Placebo", "pain", "2", "not_provided"),
    ]
    approved = A.approved_treats(A.case_candidates(cases, terms), evidence, products, terms)
    status = dict(pick(A.observed_uses(cases, terms, approved), "subject_text", "clinical_approval_status"))
    assert status["Examplestatin"] == "approved_for_condition" and status["Advil"] == "off_label_use"
    mined = A.observed_uses(cases, terms, miner=Gazetteer({"gout": "phenotype"}).match)
    assert ("gout", "PhenotypicFeature") in pick(mined, "object_text", "object_category")
    assert A.observed_uses(cases.limit(0), terms).count() == 0


def test_relations_move_a_case_once_and_gather_no_table_on_the_driver(world, spark):
    evidence, cases, products, terms = world
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(A.case_pairs(cases)).count("Exchange hashpartitioning") == 1
    assert most_rows(A.case_pairs(cases)) <= cases.count()
    approved = spark.createDataFrame([("Advil", "headache")], "subject_text string, object_text string")
    assert "Broadcast" not in plan(A.with_status(A.observed_uses(cases, terms).drop("clinical_approval_status"), approved))
    assert "Broadcast" not in plan(A.contraindications(evidence, Gazetteer({"asthma": "disease"}).match))
    spelt = [("24Q3", p, "Advil", nda, "gout", r) for p, nda, r in (("1", "NDA017977", "r2"), ("1", "17977", "r1"), ("", "5", "r1"), ("", "", ""), ("2", "000", None))]
    rows = spark.createDataFrame(spelt, "quarter string, primaryid string, drugname string, nda_raw string, indication string, source_record_id string")
    assert pick(A.observed_uses(rows, terms), "case_count", "approval_ids", "supporting_faers_records") == [("4", "17977|5", "r1|r2")]
    pairs = A.case_pairs(rows.withColumn("nda", rows["nda_raw"]))
    assert pick(pairs, "norm", "fallback", "records") == [("17977", "Advil", ["r1", "r2"]), ("5", "Advil", ["r1"])]
    assert {(p["norm"], len(p["urls"])) for p in pairs.collect()} == {("17977", 1), ("5", 0)}


def test_contraindications(world):
    evidence, _, _, _ = world
    out = A.contraindications(evidence, Gazetteer({t: k for _, t, _, k in TERMS}).match)
    assert tuple(out.columns) == CONTRAINDICATIONS
    assert pick(out, "subject_text", "object_text", "source_score", "approval_ids") == [("Ibuprofen", "asthma", "1", "NDA017977")]
    more = A.contraindications(evidence, Gazetteer({"asthma": "disease", "liver disease": "disease"}).match)
    assert pick(more, "subject_text", "object_text") == [("Examplestatin", "liver disease"), ("Ibuprofen", "asthma")]
    assert quality.invariant_violations(out, "c").count() == 0


def test_training_candidates(world, spark):
    _, cases, _, _ = world
    rows = X.deduplicated(X.case_candidates(cases).unionByName(X.case_candidates(cases.selectExpr(*[c if c != "indication" else "upper(indication) AS indication" for c in cases.columns]))))
    assert [r[0] for r in pick(rows, "text")] == ["BACK PAIN", "GOUT", "HEADACHE", "HYPERCHOLESTEROLEMIA"]
    sections = spark.createDataFrame([("S", "S#34067-9", "34067-9", " a ", None), ("S", "S#x", "x", "b", None), ("S", "S#34070-3", "34070-3", "", " ")], "spl_set_id string, spl_document_id string, loinc_code string, clean_text string, raw_text string")
    assert pick(X.label_candidates(sections), "text", "task") == [("a", "indication")]
    domain = spark.createDataFrame([("indication",), ("contraindication",)], "task string")
    assert pick(quality.task_counts(X.label_candidates(sections), domain, ["task"]), "task", "n") == [("contraindication", 0), ("indication", 1)]
