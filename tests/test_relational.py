import itertools
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import relational as R

FAMILIES = {
    "DEMO": ("primaryid string, caseid string, occp_cod string, reporter_country string", {"24Q3": [("1001", "5001", "MD", "US"), ("1002", "5002", "PH", "GB"), ("1003", "5004", "MD", "US")], "24Q2": [("2001", "5001", "MD", "US"), ("2002", "5003", "OT", "CN")]}),
    "DRUG": ("primaryid string, drug_seq string, drugname string, role_cod string, nda_num string, prod_ai string", {"24Q3": [("1001", "1", "Examplestatin", "PS", "012345", "Examplestatin"), ("1002", "1", "Advil", "PS", "017977", "Ibuprofen"), ("1003", "1", "Placebo", "PS", "", "None")], "24Q2": [("2001", "1", "Examplestatin", "PS", "12345", "Examplestatin"), ("2002", "1", "Aspirin", "PS", "020000", "Acetylsalicylic acid")]}),
    "INDI": ("primaryid string, indi_drug_seq string, indi_pt string", {"24Q3": [("1001", "1", "hypercholesterolemia"), ("1002", "1", "headache"), ("1003", "1", "back pain")], "24Q2": [("2001", "1", "hypercholesterolemia"), ("2002", "1", "arthritis")]}),
    "REAC": ("primaryid string, pt string", {"24Q3": [("1001", "rhabdomyolysis"), ("1001", "myalgia"), ("1001", " myalgia"), ("1002", "nausea"), ("1003", "")], "24Q2": [("2001", "x"), ("2002", "dyspepsia")]}),
    "RPSR": ("primaryid string, rpsr_cod string", {"24Q3": [("1001", "PERIODIC"), ("1002", "DIRECT")], "24Q2": [("2001", "DIRECT"), ("2002", "DIRECT")]}),
}
PUBLIC = ["quarter", "primaryid", "caseid", "source", "occp_cod", "reporter_country", "drugname", "ingredient", "nda", "indication", "effects"]


def families(spark, reverse=False, parts=2):
    out = {}
    for name, (schema, quarters) in FAMILIES.items():
        data = [(q, *r, f"{name}{q}.txt") for q, rs in quarters.items() for r in rs]
        out[name] = spark.createDataFrame(data[::-1] if reverse else data, f"quarter string, {schema}, source_file string").repartition(parts)
    return out


@pytest.mark.parametrize(("reverse", "parts"), [(False, 1), (True, 5)])
def test_cases_audits_and_invariance(spark, rows, reverse, parts):
    f = families(spark, reverse, parts)
    gone = spark.createDataFrame([("24Q3", "1003", "5004")], "quarter string, primaryid string, caseid string")
    cases = R.case_join(f["INDI"], f["DRUG"], f["DEMO"], f["RPSR"], f["REAC"], gone)
    kept, audit = R.reduce_cases(cases)
    assert rows(kept.select(*PUBLIC)) == sorted([
        ("24Q3", "1001", "5001", "PERIODIC", "MD", "US", "Examplestatin", "Examplestatin", "12345", "hypercholesterolemia", "myalgia$rhabdomyolysis"),
        ("24Q3", "1002", "5002", "DIRECT", "PH", "GB", "Advil", "Ibuprofen", "17977", "headache", "nausea"),
        ("24Q2", "2002", "5003", "DIRECT", "OT", "CN", "Aspirin", "Acetylsalicylic acid", "20000", "arthritis", "dyspepsia"),
    ], key=repr)
    assert rows(audit.select("quarter", "primaryid", "caseid", "dedup_key", "winning_quarter")) == [("24Q2", "2001", "5001", "5001", "24Q3")]
    assert rows(R.delete_audit(gone, ["quarter", "primaryid", "caseid", "source_file"])) == [("24Q3", "1003", "5004", "")]
    assert rows(R.dropped_warnings(f["DRUG"], gone, "DRUG")) == [("24Q3", "DRUG", "deleted_rows_dropped", "rows of deleted ids", 1)]


def test_keep_first_decides_by_order_and_groups_nulls(spark, rows):
    df = spark.createDataFrame([(None, "10", 1), (None, "2", 2), ("a", "3", 3)], "k string, seq string, v int")
    assert rows(R.keep_first(df, ["k"], ["seq"]).select("k", "v")) == [("a", 3), (None, 1)]


def test_latest_wins_keeps_all_rows_of_the_winner(spark, rows):
    df = spark.createDataFrame([("k", "24Q1", 1), ("k", "24Q2", 2), ("k", "24Q2", 3), (None, "24Q1", 4), ("z", None, 5)], "k string, q string, v int")
    kept, lost = R.latest_wins(df, F.col("k"), "q")
    assert sorted(r["v"] for r in kept.collect()) == [2, 3, 4, 5]
    assert rows(lost.select("v", "winning_version")) == [(1, "24Q2")]


def test_counts_firsts_and_singletons(spark, rows):
    df = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("a", " ", "z"), ("a", None, "z"), ("b", "2", None)], "g string, i string, v string")
    assert rows(df.groupBy("g").agg(R.distinct_or_anonymous(F.col("i")).alias("n"))) == [("a", 3), ("b", 1)]
    assert rows(R.singletons(df, "g", "i").select("g", "i")) == [("b", "2")]
    assert rows(R.min_raw_per_key(df.withColumn("r", F.lit("0017")), ["g"], F.lit("17"), F.col("r"), "out")) == [("a", ["0017"]), ("b", ["0017"])]
    assert rows(R.pre_aggregated(df, ["g"], "v", "e")) == [("a", "x$y$z")]


def test_inherited_prefers_earlier_sources_and_rows(spark, rows):
    s = "k string, t string, row_no int"
    a, b = spark.createDataFrame([("1", "", 1), ("1", "NDA", 3), ("1", "BLA", 2)], s), spark.createDataFrame([("1", "ANDA", 1), ("2", "ANDA", 1)], s)
    df = spark.createDataFrame([("1", ""), ("2", None), ("3", ""), ("1", "own"), (None, "")], "k string, t string")
    assert rows(R.inherited(df, "k", "t", [a, b])) == sorted([("1", "BLA"), ("2", "ANDA"), ("3", ""), ("1", "own"), (None, "")], key=repr)


def test_dictionary_substrings_in_order(spark):
    terms = spark.createDataFrame([(2, "Pain", "c2"), (1, "back pain", "c1"), (3, "", "c3"), (4, None, "c4")], "n bigint, term string, curie string")
    df = spark.createDataFrame([("Back PAINT",), ("none",), (None,), ("",)], "t string").selectExpr("*", "1 AS n")
    got = {r["t"]: r["matches"] and [m["curie"] for m in r["matches"]] for r in R.dictionary_matches(df, "t", terms, "term", "n").collect()}
    assert got == {"Back PAINT": ["c1", "c2"], "none": [], None: None, "": []}
    assert R.dictionary_matches(df, "t", terms.limit(0), "term", "n").count() == 4
    joined = R.dictionary_matches(df, "t", terms, "term", "n", most=1)  # beyond the bound the terms are joined
    assert {r["t"]: r["matches"] and [m["curie"] for m in r["matches"]] for r in joined.collect()} == got and joined.columns == R.dictionary_matches(df, "t", terms, "term", "n").columns
    short = spark.createDataFrame([(1, "a", "x"), (2, "in", "y"), (3, "A", "z"), (4, "zzz", "w")], "n bigint, term string, curie string")
    assert {r["t"]: r["matches"] and [m["curie"] for m in r["matches"]] for r in R.dictionary_joins(df, "t", short, "term", "n").collect()} == {"Back PAINT": ["x", "y", "z"], "none": [], None: None, "": []}


def test_lookups_explode_and_dedupe(spark, rows):
    data = [("1", "1", "NDA", "Brand", "a; b;", None, "OTC", 1), ("1", "1", "NDA", "BRAND", "B", "9", "", 2), ("", "", "", "x", "y", "", "", 3)]
    df = spark.createDataFrame(data, "appl_no string, appl_no_stripped string, appl_type string, drug_name string, active_ingredient string, product_ndc string, marketing_status_name string, row_no int")
    assert [r[:2] for r in rows(R.typed_lookups(df, ["row_no"]))] == [
        ("ingredient", "a"), ("ingredient", "b"), ("marketing_status", "OTC"), ("nonproprietary_name", "B"), ("nonproprietary_name", "a; b;"), ("product_ndc", "9"), ("proprietary_name", "Brand"),
    ]


def test_edges_merge_to_the_same_whatever_the_order(spark, rows):
    r = random.Random(1)
    data = [(f"s{i % 3}", [f"v{r.randint(0, 5)}", "", None], [f"d{i}"], float(i), r.choice(["", "c"])) for i in range(30)]
    want = None
    for order, parts in itertools.product((data, data[::-1]), (1, 7)):
        df = spark.createDataFrame(order, "k string, a array<string>, b array<string>, s double, c string").repartition(parts)
        got = rows(R.merged_edges(df, ["k"], ["a", "b"], maxima=["s"], firsts=["c"], order=["s"]))
        want = want or got
        assert got == want
    assert want[0][1] == 27.0 and len(want[0][4]) == 10


def test_null_keys_are_not_deleted(spark, rows):
    df = spark.createDataFrame([(None, 1), ("a ", 2), ("b", 3)], "k string, v int")
    assert rows(R.without_deleted(df, spark.createDataFrame([("a",), (None,)], "k string"), ["k"]).select("v")) == [(1,), (3,)]


def test_phrases_of_any_length_are_found_on_word_bounds(spark, rows):
    draw = random.Random(7)
    texts = [(i, " ".join(draw.choices("abc", k=draw.randint(1, 14)))) for i in range(60)] + [(98, ""), (99, None)]
    phrases = [" ".join(draw.choices("abc", k=draw.randint(1, 9))) for _ in range(150)] + [" ".join(texts[i][1].split()[:n]) for i in range(20) for n in (7, 8, 14)] + ["", None, "aa", "a"]
    found = R.phrase_matches(spark.createDataFrame(texts, "i int, t string"), "i", "t", spark.createDataFrame([(p,) for p in phrases], "p string"), "p")
    assert rows(found) == sorted({(i, p) for i, t in texts for p in phrases if t and p and f" {p} " in f" {t} "}, key=repr)


def test_runs_of_words_are_not_gathered_on_the_driver_whatever_the_size_of_their_files(spark, rows, tmp_path):
    spark.range(50).selectExpr("id AS i", "array_join(transform(sequence(1, 50), x -> concat('w', x)), ' ') AS t").coalesce(1).write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t"))
    phrases = spark.createDataFrame([("w2 w3",), ("w1 w2 w3 w4 w5 w6 w7 w8",), ("w3 w2",)], "p string")
    found = R.phrase_matches(texts, "i", "t", phrases, "p")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found.groupBy("p").count()) == [("w1 w2 w3 w4 w5 w6 w7 w8", 50), ("w2 w3", 50)]
