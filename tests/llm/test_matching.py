import random

import pytest
from pyspark.sql import functions as F

from lodestone.llm.matching import drug_key, firm_key, match, propagate, records, targets

PRODUCTS = [
    ("101", "BRANDOLEX", "ALPHADOL", "Firmaco Pharma Inc"), ("101", "Brandolex", None, "FIRMACO PHARMA INC"), ("102", "ALPHADOL", "ALPHADOL", "Otherly Generics SA"), ("103", "Duovitrex", "BETAMIN; GAMMATOL", "Thirdy Biologics Ltd"),
    ("104", "Zeltrexa", "DELTAPRIL", "Firmaco Pharma Inc"),
]
CASES = [
    (1, "brandolex 5mg/ml (TM)", None, None, "101"), (2, "tablets BRANDO LEX", "alphadol", "Firmaco", "101"), (3, "alphadol hydrochloride", "Alphadol", "OTHERLY, GENERICS SA.", "102"), (4, "alphadol", None, "c/o Firmaco US", "101"),
    (5, "alphadol", None, None, None), (6, "alphadol", "alphadol", "Nobody Inc", None), (7, "Strangerol", "alphadol", "Nobody Inc", None), (8, "betamin and gammatol", "gammatol\\betamin", "Thirdy", "103"), (9, "Du0vitrex", "betamin", None, "103"),
    (10, "brandollex", None, None, "101"), (11, None, None, "Firmaco", None), (12, " ", "", "", None), (13, "deltapril", "deltapril", "Frimaco Pharma Inc", "104"), (1, "brandolex", None, None, "101"), (None, "brandolex", None, None, None), (14, "q" * 100_000, None, None, None),
]


@pytest.fixture
def apps(spark):
    return targets(spark.createDataFrame(PRODUCTS, "appl_no_stripped string, drug_name string, active_ingredient string, sponsor_name string"))


def as_records(spark, data):
    df = spark.createDataFrame([r[:4] for r in data], "id bigint, n string, s string, f string").selectExpr("*", "'x' AS name", "'y' AS firm", "'z' AS appl_no")
    return records(df, "cases", "id", "n", "s", "f")


def test_keys(spark):
    df = spark.createDataFrame([("topical cream Heokimi (TM) 5mg/ml", "Mfr: Gudre US"), ("KAR-EODA /00250239/", "c/o Kania, Intl"), ("tablets", ""), (None, None)], "a string, b string")
    assert [tuple(r) for r in df.select(drug_key(F.col("a")), firm_key(F.col("b"))).collect()] == [("heoklml", "gudre"), ("kareoda", "kanla"), (None, None), (None, None)]


def test_records_find_their_application(spark, apps):
    got = sorted((r["row_id"], r["appl_no"]) for r in match(as_records(spark, CASES), apps).collect())
    assert got == sorted((r[0], r[4]) for r in CASES if r[0] and r[4])
    assert all(0.5 <= r["confidence"] <= 1 for r in match(as_records(spark, CASES), apps).collect())


def test_empty(spark, apps):
    assert match(as_records(spark, CASES).limit(0), apps).count() == 0
    assert match(as_records(spark, CASES), apps.limit(0)).count() == 0


def brute(pairs):
    """Marginals over all one-to-one choices."""
    from itertools import product
    from math import exp

    total, sums = 0.0, [0.0] * len(pairs)
    for on in product([0, 1], repeat=len(pairs)):
        chosen = [p for p, x in zip(pairs, on) if x]
        if len({p[0] for p in chosen}) < len(chosen) or len({p[1] for p in chosen}) < len(chosen):
            continue
        weight = exp(sum(p[2] for p in chosen))
        total += weight
        for k, x in enumerate(on):
            sums[k] += weight * x
    return [s / total for s in sums]


def test_beliefs_are_exact_without_loops_and_close_with_them(spark):
    r = random.Random(4)
    tree = [("e1", "a1", 1.0), ("e1", "a2", 0.5), ("e2", "a2", 2.0), ("e3", "a3", -1.0), ("e3", "a2", 0.3)]
    loop = [(f"e{i}", f"a{j}", r.uniform(-2, 3)) for i in range(3) for j in range(3)]
    for pairs, slack in ((tree, 1e-3), (loop, 0.12)):
        df = spark.createDataFrame(pairs, "e string, a string, phi double")
        got = {(x["e"], x["a"]): x["belief"] for x in propagate(df, ["e"], ["a"], rounds=40, settled=1e-6).collect()}
        for (e, a, _), p in zip(pairs, brute(pairs)):
            assert abs(got[e, a] - p) < slack


def test_messages_that_do_not_settle_are_reported(spark):
    loop = [(f"e{i}", f"a{j}", 2.0 + i - j) for i in range(3) for j in range(3)]
    df = spark.createDataFrame(loop, "e string, a string, phi double")
    assert {x["settled"] for x in propagate(df, ["e"], ["a"], rounds=2, settled=1e-12).collect()} == {False}
    assert {x["settled"] for x in propagate(df, ["e"], ["a"]).collect()} == {True}


def test_unsure_records_keep_their_confidence(spark, apps):
    every = {(r["row_id"], r["appl_no"]): r["confidence"] for r in match(as_records(spark, CASES), apps, 0.0).collect()}
    sure = {(r["row_id"], r["appl_no"]): r["confidence"] for r in match(as_records(spark, CASES), apps).collect()}
    assert sure.items() <= every.items() and {k for k, p in every.items() if p >= 0.5} == set(sure)
    slipped, clean = every[10, "101"], every[1, "101"]
    assert slipped < clean


def test_a_factor_with_most_pairs(spark):
    df = spark.range(4000).selectExpr("concat('e', id) AS e", "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('a', id) END AS a", "1.0D + (id % 7) AS phi")
    got = {r["a"]: r["belief"] for r in propagate(df, ["e"], ["a"]).where("a in ('a0', 'a3', 'a6')").collect()}
    assert abs(got["a0"] - 2.718281828 / 3.718281828) < 1e-6 and len(got) == 3
    assert abs(propagate(df, ["e"], ["a"]).where("a = 'hot'").agg({"belief": "sum"}).first()[0] - 1) < 1e-2
