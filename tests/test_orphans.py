import random
from datetime import datetime, timedelta

from lodestone.operators.orphans import canonical_id, orphan_references, orphan_report
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)
EDGE = "id string, subject string, object string, asserted_at timestamp"
NODE = "id string, arrived_at timestamp, deleted_at timestamp"


def day(n):
    return None if n is None else T0 + timedelta(days=n)


def test_ids(spark, rows):
    df = spark.createDataFrame([(" chebi:a ",), ("x\t",), ("a::b",), (" \t",), (None,), ("Ab:Cd:e",), (" hp:1",)], "i string")
    assert [r[0] for r in df.select(canonical_id(F.col("i"))).collect()] == ["CHEBI:a", "x", "A::b", None, None, "AB:Cd:e", "HP:1"]


def test_reasons(spark, rows):
    nodes = spark.createDataFrame([("A:1", day(0), day(10)), ("A:1", day(20), None), ("A:2", day(5), None), ("A:3", day(9), day(9)), ("A:4", None, None)], NODE)
    edges = [
        ("e1", "a:1", "A:2", day(5)), ("e2", "A:1 ", "A:2", day(10)), ("e3", "A:1", "A:2", day(20)), ("e4", "A:1", "A:2", day(4)), ("e5", "A:3", "A:9", day(30)),
        ("e6", "A:4", None, day(30)), ("e7", " ", "A:9", None), ("e8", "A:2", "A:2", None), ("e4", "A:1", "A:2", day(4)),
    ]
    df = spark.createDataFrame(edges, EDGE).selectExpr("*", "'x' AS key", "'y' AS reason")
    got = rows(orphan_references(df, nodes).select("id", "endpoint", "reason"))
    assert got == [
        ("e2", "subject", "deleted"), ("e4", "object", "late"), ("e5", "object", "missing"), ("e5", "subject", "deleted"), ("e6", "subject", "late"), ("e7", "object", "missing"),
    ]
    assert rows(orphan_report(df, nodes).where("period is null")) == [("object", "missing", None, 1, 1)]
    assert orphan_references(df.limit(0), nodes).count() == 0
    assert {r[2] for r in rows(orphan_references(df, nodes.limit(0)).select("id", "endpoint", "reason"))} == {"missing"}


def test_random_against_definition(spark):
    r = random.Random(5)
    nodes = [(f"N:{r.randint(0, 8)}", day(r.randint(0, 90)), day(r.choice([None, None, r.randint(0, 120)]))) for _ in range(40)]
    edges = [(str(i), f"n:{r.choice([0, 0, 0, r.randint(0, 10)])}", f"N:{r.randint(0, 10)}", day(r.randint(0, 120))) for i in range(300)]
    want = set()
    for i, s, o, t in edges:
        for end, key in (("subject", s.upper()), ("object", o)):
            own = [n for n in nodes if n[0] == key]
            came = [n for n in own if n[1] <= t]
            if not any(n[2] is None or n[2] > t for n in came):
                want.add((i, end, "missing" if not own else "late" if not came else "deleted"))
    got = orphan_references(spark.createDataFrame(edges, EDGE), spark.createDataFrame(nodes, NODE)).select("id", "endpoint", "reason")
    assert {tuple(x) for x in got.collect()} == want
