import json
from datetime import datetime, timedelta

from lodestone.operators.drift import alternatives, canonical_value, chained, file_schemas, schema_changes, unified, unions
from pyspark.sql import functions as F

SCHEMA = "feed_id bigint, file_id bigint, delivered_at timestamp, row_no int, payload string"


def feed(*files, feed_id=1):
    out = []
    for f, records in enumerate(files, 1):
        out += [(feed_id, f, datetime(2024, 1, 1) + timedelta(days=f), i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(records)]
    return out


def people(n, start=0):
    return [{"id": 7000 + i, "name": f"name {i}", "age": 20 + i, "ok": i % 2 == 0} for i in range(start, start + n)]


def changes(spark, data):
    return sorted(tuple(r)[1:] for r in schema_changes(spark.createDataFrame(data, SCHEMA)).collect())


def test_values_alike_in_all_kinds(spark):
    cases = [("12", '"012"'), ("20240131", '"2024-01-31"'), ("true", '"Y"'), ("0", "false"), ('{"num":5.0,"unit":"mg"}', '"5 mg"'), ('["a","b c"]', '"b c; a"'), ('{"t":"NDA","n":"012"}', '"NDA012"')]
    df = spark.createDataFrame(cases, "a string, b string").select(canonical_value(F.col("a")), canonical_value(F.col("b")))
    assert all(a == b for a, b in df.collect())


def test_rename_with_new_type_and_missing_values(spark):
    old = people(12)
    new = [{"primary": str(p["id"]), "name": p["name"], "age": p["age"], "flag": p["ok"]} for p in old]
    new[3]["name"] = None
    del new[4]["age"]
    assert changes(spark, feed(old, new)) == [(2, "renamed", "id", "primary"), (2, "renamed", "ok", "flag"), (2, "retyped", "id", "primary")]


def test_fields_that_go_and_come_without_values_in_common(spark):
    old = people(12)
    new = [{"id": p["id"], "name": p["name"], "age": p["age"], "colour": f"c{p['id'] % 7}"} for p in old]
    assert changes(spark, feed(old, new)) == [(2, "added", "", "colour"), (2, "removed", "ok", "")]


def test_flags_need_more_than_chance(spark):
    old = people(3)
    new = [{"id": p["id"], "name": p["name"], "age": p["age"], "other": p["ok"]} for p in old]
    assert changes(spark, feed(old, new)) == [(2, "added", "", "other"), (2, "removed", "ok", "")]


def test_kept_fields_retype_by_majority(spark):
    old, new = people(5), people(5)
    for p in new[:3]:
        p["age"] = str(p["age"])
    assert changes(spark, feed(old, new, new)) == [(2, "retyped", "age", "age")]


def test_edges(spark):
    data = feed([None, "{broken", "[1]", {"a": None}], [{"a": 1}], [])
    assert changes(spark, data) == []
    assert changes(spark, feed(people(2)) + feed(people(1), feed_id=2)) == []
    assert spark.createDataFrame(data, SCHEMA).transform(unions).transform(file_schemas).count() == 2
    assert schema_changes(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = feed(people(6), [*people(6), *people(6)])
    assert changes(spark, twice) == []


def test_unified(spark):
    data = feed([{"ID": 7}], [{"i_d": "x"}, {"id": None, "tags": ["a"]}])
    df = unified(spark.createDataFrame(data, SCHEMA), {"id": "key", "tags": "tags"}).orderBy("file_id", "row_no").collect()
    assert [(r["key"] and (r["key"]["kind"], r["key"]["text"], r["key"]["number"])) for r in df] == [("number", None, 7.0), ("string", "x", None), None]
    assert df[2]["tags"]["json"] == '["a"]'


def test_unified_keeps_every_field(spark):
    data = feed([{"ID": 7, "i_d": "x", "extra": [1], "none": None, "flag": True}], [{"id": None, "Other_Name": "o"}], [None])
    df = unified(spark.createDataFrame(data, SCHEMA), {"id": "key"}).orderBy("file_id").collect()
    assert df[0]["key"]["number"] == 7 and set(df[0]["rest"]) == {"i_d", "extra", "none", "flag"}
    assert df[0]["rest"]["i_d"]["text"] == "x" and df[0]["rest"]["extra"]["json"] == "[1]" and df[0]["rest"]["none"] is None
    assert (df[0]["rest"]["flag"]["kind"], df[0]["rest"]["flag"]["value"]) == ("boolean", "1")
    assert df[1]["key"] is None and set(df[1]["rest"]) == {"Other_Name"} and df[1]["rest"]["Other_Name"]["text"] == "o" and df[2]["rest"] == {}


def test_renames_lead_unlisted_names_to_their_column(spark):
    old = people(12)
    renamed = [[{name: p["id"], "name": p["name"], "age": p["age"]} for p in old] for name in ("Primary_No", "key_of_report")]
    extra = [{**p, "colour": f"c{p['age'] % 7}"} for p in renamed[1]]
    data = spark.createDataFrame(feed(old, *renamed, extra), SCHEMA)
    fields = chained(data, {"id": "key", "name": "name"})
    assert fields == {"id": "key", "name": "name", "primaryno": "key", "keyofreport": "key"}
    assert unified(data, fields).where("key is null").count() == 0
    assert chained(data.limit(0), {"id": "key"}) == {"id": "key"}


def test_alternatives_keep_minority_kinds_and_inner_paths(spark):
    data = feed(['{"a": 1, "b": {"c": [1, "x"], "d": null}}', '{"a": 2}', "no json", None], ['{"a": "n/a", "b": {"c": [2.5], "d": true}}', '{"a": 3, "b": [1]}'], ['{"a": "?"}'])
    found = alternatives(spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS n", "'x' AS path"))
    got = {(r["path"], r["kind"], r["usual"], r["files"], r["values"]) for r in found.collect()}
    assert got == {("a", "string", "number", 2, 2), ("b", "array", "object", 1, 1), ("b.c[]", "string", "number", 1, 1)}
    assert alternatives(spark.createDataFrame(data, SCHEMA).limit(0)).count() == 0
