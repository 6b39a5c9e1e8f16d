import json

from lodestone.operators.nested import LABEL_TABLES, emit_objects, flat_tables, visit, write_tables
from lodestone.queries import QUERIES

TAGS = frozenset(LABEL_TABLES)


def found(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return [r[:3] for r in visit(text, TAGS, "set_id")]


def test_positions_nulls_and_objects():
    doc = {"set_id": "s", "approvals": {"territories": [None, {"country": "X"}, "text"]}, "sections": [{"sections": {"sections": [{}]}}, None, {}]}
    assert found(doc) == [
        ("approvals", "approvals.0", ""),
        ("territories", "approvals.0.territories.1", "approvals.0"),
        ("sections", "sections.0", ""),
        ("sections", "sections.0.sections.0", "sections.0"),
        ("sections", "sections.0.sections.0.sections.0", "sections.0.sections.0"),
        ("sections", "sections.2", ""),
    ]


def test_wrapped_and_written_as_text():
    inner = {"set_id": "s", "ingredients": json.dumps([{"moieties": json.dumps({"name": "m"})}])}
    assert found({"dialect": 1, "document": inner}) == [("ingredients", "ingredients.0", ""), ("moieties", "ingredients.0.moieties.0", "ingredients.0")]
    assert found(json.dumps(json.dumps(inner))) == found(inner)


def test_between_fields_and_broken():
    assert found({"set_id": 1, "x": {"y": [{"sections": {}}]}}) == [("sections", "x.y.0.sections.0", "")]
    assert found("{broken") == found("null") == found("3") == found("[]") == []
    assert found({"set_id": 1, "approvals": ["s", 3, None]}) == []


def test_depth_is_not_limited_by_recursion():
    doc = {}
    for _ in range(200):
        doc = {"sections": [doc]}
    assert len(found({"set_id": 1, **doc})) == 200


def test_frames(spark, rows, tmp_path):
    doc = json.dumps({"set_id": "s", "approvals": [{"approval_id": "A1", "code": None, "territories": {"country": "X"}}], "sections": [{"text": "t" * 100_000}]})
    df = spark.createDataFrame([(1, doc), (1, doc), (2, None), (3, ""), (None, doc)], "record_id bigint, payload string").selectExpr("*", "'x' AS kind", "'y' AS path")
    objects = emit_objects(df)
    assert objects.count() == 9
    tables = flat_tables(objects)
    assert rows(tables["approvals"])[0] == (1, "approvals.0", "", "A1", None, None)
    assert rows(tables["territories"])[0][:4] == (1, "approvals.0.territories.0", "approvals.0", "X")
    write_tables(objects, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where("kind = 'sections'").count() == 3
    assert emit_objects(df.limit(0)).count() == 0


def test_every_ingredient_is_looked_for_in_the_texts(spark, tmp_path, rows):
    payloads = [
        {"set_id": "s", "ingredients": [{"name": "Alpha"}, {"name": "Beta-Two", "moieties": [{"name": "Zeta"}]}, None]},
        {"set_id": "o", "ingredients": {"name": "Gamma"}},
        {"set_id": "t", "ingredients": json.dumps([{"name": "Delta"}])},
        {"set_id": "d", "sections": [{"title": "x", "ingredients": [{"name": "Epsilon"}]}]},
    ]
    labels = [(i, p["set_id"], json.dumps(p)) for i, p in enumerate(payloads)] + [(9, None, json.dumps(payloads[0])), (10, "s", "{broken")]
    spark.createDataFrame(labels, "record_id bigint, spl_set_id string, payload string").write.parquet(str(tmp_path / "label_records.parquet"))
    docs = [(1, "s", "alpha and beta two, zeta"), (2, "o", "GAMMA."), (3, "t", "a delta"), (4, "d", "epsilon"), (5, "o", "alpha, gammas"), (6, None, "alpha"), (7, "s", None)]
    spark.createDataFrame(docs, "doc_id bigint, spl_set_id string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = [(1, "alpha"), (1, "beta two"), (2, "gamma"), (3, "delta"), (4, "epsilon")]
    assert rows(QUERIES["verbatim_ingredients"](spark, str(tmp_path))) == want
