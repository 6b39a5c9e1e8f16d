import gzip
import io
import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodestone.operators import quality as Q
from lodestone.plans import exports, products
from lodestone.sources import files as X
from lodestone.sources import labels as L
from lodestone.sources import listings, sinks
from lodestone.sources.store import OperationIndex, operation_key, tree_hash
from lodestone.streaming.latest import latest_wins_stream

NODE = "id string, name string, category array<string>"
EDGE = (
    "id string, subject string, predicate string, object string, category array<string>, knowledge_level string, agent_type string, primary_knowledge_source string, "
    "sources array<struct<resource_id:string,resource_role:string,upstream_resource_ids:array<string>>>"
)
GOOD = ("e1", "C:1", "biolink:treats", "M:1", ["a"], "k", "t", "infores:own-approvals", [("infores:own-approvals", "p", ["infores:labels", "infores:reports"])])


def codes(df):
    return sorted((r["id"], r["code"]) for r in df.collect())


def test_graph_contract(spark):
    nodes = spark.createDataFrame([("C:1", "n", ["biolink:Drug"]), (" M:1", "n", ["biolink:Disease"]), ("bad", None, []), ("M:1", "n", ["biolink:Disease"]), (None, "n", ["biolink:Drug", "x"]), ("null", "n", None)], NODE)
    assert codes(Q.node_problems(nodes)) == [
        ("", "node_bad_prefix"), ("", "node_missing_id"), ("M:1", "node_duplicate_id"), ("bad", "node_missing_category"), ("bad", "node_missing_name"), ("null", "node_missing_category"),
    ]
    bad = [
        ("e2", "C:9", "biolink:treats", "M:1", ["a"], "k", "t", "infores:own-approvals", GOOD[8]), ("e3", "M:1", "biolink:eats", "C:1", ["a"], "k", None, "infores:own-approvals", None),
        ("e4", "C:1", "biolink:treats", "M:1", None, "k", "t", None, None), ("e1", "C:1", "biolink:treats", "M:1", ["a"], "k", "t", "infores:own-approvals", GOOD[8]),
        ("e5", "M:1", "biolink:treats", "C:1", ["a"], "k", "t", "infores:labels", None),
    ]
    got = codes(Q.edge_problems(spark.createDataFrame([GOOD, *bad], EDGE), nodes, "infores:own-approvals"))
    assert got == [
        ("e1", "edge_duplicate_id"), ("e2", "edge_dangling_subject"), ("e3", "edge_missing_agent_type"), ("e3", "edge_unknown_predicate"), ("e4", "edge_missing_category"),
        ("e4", "edge_missing_provenance"), ("e5", "edge_missing_provider"), ("e5", "edge_missing_upstream"), ("e5", "edge_object_category"), ("e5", "edge_subject_category"),
    ]
    flat = exports.export_edges(spark.createDataFrame([GOOD, bad[0]], EDGE).selectExpr("*", "array('A1', 'B2') AS approval_ids", "3 AS evidence_count", "concat('the ', subject) AS original_subject"), nodes)
    assert tuple(flat.columns) == ("id", "subject", "predicate", "object", "subject_name", "object_name", "object_modifier", "knowledge_level", "agent_type", "approval", "N_cases", "supporting_spls")
    assert {(r["id"], r["subject_name"], r["object_name"], r["approval"], r["N_cases"], r["supporting_spls"]) for r in flat.collect()} == {("e1", "n", "n", "A1,B2", "3", "NA"), ("e2", "the C:9", "n", "A1,B2", "3", "NA")}
    assert {tuple(r) for r in exports.export_nodes(nodes.limit(3)).collect()} == {("C:1", "n", "biolink:Drug"), ("M:1", "n", "biolink:Disease"), ("bad", "NA", "NA")}


def test_invariants_by_family(spark):
    cols = "subject_text string, object_text string, predicate string, clinical_approval_status string, knowledge_level string, primary_knowledge_source string, upstream_resource_ids string, case_count string"
    rows = spark.createDataFrame([
        ("a", "b", "biolink:treats", "approved_for_condition", "knowledge_assertion", "infores:own-approvals", "infores:labels|infores:reports", None),
        ("c", "d", "biolink:treats", "off_label_use", "x", "infores:else", "infores:reports", None), ("e", " ", "biolink:applied_to_treat", "not_provided", "statistical_association", "infores:own-approvals", "infores:reports", "0"),
        ("f", "g", "biolink:contraindicated_in", None, "knowledge_assertion", "infores:own-approvals", "infores:labels", None), ("h", "i", "biolink:other", None, None, None, None, None),
    ], cols)
    got = {(r["code"], r["count"], r["example"]) for r in Q.invariant_violations(rows, "r", "infores:own-approvals").collect()}
    assert got == {("clinical_approval_status", 1, "c|d"), ("knowledge_level", 1, "c|d"), ("primary_knowledge_source", 1, "c|d"), ("upstream_provenance", 1, "c|d"), ("blank_object", 1, "e| "), ("bad_count", 1, "e| ")}


def test_span_scores(spark):
    s = "doc_id int, start int, end int, type string"
    gold, found = spark.createDataFrame([(1, 0, 3, "d"), (1, 5, 8, "d")], s), spark.createDataFrame([(1, 0, 3, "d"), (1, 5, 8, "p"), (2, 1, 2, "d")], s)
    assert tuple(Q.span_scores(gold, found).first()) == (1, 2, 1, 0.333333, 0.5, 0.4)
    assert Q.span_scores(gold, found, ["doc_id", "start", "end"]).first()["tp"] == 2
    assert tuple(Q.span_scores(gold.limit(0), found.limit(0)).first()) == (0, 0, 0, 0.0, 0.0, 0.0)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "DEMO24Q3.txt").write_bytes(b"PRIMARYID$CASEID$\r\n1001$5001$\r\n1002$ 5 $x$y\r\n1003\r\n")
    (tmp_path / "INDI24Q3.txt").write_bytes(b"")
    (tmp_path / "REAC24Q3.txt").write_bytes(b"FOO$PT$\n1$x$\n")
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("ascii/RPSR24Q3.txt", "ISR$RPSR_COD$\n1001$PERIODIC $\n")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("inner.zip", inner.getvalue())
    (tmp_path / "all.zip").write_bytes(outer.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"PK broken")
    return tmp_path


def test_report_files(spark, folder):
    members = X.expand_archives(X.files(spark, str(folder), with_empty=True))
    assert [r["name"] for r in members.where("content is null").collect()] == ["bad.zip"]
    lines = X.lines_of(members)
    parsed = X.parse_delimited(lines)
    demo = X.report_family(parsed, "DEMO", ["primaryid", "caseid", "occp_cod"]).orderBy("row_no").collect()
    assert [(r["quarter"], r["primaryid"], r["caseid"], r["occp_cod"]) for r in demo] == [("24Q3", "1001", "5001", ""), ("24Q3", "1002", "5", ""), ("24Q3", "1003", "", "")]
    assert [r["rpsr_cod"] for r in X.report_family(parsed, "RPSR", ["primaryid", "rpsr_cod"]).collect()] == ["PERIODIC"]
    assert sorted((r["family"], r["code"]) for r in X.extract_warnings(lines, members).collect()) == [("INDI", "empty_file"), ("REAC", "missing_primaryid")]
    plain = X.delimited_files(spark, str(folder / "DEMO24Q3.txt"))
    assert plain.columns == ["primaryid", "caseid", "source_file"] and plain.count() == 3


def test_encoding_repair():
    assert X.repaired_text(b"a\x92b \x96 \xc3\xa9 \x81") == "a’b – é �"


def test_product_tables(spark, tmp_path):
    (tmp_path / "Products.txt").write_bytes("﻿Appl No\tApplType\tProductNo\tDrugName\tActiveIngredient\n000042\tNDA\t001\tBrand\tA; B\n\t\t\tX\tY\n".encode())
    (tmp_path / "Applications.txt").write_bytes(b"ApplNo\tApplType\tSponsorName\n000042\tBLA\tS\n000077\tBLA\tT\n")
    (tmp_path / "Submissions.txt").write_bytes(b"ApplNo\tSubmissionNo\tSubmissionsPublicNotes\n000042\t1\tit\x92s\n000077\t2\t\n")
    (tmp_path / "SubmissionPropertyType.txt").write_bytes(b"a\tb\n1\t2\n")
    t = products.product_tables(X.files(spark, str(tmp_path)))
    assert sorted(r["source_record_id"] for r in t["products"].collect()) == ["drugsfda:product:NDA42:001", "drugsfda:product:row:3"]
    assert sorted((r["appl_no_raw"], r["submission_notes"], r["source_record_id"]) for r in t["submissions"].collect()) == [("BLA000077", "", "drugsfda:submission:BLA77:2"), ("NDA000042", "it’s", "drugsfda:submission:NDA42:1")]
    assert {(r["lookup_type"], r["term"]) for r in t["lookups"].collect()} == {("proprietary_name", "Brand"), ("nonproprietary_name", "A; B"), ("ingredient", "A"), ("ingredient", "B")}
    assert [r["message"] for r in t["warnings"].collect()] == ["row 3: missing application number"]


def test_labels_in_both_dialects(spark, tmp_path):
    standard = f"""<document xmlns="urn:hl7-org:v3"><setId root="ABC"/><subject><approval><id root="{L.APPLICATION_OID}" extension="NDA1"/><code codeSystem="{L.APPLICATION_CODES}" code="NDA"/></approval>
    <ingredient><x><activeMoiety><activeMoiety><code code="U1"/><name>Drug</name></activeMoiety></activeMoiety></x></ingredient></subject>
    <section><code code="X"/><code code="1-x"/><code code="34067-9" codeSystem="{L.LOINC_OID}"/><title>T</title><text>Hi <b>bold</b>  there</text></section></document>"""
    simple = '<r><document><setId>S1</setId><approval code="012345" type="NDA"/><inactiveIngredient name="L" unii=""/><activeIngredient name="X" unii="Q"/><section loinc="34067-9" name="ind">treats x</section><section>none</section></document></r>'
    (tmp_path / "a.xml.gz").write_bytes(gzip.compress(standard.encode()))
    (tmp_path / "b.xml").write_text(simple)
    (tmp_path / "c.xml").write_text("<document><setId>S2</setId>")
    t = L.label_tables(L.label_documents(X.files(spark, str(tmp_path))))
    assert sorted((r["spl_set_id"], r["loinc_code"], r["clean_text"]) for r in t["spl_sections"].collect()) == [("S1", "", "none"), ("S1", "34067-9", "treats x"), ("abc", "34067-9", "THi bold there")]
    assert sorted((r["ingredient_name"], r["ingredient_unii"], r["role"]) for r in t["spl_ingredients"].collect()) == [("Drug", "UNII:U1", "active"), ("L", "", "inactive"), ("X", "UNII:Q", "active")]
    assert sorted(r["approval_id"] for r in t["spl_approvals"].collect()) == ["012345", "NDA1"]
    assert {r["active_ingredient_name"] for r in t["spl_documents"].collect()} == {"Drug", "X"} and t["spl_sets"].count() == 2
    assert sorted(r["message"].split(":")[0] for r in t["warnings"].collect()) == ["parse error", "section missing LOINC code"]


def test_sinks_and_index(spark, tmp_path):
    df = spark.createDataFrame([("a", ""), (None, 'q"t\tx')], "a string, b string")
    sinks.write_tsv(df, str(tmp_path / "t.tsv"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "t.tsv").glob("part-*")))
    assert 'a\t""' in text and '"q""t\tx"' in text
    info = sinks.write_contract_table(df, str(tmp_path / "c.tsv"), ["b", "a", "z"], "op", ["i2", "i1"], ["a"])
    assert info["table"]["rows"] == 2 and json.loads((tmp_path / "c.tsv.manifest.json").read_text())["inputs"] == ["i1", "i2"]
    assert X.read_table(spark, str(tmp_path / "c.tsv"), ["a"]).count() == 2
    sinks.write_jsonl(df, str(tmp_path / "j.jsonl"))
    assert X.read_table(spark, str(tmp_path / "j.jsonl")).columns == ["a", "b"]
    sinks.write_parquet(df, str(tmp_path / "p" / "x.parquet"), ["a"])
    assert X.find_table(spark, str(tmp_path / "p"), "x").endswith("x.parquet") and X.find_table(spark, str(tmp_path / "p"), "y") is None
    sinks.write_bundle(df, str(tmp_path / "bundle"), {"n": 2})
    assert json.loads((tmp_path / "bundle" / "manifest.json").read_text())["counts"] == {"n": 2}
    index, calls = OperationIndex(spark, str(tmp_path / "index")), []
    stage = lambda: calls.append(1) or [str(tmp_path / "t.tsv")]
    assert [index.run("op", k, stage, "f")[1] for k in (["a", "b"], ["b", "a"])] == [False, True] and len(calls) == 1
    assert index.find("op", ["a", "b"], "other schema") is None and index.find("op", ["a", "b"], "f") is None
    assert operation_key("o", ["a", "b"]) == operation_key("o", ["b", "a"]) != operation_key("o", ["a"])
    assert tree_hash(spark, str(tmp_path / "t.tsv")) == tree_hash(spark, str(tmp_path / "t.tsv"))


def test_listings(spark):
    page = '<h1>Old</h1><a href="o.zip"></a><h2>New</h2><a href="a.zip"></a><a href="b.zip"></a><a href="a.zip"></a><a href="faers_ascii_2024q3.zip"></a><A HREF=\'/faers_ascii_2023Q1.zip\'></A>'
    df = spark.createDataFrame([(page,), (None,)], "html string")
    quarters = listings.newest(listings.discover_quarters(df, base_url="http://x/"), 1).collect()
    assert [tuple(r) for r in quarters] == [("24Q3", "http://x/faers_ascii_2024q3.zip")]
    assert [r["url"] for r in listings.release_archives(df, "<h2>New").orderBy("at").collect()][:2] == ["a.zip", "b.zip"]
    t = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 7)), (datetime(2024, 1, 1), datetime(2024, 1, 8)), (None, datetime(2024, 1, 8))], "a timestamp, b timestamp")
    assert [r[0] for r in t.select(listings.is_fresh(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_hand_off(spark, tmp_path):
    text = exports.table_config("t", "p.tsv", ["a", "b"], "biolink:treats", ["b"], ["a"], {"object": ["Disease"]}, ["Disease", "Gene"])
    assert "column: B" in text and 'object_avoid: ["Gene"]' in text
    assert exports.hand_off(spark, {"t": text}, str(tmp_path))["status"] == "deferred" and (tmp_path / "t.yaml").read_text() == text
    assert exports.build_summary(spark, {"t": 1}, {}, str(tmp_path / "s.json"))["ok"]


def test_stream_equals_batch(spark, tmp_path):
    parts = [[("k1", "24Q1", "a"), ("k2", "24Q2", "b")], [("k1", "24Q2", "c"), ("k1", "24Q2", "d")], [("k2", "24Q1", "e"), ("k1", "24Q1", "f")]]
    for i, p in enumerate(parts):
        spark.createDataFrame(p, "key string, version string, payload string").coalesce(1).write.mode("append").json(str(tmp_path / "in" / f"b{i}"))
    source = spark.readStream.schema("key string, version string, payload string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in" / "*"))
    q = latest_wins_stream(source).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination(120)
    events = spark.read.parquet(str(tmp_path / "out"))
    status = {}
    for r in events.collect():
        best = status.get((r["key"], r["payload"]))
        status[r["key"], r["payload"]] = "superseded" if "superseded" in (best, r["status"]) else "kept"
    assert status == {("k1", "a"): "superseded", ("k2", "b"): "kept", ("k1", "c"): "kept", ("k1", "d"): "kept", ("k2", "e"): "superseded", ("k1", "f"): "superseded"}
