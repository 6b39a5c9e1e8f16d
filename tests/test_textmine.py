import pytest
from pyspark.sql import functions as F

from lodestone.operators import textmine as T

MATRIX = [
    ("contraindicated in patients with asthma.", ["asthma"], ""), ("contraindicated for treatment of epilepsy in patients with asthma.", ["asthma"], "epilepsy"), ("contraindicated for asthma.", ["asthma"], ""),
    ("contraindicated for treatment of epilepsy in patients receiving a drug.", [], ""), ("none known for asthma.", [], ""), ("asthma is not contraindicated.", [], ""), ("avoid use in patients with asthma.", [], ""),
    ("contraindicated for treatment of epilepsy in patients with asthma and glaucoma.", [], ""), ("contraindicated for treatment of headache in patients with asthma.", ["asthma"], ""),
]
TERMS = {"asthma": "disease", "epilepsy": "disease", "glaucoma": "disease", "liver disease": "disease", "active liver disease": "disease", "disease": "disease", "headache": "phenotype"}
G = T.Gazetteer(TERMS)


def test_polarity_and_context(spark):
    df = spark.createDataFrame([(i, t, "contraindications") for i, (t, _, _) in enumerate(MATRIX)], "id int, text string, section_kind string")
    got = T.classified(T.mined(df, "text", G.match), ["id"]).where("accepted").collect()
    for i, (_, objects, context) in enumerate(MATRIX):
        own = [r for r in got if r["id"] == i]
        assert [r["m"]["text"] for r in own] == objects
        assert all(r["context_text"] == context for r in own)


def test_warning_sections_need_hard_language(spark):
    df = spark.createDataFrame([(1, "Asthma may occur. Do not use in epilepsy.", "warnings"), (2, "Asthma may occur.", "contraindications")], "id int, text string, section_kind string")
    got = {(r["id"], r["m"]["text"], r["accepted"], r["trigger"]) for r in T.classified(T.mined(df, "text", G.match), ["id"]).collect()}
    assert got == {(1, "Asthma", False, "no_hard_trigger"), (1, "epilepsy", True, "do not use"), (2, "Asthma", True, "contraindication_section")}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Active liver disease, ASTHMA", [("Active liver disease", 0), ("ASTHMA", 22)]), ("liver <b>disease</b>", [("liver <b>disease", 0)]), ("asthmatic", []), ("prophylaxis", []),
        ("asthma's onset", [("asthma", 0)]), ("", []), (None, []), ("a < asthma", [("asthma", 4)]), ("éasthma", [("asthma", 1)]),
    ],
)
def test_offsets(text, want):
    got = G.match(text)
    assert [(m["text"], m["start"]) for m in got] == want
    assert all(text[m["start"] : m["end"]] == m["text"] for m in got)


def test_ignored_terms_block_but_do_not_show():
    g = T.Gazetteer({"off label use": "disease", "label use": "disease"})
    assert g.match("for off label use here") == []


def test_synonyms():
    g = T.Gazetteer({"heart failure": "disease"}, synonyms=T.SYNONYMS)
    (m,) = g.match("Cardiac failure")
    assert (m["text"], m["score"], m["notes"]) == ("Cardiac failure", 0.9, "synonym:cardiac>heart")
    assert T.Gazetteer({"heart failure": "disease"}).match("Cardiac failure") == []


def spans(*found):
    return lambda t: [{"start": t.find(s), "end": t.find(s) + len(s), "label": k, "score": p} for s, k, p in found if s in t]


@pytest.mark.parametrize(
    ("text", "predicted", "want"),
    [
        ("has severe asthma now", [("severe asthma", "Disease", 0.9)], ["severe asthma"]), ("has severe asthma now", [("severe asthma", "Disease", 0.3)], []), ("has asthma and epilepsy", [("asthma and epilepsy", "Disease", 0.9)], ["asthma", "epilepsy"]),
        ("seen in pregnant women", [("in pregnant women", "Phenotype", 0.9)], []), ("a recent, severe infarction", [("a recent, severe infarction", "Disease", 0.9)], [", severe infarction"]), ("known patients with", [("known patients", "Disease", 0.9)], []), ("history of gout", [("history of gout", "Disease", 0.9)], ["gout"]), ("gene X", [("X", "Gene", 0.9)], []), ("has asthma", [("asthma", "Disease", 0.1)], ["asthma"]),
    ],
)
def test_model_merge(text, predicted, want):
    assert [m["text"] for m in T.ModelMiner(spans(*predicted), G)(text)] == want


def test_windows_cover_the_text():
    m = T.ModelMiner(spans(), G, budget=3)
    for text in ("a b. c d e f g h. i! j k", "one", "", "x " * 50, "a.b.c d; e"):
        pieces = list(m.windows(text))
        assert "".join(p for _, p in pieces).split() == text.split()
        assert all(text[at : at + len(p)] == p and len(p.split()) <= 3 for at, p in pieces)
    cut = T.ModelMiner(lambda t: [{"start": 0, "end": len(t.rstrip()), "label": "Disease", "score": 0.9}] if t.strip() else [], G, budget=2)
    assert [x["text"] for x in cut("w1 w2 w3 w4")] == ["w1 w2 w3 w4"]


def test_cache_mines_only_what_it_lacks(spark, tmp_path):
    cache = str(tmp_path / "cache")
    df = spark.createDataFrame([("has asthma",), ("has  asthma",), (None,)], "t string")
    first = T.mined_with_cache(df, "t", G.match, "v1", cache)
    assert sorted(len(r["mentions"]) for r in first.collect()) == [0, 1, 1]
    assert spark.read.option("recursiveFileLookup", "true").schema("key string").parquet(cache).count() == 1
    more = df.union(spark.createDataFrame([("epilepsy",)], "t string"))
    assert sorted(len(r["mentions"]) for r in T.mined_with_cache(more, "t", lambda t: G.match(t) if "epil" in t else 1 / 0, "v1", cache).collect()) == [0, 1, 1, 1]


def test_regex_form_equals_the_gazetteer(spark):
    texts = ["active liver disease and disease", "asthma asthma", "none", "liver diseases"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.regex_mentions(F.col("t"), list(TERMS)).alias("m"))
    assert {r["t"]: r["m"] for r in df.collect()} == {t: [m["normalized"] for m in G.match(t)] for t in texts}


def test_balanced_keeps_rows(spark):
    df = spark.createDataFrame([("x" * (i % 50),) for i in range(200)], "t string")
    out = T.balanced(df, "t", 4)
    assert sorted(r[0] for r in out.collect()) == sorted(r[0] for r in df.collect())
