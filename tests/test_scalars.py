import pytest
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.schemas import conform, contract_problems, fingerprint


def one(spark, *values):
    """Values of expressions over no data."""
    return list(spark.range(1).select(*[v.alias(f"c{i}") for i, v in enumerate(values)]).first())


def test_application_numbers(spark):
    L = F.lit
    assert one(spark, *[S.application_key(L(x)) for x in ("012345", "NDA 00017", "000", "", "x")], S.application_key(L(None))) == ["12345", "17", "", "", "", ""]
    parts = lambda *a: tuple(one(spark, S.application_parts(*[L(x) for x in a]))[0])
    assert parts("NDA012345") == ("NDA012345", "NDA", "012345", "12345")
    assert parts("anda 042", "NDA", "7") == ("NDA042", "NDA", "042", "42")
    assert parts("", "BLA", "000") == ("BLA000", "BLA", "000", "000")
    assert parts("017") == ("017", "", "017", "17")


def test_record_ids(spark):
    L = F.lit
    assert one(spark, S.product_record_id(L("NDA"), L("12"), L(None), L("n"), L(3)), S.product_record_id(L(""), L(""), L("1"), L("n-1"), L(3)), S.product_record_id(L(""), L(""), L("1"), L(""), L(3))) == [
        "drugsfda:product:NDA12:NA", "drugsfda:product:ndc:n-1", "drugsfda:product:row:3",
    ]
    assert one(spark, S.joined_id(L("a"), L(None), L("b"))) == ["a::b"]
    assert one(spark, S.operation_key(L("o"), F.array(L("b"), L("a")))) == one(spark, S.operation_key(L("o"), F.array(L("a"), L("b"))))


@pytest.mark.parametrize(
    ("text", "want"),
    [("Avoid.  Do not use; stop! x", [(0, 6, "Avoid."), (8, 19, "Do not use;"), (20, 25, "stop!"), (26, 27, "x")]), ("a.b 1.5 c", [(0, 9, "a.b 1.5 c")]), ("", []), ("  ", []), (None, []), ("One.\n\nTwo.", [(0, 4, "One."), (6, 10, "Two.")])],
)
def test_sentences(spark, text, want):
    got = one(spark, S.sentences(F.lit(text).cast("string")))[0]
    assert [tuple(s) for s in got] == want
    assert all((text or "")[a:b] == t for a, b, t in want)


def test_texts(spark):
    L = F.lit
    assert one(spark, S.normalize_text(L("<b>Crohn's</b> Disease–II")), S.collapse_ws(L(" a  \n b ")), S.dedupe_key(L(" A\tB ")), S.pipe_safe(L("a | b\n|c")), S.pipe_safe(L(None))) == ["crohn disease ii", "a b", "a b", "a b c", ""]
    assert one(spark, S.unii(L("Q1")), S.unii(L("UNII:Q1")), S.unii(L(" ")), S.canonical_type(L("PhenotypicFeature")), S.canonical_type(L("Gene"))) == ["UNII:Q1", "UNII:Q1", "", "phenotype", "gene"]
    assert one(spark, S.filled(L(" ")), S.filled(L(" a ")), S.joined_cell(F.array(L("b"), L("c"), L("a"))), S.first_cell(F.array(L("b"), L("c"))), S.sorted_join(F.array(L("b"), L(" b"), L("a"), L("")))) == ["NA", "a", "b,c,a", "b", "a|b"]
    assert one(spark, *[S.general_number(L(x)) for x in (1.0, 0.965, 0.9, 0.0, 123456.7)]) == ["1", "0.965", "0.9", "0", "123457"]


def test_placeholders(spark):
    yes = ["Product used for unknown indication", " prophylaxis ", "OFF-LABEL use", "Medication error"]
    no = ["Migraine prophylaxis", "breast cancer", "", None]
    assert one(spark, *[S.is_placeholder(F.lit(x)) for x in yes + no]) == [True] * 4 + [False] * 4


def test_links(spark):
    L, url = F.lit, S.LABEL_URL
    assert one(spark, S.label_url(L("a")), S.label_url(L("a#1")), S.label_url(L(url + "a")), S.label_url(L(" "))) == [url + "a", url + "a#1", url + "a", ""]
    assert one(spark, *[S.label_curie(L(x)) for x in ("a", "a#1", url + "a#1", "dailymed:a", "")]) == ["dailymed:a"] * 4 + [""]
    base = S.QUARTER_BASE + "/faers_ascii_2024q3.zip"
    assert one(spark, *[S.quarter_url(L(x)) for x in ("24Q3", "2024q3", "24Q5", "")]) == [base, base, None, None]
    with pytest.raises(Exception, match="no quarter label"):
        one(spark, S.quarter_url(L("x"), strict=True))
    with pytest.raises(Exception, match="holds a delimiter"):
        one(spark, S.checked_pipe(L("a|b")))
    assert one(spark, S.media_type(L("a/b.XML.gz")), S.media_type(L("b.zip")), S.media_type(L("b"))) == ["application/gzip", "application/zip", "application/octet-stream"]


def test_driver_helpers():
    assert [S.column_letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert S.avoid_list(["b"], ["a", "b", "c"]) == ["a", "c"]
    with pytest.raises(ValueError):
        S.avoid_list(["x"], ["a"])


def test_sql_functions(spark):
    S.register(spark)
    assert list(spark.sql("SELECT application_key('NDA0012'), normalize_text('A-b''s')").first()) == ["12", "a b"]


def test_contracts(spark):
    df = spark.createDataFrame([(1, None)], "B int, extra string")
    assert conform(df, ["a", "b"]).first() == ("", "1")
    assert contract_problems(df, ["B", "z"]) == ["missing:z", "extra:extra"]
    assert contract_problems(df, ["extra", "B"]) == ["order"]
    assert fingerprint(["a", "b"]) != fingerprint(["b", "a"])
