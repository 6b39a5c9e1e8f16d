import pytest

from lodestone.llm.truncation import signs_of_end, stack_of, truncated, truncation_report

CUT = ["The patient was giv", "One. Two of the", "See (the list of 9.", "It ended…", "He took 5 [cut]", "was fine. Then (more)", "Dose of caf�", "Page 3 of", "Seen by Dr.", "“It helped. And", "a, b,", "<p>Not clos"]
WHOLE = [
    "Done.", "He said “stop.”", "All (99 %).", "N/A", "—", "", "   ", "None.", "Ends well. Revised: 05/2017", "Ends.\nRev. 17.04.A", "Ends.\n\nPage 7 of 7", "Ends. Ref. LBL-43149", "So.\n\n— end —", "So. *** END ***",
    "So.\n[end of record]", "So. (End of report 123)", "<p>Closed.</p>", "结束。", 'A 5" roll.',
]


def judge(spark, texts, source="s"):
    df = spark.createDataFrame([(i, t, source) for i, t in enumerate(texts)], "doc_id bigint, text string, source string").selectExpr("*", "true AS cut", "1 AS chars")
    return {r[0] for r in truncated(df).collect()}


def test_cut_and_whole(spark):
    texts = WHOLE + ["It ends here."] * 20 + CUT
    assert {texts[i] for i in judge(spark, texts)} == set(CUT)


def test_a_source_without_terminators_needs_evidence(spark):
    texts = [f"item number {i}" for i in range(20)] + ["an open (bracket", "gone…"]
    assert judge(spark, texts) == {20, 21}
    at_limit = texts + ["x" * 40 + f" {i:03d} abc" for i in range(30)]  # one length, without terminators
    assert judge(spark, at_limit) == {20, 21} | set(range(22, 52))


def test_stack():
    assert stack_of("a (b [c] d") == ["("]
    assert stack_of("“a (b” c") == []
    assert stack_of("<b>x <i>y</i>") == ["<b"]
    assert stack_of("(" * 50_000)[:1] == ["("]
    assert stack_of("(" * 200_000 + ")" * 200_000) == stack_of("<a " + "x" * 500 + ">y</a>") == []
    assert stack_of('He said "we stop at ten.') == ['"'] and stack_of('He said "we stop" at 5" or 6".') == []


def test_open_markup_and_quotes_are_evidence():
    unclosed = lambda t: signs_of_end(t)[1]
    assert unclosed("<b>The dose is fine.") and unclosed('He said "we stop at ten.') and unclosed("<i>It “ends here.</i>") is False
    assert not unclosed("<b>The dose is fine.</b>") and not unclosed('("All of it.")') and not unclosed("<p>One.<br/>Two.")


def test_marks_may_be_long():
    assert signs_of_end("Fine. (end of " + "x" * 300 + ")")[4] and signs_of_end("Fine [" + " " * 300 + "cut ]")[3]
    assert signs_of_end("It stopped at <a href='" + "x" * 300)[2]


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (None, "cut of", None), (2, "x " * 400_000 + "cut of", "s")], "doc_id bigint, text string, source string")
    assert sorted((r[0] for r in truncated(df).collect()), key=str) == []  # both sources write no terminators
    more = df.unionByName(df.selectExpr("doc_id", "'Ends.' AS text", "source")).unionByName(df.selectExpr("doc_id", "'Ends.' AS text", "source"))
    assert sorted((r[0] for r in truncated(more).collect()), key=str) == [2, None]
    assert truncated(df.limit(0)).count() == 0
    assert truncation_report(df).where("source is null").first()["texts"] == 3
    assert signs_of_end(None)[5]


@pytest.mark.parametrize("text", ["Page 9 of 3", "Revised: 09/20"])
def test_unfinished_marks_are_no_marks(text):
    assert not signs_of_end(f"Fine. {text}")[4]
