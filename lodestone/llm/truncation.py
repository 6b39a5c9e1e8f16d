"""Texts cut off before their end, and each source's share of them.

A stack automaton reads each whole text once (brackets, quotes, markup) and then judges how it stops:
inside an open bracket or quote, in a broken character or escape, at a mark of omission, or without
anything that ends a sentence. A missing terminator counts against the source's own baseline: in a
source that usually writes none it proves nothing by itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.runtime import materialize, spread

# What may end a sentence, what may close it, and pairs that must be closed.
TERMINATORS = ".!?。！？؟।։။።᠃⸮‽"
CLOSERS = "\"'”’»)]}›」』）】*_"
PAIRS = {")": "(", "]": "[", "}": "{", "”": "“", "»": "«", "」": "「", "』": "『", "）": "（", "】": "【"}
PLACEHOLDERS = {
    "", "n/a", "na", "none", "null", "nil", "unknown", "unk", "not available", "not applicable", "not reported", "no text", "empty",
    "see above", "see attached", "see attachment", "see carton", "pending", "tbd", "to follow", "test", "xxx", "no information", "no data",
    "keine angabe", "k.a", "sin datos", "sin información", "néant", "non renseigné",
}
ABBREVIATIONS = {"rev", "ref", "dr", "mr", "mrs", "prof", "no", "nr", "approx", "vs", "e.g", "i.e", "z.b", "bzw", "ca", "cf", "fig", "p.ej"}
OMISSION = regex.compile(r"(?r)(?:…|\.\.\.+|\[\s*(?:…|\.\.\.+|cut|more|truncated|continued|gekürzt|suite)\s*\]|\(\s*(?:…|\.\.\.+|cut|more|truncated|continued|cont\.?)\s*\)|<\s*(?:cut|truncated|more)\s*>)\s*$", regex.I)
# a revision, reference, page or end mark in full
CLOSING = regex.compile(
    r"""(?r)(?:^|[\s>(\[])(?:
      (?:revised|revision|revidiert|révisé|revisado|stand)\s*:?\s*\d{1,2}[/.]\d{4}
    | rev\.\s*\d+(?:\.\d+)*\.[A-Z]
    | ref\.\s*[A-Z]{2,5}-\d{4,}
    | (?:page|seite|página)\s+(?P<at>\d+)\s+(?:of|von|sur|de)\s+(?P<all>\d+)
    | [(\[{*—–-]+\s*(?:end|ende|fin)(?:\s+(?:of|des|du|del)\s+\p{L}+)?(?:\s+\d+)?\s*[)\]}*—–-]+
    )\s*$""",
    regex.X | regex.I,
)
SIGNS = regex.compile(r"""[()\[\]{}“”«»「」『』（）【】]|(?<![^\s(\[{>])"(?=[\p{L}\p{N}])|(?<=[^\s(\[{])"|</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>""")
STRAIGHT = '"'  # opens before a word at the start of one, closes after one
VOID = {"br", "hr", "img", "p", "li", "td", "tr", "th"}  # written without an end as often as not
TAIL_TAGS = regex.compile(r"(?r)(?:\s|</?[A-Za-z][^<>]*>|&nbsp;)+$")
BROKEN = regex.compile(r"(?r)(?:�|[ÃÂ]|â€?|&#?\w{0,8}|\\u[0-9a-fA-F]{0,3}|\\x[0-9a-fA-F]?|%[0-9a-fA-F]?(?<=\p{L}%[0-9a-fA-F]?)|</?[A-Za-z][^<>]*|</?)$")
LETTER, ANY_TAG = regex.compile(r"\p{L}"), regex.compile(r"<[^<>]*>")
LONGEST_PLACEHOLDER = max(map(len, PLACEHOLDERS))
# what the patterns above need at the end of a text; without it there is no need to search
MARK_ENDS, OMISSION_ENDS, BROKEN_ENDS = regex.compile(r"[\p{L}\p{N})\]}*—–-]"), "….])>", "�ÃÂâ€"
SCHEMA = "terminated boolean, unclosed boolean, broken boolean, omission boolean, closed boolean, placeholder boolean, weak boolean, chars int, bytes int"


def stack_of(text: str) -> list[str]:
    """What is open at the end of the text: brackets, quotes (paired and straight ones) and tags.

    An apostrophe is no quote. Tags that are written without an end as often as not do not count.
    """
    stack: list[str] = []
    waiting: Counter[str] = Counter()

    def close(opener: str) -> None:
        """Takes the opener away with all that was left open inside it, if it is there."""
        if waiting[opener]:
            while (top := stack.pop()) != opener:
                waiting[top] -= 1
            waiting[opener] -= 1

    for m in SIGNS.finditer(text):
        sign = m[0]
        if sign[0] == "<":
            name = sign.strip("</>").split()[0].lower()
            if name in VOID or sign.endswith("/>"):
                continue
            if sign[1] == "/":
                close(f"<{name}")
                continue
            sign = f"<{name}"
        elif sign == STRAIGHT:
            if waiting[STRAIGHT]:
                close(STRAIGHT)
                continue
            if m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] in TERMINATORS):
                continue  # behind a letter or digit it is an inch or a stray sign
        elif sign in PAIRS:
            close(PAIRS[sign])
            continue
        stack.append(sign)
        waiting[sign] += 1
    return stack


def signs_of_end(text: str | None) -> tuple:
    """The features of one text, in the order of SCHEMA."""
    if text is None:
        return False, False, False, False, False, True, False, None, None
    chars, size = len(text), len(text.encode("utf-8", "surrogatepass"))
    bare = text.strip().strip("​﻿").strip()
    plain = ANY_TAG.sub(" ", bare).strip() if "<" in bare else bare
    said = plain.strip(" .!?:;-–—_*")
    if len(said) <= LONGEST_PLACEHOLDER and said.lower() in PLACEHOLDERS or not LETTER.search(plain):
        return False, False, False, False, False, True, False, chars, size
    body = (TAIL_TAGS.sub("", bare) if bare[-1] in ">;" else bare) or bare
    mark = CLOSING.search(body) if MARK_ENDS.match(body[-1]) else None
    closed = bool(mark) and not (mark["at"] and int(mark["at"][:9]) > int(mark["all"][:9]))
    omitted = OMISSION.search(body) if body[-1] in OMISSION_ENDS else None
    omission = bool(omitted)
    end = body.rstrip(CLOSERS + " \t\r\n\xa0")
    terminated = not omission and end[-1:] != "" and end[-1] in TERMINATORS
    last = end[:-1].rsplit(None, 1)[-1].lower().lstrip("(“\"'") if terminated and end[:-1].strip() else ""
    if last in ABBREVIATIONS:
        terminated = False
    # tags at the very end may close what is open
    unclosed = bool(stack_of(body[: omitted.start()] if omitted else bare))
    may_break = bare[-1] in BROKEN_ENDS or "&" in bare[-10:] or "\\" in bare[-6:] or "%" in bare[-2:] or bare.rfind("<") > bare.rfind(">")
    broken = not terminated and may_break and bool(BROKEN.search(bare))
    return terminated, unclosed, broken, omission, closed, False, last.isdigit(), chars, size


def end_features(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """`(doc_id, source)` and the features of how each text ends; texts are read in whole."""
    kind = documents.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "source", *[x.split()[0] for x in SCHEMA.split(", ")]]
    types = [pa.bool_()] * 7 + [pa.int32()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [signs_of_end(t) for t in b.column(2).to_pylist()]
            cols = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(list(c), t) for c, t in zip(cols, types)]], names=names)

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    return spread(rows).mapInArrow(run, f"doc_id {kind}, source string, {SCHEMA}")


def judged(documents: DataFrame, usual: float = 0.5, spike: float = 0.02, **names: str) -> DataFrame:
    """Every row with `cut` (boolean), its evidence and its source's limit, if the source has one.

    A source's limit is the length in characters or bytes of its longest texts, if at least the share
    `spike` of its texts (and five) have it, more than half of them without a terminator. Where at least the share `usual` of
    a source's texts have no terminator, a missing one counts only with an open bracket or quote, a
    broken end, an omission mark or the limit's length. Null, empty and placeholder texts and texts
    closed by a revision, reference, page or end mark are whole. A null source is a source of its own.
    """
    f = materialize(end_features(documents, **names), "ends").withColumn("source_key", F.coalesce("source", F.lit("\0")))
    open_end = ~F.col("terminated") & ~F.col("closed") & ~F.col("placeholder")
    base = f.groupBy("source_key").agg(F.avg(F.when(~F.col("placeholder"), open_end.cast("double"))).alias("share"), F.count(F.lit(1)).alias("texts"))
    lengths = f.where(~F.col("placeholder")).select("source_key", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("size")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("size")))).alias("l"), open_end.alias("open"))
    per = lengths.groupBy("source_key", "l").agg(F.count(F.lit(1)).alias("n"), F.count_if("open").alias("n_open"))
    longest = per.groupBy("source_key", "l.unit").agg(F.max(F.struct("l.size", "n", "n_open")).alias("m")).select("source_key", "m.n", "m.n_open", F.struct("unit", "m.size").alias("l"))
    limit = longest.groupBy("source_key").agg(F.max(F.struct("n", "n_open", "l")).alias("top"))
    sources = base.join(limit, "source_key", "left").select(
        "source_key", "share", F.when((F.col("top.n") >= 5) & (F.col("top.n") >= F.lit(spike) * F.col("texts")) & (F.col("top.n_open") * 2 > F.col("top.n")), F.col("top.l")).alias("limit")
    )
    at_limit = F.coalesce(F.when(F.col("limit.unit") == "chars", F.col("chars") == F.col("limit.size")).otherwise(F.col("bytes") == F.col("limit.size")), F.lit(False))
    strong = F.col("unclosed") | F.col("broken") | F.col("omission") | at_limit
    cut = ~F.col("placeholder") & ~F.col("closed") & F.when(F.col("terminated"), F.col("unclosed") | (F.col("weak") & at_limit)).otherwise((F.col("share") < usual) | strong)
    return f.join(sources, "source_key", "left").select("doc_id", "source", cut.alias("cut"), "terminated", "unclosed", "broken", "omission", at_limit.alias("at_limit"), "limit")


def truncated(documents: DataFrame, **names) -> DataFrame:
    """The ids of texts that were cut off, a row for each row of the table that was."""
    return judged(documents, **names).where("cut").select("doc_id")


def truncation_report(documents: DataFrame, **names) -> DataFrame:
    """Per source: texts, cut texts, their share and the limit found (null if none)."""
    return judged(documents, **names).groupBy("source").agg(
        F.count(F.lit(1)).alias("texts"), F.count_if("cut").alias("cut"), F.round(F.avg(F.col("cut").cast("double")), 6).alias("share"), F.first("limit").alias("limit")
    )
