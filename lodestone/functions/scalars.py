"""Scalar functions as Column -> Column expressions: no Python runs per row.

Convention: null and blank mean the same to every function that says "blank"; results are never null
unless stated.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

LABEL_URL = "https://dailymed.nlm.nih.gov/dailymed/drugInfo.cfm?setid="
LABEL_PREFIX = "dailymed:"
# The Unicode white space characters.
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
QUARTER_BASE = "https://fis.fda.gov/content/Exports"
# Indications that name no condition (search, case-insensitive).
STOP_PHRASES = (
    "unknown indication", "unapproved indication", "off[- ]label", "ill-defined", "adverse drug reaction",
    "evidence based treatment", "medication error", "not applicable",
    "product used for", "product use in", "product use issue", "drug use in", "product dose", "product prescribing",
    "product storage", "product availab", "product quality", "product misuse", "product origin unknown",
    r"product (?:administ|prescrib|dispens)\w*", "contraindicated product", "accidental exposure", "exposure during pregnancy",
)
STOP_WHOLE = ("prophylaxis", "premedication", "chemotherapy", "drug therapy", "supplementation therapy")
# Canonical entity types by lower-case label.
TYPE_ALIASES = {"disease": "disease", "diseases": "disease", "phenotype": "phenotype", "phenotypes": "phenotype", "phenotypicfeature": "phenotype", "phenotypic_feature": "phenotype"}
# Media types by file suffix, compound suffixes first.
MEDIA_TYPES = {
    ".tar.gz": "application/gzip", ".xml.gz": "application/gzip", ".jsonl.gz": "application/gzip", ".ndjson": "application/x-ndjson", ".jsonl": "application/x-ndjson",
    ".parquet": "application/vnd.apache.parquet", ".json": "application/json", ".xml": "application/xml", ".tsv": "text/tab-separated-values",
    ".csv": "text/csv", ".txt": "text/plain", ".zip": "application/zip", ".gz": "application/gzip", ".yaml": "application/yaml", ".html": "text/html",
}


def text(c: Column) -> Column:
    """The string, blank for null."""
    return F.coalesce(c.cast("string"), F.lit(""))


def stripped(c: Column) -> Column:
    """text() without Unicode white space at its ends."""
    return F.btrim(text(c), F.lit(SPACES))


def digits(c: Column) -> Column:
    return F.regexp_replace(text(c), "[^0-9]+", "")


def application_key(c: Column) -> Column:
    """Join key of an application number: its digits without leading zeroes; all-zero gives blank."""
    return F.regexp_replace(digits(c), "^0+", "")


def application_parts(raw: Column, kind: Column | None = None, number: Column | None = None) -> Column:
    """struct(appl_no_raw, appl_type, appl_no, appl_no_stripped) of an application number.

    `raw` may be combined (NDA, BLA or ANDA, then digits); a type column wins over its prefix, its
    digits win over a number column. The raw form is rebuilt from type and digits. The stripped form
    keeps a number that is all zeroes.
    """
    combined = r"(?i)^(ANDA|NDA|BLA)\s*([0-9]+)"
    source, own = stripped(raw), F.upper(stripped(kind)) if kind is not None else F.lit("")
    prefix, tail = F.upper(F.regexp_extract(source, combined, 1)), F.regexp_extract(source, combined, 2)
    k = F.when(own != "", own).otherwise(prefix)
    from_raw = F.when(tail != "", tail).otherwise(digits(source))
    n = F.when(from_raw != "", from_raw).otherwise(digits(number) if number is not None else F.lit(""))
    bare = F.regexp_replace(n, "^0+", "")
    return F.struct(F.concat(k, n).alias("appl_no_raw"), k.alias("appl_type"), n.alias("appl_no"), F.when(bare != "", bare).otherwise(n).alias("appl_no_stripped"))


def product_record_id(kind: Column, stripped_no: Column, product_no: Column, ndc: Column, ordinal: Column) -> Column:
    """Record id of a product row: by application and product number (NA if blank), else by NDC, else by row."""
    by_number = F.concat(F.lit("drugsfda:product:"), text(kind), text(stripped_no), F.lit(":"), F.when(text(product_no) != "", product_no).otherwise("NA"))
    rest = F.when(text(ndc) != "", F.concat(F.lit("drugsfda:product:ndc:"), ndc)).otherwise(F.concat(F.lit("drugsfda:product:row:"), ordinal.cast("string")))
    return F.when(text(stripped_no) != "", by_number).otherwise(rest)


def record_id(entity: str, kind: Column, stripped_no: Column, ordinal: Column, suffix: Column | None = None) -> Column:
    """Record id of an application or submission row: by number and suffix, else by row."""
    tail = F.when(text(suffix) != "", F.concat(F.lit(":"), suffix)).otherwise("") if suffix is not None else F.lit("")
    by_number = F.concat(F.lit(f"drugsfda:{entity}:"), text(kind), text(stripped_no), tail)
    return F.when(text(stripped_no) != "", by_number).otherwise(F.concat(F.lit(f"drugsfda:{entity}:row:"), ordinal.cast("string")))


def joined_id(*parts: Column, sep: str = ":") -> Column:
    """Parts joined, null parts as blanks (concat_ws alone would skip them)."""
    return F.concat_ws(sep, *[text(p) for p in parts])


def stable_id(*parts: Column, prefix: str = "sha256:") -> Column:
    """Content id: SHA-256 over the parts joined by the unit separator."""
    return F.concat(F.lit(prefix), F.sha2(joined_id(*parts, sep="\x1f"), 256))


def operation_key(operation: Column, inputs: Column) -> Column:
    """Key of an operation on a set of inputs; their order does not matter."""
    return F.sha2(F.concat_ws("|", text(operation), F.array_join(F.array_sort(inputs), "|")), 256)


def collapse_ws(c: Column) -> Column:
    """Runs of Unicode white space to single blanks, none at the ends; null stays null."""
    return F.btrim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def unii(c: Column) -> Column:
    """`UNII:` before a code that is not blank and has no prefix yet."""
    s = stripped(c)
    return F.when((s == "") | s.startswith("UNII:"), s).otherwise(F.concat(F.lit("UNII:"), s))


def document_id(set_id: Column, loinc: Column) -> Column:
    return F.when(text(loinc) != "", F.concat(text(set_id), F.lit("#"), loinc)).otherwise(text(set_id))


def normalize_text(c: Column) -> Column:
    """Matching form: lower case, tags and `'s` to blanks, all but [a-z0-9] to single blanks; null stays null."""
    bare = F.replace(F.regexp_replace(F.lower(c), "<[^>]*>", " "), F.lit("'s"), F.lit(" "))
    return F.btrim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def dedupe_key(c: Column) -> Column:
    return F.lower(collapse_ws(c))


def canonical_type(c: Column) -> Column:
    """Entity type by its aliases; other labels in lower case."""
    key = F.lower(stripped(c))
    aliases = F.create_map(*[F.lit(x) for kv in TYPE_ALIASES.items() for x in kv])
    return F.coalesce(aliases[key], key)


def is_placeholder(c: Column, phrases: Sequence[str] = STOP_PHRASES, whole: Sequence[str] = STOP_WHOLE) -> Column:
    """Whether an indication names no condition; false for blank."""
    return stripped(c).rlike("(?i)" + "|".join(phrases) + "|^(?:" + "|".join(whole) + r")\z")


def label_url(c: Column) -> Column:
    """URL of a label set or document id (`set` or `set#section`); URLs and blanks stay as they are."""
    s = F.regexp_replace(stripped(c), "#$", "")
    return F.when((s == "") | s.startswith(LABEL_URL), stripped(c)).otherwise(F.concat(F.lit(LABEL_URL), s))


def label_curie(c: Column) -> Column:
    """CURIE of the label set in an id, document id, URL or CURIE; blank stays blank."""
    s = stripped(c)
    bare = F.substring_index(F.regexp_replace(s, "^" + LABEL_URL.replace(".", r"\.").replace("?", r"\?"), ""), "#", 1)
    return F.when((s == "") | s.startswith(LABEL_PREFIX), s).otherwise(F.concat(F.lit(LABEL_PREFIX), bare))


def quarter_url(c: Column, base: str = QUARTER_BASE, strict: bool = False) -> Column:
    """Archive URL of a quarter label `YYQn` or `YYYYQn`; others give null, or fail if strict."""
    s = stripped(c)
    year, q = F.regexp_extract(s, r"^(?:(\d{4})|(\d{2}))[Qq]([1-4])$", 1), F.regexp_extract(s, r"^(?:\d{4}|\d{2})[Qq]([1-4])$", 1)
    short = F.regexp_extract(s, r"^(\d{2})[Qq][1-4]$", 1)
    y = F.when(year != "", year).otherwise(F.concat(F.lit("20"), short))
    url = F.concat(F.lit(base.rstrip("/") + "/faers_ascii_"), y, F.lit("q"), q, F.lit(".zip"))
    wrong = F.raise_error(F.concat(F.lit("no quarter label: "), s)).cast("string") if strict else F.lit(None).cast("string")
    return F.when(q != "", url).otherwise(wrong)


def quarter_label(date: Column, years: int = 4) -> Column:
    """`YYYYQn` of a date (or `YYQn`); two-digit years sort rightly within one century only."""
    return F.concat(F.substring(F.date_format(date, "yyyy"), 5 - years, years), F.lit("Q"), F.quarter(date).cast("string"))


def pipe_safe(c: Column) -> Column:
    """Free text made fit for a pipe-joined cell: bars and white space to single blanks."""
    return F.btrim(F.regexp_replace(text(c), r"(?U)[|\s]+", " "))


def is_pipe_safe(c: Column) -> Column:
    return ~text(c).rlike(r"[|\t\r\n]")


def checked_pipe(c: Column, label: str = "value") -> Column:
    """The value; the query fails on one that holds a bar, tab or line end."""
    return F.when(is_pipe_safe(c), c).otherwise(F.raise_error(F.concat(F.lit(f"{label} holds a delimiter: "), c)).cast("string"))


def sorted_join(values: Column, sep: str = "|") -> Column:
    """An array's distinct, stripped, non-blank values in order, joined."""
    clean = F.filter(F.transform(values, stripped), lambda v: v != "")
    return F.array_join(F.array_sort(F.array_distinct(clean)), sep)


def contains_words(haystack: Column, needle: Column) -> Column:
    """Whether normalised text holds a normalised phrase on word bounds (never a blank one)."""
    return (needle != "") & (F.instr(F.concat(F.lit(" "), haystack, F.lit(" ")), F.concat(F.lit(" "), needle, F.lit(" "))) > 0)


def sentences(c: Column) -> Column:
    """array<struct<start, end, text>> of sentences ending in one of .!?; before white space or the end.

    Offsets are in characters of the text; sentences lose white space at their ends; blank ones go.
    """
    whole = text(c)
    # pieces keep their separators, so lengths add up to offsets
    pieces = F.regexp_extract_all(whole, F.lit(r"(?s)(.*?[.!?;](?:\s+|\z)|.+\z)"), F.lit(1))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

    def add(acc: Column, piece: Column) -> Column:
        lead = F.length(piece) - F.length(F.regexp_replace(piece, r"^\s+", ""))
        body = F.regexp_replace(piece, r"^\s+|\s+$", "")
        start = acc["at"] + lead
        one = F.struct(start.cast("int").alias("start"), (start + F.length(body)).cast("int").alias("end"), body.alias("text"))
        return F.struct((acc["at"] + F.length(piece)).cast("int").alias("at"), F.concat(acc["out"], F.when(body != "", F.array(one)).otherwise(F.array().cast("array<struct<start:int,end:int,text:string>>"))).alias("out"))

    return F.aggregate(pieces, zero, add, lambda a: a["out"])


def keyword_sentences(c: Column, pattern: str) -> Column:
    """The sentences a pattern finds, joined by blanks."""
    return F.array_join(F.filter(F.transform(sentences(c), lambda s: s["text"]), lambda s: s.rlike(pattern)), " ")


def keyword_spans(c: Column, pattern: str) -> Column:
    """array<struct<start, end, source_start, source_end>>: where each sentence of keyword_sentences() stands in the filtered text and in the source."""
    kept = F.filter(sentences(c), lambda s: s["text"].rlike(pattern))
    shape = "array<struct<start:int,end:int,source_start:int,source_end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("out"))

    def add(acc: Column, s: Column) -> Column:
        size = (s["end"] - s["start"]).cast("int")
        one = F.struct(acc["at"].alias("start"), (acc["at"] + size).cast("int").alias("end"), s["start"].alias("source_start"), s["end"].alias("source_end"))
        return F.struct((acc["at"] + size + F.lit(1)).cast("int").alias("at"), F.array_append(acc["out"], one).alias("out"))

    return F.aggregate(kept, zero, add, lambda a: a["out"])


def general_number(c: Column) -> Column:
    """A double with six significant digits and no trailing zeroes, like `%g`."""
    fixed = F.format_string("%.6g", c.cast("double"))
    plain = F.regexp_replace(F.regexp_replace(fixed, r"(\.\d*?)0+(?=e|$)", "$1"), r"\.(?=e|$)", "")
    special = F.when(F.isnan(c.cast("double")), "nan").when(c == float("inf"), "inf").when(c == float("-inf"), "-inf").when(c == 0, "0")
    return special.otherwise(plain)


def filled(c: Column, empty: str = "NA") -> Column:
    """A scalar cell: stripped, or `empty` for null and blank."""
    s = stripped(c)
    return F.when(s != "", s).otherwise(empty)


def joined_cell(values: Column, sep: str = ",", empty: str = "NA") -> Column:
    """A list cell: its values in their order, joined, or `empty` for null and empty lists."""
    return F.when(F.size(F.coalesce(values, F.array().cast("array<string>"))) > 0, F.array_join(values, sep)).otherwise(empty)


def first_cell(values: Column, empty: str = "NA") -> Column:
    """A list's first element as a cell."""
    return filled(F.get(values, F.lit(0)), empty)


def media_type(path: Column, types: Mapping[str, str] = MEDIA_TYPES) -> Column:
    out, low = None, F.lower(path)
    for suffix, kind in sorted(types.items(), key=lambda kv: -len(kv[0])):
        out = F.when(low.endswith(suffix), kind) if out is None else out.when(low.endswith(suffix), kind)
    return out.otherwise("application/octet-stream")


def avoid_list(allowed: Iterable[str], universe: Iterable[str]) -> list[str]:
    """The complement of an allow-list; names outside the universe are refused."""
    allowed, every = set(allowed), set(universe)
    if unknown := sorted(allowed - every):
        raise ValueError(f"unknown categories: {unknown}")
    return sorted(every - allowed)


def column_letters(index: int) -> str:
    """Spreadsheet name of a column counted from 0 (0 is A, 26 is AA)."""
    if index < 0:
        raise ValueError("column index below 0")
    out = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def register(spark: SparkSession) -> None:
    """Makes the main functions callable from SQL as temporary SQL functions, still without Python."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION application_key(x STRING) RETURNS STRING RETURN regexp_replace(regexp_replace(coalesce(x, ''), '[^0-9]+', ''), '^0+', '')")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION normalize_text(x STRING) RETURNS STRING RETURN btrim(regexp_replace(replace(regexp_replace(lower(x), '<[^>]*>', ' '), \"'s\", ' '), '[^a-z0-9]+', ' '))")
