"""Delimited lines that cannot become rows: structural indexing with reasoned rejects.

A batch of lines is laid out as one byte buffer; numpy masks find delimiters, quotes, blanks and
record ends for all lines at once, and a field pointer per line then advances through the quoted
lines in lock step (one vector step per field, not one Python step per byte).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELIM, QUOTE, TAB, BLANK, CR = 0x24, 0x22, 0x09, 0x20, 0x0D

# The columns of each family, in file order.
FAMILIES = {
    "DEMO": ("PRIMARYID", "CASEID", "INIT_FDA_DT", "OCCP_COD", "REPORTER_COUNTRY"),
    "DRUG": ("PRIMARYID", "DRUG_SEQ", "DRUGNAME", "ROLE_COD", "NDA_NUM", "PROD_AI"),
    "INDI": ("PRIMARYID", "INDI_DRUG_SEQ", "INDI_PT"),
    "REAC": ("PRIMARYID", "PT"),
    "RPSR": ("PRIMARYID", "RPSR_COD"),
}
# What a trimmed field of the column must match in full.
PATTERNS = {
    "PRIMARYID": r"^[0-9]{7,10}$",
    "CASEID": r"^[0-9]+$",
    "OCCP_COD": r"^(MD|PH|OT|CN|LW)?$",
    "REPORTER_COUNTRY": r"^([A-Z]{2})?$",
    "DRUG_SEQ": r"^[1-9][0-9]{0,2}$",
    "INDI_DRUG_SEQ": r"^[1-9][0-9]{0,2}$",
    "ROLE_COD": r"^(PS|SS|C|I)$",
    "NDA_NUM": r"^[0-9]{0,6}$",
    "RPSR_COD": r"^(PER|DIR|EXP)$",
}
DATES = {"INIT_FDA_DT"}
CODES = ("quoting", "column_count", "encoding", "missing_primaryid", "invalid_value")


@dataclass
class Split:
    """Fields of a batch of lines in row-major order."""

    counts: np.ndarray  # terminated fields per line
    starts: np.ndarray  # byte offsets of the trimmed field contents
    ends: np.ndarray
    line: np.ndarray  # line of each field
    quoted: np.ndarray
    bad_quote: np.ndarray  # per line
    loose_end: np.ndarray  # per line: text after the last delimiter


def _run_ends(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each run of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def split_lines(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Split:
    """Splits lines (byte ranges of `data`) into fields."""
    n, size = len(begin), len(data)
    end = end.copy()
    blank = (data == BLANK) | (data == TAB)
    nonblank = np.flatnonzero(~blank)

    def last_solid(upto: np.ndarray, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """One past the last position < upto that is in the sorted array `at`, not below floor."""
        k = np.searchsorted(at, upto, "left") - 1
        found = np.where(k >= 0, at[np.maximum(k, 0)] + 1 if len(at) else 0, 0)
        return np.maximum(found, floor)

    def next_at(frm: np.ndarray, at: np.ndarray, ceiling: np.ndarray) -> np.ndarray:
        """First position >= frm in the sorted array `at`, not above ceiling."""
        if not len(at):
            return ceiling.copy()
        k = np.searchsorted(at, frm, "left")
        found = np.where(k < len(at), at[np.minimum(k, len(at) - 1)], size)
        return np.minimum(found, ceiling)

    # ends: lines without their CR and the blanks around it
    tail = last_solid(end, nonblank, begin)
    has_cr = (tail > begin) & (data[np.maximum(tail - 1, 0)] == CR) if size else np.zeros(n, bool)
    end = np.where(has_cr, last_solid(tail - 1, nonblank, begin), tail)

    quotes = data == QUOTE
    delims = np.flatnonzero(data == DELIM)
    if len(delims):
        # prefix parity of all quotes of the buffer; only the difference within a line matters
        line_quotes = np.concatenate(([0], np.cumsum(quotes)))
        with_quotes = line_quotes[end] > line_quotes[begin]
    else:
        with_quotes = np.zeros(n, bool)
    run_start, run_end = _run_ends(quotes)
    run_len = run_end - run_start
    odd_end = run_end[run_len % 2 == 1]  # a run of odd length closes a field at its last quote

    counts = np.zeros(n, np.int64)
    bad = np.zeros(n, bool)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    # Lines without quotes: every delimiter ends a field.
    if len(delims):
        owner = np.searchsorted(begin, delims, "right") - 1
        ok = (owner >= 0) & (delims < end[np.maximum(owner, 0)]) & ~with_quotes[np.maximum(owner, 0)]
        d, o = delims[ok], owner[ok]
        prev = np.concatenate(([-1], d[:-1])) + 1
        first = np.concatenate(([True], o[1:] != o[:-1])) if len(o) else np.zeros(0, bool)
        start = np.where(first, begin[o], prev)
        np.add.at(counts, o, 1)
        parts.append((o, start, d, np.zeros(len(d), bool)))
    final = begin.copy()  # where the text after the last terminated field starts
    if len(delims):
        k = np.searchsorted(delims, end, "left") - 1
        last = np.where(k >= 0, delims[np.maximum(k, 0)] + 1, 0)
        final = np.where(~with_quotes, np.maximum(last, begin), begin)

    # Lines with quotes: one field of every such line at a time.
    active = np.flatnonzero(with_quotes)
    pos = begin[active].copy()
    while len(active):
        stop = end[active]
        lead = next_at(pos, nonblank, stop)
        is_q = (lead < stop) & quotes[np.minimum(lead, size - 1)]
        plain_end = next_at(pos, delims, stop)
        # the run that holds the opening quote has one quote less inside the field
        r = np.clip(np.searchsorted(run_start, lead, "right") - 1, 0, max(len(run_start) - 1, 0))
        inner = np.where(is_q, run_end[r] - lead - 1, 0) if len(run_start) else np.zeros(len(active), np.int64)
        here = is_q & (inner % 2 == 1)
        after = next_at(np.where(is_q, run_end[r] if len(run_end) else 0, 0) + 1, odd_end, stop + 1)
        close = np.where(here, run_end[r] if len(run_end) else 0, after)  # one past the closing quote
        closed = is_q & (close <= stop)
        follow = next_at(np.where(closed, close, stop), nonblank, stop)
        fits = closed & ((follow >= stop) | (data[np.minimum(follow, size - 1)] == DELIM))
        wrong = is_q & ~fits
        bad[active[wrong]] = True
        field_end = np.where(is_q, follow, plain_end)
        done = ~wrong & (field_end < stop)
        parts.append((active[done], np.where(is_q, lead + 1, pos)[done], np.where(is_q, close - 1, field_end)[done], is_q[done]))
        np.add.at(counts, active[done], 1)
        final[active[~wrong & ~done]] = pos[~wrong & ~done]
        final[active[done]] = field_end[done] + 1
        active, pos = active[done], field_end[done] + 1
        more = pos < end[active]
        active, pos = active[more], pos[more]
    line = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    starts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    ends = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
    quoted = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, bool)
    order = np.lexsort((starts, line))
    line, starts, ends, quoted = line[order], starts[order], ends[order], quoted[order]
    starts = np.minimum(next_at(starts, nonblank, ends), ends)
    ends = last_solid(ends, nonblank, starts)
    loose = next_at(np.minimum(final, end), nonblank, end) < end
    return Split(counts, starts, ends, line, quoted, bad, loose)


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as one Arrow string array (ranges must not overlap and be ascending)."""
    length = ends - starts
    offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
    at = np.repeat(starts - offsets[:-1], length) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes()))


def _real_dates(texts: pa.Array) -> np.ndarray:
    """Whether each text is a calendar date written YYYYMMDD."""
    shaped = pc.match_substring_regex(texts, r"^[0-9]{8}$").to_numpy(zero_copy_only=False).astype(bool)
    value = np.zeros(len(texts), np.int64)
    value[shaped] = np.array(texts.filter(pa.array(shaped)).to_pylist(), dtype=np.int64)
    year, month, day = value // 10000, value // 100 % 100, value % 100
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    most = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.clip(month, 0, 12)] + ((month == 2) & leap)
    return shaped & (year >= 1) & (month >= 1) & (month <= 12) & (day >= 1) & (day <= most)


def classify(lines: pa.Array, family: np.ndarray) -> tuple[np.ndarray, list[list[str] | None]]:
    """Reject code of each line ('' for a loadable one) and the fields of the loadable lines."""
    n = len(lines)
    codes = np.full(n, "", dtype=object)
    fields: list[list[str] | None] = [None] * n
    raw = pc.fill_null(lines, "").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, n + 1, raw.offset * 8)
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] and raw.buffers()[2].size else np.zeros(0, np.uint8)
    data = np.ascontiguousarray(data[offsets[0] : offsets[-1]])
    shift = np.arange(n)
    begin, end = offsets[:-1] - offsets[0] + shift, offsets[1:] - offsets[0] + shift
    data = np.insert(data, offsets[1:] - offsets[0], 0x0A)  # keeps runs of quotes within their line
    s = split_lines(data, begin, end)
    width = np.array([len(FAMILIES.get(f, ())) for f in family], np.int64)
    wrong_count = (s.counts != width) | s.loose_end
    # control characters and U+FFFD (EF BF BD), C1 controls (C2 80..9F), counted by prefix sums
    ctrl = (data < 0x20) | (data == 0x7F)
    if len(data) > 2:
        ctrl[:-2] |= (data[:-2] == 0xEF) & (data[1:-1] == 0xBF) & (data[2:] == 0xBD)
    if len(data) > 1:
        ctrl[:-1] |= (data[:-1] == 0xC2) & (data[1:] >= 0x80) & (data[1:] <= 0x9F)
    sums = np.concatenate(([0], np.cumsum(ctrl)))
    odd_field = sums[s.ends] > sums[s.starts]
    odd = np.zeros(n, bool)
    odd[s.line[odd_field]] = True
    codes[wrong_count] = "column_count"
    codes[s.bad_quote] = "quoting"
    codes[(codes == "") & odd] = "encoding"
    good = codes == ""
    keep = good[s.line]
    line, starts, ends, quoted = s.line[keep], s.starts[keep], s.ends[keep], s.quoted[keep]
    column = np.arange(len(line)) - np.concatenate(([0], np.cumsum(s.counts * good)))[:-1][line]
    texts = _texts(data, starts, ends).cast(pa.large_string())
    if quoted.any():
        texts = pc.if_else(pa.array(quoted), pc.replace_substring(texts, '""', '"'), texts)
    fam = family[line]
    missing = np.zeros(n, bool)
    missing[line[(column == 0) & (ends == starts)]] = True
    invalid = np.zeros(n, bool)
    for name, columns in FAMILIES.items():
        for k, col in enumerate(columns):
            if col not in PATTERNS and col not in DATES:
                continue
            at = np.flatnonzero((fam == name) & (column == k))
            if not len(at):
                continue
            own = texts.take(pa.array(at))
            fits = _real_dates(own) if col in DATES else pc.match_substring_regex(own, PATTERNS[col]).to_numpy(zero_copy_only=False).astype(bool)
            invalid[line[at[~fits]]] = True
    codes[good & missing] = "missing_primaryid"
    codes[good & ~missing & invalid] = "invalid_value"
    values = texts.to_pylist()
    at = np.concatenate(([0], np.cumsum(s.counts * good)))
    for i in np.flatnonzero(codes == ""):
        fields[i] = values[at[i] : at[i + 1]]
    return codes, fields


def parse_lines(lines: DataFrame, line_id: str = "line_id", family: str = "family", line_no: str = "line_no", line: str = "line") -> DataFrame:
    """Each data line as `(line_id, family, code, fields)`; code is null for a loadable line.

    Header lines (line_no 0) are left out. A null line counts as a blank one (column_count); a null
    line_no, or a table without that column, as data lines. Lines of a family without known columns get no result row. Repeated
    lines are judged one by one. Columns of the input besides the four named are ignored, whatever
    their names.
    """
    kind = lines.schema[line_id].dataType
    body = lines.where(F.coalesce(F.col(line_no), F.lit(1)) != 0) if line_no in lines.columns else lines
    source = body.select(F.col(line_id).alias("line_id"), F.upper(F.trim(F.col(family))).alias("family"), F.col(line).alias("line"))
    known = source.where(F.col("family").isin(*FAMILIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            text = b.column(2).cast(pa.large_string())
            fam = np.array(b.column(1).to_pylist(), dtype=object)
            codes, fields = classify(text, fam)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([c or None for c in codes], pa.string()), pa.array(fields, pa.list_(pa.string()))],
                names=["line_id", "family", "code", "fields"],
            )

    return known.mapInArrow(run, f"line_id {kind.simpleString()}, family string, code string, fields array<string>")


def rejects(lines: DataFrame, **names: str) -> DataFrame:
    """The lines that cannot be loaded: `(line_id, code)`."""
    return parse_lines(lines, **names).where(F.col("code").isNotNull()).select("line_id", "code")


def loaded(lines: DataFrame, family: str, **names: str) -> DataFrame:
    """The typed table of one family: line_id and its columns in lower case, quotes resolved."""
    good = parse_lines(lines, **names).where((F.col("family") == family) & F.col("code").isNull())
    return good.select("line_id", *[F.col("fields")[k].alias(c.lower()) for k, c in enumerate(FAMILIES[family])])


def reject_report(lines: DataFrame, **names: str) -> DataFrame:
    """Per family: lines, loadable lines and the count of each code."""
    found = parse_lines(lines, **names)
    counts = [F.count_if(F.col("code") == c).alias(c) for c in CODES]
    return found.groupBy("family").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("code").isNull()).alias("loaded"), *counts)
