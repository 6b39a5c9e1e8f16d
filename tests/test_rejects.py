import random
import re
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest

from lodestone.operators.rejects import FAMILIES, PATTERNS, classify, loaded, parse_lines, reject_report, rejects


def by_hand(line, family):
    """One character at a time, as the rules are worded."""
    s = line.rstrip(" \t")
    if s.endswith("\r"):
        s = s[:-1].rstrip(" \t")
    fields, i = [], 0
    while i < len(s):
        j = i
        while j < len(s) and s[j] in " \t":
            j += 1
        if j < len(s) and s[j] == '"':
            k, buf = j + 1, ""
            while True:
                if k >= len(s):
                    return "quoting"
                if s[k : k + 2] == '""':
                    buf, k = buf + '"', k + 2
                elif s[k] == '"':
                    break
                else:
                    buf, k = buf + s[k], k + 1
            k += 1
            while k < len(s) and s[k] in " \t":
                k += 1
            if k >= len(s):
                return "column_count"
            if s[k] != "$":
                return "quoting"
            fields.append(buf.strip(" \t"))
        else:
            k = s.find("$", i)
            if k < 0:
                if s[i:].strip(" \t"):
                    return "column_count"
                break
            fields.append(s[i:k].strip(" \t"))
        i = k + 1
    if len(fields) != len(FAMILIES[family]):
        return "column_count"
    if any(re.search("[�\x00-\x1f\x7f-\x9f]", f) for f in fields):
        return "encoding"
    if not fields[0]:
        return "missing_primaryid"
    for c, f in zip(FAMILIES[family], fields):
        if c in PATTERNS and not re.fullmatch(PATTERNS[c][1:-1], f):
            return "invalid_value"
        if c == "INIT_FDA_DT":
            try:
                assert re.fullmatch("[0-9]{8}", f)
                datetime.strptime(f, "%Y%m%d")
            except (AssertionError, ValueError):
                return "invalid_value"
    return ""


def codes(lines, families):
    return list(classify(pa.array(lines, pa.large_string()), np.array(families, dtype=object))[0])


@pytest.mark.parametrize("seed", range(3))
def test_random_lines_as_by_hand(seed):
    r = random.Random(seed)
    lines = ["".join(r.choice('"$ a\t\r1é�$') for _ in range(r.randint(0, 14))) for _ in range(20_000)] + ["", '"', '""', "$"]
    families = [r.choice(list(FAMILIES)) for _ in lines]
    assert codes(lines, families) == [by_hand(s, f) for s, f in zip(lines, families)]


@pytest.mark.parametrize(
    ("family", "line", "code"),
    [
        ("INDI", '1234567$1$"a$b ""c"""$\r', ""),
        ("INDI", '1234567$1$5" roll$', ""),
        ("INDI", '1234567$1$"open$', "quoting"),
        ("INDI", '1234567$1$"a"x$', "quoting"),
        ("INDI", "1234567$1$lost", "column_count"),
        ("INDI", "   ", "column_count"),
        ("INDI", "1234567$1$a\tb$", "encoding"),
        ("INDI", " $1$a$", "missing_primaryid"),
        ("INDI", "1234567$010$a$", "invalid_value"),
        ("DEMO", "1234567$1$20240230$MD$US$", "invalid_value"),
        ("DEMO", "1234567$1$20240229$$$", ""),
        ("DEMO", "١٢٣٤٥٦٧$1$20240229$MD$US$", "invalid_value"),
        ("RPSR", "1234567$PER$", ""),
    ],
)
def test_codes(family, line, code):
    assert codes([line], [family]) == [code] == [by_hand(line, family)]


def test_frames(spark, rows):
    data = [(1, "INDI", 0, "HEAD$"), (2, "INDI", 1, "1234567$1$x$"), (2, "INDI", 1, "1234567$1$x$"), (3, "INDI", None, None), (4, "ELSE", 1, "x"), (5, None, 1, "x"), (6, "RPSR", 1, "x" * 500_000)]
    df = spark.createDataFrame(data, "line_id bigint, family string, line_no int, line string").selectExpr("*", "'clash' AS code", "1 AS fields")
    assert rows(rejects(df)) == [(3, "column_count"), (6, "column_count")]
    assert rows(loaded(df, "INDI")) == [(2, "1234567", "1", "x")] * 2
    assert rows(reject_report(df).select("family", "lines", "loaded")) == [("INDI", 3, 2), ("RPSR", 1, 0)]
    assert parse_lines(df.limit(0)).count() == 0
