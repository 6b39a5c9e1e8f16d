"""Free-typed values to the entries of a reference list, by a pigeonhole join in SQL.

A reference word of length L that may differ in k places is cut into k + 1 segments; one of them must
stand unchanged in any spelling within k edits, near its own position. So an equality join of
positional substrings finds all candidates, and levenshtein verifies them. It runs over the distinct
unknown words of the distinct values, not over rows. A value then meets the entries that have its
rarest word, and means an entry if its words, in any order and number, are the entry's words: misspelt within
the edits allowed, or abbreviated. Values written without the right blanks go through the same join
as whole strings. What is left falls to an anti-join and is reported as unmatched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.runtime import broadcast_if_small, materialize

LIST_ROWS = 50_000  # a reference list up to this size is broadcast

# Accented letters and their plain forms, characters typed for a letter, remarks.
ACCENTED = "áàâäãåāăąéèêëēėęěíìîïīįóòôöõøōőúùûüūůűñńňçćčßýÿžźżšśłğďťřđ"
PLAIN = "aaaaaaaaaeeeeeeeeiiiiiioooooooouuuuuuunnncccsyyzzzsslgdtrd"
TYPED, MEANT = "01345@$|i", "oleasasll"
BEFORE = (
    r"(?:pt\s+has|patient\s+has|patient\s+with|h/o|hx(?:\s+of)?|history\s+of|known|suspected|susp\.?|possible|probable|treatment\s+of|treatment\s+for"
    r"|tx(?:\s+of)?|therapy\s+for|used\s+for|for|dx\s*:?|diagnosis\s*:?|indication\s*:?|due\s+to|r/o)(?![\p{L}\p{N}])\s*[:,-]?"
)
AFTER = (
    r"(?:[;,.-]*\s*(?:stable|ongoing|per\s+gp|per\s+patient|per\s+reporter|nos|n\.o\.s\.?|unspecified|since\s+\d{4}|x\s*\d+\s*(?:yrs?|years?|months?|mo|weeks?|days?)"
    r"|-?\s*follow[\s-]up|f/u|controlled|resolved|see\s+notes?)|[\s?!;,.]+)"
)


def _fold(x: str) -> str:
    """SQL of the comparable spelling: mended encoding, no case, accents, remarks; i, l and 1 alike."""
    mended = f"CASE WHEN {x} RLIKE '[ÃÂ]' AND {x} RLIKE '^[\\\\x00-\\\\xff]*$' THEN make_valid_utf8(CAST(encode({x}, 'ISO-8859-1') AS STRING)) ELSE {x} END"
    low = f"regexp_replace(translate(lower({mended}), '{ACCENTED}', '{PLAIN}'), '\\\\p{{M}}+|[\\\\u200b-\\\\u200f\\\\u00ad]', '')"
    one = f"regexp_replace({low}, 'post[-\\\\s]op(?![\\\\p{{L}}])', 'postop')"
    no_notes = f"regexp_replace({one}, '\\\\([^)]*\\\\)|\\\\[[^\\\\]]*\\\\]', ' ')"
    before, after = BEFORE.replace("\\", "\\\\"), AFTER.replace("\\", "\\\\")
    bare = f"regexp_replace(regexp_replace({no_notes}, '^\\\\s*(?:{before}\\\\s*)+', ''), '{after}+$', '')"
    return f"translate({bare}, '{TYPED}', '{MEANT}')"


def _words(folded: str) -> str:
    return f"filter(split(regexp_replace({folded}, '[^\\\\p{{L}}\\\\p{{N}}]+', ' '), ' '), t -> t <> '')"


_EDITS = "CASE WHEN {0} <= 3 THEN 0 WHEN {0} = 4 THEN 1 WHEN {0} <= 8 THEN 2 ELSE 3 END"
# places where segment `part` of a reference of length `len` may stand in a string of length `n`
_PLACES = f"""
SELECT n, len, k, part, explode(sequence(least(lo, hi + 1), hi)) AS at, size, lo FROM (
  SELECT n, len, k, part, size,
         greatest(0, begin - part, begin + (n - len) - (k - part)) AS lo,
         least(n - size, begin + part, begin + (n - len) + (k - part)) AS hi
  FROM (SELECT l.len, l.k, l.n, p.part, l.len * p.part DIV (l.k + 1) AS begin, l.len * (p.part + 1) DIV (l.k + 1) - l.len * p.part DIV (l.k + 1) AS size
        FROM (SELECT len, k, explode(sequence(len - k, len + k)) AS n FROM (SELECT DISTINCT length(w) AS len, {_EDITS.format("length(w)")} AS k FROM {{refs}})) l
        LATERAL VIEW explode(sequence(0, l.k)) p AS part WHERE n > 0)) WHERE lo <= hi
"""
_SEGMENTS = f"""
SELECT w, len, part, substring(w, len * part DIV (k + 1) + 1, len * (part + 1) DIV (k + 1) - len * part DIV (k + 1)) AS seg
FROM (SELECT w, length(w) AS len, {_EDITS.format("length(w)")} AS k FROM {{refs}}) LATERAL VIEW explode(sequence(0, k)) p AS part
"""
_NEAR = f"""
SELECT t, w, levenshtein(t, w) AS edits FROM (
  SELECT DISTINCT q.t, s.w FROM (
    SELECT /*+ BROADCAST(p) */ u.t, p.len, p.part, substring(u.t, p.at + 1, p.size) AS seg
    FROM {{asked}} u JOIN {{places}} p ON length(u.t) = p.n) q
  JOIN {{segments}} s ON q.len = s.len AND q.part = s.part AND q.seg = s.seg)
WHERE levenshtein(t, w) <= {_EDITS.format("length(w)")}
"""

# Of pairs of a value and an entry with all of its listed words: each other word t of the value with each
# other word w of the entry at its cost (edits, or half an edit and a hundredth for each missing letter
# of an abbreviation); the cheapest pairs first, each word once; the entry of least cost. An abbreviation
# has two letters, or three where no word of the value is in full.
_BY_WORDS = f"""
SELECT x, min_by(code, CASE WHEN best.n = n THEN struct(best.cost, key) END) AS code FROM (
  SELECT x, key, code, size(ts) AS n, aggregate(links, struct(0 AS n, 0D AS cost, CAST(array() AS ARRAY<INT>) AS a, CAST(array() AS ARRAY<INT>) AS b),
    (acc, l) -> CASE WHEN array_contains(acc.a, l.i) OR array_contains(acc.b, l.j) THEN acc ELSE struct(acc.n + 1 AS n, acc.cost + l.cost AS cost, array_append(acc.a, l.i) AS a, array_append(acc.b, l.j) AS b) END) AS best
  FROM (SELECT x, key, code, ts, array_sort(filter(flatten(transform(ts, (t, i) -> transform(ws, (w, j) -> struct(
      least(nullif(levenshtein(t, w, {_EDITS.format("length(w)")}), -1) * 1D,
        CASE WHEN length(t) >= CASE WHEN short THEN 3 ELSE 2 END AND length(t) < length(w) AND startswith(w, t) THEN 0.5D + (length(w) - length(t)) / 100D END) AS cost,
      i, j)))), l -> l.cost IS NOT NULL)) AS links FROM {{pairs}}))
GROUP BY x HAVING code IS NOT NULL"""  # as a filter, the comparison would be pushed below the join and made for all pairs


def _pigeonhole(spark, asked: DataFrame, refs: DataFrame) -> DataFrame:
    """`(t, w, edits)` of asked strings t and reference strings w within the edits w's length allows."""
    places = spark.sql(_PLACES, refs=refs)
    segments = broadcast_if_small(spark.sql(_SEGMENTS, refs=refs), 8 * LIST_ROWS)
    return spark.sql(_NEAR, asked=asked, places=places, segments=segments)


def canonical_values(values: DataFrame, entries: DataFrame, value: str = "indication", text: str = "text", code: str = "curie") -> DataFrame:
    """`(value, code)` of each distinct value that is neither null, blank nor exactly an entry's text.

    code is that of the entry meant and '' if there is none. Remarks around a value do not matter. Of
    entries equally near the fewest edits and then the first words by name win. Entries with null
    text or code are left out; an empty list gives '' throughout, an empty table no rows. Only the
    named columns are read, so others may have any name.
    """
    spark = values.sparkSession
    known = entries.select(F.col(text).alias("text"), F.col(code).alias("code")).where("text is not null and code is not null")
    x = values.select(F.col(value).alias("x")).where(F.col("x").rlike(r"(?U)\S"))
    x = x.join(broadcast_if_small(known.select(F.col("text").alias("x")).distinct(), LIST_ROWS), "x", "left_anti").distinct()
    spelt = materialize(x.selectExpr("x", f"{_words(_fold('x'))} AS ws"), "spelt")
    terms = known.selectExpr(f"{_words(_fold('text'))} AS ws", "code").where("size(ws) > 0").selectExpr("array_join(array_sort(ws), ' ') AS key", "array_join(ws, '') AS w", "ws", "code")
    terms = spark.sql("SELECT key, min(w) AS w, min(ws) AS ws, min(code) AS code FROM {t} GROUP BY key", t=terms)
    terms = materialize(terms, "terms")  # read by each of the joins below
    vocabulary = spark.sql("SELECT DISTINCT w FROM (SELECT explode(ws) AS w FROM {terms})", terms=terms)
    v = broadcast_if_small(vocabulary, LIST_ROWS)
    unknown = materialize(spark.sql("SELECT t FROM (SELECT DISTINCT explode(ws) AS t FROM {spelt}) q LEFT ANTI JOIN {v} v ON q.t = v.w", spelt=spelt, v=v), "words")
    near = materialize(_pigeonhole(spark, unknown, vocabulary), "near")
    postings = materialize(spark.sql("SELECT w, key, ws, code, size(ws) AS n FROM (SELECT key, array_distinct(ws) AS ws, code FROM {terms}) LATERAL VIEW explode(ws) e AS w", terms=terms.drop("w")), "postings")
    # whether a word is listed, near a listed one or the beginning of one, and how many entries it may lead to
    words = spark.sql(
        """WITH p AS (SELECT w, count(*) AS posts FROM {postings} GROUP BY w),
        heads AS (SELECT substring(w, 1, n) AS t, sum(posts) AS posts FROM p LATERAL VIEW explode(sequence(2, greatest(2, length(w) - 1))) s AS n GROUP BY 1)
        SELECT t, sum(posts) AS posts, bool_or(listed) AS listed, bool_or(full) AS full FROM (
          SELECT w AS t, posts, true AS listed, true AS full FROM p
          UNION ALL SELECT t, posts, false, true FROM {near} JOIN p USING (w)
          UNION ALL SELECT t, posts, false, false FROM {unknown} JOIN heads USING (t)) GROUP BY t""",
        postings=postings, near=near, unknown=unknown,
    )
    # each value with its words and the one that leads to the fewest entries
    asked = spark.sql(
        """SELECT x, collect_set(CASE WHEN NOT coalesce(listed, false) THEN q.t END) AS ts, collect_set(CASE WHEN listed THEN q.t END) AS listed, bool_and(full IS NOT NULL) AS spelt_out,
          NOT bool_or(coalesce(full, false)) AS short, min(CASE WHEN full IS NOT NULL THEN struct(posts, q.t AS t, listed) END) AS by
        FROM (SELECT x, explode(ws) AS t FROM {spelt}) q LEFT JOIN {words} w ON q.t = w.t GROUP BY x""",
        spelt=spelt, words=words,
    )
    asked = materialize(asked, "asked")
    begun = spark.sql(
        """SELECT u.t, p.w FROM (SELECT DISTINCT by.t AS t FROM {asked} WHERE spelt_out AND NOT by.listed) u
        JOIN (SELECT w, substring(w, 1, n) AS head FROM {v} LATERAL VIEW explode(sequence(2, greatest(2, length(w) - 1))) s AS n) p ON u.t = p.head WHERE levenshtein(u.t, p.w) = length(p.w) - length(u.t)""",
        asked=asked, v=vocabulary,
    )
    reach = spark.sql("SELECT DISTINCT w AS t, w FROM {postings} UNION ALL (SELECT t, w FROM {near} UNION SELECT t, w FROM {begun})", postings=postings, near=near, begun=begun)
    # a listed word stands for itself only, so an entry must have all of them; the other words are compared one by one
    pairs = spark.sql(
        """SELECT a.x, a.ts, a.short, p.key, array_except(p.ws, a.listed) AS ws, p.code FROM {asked} a JOIN {reach} r ON a.by.t = r.t JOIN {postings} p ON r.w = p.w AND size(a.ts) + size(a.listed) = p.n
        WHERE a.spelt_out AND size(array_except(a.listed, p.ws)) = 0""",
        asked=asked, reach=reach, postings=postings,
    )
    by_words = materialize(spark.sql(_BY_WORDS, pairs=pairs), "bywords")
    # unmatched so far: as whole strings without blanks, at one edit if each word is known, else at three
    rest = spark.sql(
        """SELECT s.x, array_join(s.ws, '') AS t, coalesce(a.spelt_out, false) AS spelt_out FROM {spelt} s LEFT ANTI JOIN {found} f ON s.x = f.x
        LEFT JOIN {asked} a ON s.x = a.x WHERE size(s.ws) > 0""",
        spelt=spelt, found=by_words, asked=asked,
    )
    rest = materialize(rest, "rest")
    whole = _pigeonhole(spark, spark.sql("SELECT DISTINCT t FROM {rest}", rest=rest), spark.sql("SELECT DISTINCT w FROM {terms}", terms=terms))
    joined = spark.sql(
        """SELECT x, min_by(code, struct(edits, key)) AS code FROM {rest} r JOIN {whole} h ON r.t = h.t JOIN {terms} k ON h.w = k.w
        WHERE edits <= CASE WHEN spelt_out THEN 1 ELSE 3 END GROUP BY x""",
        rest=rest, whole=whole, terms=broadcast_if_small(terms, LIST_ROWS),
    )
    matched = materialize(by_words.unionByName(joined), "matched")
    # the anti-join reports what is left
    return spark.sql("SELECT x AS value, code FROM {m} UNION ALL SELECT x, '' FROM {s} s LEFT ANTI JOIN {m} USING (x)", m=matched, s=spelt)


def canonical_rows(rows: DataFrame, entries: DataFrame, row_id: str = "case_row_id", value: str = "indication", text: str = "text", code: str = "curie") -> DataFrame:
    """`(row_id, code)` of each row with a value that is neither null, blank nor exactly an entry.

    Repeated values, rows and ids are answered row by row; see canonical_values for the rest.
    """
    found = canonical_values(rows, entries, value, text, code)
    asked = rows.select(F.col(row_id), F.col(value).alias("value"))
    return asked.join(found, "value").select(row_id, "code")


def unmatched_report(rows: DataFrame, entries: DataFrame, value: str = "indication", text: str = "text", code: str = "curie") -> DataFrame:
    """Values without an entry and how many rows have them."""
    lost = canonical_values(rows, entries, value, text, code).where("code = ''").select("value")
    return rows.select(F.col(value).alias("value")).join(lost, "value").groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
