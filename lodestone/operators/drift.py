"""Schemas that drift between files: tagged unions per path, changes between files, one table.

One pass over the rows fuses them to tagged unions: how often each JSON kind occurs at each path of a
file, below the top level too, summed up within each batch before anything is shuffled. Neighbouring
files of a feed are compared on those small schemas; only files that both lose and gain fields have
their records aligned, by hashes of the values of the fields that stayed.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.runtime import broadcast_if_small, materialize, spread

KINDS = ("string", "number", "boolean", "array", "object")
MAX_FILES = 50_000  # compared files and their fields are broadcast up to this number
MAX_PAIRS = 200_000  # pairs of field names that are collected at most


def _lowered(json_text: Column) -> Column:
    """Lower case, without the keys of objects."""
    return F.lower(F.when(json_text.contains('":'), F.regexp_replace(json_text, r'"(?:[^"\\\\]|\\\\.)*"\s*:', " ")).otherwise(json_text))


def _canonical(low: Column) -> Column:
    flag = F.when(low.isin("true", '"y"', '"yes"', '"true"'), "1").when(low.isin("false", '"n"', '"no"', '"false"'), "0")
    joined = F.when(low.contains("-"), F.regexp_replace(low, r"(?<=\d)-(?=\d)", "")).otherwise(low)
    words = F.regexp_extract_all(joined, F.lit(r"(\d+(?:\.\d+)?|\p{L}+)"), F.lit(1))
    zeroes = lambda w: F.rtrim(F.regexp_replace(F.regexp_replace(w, r"^0+(?=\d)", ""), r"(\.\d*?)0+$", "$1"), F.lit("."))
    plain = F.when(joined.contains("0"), F.transform(words, zeroes)).otherwise(words)  # without a zero there is none to drop
    return F.coalesce(flag, F.array_join(F.sort_array(plain), " "))


def canonical_value(json_text: Column) -> Column:
    """A value's form that is alike in all JSON kinds it may be delivered in.

    Words and numbers in alphabetical order, without keys, punctuation, leading zeroes of whole
    numbers or trailing zeroes of fractions; dates as eight digits; flags as 1 and 0.
    """
    return _canonical(_lowered(json_text))


def _cells(payload: str) -> Column:
    """The row's fields as array<struct<field, kind, value, text>> (null for a row that is no object).

    In steps, as an expression within a lambda is evaluated anew wherever it is named.
    """
    v = F.try_parse_json(F.col(payload))
    fields = F.map_entries(F.when(F.schema_of_variant(v).startswith("OBJECT"), v).cast("map<string,variant>"))
    texts = F.transform(fields, lambda e: F.struct(e["key"].alias("field"), F.coalesce(F.to_json(e["value"]), F.lit("null")).alias("text")))
    heads = F.transform(texts, lambda c: F.struct(c["field"].alias("field"), c["text"].alias("text"), F.substring(c["text"], 1, 1).alias("head"), _lowered(c["text"]).alias("low")))
    kind = lambda h: F.when(h == '"', "string").when(h == "{", "object").when(h == "[", "array").when(h.isin("t", "f"), "boolean").when(h != "n", "number")
    return F.transform(heads, lambda c: F.struct(c["field"].alias("field"), kind(c["head"]).alias("kind"), _canonical(c["low"]).alias("value"), c["text"].alias("text")))


def _refuse(constant: str):
    raise ValueError(constant)


def _paths(text: str | None) -> Iterator[tuple[str, str, str | None]]:
    """`(field, path, kind)` of each value in a JSON object, depth first; kind is None for a null."""
    try:
        root = json.loads(text or "", parse_constant=_refuse)
    except (ValueError, RecursionError):
        return
    if not isinstance(root, dict):
        return
    stack = [(k, k, v) for k, v in root.items()]
    while stack:
        field, path, v = stack.pop()
        if isinstance(v, dict):
            yield field, path, "object"
            stack += [(field, f"{path}.{k}", x) for k, x in v.items()]
        elif isinstance(v, list):
            yield field, path, "array"
            stack += [(field, f"{path}[]", x) for x in v]
        else:
            yield field, path, None if v is None else "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "number"


def unions(feed: DataFrame, feed_id: str = "feed_id", file_id: str = "file_id", delivered_at: str = "delivered_at", payload: str = "payload") -> DataFrame:
    """Tagged unions: `(feed_id, file_id, delivered_at, field, path, kind, n)`, how many values of a path have a kind.

    path is the field's name, then `.name` into objects and `[]` into arrays; kind is null for nulls.
    Each file also has one row without a field, which counts its rows. Rows that are no JSON object
    add nothing else. Repeated rows count as often as they occur.
    """
    shape = "feed_id {0}, file_id {1}, delivered_at {2}, field string, path string, kind string, n bigint".format(*[feed.schema[c].dataType.simpleString() for c in (feed_id, file_id, delivered_at)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: Counter = Counter()
            for f, file, at, text in zip(*(c.to_pylist() for c in b.columns)):
                counts[f, file, at, None, None, None] += 1
                counts.update((f, file, at, *p) for p in _paths(text))
            cols = list(zip(*counts)) or [()] * 6
            types = [b.schema.field(i).type for i in range(3)] + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)] + [pa.array(list(counts.values()), pa.int64())], names=["feed_id", "file_id", "delivered_at", "field", "path", "kind", "n"])

    rows = spread(feed.select(F.col(feed_id).alias("feed_id"), F.col(file_id).alias("file_id"), F.col(delivered_at).alias("delivered_at"), F.col(payload).alias("payload")))
    part = rows.mapInArrow(run, shape)
    return part.groupBy("feed_id", "file_id", "field", "path", "kind").agg(F.min("delivered_at").alias("delivered_at"), F.sum("n").alias("n")).select("feed_id", "file_id", "delivered_at", "field", "path", "kind", "n")


def file_schemas(found: DataFrame) -> DataFrame:
    """Of unions(), `(feed_id, file_id, delivered_at, fields)`, a row per file.

    fields is array<struct<field, kind>> with the kind most of the field's non-null values have (of
    equally frequent kinds the first by name; null if all values are null). Files without any
    readable object have an empty array.
    """
    top = found.where(F.col("field").isNull() | (F.col("field") == F.col("path")))
    best = top.groupBy("feed_id", "file_id", "field").agg(F.min("delivered_at").alias("delivered_at"), F.min(F.when(F.col("kind").isNotNull(), F.struct(-F.col("n"), "kind"))).alias("k"))
    entry = F.when(F.col("field").isNotNull(), F.struct("field", F.col("k.kind").alias("kind")))
    return best.groupBy("feed_id", "file_id").agg(F.min("delivered_at").alias("delivered_at"), F.sort_array(F.collect_list(entry)).alias("fields"))


def alternatives(feed: DataFrame, **names: str) -> DataFrame:
    """Alternatives that appear: `(feed_id, path, kind, usual, file_id, files, values)`.

    A path's usual kind is the most frequent in the feed's first file that has a non-null value there
    (of equally frequent ones the first by name). Every other kind the path ever has in the feed gives
    a row with the file it appears in first, and the files and values that have it. Paths within
    objects and arrays count like fields.
    """
    found = materialize(unions(feed, **names), "unions").where("kind is not null")
    at = F.struct("delivered_at", "file_id")
    per = found.groupBy("feed_id", "path", "kind").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("files"), F.sum("n").alias("values"))
    usual = found.groupBy("feed_id", "path").agg(F.min(F.struct("delivered_at", "file_id", -F.col("n"), "kind")).alias("u")).select("feed_id", "path", F.col("u.kind").alias("usual"))
    return per.join(usual, ["feed_id", "path"]).where("kind <> usual").select("feed_id", "path", "kind", "usual", "first.file_id", "files", "values")


def _neighbours(schemas: DataFrame) -> DataFrame:
    """Each file but its feed's first with the file before it and what stayed, went and came."""
    w = Window.partitionBy("feed_id").orderBy("delivered_at", "file_id")
    pairs = schemas.withColumn("old_file", F.lag("file_id").over(w)).withColumn("old", F.lag("fields").over(w)).where(F.col("old_file").isNotNull())
    a, b = F.col("old"), F.col("fields")
    kept = F.array_intersect(a["field"], b["field"])
    kind_of = lambda fields, f: F.get(F.filter(fields, lambda x: x["field"] == f), F.lit(0))["kind"]
    steady = F.filter(kept, lambda f: kind_of(a, f).eqNullSafe(kind_of(b, f)))
    return pairs.select(
        "feed_id", "file_id", "old_file", a.alias("old"), b.alias("new"), kept.alias("kept"), steady.alias("steady"),
        F.array_except(a["field"], b["field"]).alias("gone"), F.array_except(b["field"], a["field"]).alias("come"),
    )


def _renames(feed: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """`(feed_id, file_id, old_field, new_field)` of fields that go and come with the same values."""
    both = pairs.where((F.size("gone") > 0) & (F.size("come") > 0))
    role = lambda file, name, side: both.select(
        F.col("feed_id").alias("pair_feed"), F.col("file_id").alias("pair"), F.col(file).alias("of_file"), F.lit(name).alias("side"), "steady", F.col(side).alias("looked")
    )
    roles = role("old_file", "old", "gone").unionByName(role("file_id", "new", "come"))
    # values are only read of the files that take part
    own = (F.col("file_id") == F.col("of_file")) & (F.col("feed_id") == F.col("pair_feed"))
    met = spread(feed.select("file_id", "feed_id", "payload")).join(broadcast_if_small(roles, MAX_FILES), own).withColumn("cells", _cells("payload")).drop("payload")
    solid = F.filter("cells", lambda c: c["kind"].isNotNull())
    stay = F.transform(F.filter(solid, lambda c: F.array_contains("steady", c["field"])), lambda c: F.xxhash64(c["field"], c["value"]))
    seen = F.sort_array(F.transform(F.filter(solid, lambda c: F.array_contains("looked", c["field"])), lambda c: F.struct(c["field"].alias("field"), c["kind"].alias("kind"), c["value"].alias("value"))))
    # rows alike in all of these fields are one record; four branches read them, so they are written once
    signed = met.select("pair_feed", "pair", "side", F.size("steady").alias("width"), stay.alias("stay"), seen.alias("seen"))
    signed = materialize(signed.withColumn("record", F.xxhash64("stay", "seen")).dropDuplicates(["pair_feed", "pair", "side", "record"]), "records")
    # all values together, all but one, and each alone: marks that only one record of each file has tie the records
    whole = F.aggregate("stay", F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(h))
    mark = lambda kind, h: F.struct(F.lit(kind).alias("alone"), h.alias("hash"))
    marks = F.concat(F.array(mark(False, F.col("whole"))), F.transform("stay", lambda h: mark(False, F.col("whole").bitwiseXOR(h))), F.transform("stay", lambda h: mark(True, h)))
    tokens = signed.where(F.size("stay") > 0).withColumn("whole", whole).select("pair_feed", "pair", "side", "width", "record", F.explode(F.array_distinct(marks)).alias("mark"))
    of = lambda s, agg: agg(F.when(F.col("side") == s, F.col("record"))).alias(f"{s}_{agg.__name__}")
    met_by = tokens.groupBy("pair_feed", "pair", "mark").agg(F.first("width").alias("width"), of("old", F.min), of("old", F.max), of("new", F.min), of("new", F.max))
    ties = met_by.where((F.col("old_min") == F.col("old_max")) & (F.col("new_min") == F.col("new_max")))
    votes = ties.groupBy("pair_feed", "pair", F.col("old_min").alias("old_key"), F.col("new_min").alias("new_key")).agg(
        F.count_if(~F.col("mark.alone")).alias("together"), F.count_if("mark.alone").alias("single"), F.first("width").alias("width")
    )
    by = lambda key: F.row_number().over(Window.partitionBy("pair_feed", "pair", key).orderBy(F.desc("together"), F.desc("single"), "old_key", "new_key"))
    enough = votes.where((F.col("together") > 0) | (F.col("single") > 1) | (F.col("width") < 3)).withColumn("ra", by("old_key")).withColumn("rb", by("new_key"))
    tied = enough.where((F.col("ra") == 1) & (F.col("rb") == 1)).select("pair_feed", "pair", "old_key", "new_key")
    side = lambda name: signed.where(F.col("side") == name).select("pair_feed", "pair", F.col("record").alias(f"{name}_key"), F.col("seen").alias(f"{name}_min"))
    sure = tied.join(side("old"), ["pair_feed", "pair", "old_key"]).join(side("new"), ["pair_feed", "pair", "new_key"])
    linked = sure.join(both.select(F.col("feed_id").alias("pair_feed"), F.col("file_id").alias("pair"), "gone", "come"), ["pair_feed", "pair"])
    one = linked.select("pair_feed", "pair", "old_min", "new_min", F.explode("gone").alias("old_field"), "come").select("*", F.explode("come").alias("new_field"))
    cell = lambda side, f: F.get(F.filter(side, lambda c: c["field"] == F.col(f)), F.lit(0))
    one = one.select("pair_feed", "pair", "old_field", "new_field", cell("old_min", "old_field").alias("a"), cell("new_min", "new_field").alias("b"))
    digits = lambda c: F.regexp_replace(F.regexp_replace(c["value"], r"[^0-9]", ""), r"^0+", "")
    numeric = ((F.col("a.kind") == "number") | (F.col("b.kind") == "number")) & (digits(F.col("a")) == digits(F.col("b"))) & (digits(F.col("a")) != "")
    same = (F.col("a.value") == F.col("b.value")) | numeric
    tally = one.groupBy("pair_feed", "pair", "old_field", "new_field").agg(
        F.count_if(same).alias("agree"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("any"), F.count_distinct(F.when(same, F.col("a.value"))).alias("values")
    )
    # two records that agree on few different values may do so by chance
    good = tally.where((F.col("agree") >= F.lit(least) * F.col("any")) & (F.col("agree") >= F.when(F.col("values") <= 2, 5).otherwise(2)))
    alike = F.levenshtein(F.lower("old_field"), F.lower("new_field"))
    rank = lambda f: F.row_number().over(Window.partitionBy("pair_feed", "pair", f).orderBy((-F.col("agree") / F.col("any")), -F.col("agree"), alike, "old_field", "new_field"))
    mutual = good.withColumn("ra", rank("old_field")).withColumn("rb", rank("new_field")).where((F.col("ra") == 1) & (F.col("rb") == 1))
    return mutual.select(F.col("pair_feed").alias("feed_id"), F.col("pair").alias("file_id"), "old_field", "new_field")


def schema_changes(feed: DataFrame, feed_id: str = "feed_id", file_id: str = "file_id", delivered_at: str = "delivered_at", payload: str = "payload", least: float = 0.8) -> DataFrame:
    """`(feed_id, file_id, change, old_field, new_field)` of each file against the one before it.

    renamed: a field goes and another brings the same values for the records delivered again, in at
    least the share `least` of those that have both (at least 2 records, or 5 where all agree on one
    or two values, as flags do); removed and added: the other fields that go or come; retyped: a
    field, kept or renamed, whose most frequent kind changes. Files are ordered by (delivered_at,
    file_id). Rows that are no JSON object have no fields; a field null throughout has no kind and is
    never retyped. Repeated rows count as often as they occur. An empty table gives no rows; other
    columns are not read.
    """
    rows = feed.select(F.col(feed_id).alias("feed_id"), F.col(file_id).alias("file_id"), F.col(delivered_at).alias("delivered_at"), F.col(payload).alias("payload"))
    pairs = materialize(_neighbours(file_schemas(unions(rows))), "schemas")  # read by each of the steps below
    renames = _renames(rows, pairs, least)
    named = renames.groupBy("feed_id", "file_id").agg(F.collect_list(F.struct("old_field", "new_field")).alias("renamed"))
    full = pairs.join(named, ["feed_id", "file_id"], "left").withColumn("renamed", F.coalesce("renamed", F.array().cast("array<struct<old_field:string,new_field:string>>")))
    row = lambda change, a, b: F.struct(F.lit(change).alias("change"), a.alias("old_field"), b.alias("new_field"))
    kind_of = lambda side, f: F.get(F.filter(side, lambda x: x["field"] == f), F.lit(0))["kind"]
    turned = F.concat(F.transform("kept", lambda f: F.struct(f.alias("old_field"), f.alias("new_field"))), F.col("renamed"))
    retyped = F.filter(turned, lambda p: kind_of("old", p["old_field"]) != kind_of("new", p["new_field"]))
    changes = F.concat(
        F.transform("renamed", lambda p: row("renamed", p["old_field"], p["new_field"])),
        F.transform(F.array_except("gone", F.col("renamed")["old_field"]), lambda f: row("removed", f, F.lit(""))),
        F.transform(F.array_except("come", F.col("renamed")["new_field"]), lambda f: row("added", F.lit(""), f)),
        F.transform(retyped, lambda p: row("retyped", p["old_field"], p["new_field"])),
    )
    return full.select("feed_id", "file_id", F.explode(changes).alias("c")).select("feed_id", "file_id", "c.*")


def _plain(name: str) -> str:
    return name.lower().replace("_", "")


def chained(feed: DataFrame, canonical: dict[str, str], **names: str) -> dict[str, str]:
    """canonical with the further names that the renames of `schema_changes` lead to, over any number of steps.

    A name that is not in canonical gets the column with which most of its renames connect it (of
    equally frequent ones the first by name), but only if it goes and comes by these renames more
    often than without one or by renames to other columns. Distinct names and pairs of names are collected, no rows.
    """
    changes = schema_changes(feed, **names).where("change <> 'retyped'")
    found = changes.groupBy("old_field", "new_field").agg(F.count(F.lit(1)).alias("n")).limit(MAX_PAIRS + 1).collect()
    if len(found) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of field names change")
    pairs = [(_plain(r["old_field"]), _plain(r["new_field"]), r["n"]) for r in found]
    out = dict(canonical)
    while True:
        votes: dict[str, dict[str, int]] = {}
        for a, b, n in pairs:
            for name, other in ((a, b), (b, a)):
                if name and name not in out and other != name:
                    # a rename between two names without a column says nothing yet
                    column = out.get(other) if other else ""
                    if column is not None:
                        votes.setdefault(name, {}).setdefault(column, 0)
                        votes[name][column] += n
        new = {}
        for name, by in votes.items():
            column = min((c for c in by if c), key=lambda c: (-by[c], c), default=None)
            if column and 2 * by[column] > sum(by.values()):
                new[name] = column
        if not new:
            return out
        out |= new


def unified(feed: DataFrame, canonical: dict[str, str], feed_id: str = "feed_id", file_id: str = "file_id", row_no: str = "row_no", payload: str = "payload") -> DataFrame:
    """All rows in one schema: `(feed_id, file_id, row_no)`, a typed union per canonical field, and `rest`.

    canonical maps names (lower case, without `_`) to columns. Each column is a struct: kind (which
    alternative came), text (a string value), number, json (arrays and objects) and value, the
    canonical form that is comparable across kinds. A field that is missing or null gives a null
    struct. Where several names of one column occur in a row, the first non-null by name counts.
    rest maps the names of all other fields of the row to such structs (null for a null value), those
    of further non-null names of a column too; it is empty for a row without any. No field is left out.
    """
    rows = feed.select(F.col(feed_id).alias("feed_id"), F.col(file_id).alias("file_id"), F.col(row_no).alias("row_no"), _cells(payload).alias("cells"))
    plain = lambda c: F.regexp_replace(F.lower(c["field"]), "_", "")
    targets = list(dict.fromkeys(canonical.values()))
    columns = []
    for column in targets:
        names = [k for k, v in canonical.items() if v == column]
        own = F.filter("cells", lambda c: plain(c).isin(names) & c["kind"].isNotNull())
        columns.append(F.array_min(own).alias(column))
    typed = rows.select("feed_id", "file_id", "row_no", "cells", *columns)
    branch = lambda c: F.when(
        c["kind"].isNotNull(),
        F.struct(
            c["kind"].alias("kind"),
            F.when(c["kind"] == "string", F.from_json(F.concat(F.lit('{"v":'), c["text"], F.lit("}")), "v string")["v"]).alias("text"),
            F.when(c["kind"] == "number", c["text"].try_cast("double")).alias("number"),
            F.when(c["kind"].isin("array", "object"), c["text"]).alias("json"),
            c["value"].alias("value"),
        ),
    )
    taken = F.array(*[F.col(c)["field"] for c in targets])
    nothing = lambda c: c["kind"].isNull() & plain(c).isin(list(canonical))
    others = F.filter(F.coalesce("cells", F.array().cast(typed.schema["cells"].dataType)), lambda c: ~nothing(c) & ~F.coalesce(F.array_contains(taken, c["field"]), F.lit(False)))
    rest = F.map_from_entries(F.transform(others, lambda c: F.struct(c["field"], branch(c))))
    whole = typed.select("feed_id", "file_id", "row_no", *targets, rest.alias("rest"))
    return whole.select("feed_id", "file_id", "row_no", *[branch(F.col(c)).alias(c) for c in targets], "rest")
