"""Relational building blocks: anti-deletes, case joins, winners by order, latest-wins, gates, edges."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.runtime import sorted_side


def without_deleted(rows: DataFrame, deleted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not among the deleted ones (compared stripped); null keys are never deleted."""
    gone = deleted.select(*[S.stripped(F.col(k)).alias(f"__{k}") for k in keys]).distinct()
    hit = reduce(lambda a, b: a & b, [S.stripped(F.col(k)) == F.col(f"__{k}") for k in keys])
    return rows.join(gone, hit & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]), "left_anti")


def pre_aggregated(rows: DataFrame, keys: Sequence[str], value: str, name: str, sep: str = "$") -> DataFrame:
    """Per key the sorted distinct non-blank values, joined."""
    clean = rows.select(*keys, S.stripped(F.col(value)).alias("v")).where("v <> ''")
    return clean.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("v")), sep).alias(name))


def keep_first(rows: DataFrame, subset: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Of rows equal in `subset` (nulls equal nulls) the first in `order`, then by the other columns.

    An aggregation with map-side combine: a hot group is cut down before it is shuffled. Columns must
    be orderable (no maps or variants).
    """
    rest = [c for c in rows.columns if c not in subset]
    rank = [(F.col(o) if isinstance(o, str) else o).alias(f"__o{i}") for i, o in enumerate(order)]
    best = rows.select(*subset, F.struct(*rank, *rest).alias("__s")).groupBy(*subset).agg(F.min("__s").alias("__s"))
    return best.select(*[F.col(c) if c in subset else F.col(f"__s.{c}") for c in rows.columns])


def latest_wins(rows: DataFrame, key: Column, version: str) -> tuple[DataFrame, DataFrame]:
    """(kept, superseded): all rows of each key's greatest version, and the others with winning_version.

    The winner comes from an aggregation with map-side combine joined back, not from a window over
    the rows, so that a hot key is never one task's group.
    """
    keyed = rows.withColumn("dedup_key", key)
    best = keyed.groupBy("dedup_key").agg(F.max(version).alias("winning_version"))
    both = keyed.join(best.withColumnRenamed("dedup_key", "__key"), F.col("dedup_key").eqNullSafe(F.col("__key"))).drop("__key")
    won = F.col(version).eqNullSafe(F.col("winning_version"))
    return both.where(won).drop("winning_version", "dedup_key"), both.where(~won)


def case_join(indications: DataFrame, drugs: DataFrame, demo: DataFrame, reports: DataFrame, reactions: DataFrame, deleted: DataFrame | None = None) -> DataFrame:
    """Case rows of report families, one per indication, drug, demographic row and report source.

    indication and drug meet on (quarter, primaryid, sequence); demographics and report sources join
    from the left and may multiply; effects are aggregated first. Deleted ids go before any join, in
    their own quarter only. Of rows equal in content the first by drug sequence as text stays.
    """
    families = [indications, drugs, demo, reports, reactions]
    if deleted is not None:
        families = [without_deleted(f, deleted, ["quarter", "primaryid"]) for f in families]
    indications, drugs, demo, reports, reactions = families
    key = ["quarter", "primaryid"]
    i = indications.select(*key, F.col("indi_drug_seq"), F.col("indi_pt").alias("indication"))
    d = drugs.select(*key, "drug_seq", "drugname", F.col("prod_ai").alias("ingredient"), F.col("nda_num").alias("nda_raw"), "role_cod", "source_file")
    m = demo.select(*key, "caseid", "occp_cod", "reporter_country")
    r = reports.select(*key, F.col("rpsr_cod").alias("source"))
    effects = pre_aggregated(reactions, key, "pt", "effects")
    on = (i["quarter"] == d["quarter"]) & (i["primaryid"] == d["primaryid"]) & (i["indi_drug_seq"] == d["drug_seq"])
    rows = i.join(d, on).drop(d["quarter"], d["primaryid"]).join(m, key, "left").join(r, key, "left").join(effects, key, "left")
    rows = rows.withColumn("nda", S.application_key(F.col("nda_raw"))).withColumn("source_record_id", S.joined_id(F.col("quarter"), F.col("primaryid"), F.col("drug_seq"), F.col("indication")))
    rows = rows.select(*[c if c in key else F.coalesce(F.col(c), F.lit("")).alias(c) for c in rows.columns])
    subset = ["quarter", "primaryid", "caseid", "source", "occp_cod", "reporter_country", "drugname", "ingredient", "nda", "indication", "effects"]
    return keep_first(rows, subset, ["drug_seq", "indi_drug_seq", "source_record_id", "role_cod", "nda_raw", "source_file"])


def reduce_cases(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cases, audit): most recent quarter per case id (else primary id), losers with key and winner."""
    key = F.when(S.stripped(F.col("caseid")) != "", S.stripped(F.col("caseid"))).otherwise(S.text(F.col("primaryid")))
    kept, lost = latest_wins(cases, key, "quarter")
    return kept, lost.select("quarter", "primaryid", "caseid", "dedup_key", F.col("winning_version").alias("winning_quarter"), "source_record_id")


def delete_audit(deleted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The deleted rows in the audit's columns; those a file lacks are blank."""
    return deleted.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in deleted.columns else F.lit("").alias(c) for c in columns])


def dropped_warnings(rows: DataFrame, deleted: DataFrame, family: str) -> DataFrame:
    """Per quarter, how many rows of a family the deletion took away."""
    gone = deleted.select(F.col("quarter"), F.col("primaryid")).distinct()
    hit = rows.join(gone, ["quarter", "primaryid"], "left_semi").groupBy("quarter").agg(F.count(F.lit(1)).alias("count"))
    return hit.select("quarter", F.lit(family).alias("family"), F.lit("deleted_rows_dropped").alias("code"), F.lit("rows of deleted ids").alias("message"), "count")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_or_anonymous(ident: Column) -> Column:
    """Distinct non-blank ids, plus one for each row without one."""
    s = S.stripped(ident)
    return F.count_distinct(F.when(s != "", s)) + F.count_if(s == "")


def first_by(value: Column, *order: Column) -> Column:
    """The value of the first row in an order (aggregate)."""
    return F.min_by(value, F.struct(*order))


def min_raw_per_key(rows: DataFrame, group: Sequence[str], key: Column, raw: Column, name: str) -> DataFrame:
    """Per group the sorted least spellings of each non-blank key, as an array."""
    two = rows.select(*group, key.alias("__k"), S.stripped(raw).alias("__v")).where("__k <> ''").groupBy(*group, "__k").agg(F.min("__v").alias("__v"))
    return two.groupBy(*group).agg(F.array_sort(F.collect_set("__v")).alias(name))


def singletons(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value, and it."""
    one = rows.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("__max"))
    return one.where(F.col(value).eqNullSafe(F.col("__max")) & F.col(value).isNotNull()).drop("__max")


def inherited(rows: DataFrame, key: str, column: str, sources: Sequence[DataFrame]) -> DataFrame:
    """rows with a blank `column` filled from the first source (in order) that has the key with a value.

    Within a source the least ordinal column `row_no` wins.
    """
    offers = [s.select(F.col(key).alias("__k"), S.text(F.col(column)).alias("__v"), F.lit(i).alias("__p"), F.col("row_no").alias("__n")).where("__k <> '' and __v <> ''") for i, s in enumerate(sources)]
    best = union_all(offers).groupBy("__k").agg(F.min_by("__v", F.struct("__p", "__n", "__v")).alias("__v"))
    own = S.text(F.col(column))
    return rows.join(best, F.col(key) == F.col("__k"), "left").withColumn(column, F.when(own != "", own).otherwise(F.coalesce("__v", F.lit("")))).drop("__k", "__v")


def typed_lookups(products: DataFrame, order: Sequence[str], separator: str = ";") -> DataFrame:
    """`(lookup_type, term, appl_no, appl_no_stripped, appl_type)`: names, ingredients, NDC and status of products.

    Terms equal but for case are one per type and application; the first in order stays.
    """
    whole = lambda kind, c: F.struct(F.lit(kind).alias("lookup_type"), S.stripped(F.col(c)).alias("term"), F.lit(0).alias("at"))
    parts = F.transform(F.split(S.text(F.col("active_ingredient")), separator), lambda x, i: F.struct(F.lit("ingredient").alias("lookup_type"), S.stripped(x).alias("term"), i.alias("at")))
    every = F.concat(F.array(whole("proprietary_name", "drug_name"), whole("nonproprietary_name", "active_ingredient")), parts, F.array(whole("product_ndc", "product_ndc"), whole("marketing_status", "marketing_status_name")))
    rows = products.where("appl_no_stripped <> ''").select("appl_no", "appl_no_stripped", "appl_type", *order, F.explode(F.filter(every, lambda s: s["term"] != "")).alias("x"))
    flat = rows.select("x.lookup_type", "x.term", "x.at", "appl_no", "appl_no_stripped", "appl_type", *order).withColumn("__fold", F.lower("term"))
    return keep_first(flat, ["lookup_type", "__fold", "appl_no_stripped"], [*order, "at", "term"]).select("lookup_type", "term", "appl_no", "appl_no_stripped", "appl_type")


def dictionary_matches(texts: DataFrame, text: str, terms: DataFrame, term: str, ordinal: str, most: int = 200_000) -> DataFrame:
    """texts with `matches`: the dictionary rows whose term is a plain substring (any case), in dictionary order.

    Each distinct text is scanned once by an automaton over all terms, so the cost does not grow with
    their number. The dictionary goes to every worker if it has at most `most` rows; a longer one is
    joined (dictionary_joins). Null texts get null, texts without a term an empty array.
    """
    names = [c for c in terms.columns if c != ordinal]
    entries = terms.select(F.col(ordinal).cast("long").alias("ordinal"), *[F.col(c).cast("string") for c in names]).where(F.coalesce(F.col(term), F.lit("")) != "").limit(most + 1).collect()
    if len(entries) > most:
        return dictionary_joins(texts, text, terms, term, ordinal)
    listed = [r.asDict() for r in sorted(entries, key=lambda r: r["ordinal"])]
    by_word: dict[str, list[int]] = {}
    for i, e in enumerate(listed):
        by_word.setdefault(e[term].lower(), []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word, at in by_word.items():
            automaton.add_word(word, at)
        if by_word:
            automaton.make_automaton()
        kind = pa.list_(pa.struct([("ordinal", pa.int64())] + [(n, pa.string()) for n in names]))
        for b in batches:
            found = []
            for t in b.column(0).to_pylist():
                hits = {i for _, at in automaton.iter(t.lower()) for i in at} if by_word else set()
                found.append([listed[i] for i in sorted(hits)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["__t", "matches"])

    one = texts.select(F.col(text).alias("__t")).where("__t is not null").distinct()
    shape = ",".join(["ordinal:bigint"] + [f"{n}:string" for n in names])
    hits = one.mapInArrow(run, f"__t string, matches array<struct<{shape}>>")
    return texts.join(sorted_side(hits), F.col(text) == F.col("__t"), "left").drop("__t")


def merged_edges(rows: DataFrame, keys: Sequence[str], unions: Sequence[str], maxima: Sequence[str] = (), firsts: Sequence[str] = (), order: Sequence[str] = (), leads: Sequence[str] = ()) -> DataFrame:
    """One row per key: arrays united, sorted and distinct; greatest scores; `firsts` non-blank and `leads` even if blank, by order.

    All arrays are exploded at once into tagged elements, made distinct with map-side combine and then
    gathered, so that a hot key gathers its distinct values only. Rows with null keys have a key of
    their own; blank elements go.
    """
    none = F.struct(F.lit(-1).alias("tag"), F.lit("").alias("v"))
    element = lambda i: lambda v: F.struct(F.lit(i).alias("tag"), v.alias("v"))
    tagged = [F.transform(F.coalesce(F.col(u), F.array().cast("array<string>")), element(i)) for i, u in enumerate(unions)]
    rank = [F.col(o).alias(f"__{o}") for o in order]
    best = lambda f: F.min(F.when((F.col(f) != "") | F.lit(f in leads), F.struct(*rank, F.col(f).alias("value"))))
    firsts = [*firsts, *leads]
    one = rows.select("*", F.explode(F.concat(F.array(none), *tagged)).alias("__x")).where("__x.tag < 0 or (__x.v is not null and __x.v <> '')")
    one = one.groupBy(*keys, F.col("__x.tag").alias("__tag"), F.col("__x.v").alias("__v")).agg(F.lit(True).alias("__one"), *[F.max(m).alias(m) for m in maxima], *[best(f).alias(f) for f in firsts])
    gather = lambda i: F.array_sort(F.collect_list(F.when(F.col("__tag") == i, F.col("__v"))))
    out = one.groupBy(*keys).agg(*[F.max(m).alias(m) for m in maxima], *[F.min(f).alias(f) for f in firsts], *[gather(i).alias(u) for i, u in enumerate(unions)], F.count(F.lit(1)).alias("__n"))
    return out.select(*keys, *maxima, *[F.coalesce(F.col(f"{f}.value"), F.lit("")).alias(f) for f in firsts], *unions)


def dictionary_joins(texts: DataFrame, text: str, terms: DataFrame, term: str, ordinal: str, gram: int = 3) -> DataFrame:
    """dictionary_matches() for a dictionary of any size, by joins alone.

    A text can only hold a term if it holds the term's rarest gram; terms shorter than a gram are
    looked for by all their grams of their own length. Distinct texts give their distinct grams, which
    meet the terms by an equality join; `instr` verifies.
    """
    names = [c for c in terms.columns if c != ordinal]
    low = terms.where(F.coalesce(F.col(term), F.lit("")) != "").select(F.lower(term).alias("__w"), F.struct(F.col(ordinal).cast("long").alias("ordinal"), *[F.col(c).cast("string").alias(c) for c in names]).alias("__m"))
    low = low.withColumn("__k", F.least(F.length("__w"), F.lit(gram)))
    grams = lambda c, k: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.substring(c, i, k)))
    every = low.select("__w", "__k", F.explode(grams(F.col("__w"), F.col("__k"))).alias("__g")).distinct()
    often = every.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    rare = every.join(often, "__g").groupBy("__w").agg(F.min(F.struct("__n", "__g")).alias("__r")).select("__w", F.col("__r.__g").alias("__g"))
    one = texts.select(F.col(text).alias("__t")).where("__t is not null").distinct()
    sizes = F.array(*[F.lit(k) for k in range(1, gram + 1)])
    own = one.select("__t", F.lower("__t").alias("__l")).select("__t", "__l", F.explode(sizes).alias("__k")).where(F.length("__l") >= F.col("__k")).select("__t", "__l", F.explode(grams(F.col("__l"), F.col("__k"))).alias("__g"))
    met = own.join(rare, "__g").where(F.instr(F.col("__l"), F.col("__w")) > 0).join(low.select("__w", "__m"), "__w")
    hits = met.groupBy("__t").agg(F.array_sort(F.collect_set("__m")).alias("__ms"))
    empty = F.array().cast(hits.schema["__ms"].dataType)
    return texts.join(hits, F.col(text) == F.col("__t"), "left").withColumn("matches", F.when(F.col(text).isNotNull(), F.coalesce("__ms", empty))).drop("__t", "__ms")


def phrase_matches(texts: DataFrame, ident: str, text: str, phrases: DataFrame, phrase: str, most: int = 6) -> DataFrame:
    """`(ident, phrase)`, distinct: which phrases each text holds on word bounds; both in matching form (words and single blanks).

    Texts give their runs of up to `most` words, which meet the phrases by equality; a longer phrase
    meets by its first words and is then looked for in the texts met. No text is compared with phrases
    that it shares no such run with. Nulls and blank phrases meet nothing.
    """
    runs = lambda words, n: F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    asked = phrases.select(F.col(phrase).alias("__p")).where("__p <> ''").distinct().withColumn("__run", F.array_join(F.slice(F.split("__p", " "), 1, most), " "))
    words = texts.select(F.col(ident).alias("__id"), F.split(F.col(text), " ").alias("__w"))
    every = [F.when(F.size("__w") >= n, runs(F.col("__w"), n)).otherwise(F.array().cast("array<string>")) for n in range(1, most + 1)]
    met = words.select("__id", F.explode(F.array_distinct(F.concat(*every))).alias("__run")).join(sorted_side(asked), "__run")
    long = F.size(F.split("__p", " ")) > most
    told = met.where(long).join(sorted_side(texts.select(F.col(ident).alias("__id"), F.col(text).alias("__t"))), "__id").where(S.contains_words(F.col("__t"), F.col("__p"))).select("__id", "__p")
    return met.where(~long).select("__id", "__p").unionByName(told).distinct().select(F.col("__id").alias(ident), F.col("__p").alias(phrase))
