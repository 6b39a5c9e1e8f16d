"""Records of several sources to the entities they denote, without common keys.

Each noisy attribute (drug name, substance, company) is resolved to the spellings of the target table
by the pigeonhole join, over distinct values. Records with the same resolved attributes form one
entity; entities and applications that agree in a brand, or in a substance and the company, become
candidate pairs with a potential from all attributes and their misspellings. Loopy belief propagation
then exchanges messages along the pairs until they settle: an entity denotes at most one application,
and an application is denoted by at most one entity of each source, set of filled attributes and
number of misspellings (rows on different single substances of one product are no rivals). Each
factor's sum is an aggregation with map-side combine that is joined back to its pairs, so that a
factor with many pairs is never one task's group. The marginals are the confidences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.canonical import ACCENTED, MEANT, PLAIN, TYPED, _pigeonhole
from lodestone.runtime import broadcast_if_small, materialize

# Words of dose forms, salts and joins that are no part of a drug's name.
FORM_WORDS = (
    "tab tabs tablet tablets film coated cap caps capsule capsules inj injection vial vials oint ointment crm cream topical soln sol solution oral "
    "susp suspension patch td ext rel er xr sr extended release tm r mg ml mcg and with sodium hydrochloride hcl micronized micronised monohydrate potassium calcium mesylate maleate"
).split()
# Log-odds of the attributes' agreement and what an edit costs.
PRIOR, BRAND, OTHER_NAME, UNKNOWN_NAME = -4.0, 8.0, -8.0, -2.0
SUBSTANCE_NAME, PART_NAME, SUBSTANCE, PART, OTHER_SUBSTANCE, UNKNOWN_SUBSTANCE = 2.0, 1.0, 3.0, 2.0, -5.0, -1.0
FIRM, OTHER_FIRM, UNKNOWN_FIRM, EDIT = 4.0, -3.0, -0.5, 1.2
ROUNDS, SETTLED, SURE = 200, 1e-3, 0.5  # after so many rounds without settling, pairs still moving are reported as such
ENTITY = ("source", "name", "substance", "firm", "slips")
APPLICATIONS = 200_000  # target rows and their spellings are broadcast up to this number


def _plain(col: Column) -> Column:
    low = F.lower(col)
    marked = F.regexp_replace(low, r"\p{M}+|[®™©]", "")
    return F.translate(F.translate(marked, ACCENTED, PLAIN), "’", "'")


def drug_key(col: Column) -> Column:
    """A drug or substance name without strength, form, salt, codes and blanks; null if none is left."""
    bare = F.regexp_replace(_plain(col), r"/\d+/|\([^)]*\)|\d+(?:[.,]\d+)?\s*(?:mg\s*/\s*ml|mcg|mg|µg|ug|ml|g|iu|%)(?![\p{L}])", " ")
    words = F.filter(F.split(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "), " "), lambda w: ~w.isin(FORM_WORDS) & (w != ""))
    key = F.translate(F.array_join(words, ""), TYPED, MEANT)
    return F.when(key != "", key)


def firm_key(col: Column) -> Column:
    """The leading word of a company name, without `Mfr:` and `c/o`; null if there is none."""
    bare = F.regexp_replace(_plain(col), r"^\s*(?:mfr|mfg|manufacturer|c/o|by)\b[\s:.]*", "")
    word = F.split(F.btrim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " ")), " ")[0]
    return F.when(word != "", F.translate(word, TYPED, MEANT))


def targets(products: DataFrame, appl_no: str = "appl_no_stripped", name: str = "drug_name", substances: str = "active_ingredient", firm: str = "sponsor_name") -> DataFrame:
    """`(appl_no, brand, parts, wholes, firm)`, a row per application, from its product rows.

    brand is null if the name is the substance's; parts are the keys of the single substances, wholes
    the ways to write all of them. Of differing rows the most frequent value by name holds.
    """
    p = products.select(F.col(appl_no).alias("appl_no"), drug_key(F.col(name)).alias("brand"), F.col(substances).alias("s"), firm_key(F.col(firm)).alias("firm")).where("appl_no is not null")
    p = p.withColumn("parts", F.array_sort(F.filter(F.transform(F.split("s", r"[;\\+]"), lambda x: drug_key(x)), lambda x: x.isNotNull())))
    one = p.groupBy("appl_no").agg(F.mode("brand", True).alias("brand"), F.mode("firm", True).alias("firm"), F.mode("parts", True).alias("parts"))
    parts = F.coalesce("parts", F.array().cast("array<string>"))
    wholes = F.array_distinct(F.array(F.array_join(parts, ""), F.array_join(F.reverse(parts), "")))
    one = one.select("appl_no", "brand", "firm", parts.alias("parts"), F.filter(wholes, lambda w: w != "").alias("wholes"))
    return one.withColumn("brand", F.when(~F.array_contains("wholes", F.col("brand")), F.col("brand")))


def records(table: DataFrame, source: str, row_id: str, name: str, substance: str, firm: str) -> DataFrame:
    """A source's rows in the common shape `(source, row_id, name, substance, firm)` of keys."""
    s = F.split(F.col(substance), r"[;\\+]")
    joined = F.array_join(F.array_sort(F.filter(F.transform(s, lambda x: drug_key(x)), lambda x: x.isNotNull())), "")
    return table.select(
        F.lit(source).alias("source"), F.col(row_id).cast("long").alias("row_id"), drug_key(F.col(name)).alias("name"), F.when(joined != "", joined).alias("substance"), firm_key(F.col(firm)).alias("firm")
    )


def _resolved(rows: DataFrame, apps: DataFrame) -> DataFrame:
    """rows with each key replaced by the target's nearest spelling (`?` if none is near) and its edits."""
    spark = rows.sparkSession
    tagged = lambda tag, c: F.concat(F.lit(tag), F.col(c))
    drugs = apps.select(F.explode(F.concat(F.array("brand"), "parts", "wholes")).alias("w")).where("w is not null").select(tagged("D", "w").alias("w"))
    refs = materialize(drugs.unionByName(apps.where("firm is not null").select(tagged("F", "firm").alias("w"))).distinct(), "spellings")
    keys = F.array(tagged("D", "name"), tagged("D", "substance"), tagged("F", "firm"))
    asked = rows.select(F.explode(keys).alias("t")).where("t is not null").distinct()
    asked = materialize(asked, "keys")
    known = broadcast_if_small(refs.withColumnRenamed("w", "t"), APPLICATIONS)
    exact = asked.join(known, "t").select("t", F.col("t").alias("w"), F.lit(0).alias("edits"))
    near = _pigeonhole(spark, asked.join(known, "t", "left_anti"), refs).where(F.substring("t", 1, 1) == F.substring("w", 1, 1))
    best = near.groupBy("t").agg(F.min(F.struct("edits", "w")).alias("b")).select("t", "b.w", "b.edits")
    # the orders in which several substances are written are one
    orders = apps.where("size(wholes) > 1").select(F.explode("wholes").alias("o"), F.col("wholes")[0].alias("first")).distinct()
    orders = orders.select(tagged("D", "o").alias("w"), tagged("D", "first").alias("first"))
    nearest = exact.unionByName(best).join(broadcast_if_small(orders, APPLICATIONS), "w", "left").select("t", F.coalesce("first", "w").alias("w"), "edits")
    nearest = materialize(nearest, "nearest")
    out = rows
    for tag, c in (("D", "name"), ("D", "substance"), ("F", "firm")):
        to = nearest.where(F.col("t").startswith(tag)).select(F.substring("t", 2, 1 << 30).alias(c), F.substring("w", 2, 1 << 30).alias(f"{c}_to"), F.col("edits").alias(f"{c}_edits"))
        out = out.join(to, c, "left")
    to = lambda c: F.when(F.col(c).isNull(), "").otherwise(F.coalesce(f"{c}_to", F.lit("?"))).alias(c)
    edits = F.coalesce("name_edits", F.lit(0)) + F.coalesce("substance_edits", F.lit(0)) + F.coalesce("firm_edits", F.lit(0))
    slips = F.greatest(F.coalesce("name_edits", F.lit(0)), edits - F.lit(1))  # a single edit outside the name is forgiven
    return out.select("source", "row_id", to("name"), to("substance"), to("firm"), slips.alias("slips"))


def _pairs(entities: DataFrame, apps: DataFrame) -> DataFrame:
    """Candidate pairs and their potential: a brand in common, or a substance and the company."""
    a = apps.select("appl_no", "brand", "parts", "wholes", F.col("firm").alias("app_firm"))
    every = apps.where("brand is not null").select(F.col("brand").alias("name"), F.lit(True).alias("is_brand")).distinct()
    e = entities.join(broadcast_if_small(every, APPLICATIONS), "name", "left")
    by_brand = e.where("is_brand").join(broadcast_if_small(a.where("brand is not null"), APPLICATIONS), F.col("name") == F.col("brand"))
    spelt = a.select("*", F.explode(F.array_distinct(F.concat("parts", "wholes"))).alias("key"))
    asked = e.where(~F.col("firm").isin("", "?")).select("*", F.explode(F.array_distinct(F.array("name", "substance"))).alias("asked")).where(~F.col("asked").isin("", "?"))
    by_firm = asked.join(broadcast_if_small(spelt, APPLICATIONS), (F.col("asked") == F.col("key")) & (F.col("firm") == F.col("app_firm"))).drop("key", "asked")
    both = by_brand.unionByName(by_firm).dropDuplicates([*ENTITY, "appl_no"])
    whole, part = lambda c: F.array_contains("wholes", F.col(c)), lambda c: F.array_contains("parts", F.col(c))
    name = (
        F.when(F.col("name") == "", 0.0).when(F.col("name") == "?", UNKNOWN_NAME).when(F.col("name").eqNullSafe(F.col("brand")), BRAND)
        .when(whole("name"), SUBSTANCE_NAME).when(part("name"), PART_NAME).otherwise(OTHER_NAME)
    )
    substance = (
        F.when(F.col("substance") == "", 0.0).when(F.col("substance") == "?", UNKNOWN_SUBSTANCE).when(whole("substance"), SUBSTANCE).when(part("substance"), PART).otherwise(OTHER_SUBSTANCE)
    )
    firm = F.when(F.col("firm") == "", 0.0).when(F.col("firm") == "?", UNKNOWN_FIRM).when(F.col("firm") == F.col("app_firm"), FIRM).otherwise(OTHER_FIRM)
    filled = F.concat_ws("", F.when(F.coalesce("is_brand", F.lit(False)), "b").when(F.col("name") == "", "-").otherwise("n"), F.when(F.col("substance") == "", "-").when(part("substance") & ~whole("substance"), F.concat(F.lit("p:"), "substance", F.lit(":"))).otherwise("s"), F.when(F.col("firm") == "", "-").otherwise("f"))
    return both.select(*ENTITY, "appl_no", filled.alias("filled"), (name + substance + firm + F.lit(PRIOR) - F.lit(EDIT) * F.col("slips")).alias("phi"))


def propagate(pairs: DataFrame, entity: Sequence[str], rival: Sequence[str], rounds: int = ROUNDS, settled: float = SETTLED, damping: float = 0.3) -> DataFrame:
    """pairs with `belief`, the marginal probability that the pair holds, and `settled`.

    Sum-product messages in log-odds. The factor of an entity lets at most one of its pairs hold, the
    factor of `rival` (application, source, filled attributes) at most one of its pairs. Every two
    rounds the messages are written, which cuts lineage, and compared with those before; it ends when
    none moved by `settled`. Pairs whose messages still move after `rounds` have settled = false.
    Factors are known by 64-bit hashes of their columns; (entity, rival) is a pair's key.
    """
    keyed = materialize(pairs.withColumns({"__e": F.xxhash64(*entity), "__r": F.xxhash64(*rival)}), "pairs")
    state = keyed.select("__e", "__r", "phi", F.lit(0.0).alias("back"), F.lit(0.0).alias("moved"))

    def others(step: DataFrame, factor: str, weight: Column) -> DataFrame:
        """step with `rest`: the sum of the weights of a factor's other pairs."""
        step = step.withColumn("weight", weight)
        sums = step.groupBy(factor).agg(F.sum("weight").alias("all"))
        return step.join(sums, factor).withColumn("rest", F.greatest(F.col("all") - F.col("weight"), F.lit(0.0))).drop("all", "weight")

    heard = F.exp(F.col("phi") + F.col("back"))
    for k in range(0, rounds, 2):
        step, keep = state.withColumn("was", F.col("back")), F.lit(damping if k else 0.0)
        for _ in range(2):
            # what the entity says of a pair: its potential against none or the entity's other pairs
            step = others(step, "__e", heard).withColumn("said", F.col("phi") - F.log1p("rest"))
            step = others(step, "__r", F.exp("said")).withColumn("back", keep * F.col("back") - (1 - keep) * F.log1p("rest"))
        state = materialize(step.select("__e", "__r", "phi", "back", F.abs(F.col("back") - F.col("was")).alias("moved")), "messages")
        if (state.agg(F.max("moved")).first()[0] or 0.0) < settled:
            break
    logit = F.col("phi") + F.col("back") - F.log1p("rest")
    beliefs = others(state, "__e", heard).select("__e", "__r", (1 / (1 + F.exp(-logit))).alias("belief"), (F.col("moved") < settled).alias("settled"))
    return keyed.join(beliefs, ["__e", "__r"]).drop("__e", "__r")


def match(rows: DataFrame, apps: DataFrame, sure: float = SURE) -> DataFrame:
    """`(appl_no, source, row_id, confidence, settled)`: the application a record denotes, at most one each.

    rows as records() gives them (their union), apps as targets() gives them. confidence is the
    marginal probability; pairs under `sure` are left out. A record without any attribute near a
    target's is no match. Of equally probable applications the first by number holds. Repeated records
    are answered row by row; rows without row_id are left out; empty tables give no rows.
    """
    apps = materialize(apps, "targets")
    keyed = materialize(rows.where("row_id is not null and (name is not null or substance is not null)"), "records")
    near = _resolved(keyed, apps).where("name not in ('', '?') or substance not in ('', '?')")
    near = materialize(near, "resolved")
    pairs = _pairs(near.select(*ENTITY).distinct(), apps)
    beliefs = propagate(pairs, ENTITY, ["appl_no", "source", "filled", "slips"])
    best = beliefs.groupBy(*ENTITY).agg(F.min(F.struct((-F.col("belief")).alias("b"), "appl_no", "settled")).alias("t"))
    best = best.select(*ENTITY, "t.appl_no", F.round(-F.col("t.b"), 6).alias("confidence"), "t.settled").where(F.col("confidence") >= sure)
    return near.join(best, list(ENTITY)).select("appl_no", "source", "row_id", "confidence", "settled")
