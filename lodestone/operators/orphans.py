"""References to records that do not exist, or not at the time of the reference.

References reduce to distinct (key, time) pairs before anything else, so that a hot key is shuffled
once per distinct time. Keys without any parent row fall to a left anti-join. For the others the
number of living parent rows at each time is a prefix sum, taken per (key, month) and offset by the
months before: a key that holds a third of all rows is split by time and never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.scalars import SPACES
from lodestone.runtime import materialize


def canonical_id(col: Column) -> Column:
    """The id without white space around it and with the part before the first colon in capitals.

    Null stays null; a blank id gives null. An id without a colon only loses its outer white space.
    """
    bare = F.btrim(col, F.lit(SPACES + "\ufeff"))
    at = F.instr(bare, ":")
    folded = F.when(at > 0, F.concat(F.upper(F.substring(bare, F.lit(1), at - 1)), F.substring(bare, at, F.length(bare)))).otherwise(bare)
    return F.when(folded != "", folded)


def _alive(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Of distinct refs (key, at) with a parent key: rows arrived by then, and rows living then."""
    life = parents.where(F.col("arrived").isNotNull())
    end = F.col("deleted").isNotNull()
    # a row deleted before or when it arrived never lives
    lives = ~end | (F.col("deleted") > F.col("arrived"))
    event = life.select(
        "key",
        F.explode(
            F.array(
                F.struct(F.col("arrived").alias("at"), F.lit(1).alias("came"), lives.cast("int").alias("living")),
                F.struct(F.when(end & lives, F.col("deleted")).alias("at"), F.lit(0).alias("came"), F.lit(-1).alias("living")),
            )
        ).alias("e"),
    ).select("key", "e.*").where(F.col("at").isNotNull())
    event = event.groupBy("key", "at").agg(F.sum("came").alias("came"), F.sum("living").alias("living"))
    asked = refs.select("key", "at", F.lit(0).cast("long").alias("came"), F.lit(0).cast("long").alias("living"), F.lit(True).alias("asked"))
    both = event.withColumn("asked", F.lit(False)).unionByName(asked).withColumn("month", F.trunc("at", "month"))
    months = both.groupBy("key", "month").agg(F.sum("came").alias("came"), F.sum("living").alias("living"))
    before = Window.partitionBy("key").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    offsets = months.select(
        "key", "month", F.coalesce(F.sum("came").over(before), F.lit(0)).alias("came0"), F.coalesce(F.sum("living").over(before), F.lit(0)).alias("living0")
    )
    within = Window.partitionBy("key", "month").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    running = both.select("key", "month", "at", "asked", F.sum("came").over(within).alias("came"), F.sum("living").over(within).alias("living"))
    return running.where("asked").join(offsets, ["key", "month"]).select("key", "at", (F.col("came") + F.col("came0")).alias("came"), (F.col("living") + F.col("living0")).alias("living"))


def orphan_references(
    children: DataFrame,
    parents: DataFrame,
    endpoints: Sequence[str] = ("subject", "object"),
    child_id: str = "id",
    child_time: str = "asserted_at",
    parent_id: str = "id",
    arrived: str = "arrived_at",
    deleted: str = "deleted_at",
) -> DataFrame:
    """Distinct `(id, endpoint, key, at, reason)` of references without a living parent.

    reason: `missing` (no parent row of that key at all), `late` (all its rows arrived after the
    reference), else `deleted`. Null or blank references are no references. A reference without a
    time is only tested for `missing`. A parent row without arrival counts as never arrived. Repeated
    child rows give one result row; a null child id stays null. Empty tables give no rows (children)
    or all references as `missing` (parents). Only the named columns are read.
    """
    endpoint = F.explode(F.array(*[F.struct(F.lit(e).alias("endpoint"), canonical_id(F.col(e)).alias("key")) for e in endpoints]))
    refs = children.select(F.col(child_id).alias("id"), F.col(child_time).alias("at"), endpoint.alias("r"))
    # the distinct references are read by four branches, so they are written once
    refs = materialize(refs.select("id", "at", "r.*").where(F.col("key").isNotNull()).distinct(), "references")
    alive = parents.select(canonical_id(F.col(parent_id)).alias("key"), F.col(arrived).alias("arrived"), F.col(deleted).alias("deleted")).where(F.col("key").isNotNull())
    wanted = refs.select("key", "at").distinct()
    keys = alive.select("key").distinct()
    missing = wanted.join(keys, "key", "left_anti").select("key", "at", F.lit("missing").alias("reason"))
    there = _alive(wanted.where(F.col("at").isNotNull()).join(keys, "key", "left_semi"), alive)
    dead = there.where(F.col("living") <= 0).select("key", "at", F.when(F.col("came") == 0, "late").otherwise("deleted").alias("reason"))
    lost = missing.unionByName(dead).toDF("lost_key", "lost_at", "reason")
    hit = (F.col("key") == F.col("lost_key")) & F.col("at").eqNullSafe(F.col("lost_at"))
    return refs.join(lost, hit).select("id", "endpoint", "key", "at", "reason")


def orphan_report(children: DataFrame, parents: DataFrame, **names) -> DataFrame:
    """Orphans per endpoint, reason and quarter of the reference (period null without a time)."""
    found = orphan_references(children, parents, **names)
    period = F.when(F.col("at").isNotNull(), F.concat_ws("", F.year("at").cast("string"), F.lit("Q"), F.quarter("at").cast("string")))
    return found.groupBy("endpoint", "reason", period.alias("period")).agg(F.count(F.lit(1)).alias("orphans"), F.count_distinct("key").alias("keys"))
