"""Checks on outputs: table contracts, graph contract, row invariants, span scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import scalars as S

# Upstream sources an edge of each predicate must name, and the categories of its ends.
UPSTREAM = {
    "biolink:treats": ("infores:labels", "infores:reports"), "biolink:applied_to_treat": ("infores:labels", "infores:reports"), "biolink:contraindicated_in": ("infores:labels",),
}
SUBJECTS = ("biolink:ChemicalEntity", "biolink:SmallMolecule", "biolink:MolecularMixture", "biolink:ComplexMolecularMixture", "biolink:Drug")
OBJECTS = ("biolink:Disease", "biolink:PhenotypicFeature", "biolink:DiseaseOrPhenotypicFeature")
REQUIRED = ("subject", "predicate", "object", "knowledge_level", "agent_type")
CATEGORY_PREFIX = "biolink:"
# What the rows of each relation's predicate must keep: upstream sources, allowed states (if any) and knowledge level.
FAMILIES = {
    "biolink:treats": (("infores:labels", "infores:reports"), ("approved_for_condition",), "knowledge_assertion"),
    "biolink:applied_to_treat": (("infores:reports",), ("approved_for_condition", "off_label_use", "not_provided"), "statistical_association"),
    "biolink:contraindicated_in": (("infores:labels",), (), "knowledge_assertion"),
}


def violations(rows: DataFrame, checks: Mapping[str, Column], example: Column, order: Sequence[Column]) -> DataFrame:
    """`(code, count, example)` of the checks that rows break, with the first example in order.

    One pass: a row's broken checks become an array that is exploded and counted.
    """
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in checks.items()]))
    rank = F.struct(*order)
    hit = rows.select(F.explode(broken).alias("code"), example.alias("example"), rank.alias("rank"))
    return hit.groupBy("code").agg(F.count(F.lit(1)).alias("count"), F.min_by("example", "rank").alias("example"))


_STRINGS = "array<string>"
_SOURCES = "array<struct<resource_id:string,resource_role:string,upstream_resource_ids:array<string>>>"


def _repeated(rows: DataFrame, code: str) -> DataFrame:
    """`(id, code)` for each row of an id but one."""
    twice = rows.where(S.stripped(F.col("id")) != "").groupBy(S.stripped(F.col("id")).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.select("id", F.explode(F.array_repeat(F.lit(code), (F.col("n") - 1).cast("int"))).alias("code"))


def node_problems(nodes: DataFrame) -> DataFrame:
    """`(id, code)` of nodes without id, name or category list, with category entries of another prefix, or repeated."""
    blank = lambda c: S.stripped(F.col(c)) == ""
    own = F.array_compact(F.array(
        F.when(blank("id"), F.lit("node_missing_id")), F.when(blank("name"), F.lit("node_missing_name")), F.when(F.coalesce(F.size("category"), F.lit(0)) <= 0, F.lit("node_missing_category")),
        F.when(F.exists("category", lambda c: ~F.coalesce(c.startswith(CATEGORY_PREFIX), F.lit(False))), F.lit("node_bad_prefix")),
    ))
    return nodes.select(S.stripped(F.col("id")).alias("id"), F.explode(own).alias("code")).unionByName(_repeated(nodes, "node_duplicate_id"))


def upstream_gaps(edges: DataFrame, needed: Sequence[str]) -> DataFrame:
    """`(id, lacking)`: which of the needed sources an edge's provenance does not name upstream, in order, joined by bars."""
    have = F.flatten(F.transform(F.coalesce("sources", F.array().cast(_SOURCES)), lambda s: F.coalesce(s["upstream_resource_ids"], F.array().cast(_STRINGS))))
    return edges.select("id", F.array_join(F.array_sort(F.array_except(F.array(*[F.lit(n) for n in needed]), have)), "|").alias("lacking"))


def edge_problems(edges: DataFrame, nodes: DataFrame, provider: str, upstream: Mapping[str, Sequence[str]] = UPSTREAM, order: Sequence[str] = ()) -> DataFrame:
    """`(id, code)` of edges against their contract.

    Required fields and category, known predicate, ends among the nodes and (for known predicates) of
    fitting categories, provenance that is there and names the provider and the predicate's upstream
    sources, ids that occur once. A repeated node has the categories of its first row in `order`, of
    all rows if there is none. The nodes join once per end, on their least needed columns.
    """
    blank = lambda c: S.stripped(F.col(c)) == ""
    strings = F.array().cast(_STRINGS)
    clean = lambda c: F.filter(F.transform(F.coalesce(c, strings), S.stripped), lambda x: x != "")
    kinds = clean(F.col("category"))
    pick = F.min_by(kinds, F.struct(*order)) if order else F.array_distinct(F.flatten(F.collect_set(kinds)))
    n = nodes.where(~blank("id")).groupBy(S.stripped(F.col("id")).alias("id")).agg(pick.alias("c"))
    e = edges.withColumns({"__s": S.stripped(F.col("subject")), "__o": S.stripped(F.col("object")), "__p": S.stripped(F.col("predicate"))})
    e = e.join(n.select(F.col("id").alias("__s"), F.col("c").alias("sc")), "__s", "left").join(n.select(F.col("id").alias("__o"), F.col("c").alias("oc")), "__o", "left")
    sources = F.coalesce("sources", F.array().cast(_SOURCES))
    named = clean(F.concat(F.transform(sources, lambda s: s["resource_id"]), F.flatten(F.transform(sources, lambda s: F.coalesce(s["upstream_resource_ids"], strings))), F.array("primary_knowledge_source")))
    known = F.col("__p").isin(*upstream)
    needed = F.create_map(*[x for k, v in upstream.items() for x in (F.lit(k), F.array(*[F.lit(u) for u in v]))])
    lacking = F.array_except(F.coalesce(needed[F.col("__p")], strings), named)
    allowed = lambda names: F.array(*[F.lit(c) for c in names])
    none = blank("primary_knowledge_source") & (F.size(sources) == 0)
    own = F.array_compact(F.array(
        F.when(blank("id"), F.lit("edge_missing_id")), *[F.when(blank(c), F.lit(f"edge_missing_{c}")) for c in REQUIRED], F.when(F.size(kinds) == 0, F.lit("edge_missing_category")),
        F.when((F.col("__p") != "") & ~known, F.lit("edge_unknown_predicate")), F.when((F.col("__s") != "") & F.col("sc").isNull(), F.lit("edge_dangling_subject")),
        F.when((F.col("__o") != "") & F.col("oc").isNull(), F.lit("edge_dangling_object")), F.when(known & F.col("sc").isNotNull() & ~F.arrays_overlap("sc", allowed(SUBJECTS)), F.lit("edge_subject_category")),
        F.when(known & F.col("oc").isNotNull() & ~F.arrays_overlap("oc", allowed(OBJECTS)), F.lit("edge_object_category")), F.when(none, F.lit("edge_missing_provenance")),
        F.when(~none & ~F.array_contains(named, provider), F.lit("edge_missing_provider")), F.when(~none & (F.size(lacking) > 0), F.lit("edge_missing_upstream")),
    ))
    return e.select(S.stripped(F.col("id")).alias("id"), F.explode(own).alias("code")).unionByName(_repeated(edges, "edge_duplicate_id"))


def invariant_violations(rows: DataFrame, relation: str, provider: str | None = None, families: Mapping[str, tuple] = FAMILIES) -> DataFrame:
    """Counts of broken invariants of a relation's rows: `(relation, code, count, example)`.

    Blank ends, unsorted lists, missing evidence and counts under one; for rows of a known predicate
    also the provider as primary source (if one is given), the family's upstream sources, states and
    knowledge level. Rows of other predicates are out of scope of these.
    """
    text = lambda c: S.stripped(F.col(c)) if c in rows.columns else F.lit("")
    blank = lambda c: text(c) == "" if c in rows.columns else F.lit(False)
    of = lambda i, kind: F.create_map(*[x for k, v in families.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v[i]]).cast(_STRINGS) if kind else F.lit(v[i]))])[text("predicate")]
    known = text("predicate").isin(*families)
    unsorted = F.lit(False)
    for c in [c for c in rows.columns if c.startswith("supporting_") or c == "approval_ids"]:
        parts = F.split(S.text(F.col(c)), r"\|")
        unsorted = unsorted | (F.array_join(F.array_sort(F.array_distinct(parts)), "|") != S.text(F.col(c)))
    checks = {
        "blank_subject": blank("subject_text"), "blank_object": blank("object_text"), "blank_predicate": blank("predicate"), "list_not_sorted": unsorted,
        "no_evidence": blank("supporting_spl_evidence"), "bad_count": (F.col("case_count").cast("long") < 1) if "case_count" in rows.columns else F.lit(False),
        "primary_knowledge_source": known & (text("primary_knowledge_source") != provider) if provider else F.lit(False),
        "upstream_provenance": known & (F.size(F.array_except(of(0, True), F.split(text("upstream_resource_ids"), r"\|"))) > 0),
        "clinical_approval_status": known & (F.size(of(1, True)) > 0) & ~F.array_contains(of(1, True), text("clinical_approval_status")), "knowledge_level": known & (text("knowledge_level") != of(2, False)),
    }
    found = violations(rows, checks, F.concat_ws("|", "subject_text", "object_text"), [F.col("subject_text"), F.col("object_text")])
    return found.select(F.lit(relation).alias("relation"), "code", "count", "example")


def task_counts(rows: DataFrame, domain: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key over a whole domain; keys without rows count zero."""
    seen = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return domain.select(*keys).distinct().join(seen, list(keys), "left").select(*keys, F.coalesce("n", F.lit(0)).alias("n"))


def span_scores(gold: DataFrame, found: DataFrame, keys: Sequence[str] = ("doc_id", "start", "end", "type")) -> DataFrame:
    """`(tp, fp, fn, precision, recall, f1)` of two span sets by exact keys; ratios of nothing are 0."""
    a, b = gold.select(*keys).distinct().withColumn("g", F.lit(1)), found.select(*keys).distinct().withColumn("f", F.lit(1))
    both = a.join(b, list(keys), "full")
    n = both.agg(F.count_if(F.col("g").isNotNull() & F.col("f").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("f").isNull()).alias("fn"))
    ratio = lambda x, y: F.when(y > 0, x / y).otherwise(0.0)
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return n.select("tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 6).alias("f1"))
