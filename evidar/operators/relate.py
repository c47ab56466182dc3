"""Joins, closures and identities: audits of references, crosswalks, indexes, claims, islands, nearest dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dangling(child: DataFrame, key: Column, parent: DataFrame, parent_key: Column, edge: str) -> DataFrame:
    """One row: the edge, its rows with a key, and how many of these have no parent."""
    keys = child.select(key.alias("k")).where("k is not null")
    known = parent.select(parent_key.alias("p")).distinct().withColumn("there", F.lit(1))
    return keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(known, F.col("k") == F.col("p"), "left").agg(
        F.lit(edge).alias("edge"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("there").isNull(), F.col("n"))), F.lit(0)).alias("dangling"))


def closure_audit(edges: Iterable[tuple[str, DataFrame, Column, DataFrame, Column]]) -> DataFrame:
    """dangling() of every edge. Keys are counted before they are joined, so a hot key costs one row."""
    out = None
    for name, child, key, parent, parent_key in edges:
        one = dangling(child, key, parent, parent_key, name)
        out = one if out is None else out.unionByName(one)
    return out


def closed_set(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key and side (left_only, right_only) of all keys that only one side has; equal sets give no rows."""
    a, b = left.select(F.col(key).alias("a")).distinct(), right.select(F.col(key).alias("b")).distinct()
    return a.join(b, F.col("a") == F.col("b"), "full_outer").where("a is null or b is null").select(
        F.coalesce("a", "b").alias(key), F.when(F.col("b").isNull(), "left_only").otherwise("right_only").alias("side"))


def crosswalk(source: DataFrame, source_id: str, source_key: Column, canonical: DataFrame, canonical_id: str, canonical_key: Column,
              candidates: DataFrame, candidate_id: str, candidate_key: Column) -> DataFrame:
    """source_id, status, match_id: an exact key's canonical owner, else its candidate owner; more than
    one owner on the level that decides is ambiguous, none on either is unmatched."""

    def owners(df: DataFrame, identity: str, key: Column, name: str) -> DataFrame:
        return df.select(key.alias("key"), F.col(identity).alias("o")).where("key is not null and key <> ''").groupBy("key").agg(
            F.countDistinct("o").alias(f"{name}_n"), F.min("o").alias(f"{name}_id"))

    rows = source.select(F.col(source_id), source_key.alias("key"))
    rows = rows.join(owners(canonical, canonical_id, canonical_key, "canonical"), "key", "left").join(owners(candidates, candidate_id, candidate_key, "candidate"), "key", "left")
    status = (
        F.when(F.col("canonical_n") == 1, "canonical").when(F.col("canonical_n") > 1, "canonical_ambiguous")
        .when(F.col("candidate_n") == 1, "candidate").when(F.col("candidate_n") > 1, "candidate_ambiguous").otherwise("unmatched"))
    return rows.select(source_id, status.alias("status"), F.when(status == "canonical", F.col("canonical_id")).when(status == "candidate", F.col("candidate_id")).alias("match_id"))


def query_index(layers: list[DataFrame]) -> DataFrame:
    """entity_id, entity_type, keys and ambiguous_keys (owned by more than one entity) over the union
    of layers(entity_id, entity_type, key)."""
    every = layers[0]
    for layer in layers[1:]:
        every = every.unionByName(layer)
    every = every.where("key is not null and key <> ''").distinct()
    owners = every.groupBy("key").agg(F.countDistinct("entity_id").alias("owners"))
    return every.join(owners, "key").groupBy("entity_id", "entity_type").agg(
        F.array_sort(F.collect_set("key")).alias("keys"),
        F.array_sort(F.collect_set(F.when(F.col("owners") > 1, F.col("key")))).alias("ambiguous_keys"))


def resolve_claims(claims: DataFrame, index: DataFrame) -> DataFrame:
    """One row for each entity that claims(entity_id, state) name: unknown_reference if index(entity_id,
    ambiguous, review_only) lacks it, conflict if known states differ, else ambiguous, review_only or resolved."""
    states = claims.groupBy("entity_id").agg(
        F.countDistinct(F.when(F.col("state") != "unknown", F.col("state"))).alias("known"),
        F.min(F.when(F.col("state") != "unknown", F.col("state"))).alias("state"), F.count(F.lit(1)).alias("claims"))
    there = index.select(F.col("entity_id").alias("i"), "ambiguous", "review_only")
    status = (
        F.when(F.col("i").isNull(), "unknown_reference").when(F.col("known") > 1, "conflict").when(F.col("ambiguous"), "ambiguous")
        .when(F.col("review_only"), "review_only").when(F.col("known") == 0, "unknown").otherwise("resolved"))
    return states.join(there, F.col("entity_id") == F.col("i"), "left").select(
        "entity_id", status.alias("status"), F.when(status == "resolved", F.col("state")).otherwise("unknown").alias("state"), "claims")


def merge_claims(claims: DataFrame, entity: list[str]) -> DataFrame:
    """Per entity the one known value; null and unknown claim nothing, two known ones conflict and give unknown."""
    value = F.when(~F.col("value").isin("unknown", ""), F.col("value"))
    return claims.groupBy(*entity).agg(F.countDistinct(value).alias("n"), F.min(value).alias("v"), F.array_sort(F.collect_set(F.when(value.isNotNull(), F.col("field")))).alias("sources")).select(
        *entity, F.when(F.col("n") == 1, F.col("v")).otherwise("unknown").alias("value"),
        F.when(F.col("n") > 1, "conflict").when(F.col("n") == 1, "claimed").otherwise("unknown").alias("evidence_state"), "sources")


def merge_assertions(positive: Column, negative: Column) -> Column:
    return F.when(positive & negative, "conflict").when(positive, "positive").when(negative, "negative")


def nearest_date(left: DataFrame, left_date: str, right: DataFrame, right_date: str, right_id: str, key: str, name: str = "nearest_id") -> DataFrame:
    """left with the id of the right row of the same key whose date is nearest on either side; ties go
    to the lesser id. Only distinct dates of each key are compared, neighbours in date order, so
    neither side is crossed with the other."""
    days = right.where(F.col(right_date).isNotNull()).groupBy(F.col(key).alias("k"), F.to_date(right_date).alias("day")).agg(F.min(right_id).alias("rid"))
    asked = left.select(F.col(key).alias("k"), F.to_date(left_date).alias("day")).where("day is not null").distinct()
    line = days.select("k", "day", F.struct("day", "rid").alias("r")).unionByName(asked.select("k", "day", F.lit(None).cast("struct<day:date,rid:" + right.schema[right_id].dataType.simpleString() + ">").alias("r")))
    order = Window.partitionBy("k").orderBy("day")
    line = line.withColumn("before", F.last("r", True).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))).withColumn(
        "after", F.first("r", True).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing)))
    gap = lambda c: F.abs(F.datediff(F.col(c)["day"], "day"))
    choice = F.array_min(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(gap(c).alias("gap"), F.col(c)["rid"].alias("rid"))) for c in ("before", "after")])))
    found = line.where("r is null").select(F.col("k").alias("__k"), F.col("day").alias("__day"), choice.alias("__c")).distinct()
    joined = left.join(found, (F.col(key) == F.col("__k")) & (F.to_date(left_date) == F.col("__day")), "left")
    return joined.withColumn(name, F.col("__c.rid")).withColumn("gap_days", F.col("__c.gap")).drop("__k", "__day", "__c")


def islands(rows: DataFrame, key: list[str], order_index: str) -> DataFrame:
    """key, first, last, size of each run of consecutive order_index values."""
    distinct = rows.select(*key, F.col(order_index).alias("i")).distinct()
    run = F.col("i") - F.row_number().over(Window.partitionBy(*key).orderBy("i"))
    return distinct.withColumn("run", run).groupBy(*key, "run").agg(F.min("i").alias("first"), F.max("i").alias("last"), F.count(F.lit(1)).alias("size")).drop("run")


def expand_range(rows: DataFrame, low: str, high: str, name: str) -> DataFrame:
    """A row for each whole number from low to high."""
    return rows.withColumn(name, F.explode(F.sequence(F.least(low, high), F.greatest(low, high))))


def override(base: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """newer, and the rows of base whose key newer has not."""
    return base.join(newer.select(key).distinct(), key, "left_anti").unionByName(newer, allowMissingColumns=True)


def bijection(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Violations of a 1:1 mapping between two columns: the side, its value and how many partners it has."""
    one = lambda x, y: rows.groupBy(F.col(x).cast("string").alias("value")).agg(F.countDistinct(y).alias("partners")).where("partners <> 1").select(F.lit(x).alias("side"), "value", "partners")
    return one(a, b).unionByName(one(b, a))
