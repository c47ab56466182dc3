"""Price cleaning: gates, one observation for each cluster and line, robust outlier rejection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.functions.gates import Gate, disposition, fails, ledger_codes, reason_codes
from evidar.functions.prices import training_line
from evidar.operators.selection import percentiles
from evidar.sources.stages import staged

# Fixed values of the outlier rule.
Z_SCALE, Z_LIMIT, MIN_GROUP = 0.6745, 3.5, 10
REVIEW_CODES = ("brokerage_included_price", "multiple_price_terms", "log_price_outlier_insufficient_group")


@dataclass(frozen=True)
class CleaningRule:
    """Which columns play which part, and which gates come first."""

    row_id: str
    cluster: str
    line: str
    group: str
    price: str
    latest: tuple[str, ...]
    gates: tuple[Gate, ...] = field(default_factory=tuple)
    review: tuple[str, ...] = REVIEW_CODES


def cluster_rank(rows: DataFrame, cluster: str, line: str, latest: tuple[str, ...], name: str = "cluster_rank") -> DataFrame:
    """Rank within cluster and line, latest first; a missing date ranks as the empty text."""
    order = [F.coalesce(F.col(c).cast("string"), F.lit("")).desc() for c in latest]
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(cluster, line).orderBy(*order)))


def modified_z(rows: DataFrame, value: Column, keys: list[str], name: str = "modified_z", size: str = "group_size") -> DataFrame:
    """Modified z of value within keys (null where the spread is 0) and how many values the group has. Medians are
    exact, and no task holds a group; rows join them by key."""
    x = rows.withColumn("__x", value)
    centre = percentiles(x, keys, F.col("__x"), {"__m": 0.5}).withColumnRenamed("n", size)
    x = x.join(centre, keys)
    spread = percentiles(x, keys, F.abs(F.col("__x") - F.col("__m")), {"__mad": 0.5}).drop("n")
    return x.join(spread, keys).withColumn(
        name, F.when(F.col("__mad") != 0, F.lit(Z_SCALE) * (F.col("__x") - F.col("__m")) / F.col("__mad"))).drop("__x", "__m", "__mad")


def clean_prices(rows: DataFrame, rule: CleaningRule) -> DataFrame:
    """Every row of rows with reason_codes, disposition (kept, needs_review, excluded), cluster_rank and modified_z.

    Gates come first; of what passes, the latest row of each cluster and line goes on, the others are
    duplicates; of these, rows beyond the limit in log price are outliers where their group has ten
    clusters or more and need review where it has not.
    """
    gated = rows.withColumn("__codes", reason_codes(rule.gates) if rule.gates else F.array().cast("array<string>"))
    failed = gated.where(F.size("__codes") > 0)
    # read by the duplicates, the scored rows and both passes of each percentile
    passed = staged(cluster_rank(gated.where(F.size("__codes") == 0), rule.cluster, rule.line, rule.latest), "passed-gates")
    duplicates = passed.where("cluster_rank > 1").withColumn(
        "__codes", F.array(F.lit("duplicate_account_cluster"), F.concat(F.lit("cluster_rank_"), F.col("cluster_rank").cast("string"))))
    scored = modified_z(passed.where("cluster_rank = 1"), F.ln(F.col(rule.price)), [rule.line, rule.group])
    outlier = F.coalesce(F.abs("modified_z") > Z_LIMIT, F.lit(False))
    scored = scored.withColumn("__codes", F.array_compact(F.array(
        F.when(outlier & (F.col("group_size") >= MIN_GROUP), "log_price_modified_z_outlier"),
        F.when(outlier & (F.col("group_size") < MIN_GROUP), "log_price_outlier_insufficient_group"))))
    every = failed.unionByName(duplicates, allowMissingColumns=True).unionByName(scored, allowMissingColumns=True)
    return every.withColumn("reason_codes", ledger_codes(F.col("__codes"))).withColumn(
        "disposition", disposition(F.col("reason_codes"), rule.review)).drop("__codes")


def market_gates(authorized: Column | None = None) -> tuple[Gate, ...]:
    """Gates of market observations. authorized says whether the row is among the rows that an external
    check authorized; without one every row fails (absence never allows)."""
    c = F.col
    review = c("price_semantic_review")
    return (
        ("market_data_external_authorization_evaluator_required", F.lit(True) if authorized is None else ~F.coalesce(authorized, F.lit(False))),
        ("invalid_price", c("selected_price_twd").isNull() | F.isnan("selected_price_twd") | (c("selected_price_twd") <= 0) | (c("selected_price_twd") == float("inf"))),
        ("currency_not_twd", ~c("currency").eqNullSafe("TWD")),
        ("currency_unverified", ~c("currency_verified").eqNullSafe(True)),
        ("server_not_international", ~c("server").eqNullSafe("international")),
        ("server_unverified", ~c("server_verified").eqNullSafe(True)),
        ("not_seller_listing", ~c("offer_kind").eqNullSafe("seller_listing")),
        ("not_single_account", ~c("entity_kind").eqNullSafe("single_account")),
        ("mixed_price", c("mixed_price").eqNullSafe(True)),
        ("brokerage_included_price", review["brokerage_included"].eqNullSafe(True)),
        ("multiple_price_terms", review["multi_price"].eqNullSafe(True)),
        ("price_type_not_training_line", c("price_line") == "unknown"),
    )


def clean_market(observations: DataFrame, authorized: Column | None = None, include_verified_sales: bool = False) -> DataFrame:
    """clean_prices() of market observations (see FIXTURES §1.3), with their price line and account type."""
    rows = observations.withColumn("price_line", training_line(F.col("price_type"))).withColumn(
        "base_account_type", F.coalesce(F.col("base_account.account_type"), F.lit("unknown")))
    gates = market_gates(authorized)
    if not include_verified_sales:
        gates += (("verified_sale_requires_separate_pool", F.col("price_line") == "verified_sale"),)
    return clean_prices(rows, CleaningRule("history_id", "account_id", "price_line", "base_account_type", "selected_price_twd",
                                           ("post_date", "observed_at", "history_id"), gates))


__all__ = ["CleaningRule", "clean_market", "clean_prices", "cluster_rank", "fails", "market_gates", "modified_z"]
