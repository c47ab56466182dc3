"""Holdout metrics and the gates a price model must pass before it may be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidar.functions.gates import Gate, reason_codes
from evidar.operators.selection import percentiles

# Acceptance thresholds.
LIMITS = {"mdape": 0.20, "p90_ape": 0.40, "baseline_improvement": 0.15, "selector_improvement": 0.10,
          "coverage_low": 0.75, "coverage_high": 0.85, "width": 0.50, "subgroup_cases": 30, "subgroup_mdape": 0.25, "supported_share": 0.80}


def ape(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted) / actual


def upper_median(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """keys, n and the value at place n // 2 of the sorted values of each group (not the mean of the middle two)."""
    return percentiles(rows, keys, value, {name: 0.5}, "upper")


def cluster_metrics(rows: DataFrame, keys: list[str], cluster: str) -> DataFrame:
    """Metrics over clusters of rows(actual, predicted, baseline, selected, low, high): every cluster has one vote."""
    per_row = rows.select(
        *keys, F.col(cluster).alias("c"), ape(F.col("actual"), F.col("predicted")).alias("ape"),
        F.abs(F.col("actual") - F.col("predicted")).alias("error"), F.abs(F.col("actual") - F.col("baseline")).alias("baseline_error"),
        F.abs(F.col("actual") - F.col("selected")).alias("selector_error"),
        F.col("actual").between(F.col("predicted") + F.col("low"), F.col("predicted") + F.col("high")).cast("double").alias("covered"),
        ((F.col("high") - F.col("low")) / F.col("predicted")).alias("width"))
    names = ("ape", "error", "baseline_error", "selector_error", "covered", "width")
    per_cluster = per_row.groupBy(*keys, "c").agg(*[F.avg(x).alias(x) for x in names], F.count(F.lit(1)).alias("n"))
    measures = [
        F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("row_count"), F.median("ape").alias("mdape"), F.percentile("ape", 0.9).alias("p90_ape"),
        F.avg("error").alias("mae"), F.avg("baseline_error").alias("baseline_mae"), F.avg("selector_error").alias("selector_mae"),
        F.avg("covered").alias("coverage"), F.median("width").alias("width")]
    out = per_cluster.groupBy(*keys).agg(*measures) if keys else per_cluster.agg(*measures)
    better = lambda c: F.when(F.col(c) != 0, 1 - F.col("mae") / F.col(c))
    return out.withColumn("baseline_improvement", better("baseline_mae")).withColumn("selector_improvement", better("selector_mae"))


def publication_gates(limits: dict[str, float] = LIMITS) -> list[Gate]:
    c = F.col
    return [
        ("holdout_mdape_above_20_percent", c("mdape") > limits["mdape"]),
        ("holdout_p90_ape_above_40_percent", c("p90_ape") > limits["p90_ape"]),
        ("median_baseline_mae_improvement_below_15_percent", c("baseline_improvement") < limits["baseline_improvement"]),
        ("comparable_selector_mae_improvement_below_10_percent", c("selector_improvement") < limits["selector_improvement"]),
        ("prediction_interval_coverage_outside_75_85_percent", ~c("coverage").between(limits["coverage_low"], limits["coverage_high"])),
        ("prediction_interval_width_above_50_percent", c("width") > limits["width"]),
    ]


def gate(metrics: DataFrame) -> DataFrame:
    """metrics with reason_codes and status: passed only if every threshold was measured and met."""
    codes = reason_codes(publication_gates())
    return metrics.withColumn("reason_codes", codes).withColumn("status", F.when(F.size(codes) == 0, "passed").otherwise("blocked"))


def subgroup_gates(metrics: DataFrame, name: str) -> DataFrame:
    """Codes of subgroups with too few cases or too great an error."""
    c = F.col
    return metrics.withColumn("reason_codes", reason_codes([
        ("subgroup_under_30", c("clusters") < LIMITS["subgroup_cases"]), ("subgroup_mdape_above_25_percent", c("mdape") > LIMITS["subgroup_mdape"])])).select(name, "clusters", "mdape", "reason_codes")


def least_squares(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Slope, intercept and r2 of y on x for each key; null where x does not vary."""
    measures = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")]
    return rows.groupBy(*keys).agg(*measures) if keys else rows.agg(*measures)
