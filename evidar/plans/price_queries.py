"""Queries of price lines: gates, ledgers, robust statistics, splits, metrics and their gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.functions.gates import disposition, ledger_codes, reason_codes
from evidar.operators import cleaning, publication, relate, selection, splits
from evidar.plans.registry import query
from evidar.sources.tables import table

CLEAN_ORDERS_SQL = """
WITH j AS (SELECT o_orderkey, o_custkey, o_orderpriority, c_mktsegment, o_totalprice, o_orderdate, o_orderstatus, c_acctbal
           FROM orders JOIN customer ON o_custkey = c_custkey),
g AS (SELECT *, list_filter([CASE WHEN coalesce(o_totalprice <= 0, true) THEN 'invalid_price' END,
                             CASE WHEN coalesce(o_orderstatus = 'P', true) THEN 'order_pending' END,
                             CASE WHEN coalesce(c_acctbal < 0, true) THEN 'account_overdrawn' END], lambda x: x IS NOT NULL) AS codes FROM j),
r AS (SELECT *, CASE WHEN len(codes) = 0 THEN row_number() OVER (PARTITION BY len(codes) = 0, o_custkey, o_orderpriority
             ORDER BY o_orderdate DESC, o_orderkey DESC) END AS rk FROM g),
m AS (SELECT o_orderpriority, c_mktsegment, median(ln(o_totalprice)) AS md, count(*) AS n FROM r WHERE rk = 1 GROUP BY ALL),
a AS (SELECT o_orderpriority, c_mktsegment, median(abs(ln(o_totalprice) - md)) AS mad FROM r JOIN m USING (o_orderpriority, c_mktsegment) WHERE rk = 1 GROUP BY ALL),
z AS (SELECT r.*, m.n, CASE WHEN rk = 1 AND mad <> 0 THEN 0.6745 * (ln(o_totalprice) - md) / mad END AS z
      FROM r LEFT JOIN m USING (o_orderpriority, c_mktsegment) LEFT JOIN a USING (o_orderpriority, c_mktsegment)),
f AS (SELECT *, CASE WHEN len(codes) > 0 THEN codes WHEN rk > 1 THEN ['duplicate_account_cluster', 'cluster_rank_' || rk]
                     WHEN coalesce(abs(z) > 3.5, false) AND n >= 10 THEN ['log_price_modified_z_outlier']
                     WHEN coalesce(abs(z) > 3.5, false) THEN ['log_price_outlier_insufficient_group'] ELSE [] END AS reasons FROM z)
"""


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"])


def cleaned_orders(spark: SparkSession, sf_dir: str, group: str = "c_mktsegment") -> DataFrame:
    gates = (("invalid_price", F.col("o_totalprice") <= 0), ("order_pending", F.col("o_orderstatus") == "P"), ("account_overdrawn", F.col("c_acctbal") < 0))
    rule = cleaning.CleaningRule("o_orderkey", "o_custkey", "o_orderpriority", group, "o_totalprice", ("o_orderdate", "padded_key"), gates)
    # keys rank as text; padded, they rank as numbers
    return cleaning.clean_prices(priced_orders(spark, sf_dir).withColumn("padded_key", F.lpad(F.col("o_orderkey").cast("string"), 20, "0")), rule)


@query("price_clean_mad", CLEAN_ORDERS_SQL + """
SELECT o_orderkey, o_custkey, o_orderpriority, array_to_string(list_sort(reasons), ',') AS reason_codes,
       CASE WHEN len(reasons) = 0 THEN 'kept' WHEN list_contains(reasons, 'log_price_outlier_insufficient_group') THEN 'needs_review' ELSE 'excluded' END AS disposition,
       round(z, 6) AS modified_z FROM f""")
def price_clean_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.array_join("reason_codes", ",").alias("reason_codes"), "disposition", F.round("modified_z", 6).alias("modified_z"))


@query("price_line_summary", CLEAN_ORDERS_SQL + """
SELECT o_orderpriority, count(*) AS row_count, count(*) FILTER (len(reasons) = 0) AS kept,
       count(*) FILTER (list_contains(reasons, 'duplicate_account_cluster')) AS duplicates,
       count(*) FILTER (list_contains(reasons, 'log_price_modified_z_outlier')) AS outliers,
       round(median(o_totalprice) FILTER (len(reasons) = 0), 4) AS kept_median FROM f GROUP BY 1""")
def price_line_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = lambda code: F.array_contains("reason_codes", code)
    return cleaned_orders(spark, sf_dir).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.size("reason_codes") == 0).alias("kept"), F.count_if(has("duplicate_account_cluster")).alias("duplicates"),
        F.count_if(has("log_price_modified_z_outlier")).alias("outliers"), F.round(F.median(F.when(F.size("reason_codes") == 0, F.col("o_totalprice"))), 4).alias("kept_median"))


@query("reason_ledger", """
WITH g AS (SELECT *, list_sort(list_filter([CASE WHEN l_discount > 0.08 THEN 'discount_high' END, CASE WHEN l_tax > 0.06 THEN 'tax_high' END,
     CASE WHEN l_returnflag = 'R' THEN 'returned' END, CASE WHEN l_quantity > 45 THEN 'quantity_bulk' END], lambda x: x IS NOT NULL)) AS codes FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(codes, ',') AS reason_codes,
       CASE WHEN len(codes) = 0 THEN 'kept' WHEN list_contains(codes, 'returned') THEN 'needs_review' ELSE 'excluded' END AS disposition FROM g""")
def reason_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    codes = ledger_codes(reason_codes([("discount_high", c("l_discount") > 0.08), ("tax_high", c("l_tax") > 0.06),
                                       ("returned", c("l_returnflag") == "R"), ("quantity_bulk", c("l_quantity") > 45)]))
    rows = table(spark, sf_dir, "lineitem").withColumn("codes", codes)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("codes", ",").alias("reason_codes"), disposition(c("codes"), ["returned"]).alias("disposition"))


@query("reason_counts", """
WITH g AS (SELECT unnest(list_filter([CASE WHEN l_discount > 0.08 THEN 'discount_high' END, CASE WHEN l_tax > 0.06 THEN 'tax_high' END,
     CASE WHEN l_returnflag = 'R' THEN 'returned' END, CASE WHEN l_quantity > 45 THEN 'quantity_bulk' END], lambda x: x IS NOT NULL)) AS reason_code, l_quantity FROM lineitem)
SELECT reason_code, count(*) AS row_count, round(sum(l_quantity), 2) AS quantity FROM g GROUP BY 1""")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    codes = reason_codes([("discount_high", c("l_discount") > 0.08), ("tax_high", c("l_tax") > 0.06), ("returned", c("l_returnflag") == "R"), ("quantity_bulk", c("l_quantity") > 45)])
    return table(spark, sf_dir, "lineitem").select(F.explode(codes).alias("reason_code"), "l_quantity").groupBy("reason_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("dedup_rank_ledger", """
SELECT o_orderkey, o_custkey, o_orderpriority, row_number() OVER w AS cluster_rank,
       CASE WHEN row_number() OVER w = 1 THEN '' ELSE 'duplicate_account_cluster,cluster_rank_' || row_number() OVER w END AS reason_codes
FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC)""")
def dedup_rank_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").alias("d"))
    # ids rank as numbers here: padded, so that their text sorts alike
    ranked = cleaning.cluster_rank(orders.withColumn("k", F.lpad(F.col("o_orderkey").cast("string"), 20, "0")), "o_custkey", "o_orderpriority", ("d", "k"))
    codes = F.when(F.col("cluster_rank") == 1, "").otherwise(F.concat(F.lit("duplicate_account_cluster,cluster_rank_"), F.col("cluster_rank").cast("string")))
    return ranked.select("o_orderkey", "o_custkey", "o_orderpriority", "cluster_rank", codes.alias("reason_codes"))


@query("outlier_small_group_review", """
WITH m AS (SELECT o_custkey, median(ln(o_totalprice)) AS md, count(*) AS n FROM orders GROUP BY 1),
a AS (SELECT o_custkey, median(abs(ln(o_totalprice) - md)) AS mad FROM orders JOIN m USING (o_custkey) GROUP BY 1),
z AS (SELECT o_orderkey, o_custkey, n, CASE WHEN mad <> 0 THEN 0.6745 * (ln(o_totalprice) - md) / mad END AS z FROM orders JOIN m USING (o_custkey) JOIN a USING (o_custkey))
SELECT o_orderkey, o_custkey, n AS group_size, round(z, 6) AS modified_z, CASE WHEN n >= 10 THEN 'log_price_modified_z_outlier' ELSE 'log_price_outlier_insufficient_group' END AS reason_code,
       CASE WHEN n >= 10 THEN 'excluded' ELSE 'needs_review' END AS disposition FROM z WHERE abs(z) > 3.5""")
def outlier_small_group_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    found = cleaning.modified_z(orders, F.ln("o_totalprice"), ["o_custkey"]).where(F.abs("modified_z") > cleaning.Z_LIMIT)
    enough = F.col("group_size") >= cleaning.MIN_GROUP
    return found.select("o_orderkey", "o_custkey", "group_size", F.round("modified_z", 6).alias("modified_z"),
                        F.when(enough, "log_price_modified_z_outlier").otherwise("log_price_outlier_insufficient_group").alias("reason_code"),
                        F.when(enough, "excluded").otherwise("needs_review").alias("disposition"))


@query("upper_vs_true_median", """
SELECT c_nationkey, round(median(c_acctbal), 6) AS true_median, round(list_sort(list(c_acctbal))[(count(*) // 2 + 1)::BIGINT], 6) AS upper_median,
       min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer GROUP BY 1""")
def upper_vs_true_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    value = F.col("c_acctbal")
    true = selection.percentiles(rows, ["c_nationkey"], value, {"true_median": 0.5}).drop("n")
    upper = publication.upper_median(rows, ["c_nationkey"], value, "upper_median").drop("n")
    ends = rows.groupBy("c_nationkey").agg(F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))
    return ends.join(true, "c_nationkey").join(upper, "c_nationkey").withColumns({n: F.round(n, 6) for n in ("true_median", "upper_median")})


@query("percentile_linear", """
SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.1), 4) AS p10, round(quantile_cont(o_totalprice, 0.9), 4) AS p90, count(*) AS n FROM orders GROUP BY 1""")
def percentile_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = selection.percentiles(table(spark, sf_dir, "orders"), ["o_orderpriority"], F.col("o_totalprice"), {"p10": 0.1, "p90": 0.9})
    return found.select("o_orderpriority", F.round("p10", 4).alias("p10"), F.round("p90", 4).alias("p90"), "n")


@query("cluster_weighted_error", """
WITH j AS (SELECT o_custkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT c_mktsegment, median(o_totalprice) AS md FROM j GROUP BY 1),
c AS (SELECT c_mktsegment, o_custkey, avg(abs(o_totalprice - md) / o_totalprice) AS ape, count(*) AS n FROM j JOIN m USING (c_mktsegment) GROUP BY ALL)
SELECT c_mktsegment, count(*) AS clusters, sum(n)::BIGINT AS row_count, round(median(ape), 6) AS mdape, round(quantile_cont(ape, 0.9), 6) AS p90_ape,
       CASE WHEN count(*) < 30 THEN 'subgroup_under_30' ELSE '' END AS support FROM c GROUP BY 1""")
def cluster_weighted_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = priced_orders(spark, sf_dir).select("o_custkey", "c_mktsegment", "o_totalprice")
    middle = rows.groupBy("c_mktsegment").agg(F.median("o_totalprice").alias("md"))
    errors = rows.join(middle, "c_mktsegment").groupBy("c_mktsegment", "o_custkey").agg(F.avg(publication.ape(F.col("o_totalprice"), F.col("md"))).alias("ape"), F.count(F.lit(1)).alias("n"))
    return errors.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("row_count"), F.round(F.median("ape"), 6).alias("mdape"), F.round(F.percentile("ape", 0.9), 6).alias("p90_ape"),
        F.when(F.count(F.lit(1)) < 30, "subgroup_under_30").otherwise("").alias("support"))


SPLIT_SQL = """
WITH s AS (SELECT o_custkey, o_orderpriority, min(o_orderdate)::DATE AS b, max(o_orderdate)::DATE AS e FROM orders GROUP BY ALL),
cuts AS (SELECT DISTINCT b AS cut FROM s),
n AS (SELECT cut, count(*) FILTER (e < cut) AS training, count(*) FILTER (b >= cut) AS holdout, count(*) FILTER (b < cut AND e >= cut) AS spanning FROM s, cuts GROUP BY 1),
best AS (SELECT *, least(training, 300) + least(holdout, 100) AS score FROM n WHERE training > 0 AND holdout > 0 ORDER BY score DESC, holdout DESC, cut LIMIT 1)
"""


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    return splits.intervals(rows, ["o_custkey", "o_orderpriority"], "day")


@query("time_forward_split", SPLIT_SQL + """
SELECT cut::VARCHAR AS cut, training, holdout, spanning, score, training >= 300 AND holdout >= 100 AS requirements_met FROM best""")
def time_forward_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.best_cut(order_spans(spark, sf_dir), []).withColumn("cut", F.col("cut").cast("string"))


@query("time_forward_pools", """
WITH s AS (SELECT c_mktsegment, o_custkey, o_orderpriority, min(o_orderdate)::DATE AS b, max(o_orderdate)::DATE AS e FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
cuts AS (SELECT DISTINCT c_mktsegment, b AS cut FROM s),
n AS (SELECT cuts.c_mktsegment, cut, count(*) FILTER (e < cut) AS training, count(*) FILTER (b >= cut) AS holdout, count(*) FILTER (b < cut AND e >= cut) AS spanning
      FROM s JOIN cuts USING (c_mktsegment) GROUP BY ALL),
r AS (SELECT *, least(training, 300) + least(holdout, 100) AS score FROM n WHERE training > 0 AND holdout > 0)
SELECT c_mktsegment, cut::VARCHAR AS cut, training, holdout, spanning, score, training >= 300 AND holdout >= 100 AS requirements_met
FROM r QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY score DESC, holdout DESC, cut) = 1""")
def time_forward_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = priced_orders(spark, sf_dir).select("c_mktsegment", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    spans = splits.intervals(rows, ["o_custkey", "o_orderpriority"], "day", ["c_mktsegment"])
    return splits.best_cut(spans, ["c_mktsegment"]).withColumn("cut", F.col("cut").cast("string"))


@query("split_assignment", SPLIT_SQL + """
SELECT o_custkey, o_orderpriority, CASE WHEN e < cut THEN 'train' WHEN b >= cut THEN 'holdout' ELSE 'spanning' END AS part FROM s, best""")
def split_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = order_spans(spark, sf_dir)
    return spans.crossJoin(F.broadcast(splits.best_cut(spans, []).select("cut"))).select("o_custkey", "o_orderpriority", splits.assign(spans, F.col("cut")).alias("part"))


HOLDOUT_SQL = SPLIT_SQL + """,
rows_ AS (SELECT o_orderkey, o_custkey, o_orderpriority, c_mktsegment, o_totalprice AS actual, o_orderdate::DATE AS day,
                 CASE WHEN e < cut THEN 'train' WHEN b >= cut THEN 'holdout' END AS part
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN s USING (o_custkey, o_orderpriority), best),
tr AS (SELECT * FROM rows_ WHERE part = 'train'), ho AS (SELECT * FROM rows_ WHERE part = 'holdout'),
seg AS (SELECT c_mktsegment, median(actual) AS predicted FROM tr GROUP BY 1), base AS (SELECT median(actual) AS baseline FROM tr),
res AS (SELECT quantile_cont(actual - predicted, 0.1) AS low, quantile_cont(actual - predicted, 0.9) AS high FROM tr JOIN seg USING (c_mktsegment)),
days AS (SELECT DISTINCT c_mktsegment, day FROM ho),
near AS (SELECT days.c_mktsegment, days.day, arg_min(tr.actual, (abs(days.day - tr.day), tr.o_orderkey)) AS selected
         FROM days JOIN tr ON days.c_mktsegment = tr.c_mktsegment GROUP BY ALL),
e_ AS (SELECT o_custkey, o_orderpriority, avg(abs(actual - predicted) / actual) AS ape, avg(abs(actual - predicted)) AS err, avg(abs(actual - baseline)) AS berr,
              avg(abs(actual - selected)) AS serr, avg(CASE WHEN actual BETWEEN predicted + low AND predicted + high THEN 1.0 ELSE 0.0 END) AS cov, avg((high - low) / predicted) AS width, count(*) AS n
       FROM ho JOIN seg USING (c_mktsegment) JOIN near USING (c_mktsegment, day), base, res GROUP BY ALL),
metrics AS (SELECT count(*) AS clusters, sum(n)::BIGINT AS row_count, median(ape) AS mdape, quantile_cont(ape, 0.9) AS p90_ape, avg(err) AS mae, avg(berr) AS baseline_mae,
       avg(serr) AS selector_mae, avg(cov) AS coverage, median(width) AS width, 1 - avg(err) / avg(berr) AS baseline_improvement, 1 - avg(err) / avg(serr) AS selector_improvement FROM e_)
"""


def holdout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdout orders with what a segment median, the global median and the nearest training order predict."""
    spans = order_spans(spark, sf_dir)
    parts = spans.crossJoin(F.broadcast(splits.best_cut(spans, []).select("cut"))).select("o_custkey", "o_orderpriority", splits.assign(spans, F.col("cut")).alias("part"))
    rows = priced_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderpriority", "c_mktsegment", F.col("o_totalprice").alias("actual"), F.to_date("o_orderdate").alias("day"))
    rows = rows.join(parts, ["o_custkey", "o_orderpriority"])
    train, holdout = rows.where("part = 'train'"), rows.where("part = 'holdout'")
    segment = train.groupBy("c_mktsegment").agg(F.median("actual").alias("predicted"))
    base = train.agg(F.median("actual").alias("baseline"))
    residual = train.join(segment, "c_mktsegment").select((F.col("actual") - F.col("predicted")).alias("r")).agg(F.percentile("r", 0.1).alias("low"), F.percentile("r", 0.9).alias("high"))
    found = relate.nearest_date(holdout, "day", train, "day", "o_orderkey", "c_mktsegment").drop("gap_days")
    chosen = train.select(F.col("o_orderkey").alias("nearest_id"), F.col("actual").alias("selected"))
    # one row each: the global median and the residual interval
    return found.join(chosen, "nearest_id").join(segment, "c_mktsegment").crossJoin(F.broadcast(base)).crossJoin(F.broadcast(residual)).withColumn(
        "cluster", F.struct("o_custkey", "o_orderpriority"))


def _rounded(df: DataFrame) -> DataFrame:
    names = ("mdape", "p90_ape", "mae", "baseline_mae", "selector_mae", "coverage", "width", "baseline_improvement", "selector_improvement")
    return df.withColumns({n: F.round(n, 4) for n in names})


@query("holdout_metrics", HOLDOUT_SQL + """
SELECT clusters, row_count, round(mdape, 4) AS mdape, round(p90_ape, 4) AS p90_ape, round(mae, 4) AS mae, round(baseline_mae, 4) AS baseline_mae, round(selector_mae, 4) AS selector_mae,
       round(coverage, 4) AS coverage, round(width, 4) AS width, round(baseline_improvement, 4) AS baseline_improvement, round(selector_improvement, 4) AS selector_improvement FROM metrics""")
def holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(publication.cluster_metrics(holdout_rows(spark, sf_dir), [], "cluster"))


@query("publication_gates", HOLDOUT_SQL + """
, c AS (SELECT list_filter([CASE WHEN mdape > 0.20 THEN 'holdout_mdape_above_20_percent' END, CASE WHEN p90_ape > 0.40 THEN 'holdout_p90_ape_above_40_percent' END,
   CASE WHEN coalesce(baseline_improvement < 0.15, true) THEN 'median_baseline_mae_improvement_below_15_percent' END,
   CASE WHEN coalesce(selector_improvement < 0.10, true) THEN 'comparable_selector_mae_improvement_below_10_percent' END,
   CASE WHEN NOT coverage BETWEEN 0.75 AND 0.85 THEN 'prediction_interval_coverage_outside_75_85_percent' END,
   CASE WHEN width > 0.50 THEN 'prediction_interval_width_above_50_percent' END], lambda x: x IS NOT NULL) AS codes FROM metrics)
SELECT array_to_string(codes, ',') AS reason_codes, CASE WHEN len(codes) = 0 THEN 'passed' ELSE 'blocked' END AS status FROM c""")
def publication_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.gate(publication.cluster_metrics(holdout_rows(spark, sf_dir), [], "cluster")).select(F.array_join("reason_codes", ",").alias("reason_codes"), "status")


@query("ols_one_feature", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, regr_count(l_extendedprice, l_quantity)::BIGINT AS n FROM lineitem GROUP BY 1""")
def ols_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = publication.least_squares(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return found.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"), "n")
