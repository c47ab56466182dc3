"""Queries of features and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.operators import modelling, sparse_net
from evidar.plans.registry import query
from evidar.sources.tables import table

FEATURE_SQL = """
WITH f AS (SELECT c_custkey, unnest(['segment', 'nation', 'balance']) AS feature, unnest([c_mktsegment, c_nationkey::VARCHAR, CASE WHEN c_acctbal > 0 THEN floor(c_acctbal)::BIGINT::VARCHAR END]) AS value FROM customer)
"""


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return modelling.long_features(table(spark, sf_dir, "customer"), "c_custkey", {
        "segment": c("c_mktsegment"), "nation": c("c_nationkey"), "balance": F.when(c("c_acctbal") > 0, F.floor("c_acctbal"))})


@query("feature_long", FEATURE_SQL + "SELECT c_custkey, feature, value FROM f WHERE value IS NOT NULL")
def feature_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_features(spark, sf_dir)


@query("feature_nested", """
WITH n AS (SELECT o_custkey, list({'id': o_orderkey, 'status': o_orderstatus}) AS a FROM orders GROUP BY 1),
b AS (SELECT c_custkey, unnest(a) AS e FROM customer JOIN n ON o_custkey = c_custkey)
SELECT c_custkey, 'segment' AS feature, c_mktsegment AS value FROM customer UNION ALL SELECT c_custkey, 'orders.' || e.id || '.status', e.status FROM b
UNION ALL SELECT c_custkey, 'orders', '__empty__' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM n)""")
def feature_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))).alias("a"))
    rows = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    there = F.coalesce("a", F.array().cast("array<struct<id:bigint,status:string>>"))
    return modelling.long_features(rows.withColumn("a", there), "c_custkey", {"segment": F.col("c_mktsegment")}, {"orders": (F.col("a"), "id", ["status"])})


@query("feature_types", FEATURE_SQL + "SELECT feature, bool_and(regexp_full_match(value, '-?[0-9]+(\\.[0-9]+)?')) AS numeric, count(*) AS n FROM f WHERE value IS NOT NULL GROUP BY 1")
def feature_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling.column_types(customer_features(spark, sf_dir))


@query("feature_sparse", FEATURE_SQL + """
SELECT c_custkey, CASE WHEN feature = 'segment' THEN feature || '=' || value ELSE feature END AS feature, CASE WHEN feature = 'segment' THEN 1.0 ELSE value::DOUBLE END AS value FROM f WHERE value IS NOT NULL""")
def feature_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling.sparse_vector(customer_features(spark, sf_dir), "c_custkey")


MODEL = {"intercept": 10.5, "columns": [
    {"name": "l_quantity", "coefficient": 0.5, "mean": 25.0, "scale": 14.5, "median": 25.0}, {"name": "l_discount", "coefficient": -0.05, "mean": 0.05, "scale": 0.0316, "median": 0.05},
    {"name": "l_quantity__missing", "coefficient": -0.2, "mean": 0.0, "scale": 1.0, "median": 0.0}]}
SCORE_SQL = "10.5 + 0.5 * (coalesce(l_quantity, 25.0) - 25.0) / 14.5 + -0.05 * (coalesce(l_discount, 0.05) - 0.05) / 0.0316 + -0.2 * (CASE WHEN l_quantity IS NULL THEN 1.0 ELSE 0.0 END - 0.0) / 1.0"


@query("portable_score", f"SELECT l_orderkey, l_linenumber, l_partkey, round({SCORE_SQL}, 6) AS log_price FROM lineitem")
def portable_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round(modelling.portable_score(rows, MODEL), 6).alias("log_price"))


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax", F.ln("l_extendedprice").alias("log_price"))


@query("elastic_net_fit")
def elastic_net_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = modelling.ElasticNet(["l_quantity", "l_discount", "l_tax"], "log_price").fit(priced_lines(spark, sf_dir), 0.01, 0.5)
    rows = [("intercept", float(model["intercept"]))] + [(c["name"], c["coefficient"]) for c in model["columns"]]
    return spark.createDataFrame(rows, "name string, coefficient double")


@query("elastic_net_cv")
def elastic_net_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = modelling.ElasticNet(["l_quantity", "l_discount", "l_tax"], "log_price")
    return spark.createDataFrame([modelling.nested_cv(priced_lines(spark, sf_dir), net, "l_orderkey", 3)],
                                 "rows long, alpha double, l1_ratio double, mae double, baseline_mae double, beats_baseline boolean")


@query("bootstrap_ci")
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling.bootstrap_ci(table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal"), ["c_mktsegment"], "c_acctbal")


@query("ensemble_price", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, [ln(l_extendedprice), ln(l_quantity * 1000)] AS x, [0.2, CASE WHEN l_discount > 0.05 THEN 0.4 ELSE 0.0 END] AS m FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber, l_partkey, unnest(x) AS x, unnest(m) AS m FROM p),
e AS (SELECT l_orderkey, l_linenumber, l_partkey, sum(x / m) FILTER (m > 0) / sum(1 / m) FILTER (m > 0) AS lp, count(*) FILTER (m > 0) AS models, row_number() OVER () AS r FROM u GROUP BY ALL)
SELECT l_partkey, count(*) AS lines, round(avg(lp), 6) AS mean_log_price, max(models) AS models FROM e GROUP BY 1""")
def ensemble_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    lines = table(spark, sf_dir, "lineitem").withColumn("id", F.struct("l_orderkey", "l_linenumber", "l_partkey"))
    either = F.array(F.struct(F.ln("l_extendedprice").alias("log_price"), F.lit(0.2).alias("mae")),
                     F.struct(F.ln(c("l_quantity") * 1000).alias("log_price"), F.when(c("l_discount") > 0.05, 0.4).otherwise(0.0).alias("mae")))
    found = modelling.ensemble(lines.select("id", F.explode(either).alias("e")).select("id", "e.*"), "id")
    return found.groupBy(c("id.l_partkey").alias("l_partkey")).agg(F.count(F.lit(1)).alias("lines"), F.round(F.avg(F.ln("price")), 6).alias("mean_log_price"), F.max("models").alias("models"))


@query("grouped_folds_check", "SELECT count(DISTINCT o_custkey) AS groups, count(*) AS rows, 0 AS split_groups FROM orders")
def grouped_folds_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = modelling.grouped_folds(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", 5)
    per = folded.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("fold").alias("folds"))
    return per.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"), F.count_if(F.col("folds") > 1).cast("int").alias("split_groups"))


NET_FEATURES = """
f AS (SELECT c_custkey, unnest(['mkt.segment', 'mkt.nation', 'acct.balance']) AS feature, unnest([c_mktsegment, CASE WHEN c_nationkey < 20 THEN 'n' || c_nationkey END, CASE WHEN c_acctbal > 0 THEN floor(c_acctbal)::BIGINT::VARCHAR END]) AS value FROM customer),
g AS (SELECT * FROM f WHERE value IS NOT NULL)"""


def net_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.when(F.col("c_nationkey") < 20, F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    return modelling.long_features(table(spark, sf_dir, "customer"), "c_custkey", {
        "mkt.segment": F.col("c_mktsegment"), "mkt.nation": nation, "acct.balance": F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal"))})


@query("sparse_gram", f"""WITH {NET_FEATURES},
e AS (SELECT c_custkey, '1' AS c, 1.0::DOUBLE AS x FROM customer UNION ALL SELECT c_custkey, 'y', (c_custkey % 7)::DOUBLE FROM customer UNION ALL SELECT c_custkey, 'n:acct.balance', value::DOUBLE FROM g WHERE feature = 'acct.balance'
  UNION ALL SELECT c_custkey, 'c:' || feature || '=' || value, 1.0 FROM g WHERE feature <> 'acct.balance' UNION ALL SELECT c_custkey, 'p:' || feature, 1.0 FROM g WHERE feature <> 'mkt.segment')
SELECT a.c AS "left", b.c AS "right", sum(a.x * b.x) AS total FROM e a JOIN e b ON a.c_custkey = b.c_custkey AND a.c <= b.c GROUP BY 1, 2""")
def sparse_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 7).alias("y"))
    entries, _ = sparse_net.design(rows, net_features(spark, sf_dir), "c_custkey", "y")
    return sparse_net.sparse_gram(entries, "c_custkey").withColumnRenamed("sum", "total")


@query("sparse_net_coefficients")
def sparse_net_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.ln(F.col("c_acctbal") + 2000).alias("y"))
    return sparse_net.fit(rows, net_features(spark, sf_dir), "c_custkey", "y", 0.01, 0.5)[1]


@query("net_scores", f"""WITH {NET_FEATURES},
t AS (SELECT feature, value, count(*) / (SELECT count(*) FROM customer) AS w FROM g WHERE feature <> 'acct.balance' AND value <> 'n3' GROUP BY 1, 2),
a AS (SELECT avg(value::DOUBLE) AS m, stddev_pop(value::DOUBLE) AS s FROM g WHERE feature = 'acct.balance'),
p AS (SELECT c_custkey, max(CASE WHEN feature = 'acct.balance' THEN value::DOUBLE END) AS b, max(CASE WHEN feature = 'mkt.segment' THEN value END) AS seg, max(CASE WHEN feature = 'mkt.nation' THEN value END) AS nat FROM g GROUP BY 1),
r AS (SELECT c.c_custkey, b, nat, ts.w AS ws, tn.w AS wn, m, s FROM customer c CROSS JOIN a LEFT JOIN p ON p.c_custkey = c.c_custkey
  LEFT JOIN t ts ON ts.feature = 'mkt.segment' AND ts.value = seg LEFT JOIN t tn ON tn.feature = 'mkt.nation' AND tn.value = nat),
v AS (SELECT *, CASE WHEN b > 9000 THEN 'out_of_distribution:acct.balance' WHEN nat IS NULL THEN 'out_of_distribution:missing_unobserved:mkt.nation' WHEN wn IS NULL THEN 'out_of_distribution:mkt.nation' END AS violation FROM r)
SELECT c_custkey, CASE WHEN violation IS NULL THEN round(2.5 + CASE WHEN b IS NULL THEN 0.3 * (100 - m) / s + 0.2 * (1 - 0.25) / 0.5 ELSE 0.3 * (b - m) / s + 0.2 * (0 - 0.25) / 0.5 END + ws + wn, 6) END AS log_price, violation FROM v""")
def net_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, features = table(spark, sf_dir, "customer"), net_features(spark, sf_dir)
    balance = features.where("feature = 'acct.balance'").agg(F.avg(F.col("value").cast("double")).alias("mean"), F.stddev_pop(F.col("value").cast("double")).alias("scale"))
    number = balance.select(F.lit("n:acct.balance").alias("column"), F.lit(0.3).alias("coefficient"), "mean", "scale")
    absent = balance.select(F.lit("m:acct.balance").alias("column"), F.lit(0.2).alias("coefficient"), F.lit(0.25).alias("mean"), F.lit(0.5).alias("scale"))
    share = features.where("feature <> 'acct.balance' and value <> 'n3'").groupBy("feature", "value").agg((F.count(F.lit(1)) / rows.count()).alias("coefficient"))
    kinds = share.select(F.concat(F.lit("c:"), "feature", F.lit("="), "value").alias("column"), "coefficient", F.lit(0.0).alias("mean"), F.lit(1.0).alias("scale"))
    numeric = F.col("feature") == "acct.balance"
    about = features.select("feature").distinct().select("feature", numeric.alias("numeric"), F.when(numeric, 100.0).alias("median"), F.when(numeric, 0.0).alias("low"), F.when(numeric, 9000.0).alias("high"), numeric.alias("missing"))
    found = sparse_net.score(rows, features, "c_custkey", 2.5, number.unionByName(absent).unionByName(kinds), about)
    return found.select("c_custkey", F.round("log_price", 6).alias("log_price"), "violation")


TARGET = {"line": "CASE o_orderkey % 6 WHEN 0 THEN 'verified_sale' WHEN 1 THEN 'urgent_sale' ELSE 'normal_listing' END", "gate": "CASE WHEN o_custkey % 9 = 0 THEN 'currency_must_be_twd' END"}
GUESS = {
    "x1": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE ln(o_totalprice) END", "m1": "CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE 0.25 END", "x2": "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE ln(o_totalprice + 1000) END",
    "m2": "CAST(NULL AS DOUBLE)", "only2": "o_custkey % 2 = 0", "r1": "CASE WHEN o_orderkey % 8 = 0 THEN 'out_of_distribution:g.a' ELSE 'elastic_scaler_means_missing' END",
}


@query("model_estimates", "WITH t AS (SELECT o_orderkey, " + ", ".join(f"{v} AS {k}" for k, v in (TARGET | GUESS).items()) + """ FROM orders),
u AS (SELECT *, x1 IS NOT NULL AND m1 > 0 AS u1, x2 IS NOT NULL AND only2 AS u2, line IN ('normal_listing', 'urgent_sale') AS known FROM t),
w AS (SELECT *, (CASE WHEN u1 THEN 4.0 * x1 ELSE 0 END + CASE WHEN u2 THEN x2 ELSE 0 END) / nullif(CASE WHEN u1 THEN 4.0 ELSE 0 END + CASE WHEN u2 THEN 1.0 ELSE 0 END, 0) AS x,
  (CASE WHEN u1 THEN 1.0 ELSE 0 END + CASE WHEN u2 THEN 1.0 ELSE 0 END) / nullif(CASE WHEN u1 THEN 4.0 ELSE 0 END + CASE WHEN u2 THEN 1.0 ELSE 0 END, 0) AS m FROM u),
s AS (SELECT *, CASE WHEN NOT known OR gate IS NOT NULL THEN 'ineligible_input' WHEN u1 OR u2 THEN 'estimated' WHEN x1 IS NULL AND r1 LIKE 'out_of_distribution:%' THEN 'out_of_distribution' ELSE 'insufficient_training_data' END AS status FROM w)
SELECT o_orderkey, status, CASE WHEN status = 'estimated' THEN round(ln(exp(x)), 6) END AS log_point,
  CASE WHEN status = 'estimated' THEN CASE WHEN u1 AND NOT u2 THEN -500.0 ELSE round(-m, 6) END END AS reach,
  CASE WHEN NOT known THEN 'unsupported_price_line' WHEN gate IS NOT NULL THEN gate WHEN u1 OR u2 THEN '' ELSE array_to_string(list_concat(['no_verified_usable_model_artifact'], list_sort(list_distinct(list_filter(
    [CASE WHEN x1 IS NULL THEN r1 ELSE 'nonpositive_outer_cv_mae' END, CASE WHEN x2 IS NULL THEN 'elastic_prediction_contract_incomplete' ELSE 'nonpositive_outer_cv_mae' END], lambda r: r IS NOT NULL)))), ',') END AS reasons FROM s""")
def model_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reach: what the lower bound is below the point, in prices where one model has its own interval and in logs else."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", *[f"{v} AS {k}" for k, v in (TARGET | GUESS).items()])
    c = F.col
    first = F.struct(c("x1").alias("log_price"), c("m1").cast("double").alias("mae"), F.lit(False).alias("train_only"), F.array("r1").alias("reasons"), F.lit(-500.0).alias("residual_low"), F.lit(700.0).alias("residual_high"))
    second = F.struct(c("x2").alias("log_price"), c("m2").alias("mae"), c("only2").alias("train_only"), F.array(F.lit("elastic_prediction_contract_incomplete")).alias("reasons"), F.lit(None).cast("double").alias("residual_low"), F.lit(None).cast("double").alias("residual_high"))
    guesses = rows.select("o_orderkey", F.explode(F.array(first, second)).alias("g")).select("o_orderkey", "g.*")
    targets = rows.select("o_orderkey", c("line").alias("price_line"), F.array_compact(F.array("gate")).alias("gate_reasons"), "x1", "x2")
    found = modelling.model_estimates(targets, guesses, "o_orderkey")
    own = rows.select(c("o_orderkey").alias("k"), (c("x1").isNotNull() & (c("m1") > 0)).alias("u1"), (c("x2").isNotNull() & c("only2")).alias("u2"), "x1", "x2")
    both = found.join(own, c("o_orderkey") == c("k"))
    # prices have two places; the logs of the rounded ones are compared with the exact mean where that is sure
    weight = F.when(c("u1"), 4.0).otherwise(0.0) + F.when(c("u2"), 1.0).otherwise(0.0)
    exact = (F.when(c("u1"), 4.0 * c("x1")).otherwise(0.0) + F.when(c("u2"), c("x2")).otherwise(0.0)) / F.nullif(weight, F.lit(0.0))
    near = lambda a, b: F.when(F.abs(a - b) <= 0.0051, b)
    point = F.ln(near(c("point"), F.exp(exact)))
    spread = (F.when(c("u1"), 1.0).otherwise(0.0) + F.when(c("u2"), 1.0).otherwise(0.0)) / F.nullif(weight, F.lit(0.0))
    reach = F.when(c("u1") & ~c("u2"), F.when(F.abs(c("low") - c("point") + 500) <= 0.011, -500.0)).otherwise(F.when(F.abs(c("low") - F.exp(exact - spread)) <= 0.0051, F.round(-spread, 6)))
    estimated = c("status") == "estimated"
    return both.select("o_orderkey", "status", F.when(estimated, F.round(point, 6)).alias("log_point"), F.when(estimated, reach).alias("reach"), F.array_join("reasons", ",").alias("reasons"))
