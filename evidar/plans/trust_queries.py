"""Queries of review, trust and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.operators import audit, modelling, provenance
from evidar.plans.audit_queries import CLOSURE_SQL, fk_closure_audit
from evidar.plans.model_queries import FEATURE_SQL, customer_features
from evidar.plans.registry import query
from evidar.sources.tables import table


@query("completion_rollup", f"""
WITH c AS (SELECT edge AS check_id, dangling = 0 AS passed FROM ({CLOSURE_SQL}))
SELECT count(*) AS checks, count(*) FILTER (passed) AS passed, bool_and(passed) AS complete, coalesce(string_agg(check_id, ',' ORDER BY check_id) FILTER (NOT passed), '') AS failed FROM c""")
def completion_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = fk_closure_audit(spark, sf_dir).select(F.col("edge").alias("check_id"), (F.col("dangling") == 0).alias("passed"))
    return audit.completion(checks).withColumn("failed", F.array_join("failed", ","))


@query("top_drivers", """
WITH c AS (SELECT c_custkey, unnest(['balance', 'key', 'nation']) AS feature, unnest([c_acctbal / 1000, (c_custkey % 7) - 3.0, c_nationkey - 12.0]) AS contribution FROM customer)
SELECT c_custkey, feature, round(contribution, 6) AS contribution, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(contribution) DESC, feature) AS place FROM c QUALIFY place <= 2""")
def top_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    parts = {"balance": c("c_acctbal") / 1000, "key": (c("c_custkey") % 7) - F.lit(3.0), "nation": c("c_nationkey") - F.lit(12.0)}
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("contribution")) for k, v in parts.items()])).alias("p")).select("c_custkey", "p.*")
    return modelling.top_drivers(rows, "c_custkey", 2).withColumn("contribution", F.round("contribution", 6))


@query("domain_admission", FEATURE_SQL + """,
d AS (SELECT unnest(['balance', 'nation', 'segment']) AS feature, unnest([1, 2, 3]) AS ordinal),
j AS (SELECT i.c_custkey, d.feature, ordinal, value FROM (SELECT DISTINCT c_custkey FROM f WHERE value IS NOT NULL) i CROSS JOIN d LEFT JOIN (SELECT * FROM f WHERE value IS NOT NULL) f ON f.c_custkey = i.c_custkey AND f.feature = d.feature),
v AS (SELECT c_custkey, ordinal, CASE WHEN value IS NULL THEN 'missing_unobserved' WHEN feature = 'balance' AND NOT value::DOUBLE BETWEEN 100 AND 9000 THEN 'numeric_out_of_range'
  WHEN feature = 'nation' AND NOT value::DOUBLE BETWEEN 0 AND 20 THEN 'numeric_out_of_range' WHEN feature = 'segment' AND value NOT IN ('BUILDING', 'MACHINERY') THEN 'category_unseen' END || ':' || feature AS code FROM j)
SELECT c_custkey, arg_min(code, ordinal) FILTER (code IS NOT NULL) AS violation FROM v GROUP BY 1""")
def domain_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = spark.createDataFrame(
        [("balance", 1, 100.0, 9000.0, None, False), ("nation", 2, 0.0, 20.0, None, False), ("segment", 3, None, None, ["BUILDING", "MACHINERY"], False)],
        "feature string, ordinal int, low double, high double, categories array<string>, observed_missing boolean")
    return modelling.out_of_domain(customer_features(spark, sf_dir), domain, "c_custkey")


@query("prune_cascade", """
WITH kept AS (SELECT p_partkey FROM part WHERE p_size > 1), broken AS (SELECT DISTINCT p_brand || p_type AS set_id FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM kept))
SELECT p_brand || p_type AS set_id, count(*) AS members FROM part WHERE p_brand || p_type NOT IN (SELECT set_id FROM broken) GROUP BY 1""")
def prune_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    items = part.select(F.col("p_partkey").alias("item_id"), "p_size")
    sets = part.select(F.concat("p_brand", "p_type").alias("set_id"), F.col("p_partkey").alias("item_id"))
    left = audit.prune(items, F.col("p_size") > 1, part.select(F.col("p_partkey").alias("item_id"), "p_name"), sets)["sets"]
    return left.groupBy("set_id").agg(F.count(F.lit(1)).alias("members"))


@query("receipt_gate", """
WITH g AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS i, count(DISTINCT year(o_orderdate)) AS g, count(DISTINCT o_orderstatus) AS c FROM orders GROUP BY 1)
SELECT o_custkey, i >= 2 AND g >= 2 AND c >= 2 AS passed, concat_ws(',', CASE WHEN i < 2 THEN 'issuers_below_two' END, CASE WHEN g < 2 THEN 'groups_below_two' END, CASE WHEN c < 2 THEN 'evidence_class_missing' END) AS codes FROM g""")
def receipt_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderpriority").alias("issuer"), F.year("o_orderdate").alias("group"), F.col("o_orderstatus").alias("evidence_class"))
    return provenance.receipt_gate(receipts, "o_custkey").withColumn("codes", F.array_join("codes", ","))


@query("adjudicated_labels", """
WITH p AS (SELECT doc_id, quality AS a, CASE WHEN n_chars >= 400 THEN 1 ELSE 0 END AS b FROM labels JOIN documents USING (doc_id)), j AS (SELECT doc_id, toxic AS ruling FROM labels WHERE doc_id % 2 = 0)
SELECT coalesce(p.doc_id, j.doc_id) AS doc_id, CASE WHEN a <> b THEN ruling ELSE a END AS label,
  concat_ws(',', CASE WHEN coalesce(a <> b, false) AND ruling IS NULL THEN 'adjudication_missing' END, CASE WHEN ruling IS NOT NULL AND NOT coalesce(a <> b, false) THEN 'adjudication_unexpected' END) AS codes
FROM p FULL JOIN j ON p.doc_id = j.doc_id""")
def adjudicated_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    b = docs.join(labels, "doc_id", "left_semi").select("doc_id", F.when(F.col("n_chars") >= 400, 1).otherwise(0).alias("label"), F.lit("B").alias("role"))
    decisions = labels.select("doc_id", F.col("quality").alias("label"), F.lit("A").alias("role")).unionByName(b)
    rulings = labels.where("doc_id % 2 = 0").select("doc_id", F.col("toxic").alias("label"))
    return provenance.adjudicated(provenance.pair_reviews(decisions, "doc_id", "label", F.col("role")), rulings, "doc_id", "label").withColumn("codes", F.array_join("codes", ","))


@query("authorized_rows", """
SELECT o.o_orderkey, a.o_orderkey IS NOT NULL AS authorized FROM orders o LEFT JOIN (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_orderstatus = 'F') a
ON o.o_orderkey = a.o_orderkey AND o.o_custkey = a.o_custkey AND o.o_totalprice IS NOT DISTINCT FROM a.p""")
def authorized_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    allowed = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", changed)
    return provenance.authorize(orders, allowed, ("o_orderkey", "o_custkey"), ("o_totalprice",)).select("o_orderkey", "authorized")
