"""Queries that run whole operators: market cleaning with all gates, subgroup codes, greedy folds, exact equality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.functions import digests
from evidar.operators import cleaning, publication, splits
from evidar.plans.registry import query
from evidar.sources.tables import table

# Observations made of orders; the expressions mean the same in both dialects.
SEEN = {
    "history_id": "lpad(CAST(o_orderkey AS VARCHAR(20)), 12, '0')", "account_id": "o_custkey % 400", "post_date": "o_orderdate", "price_type": "CASE o_orderkey % 7 WHEN 0 THEN 'reduced' WHEN 1 THEN 'unknown' WHEN 2 THEN ' Asking ' WHEN 3 THEN 'verified_sale' ELSE 'asking' END",
    "account_type": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END",
    "selected_price_twd": "CAST(CASE WHEN o_orderkey % 53 = 0 THEN 0 WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN o_totalprice * 100000 ELSE o_totalprice END AS DOUBLE)",
    "currency": "CASE WHEN o_orderkey % 23 = 0 THEN 'USD' WHEN o_orderkey % 67 = 0 THEN NULL ELSE 'TWD' END", "currency_verified": "CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE o_orderkey % 19 <> 0 END",
    "server": "CASE WHEN o_orderkey % 25 = 0 THEN 'unknown' ELSE 'international' END", "server_verified": "o_orderkey % 21 <> 0", "offer_kind": "CASE WHEN o_orderkey % 29 = 0 THEN 'mixed' ELSE 'seller_listing' END",
    "entity_kind": "CASE WHEN o_orderkey % 37 = 0 THEN 'bundle' ELSE 'single_account' END", "mixed_price": "CASE WHEN o_orderkey % 31 = 0 THEN true WHEN o_orderkey % 2 = 0 THEN false END",
    "brokerage": "o_orderkey % 41 = 0", "several": "o_orderkey % 43 = 0", "allowed": "o_orderkey % 11 <> 0",
}
SEEN_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in SEEN.items()) + " FROM orders"
GATES_SQL = [
    ("market_data_external_authorization_evaluator_required", "NOT allowed"), ("invalid_price", "coalesce(selected_price_twd <= 0, true)"), ("currency_not_twd", "currency IS DISTINCT FROM 'TWD'"),
    ("currency_unverified", "currency_verified IS DISTINCT FROM true"), ("server_not_international", "server <> 'international'"), ("server_unverified", "NOT server_verified"), ("not_seller_listing", "offer_kind <> 'seller_listing'"),
    ("not_single_account", "entity_kind <> 'single_account'"), ("mixed_price", "coalesce(mixed_price, false)"), ("brokerage_included_price", "brokerage"), ("multiple_price_terms", "several"),
    ("price_type_not_training_line", "line = 'unknown'"), ("verified_sale_requires_separate_pool", "line = 'verified_sale'")]


@query("market_cleaning", f"""
WITH o AS (SELECT *, CASE lower(trim(price_type)) WHEN 'reduced' THEN 'urgent_sale' WHEN 'asking' THEN 'normal_listing' WHEN 'verified_sale' THEN 'verified_sale' ELSE 'unknown' END AS line, coalesce(account_type, 'unknown') AS kind FROM ({SEEN_SQL})),
g AS (SELECT *, list_filter([{', '.join(f"CASE WHEN {c} THEN '{k}' END" for k, c in GATES_SQL)}], lambda x: x IS NOT NULL) AS failed FROM o),
r AS (SELECT *, CASE WHEN len(failed) = 0 THEN row_number() OVER (PARTITION BY len(failed) = 0, account_id, line ORDER BY post_date DESC, history_id DESC) END AS place FROM g),
c AS (SELECT line, kind, median(ln(selected_price_twd)) AS m, count(*) AS n FROM r WHERE place = 1 GROUP BY ALL),
d AS (SELECT r.*, c.n, c.m, ln(selected_price_twd) - m AS off FROM r LEFT JOIN c ON r.place = 1 AND c.line = r.line AND c.kind = r.kind),
s AS (SELECT line, kind, median(abs(off)) AS mad FROM d WHERE place = 1 GROUP BY ALL),
z AS (SELECT d.*, CASE WHEN place = 1 AND mad <> 0 THEN abs(0.6745 * off / mad) > 3.5 ELSE false END AS far FROM d LEFT JOIN s ON d.place = 1 AND s.line = d.line AND s.kind = d.kind)
SELECT history_id, line AS price_line, CASE WHEN brokerage OR several THEN 'needs_review' WHEN len(failed) > 0 OR place > 1 THEN 'excluded' WHEN far AND n >= 10 THEN 'excluded' WHEN far THEN 'needs_review' ELSE 'kept' END AS disposition,
  CASE WHEN len(failed) > 0 THEN array_to_string(list_sort(failed), ',') WHEN place > 1 THEN 'cluster_rank_' || place || ',duplicate_account_cluster' WHEN far AND n >= 10 THEN 'log_price_modified_z_outlier' WHEN far THEN 'log_price_outlier_insufficient_group' ELSE '' END AS codes FROM z""")
def market_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(*[f"{v} AS {k}" for k, v in SEEN.items()])
    rows = rows.withColumns({
        "observed_at": F.col("post_date"), "base_account": F.struct("account_type"),
        "price_semantic_review": F.when(F.col("brokerage") | F.col("several"), F.struct(F.col("brokerage").alias("brokerage_included"), F.col("several").alias("multi_price")))})
    found = cleaning.clean_market(rows, F.col("allowed"))
    return found.select("history_id", "price_line", "disposition", F.array_join(F.array_sort("reason_codes"), ",").alias("codes"))


@query("subgroup_reason_codes", """
WITH j AS (SELECT c_nationkey, o_custkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey), c AS (SELECT c_nationkey, o_custkey, avg(abs(o_totalprice - 150000) / o_totalprice) AS ape FROM j GROUP BY ALL),
m AS (SELECT c_nationkey, count(*) AS n, median(ape) AS md FROM c GROUP BY 1)
SELECT c_nationkey, n AS clusters, round(md, 9) AS mdape, array_to_string(list_filter([CASE WHEN n < 30 THEN 'subgroup_under_30' END, CASE WHEN md > 0.25 THEN 'subgroup_mdape_above_25_percent' END], lambda x: x IS NOT NULL), ',') AS codes FROM m""")
def subgroup_reason_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    same = [F.lit(150000.0).alias(n) for n in ("predicted", "baseline", "selected")]
    rows = rows.select("c_nationkey", "o_custkey", F.col("o_totalprice").alias("actual"), *same, F.lit(-1.0).alias("low"), F.lit(1.0).alias("high"))
    found = publication.subgroup_gates(publication.cluster_metrics(rows, ["c_nationkey"], "o_custkey"), "c_nationkey")
    return found.select("c_nationkey", "clusters", F.round("mdape", 9).alias("mdape"), F.array_join("reason_codes", ",").alias("codes"))


@query("greedy_fold_sizes", """
WITH RECURSIVE g AS (SELECT row_number() OVER (ORDER BY n DESC, o_custkey) AS i, n FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)),
r AS (SELECT 0::BIGINT AS i, [0, 0, 0, 0, 0]::BIGINT[] AS loads UNION ALL SELECT g.i, list_transform(r.loads, lambda x, k: CASE WHEN k = list_position(r.loads, list_min(r.loads)) THEN x + g.n ELSE x END) FROM r JOIN g ON g.i = r.i + 1)
SELECT unnest(range(5))::INT AS fold, unnest(loads) AS rows FROM r WHERE i = (SELECT max(i) FROM r)""")
def greedy_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.greedy_folds(table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey", 5).groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


FORM = "CASE {0} % 4 WHEN 0 THEN CAST({1} AS VARCHAR(9)) WHEN 1 THEN concat(CAST({1} AS VARCHAR(9)), '.5') WHEN 2 THEN concat('\"', CAST({1} AS VARCHAR(9)), '\"') ELSE concat('{{\"a\":', CAST({1} AS VARCHAR(9)), ',\"b\":[true]}}') END"


@query("exact_equality", "SELECT o_orderkey, (o_orderkey % 4 = o_custkey % 4) AND (o_orderkey % 5 = o_custkey % 5) AS equal, o_orderkey % 5 = o_custkey % 5 AND o_orderkey % 4 = 3 AS turned FROM orders")
def exact_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents compared in value and type; turned: with the members in another order."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", f"{FORM.format('o_orderkey', 'o_orderkey % 5')} AS a", f"{FORM.format('o_custkey', 'o_custkey % 5')} AS b")
    turned = F.concat(F.lit('{"b":[true],"a":'), (F.col("o_custkey") % 5).cast("string"), F.lit("}"))
    equal = lambda x: digests.exactly_equal(F.parse_json("a"), F.parse_json(x))
    return rows.withColumn("c", turned).select("o_orderkey", equal(F.col("b")).alias("equal"), equal(F.col("c")).alias("turned"))
