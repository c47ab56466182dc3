"""Queries of evidence about items: states, images, names, grades, costs, coverage, replay, independence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.operators import evidence
from evidar.plans.registry import query
from evidar.sources.tables import table

#: Item states made of order lines; the expressions mean the same in both dialects.
STATE = {
    "account_id": "l_orderkey", "item_id": "CASE WHEN l_linenumber = 5 THEN -l_partkey ELSE l_partkey % 40 END", "state": "CASE l_suppkey % 3 WHEN 0 THEN 'owned' WHEN 1 THEN 'confirmed_missing' ELSE 'unknown' END",
    "review_status": "CASE WHEN l_linenumber % 3 = 0 THEN 'draft' ELSE 'approved' END", "evidence_state": "CASE WHEN l_partkey % 7 = 0 THEN 'image' ELSE 'text_claim' END", "conflict": "l_partkey % 11 = 0", "model_feature": "l_linenumber < 4",
}
STATE_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in STATE.items()) + " FROM lineitem"


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{v} AS {k}" for k, v in STATE.items()])


@query("gated_item_states", f"""
WITH s AS ({STATE_SQL}), c AS (SELECT DISTINCT p_partkey % 40 AS item_id, p_partkey % 40 % 4 <> 1 AS eligible FROM part),
j AS (SELECT s.*, eligible, count(*) OVER (PARTITION BY account_id, s.item_id) AS times,
  state IN ('owned', 'confirmed_missing') AND review_status = 'approved' AND evidence_state = 'text_claim' AND NOT conflict AS sound FROM s LEFT JOIN c ON s.item_id = c.item_id)
SELECT account_id, item_id, state, review_status, evidence_state, conflict, coalesce(model_feature AND eligible AND sound, false) AS model_feature,
  concat_ws(',', CASE WHEN times > 1 THEN 'duplicate_item_state' END, CASE WHEN eligible IS NULL THEN 'unknown_canonical_item' END,
    CASE WHEN model_feature AND NOT eligible THEN 'catalog_item_not_model_eligible' END, CASE WHEN eligible IS NOT NULL AND model_feature AND NOT sound THEN 'item_evidence_not_approved' END) AS codes FROM j""")
def gated_item_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = table(spark, sf_dir, "part").selectExpr("p_partkey % 40 AS item_id", "true AS verified", "p_partkey % 40 % 4 <> 1 AS eligible").distinct()
    return evidence.gated_states(states(spark, sf_dir), catalog, "account_id", "item_id").withColumn("codes", F.array_join("codes", ","))


@query("image_evidence", """
WITH e AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 9 = 0 THEN 'selfie' ELSE 'wardrobe' END AS image_role, CASE WHEN l_linenumber = 2 THEN 'ocr_text' ELSE 'manual' END AS method,
  l_discount * 12 AS confidence, CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN 'part_1' ELSE 'item_1' END AS item, l_tax * 10 AS x, l_discount * 10 AS width FROM lineitem)
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN image_role = 'selfie' THEN 'invalid:image_role' END, CASE WHEN confidence NOT BETWEEN 0 AND 1 THEN 'invalid:confidence' END,
  CASE WHEN item = 'part_1' THEN 'invalid:detected_item_id' END, CASE WHEN x + width > 1 THEN 'invalid:bounding_box_bounds' END,
  CASE WHEN method = 'ocr_text' AND item IS NOT NULL THEN 'invalid:ocr_text_cannot_claim_item' END) AS codes FROM e""")
def image_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_partkey % 9 = 0 THEN 'selfie' ELSE 'wardrobe' END AS image_role", "CASE WHEN l_linenumber = 2 THEN 'ocr_text' ELSE 'manual' END AS recognition_method",
        "l_discount * 12 AS confidence", "CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN 'part_1' ELSE 'item_1' END AS detected_item_id", "sha2('x', 256) AS image_sha256",
        "named_struct('x', l_tax * 10, 'y', l_tax * 0, 'width', l_discount * 10, 'height', l_tax * 0) AS bounding_box", "'partial' AS wardrobe_coverage")
    return rows.select("l_orderkey", "l_linenumber", F.array_join(evidence.image_codes(), ",").alias("codes"))


@query("name_decisions", """
WITH e AS (SELECT l_partkey AS p_partkey, CASE WHEN l_linenumber % 2 = 0 THEN p_name WHEN l_linenumber = 3 THEN 'other' ELSE upper(p_name) || '!' END AS claim, l_linenumber % 2 = 0 AS official, l_suppkey % 3 AS lineage, p_name
           FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <> 6),
m AS (SELECT p_partkey, official AND claim = p_name AS o, NOT official AND regexp_replace(lower(claim), '[^a-z0-9]', '', 'g') = regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS s, lineage FROM e),
g AS (SELECT p_partkey, count(*) FILTER (o) AS no, count(*) FILTER (s) AS ns, count(DISTINCT lineage) FILTER (o OR s) AS nl FROM m GROUP BY 1)
SELECT p.p_partkey, concat_ws(',', CASE WHEN p_size < 5 THEN 'catalog_item_not_verified' END, CASE WHEN coalesce(no, 0) = 0 THEN 'official_exact_canonical_english_evidence_missing' END,
  CASE WHEN coalesce(ns, 0) = 0 THEN 'secondary_exact_canonical_english_evidence_missing' END, CASE WHEN coalesce(nl, 0) < 2 THEN 'independent_source_lineages_missing' END) AS codes,
  CASE WHEN p_size >= 5 AND no > 0 AND ns > 0 AND nl >= 2 THEN 'eligible' ELSE 'excluded_pending_verification' END AS decision FROM part p LEFT JOIN g ON p.p_partkey = g.p_partkey""")
def name_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber <> 6").join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    number = F.col("l_linenumber")
    claims = lines.select("p_partkey", F.when(number % 2 == 0, F.col("p_name")).when(number == 3, "other").otherwise(F.concat(F.upper("p_name"), F.lit("!"))).alias("claim"),
                          F.when(number % 2 == 0, evidence.OFFICIAL).otherwise(evidence.SECONDARY).alias("tier"), (F.col("l_suppkey") % 3).alias("lineage"), F.lit(True).alias("approved"))
    found = evidence.name_decisions(part.select("p_partkey", "p_name", (F.col("p_size") >= 5).alias("verified")), claims, "p_partkey", "p_name", F.regexp_replace(F.lower("claim"), "[^a-z0-9]", ""))
    return found.withColumn("codes", F.array_join("codes", ","))


@query("regraded_records", """
WITH b AS (SELECT DISTINCT l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey < 3)
SELECT p_partkey, CASE WHEN p_size > 10 AND l_partkey IS NULL THEN 'needs_review' WHEN p_size > 10 THEN 'verified' ELSE 'draft' END AS verification_status, p_size > 10 AND l_partkey IS NULL AS regraded FROM part LEFT JOIN b ON l_partkey = p_partkey""")
def regraded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 10, "verified").otherwise("draft").alias("verification_status"))
    links = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    return evidence.regraded(records, links, table(spark, sf_dir, "supplier"), "p_partkey", "s_suppkey", F.col("s_nationkey") < 3)


@query("item_or_set", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) THEN 'item' WHEN l_partkey IN (SELECT s_suppkey FROM supplier) THEN 'set' END AS target_kind FROM lineitem""")
def item_or_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("target_id"))
    items, sets = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("item_id")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("set_id"))
    return evidence.item_or_set(rows, items, sets).drop("target_id")


@query("cost_references", """
WITH c AS (SELECT l_partkey, CASE WHEN l_linenumber <= 2 THEN 'item' ELSE 'bundle' END AS scope, l_suppkey % 4 AS amount, l_returnflag <> 'R' AS approved FROM lineitem),
g AS (SELECT l_partkey, list(DISTINCT amount) FILTER (approved AND scope = 'item') AS own, list(DISTINCT amount) FILTER (approved AND scope = 'bundle') AS bundle FROM c GROUP BY 1)
SELECT l_partkey, CASE WHEN len(own) = 1 THEN 'item' WHEN coalesce(len(own), 0) = 0 AND len(bundle) = 1 THEN 'bundle' ELSE 'unknown' END AS reference_kind,
  CASE WHEN len(own) = 1 THEN own[1] WHEN coalesce(len(own), 0) = 0 AND len(bundle) = 1 THEN bundle[1] END AS amount FROM g""")
def cost_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "lineitem").select("l_partkey", F.when(F.col("l_linenumber") <= 2, "item").otherwise("bundle").alias("scope"), (F.col("l_suppkey") % 4).alias("amount"), (F.col("l_returnflag") != "R").alias("approved"))
    return evidence.cost_references(claims, "l_partkey")


@query("item_coverage", """
SELECT p_partkey, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS lines, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R') AS returned,
  (SELECT count(*) FROM supplier WHERE s_suppkey = p_partkey AND s_acctbal > 0) AS suppliers FROM part""")
def item_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_returnflag")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p_partkey"), "s_acctbal")
    parts = {"lines": (lines, F.lit(True)), "returned": (lines, F.col("l_returnflag") == "R"), "suppliers": (suppliers, F.col("s_acctbal") > 0)}
    return evidence.coverage(table(spark, sf_dir, "part").select("p_partkey"), parts, "p_partkey")


@query("coverage_scopes", """
SELECT scope, count(*) FILTER (k AND p_size > 20) AS large, count(*) FILTER (k AND p_retailprice > 1000) AS dear
FROM (SELECT 'all' AS scope, true AS k, * FROM part UNION ALL SELECT 'verified', p_size > 10, * FROM part UNION ALL SELECT 'eligible', p_size > 10 AND p_partkey % 2 = 0, * FROM part) GROUP BY 1""")
def coverage_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    verified = F.col("p_size") > 10
    return evidence.scopes(table(spark, sf_dir, "part"), {"all": F.lit(True), "verified": verified, "eligible": verified & (F.col("p_partkey") % 2 == 0)}, {"large": F.col("p_size") > 20, "dear": F.col("p_retailprice") > 1000})


@query("top_interactions", """
WITH p AS (SELECT l_orderkey, 'f' || l_linenumber AS left_feature, 'g' || l_suppkey % 5 AS right_feature, l_linenumber * (l_suppkey % 7 - 3) AS value FROM lineitem)
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY abs(value) DESC, value DESC, left_feature, right_feature) AS place FROM p WHERE value <> 0 QUALIFY place <= 2""")
def top_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "'f' || l_linenumber AS left_feature", "'g' || l_suppkey % 5 AS right_feature", "l_linenumber * (l_suppkey % 7 - 3) AS value")
    return evidence.top_interactions(pairs, "l_orderkey", "value", 2)


@query("features_without_identities", """
WITH f AS (SELECT l_orderkey, CASE l_linenumber % 4 WHEN 0 THEN 'items.' || l_partkey % 20 WHEN 1 THEN 'resources.hearts' WHEN 2 THEN 'collection.ids' ELSE 'sets.count' END AS feature, l_quantity AS value FROM lineitem)
SELECT * FROM f WHERE feature IN ('resources.hearts', 'sets.count') OR (feature LIKE 'items.%' AND substr(feature, 7)::INT % 2 = 0)""")
def features_without_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "CASE l_linenumber % 4 WHEN 0 THEN 'items.' || l_partkey % 20 WHEN 1 THEN 'resources.hearts' WHEN 2 THEN 'collection.ids' ELSE 'sets.count' END AS feature", "l_quantity AS value")
    kept = spark.range(0, 20, 2).select(F.col("id").cast("string").alias("item_id"))
    return evidence.without_identities(rows, ("resources",), ("sets.count",), kept)


@query("rule_replay", """
WITH s AS (SELECT p_partkey AS source_key, 's' || p_partkey AS source_id, p_name, p_brand FROM part WHERE p_partkey % 10 <> 0),
r AS (SELECT DISTINCT l_partkey AS target_id, CASE WHEN l_suppkey % 2 = 0 THEN 'name' ELSE 'none' END AS locator, l_partkey AS source_key FROM lineitem),
j AS (SELECT r.*, source_id, CASE locator WHEN 'name' THEN p_name END AS claim_value FROM r LEFT JOIN s USING (source_key))
SELECT target_id, locator, source_id, claim_value, sha256(claim_value) AS claim_sha256,
  concat_ws(',', CASE WHEN source_id IS NULL THEN 'source_missing' END, CASE WHEN source_id IS NOT NULL AND target_id % 9 = 0 THEN 'source_item_id_differs' END, CASE WHEN source_id IS NOT NULL AND claim_value IS NULL THEN 'locator_selects_nothing' END) AS codes FROM j""")
def rule_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where("p_partkey % 10 <> 0")
    sources = part.select(F.col("p_partkey").alias("source_key"), F.concat(F.lit("s"), "p_partkey").alias("source_id"), F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))).alias("body"))
    rules = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("target_id"), F.lit("canonical_name_en").alias("field_path"), F.col("l_partkey").alias("source_key"),
                                                    F.when(F.col("l_suppkey") % 2 == 0, "name").otherwise("none").alias("locator")).distinct()
    rules = rules.withColumn("expected_id", F.when(F.col("target_id") % 9 == 0, -1).otherwise(F.col("target_id")).cast("string"))
    claim = F.when(F.col("locator") == "name", F.get_json_object("body", "$.name")).otherwise(F.get_json_object("body", "$.none"))
    found = evidence.replayed_rules(rules, sources, F.get_json_object("body", "$.id"), claim)
    return found.select("target_id", "locator", "source_id", "claim_value", "claim_sha256", F.array_join("codes", ",").alias("codes"))


@query("review_independence", """
WITH g AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_suppkey % 3) AS reviewers, max(l_shipdate) AS last FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1)
SELECT l_orderkey, concat_ws(',', CASE WHEN n <> 2 THEN 'two_decisions_required' END, CASE WHEN reviewers < 2 THEN 'reviewers_not_independent' END,
  CASE WHEN o_orderkey IS NOT NULL AND NOT last < o_orderdate + INTERVAL 60 DAY THEN 'decision_not_before_adjudication' END) AS codes FROM g LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 2 = 0) ON o_orderkey = l_orderkey""")
def review_independence(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2").select("l_orderkey", (F.col("l_suppkey") % 3).alias("reviewer"), F.col("l_shipdate").cast("timestamp").alias("decided_at"))
    rulings = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS l_orderkey", "CAST(o_orderdate AS timestamp) + INTERVAL 60 DAY AS adjudicated_at")
    return evidence.independence(decisions, rulings, "l_orderkey").withColumn("codes", F.array_join("codes", ","))


@query("item_vectors", f"""
SELECT account_id, string_agg(item_id || ':' || state, ',' ORDER BY item_id, state) AS items, count(*) FILTER (state = 'owned') AS owned, count(*) FILTER (state = 'confirmed_missing') AS missing,
  count(*) FILTER (state = 'unknown') AS unknown FROM ({STATE_SQL}) GROUP BY 1""")
def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evidence.vectors(states(spark, sf_dir), "account_id")
    return found.withColumn("items", F.array_join(F.transform("items", lambda x: F.concat(x["item_id"].cast("string"), F.lit(":"), x["state"])), ","))
