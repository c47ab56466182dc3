"""Queries of listings: profiles made flat, text claims, recovery, near misses, observations, intake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.functions import claims, prices
from evidar.operators import market
from evidar.plans.registry import query
from evidar.sources.tables import table

#: Listings made of orders; the expressions mean the same in both dialects.
LISTING = {
    "listing_id": "o_orderkey", "account_id": "o_custkey", "post_date": "o_orderdate", "price_twd": "CAST(CASE WHEN o_orderkey % 31 = 0 THEN 0 ELSE floor(o_totalprice) END AS BIGINT)",
    "price_type": "CASE o_orderkey % 7 WHEN 0 THEN 'reduced' WHEN 1 THEN 'unknown' WHEN 2 THEN 'normal_listing' ELSE 'asking' END",
    "status": "CASE WHEN o_orderstatus = 'F' THEN 'sold' WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'active' END", "currency": "CASE WHEN o_orderkey % 23 = 0 THEN 'USD' ELSE 'TWD' END",
    "currency_verified": "o_orderkey % 19 <> 0", "server": "CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE 'international' END", "server_verified": "o_orderkey % 4 <> 0",
    "offer_kind": "CASE WHEN o_orderkey % 29 = 0 THEN 'mixed' ELSE 'seller_listing' END", "entity_kind": "CASE WHEN o_orderkey % 37 = 0 THEN 'bundle' ELSE 'single_account' END",
    "exclusion_reason": "CASE WHEN o_orderkey % 41 = 0 THEN 'manual' WHEN o_orderkey % 2 = 0 THEN ' ' END", "duplicate_cluster_id": "CASE WHEN o_orderkey % 43 = 0 THEN 'c1' END",
}
LISTING_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in LISTING.items()) + " FROM orders"
PASSES_SQL = """offer_kind = 'seller_listing' AND entity_kind = 'single_account' AND currency = 'TWD' AND currency_verified AND server = 'international' AND server_verified
  AND price_type IN ('asking', 'normal_listing') AND price_twd > 0 AND coalesce(status = 'active', false) AND trim(coalesce(exclusion_reason, '')) = '' AND duplicate_cluster_id IS NULL"""
FACTS_SQL = "sha256(json_object(" + ", ".join(f"'{c}', {c}" for c in sorted(market.FACTS)) + ")::VARCHAR)"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{v} AS {k}" for k, v in LISTING.items()])


def phrases(spark: SparkSession, sf_dir: str, texts: list[str | None]) -> DataFrame:
    """Orders with one of the texts each, by their key."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("o_orderkey") % len(texts) + 1).cast("int")).alias("said"))


def expected(texts: list, values: list, name: str) -> str:
    """SQL of the value that each order must have, by its key."""
    literal = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v + "'"
    return f"list_extract([{', '.join(map(literal, values))}], (o_orderkey % {len(texts)} + 1)::BIGINT) AS {name}"


URGENT = ["急售 100", "不急售", "不是急售", "非急出", "不 急售", "並非急出", "沒有急售", "不急售，急出", "急出", None, "出售", "並非 急售。急售"]
KINDS = ["asking", "sold_explicit", "buyout", "verified_sale", "Reduced ", "normal_listing", "sold_last_ask"]


@query("urgent_override", f"""
WITH t AS (SELECT o_orderkey, coalesce(list_extract([{', '.join('NULL' if t is None else "'" + t + "'" for t in URGENT)}], (o_orderkey % {len(URGENT)} + 1)::BIGINT), '') AS said,
  lower(trim(list_extract({KINDS}, (o_orderkey // {len(URGENT)} % {len(KINDS)} + 1)::BIGINT))) AS kind FROM orders),
u AS (SELECT *, regexp_matches(regexp_replace(said, '(?:不|非|不是|並非|并非)\\s*急(?:售|出)', '', 'g'), '急售|急出') AS urgent FROM t)
SELECT o_orderkey, CASE WHEN urgent AND kind IN ('asking', 'normal_listing', 'reduced', 'instant', 'instant_price', 'quick_sale', 'buyout') THEN 'urgent_sale'
  WHEN kind IN ('sold_explicit', 'sold_last_ask') THEN 'sold_claim' WHEN kind = 'asking' THEN 'normal_listing' ELSE kind END AS price_type FROM u""")
def urgent_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.floor(F.col("o_orderkey") / len(URGENT)) % len(KINDS) + 1).cast("int"))
    return phrases(spark, sf_dir, URGENT).select("o_orderkey", prices.urgent_override(kind, F.col("said")).alias("price_type"))


OFFERS = ["售／換：夢想", "換/售", "出 / 换", "急售", None, "即付不含勳章7.0萬、含勳章7.2萬，分期7.3至7.5萬", "標價 56000 台幣；最多分三期，超過一期加 500", "標價 56000 台幣，可分三期付款。", "18000 台幣含仲"]


@query("offer_terms", "SELECT o_orderkey, " + ", ".join([
    expected(OFFERS, [True, True, True, False, False, False, False, False, False], "sale_and_exchange"),
    expected(OFFERS, [None] * 5 + ["multiple_price_terms,badge_inclusion_price_variants,installment_price_variants", "multiple_price_terms,installment_price_variants", None, "brokerage_included_price"], "codes")]) + " FROM orders")
def offer_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.col("said")
    return phrases(spark, sf_dir, OFFERS).select("o_orderkey", prices.sale_and_exchange(said).alias("sale_and_exchange"), F.array_join(prices.price_semantic_review(said, F.lit("asking"))["reason_codes"], ",").alias("codes"))


HOLDERS = ["一手自創", "第三任", "第 2 手，一手價", "google為第一任持有，二手", "多手", None, "全圖畢", "幾乎全圖畢業", "二級斗全"]


@query("holder_and_map_claims", "SELECT o_orderkey, " + ", ".join([
    expected(HOLDERS, ["first_owner", "multiple_owners", "second_owner", "second_owner", "multiple_owners", "unknown", "unknown", "unknown", "unknown"], "holder"),
    expected(HOLDERS, ["unknown"] * 6 + ["complete", "partial", "unknown"], "maps"), expected(HOLDERS, ["unknown"] * 8 + ["complete"], "capes")]) + " FROM orders")
def holder_and_map_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.col("said")
    maps = claims.map_completion(said)
    return phrases(spark, sf_dir, HOLDERS).select("o_orderkey", claims.ownership_history(said).alias("holder"), maps["standard_maps"].alias("maps"), maps["second_tier_capes"].alias("capes"))


CANDLES = ["白蠟約 1831", "白蠟燭：12", "300白蜡", "約300白蠟", "白蠟 500以上", "白蠟+", None]


@query("resource_claims", "SELECT o_orderkey, " + ", ".join([expected(CANDLES, [1831, 12, 300, None, None, None, None], "value"), expected(CANDLES, ["approximate", "exact", "exact", None, None, None, None], "kind")]) + " FROM orders")
def resource_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = claims.resource_claim(F.col("said"), "white_candles")
    return phrases(spark, sf_dir, CANDLES).select("o_orderkey", found["value"].alias("value"), found["kind"].alias("kind"))


BINDINGS = ["GG、GC、NS 前號主不出", "Google、Apple ID、任天堂綁定不出，Google、PlayStation、Steam 可出", "FB", None, "GG 可出。GG 遺失"]


@query("binding_claims", "SELECT o_orderkey, " + ", ".join([
    expected(BINDINGS, ["high_risk", "high_risk", "unknown", "unknown", "high_risk"], "google"), expected(BINDINGS, ["high_risk", "unknown", "unknown", "unknown", "unknown"], "game_center"),
    expected(BINDINGS, ["unknown", "available", "unknown", "unknown", "unknown"], "steam"), expected(BINDINGS, ["unknown", "unknown", "mentioned_unknown", "unknown", "unknown"], "facebook")]) + " FROM orders")
def binding_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases(spark, sf_dir, BINDINGS).withColumn("found", claims.binding_matrix(F.col("said")))
    return found.select("o_orderkey", *[F.col("found")[p].alias(p) for p in ("google", "game_center", "steam", "facebook")])


@query("strict_recovery", f"SELECT listing_id FROM ({LISTING_SQL}) WHERE {PASSES_SQL} AND listing_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7)")
def strict_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = table(spark, sf_dir, "lineitem").where("l_linenumber = 7").select(F.col("l_orderkey").alias("listing_id"))
    return market.recoverable(listings(spark, sf_dir), used).select("listing_id")


@query("approval_replay", f"""
WITH l AS ({LISTING_SQL}), now AS (SELECT listing_id, {FACTS_SQL} AS h, {PASSES_SQL} AS passes FROM l),
d AS (SELECT listing_id, {FACTS_SQL} AS h, CASE WHEN listing_id % 13 = 0 THEN 'unclear' ELSE 'no_known_duplicate' END AS dd
      FROM (SELECT * REPLACE (CASE WHEN listing_id % 11 = 0 THEN price_twd + 1 ELSE price_twd END AS price_twd) FROM l) WHERE listing_id % 3 = 0)
SELECT d.listing_id, concat_ws(',', CASE WHEN NOT passes THEN 'predicates_not_met' END, CASE WHEN d.h <> now.h THEN 'facts_changed' END, CASE WHEN dd <> 'no_known_duplicate' THEN 'deduplication_not_reviewed' END) AS codes
FROM d JOIN now USING (listing_id)""")
def approval_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    changed = rows.where("listing_id % 3 = 0").withColumn("price_twd", F.when(F.col("listing_id") % 11 == 0, F.col("price_twd") + 1).otherwise(F.col("price_twd")))
    decisions = changed.select("listing_id", market.facts_digest().alias("facts_sha256"), F.when(F.col("listing_id") % 13 == 0, "unclear").otherwise("no_known_duplicate").alias("deduplication_result"))
    return market.replayed_approvals(rows, decisions).withColumn("codes", F.array_join("codes", ","))


@query("near_misses", f"""
WITH l AS ({LISTING_SQL}), b AS (SELECT *, list_filter([CASE WHEN server = 'unknown' OR NOT server_verified THEN 'international_server_evidence' END,
  CASE WHEN price_type = 'unknown' THEN 'normal_listing_price_type_evidence' END, CASE WHEN status IS NULL THEN 'active_listing_status_evidence' END], lambda x: x IS NOT NULL) AS gaps FROM l
  WHERE offer_kind = 'seller_listing' AND entity_kind = 'single_account' AND currency = 'TWD' AND currency_verified AND price_twd > 0 AND trim(coalesce(exclusion_reason, '')) = ''
  AND duplicate_cluster_id IS NULL AND price_type <> 'reduced' AND coalesce(status, 'active') = 'active')
SELECT listing_id, gaps[1] AS evidence_domain FROM b WHERE len(gaps) = 1""")
def near_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.near_misses(listings(spark, sf_dir)).select("listing_id", "evidence_domain")


@query("model_gates", f"""
SELECT listing_id, concat_ws(',', CASE WHEN currency <> 'TWD' THEN 'currency_must_be_twd' END, CASE WHEN server <> 'international' THEN 'server_must_be_international' END,
  CASE WHEN offer_kind <> 'seller_listing' THEN 'target_not_seller_listing' END, CASE WHEN entity_kind <> 'single_account' THEN 'target_not_single_account' END,
  CASE WHEN price_type <> 'normal_listing' THEN 'price_line_mismatch' END) AS market_codes,
  concat_ws(',', CASE WHEN listing_id % 3 = 0 THEN 'listing_evidence_insufficient' END, CASE WHEN listing_id % 5 = 1 THEN 'profile_requires_review' END) AS evidence_codes FROM ({LISTING_SQL})""")
def model_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir).withColumn("evidence_quality", F.when(F.col("listing_id") % 3 == 0, "low").otherwise("high")).withColumn("review_status", F.when(F.col("listing_id") % 5 == 1, "draft").when(F.col("listing_id") % 5 == 2, "approved"))
    of_market, of_evidence = market.model_gates(F.lit("normal_listing"))
    return rows.select("listing_id", F.array_join(of_market, ",").alias("market_codes"), F.array_join(of_evidence, ",").alias("evidence_codes"))


@query("valid_observations", f"""
WITH l AS (SELECT *, CASE WHEN listing_id % 6 = 0 THEN 'verified_sale' WHEN listing_id % 6 = 1 THEN 'auction' ELSE 'asking' END AS line FROM ({LISTING_SQL}))
SELECT listing_id, price_twd >= 1 AND currency = 'TWD' AND currency_verified AND server = 'international' AND server_verified AND offer_kind = 'seller_listing' AND entity_kind = 'single_account'
  AND line <> 'auction' AND (line <> 'verified_sale' OR listing_id % 4 = 2) AND listing_id % 8 <> 5 AS valid FROM l""")
def valid_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("listing_id")
    line = F.when(key % 6 == 0, "verified_sale").when(key % 6 == 1, "auction").otherwise("asking")
    rows = listings(spark, sf_dir).withColumns({
        "observation_id": F.concat(F.lit("observation_"), key), "source_snapshot_sha256": F.when(key % 8 == 5, "short").otherwise(F.sha2(key.cast("string"), 256)), "dedup_cluster_id": F.concat(F.lit("cluster_"), key),
        "date_verified": F.lit(True), "price_line": line, "completed_sale_verified": line == "verified_sale", "completed_sale_date": F.when(line == "verified_sale", F.col("post_date")),
        "completion_lineages": F.when(key % 4 == 2, F.array(F.lit("lineage_a"), F.lit("lineage_b"))).otherwise(F.array(F.lit("lineage_a"), F.lit("lineage_a")))})
    return rows.select("listing_id", market.valid_observation().alias("valid"))


@query("latest_price", f"""
SELECT c_custkey AS account_id, c_mktsegment, arg_max(price_twd, (post_date, listing_id)) AS price_twd FROM customer JOIN ({LISTING_SQL}) ON account_id = c_custkey GROUP BY 1, 2""")
def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"), "c_mktsegment")
    prices_of = listings(spark, sf_dir).select("account_id", "post_date", "listing_id", "price_twd")
    return market.latest_price(vectors, prices_of, "account_id", [F.desc("post_date"), F.desc("listing_id")]).select("account_id", "c_mktsegment", "price_twd")


@query("single_source_listing", f"""
WITH s AS (SELECT account_id, list(listing_id) AS ids FROM ({LISTING_SQL}) GROUP BY 1) SELECT s.account_id, listing_id, price_twd FROM s JOIN ({LISTING_SQL}) l ON l.listing_id = ids[1] WHERE len(ids) = 1""")
def single_source_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir)
    profiles = rows.groupBy("account_id").agg(F.collect_list("listing_id").alias("ids"))
    return market.by_single_source(profiles, "ids", rows.select("listing_id", "price_twd"), "listing_id").select("account_id", "listing_id", "price_twd")


@query("comparable_rows", f"SELECT l.listing_id, account_id, c_mktsegment AS segment, l.price_type, price_twd FROM ({LISTING_SQL}) l JOIN customer ON c_custkey = account_id")
def comparable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("segment"), F.lit("claimed").alias("price_type"))
    return market.comparable_rows(listings(spark, sf_dir).select("listing_id", "account_id", "price_type", "price_twd"), profiles)


@query("flat_profiles", f"""
SELECT listing_id, CASE WHEN listing_id % 2 = 0 THEN 'winged' ELSE 'wingless' END AS base_account_type, CASE WHEN listing_id % 3 = 0 THEN 'mixed' ELSE 'seller_listing' END AS offer_kind,
  CASE WHEN listing_id % 4 <> 0 THEN 'normal_listing' WHEN price_type = 'reduced' THEN 'urgent_sale' WHEN price_type = 'unknown' THEN 'unknown' ELSE 'normal_listing' END AS price_type,
  CASE WHEN listing_id % 5 = 0 THEN 's1' ELSE '' END AS complete_sets, 'r1,b1,e1' AS collection, CASE WHEN listing_id % 2 = 0 THEN 'google' ELSE '' END AS platforms FROM ({LISTING_SQL})""")
def flat_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, text = F.col("listing_id"), "string"
    strings = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    sets = F.array(F.struct(F.lit("s1").alias("set_id"), (key % 5 == 0).alias("is_complete"), F.lit("text_claim").alias("evidence_state")), F.struct(F.lit(None).cast(text).alias("set_id"), F.lit(True).alias("is_complete"), F.lit("unknown").alias("evidence_state")))
    platforms = F.array(F.struct(F.lit("google").alias("platform"), F.when(key % 2 == 0, "available").otherwise("unknown").alias("status")))
    profile = F.struct(
        F.struct(F.when(key % 2 == 0, "winged").cast(text).alias("account_type")).alias("base_account"), F.lit("wingless").alias("base_account_type"), F.struct(F.lit(None).cast(text).alias("earliest_season_id")).alias("season_summary"),
        F.struct(strings("i1").alias("owned_item_ids"), strings("r1").alias("graduation_rewards"), strings().alias("collaboration_items"), strings("b1", "r1").alias("bundle_item_ids"), strings("e1").alias("event_limited_item_ids"), sets.alias("item_set_profiles")).alias("collection"),
        F.struct(F.lit(0.5).alias("completion_ratio")).alias("map_completion"), F.struct(platforms.alias("platforms"), F.lit(None).cast(text).alias("risk_state")).alias("bindings"), F.lit(None).cast(text).alias("ownership_history"),
        F.struct(F.lit("asking").alias("price_type"), F.when(key % 3 == 0, "mixed").cast(text).alias("offer_kind"), F.lit(None).cast(text).alias("entity_kind")).alias("trade_conditions"),
        F.lit("seller_listing").alias("offer_kind"), F.lit("single_account").alias("entity_kind"), F.lit("reduced").alias("price_type"), F.struct(F.lit("high").alias("listing_text")).alias("evidence_quality"))
    history = F.struct(F.when(key % 4 == 0, key).alias("history_id"), F.col("price_type").alias("price_type"))
    rows = listings(spark, sf_dir).select("listing_id", profile.alias("profile"), history.alias("history"))
    flat = market.flat_profile()
    return rows.select("listing_id", flat["base_account_type"].alias("base_account_type"), flat["offer_kind"].alias("offer_kind"), flat["price_type"].alias("price_type"), F.array_join(flat["complete_set_ids"], ",").alias("complete_sets"),
                       F.array_join(flat["collection_ids"], ",").alias("collection"), F.array_join(F.map_keys(flat["bindings"]), ",").alias("platforms"))


@query("price_variants", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'urgent_sale,sold_explicit' ELSE 'asking,sold_explicit' END AS kinds FROM orders""")
def price_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = F.array(F.struct(F.lit("asking").alias("kind"), F.lit(1.0).alias("price")), F.struct(F.lit("sold_explicit").alias("kind"), F.lit(2.0).alias("price")))
    rows = phrases(spark, sf_dir, ["急售", "不急售"])
    return rows.select("o_orderkey", F.array_join(F.transform(market.consistent_variants(variants, F.col("said")), lambda v: v["kind"]), ",").alias("kinds"))


@query("intake_codes", """
WITH r AS (SELECT o_orderkey, o_custkey AS account, o_orderkey // 2 AS snapshot FROM orders)
SELECT o_orderkey, concat_ws(',', CASE WHEN count(*) OVER (PARTITION BY snapshot) > 1 THEN 'duplicate_snapshot' END, CASE WHEN count(*) OVER (PARTITION BY account) > 1 THEN 'duplicate_account' END) AS codes,
  'observation_' || substr(sha256(account || '|' || snapshot || '|' || o_orderkey), 1, 24) AS derived_id FROM r""")
def intake_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("account"), F.floor(F.col("o_orderkey") / 2).alias("snapshot"))
    found = market.intake_codes(rows, {"snapshot": "duplicate_snapshot", "account": "duplicate_account"}, ["account", "snapshot", "o_orderkey"])
    return found.select("o_orderkey", F.array_join("codes", ",").alias("codes"), "derived_id")
