"""Queries of text functions, similarities, states and trust operators, each beside SQL or the values that the rules give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.functions import digests, similarity, text
from evidar.operators import matching, provenance, publication, seasons
from evidar.plans.market_queries import LISTING_SQL, expected, listings, phrases
from evidar.plans.registry import query
from evidar.sources import stages
from evidar.sources.sinks import json_lines, write_jsonl
from evidar.sources.readers import read_jsonl
from evidar.sources.tables import table

ALIASES = {"表演": "performance", "破曉": "shattering", "極光": "aurora", "狂歡": "carnival", "預言": "prophecy", "破碎": "broken"}
ORDER = {"prophecy": 0, "performance": 1, "shattering": 2, "aurora": 3, "carnival": 4, "broken": 9}
SEASONS = {
    "表演～狂歡無斷，缺破曉；預言季卡": "aurora:owned_not_complete:unknown,carnival:owned_not_complete:unknown,performance:owned_not_complete:unknown,prophecy:owned_not_complete:yes,shattering:confirmed_missing:yes",
    "表演～狂歡": "aurora:unknown:unknown,carnival:owned_not_complete:unknown,performance:owned_not_complete:unknown,shattering:unknown:unknown",
    "狂歡畢業，極光有卡未畢": "aurora:owned_not_complete:yes,carnival:complete:yes", "表演與極光半畢業": "aurora:partial:unknown,performance:partial:unknown",
    "預言～表演全畢": "performance:complete:unknown,prophecy:complete:unknown", "破碎的翅膀": "", "破碎半畢業": "broken:partial:unknown", "凜冬畢業": "",
}


@query("season_claims", f"SELECT o_orderkey, {expected(list(SEASONS), list(SEASONS.values()), 'claims')} FROM orders")
def season_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrases(spark, sf_dir, list(SEASONS))
    found = seasons.season_claims(rows, "o_orderkey", "said", ALIASES, ORDER)
    one = found.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "season_id", "status", "pass_owned"))), ",").alias("claims"))
    return rows.join(one, F.col("o_orderkey") == F.col("id"), "left").select("o_orderkey", F.coalesce("claims", F.lit("")).alias("claims"))


WORDS = ["Ｆｕｌｌ Ｗｉｄｔｈ_1", "Straße 5!", " Tab\t", "日本語", "かな", "a日本語", None]


@query("normal_forms", "SELECT o_orderkey, " + ", ".join([
    expected(WORDS, ["fullwidth_1", "strasse5", "tab", "日本語", "かな", "a日本語", None], "nfkc"), expected(WORDS, ["ｆｕｌｌｗｉｄｔｈ1", "strasse5", "tab", "日本語", "かな", "a日本語", None], "folded"),
    expected(WORDS, ["ｆｕｌｌ ｗｉｄｔｈ_1", "strasse 5!", "tab", "日本語", "かな", "a日本語", None], "stripped"), expected(WORDS, [False, False, False, True, False, False, None], "cjk")]) + " FROM orders")
def normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.col("said")
    return phrases(spark, sf_dir, WORDS).select("o_orderkey", text.nfkc_word(said).alias("nfkc"), text.fold_alnum(said).alias("folded"), text.strip_fold(said).alias("stripped"), text.is_cjk_key(said).alias("cjk"))


DATES = ["2024-02-29", "2023-02-29", "2024-1-1", "x", None, "2024-12-31"]


@query("safe_dates", "SELECT o_orderkey, " + expected(DATES, ["2024-02-29", None, None, None, None, "2024-12-31"], "day") + " FROM orders")
def safe_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(spark, sf_dir, DATES).select("o_orderkey", text.safe_date(F.col("said")).cast("string").alias("day"))


@query("level_similarities", """
WITH t AS (SELECT o_orderkey, ['none', 'low', 'medium', 'high', 'very_high', 'unknown'][(o_orderkey % 6 + 1)::BIGINT] AS a, ['none', 'low', 'medium', 'high', 'very_high', 'odd'][(o_custkey % 6 + 1)::BIGINT] AS b FROM orders),
p AS (SELECT *, list_position(['none', 'low', 'medium', 'high', 'very_high'], a) AS i, list_position(['none', 'low', 'medium', 'high', 'very_high'], b) AS j FROM t)
SELECT o_orderkey, CASE WHEN a = 'unknown' OR b = 'unknown' THEN 0.0 WHEN a = b THEN 1.0 WHEN i > 0 AND j > 0 THEN 1 - abs(i - j) / 4 ELSE 0.0 END AS score FROM p""")
def level_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = lambda last, key: F.element_at(F.array(*[F.lit(x) for x in (*similarity.LEVELS, last)]), (F.col(key) % 6 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", similarity.level_similarity(levels("unknown", "o_orderkey"), levels("odd", "o_custkey")).alias("score"))


@query("status_map_similarities", """
WITH t AS (SELECT o_orderkey, ['complete', 'partial', 'unknown'][(o_orderkey % 3 + 1)::BIGINT] AS a1, ['complete', 'partial'][(o_orderkey % 2 + 1)::BIGINT] AS a2,
  ['complete', 'partial', 'unknown'][(o_custkey % 3 + 1)::BIGINT] AS b1 FROM orders),
s AS (SELECT *, CASE WHEN a1 = 'unknown' OR b1 = 'unknown' THEN 0.0 WHEN a1 = b1 THEN 1.0 ELSE 0.5 END AS one FROM t)
SELECT o_orderkey, round(one / 2, 6) AS score, CASE WHEN a1 = 'unknown' OR b1 = 'unknown' THEN NULL ELSE (a1 = b1)::INT::DOUBLE END AS known FROM s""")
def status_map_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda values, key: F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))
    three = ("complete", "partial", "unknown")
    a = F.create_map(F.lit("s1"), pick(three, "o_orderkey"), F.lit("s2"), pick(three[:2], "o_orderkey"))
    b = F.create_map(F.lit("s1"), pick(three, "o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(similarity.status_map_similarity(a, b), 6).alias("score"), similarity.known_map_similarity(a, b).alias("known"))


@query("account_families", "SELECT o_orderkey, " + expected(["winged", "permanent_wingless", "short_id", "odd", None], ["winged", "wingless", "short_id", "unknown", "unknown"], "family") + " FROM orders")
def account_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(spark, sf_dir, ["winged", "permanent_wingless", "short_id", "odd", None]).select("o_orderkey", similarity.account_family(F.col("said")).alias("family"))


@query("item_states", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey % 5 = 0 AS po, l_partkey % 7 = 0 AS pm, l_suppkey % 3 = 0 AS tp, l_suppkey % 4 = 0 AS tn, l_linenumber % 2 = 0 AS ap, l_quantity > 20 AS el FROM lineitem),
c AS (SELECT *, CASE WHEN el THEN tp AND ap ELSE po OR tp END AS pos, CASE WHEN el THEN tn AND ap ELSE pm OR tn END AS neg FROM v),
d AS (SELECT *, CASE WHEN el THEN (pos AND (pm OR tn)) OR (neg AND (po OR tp)) ELSE pos AND neg END AS cf FROM c)
SELECT l_orderkey, l_linenumber, cf AS conflict, CASE WHEN cf THEN 'unknown' WHEN pos THEN 'owned' WHEN neg THEN 'confirmed_missing' ELSE 'unknown' END AS state,
  CASE WHEN cf THEN 'conflict' WHEN pos THEN CASE WHEN po THEN 'profile_claim' ELSE 'text_claim' END WHEN neg THEN CASE WHEN pm THEN 'profile_claim' ELSE 'text_claim' END ELSE 'unknown' END AS evidence_state,
  el AND NOT cf AND (pos OR neg) AS model_feature FROM d""")
def item_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey % 5 = 0 AS profile_owned", "l_partkey % 7 = 0 AS profile_missing", "l_suppkey % 3 = 0 AS text_positive", "l_suppkey % 4 = 0 AS text_negative",
        "l_linenumber % 2 = 0 AS approved", "l_quantity > 20 AS eligible")
    return matching.item_states(rows).select("l_orderkey", "l_linenumber", "conflict", "state", "evidence_state", "model_feature")


@query("promotion", """
WITH e AS (SELECT l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN 'identity' ELSE 'name' END AS field, l_suppkey % 4 AS lineage, l_returnflag = 'A' AS official, CASE WHEN l_partkey % 6 = 0 THEN l_linestatus ELSE 'x' END AS v FROM lineitem),
g AS (SELECT l_partkey, count(DISTINCT lineage) AS n, bool_or(official) FILTER (field = 'identity') AS o FROM e GROUP BY 1), c AS (SELECT l_partkey, max(d) AS d FROM (SELECT l_partkey, field, count(DISTINCT v) AS d FROM e GROUP BY ALL) GROUP BY 1)
SELECT p_partkey AS candidate_id, concat_ws(',', CASE WHEN coalesce(n, 0) < 2 THEN 'lineages_below_two' END, CASE WHEN NOT coalesce(o, false) THEN 'official_identity_missing' END, CASE WHEN coalesce(d, 0) > 1 THEN 'field_values_differ' END) AS codes,
  coalesce(n, 0) >= 2 AND coalesce(o, false) AND coalesce(d, 0) <= 1 AS promoted FROM part LEFT JOIN g ON g.l_partkey = p_partkey LEFT JOIN c ON c.l_partkey = p_partkey""")
def promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS candidate_id", "CASE WHEN l_linenumber % 3 = 0 THEN 'identity' ELSE 'name' END AS field", "l_suppkey % 4 AS lineage", "l_returnflag = 'A' AS official", "CASE WHEN l_partkey % 6 = 0 THEN l_linestatus ELSE 'x' END AS value")
    candidates = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("candidate_id"))
    return provenance.promotion(candidates, evidence).withColumn("codes", F.array_join("codes", ","))


@query("exactly_one", "SELECT o_orderkey, count(l_orderkey) AS matches, count(l_orderkey) = 1 AS matched FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey GROUP BY 1")
def exactly_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("key"))
    return provenance.exactly_one(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("key")), receipts, ["key"], "o_orderkey")


@query("subgroup_gates", """
WITH j AS (SELECT c_mktsegment, c_nationkey, o_custkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey), c AS (SELECT c_nationkey, o_custkey, avg(abs(o_totalprice - 150000) / o_totalprice) AS ape FROM j GROUP BY ALL),
m AS (SELECT c_nationkey, count(*) AS n, median(ape) AS md FROM c GROUP BY 1)
SELECT c_nationkey, n AS clusters, CASE WHEN n < 30 THEN 'none' WHEN md > 0.25 THEN 'too_far' ELSE 'passed' END AS verdict FROM m""")
def subgroup_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    price = F.col("o_totalprice")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_nationkey", "o_custkey", price.alias("actual"), F.lit(150000.0).alias("predicted"), F.lit(150000.0).alias("baseline"), F.lit(150000.0).alias("selected"), F.lit(-1.0).alias("low"), F.lit(1.0).alias("high"))
    found = publication.cluster_metrics(rows, ["c_nationkey"], "o_custkey")
    limit = publication.LIMITS
    verdict = F.when(F.col("clusters") < limit["subgroup_cases"], "none").when(F.col("mdape") > limit["subgroup_mdape"], "too_far").otherwise("passed")
    return found.select("c_nationkey", "clusters", verdict.alias("verdict"))


@query("canonical_lines", f"""
SELECT count(*) AS lines, count(DISTINCT listing_id) AS ids, sum(price_twd)::BIGINT AS total, count(*) FILTER (status IS NULL) AS unknown_status FROM ({LISTING_SQL})""")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings written as canonical JSON lines and read back."""
    rows = listings(spark, sf_dir).select("listing_id", "price_twd", "status")
    path = stages.fresh(spark, "lines")
    write_jsonl(rows, path, ["listing_id"])
    back = read_jsonl(spark, path, rows.schema)
    return back.agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("listing_id").alias("ids"), F.sum("price_twd").alias("total"), F.count_if(F.col("status").isNull()).alias("unknown_status"))


@query("canonical_line_text", f"""
SELECT '{{"listing_id":' || listing_id || ',"price_twd":' || price_twd || ',"status":' || coalesce('"' || status || '"', 'null') || '}}' AS value FROM ({LISTING_SQL})""")
def canonical_line_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_lines(listings(spark, sf_dir).select("status", "price_twd", "listing_id"), ["listing_id"])


@query("cleaned_market_lines", f"""
WITH l AS (SELECT *, CASE price_type WHEN 'reduced' THEN 'urgent_sale' WHEN 'asking' THEN 'normal_listing' WHEN 'normal_listing' THEN 'normal_listing' ELSE 'unknown' END AS line FROM ({LISTING_SQL}))
SELECT line, count(*) AS listings, count(*) FILTER (price_twd > 0) AS priced FROM l GROUP BY 1""")
def cleaned_market_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidar.functions.prices import training_line

    return listings(spark, sf_dir).groupBy(training_line(F.col("price_type")).alias("line")).agg(F.count(F.lit(1)).alias("listings"), F.count_if(F.col("price_twd") > 0).alias("priced"))


@query("exact_values", "SELECT o_orderkey, " + expected(["1", "1.0", "true", "null", '{"a":1}'], ["1", "1.0", "true", "null", '{"a":1}'], "canonical") + " FROM orders")
def exact_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(spark, sf_dir, ["1", "1.0", "true", "null", '{"a":1}']).select("o_orderkey", digests.canonical_json(F.col("said")).alias("canonical"))


