"""Queries that audit: closures, sets, schemas, personal data, digests, coverage, reviews, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.functions import digests, prices, text
from evidar.operators import audit, relate, splits
from evidar.plans.registry import query
from evidar.sources.tables import table

EDGES = [
    ("nation.region", "nation", "n_regionkey", "region", "r_regionkey"), ("customer.nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.nation", "supplier", "s_nationkey", "nation", "n_nationkey"), ("orders.customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem.orders", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem.part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"), ("labels.documents", "labels", "doc_id", "documents", "doc_id"),
    ("events.customer", "events", "user_id", "customer", "c_custkey"), ("documents.pages", "documents", "doc_id", "pages", "page_id"),
]
CLOSURE_SQL = " UNION ALL ".join(
    f"SELECT '{e}' AS edge, count(*) FILTER ({k} IS NOT NULL) AS rows, count(*) FILTER ({k} IS NOT NULL AND {k} NOT IN (SELECT {pk} FROM {p})) AS dangling FROM {c}" for e, c, k, p, pk in EDGES)


@query("fk_closure_audit", CLOSURE_SQL)
def fk_closure_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return relate.closure_audit([(e, t(c), F.col(k), t(p), F.col(pk)) for e, c, k, p, pk in EDGES])


@query("fk_seeded_violations", """
SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_quantity > 49 THEN l_partkey + 1000000 ELSE l_partkey END AS l_partkey FROM lineitem)
WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""")
def fk_seeded_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 49), F.col("l_partkey") + 1000000).otherwise(F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", moved.alias("l_partkey"))
    part = table(spark, sf_dir, "part").select("p_partkey")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left_anti")


@query("closed_set_equality", """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL""")
def closed_set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.closed_set(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("identity_bijection", """
WITH a AS (SELECT p_name AS value, count(DISTINCT p_brand) AS partners FROM part GROUP BY 1), b AS (SELECT p_brand AS value, count(DISTINCT p_name) AS partners FROM part GROUP BY 1)
SELECT 'p_name' AS side, value, partners FROM a WHERE partners <> 1 UNION ALL SELECT 'p_brand', value, partners FROM b WHERE partners <> 1""")
def identity_bijection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.bijection(table(spark, sf_dir, "part"), "p_name", "p_brand")


def _pii_sql(column: str) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(coalesce({column}, ''), '{p}') THEN '{k}' END" for k, p in text.PII.items()) + "], lambda x: x IS NOT NULL), ',')"


@query("pii_scan", f"SELECT doc_id, {_pii_sql('text')} AS findings FROM documents WHERE {_pii_sql('text')} <> ''")
def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", text.pii_codes(F.col("text")).alias("f"))
    return found.where(F.size("f") > 0).select("doc_id", F.array_join("f", ",").alias("findings"))


@query("pii_scan_turns", f"SELECT conv_id, turn, {_pii_sql('text')} AS findings FROM conversations WHERE {_pii_sql('text')} <> ''")
def pii_scan_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.pii_codes(F.col("text")).alias("f"))
    return found.where(F.size("f") > 0).select("conv_id", "turn", F.array_join("f", ",").alias("findings"))


NAMES = ["widget", "ring", "red ring", "bolt"]


@query("redact_names", """
SELECT p_partkey, replace(replace(replace(replace(replace(replace(p_name, 'blue ring', chr(1)), 'red ring', '[redacted]'), 'widget', '[redacted]'), 'bolt', '[redacted]'), 'ring', '[redacted]'), chr(1), 'blue ring') AS redacted FROM part""")
def redact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.redact(F.col("p_name"), NAMES, protected=("blue ring",)).alias("redacted"))


@query("url_hosts", """
SELECT regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, count(*) AS pages FROM pages GROUP BY 1""")
def url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(text.url_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("pages"))


@query("json_pointer", "SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events")
def json_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", digests.json_pointer(F.col("props"), "/k", "bigint").alias("k"))


@query("canonical_json_digest", """
SELECT event_type, count(*) AS rows, upper(sha256(string_agg(d, chr(10) ORDER BY d))) AS digest FROM (SELECT event_type, sha256(replace(props, ' ', '')) AS d FROM events) GROUP BY 1""")
def canonical_json_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", F.sha2(digests.canonical_json(F.col("props")), 256).alias("d"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), digests.ordered_digest(F.col("d")).alias("digest"))


@query("row_digests", """
SELECT c_nationkey, count(*) AS rows, upper(sha256(string_agg(d, chr(10) ORDER BY d))) AS digest
FROM (SELECT c_nationkey, sha256(c_custkey::VARCHAR || chr(0) || c_name || chr(0) || c_mktsegment) AS d FROM customer) GROUP BY 1""")
def row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_nationkey", digests.key_digest(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")).alias("d"))
    return rows.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("rows"), digests.ordered_digest(F.col("d")).alias("digest"))


@query("surrogate_ids", """
SELECT c_custkey, 'account_' || substr(sha256(c_name), 1, 20) AS account_id, 'cluster_' || substr(sha256(c_mktsegment || chr(0) || c_nationkey::VARCHAR), 1, 20) AS cluster_id FROM customer""")
def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", digests.pseudonym("account_", F.col("c_name")).alias("account_id"), digests.surrogate_id("cluster_", F.col("c_mktsegment"), F.col("c_nationkey")).alias("cluster_id"))


@query("schema_constraints", """
SELECT rule, count(*) AS violations FROM (
  SELECT unnest(list_filter([CASE WHEN NOT l_discount BETWEEN 0 AND 0.08 THEN 'l_discount.range' END, CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag.enum' END,
    CASE WHEN l_quantity <> floor(l_quantity) THEN 'l_quantity.integer' END, CASE WHEN l_quantity >= 50 THEN 'l_quantity.exclusive_maximum' END], lambda x: x IS NOT NULL)) AS rule FROM lineitem
  UNION ALL SELECT unnest(list_filter([CASE WHEN NOT regexp_matches(p_brand, '^Brand#[0-9]$') THEN 'p_brand.pattern' END, CASE WHEN length(p_name) < 9 THEN 'p_name.min_length' END], lambda x: x IS NOT NULL)) FROM part
  UNION ALL SELECT 'p_name.unique' FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) > 1) GROUP BY 1""")
def schema_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = audit.violations(table(spark, sf_dir, "lineitem"), {
        "l_discount": {"minimum": 0, "maximum": 0.08}, "l_returnflag": {"enum": ["A", "N"]}, "l_quantity": {"type": "integer", "exclusiveMaximum": 50}})
    part = table(spark, sf_dir, "part")
    parts = audit.violations(part, {"p_brand": {"pattern": "^Brand#[0-9]$"}, "p_name": {"minLength": 9}})
    return lines.unionByName(parts).unionByName(audit.duplicates(part, "p_name")).groupBy("rule").agg(F.sum("violations").alias("violations"))


STRATA = [(f"{p}|{s}", p, s) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW") for s in ("F", "O", "P", "*")]


def quota_sql() -> str:
    steps, before = [], []
    for k, (name, p, s) in enumerate(STRATA):
        where = f"o_orderpriority = '{p}'" + ("" if s == "*" else f" AND o_orderstatus = '{s}'")
        without = "".join(f" AND o_orderkey NOT IN (SELECT o_orderkey FROM q{j})" for j in before)
        steps.append(f"q{k} AS MATERIALIZED (SELECT o_orderkey, '{name}' AS stratum, row_number() OVER (ORDER BY o_orderkey)::INT AS place FROM orders WHERE {where}{without} QUALIFY place <= 10)")
        before.append(k)
    return "WITH " + ", ".join(steps) + " " + " UNION ALL ".join(f"SELECT * FROM q{k}" for k in before)


@query("quota_sample", quota_sql())
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    strata = [(n, (F.col("o_orderpriority") == p) & (F.lit(True) if s == "*" else F.col("o_orderstatus") == s)) for n, p, s in STRATA]
    return splits.quota_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), "o_orderkey", strata, 10)


@query("alternating_split", """
SELECT c_custkey, c_mktsegment, CASE WHEN (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) % 2 = 0 THEN 'development' ELSE 'heldout' END AS "partition" FROM customer""")
def alternating_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.alternating(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"], ["c_custkey"])


@query("digest_order_split", """
WITH f AS (SELECT c_custkey, sha256(c_name) AS digest FROM customer ORDER BY digest LIMIT 200)
SELECT c_custkey, digest, row_number() OVER (ORDER BY digest) AS place, CASE WHEN row_number() OVER (ORDER BY digest) <= 100 THEN 'development' ELSE 'heldout' END AS "partition" FROM f""")
def digest_order_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.digest_order(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), F.col("c_name"), 200).drop("c_name")


AB_SQL = """
WITH a AS (SELECT doc_id, quality AS label FROM labels), b AS (SELECT doc_id, CASE WHEN n_chars >= 400 THEN 1 ELSE 0 END AS label FROM documents),
p AS (SELECT doc_id, a.label AS label_a, b.label AS label_b FROM a JOIN b USING (doc_id))
"""


def ab_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label_a"))
    return a.join(table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") >= 400, 1).otherwise(0).alias("label_b")), "doc_id")


@query("ab_conflicts", AB_SQL + "SELECT doc_id, label_a, label_b FROM p WHERE label_a <> label_b")
def ab_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ab_pairs(spark, sf_dir).where("label_a <> label_b")


@query("ab_agreement", AB_SQL + """
SELECT CASE WHEN doc_id % 2 = 0 THEN 'development' ELSE 'heldout' END AS "partition", count(*) AS cases, round(avg(CASE WHEN label_a = label_b THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p GROUP BY 1""")
def ab_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("doc_id") % 2 == 0, "development").otherwise("heldout")
    return ab_pairs(spark, sf_dir).groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias("cases"), F.round(F.avg((F.col("label_a") == F.col("label_b")).cast("double")), 6).alias("accuracy"))


@query("pr_metrics", AB_SQL + """
, n AS (SELECT count(*) FILTER (label_a = 1 AND label_b = 1) AS tp, count(*) FILTER (label_a = 0 AND label_b = 1) AS fp, count(*) FILTER (label_a = 1 AND label_b = 0) AS fn, count(*) FILTER (label_a = 0 AND label_b = 0) AS tn FROM p)
SELECT *, round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall FROM n""")
def pr_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.precision_recall(ab_pairs(spark, sf_dir), F.col("label_a") == 1, F.col("label_b") == 1)


@query("coverage_report", """
SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(DISTINCT text) FROM documents) AS distinct_texts, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS labelled,
       (SELECT count(*) FROM documents WHERE coalesce(lang, 'unknown') = 'unknown') AS lang_unknown, (SELECT count(*) FROM labels WHERE toxic = 1) AS toxic, (SELECT count(*) FROM benchmark) AS benchmark_items""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.select(F.col("doc_id").alias("l")).distinct()
    main = docs.select("doc_id", "lang", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("t")).join(known, F.col("doc_id") == F.col("l"), "left").agg(
        F.count(F.lit(1)).alias("documents"), F.countDistinct("t").alias("distinct_texts"), F.count_if(F.col("l").isNotNull()).alias("labelled"),
        F.count_if(F.coalesce("lang", F.lit("unknown")) == "unknown").alias("lang_unknown"))
    # one row each
    return main.crossJoin(labels.agg(F.count_if(F.col("toxic") == 1).alias("toxic"))).crossJoin(table(spark, sf_dir, "benchmark").agg(F.count(F.lit(1)).alias("benchmark_items")))


@query("count_by_key", "SELECT coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source, count(*) AS n FROM documents GROUP BY ALL")
def count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.count_by(table(spark, sf_dir, "documents"), "lang", "source")


@query("universe_reconcile", """
WITH c AS (SELECT p_partkey, (p_size = 50) AS canonical, (p_type = 'PROMO' AND p_size > 40) AS candidate, (p_retailprice < 950) AS excluded FROM part)
SELECT p_partkey, CASE WHEN canonical THEN 'canonical' WHEN candidate THEN 'candidate' WHEN excluded THEN 'excluded' ELSE 'unmatched' END AS class FROM c""")
def universe_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    classes = [("canonical", c("p_size") == 50), ("candidate", (c("p_type") == "PROMO") & (c("p_size") > 40)), ("excluded", c("p_retailprice") < 950)]
    return audit.classify(table(spark, sf_dir, "part"), classes, "unmatched").select("p_partkey", "class")


@query("cross_type_quarantine", """
WITH n AS (SELECT regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS name_key, count(DISTINCT p_brand) AS types FROM part GROUP BY 1)
SELECT p_partkey, name_key, p_brand, types > 1 AS quarantined FROM part JOIN n ON n.name_key = regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g')""")
def cross_type_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", text.ascii_alnum(F.col("p_name")).alias("name_key"), "p_brand")
    return audit.quarantine(rows, "name_key", "p_brand")


@query("freshness_gate", """
SELECT o_orderkey, CASE WHEN o_orderdate::DATE BETWEEN DATE '1998-08-02' - 366 AND DATE '1998-08-02' THEN 'fresh' WHEN o_orderdate::DATE > DATE '1998-08-02' THEN 'future' ELSE 'stale' END AS freshness FROM orders""")
def freshness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, cutoff = F.to_date("o_orderdate"), F.lit("1998-08-02").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(text.fresh(day, cutoff), "fresh").when(day > cutoff, "future").otherwise("stale").alias("freshness"))


@query("price_type_map", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'normal_listing' WHEN 'click' THEN 'urgent_sale' WHEN 'purchase' THEN 'verified_sale' ELSE 'unknown' END AS line FROM events""")
def price_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = prices.vocabulary(F.col("event_type"), {"view": "asking", "click": "reduced", "purchase": "verified_sale"})
    return table(spark, sf_dir, "events").select("event_id", prices.training_line(raw).alias("line"))


@query("set_override", """
SELECT c_custkey, c_acctbal, 'new' AS version FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, c_acctbal, 'base' FROM customer WHERE c_acctbal >= 0""")
def set_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.lit("base").alias("version"))
    return relate.override(base, base.where("c_acctbal < 0").withColumn("version", F.lit("new")), "c_custkey")


@query("distinct_assertions", "SELECT count(*) AS rows, count(DISTINCT p_partkey) AS keys, count(DISTINCT p_name) AS names, count(*) = count(DISTINCT p_partkey) AS key_is_unique FROM part")
def distinct_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n: Column = F.count(F.lit(1))
    return table(spark, sf_dir, "part").agg(n.alias("rows"), F.countDistinct("p_partkey").alias("keys"), F.countDistinct("p_name").alias("names"), (n == F.countDistinct("p_partkey")).alias("key_is_unique"))
