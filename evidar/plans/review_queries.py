"""Queries of blind review: cases are orders, reviewers are suppliers, sources are nations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.operators import review
from evidar.plans.registry import query
from evidar.sources.tables import table

REVIEWERS = "SELECT 'r' || lpad(s_suppkey::VARCHAR, 4, '0') AS reviewer, CASE WHEN s_suppkey % 4 > 0 THEN 'n' || s_suppkey % 5 END AS own FROM supplier WHERE s_suppkey < 12"
QUEUE_SQL = f"""
c AS (SELECT o_orderkey AS case_id, CASE WHEN o_custkey % 6 < 5 THEN 'n' || o_custkey % 6 END AS source FROM orders), p AS ({REVIEWERS}),
a AS (SELECT s.source, list(reviewer ORDER BY reviewer) AS eligible FROM (SELECT DISTINCT source FROM c) s JOIN p ON own IS NULL OR own IS DISTINCT FROM s.source GROUP BY 1),
t AS (SELECT case_id, c.source, eligible, len(eligible) AS n, row_number() OVER (PARTITION BY c.source ORDER BY sha256('queue|' || case_id), case_id) - 1 AS turn FROM c JOIN a ON a.source IS NOT DISTINCT FROM c.source),
q AS (SELECT case_id, source, turn, 'A' AS slot, eligible[turn % n + 1] AS reviewer FROM t UNION ALL SELECT case_id, source, turn, 'B', eligible[(turn + 1 + (turn // n) % (n - 1)) % n + 1] FROM t)"""


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id"), F.when(F.col("o_custkey") % 6 < 5, F.concat(F.lit("n"), (F.col("o_custkey") % 6).cast("string"))).alias("source"))


def reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.col("s_suppkey") % 4 > 0, F.concat(F.lit("n"), (F.col("s_suppkey") % 5).cast("string")))
    return table(spark, sf_dir, "supplier").where("s_suppkey < 12").select(F.concat(F.lit("r"), F.lpad(F.col("s_suppkey").cast("string"), 4, "0")).alias("reviewer"), own.alias("source"))


@query("blind_queue", f"WITH {QUEUE_SQL} SELECT case_id, slot, reviewer, 'packet_' || substr(sha256('queue|' || case_id || '|' || slot), 1, 24) AS packet_id, turn::BIGINT AS place FROM q")
def blind_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.blind_queue(cases(spark, sf_dir), reviewers(spark, sf_dir))


@query("finalised_reviews", f"""WITH {QUEUE_SQL},
d AS (SELECT case_id, slot, CASE WHEN case_id % 41 = 0 AND slot = 'B' THEN 'stranger' ELSE reviewer END AS reviewer, CASE WHEN slot = 'B' AND case_id % 5 = 0 THEN 'no' ELSE 'yes' END AS label FROM q WHERE NOT (case_id % 37 = 0 AND slot = 'A')),
b AS (SELECT case_id, count(*) AS n, bool_or(reviewer = 'stranger') AS other, min(label) AS low, max(label) AS high, list(reviewer) AS decided FROM d GROUP BY 1),
j AS (SELECT b.*, source, CASE WHEN case_id % 3 = 0 THEN NULL ELSE list_filter(eligible, lambda r: NOT list_contains(decided, r))[('0x' || substr(sha256('conflict|' || case_id), 1, 8))::BIGINT % len(list_filter(eligible, lambda r: NOT list_contains(decided, r))) + 1] END AS adjudicator
  FROM b JOIN t USING (case_id)),
s AS (SELECT *, CASE WHEN n < 2 THEN 'decision_missing' WHEN other THEN 'reviewer_differs_from_queue' WHEN low = high THEN 'agreed' WHEN adjudicator IS NULL THEN 'adjudication_missing' ELSE 'adjudicated' END AS status FROM j)
SELECT case_id, status, CASE status WHEN 'agreed' THEN low WHEN 'adjudicated' THEN 'by ' || adjudicator END AS label FROM s""")
def finalised_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions follow the queue but for some; conflicts go to the adjudicator that their queue names, but for a third."""
    given, people = cases(spark, sf_dir), reviewers(spark, sf_dir)
    queue = review.blind_queue(given, people)
    c = F.col
    made = queue.where(~((c("case_id") % 37 == 0) & (c("slot") == "A"))).select(
        "case_id", "slot", F.when((c("case_id") % 41 == 0) & (c("slot") == "B"), "stranger").otherwise(c("reviewer")).alias("reviewer"), F.when((c("slot") == "B") & (c("case_id") % 5 == 0), "no").otherwise("yes").alias("label"))
    settled = review.conflict_queue(made, given, people).where("case_id % 3 <> 0 and adjudicator is not null").select("case_id", "adjudicator", F.concat(F.lit("by "), "adjudicator").alias("label"))
    return review.finalised(queue, made, settled)
