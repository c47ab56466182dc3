"""Blind review: who decides which case, twice and apart, and who settles what they disagree on.

Assignments follow from the cases alone: within a source the cases stand in the order of a digest, and reviewers who are not
of that source take turns. So a rerun assigns alike, nobody reviews a case of their own source, the two
reviewers of a case differ, and within a source the loads of any two who may review it differ by two at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.operators.freeze import placed


def _order(case_id: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{salt}|"), case_id.cast("string")), 256)


def _by_source(reviewers: DataFrame, sources: DataFrame) -> DataFrame:
    """source and eligible: for each source its reviewers, sorted. Reviewers are people, few by nature; sources are counted."""
    pairs = sources.join(F.broadcast(reviewers.select("reviewer", F.col("source").alias("own"))))  # people
    able = pairs.where(~F.col("source").eqNullSafe(F.col("own")) | F.col("own").isNull())
    return able.groupBy(F.col("source").alias("of")).agg(F.array_sort(F.collect_set("reviewer")).alias("eligible"))


def blind_queue(cases: DataFrame, reviewers: DataFrame, salt: str = "queue") -> DataFrame:
    """case_id, slot (A or B), reviewer, packet_id and place of two assignments for each of cases(case_id, source). packet_id tells
    nothing of the other slot. A case with fewer than two reviewers who may take it has null reviewers. Null is a source of its own."""
    dealt = placed(cases.select("case_id", "source", _order(F.col("case_id"), salt).alias("order")), ["source", "order", "case_id"])
    starts = dealt.groupBy(F.col("source").alias("from")).agg(F.min("place").alias("start"))
    rows = dealt.join(starts, F.col("source").eqNullSafe(F.col("from"))).withColumn("turn", F.col("place") - F.col("start"))
    able = _by_source(reviewers, starts.select(F.col("from").alias("source")))
    rows = rows.join(able, F.col("source").eqNullSafe(F.col("of")), "left")
    n = F.size(F.coalesce("eligible", F.array().cast("array<string>")))
    # each round of n cases takes all reviewers in turn; the second is as many places on as there were rounds, never none
    step = 1 + F.floor(F.col("turn") / F.greatest(n, F.lit(1))) % F.greatest(n - 1, F.lit(1))
    at = lambda k: F.when(n >= 2, F.get("eligible", (k % F.greatest(n, F.lit(1))).cast("int")))
    slots = F.array(F.struct(F.lit("A").alias("slot"), at(F.col("turn")).alias("reviewer")), F.struct(F.lit("B").alias("slot"), at(F.col("turn") + step).alias("reviewer")))
    out = rows.select("case_id", "turn", F.explode(slots).alias("s")).select("case_id", "s.slot", "s.reviewer", "turn")
    packet = F.concat(F.lit("packet_"), F.substring(F.sha2(F.concat_ws("|", F.lit(salt), "case_id", "slot"), 256), 1, 24))
    return out.select("case_id", "slot", "reviewer", packet.alias("packet_id"), F.col("turn").alias("place"))


def conflict_queue(decisions: DataFrame, cases: DataFrame, reviewers: DataFrame, salt: str = "conflict") -> DataFrame:
    """case_id and adjudicator of the cases whose two decisions(case_id, slot, reviewer, label) differ: one who may review the source
    and decided neither, taken by the case's digest; null where there is none."""
    both = decisions.groupBy("case_id").agg(F.countDistinct("slot").alias("slots"), F.min("label").alias("low"), F.max("label").alias("high"), F.collect_set("reviewer").alias("decided"))
    open_ = both.where((F.col("slots") == 2) & (F.col("low") != F.col("high"))).join(cases.select("case_id", "source"), "case_id")
    able = _by_source(reviewers, open_.select("source").distinct())
    rows = open_.join(able, F.col("source").eqNullSafe(F.col("of")), "left")
    left = F.array_except(F.coalesce("eligible", F.array().cast("array<string>")), "decided")
    turn = F.conv(F.substring(_order(F.col("case_id"), salt), 1, 8), 16, 10).cast("long")
    chosen = F.when(F.size("left") > 0, F.get("left", (turn % F.greatest(F.size("left"), F.lit(1))).cast("int")))
    return rows.withColumn("left", left).select("case_id", chosen.alias("adjudicator"))


def finalised(queue: DataFrame, decisions: DataFrame, adjudications: DataFrame) -> DataFrame:
    """case_id, label and status of each queued case: agreed, adjudicated, or a reason why not yet: decision_missing,
    reviewer_differs_from_queue, decided_twice, adjudication_missing, adjudicator_not_independent. decisions: case_id, slot,
    reviewer, label; adjudications: case_id, adjudicator, label, one a case (the first by name if more)."""
    asked = queue.select("case_id", "slot", F.col("reviewer").alias("asked"))
    said = decisions.groupBy("case_id", "slot").agg(F.count(F.lit(1)).alias("times"), F.min("reviewer").alias("reviewer"), F.min("label").alias("label"))
    both = asked.join(said, ["case_id", "slot"], "left").groupBy("case_id").agg(
        F.count("label").alias("n"), F.bool_or(F.col("times") > 1).alias("twice"), F.bool_or(F.col("reviewer").isNotNull() & ~F.col("reviewer").eqNullSafe(F.col("asked"))).alias("other"),
        F.min("label").alias("low"), F.max("label").alias("high"), F.collect_set("reviewer").alias("decided"))
    first = Window.partitionBy("case_id").orderBy("adjudicator", "label")
    settled = adjudications.withColumn("turn", F.row_number().over(first)).where("turn = 1").select("case_id", "adjudicator", F.col("label").alias("settled"))
    rows = both.join(settled, "case_id", "left")
    status = (
        F.when(F.col("n") < 2, "decision_missing").when(F.col("other"), "reviewer_differs_from_queue").when(F.col("twice"), "decided_twice").when(F.col("low") == F.col("high"), "agreed")
        .when(F.col("adjudicator").isNull(), "adjudication_missing").when(F.array_contains("decided", F.col("adjudicator")), "adjudicator_not_independent").otherwise("adjudicated"))
    return rows.select("case_id", F.when(status == "agreed", F.col("low")).when(status == "adjudicated", F.col("settled")).alias("label"), status.alias("status"))
