"""Season claims of listing texts, as rows: one for each mention, then one for each season of a listing.

A mention is a spelling with what stands before and after it; every rule is a pattern over these two. A range
between two mentions is expanded over the catalog's order, and runs of seasons are islands of that order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidar.functions.text import WHITE
from evidar.operators.relate import expand_range, islands

# Words and patterns of the listings' language.
HARD = "。；;！!？?\\n"
SOFT = HARD + "，,、"
NOT_DONE = "(?:未|尚未|沒有|没有|無法|无法|無|无)(?:畢|毕)(?:業|业)?"
DONE = "(?<!(?:未|尚未|沒有|没有|無法|无法|無|无|不算|半)" + WHITE + "{0,5})(?:畢業|毕业)"
HEADING = "(?:畢業季節|毕业季节|畢業季|毕业季)" + WHITE + "*(?:[:：]|含)?"
PARTIAL = "^" + WHITE + "*(?:季" + WHITE + "*)?(?:半畢(?:業)?|半毕(?:业)?|[1-9]" + WHITE + "*/" + WHITE + "*[2-9])"
AND = "^" + WHITE + "*(?:與|与|和|及)" + WHITE + "*$"
TO = WHITE + "*(?:～|~|至|到|—|-)" + WHITE + "*"
AMBIGUOUS = ("凜冬", "凛冬")
GATED = ("集結", "集结", "破碎")
GATE_CLOSED = "(?:不含|不包|無|无|缺)" + WHITE + "*$"
GATE_HEADING = "(?:季節|季节|畢業季節|毕业季节)" + WHITE + "*[:：\\-—]?" + WHITE + "*[^\\n]{0,20}$"
GATE_WORDS = "畢業|毕业|季卡|有卡|無卡|无卡|半畢|半毕"
OWNED = ("complete", "partial", "owned_not_complete")


def mentions(rows: DataFrame, id_col: str, text_col: str, aliases: dict[str, str]) -> DataFrame:
    """id, n, term, before, after, start, season_id of each season that a text names. aliases: spelling -> season, a
    catalog. season_id is null where a spelling names none for sure. A spelling that is an everyday word too counts
    only where the text presents it as a season."""
    spellings = sorted({*aliases, *AMBIGUOUS}, key=lambda a: (-len(a), a))
    pattern = "(?i)(?:" + "|".join(re.escape(s) for s in spellings) + ")"
    said = F.coalesce(rows[text_col], F.lit(""))
    terms, between = F.regexp_extract_all(said, F.lit(pattern), 0), F.split(said, pattern, -1)
    given = rows.select(rows[id_col].alias("id"), terms.alias("terms"), F.flatten(F.transform(F.arrays_zip(between.alias("b"), terms.alias("t")), lambda x: F.array(x["b"], F.coalesce(x["t"], F.lit(""))))).alias("all"))
    joined = lambda start, n: F.array_join(F.slice("all", start, n), "")
    place = F.col("n") * 2
    found = given.select("id", "all", F.posexplode("terms").alias("n", "term")).select(
        "id", "n", "term", joined(F.lit(1), place + 1).alias("before"), joined(place + 3, F.size("all")).alias("after"),
        F.get("all", place + 2).alias("up_to_next"), joined(place + 5, F.size("all")).alias("after_next"))
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in (pair[0].lower(), pair[1])]) if aliases else F.create_map().cast("map<string,string>")
    season = F.when(~F.col("term").isin(*AMBIGUOUS), F.try_element_at(table, F.lower("term")))
    before, after = F.right("before", F.lit(24)), F.left("after", F.lit(16))
    presented = (
        after.startswith("季") | before.rlike(GATE_HEADING) | F.concat(before, "term", after).rlike(GATE_WORDS)
        | before.rlike(TO + "$") | after.rlike("^" + TO))
    open_ = ~before.rlike(GATE_CLOSED) & ~before.rlike(pattern + "$") & presented
    return found.withColumn("season_id", season).withColumn("start", F.length("before")).where(~F.col("term").isin(*GATED) | open_)


def _flags() -> dict[str, Column]:
    before, after = F.col("before"), F.col("after")
    left, right = F.regexp_extract(before, f"[^{SOFT}]*$", 0), F.regexp_extract(after, f"^[^{SOFT}]*", 0)
    negative = (
        after.rlike(f"^[^{SOFT}]{{0,10}}{NOT_DONE}") | left.rlike(f"{NOT_DONE}[^{SOFT}]{{0,10}}$")
        | (left.rlike(f"差[^{SOFT}]{{0,6}}$") & after.rlike(f"^[^{SOFT}]{{0,10}}(?:畢|毕)")))
    positive = F.concat(left, "term", right).rlike(DONE) | F.regexp_extract(before, f"[^{HARD}]*$", 0).rlike(f"{HEADING}[^{HARD}]*$")
    near = lambda words, later: after.rlike(f"^.{{0,5}}(?:{words}{later})") | before.rlike(f"(?:{words}).{{0,5}}$")
    return {
        "missing": before.rlike("(?:缺|缺少|斷|断)" + WHITE + "*$") | after.rlike("^" + WHITE + "*(?:缺|斷季|断季)"),
        "negative": negative, "positive": positive & ~negative,
        "partial": F.regexp_extract("up_to_next", f"^[^{SOFT}]*", 0).rlike(PARTIAL) | (F.col("up_to_next").rlike(AND) & F.col("after_next").rlike(PARTIAL)),
        "pass_yes": near("季卡|有卡", "|卡有"), "pass_no": near("無卡|无卡", ""),
    }


def season_claims(rows: DataFrame, id_col: str, text_col: str, aliases: dict[str, str], order: dict[str, int], flags: bool = False) -> DataFrame:
    """id, season_id, status, pass_owned, evidence_state. flags: also whether completion was claimed (positive) or denied (negative). order: season -> place. The seasons between the ends of a
    range are claimed too: as the range says, unknown if it says nothing."""
    named = mentions(rows, id_col, text_col, aliases).where("season_id is not null")
    signs = _flags()
    held = named.select("id", "season_id", *[c.alias(n) for n, c in signs.items()]).groupBy("id", "season_id").agg(*[F.bool_or(n).alias(n) for n in signs])
    conflict = F.col("positive") & F.col("negative")
    status = F.when(F.col("missing"), "confirmed_missing").when(conflict, "unknown").when(F.col("negative"), "owned_not_complete").when(
        F.col("partial"), "partial").when(F.col("positive"), "complete").otherwise("owned_not_complete")
    held = held.select("id", "season_id", status.alias("status"), F.when(F.col("pass_yes"), "yes").when(F.col("pass_no"), "no").otherwise("unknown").alias("pass_owned"),
                       F.when(conflict, "conflict").otherwise("text_claim").alias("evidence_state"), "positive", "negative")
    ranges = _ranges(named, order)
    ends = ranges.where("said = 'complete'").select("id", F.explode(F.array("season_id", "to_season")).alias("season_id")).distinct().withColumn("whole", F.lit(True))
    held = held.join(ends, ["id", "season_id"], "left").withColumn(
        "status", F.when((F.col("status") == "owned_not_complete") & F.coalesce("whole", F.lit(False)), "complete").otherwise(F.col("status"))).drop("whole")
    places = _places(rows.sparkSession, order)
    inside = expand_range(ranges, "low", "high", "place").join(places.withColumnRenamed("season_id", "inner"), "place")
    inside = inside.groupBy("id", F.col("inner").alias("season_id")).agg(F.min_by("said", "n").alias("status"))
    inside = inside.join(held.select("id", "season_id"), ["id", "season_id"], "left_anti").select(
        "id", "season_id", "status", F.lit("unknown").alias("pass_owned"), F.when(F.col("status") == "unknown", "unknown").otherwise("text_claim").alias("evidence_state"),
        F.lit(False).alias("positive"), F.lit(False).alias("negative"))
    every = held.unionByName(inside)
    return every if flags else every.drop("positive", "negative")


def _places(spark: SparkSession, order: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(p, s) for s, p in order.items()], "place int, season_id string")


def _ranges(named: DataFrame, order: dict[str, int]) -> DataFrame:
    """id, n, season_id, to_season, low, high, said of each two mentions with only a mark of a range between them."""
    places = F.create_map(*[F.lit(x) for pair in order.items() for x in pair]) if order else F.create_map().cast("map<string,int>")
    following = Window.partitionBy("id").orderBy("n")
    after = lambda c: F.lead(c).over(following)
    rows = named.select("id", "n", "term", "after", "start", "season_id", after("season_id").alias("to_season"), after("start").alias("to_start"), after("term").alias("to_term"))
    gap = F.col("to_start") - F.col("start") - F.length("term")
    text = F.substring("after", F.lit(1), gap + F.length("to_term") + 12)
    said = F.when(text.rlike("全畢|全毕|皆畢|皆毕"), "complete").when(text.rlike("無斷|无断|不斷|不断"), "owned_not_complete").otherwise("unknown")
    low, high = F.try_element_at(places, F.col("season_id")), F.try_element_at(places, F.col("to_season"))
    return rows.where(F.substring("after", F.lit(1), gap).rlike(f"^{TO}$")).select(
        "id", "n", "season_id", "to_season", low.alias("low"), high.alias("high"), said.alias("said")).where("low is not null and high is not null")


def season_summary(claims: DataFrame, order: dict[str, int]) -> DataFrame:
    """id, earliest_season_id, earliest_complete_season_id, complete_count, partial_count, pass_not_complete_count of each listing."""
    placed = claims.join(_places(claims.sparkSession, order), "season_id", "left")
    place = F.coalesce("place", F.lit(1 << 30))
    first = lambda kept: F.min_by(F.when(kept, F.col("season_id")), F.when(kept, F.struct(place, "season_id")))
    done = F.col("status") == "complete"
    return placed.groupBy("id").agg(
        first(F.col("status").isin(*OWNED)).alias("earliest_season_id"), first(done).alias("earliest_complete_season_id"), F.count_if(done).alias("complete_count"),
        F.count_if(F.col("status") == "partial").alias("partial_count"), F.count_if((F.col("pass_owned") == "yes") & ~done).alias("pass_not_complete_count"))


def season_runs(claims: DataFrame, order: dict[str, int], statuses: tuple[str, ...] = OWNED) -> DataFrame:
    """id, first, last, size of each run of consecutive seasons with one of the statuses, by their places."""
    placed = claims.where(F.col("status").isin(*statuses)).join(_places(claims.sparkSession, order), "season_id")
    return islands(placed, ["id"], "place")
