"""Splits that leak nothing: time-forward cuts, digest order, alternation, quotas, grouped folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.operators.freeze import placed

# Clusters asked for.
TRAINING_CLUSTERS, HOLDOUT_CLUSTERS = 300, 100


def intervals(rows: DataFrame, cluster: list[str], date: str, keep: list[str] | None = None) -> DataFrame:
    """First and last date (begin, end) of each cluster."""
    return rows.groupBy(*cluster, *(keep or [])).agg(F.min(date).alias("begin"), F.max(date).alias("end"))


def cut_scores(spans: DataFrame, pool: list[str], train_cap: int = TRAINING_CLUSTERS, holdout_cap: int = HOLDOUT_CLUSTERS) -> DataFrame:
    """For each pool and cut (a first date of some cluster): training (ended before), holdout (began at
    or after), spanning clusters and the capped score. Clusters are first counted by day, so the
    running sums go over days, not over clusters."""
    days = spans.groupBy(*pool, F.col("begin").alias("day")).agg(F.count(F.lit(1)).alias("begins"), F.lit(0).cast("long").alias("ends")).unionByName(
        spans.groupBy(*pool, F.col("end").alias("day")).agg(F.lit(0).cast("long").alias("begins"), F.count(F.lit(1)).alias("ends")))
    days = days.groupBy(*pool, "day").agg(F.sum("begins").alias("begins"), F.sum("ends").alias("ends"))
    if not pool:
        days, pool = days.withColumn("__all", F.lit(1)), ["__all"]
    before = Window.partitionBy(*pool).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*pool)
    scored = days.select(
        *pool, F.col("day").alias("cut"), "begins",
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("training"),
        (F.sum("begins").over(whole) - F.coalesce(F.sum("begins").over(before), F.lit(0))).alias("holdout"),
        F.sum("begins").over(whole).alias("clusters"),
    ).where("begins > 0 and training > 0 and holdout > 0")
    return scored.withColumn("spanning", F.col("clusters") - F.col("training") - F.col("holdout")).withColumn(
        "score", F.least("training", F.lit(train_cap)) + F.least("holdout", F.lit(holdout_cap))).drop("begins", "clusters", "__all")


def best_cut(spans: DataFrame, pool: list[str], train_cap: int = TRAINING_CLUSTERS, holdout_cap: int = HOLDOUT_CLUSTERS) -> DataFrame:
    """The cut of greatest score of each pool; then of more holdout; then the earliest."""
    scored = cut_scores(spans, pool, train_cap, holdout_cap)
    rank = F.struct("score", "holdout", (-F.unix_date(F.col("cut").cast("date"))).alias("early"))
    pick = [F.max_by(F.col(c), rank).alias(c) for c in ("cut", "training", "holdout", "spanning", "score")]
    found = scored.groupBy(*pool).agg(*pick) if pool else scored.agg(*pick).where("cut is not null")
    return found.withColumn("requirements_met", (F.col("training") >= train_cap) & (F.col("holdout") >= holdout_cap))


def assign(spans: DataFrame, cut: Column) -> Column:
    """train, holdout or spanning, by the cut."""
    return F.when(spans["end"] < cut, "train").when(spans["begin"] >= cut, "holdout").otherwise("spanning")


def alternating(rows: DataFrame, stratum: list[str], order: list[str], name: str = "partition") -> DataFrame:
    """Within each stratum every other row: development first, then heldout."""
    place = F.row_number().over(Window.partitionBy(*stratum).orderBy(*order))
    return rows.withColumn(name, F.when((place - 1) % 2 == 0, "development").otherwise("heldout"))


def digest_order(rows: DataFrame, key: Column, first: int) -> DataFrame:
    """The first rows by the SHA-256 of key, the even ones development and the odd ones heldout."""
    chosen = rows.withColumn("digest", F.sha2(key.cast("string"), 256)).orderBy("digest").limit(first)
    place = F.row_number().over(Window.orderBy("digest"))
    return chosen.withColumn("place", place).withColumn("partition", F.when(F.col("place") <= first // 2, "development").otherwise("heldout"))


def quota_sample(rows: DataFrame, key: str, strata: list[tuple[str, Column]], quota: int) -> DataFrame:
    """quota rows of least key for each stratum in order, no row twice. A stratum needs no more than
    quota rows beyond those that earlier strata can have taken, so each brings that many candidates,
    found in one pass over rows, and the choice itself is made among those few."""
    fits = F.array_compact(F.array(*[F.when(predicate, F.lit(k)) for k, (_, predicate) in enumerate(strata)]))
    every = rows.select(F.col(key).alias("key"), F.explode(fits).alias("place"))
    # each task keeps as many of a stratum as can be asked for
    within = F.row_number().over(Window.partitionBy("place").orderBy("key"))
    candidates = every.withColumn("rank", within).where(F.col("rank") <= quota * len(strata)).where(F.col("rank") <= quota * (F.col("place") + 1))
    by_stratum: dict[int, list] = {}
    for row in candidates.collect():
        by_stratum.setdefault(row.place, []).append(row.key)
    taken: set = set()
    out: list[tuple] = []
    for k, (name, _) in enumerate(strata):
        fresh = [x for x in sorted(by_stratum.get(k, [])) if x not in taken][:quota]
        taken.update(fresh)
        out += [(x, name, i + 1) for i, x in enumerate(fresh)]
    kind = rows.schema[key].dataType.simpleString()
    return rows.sparkSession.createDataFrame(out, f"{key} {kind}, stratum string, place int")


def grouped_folds(rows: DataFrame, group: str, folds: int, name: str = "fold") -> DataFrame:
    """Fold of each group, all its rows together. Groups of about one size are dealt out in turn in each slice
    of their hash, so folds differ by few groups of each size, and no list of all groups is gathered."""
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    # by size class: groups of one class are dealt out in turn in each of many slices of the hash
    slices = sizes.withColumn("__class", F.floor(F.log2("n"))).withColumn("__slice", F.pmod(F.xxhash64(group), F.lit(64)))
    turn = F.row_number().over(Window.partitionBy("__class", "__slice").orderBy(F.desc("n"), F.xxhash64(group), group))
    dealt = slices.withColumn(name, ((turn - 1 + F.col("__slice")) % folds).cast("int")).select(group, name)
    return rows.join(dealt, group)


def _quotas(loads: list[int], size: int, count: int) -> list[int]:
    """How many of count groups of this size each fold takes if each goes to the lightest fold (of equal ones to the first): the
    folds fill up to one level, found by bisection, and what is left goes to those at the level in their order."""
    taken = lambda level: [max(0, -(-(level - x) // size)) for x in loads]  # noqa: E731  so many are given out below the level
    low, high = min(loads), max(loads) + size * (count + 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if sum(taken(middle)) <= count else (low, middle)
    out = taken(low)
    left = count - sum(out)
    for fold, (x, n) in enumerate(zip(loads, out)):
        if left and x + n * size == low:
            out[fold] += 1
            left -= 1
    return out


def greedy_folds(rows: DataFrame, group: str, folds: int, name: str = "fold") -> DataFrame:
    """Fold of each group as dealing the largest groups first, each to the lightest fold, gives it. Only how many groups there are
    of each size goes to the driver (no more than the root of twice the rows); groups of one size are ranked by a
    sort over ranges and take their fold by their rank. Null is a group of its own. Repeated rows count."""
    sizes = rows.groupBy(F.col(group).alias("of")).agg(F.count(F.lit(1)).alias("n"))
    dealt = placed(sizes.withColumn("first", -F.col("n")), ["first", "of"])
    histogram = dealt.groupBy("n").agg(F.count(F.lit(1)).alias("groups")).orderBy(F.desc("n")).collect()
    loads, before, ranges = [0] * folds, 0, []
    for size in histogram:
        for fold, n in enumerate(_quotas(loads, size.n, size.groups)):
            if n:
                ranges.append((size.n, fold, before, before + n))
                before, loads[fold] = before + n, loads[fold] + n * size.n
    table = rows.sparkSession.createDataFrame(ranges, f"n long, {name} int, low long, high long")
    # a size has at most as many ranges as there are folds
    found = dealt.join(table, "n").where((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high"))).select("of", name)
    return rows.join(found, F.col(group).eqNullSafe(F.col("of"))).drop("of")
