"""Exact percentiles of groups of any size.

A sketch, added up in each task, brackets the asked places; a second pass counts what is below the bracket and the
values in it. So no task holds a group: the bracket has about 8 / ACCURACY of its rows, equal values counted once, or
all values of a group of at most ACCURACY rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.sources.stages import staged

#: The sketch errs by at most one in so many places; the bracket reaches four times as far to either side.
ACCURACY = 10_000
#: The same for medians of many columns at once, whose brackets are ranked by a sort: smaller sketches, wider brackets.
COARSE = 1_000


def _key(keys: list[str]) -> list[Column]:
    return [F.col(k) for k in keys]


def percentiles(rows: DataFrame, keys: list[str], value: Column, asked: dict[str, float], how: str = "linear") -> DataFrame:
    """keys and, for each name of asked, that percentile (a share) of value, nulls left out; count of values as n.
    how: linear (between the two values about the place) or upper (the value at the place n * share, rounded down).
    A group without values has no row."""
    x = rows.select(*_key(keys), value.cast("double").alias("x")).where("x is not null")
    reach = 4 / ACCURACY
    shares = [s for p in asked.values() for s in (max(0.0, p - reach), min(1.0, p + reach))]
    sketched = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", shares, ACCURACY).alias("cut")) if keys else x.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", shares, ACCURACY).alias("cut"))
    names = list(asked)
    same = F.lit(True)
    renamed = sketched.select(*[F.col(k).alias(f"of_{k}") for k in keys], "n", "cut")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    near = x.join(renamed, same) if keys else x.crossJoin(renamed)  # without keys the sketch is one row
    low = lambda i: F.when(F.lit(asked[names[i]] <= reach) | (F.col("n") <= ACCURACY), F.lit(float("-inf"))).otherwise(F.get("cut", F.lit(2 * i)))
    high = lambda i: F.when(F.lit(asked[names[i]] >= 1 - reach) | (F.col("n") <= ACCURACY), F.lit(float("inf"))).otherwise(F.get("cut", F.lit(2 * i + 1)))
    # one row a group and value within some bracket; all values below a bracket are one row
    slot = F.array(*[F.when(F.col("x") < low(i), F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("v"))).when(F.col("x") <= high(i), F.struct(F.lit(i).alias("i"), F.col("x").alias("v"))) for i in range(len(names))])
    counted = near.select(*_key(keys), "n", F.explode(F.array_compact(slot)).alias("s")).groupBy(*keys, "n", "s.i", "s.v").agg(F.count(F.lit(1)).alias("times"))
    held = counted.groupBy(*keys, "n", "i").agg(F.sum(F.when(F.col("v").isNull(), F.col("times")).otherwise(0)).alias("below"), F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("v", "times")))).alias("values"))
    share = F.element_at(F.array(*[F.lit(float(p)) for p in asked.values()]), F.col("i") + 1)
    # what a double makes of 0.9 * (n - 1) is the place that other engines take too
    place = share * (F.col("n") - 1) if how == "linear" else F.floor(share * F.col("n"))
    held = held.withColumn("place", F.least(place, F.col("n") - 1).cast("double"))

    def at(rank: Column) -> Column:
        found = F.aggregate("values", F.struct(F.col("below").cast("long").alias("seen"), F.lit(None).cast("double").alias("v")), lambda s, e: F.struct(
            (s["seen"] + e["times"]).cast("long").alias("seen"), F.when(s["v"].isNull() & (s["seen"] + e["times"] > rank), e["v"]).otherwise(s["v"]).alias("v")))
        inside = (rank >= F.col("below")) & found["v"].isNotNull()
        return F.when(inside, found["v"]).otherwise(F.raise_error(F.lit("a place lies outside its bracket")).cast("double"))

    lower = at(F.floor("place"))
    exact = lower + (at(F.ceil("place")) - lower) * (F.col("place") - F.floor("place")) if how == "linear" else lower
    done = held.select(*_key(keys), "n", "i", exact.alias("p"))
    picks = [F.max(F.when(F.col("i") == i, F.col("p"))).alias(n) for i, n in enumerate(names)]
    return done.groupBy(*keys, "n").agg(*picks) if keys else done.groupBy("n").agg(*picks)


def medians(rows: DataFrame, values: dict[str, Column]) -> dict[str, float | None]:
    """The exact median of each value over the rows where it is not null (none: None), as Spark's own gives it, of any number of rows:
    a pass for the sketches, one that counts what is below each bracket, and one for what lies in it, which is ranked by a sort."""
    reach, spans = 4 / COARSE, {}
    x = {k: v.cast("double") for k, v in values.items()}
    sketch = rows.agg(*[F.count(v).alias(f"n|{k}") for k, v in x.items()], *[F.percentile_approx(v, [0.5 - reach, 0.5 + reach], COARSE).alias(f"cut|{k}") for k, v in x.items()]).first()
    for k in x:
        if sketch[f"n|{k}"]:
            spans[k] = [float("-inf"), float("nan")] if sketch[f"n|{k}"] <= COARSE else sketch[f"cut|{k}"]  # not a number is above all
    if not spans:
        return dict.fromkeys(values)
    below = rows.agg(*[F.count(F.when(x[k] < low, 1)).alias(k) for k, (low, _) in spans.items()]).first()
    slot = F.array(*[F.when((x[k] >= low) & (x[k] <= high), F.struct(F.lit(k).alias("name"), x[k].alias("v"))) for k, (low, high) in spans.items()])
    near = rows.select(F.explode(F.array_compact(slot)).alias("s")).groupBy("s.name", "s.v").agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(Window.partitionBy("name").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    table = lambda x: F.create_map(*[F.lit(y) for pair in x.items() for y in pair])[F.col("name")]
    ranked = staged(near.select("name", "v", (upto + table({k: below[k] for k in spans})).alias("upto"), "times"), "median-ranks")
    at = lambda k: F.floor((table({name: sketch[f"n|{name}"] for name in spans}) - 1 + k) / 2)
    here = lambda k: F.max(F.when((F.col("upto") > at(k)) & (F.col("upto") - F.col("times") <= at(k)), F.col("v")))
    found = {r.name: (r.a, r.b) for r in ranked.groupBy("name").agg(here(0).alias("a"), here(1).alias("b")).collect()}
    out: dict[str, float | None] = dict.fromkeys(values)
    for k in spans:
        a, b = found.get(k, (None, None))
        if a is None or b is None:
            raise ArithmeticError(f"the median of {k} lies outside its bracket")
        out[k] = a if a == b else 0.5 * a + 0.5 * b
    return out
