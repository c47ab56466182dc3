"""Elastic net over long features with wide one-hot columns, and scoring and admission of rows in one join.

Features are rows (row_id, feature, value). A numeric feature is a standardised column and, where rows lack it, a standardised
indicator; a categorical one is a column of 0 and 1 for each of its values, with a value of its own for rows that lack it. The
sums of products are summed up cell by cell from what a row has, so no dense row is ever made: a cell for two
categories is how often they occur together. The medians are exact without a task that holds a feature.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidar.operators.modelling import NUMBER, column_types
from evidar.operators.selection import percentiles
from evidar.sources.stages import staged

ABSENT = "__unknown__"
#: Cells of the sums of products up to which they are solved in one place; beyond that each step is a join over them.
SOLVED_AT_ONCE = 4_000_000
#: Greatest change of a coefficient at which the steps end, and their greatest number: more raise.
TOLERANCE, SWEEPS = 1e-10, 100_000
# Rows that a model needs at least, of all and for each group of features.
LEAST_ROWS, ROWS_A_GROUP = 100, 10
# Fixed value: log prices outside are no prices.
LOG_BOUND = 700.0

_ONE, _Y = "1", "y"


def minimum_rows(features: DataFrame) -> Column:
    """As an aggregate over features: rows that their number of groups (names up to the first dot) asks for."""
    return F.greatest(F.lit(LEAST_ROWS), F.lit(ROWS_A_GROUP) * F.countDistinct(F.substring_index("feature", ".", 1)))


def _present(features: DataFrame) -> DataFrame:
    return features.where("value is not null and value <> 'unknown'")


def design(rows: DataFrame, features: DataFrame, row_id: str, target: str) -> tuple[DataFrame, DataFrame]:
    """entries (row_id, column, x) and about (feature, numeric, median, low, high, missing). Columns are 1 (of ones), y, n:<feature>,
    c:<feature>=<value>, and p:<feature> (1 where it is there) of features that some row lacks. What a row lacks is no
    entry: it is one minus what is there, which completed() puts in. rows: row_id and target, those without a target play no part."""
    rows = rows.where(F.col(target).isNotNull()).select(row_id, F.col(target).cast("double").alias("y"))
    given = staged(_present(features).join(rows.select(row_id), row_id, "left_semi"), "net-features")
    types = column_types(given).select("feature", "numeric")
    typed = staged(given.join(types, "feature").select(row_id, "feature", "value", "numeric", F.when(F.col("numeric"), F.col("value").try_cast("double")).alias("x")), "net-typed")
    numbers = typed.where("numeric")
    median = percentiles(numbers.select("feature", "x"), ["feature"], F.col("x"), {"median": 0.5})
    count = rows.count()
    about = typed.groupBy("feature").agg(F.first("numeric").alias("numeric"), F.min("x").alias("low"), F.max("x").alias("high"), (F.count(F.lit(1)) < count).alias("missing"))
    about = staged(about.join(median.select("feature", "median"), "feature", "left"), "net-about")
    partly = typed.join(about.where("missing").select("feature"), "feature", "left_semi")
    entries = (
        rows.select(row_id, F.lit(_ONE).alias("column"), F.lit(1.0).alias("x")).unionByName(rows.select(row_id, F.lit(_Y).alias("column"), F.col("y").alias("x")))
        .unionByName(numbers.select(row_id, F.concat(F.lit("n:"), "feature").alias("column"), "x"))
        .unionByName(typed.where("not numeric").select(row_id, F.concat(F.lit("c:"), "feature", F.lit("="), "value").alias("column"), F.lit(1.0).alias("x")))
        .unionByName(partly.select(row_id, F.concat(F.lit("p:"), "feature").alias("column"), F.lit(1.0).alias("x"))))
    return entries, about


def sparse_gram(entries: DataFrame, row_id: str) -> DataFrame:
    """left, right (left <= right) and sum of x * x over the rows that have both columns. A row's pairs are made from its own
    entries and added up in each task; a row has as many as it has features."""
    by_row = entries.groupBy(row_id).agg(F.collect_list(F.struct("column", "x")).alias("own"))
    pairs = by_row.select(F.explode("own").alias("a"), "own").select("a", F.explode(F.filter("own", lambda b: b["column"] >= F.col("a.column"))).alias("b"))
    return pairs.groupBy(F.col("a.column").alias("left"), F.col("b.column").alias("right")).agg(F.sum(F.col("a.x") * F.col("b.x")).alias("sum"))


def completed(gram: DataFrame, about: DataFrame) -> DataFrame:
    """The cells, both ways around, with absent numbers at their medians and columns m:<feature> (1 where a number is absent) and
    c:<feature>=__unknown__ in place of p:<feature>: a product with a thin matrix from either side."""
    both = gram.unionByName(gram.where("left <> right").select(F.col("right").alias("left"), F.col("left").alias("right"), "sum"))
    own = both.select(F.col("left").alias("from")).distinct().where("from not like 'p:%'").select("from", F.col("from").alias("to"), F.lit(1.0).alias("weight"))
    lacking = about.where("missing")
    name = lambda prefix: F.concat(F.lit(prefix), "feature")
    absent = F.when(F.col("numeric"), name("m:")).otherwise(F.concat(F.lit("c:"), "feature", F.lit(f"={ABSENT}")))
    out = [own]
    for source, sign in ((F.lit(_ONE), 1.0), (name("p:"), -1.0)):
        out.append(lacking.select(source.alias("from"), absent.alias("to"), F.lit(sign).alias("weight")))
        out.append(lacking.where("numeric").select(source.alias("from"), name("n:").alias("to"), (F.lit(sign) * F.col("median")).alias("weight")))
    matrix = staged(reduce(DataFrame.unionByName, out), "net-completion")
    for side in ("left", "right"):
        both = both.join(matrix, F.col(side) == F.col("from")).select(*(F.col("to").alias(c) if c == side else F.col(c) for c in ("left", "right")), (F.col("sum") * F.col("weight")).alias("sum"))
        both = both.groupBy("left", "right").agg(F.sum("sum").alias("sum"))
    return both


def standardised(gram: DataFrame, about: DataFrame) -> tuple[DataFrame, DataFrame, float, float]:
    """cells (left, right, g: mean product over both scales), columns (column, mean, scale, r: covariance with the target over the
    scale), the number of rows and the target's mean. Categories keep scale 1; columns that do not vary are none."""
    cells = staged(completed(gram, about), "net-cells")
    first = cells.where(F.col("left") == _ONE)
    found = {r.right: r.sum for r in first.where(F.col("right").isin(_ONE, _Y)).collect()}
    if not found:
        raise ValueError("no rows")
    n, y_mean = found[_ONE], found[_Y] / found[_ONE]
    means = first.where(~F.col("right").isin(_ONE, _Y)).select(F.col("right").alias("column"), (F.col("sum") / n).alias("mean"))
    squares = cells.where(F.col("left") == F.col("right")).select(F.col("left").alias("column"), (F.col("sum") / n).alias("square"))
    cross = cells.where(F.col("right") == _Y).select(F.col("left").alias("column"), (F.col("sum") / n).alias("cross"))
    deviation = F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    columns = means.join(squares, "column").join(cross, "column", "left").withColumn("deviation", deviation).where("deviation > 1e-12")
    scale = F.when(F.col("column").startswith("c:"), 1.0).otherwise(F.col("deviation"))
    columns = columns.select("column", "mean", scale.alias("scale"), ((F.coalesce("cross", F.lit(0.0)) - F.col("mean") * y_mean) / scale).alias("r"))
    columns = staged(columns, "net-columns")
    side = lambda k: columns.select(F.col("column").alias(k), F.col("scale").alias(f"{k}_scale"))
    # the product of means, which would fill every cell, is subtracted where the cells are used
    scaled = cells.join(side("left"), "left").join(side("right"), "right").select("left", "right", (F.col("sum") / n / F.col("left_scale") / F.col("right_scale")).alias("g"))
    return staged(scaled, "net-scaled"), columns, float(n), float(y_mean)


def _descend(g: np.ndarray, r: np.ndarray, alpha: float, l1: float) -> np.ndarray:
    """Coordinate descent; g: covariances of the columns."""
    w, gw = np.zeros(len(r)), np.zeros(len(r))
    diagonal = np.diag(g)
    for _ in range(SWEEPS):
        change = 0.0
        for j in range(len(r)):
            rho = r[j] - gw[j] + diagonal[j] * w[j]
            new = math.copysign(max(abs(rho) - alpha * l1, 0.0), rho) / (diagonal[j] + alpha * (1 - l1))
            if new != w[j]:
                gw += g[:, j] * (new - w[j])
                change, w[j] = max(change, abs(new - w[j])), new
        if change < TOLERANCE:
            return w
    raise ArithmeticError(f"not solved after {SWEEPS} sweeps")


def _steps(cells: DataFrame, columns: DataFrame, alpha: float, l1: float) -> DataFrame:
    """column and w by accelerated proximal gradient steps, each a join of the cells with the coefficients."""
    m = F.col("mean") / F.col("scale")
    bound = cells.groupBy("left").agg(F.sum(F.abs("g")).alias("s")).agg(F.max("s")).first()[0] or 1.0
    bound = float(bound) + alpha * (1 - l1)
    state = staged(columns.select("column", "r", m.alias("m"), F.lit(0.0).alias("w"), F.lit(0.0).alias("v")), "net-state")
    t = 1.0
    for _ in range(SWEEPS):
        centre = float(state.agg(F.sum(F.col("m") * F.col("v"))).first()[0] or 0.0)
        product = cells.join(state.select(F.col("column").alias("right"), "v"), "right").groupBy(F.col("left").alias("column")).agg(F.sum(F.col("g") * F.col("v")).alias("gv"))
        slope = F.coalesce("gv", F.lit(0.0)) - F.col("m") * centre + F.col("v") * (alpha * (1 - l1)) - F.col("r")
        moved = F.col("v") - slope / bound
        shrunk = F.signum(moved) * F.greatest(F.abs(moved) - alpha * l1 / bound, F.lit(0.0))
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        stepped = state.join(product, "column", "left").withColumn("new", shrunk)
        state = staged(stepped.select("column", "r", "m", F.col("new").alias("w"), (F.col("new") + (t - 1) / after * (F.col("new") - F.col("w"))).alias("v"), F.abs(F.col("new") - F.col("w")).alias("d")), "net-state")
        t = after
        if (state.agg(F.max("d")).first()[0] or 0.0) < TOLERANCE:
            return state.select("column", "w")
    raise ArithmeticError(f"not solved after {SWEEPS} steps")


def fit(rows: DataFrame, features: DataFrame, row_id: str, target: str, alpha: float, l1: float, at_once: int = SOLVED_AT_ONCE) -> tuple[float, DataFrame, DataFrame]:
    """Intercept, terms (column, coefficient, mean, scale) and about (feature, numeric, median, low, high, missing) of an elastic
    net: the least of 1/2n |y - Xw - b|^2 + alpha (l1 |w|_1 + (1 - l1)/2 |w|^2)."""
    entries, about = design(rows, features, row_id, target)
    cells, columns, _, y_mean = standardised(sparse_gram(entries, row_id), about)
    spark = rows.sparkSession
    width = columns.count()
    if width * width <= at_once:
        own = columns.orderBy("column").collect()
        place = {c.column: k for k, c in enumerate(own)}
        g, m = np.zeros((width, width)), np.array([c.mean / c.scale for c in own])
        for cell in cells.collect():
            g[place[cell.left], place[cell.right]] = cell.g
        w = _descend(g - np.outer(m, m), np.array([c.r for c in own]), alpha, l1)
        solved = spark.createDataFrame([(c.column, float(x)) for c, x in zip(own, w)], "column string, w double")
    else:
        solved = _steps(cells, columns, alpha, l1)
    terms = staged(columns.join(solved, "column").select("column", F.col("w").alias("coefficient"), "mean", "scale"), "net-terms")
    # columns are centred, those of categories too: their means go into the intercept
    shift = terms.where(F.col("column").startswith("c:")).agg(F.sum(F.col("coefficient") * F.col("mean"))).first()[0] or 0.0
    return y_mean - float(shift), terms, about


def score(rows: DataFrame, features: DataFrame, row_id: str, intercept: float, terms: DataFrame, about: DataFrame) -> DataFrame:
    """row_id, log_price and violation of each row: the first feature, numbers before categories and then by name, that lies
    outside what the model has seen; such a row has no price. One join with the features that a row has: what a row without any
    would score is known beforehand, and each feature adds what it changes."""
    part = lambda prefix: terms.where(F.col("column").startswith(prefix)).select(F.expr(f"substring(column, {len(prefix) + 1})").alias("name"), *terms.columns[1:])
    n, m, c = part("n:"), part("m:"), part("c:")
    line = about.join(n.select(F.col("name").alias("feature"), F.col("coefficient").alias("slope"), F.col("mean").alias("centre"), F.col("scale").alias("width")), "feature", "left").join(
        m.select(F.col("name").alias("feature"), F.col("coefficient").alias("step"), F.col("mean").alias("share"), F.col("scale").alias("spread")), "feature", "left")
    unknown = c.where(F.endswith("name", F.lit(f"={ABSENT}"))).select(F.expr(f"left(name, length(name) - {len(ABSENT) + 1})").alias("feature"), F.col("coefficient").alias("unsaid"))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    value_at = lambda x: zero(F.col("slope") * (x - F.col("centre")) / F.col("width"))
    flag_at = lambda x: zero(F.col("step") * (F.lit(x) - F.col("share")) / F.col("spread"))
    line = line.join(unknown, "feature", "left")
    line = line.withColumn("absent", F.when(F.col("numeric"), value_at(F.col("median")) + flag_at(1.0)).otherwise(zero(F.col("unsaid"))))
    line = line.withColumn("place", F.concat(F.when(F.col("numeric"), "0").otherwise("1"), "feature"))
    line = staged(line, "net-line")
    base = line.agg(F.sum("absent").alias("sum"), F.array_sort(F.collect_list(F.when(~F.col("missing"), F.col("place")))).alias("needed"))
    given = _present(features).select(row_id, "feature", "value").join(line, "feature")
    number = F.when(F.col("value").rlike(NUMBER), F.col("value").try_cast("double"))
    there = F.when(F.col("numeric"), number.isNotNull()).otherwise(True)
    given = given.where(there).withColumn("name", F.when(~F.col("numeric"), F.concat("feature", F.lit("="), "value")))
    known = c.select(F.col("name").alias("known"), F.col("coefficient").alias("weight"))
    given = given.join(known, F.col("name") == F.col("known"), "left")
    change = F.when(F.col("numeric"), value_at(number) + flag_at(0.0)).otherwise(zero(F.col("weight"))) - F.col("absent")
    outside = F.when(F.col("numeric"), (number < F.col("low")) | (number > F.col("high"))).otherwise(F.col("known").isNull())
    sums = given.groupBy(row_id).agg(F.sum(change).alias("change"), F.min(F.when(outside, F.col("place"))).alias("outside"), F.collect_set("place").alias("places"))
    every = rows.select(row_id).join(sums, row_id, "left").crossJoin(F.broadcast(base))  # base is one row
    lacking = F.array_min(F.array_except("needed", F.coalesce("places", F.array().cast("array<string>"))))
    first = F.least("outside", lacking)
    code = F.when(first.isNull(), None).when(F.coalesce(first == F.col("outside"), F.lit(False)), F.concat(F.lit("out_of_distribution:"), F.expr("substring(outside, 2)"))).otherwise(
        F.concat(F.lit("out_of_distribution:missing_unobserved:"), F.substring(lacking, F.lit(2), F.length(lacking))))
    log_price = F.lit(intercept) + zero(F.col("sum")) + zero(F.col("change"))
    code = F.coalesce(code, F.when(F.isnan(log_price) | (F.abs(log_price) > LOG_BOUND), "out_of_distribution:nonfinite_or_overflow_prediction"))
    return every.select(row_id, F.when(code.isNull(), log_price).alias("log_price"), code.alias("violation"))
