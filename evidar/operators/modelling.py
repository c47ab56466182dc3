"""Price models: long features, column types, folds, elastic net, portable scoring, bootstrap, ensembles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.operators import selection
from evidar.operators.splits import grouped_folds
from evidar.sources.stages import staged

# The grid, and draws and seeds of the resampling.
ALPHAS, L1_RATIOS = (0.01, 0.03, 0.1, 0.3, 1.0), (0.1, 0.5, 0.9)
CI_SEED, CI_DRAWS, STABILITY_SEED, STABILITY_DRAWS = 1729, 400, 20260816, 500
MIN_LINEAR_ROWS, MIN_TREE_ROWS = 100, 300
# Lines that models price.
PRICE_LINES = ("normal_listing", "urgent_sale")
#: What counts as a number: not the words that a cast would take for one, as NaN and Infinity.
NUMBER = r"^[ \t]*[-+]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?[ \t]*$"


def long_features(rows: DataFrame, row_id: str, scalars: dict[str, Column], arrays: dict[str, tuple[Column, str, list[str]]] | None = None) -> DataFrame:
    """row_id, feature, value (text): scalars by name (null is no feature) and arrays of structs keyed by
    a stable id, each field as name.<id>.field; an empty array is name=__empty__."""
    pairs = [F.struct(F.lit(n).alias("feature"), c.cast("string").alias("value")) for n, c in scalars.items()]
    out = rows.select(row_id, F.explode(F.array(*pairs)).alias("p")).select(row_id, "p.feature", "p.value").where("value is not null")
    for name, (column, key, fields) in (arrays or {}).items():
        empty = rows.where(F.size(column) == 0).select(row_id, F.lit(name).alias("feature"), F.lit("__empty__").alias("value"))
        entries = rows.select(row_id, F.explode(column).alias("e"))
        parts = F.array(*[F.struct(F.concat(F.lit(f"{name}."), F.col(f"e.{key}").cast("string"), F.lit(f".{f}")).alias("feature"), F.col(f"e.{f}").cast("string").alias("value")) for f in fields])
        out = out.unionByName(empty).unionByName(entries.select(row_id, F.explode(parts).alias("p")).select(row_id, "p.feature", "p.value").where("value is not null"))
    return out


def column_types(features: DataFrame) -> DataFrame:
    """feature, numeric (all present values but unknown are numbers), n."""
    number = F.col("value").rlike(NUMBER) & F.col("value").try_cast("double").isNotNull()
    present = F.col("value") != "unknown"
    return features.groupBy("feature").agg(F.coalesce(F.bool_and(F.when(present, number)), F.lit(False)).alias("numeric"), F.count(F.lit(1)).alias("n"))


def sparse_vector(features: DataFrame, row_id: str) -> DataFrame:
    """row_id, feature, value (number): numbers as they are, a category k=v as 1 under the name k=v."""
    typed = features.join(F.broadcast(column_types(features)), "feature")
    return typed.where("value <> 'unknown'").select(
        row_id, F.when(F.col("numeric"), F.col("feature")).otherwise(F.concat_ws("=", "feature", "value")).alias("feature"),
        F.when(F.col("numeric"), F.col("value").try_cast("double")).otherwise(1.0).alias("value"))


class ElasticNet:
    """Elastic net by coordinate descent on the Gram matrix, which one pass over the rows sums up.

    Minimises 1/2n |y - Xw - b|^2 + alpha (l1 |w|_1 + (1 - l1)/2 |w|^2) over columns standardised with
    the population deviation. Missing values are the column's median, with an indicator column.
    """

    def __init__(self, columns: list[str], target: str):
        self.columns, self.target = columns, target

    def _moments(self, rows: DataFrame, medians: dict[str, float]) -> tuple[np.ndarray, list[str]]:
        """Sums of products of (1, columns, indicators, target): a row of the matrix for each task, summed."""
        columns, target = self.columns, self.target
        fill = np.array([medians[c] for c in columns])
        size = 2 * len(columns) + 2

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((size, size))
            for batch in batches:
                x = batch[columns].to_numpy(float)
                missing = np.isnan(x)
                z = np.column_stack([np.ones(len(x)), np.where(missing, fill, x), missing, batch[target].to_numpy(float)])
                total += z.T @ z
            yield pd.DataFrame({"cell": np.arange(size * size), "v": total.ravel()})

        given = rows.select(*[F.col(c).cast("double") for c in columns], F.col(target).cast("double"))
        sums = given.mapInPandas(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(size * size)
        for r in sums:
            out[r.cell] = r.v
        return out.reshape(size, size), columns + [f"{c}__missing" for c in columns]

    def filled(self, moments: np.ndarray, medians: dict[str, float]) -> tuple[np.ndarray, list[str]]:
        """The sums of products with missing values as these medians, from those with missing values as 0."""
        k, change = len(self.columns), np.eye(len(moments))
        change[np.arange(1, k + 1), np.arange(k + 1, 2 * k + 1)] = [medians[c] for c in self.columns]
        return change @ moments @ change.T, self.columns + [f"{c}__missing" for c in self.columns]

    def fold_moments(self, rows: DataFrame, folds: int) -> list[np.ndarray]:
        """Sums of products of each fold, missing values as 0; one pass, summed in each task."""
        columns, target, size = self.columns, self.target, 2 * len(self.columns) + 2

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((folds, size, size))
            for batch in batches:
                x = batch[columns].to_numpy(float)
                z = np.column_stack([np.ones(len(x)), np.nan_to_num(x), np.isnan(x), batch[target].to_numpy(float)])
                for k in range(folds):
                    own = z[batch["fold"].to_numpy() == k]
                    total[k] += own.T @ own
            yield pd.DataFrame({"cell": np.arange(total.size), "v": total.ravel()})

        given = rows.select("fold", *[F.col(c).cast("double") for c in columns], F.col(target).cast("double"))
        sums = given.mapInPandas(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(folds * size * size)
        for r in sums:
            out[r.cell] = r.v
        return list(out.reshape(folds, size, size))

    def medians(self, rows: DataFrame) -> dict[str, float]:
        found = selection.medians(rows, {c: F.col(c) for c in self.columns})
        return {c: float(found[c] or 0.0) for c in self.columns}

    def fit(self, rows: DataFrame, alpha: float, l1: float) -> dict:
        medians = self.medians(rows)
        moments, names = self._moments(rows, medians)
        return self.solve(moments, names, medians, alpha, l1)

    @staticmethod
    def solve(moments: np.ndarray, names: list[str], medians: dict[str, float], alpha: float, l1: float) -> dict:
        n = moments[0, 0]
        if n == 0:
            raise ValueError("no rows")
        mean, y_mean = moments[0, 1:-1] / n, moments[0, -1] / n
        cov = moments[1:-1, 1:-1] / n - np.outer(mean, mean)
        cross = moments[1:-1, -1] / n - mean * y_mean
        scale = np.sqrt(np.maximum(np.diag(cov), 0))
        use = scale > 1e-12
        safe = np.where(use, scale, 1.0)
        gram, right = cov / np.outer(safe, safe), cross / safe
        w = np.zeros(len(names))
        for _ in range(5000):
            change = 0.0
            for j in np.flatnonzero(use):
                rho = right[j] - gram[j] @ w + gram[j, j] * w[j]
                new = math.copysign(max(abs(rho) - alpha * l1, 0.0), rho) / (gram[j, j] + alpha * (1 - l1))
                change, w[j] = max(change, abs(new - w[j])), new
            if change < 1e-10:
                break
        return {"intercept": y_mean, "columns": [
            {"name": c, "coefficient": float(w[i]), "mean": float(mean[i]), "scale": float(safe[i]), "median": medians.get(c, 0.0)} for i, c in enumerate(names)]}


def portable_score(rows: DataFrame, model: dict) -> Column:
    """The model's prediction as column arithmetic over rows: sum of coefficient times standardised value."""
    out = F.lit(float(model["intercept"]))
    for c in model["columns"]:
        name = c["name"]
        value = F.col(name.removesuffix("__missing")).isNull().cast("double") if name.endswith("__missing") else F.coalesce(F.col(name).cast("double"), F.lit(c["median"]))
        out = out + F.lit(c["coefficient"]) * (value - F.lit(c["mean"])) / F.lit(c["scale"])
    return out


def nested_cv(rows: DataFrame, net: ElasticNet, group: str, folds: int = 5, grid: tuple = tuple((a, l1) for a in ALPHAS for l1 in L1_RATIOS), least: int = MIN_LINEAR_ROWS) -> dict:
    """Mean absolute error on rows that took no part in the choice of the grid point nor in the fit, beside the median's;
    groups stay together. For each fold the point is chosen by squared error over the other folds, one left out at a
    time, from their sums of products; these come from one pass. alpha and l1_ratio are the choice over all folds, missing
    values at the medians of all rows. With fewer than least rows nothing is fitted: only rows is told."""
    folded = staged(grouped_folds(rows, group, folds), "cv-folds")
    n = folded.count()
    if n < least:
        return {"rows": n, "alpha": None, "l1_ratio": None, "mae": None, "baseline_mae": None, "beats_baseline": None}
    sums = net.fold_moments(folded, folds)
    outside = selection.medians(folded, {f"{c}|{k}": F.when(F.col("fold") != k, F.col(c)) for c in (*net.columns, net.target) for k in range(folds)} | {c: F.col(c) for c in net.columns})
    medians = [{c: float(outside[f"{c}|{k}"] or 0.0) for c in net.columns} for k in range(folds)]

    def choice(inner: list[int], fills: dict[str, float]) -> tuple[float, float]:
        miss = np.zeros(len(grid))
        for j in inner:
            train, names = net.filled(sum(sums[i] for i in inner if i != j), fills)
            left_out, _ = net.filled(sums[j], fills)
            miss += [squared_error(left_out, net.solve(train, names, fills, *point)) for point in grid]
        return grid[int(np.argmin(miss))]

    errors, every = [], range(folds)
    for k in every:
        inner = [i for i in every if i != k]
        train, names = net.filled(sum(sums[i] for i in inner), medians[k])
        model = net.solve(train, names, medians[k], *choice(inner, medians[k]))
        here = F.col("fold") == k
        errors += [F.sum(F.when(here, F.abs(F.col(net.target) - portable_score(folded, model)))).alias(f"e{k}"),
                   F.sum(F.when(here, F.abs(F.col(net.target) - F.lit(float(outside[f"{net.target}|{k}"] or 0.0))))).alias(f"b{k}")]
    found = folded.agg(F.count(F.lit(1)).alias("n"), *errors).first()
    mae, base = (sum(found[f"{c}{k}"] or 0.0 for k in every) / found.n for c in "eb")
    alpha, l1 = choice(list(every), {c: float(outside[c] or 0.0) for c in net.columns})
    return {"rows": found.n, "alpha": alpha, "l1_ratio": l1, "mae": mae, "baseline_mae": base, "beats_baseline": mae < base}


def squared_error(moments: np.ndarray, model: dict) -> float:
    """Sum of squared errors of a model over the rows whose sums of products these are."""
    w = np.array([c["coefficient"] / c["scale"] for c in model["columns"]])
    v = np.concatenate(([model["intercept"] - w @ [c["mean"] for c in model["columns"]]], w, [-1.0]))
    return float(v @ moments @ v)


def _uniform(rows: np.ndarray, draws: int, seed: int) -> np.ndarray:
    """A number in (0, 1) for each row (named by a number) and draw, from a hash of both."""
    z = rows.astype(np.uint64)[:, None] + (np.arange(draws, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))).astype(float) + 0.5) / 2.0**64


def _weights(rows: np.ndarray, times: np.ndarray, draws: int, seed: int) -> np.ndarray:
    """How often a value that occurs so many times is in each resample: Poisson of that mean, by a normal from 64 on."""
    u, out = _uniform(rows, draws, seed), np.zeros((len(rows), draws))
    for n in np.unique(times):
        own = times == n
        if n < 64:
            chances = np.exp(-n + np.arange(200) * math.log(n) - np.array([math.lgamma(k + 1) for k in range(200)]))
            out[own] = np.searchsorted(np.cumsum(chances), u[own])
        else:
            angle = 2 * math.pi * _uniform(rows[own], draws, seed + draws)
            out[own] = np.maximum(0, np.round(n + math.sqrt(n) * np.sqrt(-2 * np.log(u[own])) * np.cos(angle)))
    return out


def resampled_means(rows: DataFrame, keys: list[str], value: str, seed: int, draws: int) -> DataFrame:
    """keys, n, mean and means (of every resample, sorted) of each key. Every value has its own Poisson weight in each
    resample, the same however rows are dealt, so tasks add up two sums a resample and hold no group."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("times"))
    given = counted.withColumn("row", F.xxhash64(*keys, "v"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 5_000):
                for key, part in batch.iloc[at : at + 5_000].groupby(keys, dropna=False, sort=False):
                    times, v = part["times"].to_numpy(), part["v"].to_numpy()
                    w = _weights(part["row"].to_numpy(np.int64), times, draws, seed)
                    out = pd.DataFrame({"draw": np.arange(-1, draws), "w": np.append(times.sum(), w.sum(0)), "wv": np.append(times @ v, v @ w)})
                    yield out.assign(**dict(zip(keys, key)))[[*keys, "draw", "w", "wv"]]

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    sums = given.mapInPandas(draw, f"{kinds}, draw int, w double, wv double").groupBy(*keys, "draw").agg(F.sum("w").alias("w"), F.sum("wv").alias("wv"))
    whole = F.col("draw") == -1
    return sums.groupBy(*keys).agg(F.max(F.when(whole, F.col("w"))).cast("long").alias("n"), F.max(F.when(whole, F.col("wv") / F.col("w"))).alias("mean"),
                                   F.array_sort(F.collect_list(F.when(~whole & (F.col("w") > 0), F.col("wv") / F.col("w")))).alias("means"))


def bootstrap_ci(rows: DataFrame, keys: list[str], value: str, seed: int = CI_SEED, draws: int = CI_DRAWS) -> DataFrame:
    """keys, n, mean and 2.5/97.5 % bounds of resampled means for each key."""
    at = lambda share: F.get("means", F.floor(F.lit(share) * (F.size("means") - 1)).cast("int"))
    return resampled_means(rows, keys, value, seed, draws).select(*keys, "n", "mean", at(0.025).alias("low"), at(0.975).alias("high"))


def sign_stability(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n and the share of resampled means that have the sign of the mean."""
    same = F.size(F.filter("means", lambda m: F.signum(m) == F.signum("mean"))) / F.size("means")
    return resampled_means(rows, keys, value, STABILITY_SEED, STABILITY_DRAWS).select(*keys, "n", same.alias("stability"))


def top_drivers(contributions: DataFrame, row_id: str, k: int = 10) -> DataFrame:
    """The k contributions(row_id, feature, contribution) of greatest size of each row."""
    order = Window.partitionBy(row_id).orderBy(F.desc(F.abs("contribution")), "feature")
    return contributions.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def out_of_domain(features: DataFrame, domain: DataFrame, row_id: str) -> DataFrame:
    """row_id and first violation (by the domain's ordinal) of features(row_id, feature, value) outside
    domain(feature, ordinal, low, high, categories, observed_missing)."""
    asked = features.select(row_id).distinct().crossJoin(F.broadcast(domain))
    joined = asked.join(features, [row_id, "feature"], "left")
    number = F.col("value").try_cast("double")
    code = (
        F.when(F.col("value").isNull() & ~F.col("observed_missing"), "missing_unobserved")
        .when(F.col("low").isNotNull() & ((number < F.col("low")) | (number > F.col("high"))), "numeric_out_of_range")
        .when(F.col("categories").isNotNull() & F.col("value").isNotNull() & ~F.array_contains("categories", F.col("value")), "category_unseen"))
    return joined.withColumn("code", code).groupBy(row_id).agg(F.min_by(F.when(F.col("code").isNotNull(), F.concat_ws(":", "code", "feature")), F.when(F.col("code").isNotNull(), F.col("ordinal"))).alias("violation"))


def ensemble(predictions: DataFrame, row_id: str) -> DataFrame:
    """Inverse-error mean of predictions(row_id, log_price, mae) on the log scale, with exp(x -/+ mean error).
    A model without a positive error has no weight; without any the row has no price."""
    usable = F.col("log_price").isNotNull() & (F.col("mae") > 0)
    weight = F.when(usable, 1 / F.col("mae"))
    joined = predictions.groupBy(row_id).agg((F.sum(weight * F.col("log_price")) / F.sum(weight)).alias("log_price"), (F.sum(weight * F.col("mae")) / F.sum(weight)).alias("mae"), F.count(weight).alias("models"))
    price = F.exp("log_price")
    return joined.select(row_id, "models", price.alias("price"), F.exp(F.col("log_price") - F.col("mae")).alias("low"), F.exp(F.col("log_price") + F.col("mae")).alias("high"),
                         F.when(F.col("models") > 0, "estimated").otherwise("insufficient_training_data").alias("status"))


def model_estimates(rows: DataFrame, predictions: DataFrame, row_id: str, fallback: DataFrame | None = None) -> DataFrame:
    """row_id, status, low, point, high, models, reasons and comparables of each of rows(row_id, price_line, gate_reasons).

    ineligible_input: the line is none that models price, or a gate has a reason; estimated: a model has a price and an error;
    else out_of_distribution if a model says so, else insufficient_training_data. predictions: row_id, log_price, mae,
    train_only (its error was held back by the evaluator and counts as 1), reasons, residual_low and residual_high (of one
    that is used alone). fallback: row_id and comparables, which stand beside every status."""
    lines = F.coalesce(F.col("price_line").isin(*PRICE_LINES), F.lit(False))
    open_ = lines & (F.size(F.coalesce("gate_reasons", F.array().cast("array<string>"))) == 0)
    error = F.when(F.col("mae") > 0, F.col("mae")).when(F.coalesce("train_only", F.lit(False)), 1.0)
    given = predictions.withColumn("error", error).withColumn("used", F.col("log_price").isNotNull() & F.col("error").isNotNull())
    weight = F.when(F.col("used"), 1 / F.col("error"))
    said = F.when(F.col("log_price").isNull(), F.col("reasons")).when(~F.col("used"), F.array(F.lit("nonpositive_outer_cv_mae")))
    alone = lambda c: F.max(F.when(F.col("used"), F.col(c)))
    joined = given.groupBy(row_id).agg(
        F.count(weight).alias("models"), (F.sum(weight * F.col("log_price")) / F.sum(weight)).alias("log_price"), (F.sum(weight * F.col("error")) / F.sum(weight)).alias("mae"),
        alone("residual_low").alias("residual_low"), alone("residual_high").alias("residual_high"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(said)))).alias("said"))
    none = F.array().cast("array<string>")
    out = rows.join(joined, row_id, "left").withColumn("models", F.when(open_, F.coalesce("models", F.lit(0))).otherwise(0))
    outside = F.exists(F.coalesce("said", none), lambda r: F.startswith(r, F.lit("out_of_distribution:")))
    status = F.when(~open_, "ineligible_input").when(F.col("models") > 0, "estimated").when(outside, "out_of_distribution").otherwise("insufficient_training_data")
    point = F.greatest(F.lit(1.0), F.exp("log_price"))
    residual = (F.col("models") == 1) & F.col("residual_low").isNotNull() & F.col("residual_high").isNotNull()
    low = F.when(residual, F.least(point, F.greatest(F.lit(1.0), point + F.col("residual_low")))).otherwise(F.exp(F.col("log_price") - F.col("mae")))
    high = F.when(residual, F.greatest(point, point + F.col("residual_high"))).otherwise(F.exp(F.col("log_price") + F.col("mae")))
    reasons = F.when(~lines, F.array(F.lit("unsupported_price_line"))).when(~open_, F.col("gate_reasons")).when(
        F.col("models") > 0, none).otherwise(F.concat(F.array(F.lit("no_verified_usable_model_artifact")), F.coalesce("said", none)))
    priced = lambda c: F.when(status == "estimated", F.round(c, 2))
    out = out.select(row_id, status.alias("status"), priced(low).alias("low"), priced(point).alias("point"), priced(high).alias("high"), "models", reasons.alias("reasons"))
    return out if fallback is None else out.join(fallback.select(row_id, "comparables"), row_id, "left")


def item_values(states: DataFrame, prices: DataFrame, account: str, refit_folds: Column | None = None) -> DataFrame:
    """Tallies of states(account, item_id, state) per item with the difference of mean log prices of owners
    and others; eligible only with 10 owners and 10 missing and at least two refits (none unless given)."""
    joined = states.join(prices, account, "left")
    n = lambda s: F.count_if(F.col("state") == s)
    mean = lambda s: F.avg(F.when(F.col("state") == s, F.ln("price")))
    folds = F.lit(0) if refit_folds is None else refit_folds
    out = joined.groupBy("item_id").agg(n("owned").alias("owned"), n("confirmed_missing").alias("missing"), n("unknown").alias("unknown"),
                                        F.count_if((F.col("state") == "confirmed_missing") & F.col("price").isNotNull()).alias("supported_missing"), (mean("owned") - mean("confirmed_missing")).alias("log_difference"))
    return out.withColumn("eligible", (F.col("owned") >= 10) & (F.col("supported_missing") >= 10) & (folds >= 2))
