"""Similarities between a target and a comparable. What is unknown never matches what is unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights, thresholds and ordered levels.
WEIGHTS = {
    "account_type": 15, "seasons": 22, "items_sets": 20, "map_completion": 10, "collection": 8,
    "resources": 7, "bindings": 6, "ownership": 4, "date": 5, "evidence": 3,
}
LEVELS = ("none", "low", "medium", "high", "very_high")
MIN_SCORE = 40.0
MIN_CONTENT_DIMENSIONS = 3
EXCLUSIVE_DIMENSIONS = ("account_type", "map_completion", "resources", "bindings", "ownership")


def known(value: Column, *more_unknown: str) -> Column:
    """Null for blank and for words that mean unknown."""
    text = F.trim(value.cast("string"))
    return F.when(~F.lower(text).isin("", "unknown", "null", "none", *more_unknown), text)


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two sets; 0 where either is empty or null."""
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.coalesce(F.when(both, F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))), F.lit(0.0))


def level_similarity(a: Column, b: Column) -> Column:
    """1 where equal; ordered levels lose a quarter for each step; else 0."""
    scale = F.array(*[F.lit(x) for x in LEVELS])
    i, j = F.array_position(scale, a), F.array_position(scale, b)
    return F.coalesce(F.when((a == "unknown") | (b == "unknown"), 0.0).when(a == b, 1.0).when((i > 0) & (j > 0), 1 - F.abs(i - j) / 4), F.lit(0.0))


def relative_similarity(a: Column, b: Column) -> Column:
    """1 less the difference as a share of the greater (at least 1); null where either is."""
    return F.when(a.isNotNull() & b.isNotNull(), 1 - F.least(F.abs(a - b) / F.greatest(a, b, F.lit(1.0)), F.lit(1.0)))


def mean_known(parts: list[Column]) -> Column:
    """Mean of the parts that are not null; null if all are."""
    values = F.array_compact(F.array(*parts))
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values))


def date_similarity(a: Column, b: Column) -> Column:
    return F.coalesce(1 - F.least(F.abs(F.datediff(a, b)), F.lit(365)) / 365, F.lit(0.0))


def status_map_similarity(a: Column, b: Column) -> Column:
    """Over the keys of either map: 1 for an equal known status, a half for two known ones that differ."""
    keys = F.array_union(F.map_keys(a), F.map_keys(b))

    def one(k: Column) -> Column:
        x, y = F.try_element_at(a, k), F.try_element_at(b, k)
        return F.coalesce(F.when((x != "unknown") & (y != "unknown"), F.when(x == y, 1.0).otherwise(0.5)), F.lit(0.0))

    total = F.aggregate(keys, F.lit(0.0), lambda s, k: s + one(k))
    return F.coalesce(F.when((F.size(a) > 0) & (F.size(b) > 0), total / F.size(keys)), F.lit(0.0))


def season_similarity(a: Column, b: Column, earliest_a: Column, earliest_b: Column) -> Column:
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.coalesce(F.when(both, F.least(F.lit(1.0), status_map_similarity(a, b) * 0.9 + level_similarity(earliest_a, earliest_b) * 0.1)), F.lit(0.0))


def known_map_similarity(a: Column, b: Column) -> Column:
    """Share of equal values among the keys known on both sides; null if there are none."""
    clean = lambda m: F.map_filter(m, lambda _, v: v.isNotNull() & ~v.isin("unknown", "mentioned_unknown"))
    shared = F.array_intersect(F.map_keys(clean(a)), F.map_keys(clean(b)))
    equal = F.size(F.filter(shared, lambda k: F.element_at(a, k) == F.element_at(b, k)))
    return F.when(F.size(shared) > 0, equal / F.size(shared))


def account_family(value: Column) -> Column:
    return (
        F.when(value.isin("wingless", "permanent_wingless", "crash_wingless"), "wingless")
        .when(value.isin("winged", "short_id", "special_appearance"), value)
        .otherwise("unknown")
    )


def weighted(dimensions: dict[str, Column], weights: dict[str, int]) -> dict[str, Column]:
    """Each dimension times its weight, rounded half to even at four digits before anything is added."""
    def rounded(value: Column) -> Column:
        return F.when(F.rint(value) == value, value).otherwise(F.bround(value, 4))  # most are whole, and rounding is dear

    return {k: rounded(dimensions[k] * F.lit(float(weights[k]))) for k in weights}


def total(parts: dict[str, Column]) -> Column:
    out = F.lit(0.0)
    for part in parts.values():
        out = out + part
    return F.bround(out, 4)


def may_total(dimensions: dict[str, Column], weights: dict[str, int], least: float) -> Column:
    """Whether total() can be so much: the sum before anything is rounded, with room for all that rounding adds. Cheap to ask first."""
    raw = F.lit(0.0)
    for k in weights:
        raw = raw + dimensions[k] * F.lit(float(weights[k]))
    return raw >= least - 1e-4 * (len(weights) + 1)


def describe(parts: dict[str, Column], known_flags: dict[str, Column], weights: dict[str, int], exclusive: tuple[str, ...], by: str | None = None) -> dict[str, Column]:
    """Names of dimensions that match, that surely differ (exclusive and known ones only), and the unconfirmed rest: arrays, or
    strings joined with by."""
    named = lambda conditions: [F.when(c, F.lit(k)) for k, c in conditions.items()]
    pick = lambda conditions: F.array_compact(F.array(*named(conditions))) if by is None else F.concat_ws(by, *named(conditions))
    low = {k: parts[k] <= weights[k] * 0.25 for k in weights}
    return {
        "major_matches": pick({k: parts[k] >= weights[k] * 0.75 for k in weights}),
        "major_differences": pick({k: low[k] & known_flags[k] for k in weights if k in exclusive}),
        "unconfirmed_dimensions": pick({k: ~known_flags[k] | (low[k] if k not in exclusive else F.lit(False)) for k in weights}),
    }
