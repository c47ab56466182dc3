"""Audits: constraints of a schema, counts, precision and recall, reconciliation, completion, pruning."""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidar.functions.digests import exactly


def constraint_gates(schema: dict[str, dict[str, Any]]) -> list[tuple[str, Column]]:
    """Failure predicates of a flat schema: column -> JSON-Schema keywords. A null value fails only
    `required`; keywords judge what is there."""
    out: list[tuple[str, Column]] = []
    for name, rules in schema.items():
        c, there = F.col(name), F.col(name).isNotNull()
        size = lambda col: F.length(col.cast("string"))
        if rules.get("required"):
            out.append((f"{name}.required", ~there))
        if "minimum" in rules or "maximum" in rules:
            low, high = rules.get("minimum"), rules.get("maximum")
            bad = F.lit(False)
            bad = bad | (c < low) if low is not None else bad
            bad = bad | (c > high) if high is not None else bad
            out.append((f"{name}.range", there & bad))
        if "exclusiveMinimum" in rules:
            out.append((f"{name}.exclusive_minimum", there & (c <= rules["exclusiveMinimum"])))
        if "exclusiveMaximum" in rules:
            out.append((f"{name}.exclusive_maximum", there & (c >= rules["exclusiveMaximum"])))
        if "enum" in rules:
            out.append((f"{name}.enum", there & ~c.isin(*rules["enum"])))
        if "const" in rules:
            out.append((f"{name}.const", there & (c != F.lit(rules["const"]))))
        if "pattern" in rules:
            out.append((f"{name}.pattern", there & ~c.rlike(rules["pattern"])))
        if "minLength" in rules:
            out.append((f"{name}.min_length", there & (size(c) < rules["minLength"])))
        if "maxLength" in rules:
            out.append((f"{name}.max_length", there & (size(c) > rules["maxLength"])))
        if "minItems" in rules:
            out.append((f"{name}.min_items", there & (F.size(c) < rules["minItems"])))
        if "maxItems" in rules:
            out.append((f"{name}.max_items", there & (F.size(c) > rules["maxItems"])))
        if rules.get("uniqueItems"):
            out.append((f"{name}.unique_items", there & (F.size(F.array_distinct(c)) != F.size(c))))
        if rules.get("type") == "integer":
            out.append((f"{name}.integer", there & (c != F.floor(c))))
    return out


def violations(rows: DataFrame, schema: dict[str, dict[str, Any]]) -> DataFrame:
    """rule, violations (more than 0) of a flat schema, counted in one pass."""
    gates = constraint_gates(schema)
    counted = rows.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(code) for code, p in gates])
    pairs = F.array(*[F.struct(F.lit(code).alias("rule"), F.col(f"`{code}`").alias("violations")) for code, _ in gates])
    return counted.select(F.explode(pairs).alias("p")).select("p.rule", "p.violations").where("violations > 0")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """The rule key.unique and how many rows repeat a key (null is no key)."""
    again = rows.where(F.col(key).isNotNull()).groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n"))
    return again.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit(f"{key}.unique").alias("rule"), "violations").where("violations > 0")


# JSON Schema of nested documents -------------------------------------------------------------

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def schema_errors(value: Any, schema: dict[str, Any] | bool, root: dict[str, Any] | None = None, path: str = "$") -> list[str]:
    """Errors (path and keyword) of a JSON value under a JSON Schema; unknown keywords say nothing. As the standard has it
    since 2019, 1.0 is an integer and keywords beside a $ref count too. A $ref is looked up in the schema itself only, and
    of formats date and date-time are checked."""
    import re
    from datetime import date, datetime

    if schema is True:
        return []
    if schema is False:
        return [f"{path}: false"]
    root = schema if root is None else root
    out: list[str] = []
    bad = lambda keyword: out.append(f"{path}: {keyword}")
    sub = lambda v, s, p=path: schema_errors(v, s, root, p)
    if "$ref" in schema:
        target: Any = root
        for step in schema["$ref"].removeprefix("#").strip("/").split("/"):
            target = target[step] if step else target
        out += sub(value, target)
    if "type" in schema:
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        if not any((k == "number" and number) or (k == "integer" and number and float(value).is_integer()) or (k in _TYPES and isinstance(value, _TYPES[k])) for k in kinds):
            bad("type")
            return out
    if "const" in schema and not exactly(value, schema["const"]):
        bad("const")
    if "enum" in schema and not any(exactly(value, e) for e in schema["enum"]):
        bad("enum")
    for keyword, wanted in (("allOf", "all"), ("anyOf", "any"), ("oneOf", "one")):
        if keyword in schema:
            fits = sum(not sub(value, s) for s in schema[keyword])
            if (wanted == "all" and fits < len(schema[keyword])) or (wanted == "any" and not fits) or (wanted == "one" and fits != 1):
                bad(keyword)
    if "not" in schema and not sub(value, schema["not"]):
        bad("not")
    if "if" in schema:
        branch = schema.get("else" if sub(value, schema["if"]) else "then")
        out += sub(value, branch) if branch is not None else []
    if isinstance(value, str):
        for keyword, fails in (("minLength", lambda n: len(value) < n), ("maxLength", lambda n: len(value) > n), ("pattern", lambda p: re.search(p, value) is None)):
            if keyword in schema and fails(schema[keyword]):
                bad(keyword)
        if schema.get("format") in ("date", "date-time"):
            try:
                date.fromisoformat(value) if schema["format"] == "date" else datetime.fromisoformat(value.replace("Z", "+00:00"))
            except ValueError:
                bad("format")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        for keyword, fails in (("minimum", lambda n: value < n), ("maximum", lambda n: value > n), ("exclusiveMinimum", lambda n: value <= n), ("exclusiveMaximum", lambda n: value >= n)):
            if keyword in schema and fails(schema[keyword]):
                bad(keyword)
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            bad("minItems")
        if len(value) > schema.get("maxItems", len(value)):
            bad("maxItems")
        if schema.get("uniqueItems") and any(exactly(a, b) for i, a in enumerate(value) for b in value[:i]):
            bad("uniqueItems")
        if "contains" in schema and not any(not sub(v, schema["contains"]) for v in value):
            bad("contains")
        if "items" in schema:
            for i, v in enumerate(value):
                out += sub(v, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        for name in schema.get("required", []):
            if name not in value:
                bad(f"required {name}")
        given = schema.get("properties", {})
        for name, v in value.items():
            if name in given:
                out += sub(v, given[name], f"{path}.{name}")
            elif "additionalProperties" in schema:
                out += sub(v, schema["additionalProperties"], f"{path}.{name}")
            if "propertyNames" in schema:
                out += sub(name, schema["propertyNames"], f"{path}.{name}")
    return out


def validate_json(rows: DataFrame, column: str, schema: dict[str, Any], name: str = "errors") -> DataFrame:
    """rows with the errors of JSON text under a schema; text that is no JSON has the error `json`."""

    @F.pandas_udf("array<string>")
    def check(text: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[str]:
            try:
                return schema_errors(json.loads(t), schema) if t is not None else ["$: json"]
            except ValueError:
                return ["$: json"]

        return text.map(one)

    return rows.withColumn(name, check(F.col(column)))


# counts and classes -------------------------------------------------------------------------


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by keys; a missing value is counted as unknown."""
    return rows.groupBy(*[F.coalesce(F.col(k).cast("string"), F.lit("unknown")).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))


def precision_recall(rows: DataFrame, truth: Column, said: Column) -> DataFrame:
    """One row: tp, fp, fn, tn, precision and recall (null without a denominator)."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    counts = rows.agg(n(truth & said).alias("tp"), n(~truth & said).alias("fp"), n(truth & ~said).alias("fn"), n(~truth & ~said).alias("tn"))
    share = lambda other: F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col(other)), 6)
    return counts.withColumn("precision", share("fp")).withColumn("recall", share("fn"))


def classify(rows: DataFrame, classes: list[tuple[str, Column]], rest: str, name: str = "class") -> DataFrame:
    """Exactly one class for each row: the first whose predicate holds, else the rest."""
    out = F.lit(rest)
    for label, predicate in reversed(classes):
        out = F.when(F.coalesce(predicate, F.lit(False)), label).otherwise(out)
    return rows.withColumn(name, out)


def quarantine(rows: DataFrame, key: str, kind: str) -> DataFrame:
    """rows with quarantined: the key is used with more than one kind."""
    kinds = rows.groupBy(key).agg((F.countDistinct(kind) > 1).alias("quarantined"))
    return rows.join(kinds, key)


def completion(checks: DataFrame) -> DataFrame:
    """One row over checks(check_id, passed): complete only if every check passed and there is one."""
    return checks.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.coalesce("passed", F.lit(False))).alias("passed"),
        F.coalesce(F.bool_and(F.coalesce("passed", F.lit(False))), F.lit(False)).alias("complete"),
        F.array_sort(F.collect_list(F.when(~F.coalesce("passed", F.lit(False)), F.col("check_id")))).alias("failed"))


def prune(items: DataFrame, keep: Column, aliases: DataFrame, sets: DataFrame) -> dict[str, DataFrame]:
    """Items that stay, their aliases, and the sets(set_id, item_id) that lose no member."""
    kept = items.where(F.coalesce(keep, F.lit(False)))
    ids = kept.select("item_id")
    broken = sets.join(ids, "item_id", "left_anti").select("set_id").distinct()
    return {"items": kept, "aliases": aliases.join(ids, "item_id", "left_semi"), "sets": sets.join(broken, "set_id", "left_anti")}
