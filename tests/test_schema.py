"""Compiled schemas against the plain validator over random documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from evidar.functions.schema import schema_errors
from evidar.operators import audit

SCHEMA = {
    "type": "object", "required": ["a", "kind"], "additionalProperties": False, "propertyNames": {"maxLength": 5, "pattern": "^[a-z]+$"},
    "properties": {
        "a": {"type": ["integer", "null"], "minimum": 0, "exclusiveMaximum": 10}, "kind": {"enum": ["x", "y", 1, None, {"q": [1]}]},
        "list": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "contains": {"const": 1}, "items": {"type": ["number", "string"]}},
        "when": {"type": "string", "format": "date", "minLength": 3}, "n": {"oneOf": [{"type": "integer"}, {"type": "number", "minimum": 2}]},
        "any": {"anyOf": [{"const": True}, {"type": "string", "maxLength": 2}]}, "deep": {"$ref": "#/$defs/deep"}, "other": {"not": {"type": "string"}}, "both": {"allOf": [{"minimum": 1}, {"maximum": 3}]},
    },
    "if": {"properties": {"kind": {"const": "x"}}}, "then": {"required": ["n"]}, "else": {"properties": {"a": {"type": "integer"}}},
    "$defs": {"deep": {"type": "object", "properties": {"w": {"type": "object", "properties": {"z": {"type": "array", "items": {"type": "object", "required": ["k"], "additionalProperties": {"type": "boolean"}}}}}}}},
}
VALUES = [0, 1, 1.0, 2.5, -1, 11, None, True, "x", "y", "abc", "2024-02-29", "2023-02-29", [], [1], [1, 1], [1, 1.0, "a", None], [1, "1"], {}, {"q": [1]}, {"w": {"z": [{"k": True}, {"k": 1, "m": "no"}, {}, 5]}}, {"w": 3}]


def documents(n=500):
    rng = random.Random(7)
    out = [rng.choice(VALUES) for _ in range(20)]
    for _ in range(n):
        names = rng.sample([*SCHEMA["properties"], "zzz", "tooLong", "UP"], rng.randint(0, 8))
        out.append({k: rng.choice(VALUES) for k in names} | ({"a": 3, "kind": "x"} if rng.random() < 0.6 else {}))
    good = {"list": [1, "b"], "when": "2024-02-29", "n": 1.5 + 2, "any": True, "deep": {"w": {"z": [{"k": True}]}}, "other": 5, "both": 2}
    out += [{"a": 3, "kind": rng.choice(["x", "y", 1]), "n": 4.5} | {k: good[k] for k in rng.sample(list(good), rng.randint(0, 6))} for _ in range(40)]
    return out


def test_random_documents(spark):
    docs = documents()
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, j string")
    got = {r.id: r.e for r in rows.select("id", schema_errors(F.col("j"), SCHEMA).alias("e")).collect()}
    for i, d in enumerate(docs):
        assert got[i] == sorted(audit.schema_errors(d, SCHEMA)), d
    assert sum(not e for e in got.values()) > 5 and sum(len(e) > 2 for e in got.values()) > 50


def test_files_and_text_that_is_no_json(spark):
    files = {"parts/line.json": {"type": "object", "properties": {"id": {"$ref": "../shared.json#/$defs/id"}, "url": {"type": "string", "format": "uri"}, "at": {"type": "string", "format": "date-time"}}}, "shared.json": {"$defs": {"id": {"type": "string", "minLength": 2}}}}
    schema = {"type": "array", "items": {"$ref": "parts/line.json"}}
    said = ['[{"id": "ab", "url": "https://x", "at": "2024-01-01T10:00:00Z"}, {"id": "a", "url": "x y", "at": "2024-13-01T10:00:00"}]', "no json", None, "{}", "[5]"]
    rows = spark.createDataFrame(list(enumerate(said)), "i int, j string")
    got = {r.i: r.e for r in rows.select("i", schema_errors(F.col("j"), schema, files).alias("e")).collect()}
    assert got == {0: ["$[1].at: format", "$[1].id: minLength", "$[1].url: format"], 1: ["$: json"], 2: ["$: json"], 3: ["$: type"], 4: ["$[0]: type"]}
    with pytest.raises(ValueError, match="out of the root"):
        schema_errors(F.col("j"), {"$ref": "../x.json"})
    with pytest.raises(ValueError, match="refers to itself"):
        schema_errors(F.col("j"), {"$ref": "#/$defs/t", "$defs": {"t": {"properties": {"t": {"$ref": "#/$defs/t"}}}}})
