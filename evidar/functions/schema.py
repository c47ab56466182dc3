"""JSON Schema compiled to a column expression over VARIANT: an array of errors, each a path and a keyword.

Every subschema is one expression; values are bound once by a lambda, so an expression grows with the schema and not
with its depth. A $ref to the schema itself or to another file is compiled where it stands, so a schema that refers
to itself in a circle is refused. Nothing runs in Python.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidar.functions.digests import exactly_equal
from evidar.functions.text import DIGIT
from evidar.operators.nested import kind_of

Schema = dict[str, Any] | bool
_KINDS = {"object": "object", "array": "list", "string": "string", "boolean": "boolean", "null": "null"}
_DATE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
_URI = "^[A-Za-z][A-Za-z0-9+.-]*:"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is worked out once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _none() -> Column:
    return F.array().cast("array<string>")


class Compiler:
    """files: the schemas by their paths. A file's $ref is relative to it and may not lead out of the root."""

    def __init__(self, files: dict[str, Schema]):
        self.files, self.open = {self._path(p): s for p, s in files.items()}, []

    @staticmethod
    def _path(path: str, beside: str = "") -> str:
        parts: list[str] = []
        for step in (*PurePosixPath(beside).parent.parts, *PurePosixPath(path).parts):
            if step == "..":
                if not parts:
                    raise ValueError(f"reference leads out of the root: {path}")
                parts.pop()
            elif step != ".":
                parts.append(step)
        return "/".join(parts)

    def resolved(self, ref: str, current: str) -> tuple[Schema, str]:
        name, _, pointer = ref.partition("#")
        path = self._path(name, current) if name else current
        target: Any = self.files[path]
        for step in pointer.split("/")[1:]:
            step = step.replace("~1", "/").replace("~0", "~")
            target = target[int(step)] if isinstance(target, list) else target[step]
        return target, path

    def errors(self, value: Column, path: str) -> Column:
        """The errors of a VARIANT under the schema of this path; a null value is JSON's null."""
        return self._checked(value, self.files[self._path(path)], self._path(path), F.lit("$"))

    def _checked(self, value: Column, schema: Schema, current: str, at: Column) -> Column:
        if schema is True or schema == {}:
            return _none()
        if schema is False:
            return F.array(F.concat(at, F.lit(": false")))
        return let(value, lambda v: let(kind_of(v), lambda kind: let(at, lambda path: self._body(v, kind, schema, current, path))))

    def _body(self, v: Column, kind: Column, s: dict[str, Any], current: str, at: Column) -> Column:
        bad = lambda keyword: F.concat(at, F.lit(f": {keyword}"))
        flag = lambda fails, keyword: F.when(F.coalesce(fails, F.lit(False)), bad(keyword))
        sub = lambda x, schema, place=at: self._checked(x, schema, current, place)
        lists: list[Column] = []
        if "$ref" in s:
            target, path = self.resolved(s["$ref"], current)
            key = (path, s["$ref"].partition("#")[2])
            if key in self.open:
                raise ValueError(f"the schema refers to itself: {s['$ref']}")
            self.open.append(key)
            lists.append(self._checked(v, target, path, at))
            self.open.pop()
        flags: list[Column] = []
        literal = lambda x: F.parse_json(F.lit(json.dumps(x)))
        same = lambda x: (kind == "null") if x is None else exactly_equal(v, literal(x))
        if "const" in s:
            flags.append(flag(~same(s["const"]), "const"))
        if "enum" in s:
            found = F.lit(False)
            for x in s["enum"]:
                found = found | F.coalesce(same(x), F.lit(False))
            flags.append(flag(~found, "enum"))
        for keyword in ("allOf", "anyOf", "oneOf"):
            if keyword in s:
                fits = sum((F.when(F.size(sub(v, x)) == 0, 1).otherwise(0) for x in s[keyword]), F.lit(0))
                flags.append(flag({"allOf": fits < len(s[keyword]), "anyOf": fits == 0, "oneOf": fits != 1}[keyword], keyword))
        if "not" in s:
            flags.append(flag(F.size(sub(v, s["not"])) == 0, "not"))
        if "if" in s:
            branch = lambda name: sub(v, s[name]) if name in s else _none()
            lists.append(F.when(F.size(sub(v, s["if"])) == 0, branch("then")).otherwise(branch("else")))
        if {"minLength", "maxLength", "pattern", "format"} & s.keys():
            lists.append(F.when(kind == "string", let(F.try_variant_get(v, "$", "string"), lambda t: F.array_compact(F.array(*self._text(t, s, flag))))).otherwise(_none()))
        bounds = {"minimum": lambda x, n: x < n, "maximum": lambda x, n: x > n, "exclusiveMinimum": lambda x, n: x <= n, "exclusiveMaximum": lambda x, n: x >= n}
        number = F.try_variant_get(v, "$", "double")
        flags += [flag((kind == "number") & f(number, F.lit(float(s[k]))), k) for k, f in bounds.items() if k in s]
        if {"minItems", "maxItems", "uniqueItems", "contains", "items"} & s.keys():
            lists.append(F.when(kind == "list", let(v.cast("array<variant>"), lambda items: self._items(items, s, flag, sub, at))).otherwise(_none()))
        if {"required", "properties", "additionalProperties", "propertyNames"} & s.keys():
            lists.append(F.when(kind == "object", let(v.cast("map<string,variant>"), lambda m: self._members(m, s, flag, sub, at))).otherwise(_none()))
        rest = F.concat(F.array_compact(F.array(*flags)) if flags else _none(), *lists) if lists else F.array_compact(F.array(*flags)) if flags else _none()
        if "type" in s:
            whole = F.try_variant_get(v, "$", "double")
            tests = F.lit(False)
            for k in s["type"] if isinstance(s["type"], list) else [s["type"]]:
                if k in ("number", "integer"):
                    tests = tests | ((kind == "number") & (F.lit(True) if k == "number" else F.coalesce(whole == F.floor(whole), F.lit(False))))
                else:
                    tests = tests | (kind == _KINDS.get(k, k))
            of_ref = [lists[0]] if "$ref" in s else []
            rest = F.when(tests, rest).otherwise(F.concat(*of_ref, F.array(bad("type"))))
        return rest

    @staticmethod
    def _text(t: Column, s: dict[str, Any], flag: Callable) -> list[Column]:
        out = []
        if "minLength" in s:
            out.append(flag(F.length(t) < s["minLength"], "minLength"))
        if "maxLength" in s:
            out.append(flag(F.length(t) > s["maxLength"], "maxLength"))
        if "pattern" in s:
            out.append(flag(~t.rlike(s["pattern"].replace(r"\d", DIGIT)), "pattern"))
        form = s.get("format")
        if form == "date":
            out.append(flag(~t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") | F.try_to_date(t, "yyyy-MM-dd").isNull(), "format"))
        elif form == "date-time":
            out.append(flag(~t.rlike(_DATE_TIME) | t.try_cast("timestamp").isNull(), "format"))
        elif form == "uri":
            out.append(flag(~t.rlike(_URI), "format"))
        return out

    @staticmethod
    def _items(items: Column, s: dict[str, Any], flag: Callable, sub: Callable, at: Column) -> Column:
        flags, lists = [], []
        if "minItems" in s:
            flags.append(flag(F.size(items) < s["minItems"], "minItems"))
        if "maxItems" in s:
            flags.append(flag(F.size(items) > s["maxItems"], "maxItems"))
        if s.get("uniqueItems"):
            spelled = F.transform(items, lambda x: F.concat_ws(":", F.coalesce(F.schema_of_variant(x), F.lit("null")), F.coalesce(F.to_json(x), F.lit("null"))))
            flags.append(flag(F.size(F.array_distinct(spelled)) < F.size(items), "uniqueItems"))
        if "contains" in s:
            flags.append(flag(~F.exists(items, lambda x: F.size(sub(x, s["contains"])) == 0), "contains"))
        if "items" in s:
            lists.append(F.flatten(F.transform(items, lambda x, i: sub(x, s["items"], F.concat(at, F.lit("["), i.cast("string"), F.lit("]"))))))
        return F.concat(F.array_compact(F.array(*flags)) if flags else _none(), *lists)

    @staticmethod
    def _members(m: Column, s: dict[str, Any], flag: Callable, sub: Callable, at: Column) -> Column:
        known = s.get("properties", {})
        there = lambda name: F.map_contains_key(m, F.lit(name))
        inside = lambda name: F.concat(at, F.lit("."), name)
        out = [F.array_compact(F.array(*[flag(~there(n), f"required {n}") for n in s["required"]]))] if s.get("required") else [_none()]
        out += [F.when(there(n), sub(F.element_at(m, F.lit(n)), x, inside(F.lit(n)))).otherwise(_none()) for n, x in known.items()]
        if s.get("additionalProperties", True) is not True:
            others = F.filter(F.map_keys(m), lambda k: ~k.isin(*known)) if known else F.map_keys(m)
            out.append(F.flatten(F.transform(others, lambda k: sub(F.element_at(m, k), s["additionalProperties"], inside(k)))))
        if "propertyNames" in s:
            as_value = lambda k: F.variant_get(F.parse_json(F.to_json(F.array(k))), "$[0]", "variant")
            out.append(F.flatten(F.transform(F.map_keys(m), lambda k: sub(as_value(k), s["propertyNames"], inside(k)))))
        return F.concat(*out)


def schema_errors(document: Column, schema: Schema, files: dict[str, Schema] | None = None) -> Column:
    """Errors of JSON text under a schema, sorted; text that is no JSON, and null, has the error `json`. files: schemas that it
    refers to, by path."""
    compiler = Compiler({"": schema} | (files or {}))
    parsed = F.try_parse_json(document)
    return F.when(parsed.isNull(), F.array(F.lit("$: json"))).otherwise(F.array_sort(compiler.errors(parsed, "")))
