"""Sinks: canonical JSON lines and objects, and an append that is whole or not at all."""

from __future__ import annotations

import hashlib
import os
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidar.functions.digests import canonical_bytes, canonical_json


def json_lines(rows: DataFrame, order: list[str]) -> DataFrame:
    """One canonical JSON text a row, in order; nulls stay."""
    text = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    return rows.orderBy(*order).select(canonical_json(text).alias("value"))


def write_jsonl(rows: DataFrame, path: str, order: list[str]) -> None:
    """Canonical JSON lines in order, spread over files whose names keep it."""
    json_lines(rows, order).write.mode("overwrite").option("lineSep", "\n").text(path)


def write_object(value: Any, path: str | Path) -> str:
    """A canonical JSON object file; returns its SHA-256."""
    data = canonical_bytes(value, newline=True)
    _replace(Path(path), data)
    return hashlib.sha256(data).hexdigest().upper()


def _replace(path: Path, data: bytes) -> None:
    staged = path.with_name(path.name + ".staged")
    with open(staged, "xb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(staged, path)


def append_records(path: str | Path, records: list[dict], expected_sha256: str, key: str) -> str:
    """Appends records to a JSON lines file if its digest is still the expected one and no key repeats;
    the file is replaced as a whole or stays as it was. Returns the new digest."""
    place, lock = Path(path), Path(f"{path}.lock")
    handle = os.open(lock, os.O_CREAT | os.O_EXCL)
    try:
        before = place.read_bytes() if place.exists() else b""
        if hashlib.sha256(before).hexdigest().lower() != expected_sha256.lower():
            raise ValueError("the file has changed")
        import json

        keys = [json.loads(line)[key] for line in before.decode().splitlines() if line.strip()] + [r[key] for r in records]
        if len(keys) != len(set(keys)):
            raise ValueError(f"a {key} repeats")
        data = before + b"".join(canonical_bytes(r, newline=True) for r in records)
        _replace(place, data)
        return hashlib.sha256(data).hexdigest()
    finally:
        os.close(handle)
        lock.unlink()
