"""Gates: predicates that emit reason codes. Every row is kept or appears in the ledger with its codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Gate = tuple[str, Column]


def fails(predicate: Column) -> Column:
    """A failure predicate that also holds where it cannot be decided (fail closed)."""
    return F.coalesce(predicate, F.lit(True))


def reason_codes(gates: Iterable[Gate]) -> Column:
    """The codes of all failure predicates that hold, in the order given; null counts as failed."""
    return F.array_compact(F.array(*[F.when(fails(p), F.lit(code)) for code, p in gates]))


def joined_codes(gates: Iterable[Gate], by: str = ",") -> Column:
    """reason_codes() as one string, for rows too many to have an array each."""
    return F.concat_ws(by, *[F.when(fails(p), F.lit(code)) for code, p in gates])


def ledger_codes(codes: Column) -> Column:
    """Codes as a ledger lists them: each once, sorted."""
    return F.array_sort(F.array_distinct(codes))


def disposition(codes: Column, review: Iterable[str]) -> Column:
    """kept without codes; needs_review if one of the review codes is there; else excluded."""
    return F.when(F.size(codes) == 0, "kept").when(F.arrays_overlap(codes, F.array(*[F.lit(c) for c in review])), "needs_review").otherwise("excluded")


def first_reason(gates: Iterable[Gate]) -> Column:
    """Only the first code in order, null if none: for chains that stop at the first failure."""
    return F.coalesce(*[F.when(fails(p), F.lit(code)) for code, p in gates])


def split(rows: DataFrame, codes: str = "reason_codes") -> tuple[DataFrame, DataFrame]:
    """(kept, ledger)."""
    return rows.where(F.size(codes) == 0), rows.where(F.size(codes) > 0)
