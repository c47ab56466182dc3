"""Provenance and trust: evidence replay, authorized rows, review pairing, receipts. Trust enters as data:
without authorized rows nothing is authorized."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidar.functions.digests import canonical_digest, exactly, merkle_root, resolve_pointer
from evidar.functions.gates import reason_codes

ROW_KEY = ("dataset_id", "history_id", "account_id", "observation_id", "price_line")


def replay(evidence: dict[str, Any], snapshot: bytes) -> list[str]:
    """Reason codes of one evidence row against the bytes it cites: none if length, digest, pointer value
    and claim hash all replay."""
    codes = []
    if evidence.get("source_snapshot_byte_length") not in (None, len(snapshot)):
        codes.append("snapshot_length_mismatch")
    if hashlib.sha256(snapshot).hexdigest().lower() != str(evidence.get("source_snapshot_sha256", "")).lower():
        codes.append("snapshot_digest_mismatch")
    try:
        found = resolve_pointer(json.loads(snapshot), evidence["claim_locator"])
    except (KeyError, ValueError):
        return [*codes, "claim_locator_unresolved"]
    if not exactly(found, evidence.get("claim_value")):
        codes.append("claim_value_mismatch")
    if canonical_digest(evidence.get("claim_value")).lower() != str(evidence.get("claim_hash", "")).lower():
        codes.append("claim_hash_mismatch")
    return codes


def replay_evidence(evidence: DataFrame, snapshots: DataFrame) -> DataFrame:
    """evidence(evidence_id, source_path, locator, claim JSON text, claim_hash, snapshot_sha256) with codes,
    joined to snapshots(path, content). Snapshots join by path, each read once."""
    import pandas as pd

    @F.pandas_udf("array<string>")
    def check(content: pd.Series, locator: pd.Series, claim: pd.Series, claim_hash: pd.Series, sha: pd.Series) -> pd.Series:
        def one(data, at, value, digest, snapshot):
            if data is None:
                return ["snapshot_missing"]
            return replay({"claim_locator": at, "claim_value": json.loads(value), "claim_hash": digest, "source_snapshot_sha256": snapshot}, bytes(data))

        return pd.Series([one(*row) for row in zip(content, locator, claim, claim_hash, sha)])

    joined = evidence.join(snapshots, F.col("source_path") == F.col("path"), "left")
    return joined.withColumn("codes", check("content", "locator", "claim", "claim_hash", "snapshot_sha256")).drop("content", "path")


def authorize(rows: DataFrame, authorized: DataFrame, key: tuple[str, ...] = ROW_KEY, facts: tuple[str, ...] = ()) -> DataFrame:
    """rows with authorized: exactly one authorized row has their key and equal facts (null equals null)."""
    other = authorized.select(*[F.col(k).alias(f"__{k}") for k in (*key, *facts)], F.lit(1).alias("__there"))
    same = [F.col(k) == F.col(f"__{k}") for k in key] + [F.col(f).eqNullSafe(F.col(f"__{f}")) for f in facts]
    unique = other.groupBy(*[f"__{k}" for k in (*key, *facts)]).agg(F.sum("__there").alias("__there")).where("__there = 1")
    return rows.join(unique, same, "left").withColumn("authorized", F.col("__there").isNotNull()).drop(*[f"__{k}" for k in (*key, *facts)], "__there")


def pair_reviews(decisions: DataFrame, assignment: str, label: str, role: Column) -> DataFrame:
    """assignment, label_a, label_b, conflict of decisions by role A and B; both are needed."""
    a = decisions.where(role == "A").select(assignment, F.col(label).alias("label_a"))
    b = decisions.where(role == "B").select(assignment, F.col(label).alias("label_b"))
    return a.join(b, assignment).withColumn("conflict", ~F.col("label_a").eqNullSafe(F.col("label_b")))


def adjudicated(pairs: DataFrame, adjudications: DataFrame, assignment: str, label: str) -> DataFrame:
    """Final labels, with a code where a conflict lacks its adjudication or an agreement has one."""
    joined = pairs.join(adjudications.select(assignment, F.col(label).alias("ruling")), assignment, "full_outer")
    codes = reason_codes([
        ("adjudication_missing", F.coalesce("conflict", F.lit(False)) & F.col("ruling").isNull()),
        ("adjudication_unexpected", F.col("ruling").isNotNull() & ~F.coalesce("conflict", F.lit(False)))])
    return joined.select(assignment, F.when(F.col("conflict"), F.col("ruling")).otherwise(F.col("label_a")).alias("label"), codes.alias("codes"))


def receipt_gate(receipts: DataFrame, archive: str) -> DataFrame:
    """archive, passed, codes: at least two issuers, two groups and both classes of evidence; all or nothing."""
    counted = receipts.groupBy(archive).agg(F.countDistinct("issuer").alias("issuers"), F.countDistinct("group").alias("groups"), F.countDistinct("evidence_class").alias("classes"))
    codes = reason_codes([("issuers_below_two", F.col("issuers") < 2), ("groups_below_two", F.col("groups") < 2), ("evidence_class_missing", F.col("classes") < 2)])
    return counted.select(archive, (F.size(codes) == 0).alias("passed"), codes.alias("codes"))


def exactly_one(left: DataFrame, right: DataFrame, key: list[str], left_id: str) -> DataFrame:
    """left_id and matches: left rows with their number of right rows of equal key; only 1 is a match."""
    n = right.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return left.join(n, key, "left").select(left_id, F.coalesce("__n", F.lit(0)).alias("matches"), F.coalesce(F.col("__n") == 1, F.lit(False)).alias("matched"))


def promotion(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """candidate_id, codes, promoted over evidence(candidate_id, field, lineage, official): two lineages at least
    and an official identity; contradictory values of a field reject."""
    per = evidence.groupBy("candidate_id").agg(F.countDistinct("lineage").alias("lineages"), F.max(F.when(F.col("field") == "identity", F.col("official"))).alias("official_identity"))
    clash = evidence.groupBy("candidate_id", "field").agg(F.countDistinct("value").alias("n")).groupBy("candidate_id").agg(F.max("n").alias("values"))
    joined = candidates.join(per, "candidate_id", "left").join(clash, "candidate_id", "left")
    codes = reason_codes([("lineages_below_two", F.coalesce("lineages", F.lit(0)) < 2), ("official_identity_missing", ~F.coalesce("official_identity", F.lit(False))), ("field_values_differ", F.coalesce("values", F.lit(0)) > 1)])
    return joined.select("candidate_id", codes.alias("codes"), (F.size(codes) == 0).alias("promoted"))


__all__ = ["adjudicated", "authorize", "exactly_one", "merkle_root", "pair_reviews", "promotion", "receipt_gate", "replay", "replay_evidence"]
