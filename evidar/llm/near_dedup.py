"""SimHash near-dedup by the generalised pigeonhole principle.

If two fingerprints differ in at most TAU of 64 bits and the bits are dealt into m partitions
with thresholds that sum to TAU - m + 1, then some partition differs within its threshold (one
of -1 is never probed). Correlated bits share a partition; the thresholds are those of least
estimated cost, found by dynamic programming. Every fingerprint is put under its own value of a
partition and probes the values within the threshold; those that meet are verified. What meets
is reduced to a forest at once, so that a group of copies costs edges in its size, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import table, written
from evidar.llm.components import connected
from evidar.llm.simhash import fingerprints

BITS = 64
TAU = 3
PARTITIONS = (2, 3, 4)
#: Cost of a candidate, next to that of a probe.
CANDIDATE_COST = 0.2
#: Buckets up to this size are compared pair by pair, larger ones by search from a frontier.
SMALL_BUCKET = 16
LARGE_BUCKET = 4096


def correlations(fps: DataFrame) -> np.ndarray:
    """The correlation of each two bits over all fingerprints, from one 64 x 64 sum of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1), np.int64)
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy(zero_copy_only=False))
            ones = np.column_stack([bits, np.ones(len(bits), np.float64)])
            total += (ones.T @ ones).astype(np.int64)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array((i * (BITS + 1) + j).ravel()), pa.array(total.ravel())], ["cell", "n"])

    cells = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((BITS + 1) ** 2)
    for row in cells:
        both[row.cell] = row.n
    both = both.reshape(BITS + 1, BITS + 1)
    n = max(both[-1, -1], 1.0)
    p = both[:-1, -1] / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return (both[:-1, :-1] / n - np.outer(p, p)) / np.outer(spread, spread)


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)


def group_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal size: each starts with the bit most correlated to the others left
    and takes in the bits most correlated to it."""
    strength = np.abs(correlation) - np.eye(len(correlation))
    left, out = list(range(len(correlation))), []
    for k in range(m):
        size = len(left) // (m - k)
        group = [max(left, key=lambda b: (strength[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def extract(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The named bits of each fingerprint as one number."""
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= (fp >> np.uint64(b) & np.uint64(1)) << np.uint64(k)
    return out


def collision_rates(fps: DataFrame, groups: list[list[int]]) -> tuple[int, list[float]]:
    """The number of fingerprints, and for each partition the share of pairs that agree on it, over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, bits in enumerate(groups):
                values, n = np.unique(extract(fp, bits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k)), pa.array(values.view(np.int64)), pa.array(n)], ["part", "value", "n"])

    counts = fps.select("fp").mapInArrow(run, "part long, value long, n long").groupBy("part", "value").agg(F.sum("n").cast("double").alias("n"))
    rows = {r.part: r for r in counts.groupBy("part").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("pairs")).collect()}
    n = int(rows[0].n) if rows else 0
    return n, [rows[k].pairs / rows[k].n ** 2 if k in rows else 0.0 for k in range(len(groups))]


def probes(width: int, threshold: int) -> float:
    """Values that a fingerprint is put under or probes, on average: of two that differ, the one with
    the highest differing bit set probes for the other."""
    return 0.0 if threshold < 0 else 1.0 + sum(comb(width, k) for k in range(1, threshold + 1)) / 2


def allocate(n: int, widths: list[int], rates: list[float], tau: int = TAU) -> tuple[float, list[int]]:
    """The cheapest thresholds with sum tau - m + 1, by dynamic programming over the partitions. The
    candidates within t bits are estimated from the rate of equal values, one bit more multiplying
    the values by width, as if bits agreed independently."""
    m = len(widths)

    def cost(i: int, t: int) -> float:
        if t < 0:
            return 0.0
        values = sum(comb(widths[i], k) for k in range(t + 1))
        agree = max(min(rates[i] ** (1 / widths[i]), 1.0), 0.5)
        near = rates[i] * sum(comb(widths[i], k) * ((1 - agree) / agree) ** k for k in range(t + 1))
        return n * probes(widths[i], t) + CANDIDATE_COST * n * n * min(near, values * rates[i])

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(m):
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (spent, chosen) in best.items():
            for t in range(-1, tau + 1):
                option = (spent + cost(i, t), [*chosen, t])
                if total + t not in step or option < step[total + t]:
                    step[total + t] = option
        best = step
    return best[tau - m + 1]


def make_plan(fps: DataFrame, tau: int = TAU) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed, for the number of partitions of least cost."""
    correlation = correlations(fps)
    choices = [(m, group_bits(correlation, m)) for m in PARTITIONS]
    n, rates = collision_rates(fps, [bits for _, groups in choices for bits in groups])
    options, at = [], 0
    for m, groups in choices:
        spent, thresholds = allocate(n, [len(g) for g in groups], rates[at : at + m], tau)
        options.append((spent, m, [(bits, t) for bits, t in zip(groups, thresholds) if t >= 0]))
        at += m
    return min(options)[2]


def put_and_probe(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """key, fp: each fingerprint under its own and all probed values of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(every), 4096):
                fp = every[start : start + 4096]
                for k, (bits, threshold) in enumerate(plan):
                    value = extract(fp.view(np.uint64), bits).view(np.int64)
                    keys, owners = [value], [fp]
                    for size in range(1, threshold + 1):
                        for flip in combinations(range(len(bits)), size):
                            has = (value >> flip[-1] & 1) == 1
                            keys.append(value[has] ^ sum(1 << b for b in flip))
                            owners.append(fp[has])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) | k << 60), pa.array(np.concatenate(owners))], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def split_hot(met: DataFrame, tau: int = TAU, most: int = LARGE_BUCKET) -> DataFrame:
    """met with the rows of buckets above most under tau + 1 keys of smaller ones instead, one for each block of
    bits: two that differ in tau bits at most agree on one of the blocks, so no link is lost."""
    hot = met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(F.col("key").alias("hot"))
    hot = written(hot, "simhash-hot")
    if hot.isEmpty():
        return met
    width = -(-BITS // (tau + 1))
    blocks = [F.xxhash64("key", F.lit(k), F.shiftrightunsigned("fp", k * width).bitwiseAND((1 << width) - 1)) for k in range(tau + 1)]
    large = met.join(hot, F.col("key") == F.col("hot")).select(F.explode(F.array(*blocks)).alias("key"), "fp")
    return met.join(hot, F.col("key") == F.col("hot"), "left_anti").unionByName(large)


def verify(met: DataFrame, tau: int = TAU) -> DataFrame:
    """Edges a, b between fingerprints that met under a key and differ in at most tau bits, or that
    are connected through such; enough of them to connect all that are, at most SMALL_BUCKET a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            key, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            held.append((key, fp.view(np.uint64)))
            if held[0][0][0] == key[-1]:
                continue  # one bucket goes on
            key, fp = np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held])
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            yield from _edges(key[:cut], fp[:cut], tau)
            held = [(key[cut:], fp[cut:])]
        if held:
            yield from _edges(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]), tau)

    # a bucket holds distinct fingerprints that agree on a partition: as many as differ in the other bits
    dealt = met.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def _edges(key: np.ndarray, fp: np.ndarray, tau: int) -> Iterator[pa.RecordBatch]:
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    size_of = np.repeat(sizes, sizes)
    small = (size_of > 1) & (size_of <= SMALL_BUCKET)
    k, f = key[small], fp[small]
    for d in range(1, min(SMALL_BUCKET, len(f))):
        near = np.flatnonzero((k[d:] == k[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= tau) & (f[d:] != f[:-d]))
        found.append((f[near], f[near + d]))
    for start, size in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET]):
        found += forest(np.unique(fp[start : start + size]), tau)
    if found:
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
        for at in range(0, len(a), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 65536]), pa.array(b[at : at + 65536])], ["a", "b"])


def forest(fp: np.ndarray, tau: int, split: bool = True) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what chains of links within tau bits connect among distinct fingerprints."""
    if split and len(fp) > LARGE_BUCKET:
        # within the bucket again by blocks of bits: one of tau + 1 blocks must be equal
        out = []
        width = -(-BITS // (tau + 1))
        for at in range(0, BITS, width):
            block = fp >> np.uint64(at) & np.uint64((1 << min(width, BITS - at)) - 1)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            for part in np.split(fp[order], cuts):
                if len(part) > 1:
                    out += forest(part, tau, split=False)
        return out
    out, left = [], fp
    while len(left) > 1:
        root, frontier, left = left[:1], left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(frontier), 64):
                block = frontier[at : at + 64]
                near |= (np.bitwise_count(left[None, :] ^ block[:, None]) <= tau).any(0)
                if near.all():
                    break
            frontier, left = left[near], left[~near]
            if len(frontier):
                out.append((np.repeat(root, len(frontier)), frontier))
    return out


def link(prints: DataFrame, tau: int = TAU) -> DataFrame:
    """fp, component_id for each distinct fingerprint of prints(id, fp): the least id among all rows
    whose fingerprints a chain of links reaches (null only if none of them has an id)."""
    by_print = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    if by_print.isEmpty():
        return by_print.select("fp", F.col("least").alias("component_id"))
    edges = written(verify(split_hot(put_and_probe(by_print, make_plan(by_print, tau)), tau), tau).distinct(), "simhash-edges")
    labels = connected(edges)
    linked = labels.join(by_print, labels["node"] == by_print["fp"]).select("node", "root", "least")
    roots = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.select("node", "root").join(roots, "root").select("node", "component_id")
    return written(by_print.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")), "simhash-components")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, tau: int = TAU) -> DataFrame:
    """id, fp (64 bits as a long), component_id for each row of docs.

    Null and blank texts have fingerprint 0, linked like any other; repeated rows repeat; an empty
    table gives no rows. Fingerprints link at tau or fewer differing bits, components are transitive.
    """
    prints = written(fingerprints(docs, id_col, text_col, width), "simhash-documents")
    return prints.join(link(prints, tau), "fp").select("id", "fp", "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
