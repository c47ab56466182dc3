"""Near copies at a Jaccard similarity of word shingles, found by SimHash.

A document's distinct shingles vote on a fingerprint of WORDS x 64 bits. Two documents of a given
similarity differ in each bit with a known chance, so partitions of correlated bits with a threshold
each find them with a known chance. The thresholds (-1: not probed) are those of least estimated cost
that find a pair at the similarity with a chance of RECALL, by dynamic programming. For certain they
find every pair that differs in no more bits than the thresholds and the probed partitions, less one,
add up to: the generalised pigeonhole principle. What meets is verified by the exact similarity of the
shingles, in two rounds: of each bucket the spanning forests of nearest pairs go first. Where pairs were left
over that still lie in two groups, the rows then meet with their shingles, and what they share is counted where
they meet, for whole blocks by products of matrices: only links leave a task, no more than there are groups, so a
large group of texts that are nearly similar makes no rows in its square. Rows of a bucket too large to be
compared at once meet by further bits in the first round; in the second all rows outside its largest group are
compared with all rows of the bucket, in blocks. So every pair that meets, and differs in no more bits than a
pair at the similarity would, is verified or lies in one group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidar.llm.common import discard, free_names, release_caches, written
from evidar.llm.components import connected
from evidar.llm.near_dedup import extract, group_bits, probes
from evidar.llm.simhash import shingle_hashes

WIDTH = 5
SIMILARITY = 0.8
#: Chance that a pair at exactly SIMILARITY becomes a candidate: that it meets in some partition, times that it differs in few
#: enough bits of the whole fingerprint.
RECALL = 0.98
BITS_CHANCE, BITS_DEVIATIONS = 0.995, 2.58
WORDS = 8
#: Partitions that each word of the fingerprint may be dealt into.
PARTITIONS = (2, 3, 4, 5)
#: Cost of comparing a candidate, next to that of a row put or probed.
CANDIDATE_COST = 0.01
#: Words of the fingerprint that go along with a key, and of them those by which hot buckets are dealt again.
CARRIED, AGAIN = WORDS, 4
#: Forests of nearest pairs taken from a bucket in the first round; in each further round, where pairs are verified outside of the
#: buckets, of those it has left so many times more.
FORESTS, MORE = 3, 8
SMALL_BUCKET = 48
#: Rows of a bucket that are compared in one task; of those dealt again in the first round, how many meet the next block too.
BLOCK, OVERLAP = 1024, 128
#: Bytes of shingles in a block.
BLOCK_BYTES = 8 << 20
#: Larger buckets are hot.
HOT_BUCKET = 1024
#: Columns of the matrices whose product counts what sets share.
_COLUMNS = 2048
#: Pairs that a task holds before it thins them.
_HELD_PAIRS = 1 << 19
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def distinct_shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The hashes of the distinct shingles of a text, ascending."""
    parts = list(shingle_hashes(text, width))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def wide_fingerprint(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """words x 64 bits, each 1 if set in more than half of the hashes, mixed anew for each word."""
    ones = np.zeros(words * 64, np.int64)
    steps = (np.arange(1, words + 1, dtype=np.uint64) * _MIX[0])[None, :]
    for at in range(0, len(hashes), 4080):
        z = hashes[at : at + 4080, None] + steps
        z = (z ^ (z >> np.uint64(30))) * _MIX[1]
        z = (z ^ (z >> np.uint64(27))) * _MIX[2]
        bits = np.unpackbits((z ^ (z >> np.uint64(31))).astype("<u8").view(np.uint8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # so many fit a byte
            ones += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """uid, id, text_key (SHA-256 of the text), digest (of the distinct shingles; null for no words), f0 ...
    (the fingerprint's words) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        for batch in batches:
            digests, prints = [], np.zeros((batch.num_rows, WORDS), np.uint64)
            for i, text in enumerate(batch.column(3)):
                found = distinct_shingles(text.as_py(), width)
                digests.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                if len(found):
                    prints[i] = wide_fingerprint(found)
            words = [pa.array(prints[:, k].astype(np.int64)) for k in range(WORDS)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digests, pa.binary()), *words],
                                             ["uid", "id", "text_key", "digest", *(f"f{k}" for k in range(WORDS))])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.monotonically_increasing_id().alias("uid"), docs[id_col].alias("id"),
                        _text_key(docs[text_col]).alias("text_key"), docs[text_col].alias("text"))
    return given.mapInArrow(run, f"uid long, id {kind}, text_key binary, digest binary, " + ", ".join(f"f{k} long" for k in range(WORDS)))


def _text_key(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def bit_sums(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each of their words in how many each two bits are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((WORDS, 65, 65), np.int64)
        for batch in batches:
            for k in range(WORDS):
                word = batch.column(k).to_numpy(zero_copy_only=False).astype("<i8")
                bits = np.unpackbits(word.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
                ones = np.column_stack([bits, np.ones(len(bits))])
                total[k] += (ones.T @ ones).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "n"])

    cells = prints.select([f"f{k}" for k in range(WORDS)]).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    sums = np.zeros(WORDS * 65 * 65, np.int64)
    for row in cells:
        sums[row.cell] = row.n
    sums = sums.reshape(WORDS, 65, 65)
    return int(sums[0, -1, -1]), sums


def difference_rate(similarity: float) -> float:
    """Chance that a bit differs between two sets of this Jaccard similarity: their angle as a share of a half turn."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def bits_bound(similarity: float) -> int:
    """Bits of the carried words in which a pair of this similarity differs at most, with a chance of BITS_CHANCE."""
    rate, bits = difference_rate(similarity), 64 * CARRIED
    return math.ceil(bits * rate + BITS_DEVIATIONS * math.sqrt(bits * rate * (1 - rate)))


def meets(bits: int, threshold: int, rate: float) -> float:
    """Chance that two fingerprints differ in threshold of bits bits at most."""
    return sum(math.comb(bits, k) * rate**k * (1 - rate) ** (bits - k) for k in range(threshold + 1))


def allocate(n: int, widths: list[int], agree: list[float], rate: float, recall: float) -> tuple[float, list[int]]:
    """The thresholds of least cost that miss a pair in all partitions with a chance of 1 - recall at most:
    by dynamic programming over the partitions and the log of that chance. agree: the share of pairs that
    agree on a partition, from which candidates within t bits are estimated."""
    unit = 0.01
    goal = math.ceil(-math.log(1 - recall) / unit)
    best: list[tuple[float, tuple[int, ...]] | None] = [None] * (goal + 1)
    best[0] = (0.0, ())
    for bits, same in zip(widths, agree):
        options = [(0, 0.0, -1)]
        for t in range(3):
            bit = max(same ** (1 / bits), 0.5)
            near = min(1.0, same * sum(math.comb(bits, k) * ((1 - bit) / bit) ** k for k in range(t + 1)))
            cost = n * probes(bits, t) + CANDIDATE_COST * n * n / 2 * near
            options.append((int(-math.log(1 - meets(bits, t, rate)) / unit), cost, t))
        step: list[tuple[float, tuple[int, ...]] | None] = [None] * (goal + 1)
        for at, held in enumerate(best):
            if held is None:
                continue
            for gain, cost, t in options:
                to = min(goal, at + gain)
                if step[to] is None or held[0] + cost < step[to][0]:
                    step[to] = (held[0] + cost, (*held[1], t))
        best = step
    if best[goal] is None:
        return math.inf, []
    return best[goal][0], list(best[goal][1])


def make_plan(n: int, sums: np.ndarray, similarity: float, recall: float = RECALL / BITS_CHANCE) -> list[tuple[int, list[int], int]]:
    """(word, bits, threshold) of each partition that is probed."""
    rate, p = difference_rate(similarity), sums[:, :-1, -1] / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = (sums[:, :-1, :-1] / max(n, 1) - p[:, :, None] * p[:, None, :]) / (spread[:, :, None] * spread[:, None, :])
    options = []
    for m in PARTITIONS:
        dealt = [(k, bits) for k in range(WORDS) for bits in group_bits(correlation[k], m)]
        agree = [float(np.prod(p[k, bits] ** 2 + (1 - p[k, bits]) ** 2)) for k, bits in dealt]
        cost, thresholds = allocate(n, [len(b) for _, b in dealt], agree, rate, recall)
        options.append((cost, m, [(k, bits, t) for (k, bits), t in zip(dealt, thresholds) if t >= 0]))
    return min(options)[2]


def put_and_probe(classes: DataFrame, plan: list[tuple[int, list[int], int]]) -> DataFrame:
    """key, node and the first CARRIED words: each fingerprint under its own and all probed values of each partition."""
    names = ["key", "node", *(f"f{k}" for k in range(CARRIED))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            for start in range(0, len(every), 4096):
                rows = every[start : start + 4096]
                for part, (word, bits, threshold) in enumerate(plan):
                    value = extract(rows[:, 1 + word].view(np.uint64), bits).view(np.int64)
                    keys, owners = [value], [np.arange(len(rows))]
                    for size in range(1, threshold + 1):
                        for flip in combinations(range(len(bits)), size):
                            has = np.flatnonzero(value >> flip[-1] & 1)
                            keys.append(value[has] ^ sum(1 << b for b in flip))
                            owners.append(has)
                    own = np.concatenate(owners)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) | part << 40), *(pa.array(rows[own, c]) for c in range(1 + CARRIED))], names)

    return classes.select("node", *(f"f{k}" for k in range(WORDS))).mapInArrow(run, ", ".join(f"{n} long" for n in names))


_GROUPED = ["part", "key", "node", "root", "asks", *(f"f{k}" for k in range(CARRIED))]


def hot_keys(put: DataFrame) -> DataFrame:
    """key of each bucket of more than HOT_BUCKET rows."""
    return put.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_BUCKET).select("key")


def first_round(put: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows by bucket, those of hot buckets by 12 bits more of AGAIN words instead: that links what is nearly equal."""
    words = [f"f{k}" for k in range(CARRIED)]
    plain = put.join(hot, "key", "left_anti").select(F.col("key").alias("part"), "key", "node", F.col("node").alias("root"), F.lit(1).cast("long").alias("asks"), *words)
    again = [F.xxhash64("key", F.lit(k), F.col(f"f{k}").bitwiseAND(0xFFF)) for k in range(AGAIN)]
    large = put.join(hot, "key", "left_semi").select(F.explode(F.array(*again)).alias("part"), "key", "node", F.col("node").alias("root"), F.lit(1).cast("long").alias("asks"), *words)
    return plain.unionByName(large)


def later_round(put: DataFrame, keys: DataFrame, labels: DataFrame, sets: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of these buckets, where they lie in more than one group, each with its group's root and, with sets, its shingles. In a
    bucket of more than a block those outside the largest group ask, block by block, all rows, block by block. A block has about
    BLOCK rows at most, and BLOCK_BYTES of shingles. Also the tables that these are read from."""
    roots = labels.select(F.col("node").alias("linked"), F.col("root").alias("known"))
    rows = put.join(keys, "key", "left_semi").join(roots, F.col("node") == F.col("linked"), "left")
    words = [f"f{k}" for k in range(CARRIED)]
    rows = written(rows.select("key", "node", F.coalesce("known", "node").alias("root"), *words), "near-open")
    held, bytes_ = [rows], F.lit(0).cast("long")
    if sets is not None:
        several = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        rows = rows.join(several, "key", "left_semi")
        held.append(written(sets(rows.select("node").distinct()), "near-shingles"))
        # read four times from here on, so it is joined once
        rows, bytes_ = written(rows.join(held[1].select("node", "size"), "node"), "near-sized"), 8 * F.col("size")
        held.append(rows)
    groups = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum(bytes_).alias("bytes"))
    sizes = groups.groupBy("key").agg(F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "root", "bytes")).alias("largest"),
                                      F.count(F.lit(1)).alias("groups")).where("groups > 1")
    blocks = lambda n, size: F.greatest(F.ceil(n / F.lit(BLOCK)), F.ceil(size / F.lit(BLOCK_BYTES)))
    sizes = sizes.select("key", F.col("largest.root").alias("most"), blocks(F.col("rows"), F.col("bytes")).alias("blocks"),
                         blocks(F.col("rows") - F.col("largest.n"), F.col("bytes") - F.col("largest.bytes")).alias("asking"))
    rows = rows.join(sizes, "key")
    part = lambda a, b: F.xxhash64("key", a, b)
    own = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n))
    row = lambda part, asks: [part.alias("part"), "key", "node", "root", F.lit(asks).cast("long").alias("asks"), *words]
    small, large = rows.where("blocks = 1"), rows.where("blocks > 1")
    zero = F.lit(0).cast("long")
    asked = large.withColumn("other", F.explode(F.sequence(zero, F.col("asking") - 1))).select(*row(part(F.col("other"), own("blocks", 0)), 0))
    ask = large.where("root <> most").withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1))).select(*row(part(own("asking", 1), F.col("other")), 1))
    dealt = small.select(*row(F.col("key"), 1)).unionByName(asked).unionByName(ask)
    return dealt if sets is None else dealt.join(held[1].select("node", "shingles"), "node"), held


def candidates(grouped: DataFrame, most_bits: int, layers: int, cut: bool) -> DataFrame:
    """a < b for the pairs of layers spanning forests, nearest first, over the groups in each part, of rows within most_bits of the
    carried words of which one asks; and open (a and b null), the key, where pairs were left over. cut: a part of more than
    BLOCK + OVERLAP rows goes block after block, each with some rows of the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, len(_GROUPED)), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)])
            last = int(np.searchsorted(held[:, 0], held[-1, 0]))  # the last part may go on
            if last:
                yield from _pairs(held[:last], most_bits, layers)
                held = held[last:]
            while cut and len(held) >= max(BLOCK, HOT_BUCKET) + OVERLAP:
                yield from _pairs(held[:BLOCK], most_bits, layers)
                held = np.concatenate([held[:OVERLAP], held[BLOCK:]])
        if len(held):
            yield from _pairs(held, most_bits, layers)

    dealt = grouped.select(*_GROUPED).repartition("part").sortWithinPartitions("part", "f0", "f1", "node")
    return dealt.mapInArrow(run, "a long, b long, open long").distinct()


def _pairs(rows: np.ndarray, most_bits: int, layers: int) -> Iterator[pa.RecordBatch]:
    """Of whole parts, sorted by part."""
    part, key, node, root, asks = rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4] > 0
    f = np.ascontiguousarray(rows[:, 5:]).view(np.uint64)
    sizes = np.diff(np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)])
    starts = np.cumsum(sizes) - sizes
    # rows of one group in one part are one vertex
    _, vertex = np.unique(np.stack([np.repeat(np.arange(len(sizes)), sizes), root]), axis=1, return_inverse=True)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    count, left_over = 0, np.zeros(len(rows), bool)

    def thin() -> None:
        nonlocal held, count
        i, j, d = (np.concatenate(x) for x in zip(*held))
        chosen, left = forests(i, j, d, vertex.ravel(), layers)
        left_over[i[left]] = True
        held, count = [(i[chosen], j[chosen], d[chosen])], len(chosen)

    def near(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal count
        some = np.flatnonzero((root[i] != root[j]) & (asks[i] | asks[j]))
        i, j = i[some], j[some]
        d = np.bitwise_count(f[i] ^ f[j]).sum(1, dtype=np.int64)
        hit = np.flatnonzero(d <= most_bits)
        if len(hit):
            held.append((i[hit], j[hit], d[hit]))
            count += len(hit)
            if count > _HELD_PAIRS + len(rows) * layers:
                thin()

    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL_BUCKET), sizes))
    for step in range(1, min(SMALL_BUCKET, len(part))):
        at = at[at + step < len(part)]
        at = at[part[at] == part[np.minimum(at + step, len(part) - 1)]]
        if not len(at):
            break
        near(at, at + step)
    for start, size in zip(starts[sizes > SMALL_BUCKET].tolist(), sizes[sizes > SMALL_BUCKET].tolist()):
        for k in range(start, start + size - 1):
            rest = np.arange(k + 1, start + size)
            near(np.full(len(rest), k), rest)
    if not held:
        return
    thin()
    i, j, _ = held[0]
    a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
    keys = np.unique(key[left_over])
    for at in range(0, len(a), 65536):
        some = slice(at, at + 65536)
        yield pa.RecordBatch.from_arrays([pa.array(a[some]), pa.array(b[some]), pa.nulls(len(a[some]), pa.int64())], ["a", "b", "open"])
    if len(keys):
        yield pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.int64())] * 2 + [pa.array(keys)], ["a", "b", "open"])


def settled(grouped: DataFrame, most_bits: int, similarity: float) -> DataFrame:
    """a, b: links of the groups in each part, as many as connect what pairs within most_bits connect whose shingles have a Jaccard
    similarity of at least similarity. Every such pair of which one asks is verified here, unless it lies in one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0).to_numpy()
            cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
            if held and part[0] != held[0].column(0)[0].as_py():
                cuts = np.r_[0, cuts]
            at = 0
            for cut in cuts.tolist():
                yield from _links([*held, batch.slice(at, cut - at)], most_bits, similarity)
                held, at = [], cut
            held.append(batch.slice(at))  # the last part may go on
        if held:
            yield from _links(held, most_bits, similarity)

    dealt = grouped.select(*_GROUPED, "shingles").repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "a long, b long")


def _links(batches: list[pa.RecordBatch], most_bits: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Of one part."""
    rows = np.concatenate([np.stack([c.to_numpy() for c in b.columns[: len(_GROUPED)]], 1) for b in batches])
    node, root, asks = rows[:, 2], rows[:, 3], rows[:, 4] > 0
    f = np.ascontiguousarray(rows[:, 5:]).view(np.uint64)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for b in batches for x in b.column(len(_GROUPED))]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    asking, asked = np.flatnonzero(asks), np.flatnonzero(~asks)
    whole = not len(asked)  # all ask each other
    asked = asking if whole else asked
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(asking), 64):
        i = asking[at : at + 64, None]
        ok = (root[i] != root[asked]) & (np.minimum(size[i], size[asked]) >= similarity * np.maximum(size[i], size[asked]) - 1e-9)
        if whole:
            ok &= i < asked
        x, y = np.nonzero(ok)
        x, y = i[x, 0], asked[y]
        near = np.bitwise_count(f[x] ^ f[y]).sum(1, dtype=np.int64) <= most_bits
        found.append((x[near], y[near]))
    i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    if not len(i):
        return
    both = shared(sets, i, j)
    hit = reaches(both, size[i] + size[j], similarity)
    i, j = i[hit], j[hit]
    if len(i):
        chosen, _ = forests(i, j, np.zeros(len(i), np.int64), np.unique(root, return_inverse=True)[1], 1)
        i, j = node[i[chosen]], node[j[chosen]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], ["a", "b"])


def reaches(both, total, similarity: float):
    """Whether sets that share so many elements of their sizes' total have a Jaccard similarity of at least similarity."""
    return both >= similarity * (total - both) - 1e-9


def shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many elements the sets of each pair i, j share: pair by pair, or by matrices of the elements that come more than once,
    whatever costs less."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    pairwise = int((size[i] + size[j] + 1000).sum())  # costs in units of an element merged
    rows = np.unique(np.concatenate((i, j)))
    if pairwise > 10 * size[rows].sum():
        left, right = np.unique(i), np.unique(j)
        _, column, times = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
        column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[column]
        width = int((times > 1).sum())
        if pairwise > len(left) * len(right) * width // 100:
            order = np.argsort(column, kind="stable")
            order = order[np.searchsorted(column[order], 0) :]
            owner, column = np.repeat(rows, size[rows])[order], column[order]
            both = np.zeros((len(left), len(right)))
            for at in range(0, width, _COLUMNS):
                some = slice(*np.searchsorted(column, (at, at + _COLUMNS)))
                x, y = (_cells(side, owner[some], column[some] - at) for side in (left, right))
                both += x @ y.T
            return both[np.searchsorted(left, i), np.searchsorted(right, j)].astype(np.int64)
    return np.fromiter((_common(sets[a], sets[b]) for a, b in zip(i.tolist(), j.tolist())), np.int64, len(i))


def _cells(side: np.ndarray, owner: np.ndarray, column: np.ndarray) -> np.ndarray:
    """1 where a row of side owns a column."""
    out = np.zeros((len(side), _COLUMNS), np.float32)
    at = np.minimum(np.searchsorted(side, owner), len(side) - 1)
    own = side[at] == owner
    out[at[own], column[own]] = 1
    return out


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many elements two ascending sets share."""
    z = np.sort(np.concatenate((x, y)), kind="stable")
    return int((z[1:] == z[:-1]).sum())


def forests(i: np.ndarray, j: np.ndarray, d: np.ndarray, vertex: np.ndarray, layers: int) -> tuple[np.ndarray, np.ndarray]:
    """The edges of a spanning forest of nearest pairs, of one of what is left, and so on; and what is left of all. vertex: of
    each row. Pairs that come again later are the ones chosen now or are left over again."""
    order = np.lexsort((j, i, d))
    left, out = order, []
    for _ in range(layers):
        part, taken = np.arange(int(vertex.max()) + 1), []
        live = left
        while len(live):
            pi, pj = part[vertex[i[live]]], part[vertex[j[live]]]
            open_ = pi != pj
            live, pi, pj = live[open_], pi[open_], pj[open_]
            if not len(live):
                break
            # each part's nearest edge: edges are in order of distance, so the first one of each
            first = np.full(len(part), len(live))
            rank = np.arange(len(live))
            np.minimum.at(first, pi, rank)
            np.minimum.at(first, pj, rank)
            use = np.unique(first[first < len(live)])
            taken.append(live[use])
            part = _joined(part, pi[use], pj[use])
        if not taken:
            break
        chosen = np.concatenate(taken)
        out.append(chosen)
        left = left[~np.isin(left, chosen)]
    return np.concatenate(out) if out else np.zeros(0, np.int64), left


def _joined(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """part with those joined that edges a, b connect, each named by the least."""
    name = np.arange(len(part))
    while True:
        low = np.minimum(name[a], name[b])
        before = name.copy()
        np.minimum.at(name, a, low)
        np.minimum.at(name, b, low)
        name = name[name]
        if (name == before).all():
            return name[part]


def shingle_sets(nodes: DataFrame, docs: DataFrame, sketched: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """node, size, shingles (the distinct ones, ascending) of each node n."""
    n = nodes.columns[0]
    keys = sketched.join(nodes, F.col("uid") == nodes[n], "left_semi").select("uid", F.col("id").alias("of_id"), "text_key")
    given = docs.select(docs[id_col].alias("id"), _text_key(docs[text_col]).alias("key"), docs[text_col].alias("text"))
    texts = given.join(keys, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("text_key"))).select("uid", "text").dropDuplicates(["uid"])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [distinct_shingles(t.as_py(), width) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
                                                 ["node", "size", "shingles"])

    return texts.mapInArrow(shingles, "node long, size long, shingles binary")


def verified(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The pairs a, b of nodes whose distinct shingles have a Jaccard similarity of at least similarity."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep.append(reaches(_common(x, y), len(x) + len(y), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = written(sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "near-shingles")
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def linked(put: DataFrame, most_bits: int, verify: Callable[[DataFrame], DataFrame], sets: Callable[[DataFrame], DataFrame] | None = None,
           similarity: float = SIMILARITY) -> DataFrame:
    """node and root of what verified pairs connect. Ends once every pair that meets in a bucket within most_bits has been
    verified or lies in one group. sets gives node, size and shingles of nodes: with it, what the buckets have left after the first
    round is verified where it meets, by its similarity, so that a group makes no more rows than it has members. Without it pairs are
    told by verify alone, and each round takes more of what the buckets have left."""
    hot = written(hot_keys(put), "near-hot")
    grouped, read, layers, links, seen = first_round(put, hot), [], FORESTS, [], []
    while True:
        found = written(candidates(grouped, most_bits, layers, cut=not links), "near-found")
        discard(*read)
        pairs = found.where("open is null").select("a", "b")
        for earlier in seen:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        seen.append(written(pairs, "near-pairs"))
        again = bool(links)
        links.append(written(verify(seen[-1]), "near-links"))
        keys = found.where("open is not null").select(F.col("open").alias("key")).distinct()
        keys = written(keys if again else keys.unionByName(hot), "near-keys")
        discard(found)
        labels = connected(reduce(DataFrame.unionByName, links))
        if not keys.isEmpty() and sets is not None:
            grouped, read = later_round(put, keys, labels, sets)
            links.append(written(settled(grouped, most_bits, similarity), "near-links"))
            discard(*read)
            labels = connected(reduce(DataFrame.unionByName, links))
        if keys.isEmpty() or sets is not None:
            discard(keys, hot, *seen, *links)
            return labels
        layers *= MORE if again else 1
        grouped, read = later_round(put, keys, labels)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """uid, id, text_key, keep_uid, keep_id, keep_key for each row of docs: the row of its group that has the
    least id (null last; then the least text key and uid). Groups are what chains of pairs connect whose
    distinct shingles of width words (A-Z lowered; fewer words are one shingle) have a Jaccard similarity
    of similarity or more.

    Rows of equal shingles are one class, always; rows without words are one too. Repeated rows repeat,
    an empty table gives no rows. No pair below the similarity is linked; a pair at it is found with a
    chance of RECALL, closer ones with a greater.
    """
    sketched = written(sketches(docs, id_col, text_col, width), "near-sketches")
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "uid")).alias("least")
    words = [F.first(f"f{k}").alias(f"f{k}") for k in range(WORDS)]
    classes = written(sketched.groupBy("digest").agg(F.min("uid").alias("node"), least, *words), "near-classes")
    some = classes.where("digest is not null")
    n, sums = bit_sums(some)
    if n > 1:
        most_bits = bits_bound(similarity)
        put = put_and_probe(some, make_plan(n, sums, similarity))
        sets = lambda nodes: shingle_sets(nodes, docs, sketched, id_col, text_col, width)
        labels = linked(put, most_bits, lambda pairs: verified(pairs, sets, similarity), sets, similarity)
        named = classes.select("digest", "node", "least").join(labels.select(F.col("node").alias("linked"), "root"), F.col("node") == F.col("linked"), "left")
    else:
        named = classes.select("digest", "node", "least", F.lit(None).cast("long").alias("root"))
    named = named.select("digest", "least", F.coalesce("root", "node").alias("root"))
    leads = named.groupBy("root").agg(F.min("least").alias("lead"))
    of_class = named.select("digest", "root").join(leads, "root").select(F.col("digest").alias("class"), "lead")
    return sketched.join(of_class, F.col("digest").eqNullSafe(F.col("class"))).select(
        "uid", "id", "text_key", F.col("lead.uid").alias("keep_uid"), F.col("lead.id").alias("keep_id"), F.col("lead.text_key").alias("keep_key"))


def near_dedup_stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each group of similar_groups, that of
    least id. Of rows that repeat id and text one stays. An empty table gives no rows."""
    name = free_names(docs, "gone", "gone_key", "again", "again_key")
    found = written(similar_groups(docs, id_col, text_col), "near-found")
    own, kept = F.struct("id", "text_key"), F.struct("keep_id", "keep_key")
    gone = found.where(~own.eqNullSafe(kept)).select(F.col("id").alias(name["gone"]), F.col("text_key").alias(name["gone_key"])).distinct()
    rows = docs.join(gone, docs[id_col].eqNullSafe(F.col(name["gone"])) & (_text_key(docs[text_col]) == F.col(name["gone_key"])), "left_anti")
    again = found.where(own.eqNullSafe(kept)).groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = written(again.select(F.col("id").alias(name["again"]), F.col("text_key").alias(name["again_key"])), "near-again")
    if again.isEmpty():
        return rows
    same = rows[id_col].eqNullSafe(F.col(name["again"])) & (_text_key(rows[text_col]) == F.col(name["again_key"]))
    return rows.join(again, same, "left_anti").unionByName(rows.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))
