"""Packing documents into sequences by non-negative least squares on the histogram of lengths.

Documents are cut into full windows and one rest. Rests are binned by length; all combinations
of one to three bins that fill a window are the columns of a least-squares problem whose
non-negative solution says how often to repeat each. Counts are rounded down, and what is left
is packed greedily, length by length. The plan is made from the histogram alone; each piece then
finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidar.llm.common import table, worker_cache, written
from evidar.llm.token_counts import byte_letters, merge_table
from evidar.llm.words import WordCache, grouped

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END_ID = 1
#: Bytes of words, and of pre-tokens, whose ids a worker holds.
CACHED_BYTES = 40 << 20
#: Characters whose ids are found together.
GROUP_CHARS = 1 << 18
BIN = 8
_BIG = 1 << 48
#: Salts among which the pieces of a length are ranked; more where there are more than 20,000 pieces a salt.
SALTS = 256


class Encoder:
    """Ids (little-endian, unsigned, 32 bits) of white-space words as the library gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library, self.table = Tokenizer.from_file(path), merge_table(path)
        self.letters = dict(enumerate(byte_letters()))
        self.known = WordCache(self._pre_tokens, CACHED_BYTES)

    def _ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _pre_tokens(self, tokens: list[str]) -> list[bytes]:
        """Of pre-tokens, by the library's model alone: each byte as its letter."""
        merge, ids, ends = self.library.model.tokenize, [], []
        for token in tokens:
            ids += [t.id for t in merge(token if token.isascii() and token.isprintable() else token.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters))]
            ends.append(4 * len(ids))
        flat = np.array(ids, "<u4").tobytes()
        return [flat[i:j] for i, j in zip([0, *ends], ends)]

    def words(self, words: list[str]) -> list[bytes]:
        # what is one pre-token, lower-case, is named by a string, the others by a list
        parts = [w.lower() if w.isascii() and w.isalpha() else None if "<|" in w else self.table.pre_tokens(w) for w in words]
        new = {p for p in parts if type(p) is str}
        new.update(t for p in parts if type(p) is list for t in p)
        self.known.learn(new)
        get = self.known.__getitem__
        return [get(p) if type(p) is str else self._ids(w) if p is None else get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for w, p in zip(words, parts)]


def cut(texts: list[str | None], path: str, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(index of text, start, length, crc32 of the ids, tokens of the document) of each piece."""
    cache, size = worker_cache(f"ids {path}", lambda: WordCache(Encoder(path).words, CACHED_BYTES)), 4 * window
    done: list[tuple[int, int]] = []
    rest = b""

    def close(i: int) -> Iterator[tuple[int, int, int, int, int]]:
        ids = rest + np.array([END_ID], "<u4").tobytes()
        parts = done + [(len(ids[k : k + size]) // 4, zlib.crc32(ids[k : k + size])) for k in range(0, len(ids), size)]
        total = sum(n for n, _ in parts)
        start = 0
        for n, crc in parts:
            yield i, start, n, crc, total
            start += n

    at = None
    for group, words in grouped(texts, GROUP_CHARS):
        cache.learn(words)
        for i, own in group:
            if at is not None and i != at:
                yield from close(at)
                done, rest = [], b""
            at = i
            rest += b"".join(map(cache.__getitem__, own))
            # a window is closed only once more ids follow, so the rest is never empty
            full = max(0, len(rest) - 1) // size
            done += ((window, zlib.crc32(rest[k * size : (k + 1) * size])) for k in range(full))
            rest = rest[full * size :]
    if at is not None:
        yield from close(at)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens of each piece of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(list(cut(batch.column(1).to_pylist(), path, window)), np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found[:, 0])), *(pa.array(found[:, k]) for k in range(1, 5))],
                                             ["id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(n: int) -> np.ndarray:
    """All (a, b, c) with a >= b >= c >= 0, a > 0 and a + b + c = n; 0 stands for no piece."""
    c, b = np.meshgrid(np.arange(n + 1), np.arange(n + 1), indexing="ij")
    a = n - b - c
    ok = (a >= b) & (b >= c)
    return np.stack([a[ok], b[ok], c[ok]], 1)


def nnls(columns: np.ndarray, goal: np.ndarray, tolerance: float = 0.5) -> np.ndarray:
    """x >= 0 of least |A x - goal|, by active sets; columns[k] lists the rows (1-based, 0: none) that
    column k of A counts. Counts get rounded, so it stops where no slope is above tolerance pieces."""
    n = len(goal)
    x = np.zeros(len(columns))
    chosen: list[int] = []
    matrix = np.zeros((0, n))
    for _ in range(3 * n):
        miss = np.concatenate(([0.0], goal - x[chosen] @ matrix))
        slope = miss[columns].sum(1)
        slope[chosen] = -1
        k = int(np.argmax(slope))
        if slope[k] <= tolerance:
            break
        chosen.append(k)
        matrix = np.vstack([matrix, np.bincount(columns[k], minlength=n + 1)[1:]])
        while chosen:
            gram = matrix @ matrix.T
            gram[np.diag_indices_from(gram)] += 1e-9
            z = np.linalg.solve(gram, matrix @ goal)
            low = z <= 0
            if not low.any():
                x[chosen] = z
                break
            old = x[chosen]
            step = np.min(old[low] / np.maximum(old[low] - z[low], 1e-300))
            moved = old + step * (z - old)
            gone = low & (moved <= 1e-9)
            if not gone.any():
                gone[np.argmin(np.where(low, moved, np.inf))] = True
            moved[gone] = 0
            x[chosen] = moved
            chosen, matrix = [c for c, g in zip(chosen, gone) if not g], matrix[~gone]
    return x


class Plan:
    """Where the piece of each rank among the pieces of its length goes. Built from the counts of lengths."""

    def __init__(self, counts: dict[int, int], window: int = WINDOW, width: int = BIN):
        self.window, self.width = window, width
        have = np.zeros(window + 1, np.int64)
        for length, n in counts.items():
            have[length] = n
        self.full = int(have[window])
        have[window] = 0
        next_sequence = self.full
        bins = window // width
        which = -(-np.arange(window + 1) // width)
        in_bin = np.bincount(which, have, bins + 1).astype(np.int64)
        combos = combinations(bins)
        x = nnls(combos, in_bin[1:].astype(float))
        used = np.zeros(bins + 1, np.int64)
        slots: list[tuple[int, ...]] = []  # bin, first slot, first sequence, and bin and first slot of the pieces before
        for k in sorted(np.flatnonzero(x >= 1), key=lambda k: -x[k]):
            parts = [int(b) for b in combos[k] if b]
            need = np.bincount(parts, minlength=bins + 1)
            n = int(min([int(x[k]), *((in_bin[b] - used[b]) // need[b] for b in set(parts))]))
            if n <= 0:
                continue
            before: list[int] = []
            for b in parts:
                slots.append((b, int(used[b]), next_sequence, *(before + [0, 0, 0, 0])[:4]))
                before += [b, int(used[b])]
                used[b] += n
            next_sequence += n
        # the slots of a bin go to its lengths from the longest down
        self.binned = np.zeros(window + 1, np.int64)
        self.first_slot = np.zeros(window + 1, np.int64)
        edges: list[tuple[int, int, int]] = []
        for b in range(1, bins + 1):
            at = 0
            for length in range(min(b * width, window), (b - 1) * width, -1):
                n = min(int(have[length]), int(used[b]) - at)
                if n > 0:
                    self.binned[length], self.first_slot[length] = n, at
                    edges.append((b, at, length))
                    at += n
        self.slots = np.array(sorted(slots), np.int64).reshape(-1, 7)
        self.edges = np.array(edges, np.int64).reshape(-1, 3)
        self.greedy, self.sequences = self._greedy(have - self.binned, next_sequence)

    def _greedy(self, left: np.ndarray, next_sequence: int) -> tuple[np.ndarray, int]:
        """Patterns of the longest length left and then whatever fits best, each as often as it can be."""
        left, taken = left.copy(), np.zeros(self.window + 1, np.int64)
        there = [int(v) for v in np.flatnonzero(left)]
        out: list[tuple[int, int, int, int]] = []  # length, first rank, first sequence, offset
        while there:
            space, pattern = self.window, []
            at = len(there) - 1
            while at >= 0 and space:
                length = there[at]
                if length <= space:
                    n = min(space // length, int(left[length]))
                    pattern.append((length, n))
                    space -= n * length
                at = min(at, int(np.searchsorted(there, space, side="right"))) - 1
            times = min(int(left[v]) // n for v, n in pattern)
            offset = 0
            for length, n in pattern:
                for _ in range(n):
                    out.append((length, int(taken[length]), next_sequence, offset))
                    taken[length] += times
                    offset += length
                left[length] -= times * n
            next_sequence += times
            there = [v for v in there if left[v]]
        return np.array(sorted(out), np.int64).reshape(-1, 4), next_sequence

    def _length_at(self, b: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Length of the piece in a slot of a bin; 0 where b is 0."""
        if not len(self.edges):
            return np.zeros(len(b), np.int64)
        at = np.searchsorted(self.edges[:, 0] * _BIG + self.edges[:, 1], b * _BIG + slot, side="right") - 1
        return np.where(b > 0, self.edges[np.maximum(at, 0), 2], 0)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and ranks (from 0)."""
        sequence, offset = rank.copy(), np.zeros(len(rank), np.int64)
        part = (length < self.window) & (rank < self.binned[length])
        if part.any():
            slot = self.first_slot[length[part]] + rank[part]
            bins = -(-length[part] // self.width)
            at = np.searchsorted(self.slots[:, 0] * _BIG + self.slots[:, 1], bins * _BIG + slot, side="right") - 1
            row = self.slots[at]
            step = slot - row[:, 1]
            sequence[part] = row[:, 2] + step
            offset[part] = self._length_at(row[:, 3], row[:, 4] + step) + self._length_at(row[:, 5], row[:, 6] + step)
        part = (length < self.window) & ~part
        if part.any():
            own = rank[part] - self.binned[length[part]]
            at = np.searchsorted(self.greedy[:, 0] * _BIG + self.greedy[:, 1], length[part] * _BIG + own, side="right") - 1
            row = self.greedy[at]
            sequence[part] = row[:, 2] + own - row[:, 1]
            offset[part] = row[:, 3]
        return sequence, offset

def ranked(rows: DataFrame, salts: int) -> DataFrame:
    """rows with their rank (from 0) among the rows of their length, by salt, id, start. No task
    gets all rows of a length: rows are ranked within a salt, and counts by salt are summed up."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32", "doc_tokens"))
    return salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own") - 1)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece.

    Every id of every row lies in exactly one piece. A null text counts as empty and gives a
    piece of the end id alone; rows that repeat are packed each; an empty table gives no rows; a very
    long text fills many sequences; other columns play no part.
    """
    spark = docs.sparkSession
    rows = written(pieces(docs, path, id_col, text_col), "pack-pieces")
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(Plan(counts))
    salts = max(SALTS, sum(counts.values()) // 20_000)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            sequence, offset = plan.value.place(get("length").to_numpy(zero_copy_only=False), get("rank").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*(get(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(sequence), pa.array(offset)],
                                             ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked(rows, salts).select("id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        place, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def packing_stage(docs: DataFrame) -> DataFrame:
    """The pieces of docs as in pack(), with doc_id."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path(VOCABULARY)).withColumnRenamed("id", "doc_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_stage(table(spark, sf_dir, "documents"))
