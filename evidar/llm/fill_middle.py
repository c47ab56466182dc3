"""Fill-in-middle documents, cut by an overlapping-chunk decomposition.

Whether a unit (a character, a word, a line) begins at a byte is a predicate of that byte and the one
before it. So the bytes of a batch of texts lie in chunks that overlap by one byte, each chunk counts its
boundaries by itself, all of them at once, and prefix sums of the counts tell for the rank of a cut which
chunk owns it. Only the owning chunks are scanned again. What comes back from Python is two byte
offsets a document; pieces, output and restored text are put together by Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import free_names, table

SEED = 1
#: Of 100 documents, those left plain, and of the others those whose suffix comes first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a chunk, and chunks whose boundaries are counted at once.
CHUNK, CHUNKS = 4096, 512

Predicate = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _space(b: np.ndarray) -> np.ndarray:
    return (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))


#: Whether a unit begins at a byte of a UTF-8 text, by the byte before it and itself.
UNITS: dict[str, Predicate] = {
    "character": lambda before, here: (here & 0xC0) != 0x80,
    "word": lambda before, here: _space(before) & ~_space(here),
    "line": lambda before, here: before == 0x0A,
}


class Chunks:
    """The chunks of texts that lie one after another in data; text i is data[bounds[i]:bounds[i + 1]]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, begins: Predicate):
        self.data, self.bounds, self.begins = data, bounds, begins
        sizes = np.diff(bounds)
        n = -(-sizes // CHUNK)
        first = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(sizes)), n)
        self.start = bounds[owner] + (np.arange(len(owner)) - first[owner]) * CHUNK
        self.stop = np.minimum(self.start + CHUNK, bounds[owner + 1])
        self.heads = np.repeat(False, len(owner))
        self.heads[first[n > 0]] = True
        counts = [self._counted(at, min(at + CHUNKS, len(owner))) for at in range(0, len(owner), CHUNKS)]
        self.upto = np.cumsum(np.concatenate([np.zeros(1, np.int64), *counts]))
        self.before = self.upto[first]
        self.units = self.upto[first + n] - self.before + (sizes > 0)

    def _mask(self, low: int, high: int) -> np.ndarray:
        """The predicate at each of these bytes; the first looks at one byte more."""
        here = self.data[low:high]
        before = self.data[low - 1 : high - 1] if low else np.concatenate([np.zeros(1, np.uint8), here[:-1]])
        return self.begins(before, here)

    def _counted(self, at: int, to: int) -> np.ndarray:
        low = self.start[at]
        mask = self._mask(low, self.stop[to - 1])
        mask[self.start[at:to][self.heads[at:to]] - low] = False  # a text's first byte is no boundary
        return np.add.reduceat(mask, self.start[at:to] - low, dtype=np.int64)

    def cut(self, rank: np.ndarray) -> np.ndarray:
        """For each text the byte, from its start, at which its first rank units end."""
        out = np.where(rank < self.units, 0, np.diff(self.bounds))
        inner = np.flatnonzero((rank > 0) & (rank < self.units))
        sought = self.before[inner] + rank[inner]
        owner = np.searchsorted(self.upto, sought, side="left") - 1
        for i, k, nth in zip(inner.tolist(), owner.tolist(), (sought - self.upto[owner]).tolist()):
            mask = self._mask(self.start[k], self.stop[k])
            if self.heads[k]:
                mask[0] = False
            out[i] = self.start[k] + np.flatnonzero(mask)[nth - 1] - self.bounds[i]
        return out


_CUT = "struct<n: bigint, low: bigint, high: bigint, low_byte: int, high_byte: int>"


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts, one after another, and where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if offsets else np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds


def cuts(unit: str) -> Callable[..., Column]:
    """A function of text (not null) and two draws: units, both ranks of cuts and their bytes."""
    begins = UNITS[unit]

    @F.arrow_udf(_CUT)
    def found(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, one, other in batches:
            chunks = Chunks(*text_bytes(texts), begins)
            ranks = [d.to_numpy(zero_copy_only=False) % (chunks.units + 1) for d in (one, other)]
            low, high = np.minimum(*ranks), np.maximum(*ranks)
            columns = [chunks.units, low, high, chunks.cut(low).astype(np.int32), chunks.cut(high).astype(np.int32)]
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], ["n", "low", "high", "low_byte", "high_byte"])

    return found


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 that a document draws, the same in every run; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _bytes(*parts: Column | str) -> Column:
    """The parts one after another, as text."""
    return F.concat(*(F.lit(p).cast("binary") if isinstance(p, str) else p for p in parts)).cast("string")


def restored(output: Column, form: Column) -> Column:
    """The text that output was made of."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    at = lambda k: F.get(part, F.lit(k))
    return F.when(form == "plain", output).when(form == "psm", F.concat(at(1), at(3), at(2))).otherwise(F.concat(at(2), at(3), at(1)))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "character", seed: int = SEED,
                   plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """id, n (units), form (plain, psm or spm), prefix_units, middle_units (null if plain) and output of each row of docs.

    Null text counts as empty, and an empty one is plain, as is one that holds a marker. A null id draws as an
    empty one. Rows that repeat id and text come out alike, once each. A very long text is more chunks. Where
    both cuts fall on one place the middle is empty. An empty table gives no rows. Other columns play no part.
    """
    name = free_names(docs, "id", "text", "draw", "cut")
    rows = docs.select(docs[id_col].alias(name["id"]), F.coalesce(docs[text_col], F.lit("")).alias(name["text"]))
    text, draw = F.col(name["text"]), draws(F.col(name["id"]), seed)
    rows = rows.withColumn(name["cut"], cuts(unit)(text, draw[0], draw[1]))
    cut = lambda field: F.col(f"{name['cut']}.{field}")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (draw[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    raw = text.cast("binary")
    prefix = F.substring(raw, F.lit(1), cut("low_byte"))
    middle = F.substring(raw, cut("low_byte") + 1, cut("high_byte") - cut("low_byte"))
    suffix = F.substring(raw, cut("high_byte") + 1, F.lit(2**31 - 1))
    output = F.when(form == "plain", text).when(form == "psm", _bytes(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)).otherwise(
        _bytes(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return rows.select(
        F.col(name["id"]).alias("id"), cut("n").alias("n"), form.alias("form"), F.when(form != "plain", cut("low")).alias("prefix_units"),
        F.when(form != "plain", cut("high") - cut("low")).alias("middle_units"), output.alias("output"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP11_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
u AS (SELECT doc_id, x, length(x) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
             ('0x' || h[25:32])::BIGINT AS h4 FROM t),
v AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
w AS (SELECT *, substring(x, 1, a) AS p, substring(x, a + 1, b - a) AS m, substring(x, b + 1, n - b) AS s FROM v)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM w
"""
