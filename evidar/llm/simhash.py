"""SimHash fingerprints of texts: the majority of the hashes of all word shingles, bit by bit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

SEED = 42
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Shingles whose hashes are held at once.
CHUNK = 1 << 16


def shingle_hashes(text: str | None, width: int = 3) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all shingles of width words, A-Z lowered, repeats included, CHUNK at a time;
    fewer words are one shingle, no words give none."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    words = data.split()  # at U+0020 and U+0009 to U+000D only
    if not words:
        return
    body = b" ".join(words)
    if len(words) <= width:
        yield np.array([xxh64_intdigest(body, SEED)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    stops = ends[width - 1 :]
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), stops[at : at + CHUNK].tolist())
        yield np.fromiter((xxh64_intdigest(body[a:b], SEED) for a, b in spans), np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits: each is 1 if set in more than half of the hashes of all shingles; no words give 0."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, width):
        ones += bit_counts(hashes)
        total += len(hashes)
    return int(((ones * 2 > total) * (np.uint64(1) << np.arange(64, dtype=np.uint64))).sum(dtype=np.uint64))


_SPREAD = np.array([[b >> k & 1 for k in range(8)] for b in range(256)], np.int64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, from counts of byte values."""
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(columns) < 256:
        return np.unpackbits(columns, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.concatenate([np.bincount(columns[:, k], minlength=256) @ _SPREAD for k in range(8)])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """id and fingerprint (its 64 bits as a long) of each row of docs. Null and blank texts have 0, long ones are hashed
    part by part, repeated rows repeat, an empty table gives no rows, and other columns play no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {kind}, fp long")
