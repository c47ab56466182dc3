"""Chroma audio fingerprints and their alignment.

A recording becomes frames of twelve pitch classes. Filters, each the difference of two groups of
rectangles of that image, are read off its integral image at every frame and quantised to two bits;
sixteen make a packed integer. Recordings that share integers are aligned by a histogram of the
offsets between them, and the share of bits that differ at an offset says whether they match there.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import table, written

RATE = 5512
FRAME = 2048
HOP = 682
LOW_HZ, HIGH_HZ = 55.0, 2600.0
# The filter bank published with the chroma fingerprint.
#: Kind, first pitch class, pitch classes, frames of each filter. Kinds: 0 sum; 1 upper less lower
#: pitch half; 2 later less earlier half; 3 the two diagonals; 4 middle less outer thirds in pitch; 5 in time.
FILTERS = (
    (0, 4, 3, 15), (4, 4, 6, 15), (1, 0, 4, 16), (3, 8, 2, 12),
    (3, 4, 4, 8), (4, 0, 3, 5), (1, 2, 2, 9), (2, 7, 3, 4),
    (2, 6, 2, 16), (2, 1, 3, 2), (5, 10, 1, 15), (3, 6, 2, 10),
    (2, 1, 1, 14), (3, 5, 6, 4), (1, 9, 2, 12), (3, 4, 2, 14),
)
SPREAD = 0.12
#: Two-bit codes of the four levels; neighbours differ in one bit.
LEVEL_CODES = np.array([0, 1, 3, 2], np.uint32)
WIDEST = max(f[3] for f in FILTERS)
#: An alignment needs so many equal integers, so many frames in common, and no more bit errors than this share.
MIN_EQUAL, MIN_OVERLAP, MAX_ERROR = 2, 20, 0.25


def decode_wav(data: bytes | None) -> np.ndarray | None:
    """Mono samples at RATE of PCM WAV bytes (8, 16 or 32 bits); None for anything else."""
    if not data or len(data) < 44 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None
    at, form, body = 12, None, None
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt " and size >= 16:
            form = struct.unpack_from("<HHIIHH", data, at + 8)
        elif name == b"data":
            body = data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    if form is None or body is None or form[0] != 1 or form[5] not in (8, 16, 32) or not form[1] or not form[2]:
        return None
    kind = {8: "u1", 16: "<i2", 32: "<i4"}[form[5]]
    step = form[1] * form[5] // 8
    x = np.frombuffer(body[: len(body) // step * step], kind).reshape(-1, form[1]).astype(np.float64).mean(1)
    x = (x - 128) / 128 if form[5] == 8 else x / 2.0 ** (form[5] - 1)
    if form[2] != RATE and len(x):
        x = np.interp(np.arange(int(len(x) * RATE / form[2])) * form[2] / RATE, np.arange(len(x)), x)
    return x


def encode_wav(x: np.ndarray, rate: int = RATE) -> bytes:
    body = np.clip(np.round(x * 32767), -32768, 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate * 2, 2, 16) + b"data" + struct.pack("<I", len(body)) + body


@lru_cache(1)
def _pitch_classes() -> np.ndarray:
    """Which FFT bin adds to which pitch class."""
    hz = np.arange(FRAME // 2 + 1) * RATE / FRAME
    out = np.zeros((len(hz), 12))
    use = np.flatnonzero((hz >= LOW_HZ) & (hz <= HIGH_HZ))
    out[use, np.round(12 * np.log2(hz[use] / 440.0)).astype(int) % 12] = 1.0
    return out


def chroma(x: np.ndarray) -> np.ndarray:
    """Pitch-class frames: smoothed over five frames, each of length 1 (or 0 where it is silent)."""
    if len(x) < FRAME:
        return np.zeros((0, 12))
    window, out = np.hanning(FRAME), []
    starts = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    for at in range(0, len(starts), 512):
        out.append(np.abs(np.fft.rfft(starts[at : at + 512] * window)) ** 2 @ _pitch_classes())
    image = np.concatenate(out)
    padded = np.pad(image, ((2, 2), (0, 0)))
    image = sum(w * padded[k : k + len(image)] for k, w in enumerate((0.25, 0.75, 1.0, 0.75, 0.25)))
    norm = np.sqrt((image**2).sum(1, keepdims=True))
    return np.where(norm > 1e-4, image / np.maximum(norm, 1e-12), 0.0)


def fingerprint(x: np.ndarray) -> np.ndarray:
    """One packed integer for each frame at which the widest filter fits."""
    image = chroma(x)
    n = len(image) - WIDEST + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    integral = np.zeros((len(image) + 1, 13))
    integral[1:, 1:] = image.cumsum(0).cumsum(1)
    t = np.arange(n)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        """Sum over frames t0 to t1 (from each frame on) and pitch classes p0 to p1."""
        return integral[t + t1, p1] - integral[t + t0, p1] - integral[t + t1, p0] + integral[t + t0, p0]

    packed = np.zeros(n, np.uint32)
    for kind, p, height, width in FILTERS:
        top, half_p, half_t = min(12, p + height), (p + min(12, p + height)) // 2, width // 2
        whole = area(0, width, p, top)
        if kind == 0:
            a, b = whole, area(0, width, 0, 12) - whole
        elif kind == 1:
            a, b = area(0, width, half_p, top), area(0, width, p, half_p)
        elif kind == 2:
            a, b = area(half_t, width, p, top), area(0, half_t, p, top)
        elif kind == 3:
            a = area(0, half_t, half_p, top) + area(half_t, width, p, half_p)
            b = whole - a
        elif kind == 4:
            third = (top - p) // 3
            a = area(0, width, p + third, top - third)
            b = whole - a
        else:
            third = width // 3
            a = area(third, width - third, p, top)
            b = whole - a
        value = np.log((1 + a) / (1 + b))
        level = np.searchsorted([-SPREAD, 0.0, SPREAD], value, side="right")
        packed = packed << np.uint32(2) | LEVEL_CODES[level]
    return packed


def render(vector: np.ndarray, note_s: float = 0.2) -> bytes:
    """A vector as a recording: one note of two partials for each component, its pitch by its value."""
    n = int(RATE * note_s)
    pitch = np.clip(np.round((np.nan_to_num(np.asarray(vector, np.float64)) + 0.4) * 30), 0, 23)
    phase = 2 * np.pi * np.cumsum(np.repeat(220.0 * 2 ** (pitch / 12), n) / RATE)
    return encode_wav(0.5 * np.sin(phase) + 0.2 * np.sin(2 * phase))


def _prints(ids: pa.Array, found: list[np.ndarray | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([None if f is None else f.view(np.int32).tolist() for f in found], pa.list_(pa.int32()))], ["id", "print"])


def fingerprint_media(media: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """id and print (packed integers, null where the bytes are no recording) of a column of WAV bytes. Repeated rows
    repeat, an empty table gives no rows, long recordings are taken whole, and other columns play no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                sounds = [decode_wav(m) for m in part.column(1).to_pylist()]
                yield _prints(part.column(0), [None if s is None else fingerprint(s) for s in sounds])

    kind = media.schema[id_col].dataType.simpleString()
    return media.select(media[id_col].alias("id"), media[media_col].alias("media")).mapInArrow(run, f"id {kind}, print array<int>")


def fingerprint_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """As fingerprint_media, of the recordings that render() makes of vectors; these exist one at a time only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [None if not v else fingerprint(decode_wav(render(np.array(v, np.float64)))) for v in part.column(1).to_pylist()]
                yield _prints(part.column(0), found)

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("vector")).mapInArrow(run, f"id {kind}, print array<int>")


def bit_error(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[int, float]:
    """Frames in common and the share of their bits that differ, with b's frame k + offset over a's frame k."""
    start, stop = max(0, -offset), min(len(a), len(b) - offset)
    if stop <= start:
        return 0, 1.0
    return stop - start, float(np.bitwise_count(a[start:stop] ^ b[start + offset : stop + offset]).mean()) / 32


def align(prints: DataFrame, is_query: str = "id % 50 = 0") -> DataFrame:
    """id, class_id, n_frames, links for each row of prints(id, print).

    Recordings of equal print are one class, named by its least id (null if none has one). A class
    with a row for which is_query holds is searched for among all classes: links has every other
    class that shares MIN_EQUAL integers at one offset and there, over MIN_OVERLAP frames, differs in
    MAX_ERROR of the bits at most, with offset and bit_error. Of several such offsets it is that of most
    equal integers, then the least. Classes of no query have null links.
    A null or empty print belongs to no class. Repeated rows repeat.
    """
    rows = prints.withColumn("class", F.when(F.size("print") > 0, F.sha2(F.concat_ws(",", F.col("print").cast("array<string>")), 256)))
    rows = written(rows.select("id", "class", "print", F.coalesce(F.expr(is_query), F.lit(False)).alias("asks")), "audio-prints")
    classes = written(rows.where("class is not null").groupBy("class").agg(
        F.min("id").alias("class_id"), F.max("asks").alias("asks"), F.first("print").alias("print")), "audio-classes")
    frames = classes.select("class", "asks", F.posexplode("print").alias("at", "value"))
    asked = frames.where("asks").select(F.col("class").alias("query"), F.col("at").alias("query_at"), "value")
    # each class counts a value once for each frame; offsets are counted before anything is gathered
    votes = asked.join(frames.select("class", "at", "value"), "value").where("query <> class").groupBy(
        "query", "class", (F.col("at") - F.col("query_at")).alias("offset")).agg(F.count(F.lit(1)).alias("equal"))
    # a row a pair with all its offsets, at most as many as both have frames; the best come first
    offsets = votes.where(F.col("equal") >= MIN_EQUAL).groupBy("query", "class").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("equal")).alias("n"), "offset")))["offset"].alias("offsets"))
    pairs = offsets.join(classes.select("class", F.col("class_id").alias("found_id"), F.col("print").alias("found_print")), "class")
    pairs = pairs.join(classes.select(F.col("class").alias("query"), F.col("print").alias("query_print")), "query")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, best, errors = [], [], []
            for k, (a, b, offsets) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))):
                a, b = np.array(a, np.int32), np.array(b, np.int32)
                for offset in offsets:
                    n, error = bit_error(a, b, offset)
                    if n >= MIN_OVERLAP and error <= MAX_ERROR:
                        keep.append(k)
                        best.append(offset)
                        errors.append(error)
                        break
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in (0, 1)), pa.array(best, pa.int32()), pa.array(errors, pa.float64())], ["query", "class_id", "offset", "bit_error"])

    kind = prints.schema["id"].dataType.simpleString()
    found = pairs.select("query", "found_id", "query_print", "found_print", "offsets").mapInArrow(verify, f"query string, class_id {kind}, offset int, bit_error double")
    links = found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("class_id", "offset", "bit_error"))).alias("links"))
    named = classes.select("class", "class_id", "asks").join(links, F.col("class") == F.col("query"), "left").select(
        "class", "class_id", F.when(F.col("asks"), F.coalesce("links", F.array().cast(links.schema["links"].dataType))).alias("links"))
    return rows.select("id", F.col("class").alias("own"), F.coalesce(F.size("print"), F.lit(0)).alias("n_frames")).join(
        named, F.col("own") == F.col("class"), "left").select("id", "class_id", "n_frames", "links")


def op8_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(fingerprint_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")).withColumnRenamed("id", "vec_id")
