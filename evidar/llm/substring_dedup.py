"""Substring dedup by sliding sentence spans.

From every sentence on, the run of the fewest sentences (SPAN_SENTENCES and SPAN_WORDS at least) is
hashed, the hashes of all documents are joined, and the sentences that a non-first occurrence of a
repeated run covers are removed. Sentences are parted after words that their own hash picks, whatever
stands around them, so that a passage is parted alike wherever it stands. In scripts that put no
space between words each character counts as a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import table, written

SPAN_SENTENCES = 3
SPAN_WORDS = 20
#: A word in so many ends a sentence by its hash.
PARTED = 4
#: Characters taken at once; of longer texts only a few numbers for each word are held whole.
WINDOW = 1 << 17
_SPACE, _LINE, _UNSPACED, _STOP, _WIDE_STOP, _CLOSER = 1, 2, 4, 8, 16, 32
#: Thai to Tibetan, Myanmar, Khmer, kana and Han with their punctuation.
_UNSPACED_RANGES = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
                    (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF01, 0xFF9F), (0x20000, 0x3FFFF))
#: Two odd multipliers, so that words and runs have hashes of 128 bits.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@lru_cache(1)
def _kinds() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    out[[c for c in range(0x3001) if chr(c).isspace()]] |= _SPACE
    out[ord("\n")] |= _LINE
    for low, high in _UNSPACED_RANGES:
        out[low : high + 1] |= _UNSPACED
    for flag, letters in ((_STOP, ".!?"), (_WIDE_STOP, "\u3002\uff01\uff1f"), (_CLOSER, "\"'»”)]\u300d\u300f\uff09")):
        out[[ord(c) for c in letters]] |= flag
    return out


@lru_cache(16)
def _table(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers, or a few more, from a table of one of few sizes."""
    return _table(base, 1 << next(b for b in (16, 21, 26, 31) if n <= 1 << b))


_INVERSE = {b: pow(b, -1, 1 << 64) for b in _BASES}


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """The polynomial in base, modulo 2**64, of values[start:stop] for each start and stop; it is the same wherever they stand."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n)[:n], out=total[1:])
    return (total[stops] - total[starts]) * _powers(_INVERSE[base], n)[starts]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _window(codes: np.ndarray, last: bool) -> tuple[np.ndarray, ...]:
    """Starts, ends (with the white space after it), two hashes and cut flag of the words that begin in codes,
    less the last one unless the text ends here."""
    kind = _kinds()[codes]
    solid, apart = (kind & _SPACE) == 0, (kind & _UNSPACED) != 0
    new = solid.copy()
    new[1:] &= ~solid[:-1] | apart[:-1] | apart[1:]
    starts = np.flatnonzero(new)
    if not len(starts):
        return starts, starts, starts.astype(np.uint64), starts.astype(np.uint64), starts.astype(bool)
    place = np.arange(len(codes))
    following = np.append(starts[1:], len(codes))
    stops = np.maximum.accumulate(np.where(solid, place, -1))[following - 1] + 1
    letters = codes.astype(np.uint64) + np.uint64(1)
    first, second = (_mixed(_sums(letters, starts, stops, b)) for b in _BASES)
    gap = following > stops
    lines, blanks = np.zeros(len(codes) + 1, np.int64), np.zeros(len(codes) + 1, np.int64)
    np.cumsum((kind & _LINE) != 0, out=lines[1:])
    np.cumsum(~solid, out=blanks[1:])
    cut = (first >> np.uint64(32)) % np.uint64(PARTED) == 0
    cut |= lines[following] > lines[stops]
    # the last letter that closes nothing: a full stop there ends the sentence
    plain = np.maximum.accumulate(np.where(solid & ((kind & _CLOSER) == 0), place, -1))[stops - 1]
    there = np.maximum(plain, 0)
    cut |= gap & (plain >= starts) & ((kind[there] & _STOP) != 0)
    closes = np.append(kind, 0)[following] & _CLOSER != 0
    cut |= (plain >= 0) & ((kind[there] & _WIDE_STOP) != 0) & (blanks[stops] == blanks[there]) & (gap | ~closes)
    return tuple(x if last else x[:-1] for x in (starts, following, first, second, cut))


class Group:
    """Some texts, parted. ends, first, second: of each word; cuts: the words (from 1) after which a sentence
    ends; sentence_of: of each text the first of its sentences, and at last their number."""

    def __init__(self, texts: list[str]):
        # the line ends between the texts end sentences too
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        at, size, found = 0, WINDOW, []
        while True:
            last = at + size >= len(codes)
            starts, *rest = _window(codes[at : at + size], last)
            if not last and not len(starts):
                size *= 2  # one word fills the window
                continue
            found.append((starts + at, rest[0] + at, *rest[1:]))
            if last:
                break
            at, size = int(found[-1][1][-1]), WINDOW
        starts, self.ends, self.first, self.second, cut = (np.concatenate(x) for x in zip(*found))
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths + 1)))
        words = np.searchsorted(starts, self.offsets)  # of each text the first of its words
        cut[words[1:][words[1:] > 0] - 1] = True
        self.cuts = np.flatnonzero(cut) + 1
        self.sentence_of = np.searchsorted(self.cuts, words, side="right")
        self.before = np.concatenate(([0], self.cuts))

    def ranges(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each sentence of a text; together they are the whole text. One without words has none."""
        stops = self.ends[self.cuts[self.sentence_of[i] : self.sentence_of[i + 1]] - 1] - self.offsets[i]
        stops[-1:] = self.lengths[i]
        return np.concatenate(([0], stops[:-1])) if len(stops) else stops, stops

    def run_ends(self, how: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """The sentences with which a run begins, and where it ends, as far as runs end in their text."""
        n = len(self.cuts)
        starts = np.arange(n)
        ends = np.maximum(starts + how[0], np.searchsorted(self.before, self.before[:-1] + how[1]))
        fits = np.flatnonzero(ends <= np.repeat(self.sentence_of[1:], np.diff(self.sentence_of)))
        return fits, ends[fits]

    def runs(self, how: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First sentence, its end and two hashes of each run."""
        starts, ends = self.run_ends(how)
        return starts, ends, *(_mixed(_sums(words, self.before[starts], self.before[ends], b)) for words, b in zip((self.first, self.second), _BASES))


def groups(texts: pa.Array, size: int = WINDOW) -> Iterator[tuple[int, Group]]:
    """Index of the first text, and the texts from there on, of about size characters together; null counts as empty."""
    at, held, chars = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py() or "")
        chars += len(held[-1])
        if chars >= size:
            yield at, Group(held)
            at, held, chars = i + 1, [], 0
    if held:
        yield at, Group(held)


def sentences(text: str) -> list[tuple[int, int]]:
    starts, stops = Group([text]).ranges(0)
    return list(zip(starts.tolist(), stops.tolist()))


def spans(text: str, how: tuple[int, int] = (SPAN_SENTENCES, SPAN_WORDS)) -> list[tuple[tuple[int, int], int, int]]:
    """(hash, first sentence, sentences) of each run."""
    starts, ends, first, second = (x.tolist() for x in Group([text]).runs(how))
    return [(h, i, stop - i) for i, stop, h in zip(starts, ends, zip(first, second))]


def _key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """32 bits of id and text: tells rows of one id apart."""
    return F.xxhash64(docs[id_col], docs[text_col]).bitwiseAND(0xFFFFFFFF)


def span_table(docs: DataFrame, id_col: str, text_col: str, how: tuple[int, int]) -> DataFrame:
    """span and check (the hashes), id and at: the row's key, the first sentence and whether the run stands
    earlier in the document, in 32, 31 and 1 bits of one number, since this table is the largest that is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for at, group in groups(batch.column(2)):
                starts, _, span, check = group.runs(how)
                text = np.searchsorted(group.sentence_of, starts, side="right") - 1
                order = np.lexsort((starts, check, span, text))
                same = (text[order][1:] == text[order][:-1]) & (span[order][1:] == span[order][:-1]) & (check[order][1:] == check[order][:-1])
                again = np.zeros(len(starts), bool)
                again[order[1:][same]] = True
                place = keys[at + text] << 32 | (starts - group.sentence_of[text]) << 1 | again
                for k in range(0, len(starts), 50_000):
                    part = slice(k, k + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(span.view(np.int64)[part]), pa.array(check.view(np.int64)[part]), batch.column(0).take(pa.array(at + text[part])), pa.array(place[part])],
                        ["span", "check", "id", "at"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(docs[id_col].alias("id"), _key(docs, id_col, text_col).alias("doc"), docs[text_col].alias("text"))
    return given.mapInArrow(run, f"span long, check long, id {kind}, at long")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: tuple[int, int] = (SPAN_SENTENCES, SPAN_WORDS)) -> DataFrame:
    """id, doc, runs: for each document the first sentences of the runs that stand earlier, in a document
    of lesser id (null last) or before in the same one."""
    found = span_table(docs, id_col, text_col, how)
    # a table of its own, so that the join has shuffled both sides and can split a span that is everywhere;
    # the spans themselves are cheaper to make again than to keep
    twice = written(found.groupBy("span", "check").agg(F.count(F.lit(1)).alias("times"), F.min("id").alias("first_id")).where("times > 1").select(
        F.col("span").alias("s"), F.col("check").alias("c"), "first_id"), "spans-repeated")
    again = F.col("at").bitwiseAND(1) == 1
    later = found.join(twice, (F.col("span") == F.col("s")) & (F.col("check") == F.col("c"))).where(again | ~F.col("id").eqNullSafe(F.col("first_id")))
    place = F.shiftright(F.col("at").bitwiseAND(0xFFFFFFFF), 1).cast("int")
    return later.select("id", F.shiftrightunsigned("at", 32).alias("doc"), place.alias("first")).groupBy("id", "doc").agg(F.collect_list("first").alias("runs"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: tuple[int, int] = (SPAN_SENTENCES, SPAN_WORDS)) -> DataFrame:
    """id, n_sentences, n_removed, removed (ranges of characters), text (what is left) for each row of docs.

    Null text counts as empty. A null id comes after all others; rows that repeat an id count as one
    place, so of rows that repeat id and text none loses what only they share. An empty table gives
    no rows. Texts with fewer sentences or words than a run have no runs and stay whole. Very long texts
    are parted in windows. Other columns of docs, whatever their names, play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            runs = batch.column(2)
            for at, group in groups(batch.column(1)):
                starts, ends = group.run_ends(how)
                end_of = np.zeros(len(group.cuts) + 1, np.int64)
                end_of[starts] = ends
                counts, removed, left = np.diff(group.sentence_of), [], []
                gone_of = np.zeros(len(counts), np.int64)
                for i in range(len(counts)):
                    text, firsts = batch.column(1)[at + i].as_py() or "", runs[at + i].as_py()
                    cut: list[tuple[int, int]] = []
                    if firsts:
                        first = group.sentence_of[i]
                        cover = np.zeros(counts[i] + 1, np.int64)
                        np.add.at(cover, firsts, 1)
                        np.add.at(cover, end_of[first + np.array(firsts)] - first, -1)
                        gone = np.concatenate(([False], np.cumsum(cover)[:-1] > 0, [False]))
                        edges = np.flatnonzero(gone[1:] != gone[:-1])
                        start, stop = group.ranges(i)
                        cut = list(zip(start[edges[::2]].tolist(), stop[edges[1::2] - 1].tolist()))
                        gone_of[i] = gone.sum()
                    removed.append([{"start": a, "stop": b} for a, b in cut])
                    left.append("".join(text[a:b] for a, b in zip([0, *(b for _, b in cut)], [*(a for a, _ in cut), len(text)])) if cut else text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(counts)), pa.array(counts), pa.array(gone_of), pa.array(removed, kind), pa.array(left, pa.string())],
                    ["id", "n_sentences", "n_removed", "removed", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    later = repeats(docs, id_col, text_col, how).select(F.col("id").alias("later_id"), F.col("doc").alias("later_doc"), "runs")
    given = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), _key(docs, id_col, text_col).alias("doc"))
    joined = given.join(later, (F.col("doc") == F.col("later_doc")) & F.col("id").eqNullSafe(F.col("later_id")), "left")
    return joined.select("id", "text", "runs").mapInArrow(
        run, f"id {kind}, n_sentences long, n_removed long, removed array<struct<start:int,stop:int>>, text string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_sentences", "n_removed", "removed", F.length("text").alias("chars_left"), F.sha2("text", 256).alias("left_sha256"))
