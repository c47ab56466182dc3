"""Language identification by rank-order n-gram profiles and the out-of-place distance.

A profile is the ranking of the most frequent 1- to 3-grams inside words (a word's ends count as
one blank each). A document gets the language whose profile's ranks differ least from its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidar.llm.common import held_out, release_caches, table

PROFILE_SIZE = 400
DOCUMENT_SIZE = 300
#: Languages whose profiles are collected at most; beyond it learn_profiles raises rather than drop one.
MAX_LANGUAGES = 2000
UNDETERMINED = "und"
_BITS = 21
_DENSE = 48


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as integers (21 bits a character, the first lowest; a word's end
    is 0), ascending, and their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0)
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if (most := int(codes.max())) < 1 << 13:
        seen = np.bincount(codes, minlength=most + 1) > 0
        letters, x = np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]
    else:
        letters, x = np.unique(codes, return_inverse=True)
    n = len(letters)
    if n <= _DENSE:
        # one count for each possible n-gram of this text's few letters; the order is that of the keys
        single = np.bincount(x, minlength=n)
        single[0] = 0
        pairs = x[:-1] + n * x[1:]
        double = np.bincount(pairs, minlength=n * n)
        inner = x[1:-1] != 0
        triple = np.bincount((pairs[:-1] + n * n * x[2:])[inner], minlength=n**3)
        one, two, three = (np.flatnonzero(count) for count in (single, double, triple))
        wide = letters.astype(np.int64)
        keys = np.concatenate((wide[three % n] | wide[three // n % n] << _BITS | wide[three // (n * n)] << 2 * _BITS | -1 << 63,
                               wide[one], wide[two % n] | wide[two // n] << _BITS | 1 << 62))
        return keys, np.concatenate((triple[three], single[one], double[two]))
    inner = x[1:-1] != 0
    wide = letters.astype(np.int64)[x]
    keys = np.concatenate((wide[wide != 0], wide[:-1] | wide[1:] << _BITS | 1 << 62,
                           (wide[:-2] | wide[1:-1] << _BITS | wide[2:] << 2 * _BITS | -1 << 63)[inner]))
    return np.unique(keys, return_counts=True)


def has_letters(text: str | None) -> bool:
    return len(grams(text or "")[0]) > 0


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language, summed over the task."""
    release_caches()
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    pending: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def fold(lang: str) -> None:
        parts = pending.pop(lang, []) + ([total[lang]] if lang in total else [])
        keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        total[lang] = keys, np.bincount(inverse, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (got := grams(text or ""))[0].size:
                pending.setdefault(lang, []).append(got)
                if len(pending[lang]) >= 200:
                    fold(lang)
    for lang in sorted(pending.keys() | total.keys()):
        if lang in pending:
            fold(lang)
        keys, counts = total[lang]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """The size most frequent n-grams of each language (ties by n-gram), from all rows of
    labelled(lang, text). The driver gets at most size rows for each language."""
    counts = labelled.where("lang is not null").select("lang", "text").mapInArrow(_gram_counts, "lang string, gram long, n long")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = totals.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= size)
    rows = ranked.select("lang", "gram", "place").limit(MAX_LANGUAGES * size + 1).collect()
    if len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled")
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.place)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


class Classifier:
    def __init__(self, profiles: dict[str, list[int]], document_size: int = DOCUMENT_SIZE):
        self.langs = sorted(profiles)
        self.document_size = document_size
        self.missing = max((len(p) for p in profiles.values()), default=0)
        self.keys = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.keys, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and 1 less the out-of-place distance as a share of the greatest possible."""
        keys, counts = grams(text or "")
        if not len(keys) or not self.langs:
            return UNDETERMINED, 0.0
        top = keys[np.argsort(-counts, kind="stable")[: self.document_size]]
        at = np.searchsorted(self.keys, top)
        at = np.where(self.keys[np.minimum(at, len(self.keys) - 1)] == top, at, len(self.keys))
        ranks = self.ranks[at]
        distance = np.where(ranks < 0, self.missing, np.minimum(np.abs(ranks - np.arange(len(top))[:, None]), self.missing)).sum(0)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (len(top) * self.missing)


def identify(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score for each row, from the whole text alone. A null text or one
    without letters is `und` with score 0, as is every text where profiles is empty; ties go to the
    language first by code point. Repeated rows repeat, an empty table gives no rows, long texts are taken
    whole, and other columns play no part."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(profiles)
        for batch in batches:
            ids, out, texts = batch.columns
            found = [classifier.predict(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids, out, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), fold_of(docs[id_col]).alias("held_out"), docs[text_col].alias("text"))
    return rows.mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double")


def fold_of(doc_id: Column) -> Column:
    return held_out(doc_id, 4, 2)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~fold_of(docs["doc_id"]) & docs["lang"].isNotNull()).select(docs["lang"], docs["text"])


def language_stage(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language can be told, a null lang filled with the language told; null texts and
    those without a letter go. Where no training row has a language and a letter, no language can be told:
    only these go, and lang stays null. Repeated rows repeat, an empty table gives no rows, long texts are
    taken whole, other columns pass as they are."""
    profiles = learn_profiles(training_rows(docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        classifier = Classifier(profiles)
        for batch in batches:
            at = batch.schema.get_field_index("lang")
            texts = [t.as_py() for t in batch.column(batch.schema.get_field_index("text"))]
            told = [classifier.predict(t)[0] for t in texts]
            stays = [lang != UNDETERMINED or (not classifier.langs and has_letters(t)) for lang, t in zip(told, texts)]
            found = pa.array([None if lang == UNDETERMINED else lang for lang in told], pa.string())
            lang = pc.coalesce(batch.column(at), found.cast(batch.schema.field(at).type))
            yield batch.set_column(at, batch.schema.field(at).name, lang).filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn_profiles(training_rows(docs))).withColumnRenamed("id", "doc_id")
