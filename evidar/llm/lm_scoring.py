"""Language-model scores by subword lattice likelihood.

The vocabulary and its scores are an existing model's. The scores of this vocabulary are ranks of merges, not
log probabilities, so they weight pieces by exp(score / heat), the heat being fitted to the training words.
Under these weights, as a prior worth PRIOR_PIECES pieces, the probability of each piece is learned from the
words of the training documents by expectation maximisation over all segmentations. A document's score is the log10 of its probability summed over all segmentations of its words, and of
the end. Beside it stands the score of an add-one word unigram model, whose counts are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import held_out, table, worker_cache, written
from evidar.llm.lattice import Lattice, Vocabulary, vocabulary
from evidar.llm.simhash import _LOWER
from evidar.llm.words import CHUNK_CHARS, WordCache

VOCABULARY = "piece_bpe_32k.model"
EM_ROUNDS = 3
#: Pieces that the existing scores count for beside the training words.
PRIOR_PIECES = 10_000.0
#: The most frequent words whose counts every executor gets; all others are joined.
HEAD_WORDS = 250_000
#: Bytes of words whose scores a worker holds.
CACHED_BYTES = 128 << 20
#: Characters whose new words are scored together: the more there are, the more words of a length go through one array.
GROUP_CHARS = 1 << 22
#: Words whose pieces are counted together.
GROUP_WORDS = 100_000
#: Words counted in a task before they are passed on.
HELD_WORDS = 400_000
_LN10 = math.log(10)
_SPACES = b"\t\n\x0b\x0c\r "


def word_chunks(text: str | None) -> Iterator[list[str]]:
    """The words of a text, A-Z lowered, in lists of about CHUNK_CHARS bytes."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    at = 0
    while at < len(data):
        end = at + CHUNK_CHARS
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        # bytes.split() splits at these six bytes only; str.split() would at others too
        yield b" ".join(data[at:end].split()).decode("utf-8", "surrogatepass").split(" ") if data[at:end].strip() else []
        at = end


def count_words(texts: DataFrame) -> DataFrame:
    """word, n over the only column of texts; added up in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def drain() -> Iterator[pa.RecordBatch]:
            words = list(total)
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([total[w] for w in part], pa.int64())], ["word", "n"])
            total.clear()

        for batch in batches:
            for text in batch.column(0):
                for words in word_chunks(text.as_py()):
                    total.update(words)
                    if len(total) > HELD_WORDS:
                        yield from drain()
        yield from drain()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learn(counts: DataFrame, documents: int, path: str, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Natural log probability of each piece, byte and the end, from word, n. Each round is one pass
    over the counted words; the driver gets one sum for each entry of the vocabulary."""
    vocab = vocabulary(path)
    log_p = vocab.first_guess()
    spark = counts.sparkSession
    for _ in range(rounds if documents else 0):
        given = spark.sparkContext.broadcast(log_p)

        def expect(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(vocabulary(path), given.value)
            total, words, times = np.zeros(vocabulary(path).size), [], []
            for batch in batches:
                words += batch.column(0).to_pylist()
                times += batch.column(1).to_pylist()
                if len(words) >= GROUP_WORDS:
                    total += lattice.expected_counts(words, np.array(times))
                    words, times = [], []
            if words:
                total += lattice.expected_counts(words, np.array(times))
            there = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["piece", "n"])

        sums = counts.select("word", "n").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        expected = np.zeros(vocab.size)
        for row in sums:
            expected[row.piece] += row.n
        expected[vocab.end] += documents
        given.destroy()
        log_p = updated(vocab, expected)
    return log_p


def updated(vocab: Vocabulary, expected: np.ndarray) -> np.ndarray:
    """Log probabilities from expected counts and the existing scores at the heat that fits these counts best."""
    sums = expected + PRIOR_PIECES * vocab.tempered(vocab.fitted_heat(expected))
    return np.log(sums / sums.sum())


def head_of(counts: DataFrame, most: int = HEAD_WORDS) -> dict[str, float]:
    """log10 of one more than the count of all words that occur at least so often that there are no more than most of them."""
    step = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for row in sizes:
        total += row.words
        if total > most:
            break
        least = row.least
    return {} if least is None else {r.word: math.log10(r.n + 1) for r in counts.where(F.col("n") >= least).select("word", "n").collect()}


class Scorer:
    """The learned model with the word counts of the training documents (a table) beside it."""

    def __init__(self, docs: DataFrame, training: Column, path: str, text_col: str = "text"):
        self.path = path
        texts = docs.where(training).select(docs[text_col].alias("text"))
        self.counts = written(count_words(texts), "lm-counts")
        self.documents = texts.count()
        row = self.counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        # the end is a token of its own
        self.tokens, self.distinct = row.n + self.documents, row.v + (self.documents > 0)
        self.log_p = learn(self.counts, self.documents, path)
        self.head = docs.sparkSession.sparkContext.broadcast(head_of(self.counts))

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: Column | None = None) -> DataFrame:
        """id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

        A null or blank text has the end as its only token. Frequent words are looked up where the
        text is; each document's other words leave as rows that are joined to the counts.
        """
        path, head, model = self.path, self.head, docs.sparkSession.sparkContext.broadcast(self.log_p.tobytes())
        unit, documents = math.log10(self.tokens + self.distinct + 1), self.documents
        kind = docs.schema[id_col].dataType.simpleString()
        fields = f"uid long, id {kind}, held_out boolean, word string, times long, n_tokens long, n_known long, base double, score double"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cache, known = worker_cache(f"scores {hash(model.value)}", lambda: WordCache(Lattice(vocabulary(path), np.frombuffer(model.value)).word_scores, CACHED_BYTES)), head.value
            end_score = float(np.frombuffer(model.value)[-1])
            for batch in batches:
                uids, ids, folds, texts = (c for c in batch.columns)
                # n_tokens, n_known, base and score of each document
                sums = [[1, int(documents > 0), math.log10(documents + 1), end_score] for _ in range(batch.num_rows)]
                rest: list[str] = []
                times_of: list[int] = []
                origin: list[int] = []
                for group in _groups(texts.to_pylist()):
                    cache.learn(set().union(*(own.keys() for _, own in group)))
                    for i, own in group:
                        n, n_known, base, score = sums[i]
                        for word, times in own.items():
                            n += times
                            score += times * cache[word]
                            found = known.get(word)
                            if found is not None:
                                n_known += times
                                base += times * found
                            else:
                                rest.append(word)
                                times_of.append(times)
                                origin.append(i)
                        sums[i] = [n, n_known, base, score]
                    if len(rest) > 50_000:
                        yield _batch(uids, ids, folds, origin, rest, times_of)
                        rest, times_of, origin = [], [], []
                if rest:
                    yield _batch(uids, ids, folds, origin, rest, times_of)
                # a word holds no space, so these rows meet no count
                every = list(range(batch.num_rows))
                yield _batch(uids, ids, folds, every, [f" {u}" for u in uids.to_pylist()], [0] * batch.num_rows, np.array(sums, np.float64).reshape(-1, 4))

        given = docs.select(F.monotonically_increasing_id().alias("uid"), docs[id_col].alias("id"),
                            (F.lit(False) if fold is None else fold).alias("held_out"), docs[text_col].alias("text"))
        parts = given.mapInArrow(run, fields)
        counts = self.counts.select(F.col("word").alias("counted"), "n")
        rows = parts.join(counts, F.col("word") == F.col("counted"), "left")
        known = F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)
        return rows.groupBy("uid").agg(
            F.max(F.when(F.col("times") == 0, F.col("id"))).alias("id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + known).alias("n_known"),
            F.lit(self.tokens).cast("long").alias("train_tokens"),
            # every token's count is over the same total
            (F.sum(F.col("base") + F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)) - F.sum("n_tokens") * F.lit(unit)).alias("base_score"),
            F.sum("score").alias("score"),
        ).drop("uid")


def _groups(texts: list[str | None]) -> Iterator[list[tuple[int, Counter[str]]]]:
    """Groups of (index of the text, counts of words of it or a part of it), of about GROUP_CHARS together."""
    group: list[tuple[int, Counter[str]]] = []
    size = 0
    for i, text in enumerate(texts):
        for words in word_chunks(text):
            group.append((i, Counter(words)))
            size += len(words)
            if size * 6 > GROUP_CHARS:
                yield group
                group, size = [], 0
    if group:
        yield group


def _batch(uids: pa.Array, ids: pa.Array, folds: pa.Array, origin: list[int], words: list[str], times: list[int], sums: np.ndarray | None = None) -> pa.RecordBatch:
    at = pa.array(origin, pa.int64())
    sums = np.zeros((len(origin), 4)) if sums is None else sums
    return pa.RecordBatch.from_arrays(
        [uids.take(at), ids.take(at), folds.take(at), pa.array(words, pa.string()), pa.array(times, pa.int64()), pa.array(sums[:, 0].astype(np.int64)),
         pa.array(sums[:, 1].astype(np.int64)), pa.array(sums[:, 2].copy()), pa.array(sums[:, 3] / _LN10)],
        ["uid", "id", "held_out", "word", "times", "n_tokens", "n_known", "base", "score"])


def score_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from the documents that are not held out (crc32 of the id as text modulo 7 is 2; a null id
    never is) and scores all. A null text counts as empty. Repeated rows repeat; an empty table gives no rows;
    long texts and words are scored whole; other columns play no part."""
    fold = held_out(docs[id_col], 7, 2)
    return Scorer(docs, ~fold, path, text_col).score(docs, id_col, text_col, fold)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)).withColumnRenamed("id", "doc_id")
