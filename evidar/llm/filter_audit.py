"""How filters interact: what each of them keeps and removes at each step of every order.

A document's failures are a mask of one bit a filter. For each part of the table three histograms over the
masks, of all documents, good ones and toxic ones, are stacked as rows, and products with integer
matrices (masks x orders and steps) give what is kept, removed, redundant and unique. A filter that
drops repeated texts is a bit of the mask like any other, found before any filter is applied.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import as_rows, table, written

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SLICE = 1 << 20

Filter = Callable[[Column], Column]
#: By letter: whether a text with these statistics fails. REPEAT is the filter of texts that a smaller id has too.
REPEAT = "E"
FILTERS: dict[str, Filter] = {
    "A": lambda s: s["words"] < 50,
    "B": lambda s: 100 * s["distinct"] < 65 * s["words"],
    "C": lambda s: 100 * s["capitals"] > 5 * s["chars"],
    "D": lambda s: s["marked"],
}
MARKS = b"#$%&*|"


def slices(text: bytes, size: int = _SLICE) -> Iterator[bytes]:
    """The text in parts of about size bytes, cut at white space."""
    at = 0
    while len(text) - at > size:
        cut = _SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def statistics(text: Column) -> Column:
    """Words, distinct words, letters A-Z, code points of a text (binary, not null), and whether it has one of MARKS."""
    return F.arrow_udf(_statistics, "struct<words: bigint, distinct: bigint, capitals: bigint, chars: bigint, marked: boolean>")(text)


def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = []
        for value in texts:
            text = value.as_buffer().to_pybytes()
            words, seen = 0, set()
            for part in slices(text):
                found = part.split()  # of bytes: at the contracts' white space and nowhere else
                words += len(found)
                seen.update(found)
            ascii_ = text.isascii()
            chars = len(text) if ascii_ else int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())
            rows.append((words, len(seen), len(text) - len(text.translate(None, _CAPITALS)), chars, len(text.translate(None, MARKS)) < len(text)))
        names = ["words", "distinct", "capitals", "chars"]
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.StructArray.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.bool_())], [*names, "marked"])


def failure_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str, filters: dict[str, Filter]) -> DataFrame:
    """part, id, digest (of the text), mask (without REPEAT), good and toxic of each row of docs."""
    given = docs.select(docs[part_col].alias("part"), docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = given.select(
        F.coalesce("part", F.lit("")).alias("part"), "id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        statistics(F.col("text").cast("binary")).alias("stats"))
    mask = sum((F.when(fails(F.col("stats")), 1 << bit).otherwise(0) for bit, fails in enumerate(filters.values())), F.lit(0))
    known = as_rows(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.select("part", "id", "digest", mask.alias("mask"))
    return rows.join(known, F.col("id") == F.col("labelled"), "left").select(
        "part", "id", "digest", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def histograms(rows: DataFrame, n_filters: int) -> DataFrame:
    """A row for each part: part, and docs, good and toxic, each an array with a count for each mask. The repeat
    bit, the last one, is set for all rows, and taken back for those that hold the least id of their text. So a text
    in many rows is only ever summed up or joined by text and id, and no task gets all rows of one."""
    first = rows.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("first"))
    first = first.select(F.col("digest").alias("of"), F.col("first.id").alias("first"))
    leads = rows.join(first, (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")), "left_semi")
    repeat = 1 << (n_filters - 1)
    sums = [F.count(F.lit(1)).alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")]
    every = rows.groupBy("part", "mask").agg(*sums).withColumn("sign", F.lit(1)).withColumn("mask", F.col("mask") + repeat)
    alone = leads.groupBy("part", "mask").agg(*sums)
    counts = every.unionByName(alone.withColumn("sign", F.lit(1))).unionByName(alone.withColumn("mask", F.col("mask") + repeat).withColumn("sign", F.lit(-1)))
    cell = lambda k, c: F.sum(F.when(F.col("mask") == k, F.col("sign") * F.col(c)).otherwise(0))
    cells = {c: [f"{c}_{k}" for k in range(2 * repeat)] for c in ("docs", "good", "toxic")}
    wide = counts.groupBy("part").agg(*(cell(k, c).alias(name) for c, names in cells.items() for k, name in enumerate(names)))
    return wide.select("part", *(F.array(*names).alias(c) for c, names in cells.items()))


def incidence(letters: str) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The orders and steps, and for each outcome a matrix: mask x order and step, 1 where a document of that mask has
    that outcome there. shapley: in how many orders the step's filter removes it."""
    steps = [("".join(order), k + 1) for order in permutations(letters) for k in range(len(letters))]
    bit = {c: 1 << i for i, c in enumerate(letters)}
    here = np.array([bit[order[k - 1]] for order, k in steps])
    earlier = np.array([sum(bit[c] for c in order[: k - 1]) for order, k in steps])
    mask = np.arange(1 << len(letters))[:, None]
    fails, gone = (mask & here) > 0, (mask & earlier) > 0
    share = factorial(len(letters)) // np.maximum(np.bitwise_count(mask.astype(np.uint64)).astype(np.int64), 1)
    out = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": mask == here, "shapley": fails * share}
    return steps, {k: v.astype(np.int64) for k, v in out.items()}


#: Outcome, matrix and histogram of each count.
OUTCOMES = {
    "kept": ("kept", "docs"), "removed": ("removed", "docs"), "redundant": ("redundant", "docs"), "unique_fails": ("unique_fails", "docs"),
    "good_lost": ("removed", "good"), "toxic_lost": ("removed", "toxic"), "shapley": ("shapley", "docs"),
}
#: Parts whose rows are made at once.
_PARTS = 64


def outcomes(stacked: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step and the counts of OUTCOMES, for each part, order and step."""

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, matrices = incidence(letters)
        orders, places = zip(*steps)
        for batch in batches:
            for at in range(0, len(batch), _PARTS):
                some = batch.iloc[at : at + _PARTS]
                rows = {c: np.stack(some[c].to_numpy()).astype(np.int64) for c in ("docs", "good", "toxic")}
                out = pd.DataFrame({"part": np.repeat(some["part"].to_numpy(), len(steps)), "filter_order": np.tile(orders, len(some)), "step": np.tile(places, len(some)).astype(np.int32)})
                for name, (matrix, histogram) in OUTCOMES.items():
                    out[name] = (rows[histogram] @ matrices[matrix]).ravel()
                yield out

    return stacked.mapInPandas(product, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in OUTCOMES))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                 filters: dict[str, Filter] = FILTERS, repeat: str = REPEAT) -> DataFrame:
    """For each part, order of the filters (and of repeat, that of repeated texts) and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley.

    Null text counts as empty, a null part as the part of the empty name. A null id has no label and comes after all
    others: its text is a repeat if a row with an id has it. Of rows that repeat id and text none is smaller, so all
    hold their text. A label given twice holds if one of them does. A very long text is read in slices; only its
    distinct words are held. An empty table gives no rows. Other columns play no part.
    """
    letters = "".join(filters) + repeat
    rows = written(failure_rows(docs, labels, id_col, text_col, part_col, filters), "audit-rows")
    return outcomes(histograms(rows, len(letters)), letters)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT part, doc_id, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) > 5 * length(x) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS mask FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
h AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM u LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(c, bit)),
o AS (SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM f a, f b, f d, f e, f g WHERE a.bit + b.bit + d.bit + e.bit + g.bit = 31
        AND a.bit | b.bit | d.bit | e.bit | g.bit = 31),
s AS (SELECT filter_order, k AS step, (SELECT bit FROM f WHERE c = filter_order[k]) AS bit,
             (SELECT coalesce(sum(bit), 0) FROM f WHERE contains(filter_order[1:k - 1], c) AND k > 1)::INT AS gone FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
SELECT part, filter_order, step,
       sum(CASE WHEN mask & (bit | gone) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & bit > 0 AND mask & gone > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN mask & bit > 0 THEN n * (120 // bit_count(mask::INT)) ELSE 0 END)::BIGINT AS shapley
FROM h, s GROUP BY part, filter_order, step
"""
