"""Mixing sources to target weights by entropy balancing.

Sought are document rates, at most MAX_COPIES, that hit every source's token target and keep the bands of
document length near their share of the corpus, and otherwise stay as near to 1 as possible, in relative
entropy over tokens. The convex dual has one variable for each source and one for each band; a rate is the
exponential of its source's and its band's. Newton steps run on the bands' duals, each with one aggregate
over the sources, whose own duals follow in closed form. The rates are then rounded into whole copies: a
document gets the whole part, and one more if its ticket is below a threshold at which the tickets of its
source and size make up the rest of the rates' words. What one size leaves over goes on to the next smaller, and
what the smallest leave, having the greatest number of copies, goes back to those with room.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import free_names, table, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
#: Lengths, in words, at which a band begins.
BANDS = (0, 128, 512, 2048)
#: A band may miss its share of all words by this times its dual: sources come first, and may leave no way to keep the bands.
RIDGE = 0.02
#: Greatest miss of the dual's slope, as a share of all words, at which Newton's steps end, and their greatest number.
TOLERANCE, STEPS = 1e-9, 100
#: Bits of a ticket, and those of them within a range; sizes of a source of so many documents at most are settled document by document.
_TICKET_BITS, _LOW = 24, 12
EXACT = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ticket(doc_id: Column, text: Column) -> Column:
    """A number below 2**24 that a document draws, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 64 - _TICKET_BITS)


def band_of(size: Column) -> Column:
    return sum(((size >= at).cast("int") for at in BANDS[1:]), F.lit(0))


def class_of(size: Column) -> Column:
    """Bits of the number of words: sizes of a class differ by less than a factor of two."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def ranked_sources(sources: DataFrame) -> DataFrame:
    """sources with their rank (from 0) by code point, null last. Only the number of sources of each range
    of the sort goes to the driver."""
    dealt = sources.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id())
    dealt = written(dealt, "mix-ranks")
    part = F.shiftright("place", 33).cast("int")
    counts = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, total = [], 0
    for row in counts:
        before.append((row.part, total))
        total += row.n
    starts = sources.sparkSession.createDataFrame(before, "part int, before long")
    return dealt.withColumn("part", part).join(starts, "part").withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)).drop("part", "place", "before")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """sources(source, size, ...) with target: each source's share of all words by its weight, held at most times
    its own words; what is above is shared again by weight among the others, until none is above."""
    given = F.array(*map(F.lit, weights))
    rows = ranked_sources(sources).withColumn("weight", F.element_at(given, (F.col("rank") % len(weights) + 1).cast("int"))).drop("rank")
    rows = written(rows, "mix-weights")
    total = rows.agg(F.sum("size").alias("n")).first().n or 0
    full = F.col("size") * float(most)
    level, before = 0.0, -1
    # a source is full where its share would be above; each turn only more are
    while True:
        held = full < F.col("weight") * F.lit(level)
        row = rows.agg(F.count_if(held).alias("n"), F.sum(F.when(held, full).otherwise(0.0)).alias("full"), F.sum(F.when(held, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if row.n == before or not row.weight:
            break
        level, before = max(level, (total - row.full) / row.weight), row.n
    return rows.withColumn("target", F.least(full, F.col("weight") * F.lit(level))).drop("weight")


def source_rates(words: np.ndarray, target: np.ndarray, duals: np.ndarray, most: float) -> np.ndarray:
    """The rate of each band of each source (words: source x band) at these duals of the bands. A source's own dual is
    the one at which the rates' words are its target: with k bands at the greatest rate (those of the greatest
    duals, one after another) it is what the others leave, if it holds none of these back."""
    tilt, order = np.exp(duals), np.argsort(-duals, kind="stable")
    own, settled = np.full(len(words), np.inf), np.zeros(len(words), bool)
    for k in range(len(duals)):
        rest = words[:, order[k:]] @ tilt[order[k:]]
        left = np.maximum(target - most * words[:, order[:k]].sum(1), 0.0)
        dual = np.divide(left, rest, out=np.full(len(words), np.inf), where=rest > 0)
        fits = ~settled & (dual * tilt[order[k]] <= most)
        own[fits] = dual[fits]
        settled |= fits
    return np.minimum(most, own[:, None] * tilt)


def slopes(words: np.ndarray, target: np.ndarray, duals: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """What these sources add to the slope of the dual in the bands, and to its curvature once their own duals follow."""
    rates = source_rates(words, target, duals, most)
    taken = rates * words
    free = np.where(rates < most, taken, 0.0)
    inner = np.maximum(free.sum(1), 1e-300)
    return taken.sum(0), np.diag(free.sum(0)) - (free / inner[:, None]).T @ free


def band_duals(sources: DataFrame, most: float = MAX_COPIES) -> np.ndarray:
    """The duals of the bands at the optimum. sources: w0 ..., target. Each Newton step is one aggregate, in which
    every source's tilted words enter, summed in its task; the driver gets a slope and a curvature for each two bands."""
    n = len(BANDS)
    names = [f"w{b}" for b in range(n)]
    sums = sources.agg(F.sum("target").alias("all"), *(F.sum(w).alias(w) for w in names)).first()
    duals = np.zeros(n)
    if not sums["all"]:
        return duals
    total, words = float(sums["all"]), np.array([float(sums[w]) for w in names])
    goal = words / words.sum() * total

    def at(duals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                slope, curve = slopes(batch[names].to_numpy(float), batch["target"].to_numpy(float), duals, most)
                yield pd.DataFrame({"cell": np.arange(n + n * n), "x": np.concatenate((slope, curve.ravel()))})

        rows = sources.select(*names, "target").mapInPandas(partial, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
        cells = np.zeros(n + n * n)
        for row in rows:
            cells[row.cell] = row.x
        return cells[:n] - goal + RIDGE * total * duals, cells[n:].reshape(n, n) + RIDGE * total * np.eye(n)

    slope, curve = at(duals)
    for _ in range(STEPS):
        if np.abs(slope).max() <= TOLERANCE * total:
            return duals
        step = -np.linalg.solve(curve, slope)
        step /= max(1.0, np.abs(step).max())
        while True:
            found = at(duals + step)
            # where rates reach the greatest the curvature jumps: go on only to a lesser slope
            if np.linalg.norm(found[0]) < np.linalg.norm(slope) or np.abs(step).max() < 1e-12:
                break
            step /= 2
        duals, (slope, curve) = duals + step, found
    raise ArithmeticError(f"the dual has not converged after {STEPS} steps: slope {np.abs(slope).max() / total:.2g} of all words")


def with_rates(sources: DataFrame, duals: np.ndarray, most: float = MAX_COPIES) -> DataFrame:
    """source_key, source_size, target, rates (of each band) of each source."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rates = source_rates(batch[[f"w{b}" for b in range(len(BANDS))]].to_numpy(float), batch["target"].to_numpy(float), duals, most)
            yield batch[["source_key", "source_size", "target"]].assign(rates=list(np.where(np.isfinite(rates), rates, 0.0)))

    given = sources.select("source_key", F.col("size").alias("source_size"), "target", *(f"w{b}" for b in range(len(BANDS))))
    return given.mapInPandas(run, "source_key string, source_size long, target double, rates array<double>")


def thresholds(cells: DataFrame, rows: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """source_key, class, floor, threshold. cells: source_key, class, rate, words, n (documents); rows: source_key, class,
    ticket, size. A document gets floor copies, one more if its ticket is below the threshold; floor is below most
    wherever a threshold is above 0. Classes of at most EXACT documents are settled document by document, larger ones by
    ranges of tickets first and by tickets within the range where they end then."""
    given = rows.join(cells.select("source_key", "class", "n"), ["source_key", "class"])
    entry = F.when(F.col("n") <= EXACT, F.col("ticket")).otherwise(F.shiftleft(F.shiftright("ticket", _LOW), _LOW))
    high = given.groupBy("source_key", "class", entry.alias("at")).agg(F.sum("size").alias("size"))
    high = high.join(cells, ["source_key", "class"]).select("source_key", "class", "at", "size", "rate", "words", "n")
    schema = "source_key string, class int, floor long, threshold long, owed double"
    first = written(high.groupBy("source_key").applyInPandas(lambda g: settled(g, most), schema), "mix-high")
    ends = first.where("owed >= 0").select("source_key", "class", "threshold", "owed")
    low = rows.join(ends, ["source_key", "class"]).where(F.shiftright("ticket", _LOW) == F.shiftright("threshold", _LOW))
    low = low.groupBy("source_key", "class", "threshold", "owed", "ticket").agg(F.sum("size").alias("size"))
    found = low.groupBy("source_key").applyInPandas(settled_within, "source_key string, class int, within long")
    return first.join(found, ["source_key", "class"], "left").select("source_key", "class", "floor", F.coalesce("within", "threshold").alias("threshold"))


class _Class:
    """The documents of a source and class of sizes: entries in order of tickets, each a document or a range of them."""

    def __init__(self, part: pd.DataFrame, most: int):
        part = part.sort_values("at")
        self.at, self.sums = part["at"].to_numpy(), part["size"].to_numpy(float).cumsum()
        self.words, self.most, self.exact = float(part["words"].iloc[0]), most, part["n"].iloc[0] <= EXACT
        self.floor, self.fit, self.got, self.rest = 0, 0, 0.0, 0.0
        self.rate = float(part["rate"].iloc[0])
        self.taken = 0.0

    def settle(self, wanted: float) -> float:
        """Takes what comes nearest to wanted words, and returns what is left of them (below 0: what is over)."""
        if not self.words:  # texts without words
            self.floor = min(self.most, round(self.rate))
            return wanted
        self.floor = int(min(self.most, max(0.0, wanted) // self.words))
        rest = max(0.0, wanted) - self.floor * self.words
        self.fit, self.got, self.rest = 0, 0.0, 0.0
        if self.floor < self.most:
            self.fit = int(np.searchsorted(self.sums, rest, side="right"))
            self.got = float(self.sums[self.fit - 1]) if self.fit else 0.0
            if self.fit < len(self.sums):
                if not self.exact:
                    self.rest = rest - self.got  # found within the range
                elif 2 * rest > self.got + float(self.sums[self.fit]):
                    self.got, self.fit = float(self.sums[self.fit]), self.fit + 1
        self.taken = self.floor * self.words + self.got + self.rest
        return wanted - self.taken

    def end(self) -> int:
        if not self.words or self.floor == self.most:
            return 0
        return int(self.at[self.fit]) if self.fit < len(self.at) else 1 << _TICKET_BITS


def settled(group: pd.DataFrame, most: int) -> pd.DataFrame:
    """floor and threshold of each class of a source, and what is owed within the range that begins at the threshold (-1: that is
    no range). From the largest class on each takes its rate's words; what is left or over goes to the next, and
    what is left of all goes to those with room, from the smallest on."""
    classes = {k: _Class(part, most) for k, part in group.groupby("class")}
    left = 0.0
    for k in sorted(classes, reverse=True):
        left = classes[k].settle(classes[k].rate * classes[k].words + left)
    for k in sorted(classes):
        left = classes[k].settle(classes[k].taken + left)
    key = group["source_key"].iloc[0]
    out = [(key, k, c.floor, c.end(), -1.0 if c.exact or not c.words or c.floor == most or c.fit == len(c.at) else c.rest) for k, c in classes.items()]
    return pd.DataFrame(out, columns=["source_key", "class", "floor", "threshold", "owed"])


def settled_within(group: pd.DataFrame) -> pd.DataFrame:
    """The threshold of each class within the range where it ends; what is left or over goes to the next smaller class."""
    out, left = [], 0.0
    for k, part in sorted(group.groupby("class"), reverse=True):
        part = part.sort_values("ticket")
        sums = part["size"].to_numpy(float).cumsum()
        owed = float(part["owed"].iloc[0]) + left
        fit = int(np.searchsorted(sums, owed, side="right"))
        if fit < len(sums) and 2 * owed > (sums[fit - 1] if fit else 0.0) + sums[fit]:
            fit += 1
        left = owed - (float(sums[fit - 1]) if fit else 0.0)
        # past the range's last ticket none is below the next range's first
        end = int(part["ticket"].iloc[fit]) if fit < len(sums) else (int(part["threshold"].iloc[0] >> _LOW) + 1) << _LOW
        out.append((part["source_key"].iloc[0], k, end))
    return pd.DataFrame(out, columns=["source_key", "class", "within"])


class Mix:
    """What decides about each document: a row for each source and class of sizes."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: tuple[float, ...] = WEIGHTS, most: int = MAX_COPIES):
        self.columns = (id_col, text_col, source_col)
        size = word_count(docs[text_col])
        rows = docs.select(docs[source_col].alias("source"), _key(docs[source_col]).alias("source_key"), size.alias("size"), ticket(docs[id_col], docs[text_col]).alias("ticket"))
        rows = written(rows, "mix-rows").withColumn("class", class_of(F.col("size")))
        n = len(BANDS)
        cells = written(rows.groupBy("source", "source_key", "class", band_of(F.col("size")).alias("band")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "mix-cells")
        sources = cells.groupBy("source", "source_key").agg(
            F.sum("words").alias("size"), *(F.sum(F.when(F.col("band") == b, F.col("words")).otherwise(0)).alias(f"w{b}") for b in range(n)))
        sources = written(source_targets(sources, weights, most), "mix-sources")
        sources = with_rates(sources, band_duals(sources, most), most)
        rated = cells.join(sources, "source_key").select("source_key", "class", "words", "n", "source_size", "target", F.coalesce(F.get("rates", F.col("band")), F.lit(0.0)).alias("rate"))
        # bands begin at powers of two, so a class lies in one band
        rated = written(rated, "mix-rates")
        found = thresholds(rated.select("source_key", "class", "words", "n", "rate"), rows, most)
        self.params = written(rated.join(found, ["source_key", "class"]).drop("words", "n"), "mix-params")

    def decide(self, docs: DataFrame, names: dict[str, str]) -> DataFrame:
        """docs with size, source_size, target, rate and copies under the given names."""
        id_col, text_col, source_col = self.columns
        size = word_count(docs[text_col])
        params = self.params.select(*(F.col(c).alias(names.get(c, names["copies"] + c)) for c in self.params.columns))
        own = lambda c: params[names["copies"] + c]
        rows = docs.withColumn(names["size"], size)
        rows = rows.join(params, (_key(rows[source_col]) == own("source_key")) & (class_of(rows[names["size"]]) == own("class")))
        copies = own("floor") + (ticket(rows[id_col], rows[text_col]) < own("threshold")).cast("long")
        return rows.withColumn(names["copies"], copies)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """id, size, source_size, target, taken, copies, rate for each row of docs.

    Null text has size 0; null source is a source of its own, the last. Rows that repeat id and
    text get equal copies. An empty table gives no rows. No row is taken more than three times. A
    very long text is a class of its own size, and what cannot be taken of it whole is taken of smaller
    ones. Other columns, whatever their names, play no part.
    """
    names = free_names(docs, "size", "source_size", "target", "rate", "copies")
    given = docs.select(docs[id_col], docs[text_col], docs[source_col])
    found = Mix(given, id_col, text_col, source_col, **how).decide(given, names)
    return found.select(
        F.col(id_col).alias("id"), F.col(names["size"]).alias("size"), F.col(names["source_size"]).alias("source_size"), F.col(names["target"]).alias("target"),
        (F.col(names["copies"]) * F.col(names["size"])).alias("taken"), F.col(names["copies"]).alias("copies"), F.col(names["rate"]).alias("rate"))


def mixing_stage(docs: DataFrame) -> DataFrame:
    """Each row of docs as many times as the mix takes it, with its columns, whatever else they are named; nulls, long
    texts, repeated rows and an empty table as in mix()."""
    names = free_names(docs, "size", "source_size", "target", "rate", "copies", "copy")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = Mix(docs).decide(docs, names).where(F.col(names["copies"]) > 0)
    return found.withColumn(names["copy"], F.explode(F.sequence(F.lit(1).cast("long"), F.col(names["copies"])))).select(*columns)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
