"""Dictionary matching in text, three-valued states and sets over them."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidar.functions.text import fold_alnum_py, lower_alnum_py

# Words that negate what follows.
NEGATION_PREFIXES = ("沒有", "没有", "未有", "無", "无", "不含", "不包括", "缺少", "缺", "未擁有", "未拥有")
LONGEST_FIRST, LEFTMOST_LONGEST = "longest_first", "leftmost_longest"
MATCHES = "array<struct<start:int,stop:int,alias:string,negative:boolean>>"


@dataclass(frozen=True)
class Negation:
    """An occurrence is negated if the window before it ends with one of the words."""

    words: tuple[str, ...] = NEGATION_PREFIXES
    window: int = 6

    def __call__(self, text: str, start: int) -> bool:
        return text[max(0, start - self.window) : start].endswith(self.words)


class Matcher:
    """Occurrences of dictionary keys in normalised text without overlaps, by either policy."""

    def __init__(self, keys: Iterable[str], policy: str = LONGEST_FIRST, negation: Callable[[str, int], bool] | None = None):
        if policy not in (LONGEST_FIRST, LEFTMOST_LONGEST):
            raise ValueError(policy)
        self.policy, self.negation = policy, negation or Negation()
        self.automaton = ahocorasick.Automaton()
        for key in keys:
            if key:
                self.automaton.add_word(key, key)
        self.automaton.make_automaton() if len(self.automaton) else None

    def find(self, text: str) -> list[tuple[int, int, str, bool]]:
        if not len(self.automaton):
            return []
        found = [(stop + 1 - len(key), stop + 1, key) for stop, key in self.automaton.iter(text)]
        chosen: list[tuple[int, int, str]] = []
        if self.policy == LONGEST_FIRST:
            taken: list[bool] = [False] * len(text)
            for start, stop, key in sorted(found, key=lambda f: (f[0] - f[1], f[0], f[2])):
                # no chosen one is shorter, so an overlap touches an end
                if not (taken[start] or taken[stop - 1]):
                    taken[start:stop] = [True] * (stop - start)
                    chosen.append((start, stop, key))
        else:
            cursor = 0
            for start, stop, key in sorted(found, key=lambda f: (f[0], -f[1], f[2])):
                if start >= cursor:
                    chosen.append((start, stop, key))
                    cursor = stop
        return [(a, b, k, self.negation(text, a)) for a, b, k in sorted(chosen)]


NORMALISERS: dict[str, Callable[[str], str]] = {"lower_alnum": lower_alnum_py, "fold_alnum": fold_alnum_py, "none": lambda t: t, "lower": str.lower}


def match(rows: DataFrame, text: str, keys: list[str], policy: str = LONGEST_FIRST, normaliser: str = "lower_alnum", negation: Callable[[str, int], bool] | None = None,
          name: str = "matches") -> DataFrame:
    """rows with the matches in a text column. The dictionary (a catalog, small by nature) goes to each
    task once and becomes one automaton there."""
    normal = NORMALISERS[normaliser]
    given = rows.sparkSession.sparkContext.broadcast(sorted({normal(k) for k in keys} - {""}))

    @F.pandas_udf(MATCHES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(given.value, policy, negation)
        for batch in batches:
            yield batch.map(lambda t: [dict(zip(("start", "stop", "alias", "negative"), m)) for m in matcher.find(normal(t))] if t else [])

    return rows.withColumn(name, run(F.col(text)))


def count_matches(rows: DataFrame, text: str, keys: list[str], policy: str = LONGEST_FIRST, normaliser: str = "lower_alnum", name: str = "counts") -> DataFrame:
    """rows with how often each key stands in a text column: as match(), but only the counts leave the task."""
    normal = NORMALISERS[normaliser]
    given = rows.sparkSession.sparkContext.broadcast(sorted({normal(k) for k in keys} - {""}))

    @F.pandas_udf("map<string,long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(given.value, policy, lambda text, start: False)
        for batch in batches:
            yield batch.map(lambda t: dict(Counter(m[2] for m in matcher.find(normal(t)))) if t else {})

    return rows.withColumn(name, run(F.col(text)))


def unambiguous(aliases: DataFrame, alias: str, owner: str) -> DataFrame:
    """alias and owner of the aliases that only one owner has."""
    return aliases.groupBy(alias).agg(F.countDistinct(owner).alias("n"), F.min(owner).alias(owner)).where("n = 1").drop("n")


def three_state(positive: Column, negative: Column) -> Column:
    """owned, confirmed_missing or unknown; a conflict is unknown, and so is silence."""
    p, n = F.coalesce(positive, F.lit(False)), F.coalesce(negative, F.lit(False))
    return F.when(p & n, "unknown").when(p, "owned").when(n, "confirmed_missing").otherwise("unknown")


def item_states(vectors: DataFrame) -> DataFrame:
    """State of rows(account_id, item_id, profile_owned, profile_missing, text_positive, text_negative,
    approved, eligible): of an eligible item only an approved exact token in the text claims, and a
    contrary claim from any source makes a conflict; of others every claim counts, for review only."""
    c = lambda n: F.coalesce(F.col(n), F.lit(False))
    raw_positive, raw_negative = c("profile_owned") | c("text_positive"), c("profile_missing") | c("text_negative")
    positive = F.when(c("eligible"), c("text_positive") & c("approved")).otherwise(raw_positive)
    negative = F.when(c("eligible"), c("text_negative") & c("approved")).otherwise(raw_negative)
    conflict = F.when(c("eligible"), (positive & raw_negative) | (negative & raw_positive)).otherwise(positive & negative)
    state = F.when(conflict, "unknown").when(positive, "owned").when(negative, "confirmed_missing").otherwise("unknown")
    evidence = (
        F.when(conflict, "conflict").when(positive, F.when(c("profile_owned"), "profile_claim").otherwise("text_claim"))
        .when(negative, F.when(c("profile_missing"), "profile_claim").otherwise("text_claim")).otherwise("unknown"))
    return vectors.withColumns({"state": state, "evidence_state": evidence, "conflict": conflict}).withColumn(
        "model_feature", c("eligible") & F.col("state").isin("owned", "confirmed_missing") & ~F.col("conflict"))


def dense_states(accounts: DataFrame, account_id: str, items: DataFrame, item_id: str, evidence: DataFrame) -> DataFrame:
    """Every account with every catalog item: the evidence where there is any, else silence. The catalog
    is small by nature and broadcast; the evidence is joined by both keys."""
    grid = accounts.select(account_id).crossJoin(F.broadcast(items))
    return grid.join(evidence, [account_id, item_id], "left")


def set_completion(states: DataFrame, account_id: str, members: DataFrame) -> DataFrame:
    """account, set_id, owned, missing, known, required, ratio, complete over members(set_id, item_id) and
    states(account, item_id, state). Ratio and complete are null unless all required members are known."""
    size = members.groupBy("set_id").agg(F.countDistinct("item_id").alias("required"))
    per = states.join(F.broadcast(members), "item_id").groupBy(account_id, "set_id").agg(
        F.count_if(F.col("state") == "owned").alias("owned"), F.count_if(F.col("state") == "confirmed_missing").alias("missing"))
    known = F.col("owned") + F.col("missing")
    all_known = known == F.col("required")
    return per.join(F.broadcast(size), "set_id").select(
        account_id, "set_id", "owned", "missing", known.alias("known"), "required",
        F.when(all_known, F.col("owned") / F.col("required")).alias("ratio"), F.when(all_known, F.col("owned") == F.col("required")).alias("complete"))


def text_states(texts: list[tuple[str, str]], catalog: dict[str, dict], aliases: dict[str, str], seller: bool = True) -> dict[str, dict]:
    """States of all catalog items for one account from (source, text) pairs: the same rules as
    item_states(), for a single account (FIXTURES §2.4). catalog: item -> eligible, tokens."""
    found: dict[str, dict] = defaultdict(lambda: {"aliases": set(), "positive": False, "negative": False, "sources": set()})
    matcher = Matcher(aliases)
    for source, text in texts if seller else []:
        for _, _, alias, negative in matcher.find(lower_alnum_py(text)):
            hit = found[aliases[alias]]
            hit["aliases"].add(alias)
            hit["sources"].add(source)
            hit["negative" if negative else "positive"] = True
    out = {}
    for item, about in catalog.items():
        hit = found.get(item, {"aliases": set(), "positive": False, "negative": False, "sources": set()})
        usable = not about["eligible"] or bool(hit["aliases"] & {lower_alnum_py(t) for t in about["tokens"]})
        positive, negative = hit["positive"] and usable, hit["negative"] and usable
        conflict = (positive and hit["negative"]) or (negative and hit["positive"])
        state = "unknown" if conflict or not (positive or negative) else "owned" if positive else "confirmed_missing"
        out[item] = {"state": state, "conflict": conflict, "aliases": sorted(hit["aliases"]), "sources": sorted(hit["sources"]),
                     "model_feature": about["eligible"] and state != "unknown"}
    return out
