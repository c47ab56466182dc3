"""Dictionaries of several catalogs in texts, as rows: alias tables, occurrences, choice among overlaps, evidence, sidecar.

Occurrences are rows (id, source, start, stop, alias, before). A dictionary of bounded size goes to each task as one
automaton; of a larger one a filter does, and the places that it lets through are joined with the keys. Overlaps are
settled within islands of occurrences that touch each other, so a long text is many small groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.functions.text import lower_alnum
from evidar.operators.matching import LEFTMOST_LONGEST, LONGEST_FIRST, NEGATION_PREFIXES

# Shortest names and nicknames, and words that negate in the sidecar.
SHORTEST_NAME, SHORTEST_ALIAS = 2, 3
SIDECAR_NEGATIONS = ("沒有", "無", "未有", "缺少", "缺", "不含", "不帶", "未包含")
SIDECAR_WINDOW, VECTOR_WINDOW = 4, 6

#: Characters of all keys up to which a dictionary goes to every task.
BROADCAST_CHARS = 4 << 20
#: Of larger dictionaries: characters of the shortest key, characters of texts looked at together, bits of the filter at most (as a power of
#: two), and the base of the hashes.
DEALT_BY, STRIDE, FILTER_BITS, ODD = 2, 1 << 19, 27, 0x5851F42D4C957F2D
_HIT = "struct<start:int,stop:int,alias:string,before:string>"


def alias_table(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """alias (normalised) and item_id, where one item alone has the spelling. Names count from two characters on, an item's own
    nicknames from three, rows of the alias master from two if verified and else from three. items: item_id, names
    (array), aliases (array); aliases: target_type, target_id, alias_text, verified."""
    names = items.select("item_id", F.explode("names").alias("said"), F.lit(SHORTEST_NAME).alias("shortest"))
    nicknames = items.select("item_id", F.explode("aliases").alias("said"), F.lit(SHORTEST_ALIAS).alias("shortest"))
    shortest = F.when(F.coalesce("verified", F.lit(False)), SHORTEST_NAME).otherwise(SHORTEST_ALIAS)
    master = aliases.where("target_type = 'item'").join(items.select(F.col("item_id").alias("target_id")), "target_id", "left_semi").select(
        F.col("target_id").alias("item_id"), F.col("alias_text").alias("said"), shortest.alias("shortest"))
    every = names.unionByName(nicknames).unionByName(master).select("item_id", lower_alnum(F.col("said")).alias("alias"), "shortest")
    spelled = every.where(F.length("alias") >= F.col("shortest"))
    return spelled.groupBy("alias").agg(F.min("item_id").alias("item_id"), F.max("item_id").alias("other")).where("item_id = other").drop("other")


def approved_tokens(items: DataFrame) -> DataFrame:
    """item_id and token: the English name of an item that is verified and eligible. No nickname is approved with it."""
    good = (F.col("verification_status") == "verified") & (F.col("model_feature_status") == "eligible")
    return items.where(good).select("item_id", lower_alnum(F.col("canonical_name_en")).alias("token")).where("token <> ''")


def distinct_keys(index: DataFrame, eligible: Column, ambiguous: DataFrame | None = None) -> DataFrame:
    """key and owner of index(key, owner, ...), where one owner alone has the key and it is not said to be ambiguous(key)."""
    own = index.where(eligible).groupBy("key").agg(F.min("owner").alias("owner"), F.max("owner").alias("other")).where("owner = other").drop("other")
    return own if ambiguous is None else own.join(ambiguous.select("key").distinct(), "key", "left_anti")


def _automaton_hits(texts: DataFrame, keys: list[str], window: int) -> DataFrame:
    given = texts.sparkSession.sparkContext.broadcast(keys)

    @F.pandas_udf(f"array<{_HIT}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for key in given.value:
            automaton.add_word(key, len(key))
        automaton.make_automaton()
        for batch in batches:
            yield batch.map(lambda t: [(e + 1 - n, e + 1, t[e + 1 - n : e + 1], t[max(0, e + 1 - n - window) : e + 1 - n]) for e, n in automaton.iter(t)] if t and len(automaton) else [])

    return texts.select("id", "source", F.explode(run(F.col("text"))).alias("hit")).select("id", "source", "hit.*")


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Sums of the code points times powers of ODD before each place: two of them make the hash of what stands between."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes.astype(np.uint64) * _powers(ODD, len(codes)), out=sums[1:])
    return sums


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(max(n - 1, 0), base, np.uint64)), dtype=np.uint64)[:n]


def _bits(sums: np.ndarray, length: int, bits: int) -> np.ndarray:
    """For each place where so many characters stand, their bit of a filter of 2**bits."""
    n = len(sums) - length
    own = (sums[length:] - sums[:n]) * _powers(pow(ODD, -1, 1 << 64), len(sums))[:n]
    own = (own ^ (own >> np.uint64(31)) ^ np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
    return own >> np.uint64(64 - bits)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for each key, summed up in each task: what goes to the driver is the filter at most."""

    @F.pandas_udf("long")
    def bit(alias: pd.Series) -> pd.Series:
        return alias.map(lambda a: int(_bits(_hashes(_codes(a)), len(a), bits)[0]))

    held = keys.select(bit(F.col("alias")).alias("bit")).groupBy(F.shiftright("bit", 3).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(bit & 7 AS int))")).alias("own"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for part in held.toLocalIterator():
        out[part.byte] = part.own
    return out


def _dealt_hits(texts: DataFrame, keys: DataFrame, n: int, lengths: list[int], window: int) -> DataFrame:
    """A filter with a bit for each key goes to every task, of bounded size: a full one lets more through and loses nothing. Places
    of a text whose characters may be a key are joined with the keys; no other place leaves its task."""
    bits = min(max(10, (16 * n).bit_length()), FILTER_BITS)
    given = texts.sparkSession.sparkContext.broadcast(_filter(keys, bits))

    @F.pandas_udf(f"array<{_HIT}>")
    def run(batch: pd.Series) -> pd.Series:
        held, out, at = given.value, [], 0
        while at < len(batch):
            some, size = [], 0
            while at < len(batch) and (not some or size + len(batch.iloc[at]) <= STRIDE):
                some.append(batch.iloc[at])
                size, at = size + len(some[-1]), at + 1
            ends = np.cumsum([len(t) for t in some])
            sums, found = _hashes(_codes("".join(some))), [[] for _ in some]
            for length in lengths:
                if length < len(sums):
                    bit = _bits(sums, length, bits)
                    places = np.flatnonzero(held[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                    of = np.searchsorted(ends, places, "right")
                    inside = places + length <= ends[of]
                    for k, place in zip(of[inside].tolist(), places[inside].tolist()):
                        t, start = some[k], place - int(ends[k]) + len(some[k])
                        found[k].append((start, start + length, t[start : start + length], t[max(0, start - window) : start]))
            out += found
        return pd.Series(out, dtype=object)

    maybe = texts.select("id", "source", F.explode(run(F.col("text"))).alias("hit")).select("id", "source", "hit.*")
    return maybe.join(keys, "alias", "left_semi").select("id", "source", "start", "stop", "alias", "before")


def occurrences(texts: DataFrame, aliases: DataFrame, window: int = VECTOR_WINDOW, most: int = BROADCAST_CHARS) -> DataFrame:
    """id, source, start, stop, alias, before (so many characters) of each place where an alias stands in
    texts(id, source, text), overlaps and all. aliases: alias, of DEALT_BY characters at least, in the texts' normal form."""
    keys = aliases.select("alias").where("alias <> ''").distinct()
    lengths = {r.length: r.n for r in keys.groupBy(F.length("alias").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = texts.select("id", "source", "text").where("text <> ''")
    if sum(k * n for k, n in lengths.items()) <= most:
        return _automaton_hits(texts, sorted(r.alias for r in keys.collect()), window)
    if min(lengths) < DEALT_BY:
        raise ValueError(f"keys of a dictionary that is dealt have {DEALT_BY} characters at least")
    return _dealt_hits(texts, keys, sum(lengths.values()), sorted(lengths), window)


def settled(hits: DataFrame, policy: str = LONGEST_FIRST) -> DataFrame:
    """The hits that stay where they overlap within a text: the longest first (then leftmost, then by alias), or from the left the
    longest that begins first. Only hits that touch each other by a chain of overlaps are compared."""
    order = Window.partitionBy("id", "source").orderBy("start", "stop", "alias")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = hits.withColumn("begins", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    rows = rows.withColumn("island", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    length = F.col("stop") - F.col("start")
    rank = F.struct((-length).alias("a"), F.col("start").alias("b")) if policy == LONGEST_FIRST else F.struct(F.col("start").alias("a"), (-length).alias("b"))
    islands = rows.groupBy("id", "source", "island").agg(F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "alias", "start", "stop", "before"))).alias("hits"))
    kind = islands.schema["hits"].dataType

    def take(chosen: Column, hit: Column) -> Column:
        if policy == LONGEST_FIRST:
            clash = F.exists(chosen, lambda c: (hit["start"] < c["stop"]) & (c["start"] < hit["stop"]))
        else:
            clash = F.coalesce(hit["start"] < F.get(chosen, F.size(chosen) - 1)["stop"], F.lit(False))
        return F.when(clash, chosen).otherwise(F.concat(chosen, F.array(hit))).cast(kind)

    kept = F.aggregate("hits", F.array().cast(kind), take)
    alone = F.when(F.size("hits") == 1, F.col("hits")).otherwise(kept)
    return islands.select("id", "source", F.explode(alone).alias("hit")).select("id", "source", "hit.start", "hit.stop", "hit.alias", "hit.before")


def negated(before: Column, words: tuple[str, ...] = NEGATION_PREFIXES) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | F.endswith(before, F.lit(word))
    return out


def text_evidence(hits: DataFrame, owners: DataFrame, words: tuple[str, ...] = NEGATION_PREFIXES) -> DataFrame:
    """id, owner, aliases and sources (sorted), positive and negative of settled hits; owners: alias, owner, of one catalog or several."""
    said = hits.withColumn("negative", negated(F.col("before"), words)).join(owners.select("alias", "owner"), "alias")
    return said.groupBy("id", "owner").agg(
        F.array_sort(F.collect_set("alias")).alias("aliases"), F.array_sort(F.collect_set("source")).alias("sources"),
        F.bool_or(~F.col("negative")).alias("positive"), F.bool_or("negative").alias("negative"))


def vector_inputs(evidence: DataFrame, profile: DataFrame, items: DataFrame, approved: DataFrame) -> DataFrame:
    """What matching.item_states() asks for, of each account and item that the text or the profile names: account_id, item_id,
    profile_owned, profile_missing, text_positive, text_negative, approved, eligible, aliases, sources. profile: account_id,
    item_id, owned, missing; items: item_id, verification_status, model_feature_status."""
    tokens = approved.groupBy("item_id").agg(F.collect_set("token").alias("tokens"))
    text = evidence.select(F.col("id").alias("account_id"), F.col("owner").alias("item_id"), "aliases", "sources", F.col("positive").alias("text_positive"), F.col("negative").alias("text_negative"))
    rows = text.join(profile, ["account_id", "item_id"], "full").join(items.select("item_id", "verification_status", "model_feature_status"), "item_id").join(tokens, "item_id", "left")
    none = F.array().cast("array<string>")
    aliases = F.coalesce("aliases", none)
    feature = F.coalesce("model_feature_status", F.when(F.col("verification_status") == "verified", "eligible").otherwise("excluded_pending_verification"))
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    return rows.select(
        "account_id", "item_id", no("owned").alias("profile_owned"), no("missing").alias("profile_missing"), no("text_positive").alias("text_positive"),
        no("text_negative").alias("text_negative"), F.arrays_overlap(aliases, F.coalesce("tokens", none)).alias("approved"),
        ((F.col("verification_status") == "verified") & (feature == "eligible")).alias("eligible"), aliases.alias("aliases"), F.coalesce("sources", none).alias("sources"),
        feature.alias("feature_status"))


def parser_summary(states: DataFrame, accounts: DataFrame, catalog_items: int) -> DataFrame:
    """For each account of accounts(account_id): how many items of the catalog are approved features, await review, are named by
    the text, by each source, by the profile, or in conflict. states: item_states() of vector_inputs()."""
    n = lambda c: F.count_if(c)
    sums = states.groupBy("account_id").agg(
        n(F.col("model_feature")).alias("approved_items"), n(~F.col("model_feature") & (F.col("feature_status") == "excluded_pending_verification")).alias("named_for_review"),
        n(F.size("aliases") > 0).alias("text_items"), n(F.array_contains("sources", "listing_text")).alias("listing_text_items"), n(F.array_contains("sources", "feature_summary")).alias("feature_summary_items"),
        n(F.col("profile_owned")).alias("profile_owned_items"), n(F.col("profile_missing")).alias("profile_missing_items"), n(F.col("conflict")).alias("conflict_items"))
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in sums.columns[1:]]
    return accounts.select("account_id").join(sums, "account_id", "left").select("account_id", F.lit(catalog_items).cast("long").alias("catalog_items"), *zeros)


def sidecar(accounts: DataFrame, listings: DataFrame, hits: DataFrame, owners: DataFrame) -> DataFrame:
    """A review-only row for each account: account_id, listing_id, eligibility, digests of text and summary, and matches, an array of
    (owner, assertion) sorted by owner. An account is scanned only if it has one listing and both say a seller offers a
    single account. accounts: account_id, listing_ids, offer_kind, entity_kind; listings: listing_id, offer_kind,
    entity_kind, listing_text, feature_summary (array); hits: settled, id being the account. No text leaves."""
    asked = accounts.select("account_id", F.col("offer_kind").alias("own_offer"), F.col("entity_kind").alias("own_entity"), F.when(F.size("listing_ids") == 1, F.get("listing_ids", F.lit(0))).alias("listing_id"))
    rows = asked.join(listings, "listing_id", "left")
    agreed = (F.col("own_offer").eqNullSafe(F.col("offer_kind"))) & (F.col("own_entity").eqNullSafe(F.col("entity_kind")))
    eligible = F.coalesce(agreed & (F.col("offer_kind") == "seller_listing") & (F.col("entity_kind") == "single_account"), F.lit(False))
    summary = F.coalesce("feature_summary", F.array().cast("array<string>"))
    digest = lambda text: F.upper(F.sha2(text.cast("binary"), 256))
    rows = rows.select(
        "account_id", "listing_id", eligible.alias("eligible"), digest(F.coalesce("listing_text", F.lit(""))).alias("listing_text_sha256"),
        digest(F.concat(F.to_json(summary), F.lit("\n"))).alias("feature_summary_sha256"))
    found = text_evidence(hits, owners, SIDECAR_NEGATIONS).select(F.col("id").alias("matched"), F.struct(
        "owner", F.when(F.col("positive") & F.col("negative"), "conflict").when(F.col("negative"), "negative").otherwise("positive").alias("assertion")).alias("match"))
    found = found.groupBy("matched").agg(F.array_sort(F.collect_list("match")).alias("matches"))
    kind = found.schema["matches"].dataType
    matches = F.when(F.col("eligible"), F.coalesce("matches", F.array().cast(kind))).otherwise(F.array().cast(kind))
    return rows.join(found, F.col("account_id") == F.col("matched"), "left").select(
        "account_id", "listing_id", F.when(F.col("eligible"), "eligible").otherwise("suppressed_not_seller_single_account").alias("matching_eligibility"),
        "listing_text_sha256", "feature_summary_sha256", F.lit(True).alias("review_only"), F.lit(False).alias("model_feature"), matches.alias("matches"))
