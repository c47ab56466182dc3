"""Account profiles put together from a listing's text and its feature summary, two sources that may disagree.

Each claim is parsed in each source by itself; a field keeps the one value that the sources give, or is unknown with the
conflict on record. What a seller of a single account does not say stays unknown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidar.functions import claims
from evidar.functions.text import lower_alnum
from evidar.operators import lexicon, matching, seasons

SOURCES = ("listing_text", "normalized_feature_summary")
# Availabilities of an event's items that are limited, and what older binding and risk words are called now.
LIMITED = ("limited_time", "temporarily_unavailable", "officially_discontinued")
BINDING_WORDS = {"restricted": "high_risk", "included": "available", "transferable": "available", "unbound": "available"}
RISK_STATES = {"partial_or_unknown": "unknown", "clean_claimed": "low", "restricted": "restricted", "low": "low", "high_risk": "high_risk"}
MAP_FIELDS = ("standard_maps", "second_tier_capes")


def source_texts(listings: DataFrame) -> DataFrame:
    """listings with text and summary: what may be claimed from, empty unless a seller offers a single account."""
    allowed = F.coalesce((F.col("offer_kind") == "seller_listing") & (F.col("entity_kind") == "single_account"), F.lit(False))
    lines = F.array_join(F.array_compact(F.coalesce("feature_summary", F.array().cast("array<string>"))), "\n")
    return listings.withColumns({"allowed": allowed, "text": F.when(allowed, F.coalesce("listing_text", F.lit(""))).otherwise(""), "summary": F.when(allowed, lines).otherwise("")})


def parsed(texts: DataFrame) -> DataFrame:
    """texts with what each source claims by itself: resources, maps, history and bindings, each for text and for summary."""
    out = {}
    texts = texts.withColumns({f"parts_{s}": claims.binding_parts(F.col(s)) for s in ("text", "summary")})
    for source in ("text", "summary"):
        said = F.col(source)
        out[f"resources_{source}"] = F.struct(*[claims.resource_claim(said, r).alias(r) for r in claims.RESOURCE_WORDS])
        out[f"maps_{source}"] = claims.map_completion(said)
        out[f"history_{source}"] = claims.ownership_history(said)
        out[f"bindings_{source}"] = claims.bindings_of(F.col(f"parts_{source}"))
    return texts.withColumns(out).drop("parts_text", "parts_summary")


def merged_fields(rows: DataFrame) -> DataFrame:
    """parsed() rows with each field's one value, evidence state and sources, as structs res_<resource>, map_<field>, history and
    bind_<platform>."""
    both = lambda field, name: [(F.col(f"{field}_{c}")[name], s) for c, s in zip(("text", "summary"), SOURCES)]
    out = {f"res_{r}": claims.merged(*((c["value"], s) for c, s in both("resources", r))) for r in claims.RESOURCE_WORDS}
    out |= {f"map_{f}": claims.merged(*both("maps", f), unknown="unknown") for f in MAP_FIELDS}
    out["history"] = claims.merged((F.col("history_text"), SOURCES[0]), (F.col("history_summary"), SOURCES[1]), unknown="unknown")
    out |= {f"bind_{p}": claims.merged(*both("bindings", p), unknown="unknown") for p in claims.PLATFORM_WORDS}
    return rows.withColumns(out)


def _overall(names: list[str]) -> Column:
    states = F.array(*[F.col(f"{n}.evidence_state") for n in names])
    return F.when(F.array_contains(states, "conflict"), "conflict").when(F.array_contains(states, "text_claim"), "text_claim").otherwise("unknown")


def resources() -> Column:
    """values, kinds and evidence by resource, and the evidence of all. A value is approximate if a source that gives it says so."""
    def kind(r: str) -> Column:
        own = F.col(f"res_{r}")
        rough = [F.coalesce((F.col(f"resources_{c}")[r]["value"] == own["value"]) & (F.col(f"resources_{c}")[r]["kind"] == "approximate"), F.lit(False)) for c in ("text", "summary")]
        return F.when((own["evidence_state"] == "text_claim") & (rough[0] | rough[1]), "approximate")

    every = list(claims.RESOURCE_WORDS)
    return F.struct(F.struct(*[F.col(f"res_{r}.value").alias(r) for r in every]).alias("values"), F.struct(*[kind(r).alias(r) for r in every]).alias("kinds"),
                    F.struct(*[F.col(f"res_{r}").alias(r) for r in every]).alias("evidence"), _overall([f"res_{r}" for r in every]).alias("evidence_state"))


def maps() -> Column:
    return F.struct(*[F.col(f"map_{f}").alias(f) for f in MAP_FIELDS], _overall([f"map_{f}" for f in MAP_FIELDS]).alias("evidence_state"))


def bindings(known: Column | None = None) -> Column:
    """An array of (platform, status, evidence_state, sources) in the platforms' order. known: a map of what was on record, which
    counts where neither source says anything."""
    words = F.create_map(*[F.lit(x) for pair in BINDING_WORDS.items() for x in pair])
    out = []
    for platform in claims.PLATFORM_WORDS:
        m = F.col(f"bind_{platform}")
        status = m["value"]
        if known is not None:
            old = F.try_element_at(known, F.lit(platform))
            status = F.when(m["evidence_state"] == "unknown", F.coalesce(F.try_element_at(words, old), old, F.lit("unknown"))).otherwise(status)
        out.append(F.struct(F.lit(platform).alias("platform"), status.alias("status"), m["evidence_state"].alias("evidence_state"), m["sources"].alias("sources")))
    return F.array(*out)


def risk_state(said: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in RISK_STATES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.coalesce(said, F.lit("unknown"))), F.lit("unknown"))


def season_profiles(texts: DataFrame, aliases: dict[str, str], order: dict[str, int]) -> DataFrame:
    """id, season_id, status, pass_owned, evidence_state and sources of texts(id, text, summary): claims of both sources, merged.
    That a season is named says that it is owned, which agrees with any more specific claim; two specific ones are a
    conflict, and so is a denied completion beside a claimed one or beside a missing season."""
    said = texts.select("id", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.col(c).alias("said")) for c, s in zip(("text", "summary"), SOURCES)])).alias("x"))
    said = said.select(F.struct("id", "x.source").alias("key"), F.col("x.said").alias("said")).where("said <> ''")
    rows = seasons.season_claims(said, "key", "said", aliases, order, flags=True).select("id.id", "id.source", "season_id", "status", "pass_owned", "evidence_state", "positive", "negative")
    known = F.when(F.col("status") != "unknown", F.col("status"))
    specific = F.when(known != "owned_not_complete", known)
    passes = F.when(F.col("pass_owned") != "unknown", F.col("pass_owned"))
    sums = rows.groupBy("id", "season_id").agg(
        F.count(known).alias("n"), F.min(specific).alias("low"), F.max(specific).alias("high"), F.min(passes).alias("pass_low"), F.max(passes).alias("pass_high"),
        F.bool_or("positive").alias("positive"), F.bool_or("negative").alias("negative"), F.bool_or(F.col("status") == "confirmed_missing").alias("missing"),
        F.array_sort(F.collect_set("source")).alias("sources"))
    denied_conflict = F.col("negative") & (F.col("positive") | F.col("missing"))
    conflict = F.when(F.col("negative"), denied_conflict).otherwise(F.coalesce(F.col("low") != F.col("high"), F.lit(False)))
    status = F.when(conflict, "unknown").when(F.col("negative"), "owned_not_complete").when(F.col("low").isNotNull(), F.col("low")).when(F.col("n") > 0, "owned_not_complete").otherwise("unknown")
    two = F.coalesce(F.col("pass_low") != F.col("pass_high"), F.lit(False))
    return sums.select("id", "season_id", status.alias("status"), F.when(two, "unknown").otherwise(F.coalesce("pass_low", F.lit("unknown"))).alias("pass_owned"),
                       F.when(conflict | two, "conflict").otherwise("text_claim").alias("evidence_state"), "sources")


def collection_claims(texts: DataFrame, names: DataFrame) -> DataFrame:
    """id, target_type, target_id and sources of the items and sets that a text or summary names without denying them.
    texts: id, text, summary; names: alias (normalised), target_type, target_id, each alias of one target. Only positive
    claims are made: a denied name says nothing here."""
    said = texts.select("id", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.col(c).alias("said")) for c, s in zip(("text", "summary"), SOURCES)])).alias("x"))
    hits = lexicon.settled(lexicon.occurrences(said.select("id", "x.source", lower_alnum(F.col("x.said")).alias("text")), names), matching.LONGEST_FIRST)
    stated = hits.where(~lexicon.negated(F.col("before"))).join(names, "alias")
    return stated.groupBy("id", "target_type", "target_id").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def collection_subsets(owned: DataFrame, items: DataFrame, sets: DataFrame) -> DataFrame:
    """id and what its owned items are by the catalog alone: owned_item_ids, graduation_rewards, collaboration_items,
    bundle_item_ids and event_limited_item_ids, each sorted, and the sources of the claims. owned: id, item_id, sources;
    items: item_id, ultimate_reward, collaboration, set_ids, source_type, availability_status; sets: set_id, set_type."""
    bundled = items.select("item_id", F.explode("set_ids").alias("set_id")).join(sets.where("set_type = 'bundle'").select("set_id").distinct(), "set_id", "left_semi")
    about = items.join(bundled.select("item_id").distinct().withColumn("bundle", F.lit(True)), "item_id", "left").select(
        "item_id", F.coalesce("ultimate_reward", F.lit(False)).alias("graduation_rewards"), F.coalesce("collaboration", F.lit(False)).alias("collaboration_items"), F.coalesce("bundle", F.lit(False)).alias("bundle_item_ids"),
        F.coalesce((F.col("source_type") == "event") & F.col("availability_status").isin(*LIMITED), F.lit(False)).alias("event_limited_item_ids"))
    kinds = about.columns[1:]
    rows = owned.join(about, "item_id", "left")
    some = lambda kept: F.array_sort(F.collect_set(F.when(kept, F.col("item_id"))))
    return rows.groupBy("id").agg(some(F.lit(True)).alias("owned_item_ids"), *[some(F.col(k)).alias(k) for k in kinds], F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"))


def profiles(listings: DataFrame, aliases: dict[str, str], order: dict[str, int], names: DataFrame, items: DataFrame, sets: DataFrame) -> DataFrame:
    """One profile a listing: account_id, listing_id, seasons, resources, maps, bindings, risk_state, ownership_history, collection,
    review_status. listings: listing_id, account_id, offer_kind, entity_kind, listing_text, feature_summary (array),
    known_bindings (map), binding_risk. A conflict in any field asks for review; so does a name that no season has for sure."""
    texts = source_texts(listings).withColumn("id", F.col("listing_id"))
    named = season_profiles(texts.select("id", "text", "summary"), aliases, order)
    by_listing = named.groupBy(F.col("id").alias("season_of")).agg(
        F.array_sort(F.collect_list(F.struct("season_id", "status", "pass_owned", "evidence_state", "sources"))).alias("seasons"), F.bool_or(F.col("evidence_state") == "conflict").alias("season_conflict"))
    claimed = collection_claims(texts.select("id", "text", "summary"), names)
    owned = collection_subsets(claimed.where("target_type = 'item'").select("id", F.col("target_id").alias("item_id"), "sources"), items, sets)
    owned = owned.select(F.col("id").alias("owned_of"), F.struct(*owned.columns[1:]).alias("collection"))
    named_sets = claimed.where("target_type = 'set'").groupBy(F.col("id").alias("sets_of")).agg(F.array_sort(F.collect_list(F.struct("target_id", "sources"))).alias("item_sets"))
    rows = merged_fields(parsed(texts)).select("account_id", "listing_id", resources().alias("resources"), maps().alias("maps"), F.col("history").alias("ownership_history"), bindings(F.col("known_bindings")).alias("bindings"),
                        F.when(F.col("allowed"), risk_state(F.col("binding_risk"))).otherwise("unknown").alias("risk_state"))
    for more, key in ((by_listing, "season_of"), (owned, "owned_of"), (named_sets, "sets_of")):
        rows = rows.join(more, F.col("listing_id") == F.col(key), "left").drop(key)
    conflict = (
        (F.col("resources.evidence_state") == "conflict") | (F.col("maps.evidence_state") == "conflict") | (F.col("ownership_history.evidence_state") == "conflict")
        | F.exists("bindings", lambda b: b["evidence_state"] == "conflict") | F.coalesce("season_conflict", F.lit(False)))
    return rows.withColumn("review_status", F.when(conflict, "needs_review").otherwise("unknown")).drop("season_conflict")
