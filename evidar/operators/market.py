"""Listings on their way into the market: profiles made flat, recovery and its approvals, near misses, observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.functions.gates import reason_codes
from evidar.functions.prices import ESTIMATOR_TYPES, urgent_claim, vocabulary

# The strict rules of a listing that may be recovered, and what a near miss may lack.
NORMAL_PRICE_TYPES = ("asking", "normal_listing")
URGENT_KINDS = ("asking", "normal_listing", "reduced", "instant", "instant_price", "quick_sale", "buyout")
OBSERVED_LINES = ("asking", "reduced", "urgent_sale", "verified_sale")
FACTS = ("listing_id", "price_twd", "price_type", "status", "currency", "currency_verified", "server", "server_verified", "offer_kind", "entity_kind", "exclusion_reason", "duplicate_cluster_id")


def flat_profile(profile: str = "profile", history: str = "history") -> dict[str, Column]:
    """Columns of a flat profile from a nested one and the history row joined to it (null for a target): what is
    nested wins over the top level, but a history's price type over the profile's claim."""
    p, h = (lambda name: F.col(f"{profile}.{name}")), (lambda name: F.col(f"{history}.{name}"))
    unknown = lambda c: F.coalesce(c, F.lit("unknown"))
    sets = p("collection.item_set_profiles")
    named = F.filter(sets, lambda s: s["set_id"].isNotNull())
    claim = F.when(h("history_id").isNotNull() & h("price_type").isNotNull(), h("price_type")).otherwise(F.coalesce(p("trade_conditions.price_type"), p("price_type")))
    rewards = [F.coalesce(p(f"collection.{c}"), F.array().cast("array<string>")) for c in ("graduation_rewards", "collaboration_items", "bundle_item_ids", "event_limited_item_ids")]
    platforms = F.filter(p("bindings.platforms"), lambda b: ~b["status"].isin("unknown", "mentioned_unknown") & b["platform"].isNotNull())
    return {
        "base_account_type": unknown(F.coalesce(p("base_account.account_type"), p("base_account_type"))),
        "earliest_season_id": unknown(p("season_summary.earliest_season_id")),
        "owned_item_ids": F.coalesce(p("collection.owned_item_ids"), F.array().cast("array<string>")),
        "collection_ids": F.array_distinct(F.concat(*rewards)),
        "complete_set_ids": F.transform(F.filter(named, lambda s: s["is_complete"]), lambda s: s["set_id"]),
        "mentioned_set_ids": F.transform(F.filter(named, lambda s: s["evidence_state"].isin("text_claim", "image_confirmed")), lambda s: s["set_id"]),
        "map_completion_ratio": p("map_completion.completion_ratio"),
        "bindings": F.map_from_entries(F.transform(platforms, lambda b: F.struct(b["platform"], b["status"]))),
        "binding_state": unknown(p("bindings.risk_state")),
        "ownership_generation": unknown(p("ownership_history")),
        "offer_kind": unknown(F.coalesce(p("trade_conditions.offer_kind"), p("offer_kind"))),
        "entity_kind": unknown(F.coalesce(p("trade_conditions.entity_kind"), p("entity_kind"))),
        "evidence_quality": unknown(p("evidence_quality.listing_text")),
        "price_type": vocabulary(unknown(claim), ESTIMATOR_TYPES),
    }


def consistent_variants(variants: Column, text: Column) -> Column:
    """An array of priced variants (structs with a kind) whose listing kinds are urgent where the text claims urgency."""
    urgent = urgent_claim(text)
    return F.coalesce(F.transform(variants, lambda v: v.withField("kind", F.when(urgent & F.lower(F.trim(v["kind"])).isin(*URGENT_KINDS), "urgent_sale").otherwise(v["kind"]))),
                      F.filter(variants, lambda v: F.lit(False)))


def comparable_rows(histories: DataFrame, profiles: DataFrame, key: str = "account_id") -> DataFrame:
    """Profiles with the facts of each of their histories over their own; a history without a profile is an error."""
    own = [c for c in profiles.columns if c == key or c not in histories.columns]
    joined = histories.join(profiles.select(*own).withColumn("has_profile", F.lit(True)), key, "left")
    return joined.withColumn("has_profile", F.when(F.col("has_profile"), True).otherwise(F.raise_error(F.concat(F.lit("history has no profile: "), F.col(key).cast("string"))))).where("has_profile").drop("has_profile")


def positive(price: Column) -> Column:
    return F.coalesce(price > 0, F.lit(False))


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text) == "", F.lit(True))


def recovery_codes() -> Column:
    """What keeps a listing from being recovered, in order; what is unknown never passes."""
    c = F.col
    return reason_codes([
        ("not_seller_listing", c("offer_kind") != "seller_listing"), ("not_single_account", c("entity_kind") != "single_account"),
        ("currency_not_verified", (c("currency") != "TWD") | ~c("currency_verified")), ("server_not_verified", (c("server") != "international") | ~c("server_verified")),
        ("not_normal_listing", ~c("price_type").isin(*NORMAL_PRICE_TYPES)), ("price_not_positive", ~positive(c("price_twd"))), ("not_active", c("status") != "active"),
        ("editorial_exclusion", ~blank(c("exclusion_reason"))), ("known_duplicate", c("duplicate_cluster_id").isNotNull())])


def recoverable(listings: DataFrame, used: DataFrame, key: str = "listing_id") -> DataFrame:
    """The listings that may be recovered: those that no history used and no code speaks against."""
    return listings.join(used.select(key).distinct(), key, "left_anti").where(F.size(recovery_codes()) == 0)


def facts_digest(facts: tuple[str, ...] = FACTS) -> Column:
    """SHA-256 of the named facts as canonical JSON of sorted keys, nulls included."""
    return F.sha2(F.to_json(F.struct(*sorted(facts)), {"ignoreNullFields": "false"}), 256)


def replayed_approvals(listings: DataFrame, decisions: DataFrame, key: str = "listing_id") -> DataFrame:
    """key and codes for each decision (key, facts_sha256, deduplication_result): an approval holds only for the very
    facts it was given for, while the listing can be recovered, and after a review for duplicates."""
    now = listings.select(key, facts_digest().alias("now_sha256"), (F.size(recovery_codes()) == 0).alias("passes"))
    joined = decisions.join(now, key, "left")
    return joined.select(key, reason_codes([
        ("listing_missing", F.col("now_sha256").isNull()), ("predicates_not_met", ~F.col("passes")), ("facts_changed", F.col("facts_sha256") != F.col("now_sha256")),
        ("deduplication_not_reviewed", F.col("deduplication_result") != "no_known_duplicate")]).alias("codes"))


def near_misses(listings: DataFrame) -> DataFrame:
    """listing_id, evidence_domain, required_fields of the listings that lack exactly one piece of hard evidence and are
    candidates otherwise. A value that is known and wrong is no missing evidence."""
    c = F.col
    base = ((c("offer_kind") == "seller_listing") & (c("entity_kind") == "single_account") & (c("currency") == "TWD") & c("currency_verified") & positive(c("price_twd"))
            & blank(c("exclusion_reason")) & c("duplicate_cluster_id").isNull())
    unknown = lambda n: F.coalesce(c(n) == "unknown", F.lit(True))
    server_gap = unknown("server") | ((c("server") == "international") & ~F.coalesce(c("server_verified"), F.lit(False)))
    groups = [("international_server_evidence", ("server", "server_verified"), server_gap, unknown("server") | (c("server") == "international")),
              ("normal_listing_price_type_evidence", ("price_type",), unknown("price_type"), unknown("price_type") | c("price_type").isin(*NORMAL_PRICE_TYPES)),
              ("active_listing_status_evidence", ("status",), unknown("status"), unknown("status") | (c("status") == "active"))]
    gaps = F.array_compact(F.array(*[F.when(gap, F.struct(F.lit(name).alias("evidence_domain"), F.array(*map(F.lit, fields)).alias("required_fields"))) for name, fields, gap, _ in groups]))
    for *_, possible in groups:
        base = base & possible
    return listings.where(base).withColumn("gaps", gaps).where(F.size("gaps") == 1).select("listing_id", F.col("gaps")[0]["evidence_domain"].alias("evidence_domain"), F.col("gaps")[0]["required_fields"].alias("required_fields"))


def model_gates(price_line: Column) -> tuple[Column, Column]:
    """Codes of the market and of the evidence that keep a profile from a model's estimate."""
    c = F.col
    market = reason_codes([("currency_must_be_twd", c("currency") != "TWD"), ("server_must_be_international", c("server") != "international"), ("target_not_seller_listing", c("offer_kind") != "seller_listing"),
                           ("target_not_single_account", c("entity_kind") != "single_account"), ("price_line_mismatch", c("price_type") != price_line)])
    evidence = reason_codes([("listing_evidence_insufficient", ~c("evidence_quality").isin("high", "medium")), ("profile_requires_review", F.coalesce(c("review_status") != "approved", F.lit(False)))])
    return market, evidence


def valid_observation() -> Column:
    """Whether a row may be observed as a price; a verified sale needs two pieces of independent evidence and its day."""
    c, sale = F.col, F.col("price_line") == "verified_sale"
    lineages = c("completion_lineages")
    plain = (c("observation_id").startswith("observation_") & c("source_snapshot_sha256").rlike("^[0-9A-Fa-f]{64}$") & c("dedup_cluster_id").startswith("cluster_") & (c("price_twd") >= 1)
             & c("date_verified") & (c("currency") == "TWD") & c("currency_verified") & (c("server") == "international") & c("server_verified") & (c("offer_kind") == "seller_listing")
             & (c("entity_kind") == "single_account") & c("price_line").isin(*OBSERVED_LINES) & c("post_date").isNotNull())
    sold = c("completed_sale_verified") & (c("completed_sale_date") == c("post_date")) & (F.size(lineages) >= 2) & (F.size(F.array_distinct(lineages)) == F.size(lineages))
    return F.coalesce(plain & F.when(sale, sold).otherwise(c("completed_sale_date").isNull()), F.lit(False))


def latest_price(vectors: DataFrame, prices: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """vectors with the price of their key; of several prices the last in order."""
    last = prices.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("place = 1").drop("place")
    return vectors.join(last, key)


def by_single_source(profiles: DataFrame, ids: str, listings: DataFrame, key: str) -> DataFrame:
    """profiles with the listing of their source, where they have exactly one."""
    only = profiles.where(F.size(ids) == 1)
    return only.join(listings, F.get(only[ids], F.lit(0)) == listings[key])


def intake_codes(records: DataFrame, unique: dict[str, str], parts: list[str]) -> DataFrame:
    """records with derived_id (from the digest of parts) and codes: which of the columns of unique (column -> code) repeat,
    and whether another record has the same derived id with other parts."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    rows = records.withColumn("digest", digest).withColumn("derived_id", F.concat(F.lit("observation_"), F.substring("digest", 1, 24)))
    for i, column in enumerate(unique):
        again = rows.groupBy(column).agg(F.count(F.lit(1)).alias(f"n{i}"))
        rows = rows.join(again, column)
    clash = rows.groupBy("derived_id").agg((F.min("digest") != F.max("digest")).alias("clash"))
    rows = rows.join(clash, "derived_id")
    codes = reason_codes([*((code, F.col(f"n{i}") > 1) for i, code in enumerate(unique.values())), ("derived_id_collision", F.col("clash"))])
    return rows.withColumn("codes", codes).drop("digest", "clash", *(f"n{i}" for i in range(len(unique))))
