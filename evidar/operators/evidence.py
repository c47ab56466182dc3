"""Evidence about catalog items: gates of states and images, eligibility, grades, costs, coverage, replay of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.functions.gates import reason_codes

# Vocabularies of the evidence contracts.
IMAGE_ROLES = ("profile", "wardrobe", "map", "constellation", "resource", "unknown")
METHODS = ("manual", "template", "embedding", "ocr_text", "unknown")
STATES = ("owned", "confirmed_missing")
CLAIMS = ("profile_claim", "text_claim")
OFFICIAL, SECONDARY = "official_item_specific", "secondary_reference"


def gated_states(states: DataFrame, catalog: DataFrame, account: str, item: str) -> DataFrame:
    """states (account, item, state, review_status, evidence_state, conflict, model_feature) with codes and the model_feature
    that survives: one that the caller set, of an eligible item of the catalog, with approved evidence. Nothing is raised."""
    known = catalog.select(F.col(item), (F.coalesce(F.col("verified") & F.col("eligible"), F.lit(False))).alias("catalog_eligible"))
    # both sides by key: states of an account repeat an item, so counts are joined, not windowed over an account
    repeated = states.groupBy(account, item).agg(F.count(F.lit(1)).alias("times"))
    rows = states.join(known, item, "left").join(repeated, [account, item])
    there = F.col("catalog_eligible").isNotNull()
    sound = F.coalesce(F.col("state").isin(*STATES) & (F.col("review_status") == "approved") & F.col("evidence_state").isin(*CLAIMS) & ~F.col("conflict"), F.lit(False))
    asked = F.coalesce(F.col("model_feature"), F.lit(False))
    codes = reason_codes([("duplicate_item_state", F.col("times") > 1), ("unknown_canonical_item", ~there),
                          ("catalog_item_not_model_eligible", there & asked & ~F.col("catalog_eligible")), ("item_evidence_not_approved", there & asked & ~sound)])
    kept = there & asked & F.col("catalog_eligible") & sound
    return rows.withColumn("codes", codes).withColumn("model_feature", F.coalesce(kept, F.lit(False))).drop("catalog_eligible", "times")


def image_codes(box: str = "bounding_box") -> Column:
    """Errors of a row of image evidence: shapes, vocabularies, ranges, and a box that leaves the image."""
    c = F.col
    sides = [c(f"{box}.{n}") for n in ("x", "y", "width", "height")]
    there, item = c(box).isNotNull(), c("detected_item_id")
    within = F.lit(True)
    for s in sides:
        within = within & F.coalesce(s.between(0, 1), F.lit(False))
    return reason_codes([
        ("invalid:image_sha256", ~c("image_sha256").rlike("^[0-9A-Fa-f]{64}$")), ("invalid:image_role", ~c("image_role").isin(*IMAGE_ROLES)),
        ("invalid:recognition_method", ~c("recognition_method").isin(*METHODS)), ("invalid:confidence", ~c("confidence").between(0, 1)),
        ("invalid:detected_item_id", item.isNotNull() & ~item.startswith("item_")), ("invalid:bounding_box", there & ~within),
        ("invalid:bounding_box_bounds", there & within & ((sides[0] + sides[2] > 1) | (sides[1] + sides[3] > 1))),
        ("invalid:ocr_text_cannot_claim_item", F.coalesce((c("recognition_method") == "ocr_text") & item.isNotNull(), F.lit(False))),
        ("invalid:wardrobe_coverage", ~c("wardrobe_coverage").isin("complete", "partial", "unknown"))])


def name_decisions(items: DataFrame, evidence: DataFrame, item: str, name: str, token: Column) -> DataFrame:
    """item, decision, codes: whether two independent lineages, an official and a secondary one, state the exact name of an
    item. evidence: item, claim, tier, lineage, approved. token: the claim column as secondary sources are compared."""
    folded = F.regexp_replace(F.lower(F.col(name)), "[^a-z0-9]", "")
    joined = evidence.where("approved").join(items.select(item, name), item)
    official, second = (F.col("tier") == OFFICIAL) & (F.col("claim") == F.col(name)), (F.col("tier") == SECONDARY) & (token == folded)
    found = joined.groupBy(item).agg(F.count_if(official).alias("n_official"), F.count_if(second).alias("n_secondary"), F.countDistinct(F.when(official | second, F.col("lineage"))).alias("lineages"))
    rows = items.join(found, item, "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    codes = reason_codes([
        ("catalog_item_not_verified", ~F.col("verified")), ("canonical_english_name_missing_or_non_ascii", ~F.col(name).rlike(r"^[\x00-\x7F]+$")),
        ("official_exact_canonical_english_evidence_missing", none("n_official")), ("secondary_exact_canonical_english_evidence_missing", none("n_secondary")),
        ("independent_source_lineages_missing", F.coalesce(F.col("lineages"), F.lit(0)) < 2)])
    return rows.select(item, codes.alias("codes")).withColumn("decision", F.when(F.size("codes") == 0, "eligible").otherwise("excluded_pending_verification"))


def regraded(records: DataFrame, links: DataFrame, sources: DataFrame, key: str, source: str, official: Column) -> DataFrame:
    """records whose verified ones without an official source need review. links: key, source."""
    backed = links.join(sources.where(official).select(source).distinct(), source, "left_semi").select(key).distinct().withColumn("backed", F.lit(True))
    lacks = (F.col("verification_status") == "verified") & F.col("backed").isNull()
    return records.join(backed, key, "left").withColumn("regraded", F.coalesce(lacks, F.lit(False))).withColumn(
        "verification_status", F.when(F.col("regraded"), "needs_review").otherwise(F.col("verification_status"))).drop("backed")


def item_or_set(evidence: DataFrame, items: DataFrame, sets: DataFrame, target: str = "target_id") -> DataFrame:
    """evidence with target_kind: item, set, or null where neither catalog has the target."""
    i = items.select(F.col("item_id").alias("as_item")).distinct()
    s = sets.select(F.col("set_id").alias("as_set")).distinct()
    joined = evidence.join(i, F.col(target) == F.col("as_item"), "left").join(s, F.col(target) == F.col("as_set"), "left")
    return joined.withColumn("target_kind", F.when(F.col("as_item").isNotNull(), "item").when(F.col("as_set").isNotNull(), "set")).drop("as_item", "as_set")


def cost_references(claims: DataFrame, item: str) -> DataFrame:
    """item, reference_kind, amount of claims (item, scope item or bundle, amount, approved): the one amount that all approved
    claims of an item state; else the one of its bundle, which is never shared out among items; else unknown."""
    one = lambda scope: F.collect_set(F.when(F.col("approved") & (F.col("scope") == scope), F.col("amount")))
    found = claims.groupBy(item).agg(one("item").alias("own"), one("bundle").alias("bundle"))
    single = lambda c: F.size(c) == 1
    return found.select(item, F.when(single("own"), "item").when((F.size("own") == 0) & single("bundle"), "bundle").otherwise("unknown").alias("reference_kind"),
                        F.when(single("own"), F.col("own")[0]).when((F.size("own") == 0) & single("bundle"), F.col("bundle")[0]).alias("amount"))


def coverage(items: DataFrame, parts: dict[str, tuple[DataFrame, Column]], item: str) -> DataFrame:
    """items with a count of each part (name -> rows with the item, and which of them count); 0 where there are none. Each
    part is added up before it is joined."""
    out = items
    for name, (rows, counts) in parts.items():
        out = out.join(rows.groupBy(item).agg(F.count_if(counts).alias(name)), item, "left").fillna(0, [name])
    return out


def scopes(rows: DataFrame, kinds: dict[str, Column], measures: dict[str, Column]) -> DataFrame:
    """scope and measures: how many rows of each scope (all of them may overlap) hold, in one pass."""
    sums = rows.agg(*[F.count_if(F.coalesce(k & m, F.lit(False))).alias(f"{s}|{n}") for s, k in kinds.items() for n, m in measures.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), *[F.col(f"`{s}|{n}`").alias(n) for n in measures]) for s in kinds])).alias("x")).select("x.*")


def top_interactions(pairs: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The k pairs of each key with the greatest absolute value; those of 0 are none. Each task keeps k at most."""
    order = Window.partitionBy(key).orderBy(F.desc(F.abs(value)), F.desc(value), "left_feature", "right_feature")
    return pairs.where(F.col(value) != 0).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def without_identities(features: DataFrame, trusted: tuple[str, ...], aggregates: tuple[str, ...], kept: DataFrame | None = None) -> DataFrame:
    """Long features (feature, value, ...) without the items of untrusted groups, but with their aggregates; kept: items
    whose states are approved features all the same."""
    group = F.substring_index("feature", ".", 1)
    plain = features.where(group.isin(*trusted) | F.col("feature").isin(*aggregates))
    if kept is None:
        return plain
    approved = features.where(group == "items").join(kept.select(F.concat(F.lit("items."), F.col("item_id")).alias("feature")).distinct(), "feature", "left_semi")
    return plain.where(group != "items").unionByName(approved.select(*plain.columns))


def replayed_rules(rules: DataFrame, sources: DataFrame, document: Column, claim: Column) -> DataFrame:
    """A ledger row for each rule (target_id, field_path, source_key, locator, expected_id): what its source says there, with
    codes where the source is missing, names another item, or says nothing. document: id the source gives; claim: its value."""
    rows = rules.join(sources, "source_key", "left")
    times = rules.groupBy("target_id", "field_path", "source_key", "locator").agg(F.count(F.lit(1)).alias("times"))
    rows = rows.withColumn("claim_value", claim).withColumn("found_id", document).join(times, ["target_id", "field_path", "source_key", "locator"])
    codes = reason_codes([("source_missing", F.col("source_id").isNull()), ("source_item_id_differs", F.coalesce(F.col("found_id") != F.col("expected_id"), F.col("source_id").isNotNull())),
                          ("locator_selects_nothing", F.col("source_id").isNotNull() & F.col("claim_value").isNull()), ("duplicate_rule", F.col("times") > 1)])
    evidence = F.concat(F.lit("evidence_"), F.substring(F.sha2(F.concat_ws("|", "target_id", "field_path", "source_id", "locator", "claim_value"), 256), 1, 24))
    return rows.select("target_id", "field_path", "source_id", "locator", "claim_value", F.sha2("claim_value", 256).alias("claim_sha256"), codes.alias("codes"), evidence.alias("evidence_id"))


def independence(decisions: DataFrame, adjudications: DataFrame, key: str) -> DataFrame:
    """key and codes: two blind decisions of different reviewers, both strictly before the adjudication. decisions: key,
    reviewer, decided_at."""
    by_key = decisions.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("reviewer").alias("reviewers"), F.max("decided_at").alias("last"))
    rows = by_key.join(adjudications, key, "left")
    return rows.select(key, reason_codes([("two_decisions_required", F.col("n") != 2), ("reviewers_not_independent", F.col("reviewers") < 2),
                                          ("decision_not_before_adjudication", F.col("adjudicated_at").isNotNull() & ~(F.col("last") < F.col("adjudicated_at")))]).alias("codes"))


def vectors(states: DataFrame, account: str) -> DataFrame:
    """account, items (item_id, state, sorted by item), owned, missing, unknown of the states of an account."""
    return states.groupBy(account).agg(F.array_sort(F.collect_list(F.struct("item_id", "state"))).alias("items"),
                                       *[F.count_if(F.col("state") == s).alias(n) for s, n in (("owned", "owned"), ("confirmed_missing", "missing"), ("unknown", "unknown"))])
