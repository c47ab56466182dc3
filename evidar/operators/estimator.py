"""The comparable estimator: hard pool, similarity, pool expansion, top five with explanations, range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidar.functions import similarity as sim
from evidar.functions.gates import reason_codes
from evidar.sources.stages import staged

TOP = 5
#: Rows of either side that meet in a block, pairs that a task makes at about, and the most tasks they are dealt to.
BLOCK, PAIRS_A_TASK, MOST_TASKS = 2_048, 4_000_000, 1 << 15
RESOURCES = ("white_candles", "hearts", "red_candles", "season_candles")


def set_overlaps(targets: DataFrame, sets: DataFrame, owner: str, item: str) -> DataFrame:
    """target_id, comparable_id, shared, jaccard of each target with every other owner that shares an item.
    Postings are joined by item, so owners without a shared item are never paired."""
    size = sets.groupBy(F.col(owner).alias("o")).agg(F.count(F.lit(1)).alias("n"))
    left = targets.select(F.col(owner).alias("target_id"), F.col(item).alias("i"))
    right = sets.select(F.col(owner).alias("comparable_id"), F.col(item).alias("j"))
    shared = left.join(right, F.col("i") == F.col("j")).where("target_id <> comparable_id").groupBy("target_id", "comparable_id").agg(F.count(F.lit(1)).alias("shared"))
    shared = shared.join(size.select(F.col("o").alias("a"), F.col("n").alias("na")), F.col("target_id") == F.col("a")).join(
        size.select(F.col("o").alias("b"), F.col("n").alias("nb")), F.col("comparable_id") == F.col("b"))
    return shared.select("target_id", "comparable_id", "shared", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard"))


def market_overlaps(sets: DataFrame, chosen: Column, owner: str, item: str, market: str) -> DataFrame:
    """As set_overlaps(), of the chosen owners with those of their own market alone: market, target_id, comparable_id, shared, jaccard.
    sets: owner, item and market, each item once. The sizes of the sets go with the postings, which are written once."""
    sized = staged(sets.select(owner, item, market, F.count(F.lit(1)).over(Window.partitionBy(owner)).alias("n")), "overlap-sets")
    left = sized.where(chosen).select(F.col(owner).alias("target_id"), F.col(item).alias("i"), F.col(market).alias("market"), F.col("n").alias("na"))
    right = sized.select(F.col(owner).alias("comparable_id"), F.col(item).alias("j"), F.col(market).alias("of"), F.col("n").alias("nb"))
    met = left.join(right, (F.col("i") == F.col("j")) & (F.col("market") == F.col("of"))).where("target_id <> comparable_id")
    shared = met.groupBy("market", "target_id", "comparable_id", "na", "nb").agg(F.count(F.lit(1)).alias("shared"))
    return shared.select("market", "target_id", "comparable_id", "shared", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard"))


def market_pairs(targets: DataFrame, comparables: DataFrame, market: tuple[str, str], ids: tuple[str, str], overlaps: DataFrame | None = None) -> DataFrame:
    """Each target beside all comparables of its market, columns of both. market and ids name a column of either side. The two sides
    of a market meet in blocks of about BLOCK rows, so neither a large market nor few of them make a long task; a row is sent
    to as many tasks as the other side has blocks, and no pair is shuffled. With overlaps (market, target_id, comparable_id, jaccard)
    jaccard stands beside, 0 where there is none: a target takes those of a block along, one for each of its rows at most."""
    (t_market, c_market), (t_id, c_id) = market, ids
    sizes = targets.groupBy(F.col(t_market).alias("of")).agg(F.count(F.lit(1)).alias("t_n")).join(comparables.groupBy(F.col(c_market).alias("of")).agg(F.count(F.lit(1)).alias("c_n")), "of")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = staged(sizes.select("of", blocks("t_n").alias("t_blocks"), blocks("c_n").alias("c_blocks"), (F.col("t_n") * F.col("c_n")).alias("pairs")), "market-sizes")
    pairs = sizes.agg(F.sum(F.col("pairs").cast("double"))).first()[0] or 0.0
    tasks = int(min(max(targets.sparkSession.sparkContext.defaultParallelism, pairs / PAIRS_A_TASK), MOST_TASKS))

    block = lambda row_id, mine: F.pmod(F.xxhash64(row_id), F.col(f"{mine}_blocks")).cast("int")

    def dealt(rows: DataFrame, own: str, row_id: str, mine: str, other: str) -> DataFrame:
        place = block(row_id, mine)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        met = rows.join(sizes, F.col(own) == F.col("of")).select(*rows.columns, place.alias(f"{mine}_block"), every.alias(f"{other}_block"))
        key = [F.col("t_block").alias(f"{mine}_t"), F.col("c_block").alias(f"{mine}_c")]
        return met.select(*rows.columns, *key)

    left, right = dealt(targets, t_market, t_id, "t", "c"), dealt(comparables, c_market, c_id, "c", "t")
    if overlaps is not None:
        near = overlaps.join(sizes, F.col("market") == F.col("of")).groupBy(F.col("target_id").alias("near_to"), block("comparable_id", "c").alias("near_in"))
        near = near.agg(F.map_from_entries(F.collect_list(F.struct("comparable_id", "jaccard"))).alias("near"))
        left = left.join(near, (F.col(t_id) == F.col("near_to")) & (F.col("t_c") == F.col("near_in")), "left").drop("near_to", "near_in")
    left, right = left.repartition(tasks, t_market, "t_t", "t_c"), right.repartition(tasks, c_market, "c_t", "c_c")
    met = (F.col(t_market) == F.col(c_market)) & (F.col("t_t") == F.col("c_t")) & (F.col("t_c") == F.col("c_c"))
    pairs = left.join(right, met).drop("t_t", "t_c", "c_t", "c_c")
    return pairs if overlaps is None else pairs.withColumn("jaccard", F.coalesce(F.try_element_at("near", F.col(c_id)), F.lit(0.0))).drop("near")


def top_k(rows: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "place") -> DataFrame:
    """The first k rows of each key (kept to k in every task before the shuffle)."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def choose_pool(pairs: DataFrame, exact: Column, target: list[str], least: int = 3) -> DataFrame:
    """For each target the sizes of the exact and the family pool, and which one is used: exact if it has enough."""
    enough = F.col("n_exact") >= least
    return pairs.groupBy(*target).agg(F.count_if(exact).alias("n_exact"), F.count(F.lit(1)).alias("n_family")).select(
        *target, "n_exact", "n_family", F.when(enough, "exact").otherwise("family").alias("pool"), F.when(enough, F.col("n_exact")).otherwise(F.col("n_family")).alias("pool_size"))


def hard_pool_codes(t: str, c: str) -> Column:
    """Reason codes of a pair of profiles (struct columns t and c); c.authorized comes from authorized rows."""
    f = lambda side, name: F.col(f"{side}.{name}")
    gates = [
        ("same_account_id", F.coalesce(sim.known(f(t, "account_id")) == sim.known(f(c, "account_id")), F.lit(False))),
        ("source_listing_id_overlap", F.coalesce(F.size(F.array_intersect(*[F.filter(f(s, "source_listing_ids"), lambda x: sim.known(x).isNotNull()) for s in (t, c)])) > 0, F.lit(False))),
        ("duplicate_cluster_id_match", F.coalesce(sim.known(f(t, "duplicate_cluster_id")) == sim.known(f(c, "duplicate_cluster_id")), F.lit(False))),
        ("market_data_external_authorization_evaluator_required", ~F.coalesce(f(c, "authorized"), F.lit(False))),
    ]
    for prefix, side in (("target_", t), ("", c)):
        review = f(side, "price_semantic_review")
        there = review.isNotNull()
        gates += [(f"{prefix}price_semantic_review_not_approved", there & ~review["review_status"].eqNullSafe("approved")),
                  (f"{prefix}brokerage_included", there & review["brokerage_included"].eqNullSafe(True)), (f"{prefix}multi_price", there & review["multi_price"].eqNullSafe(True))]
    for name in ("currency", "server"):
        a, b = sim.known(f(t, name)), sim.known(f(c, name))
        gates += [(f"target_{name}_unknown", a.isNull()), (f"{name}_unverified", a.isNotNull() & b.isNull()), (f"{name}_mismatch", F.coalesce(a != b, F.lit(False)))]
    gates += [(f"{n}_required", ~f(c, n).eqNullSafe(True)) for n in ("currency_verified", "server_verified")]
    for prefix, side in (("target_", t), ("", c)):
        gates += [(f"{prefix}not_seller_listing", ~f(side, "offer_kind").eqNullSafe("seller_listing")), (f"{prefix}not_single_account", ~f(side, "entity_kind").eqNullSafe("single_account"))]
    family, other = (sim.account_family(F.coalesce(f(s, "base_account_type"), F.lit("unknown"))) for s in (t, c))
    gates += [
        ("account_type_unverified", (family != "unknown") & (other == "unknown")),
        ("account_type_incompatible", (family != "unknown") & (other != "unknown") & (family != other)),
        ("target_price_type_unknown", F.coalesce(f(t, "price_type"), F.lit("unknown")) == "unknown"),
        ("price_type_mismatch", (F.coalesce(f(t, "price_type"), F.lit("unknown")) != "unknown") & ~f(t, "price_type").eqNullSafe(f(c, "price_type"))),
    ]
    return reason_codes(gates)


def dimensions(t: str, c: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Similarity of each of the ten dimensions, and whether both sides know it."""
    f = lambda side, name: F.col(f"{side}.{name}")
    pair = lambda name: (f(t, name), f(c, name))
    has = lambda x: F.coalesce(F.size(x) > 0, F.lit(False))
    both = lambda name: has(f(t, name)) & has(f(c, name))
    a, b = (sim.known(x, "winged_or_unspecified") for x in pair("base_account_type"))
    family = [sim.account_family(F.coalesce(x, F.lit("unknown"))) for x in pair("base_account_type")]
    account = F.when(F.coalesce(a == b, F.lit(False)), 1.0).when((family[0] != "unknown") & (family[0] == family[1]), 0.6).otherwise(0.0)
    sets = sim.jaccard(*pair("complete_set_ids")) * 0.7 + sim.jaccard(*pair("mentioned_set_ids")) * 0.3
    # what a text gives as about so much is no measurement, so it is unknown here
    exact = lambda s, r: F.when(~F.coalesce(F.array_contains(f(s, "approximate_resources"), r), F.lit(False)), f(s, f"resources.{r}").cast("double"))
    numbers = [sim.relative_similarity(exact(t, r), exact(c, r)) for r in RESOURCES]
    ratio_a, ratio_b = pair("map_completion_ratio")
    maps = F.coalesce(F.greatest(F.lit(0.0), 1 - F.abs(ratio_a - ratio_b)), sim.known_map_similarity(*pair("map_completion")), F.lit(0.0))
    values = {
        "account_type": account, "seasons": sim.season_similarity(*pair("seasons"), *pair("earliest_season_id")),
        "items_sets": sim.jaccard(*pair("owned_item_ids")) * 0.75 + sets * 0.25, "map_completion": maps, "collection": sim.jaccard(*pair("collection_ids")),
        "resources": F.coalesce(sim.mean_known(numbers), sim.level_similarity(*pair("resource_level"))),
        "bindings": F.when(both("bindings"), F.coalesce(sim.known_map_similarity(*pair("bindings")), F.lit(0.0))).otherwise(sim.level_similarity(*pair("binding_state"))),
        "ownership": sim.level_similarity(*pair("ownership_generation")), "date": sim.date_similarity(f(t, "valuation_date"), f(c, "post_date")),
        "evidence": sim.level_similarity(*pair("evidence_quality")),
    }
    known_text = lambda name: sim.known(f(t, name)).isNotNull() & sim.known(f(c, name)).isNotNull()
    any_items = [has(f(s, "owned_item_ids")) | has(f(s, "complete_set_ids")) | has(f(s, "mentioned_set_ids")) for s in (t, c)]
    flags = {
        "account_type": a.isNotNull() & b.isNotNull(), "seasons": both("seasons"), "items_sets": any_items[0] & any_items[1],
        "map_completion": (ratio_a.isNotNull() & ratio_b.isNotNull()) | sim.known_map_similarity(*pair("map_completion")).isNotNull(),
        "collection": both("collection_ids"), "resources": sim.mean_known(numbers).isNotNull(), "bindings": sim.known_map_similarity(*pair("bindings")).isNotNull(),
        "ownership": known_text("ownership_generation"), "date": f(t, "valuation_date").isNotNull() & f(c, "post_date").isNotNull(), "evidence": known_text("evidence_quality"),
    }
    return values, flags


CONTENT_DIMENSIONS = ("seasons", "items_sets", "map_completion", "collection", "resources", "bindings", "ownership")


def estimate(targets: DataFrame, comparables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(estimates, ledger). Both inputs are flat profiles (account_id, ..., see dimensions()); comparables
    carry input_ordinal, selected_price_twd and authorized. A profile may name approximate_resources. Targets are the small side: each is compared
    with every comparable, since those that fail must be accounted for, and nothing else is kept of them."""
    targets, comparables = (p if "approximate_resources" in p.columns else p.withColumn("approximate_resources", F.array().cast("array<string>")) for p in (targets, comparables))
    left = targets.select(F.col("account_id").alias("target_id"), F.struct(*targets.columns).alias("t"))
    right = comparables.select(F.struct(*comparables.columns).alias("c"))
    pairs = right.crossJoin(F.broadcast(left)).withColumn("codes", hard_pool_codes("t", "c"))
    price = F.col("c.selected_price_twd")
    pairs = pairs.withColumn("codes", F.when(F.coalesce(price >= 0, F.lit(False)), F.col("codes")).otherwise(F.array_append("codes", "price_missing_or_invalid")))
    pool = staged(pairs.where(F.size("codes") == 0).drop("codes"), "estimate-pool")
    exact = F.coalesce(F.col("t.base_account_type") == F.col("c.base_account_type"), F.lit(False))
    # few comparables of a target pass the pool; they alone are gathered
    by_target = Window.partitionBy("target_id")
    pool = pool.withColumn("exact", exact).withColumn("n_exact", F.count_if("exact").over(by_target))
    values, flags = dimensions("t", "c")
    parts = sim.weighted(values, sim.WEIGHTS)
    scored = staged(pool.withColumns({f"s_{k}": v for k, v in parts.items()} | {f"k_{k}": v for k, v in flags.items()}).select(
        "target_id", F.col("c.comparable_id").alias("comparable_id"), F.col("c.input_ordinal").alias("input_ordinal"), F.col("c.selected_price_twd").alias("price"),
        "exact", "n_exact", *[f"s_{k}" for k in parts], *[f"k_{k}" for k in flags]), "estimate-scores")
    parts, flags = {k: F.col(f"s_{k}") for k in parts}, {k: F.col(f"k_{k}") for k in flags}
    content = F.lit(0)
    for k in CONTENT_DIMENSIONS:
        content = content + flags[k].cast("int")
    scored = scored.withColumn("score", sim.total(parts))
    codes = reason_codes([
        ("account_type_family_not_needed", (F.col("n_exact") >= 3) & ~F.col("exact")),
        ("similarity_below_minimum", F.col("score") < sim.MIN_SCORE), ("too_few_content_dimensions", content < sim.MIN_CONTENT_DIMENSIONS)])
    scored = staged(scored.withColumn("codes", codes), "estimate-codes")
    order = Window.partitionBy("target_id").orderBy(F.desc("score"), "input_ordinal")
    ranked = scored.where(F.size("codes") == 0).withColumn("place", F.row_number().over(order))
    said = sim.describe(parts, flags, sim.WEIGHTS, sim.EXCLUSIVE_DIMENSIONS)
    top = ranked.where(F.col("place") <= TOP).withColumns(said)
    price = F.col("price")
    estimates = top.groupBy("target_id").agg(
        F.count(F.lit(1)).alias("comparables"), F.min(price).alias("low"), F.max(price).alias("high"), F.array_sort(F.collect_list(price)).alias("prices"),
        F.array_sort(F.collect_list(F.struct("place", "comparable_id", "score", *said))).alias("explanations"))
    upper = F.element_at("prices", (F.floor(F.size("prices") / 2) + 1).cast("int"))
    enough = F.col("comparables") >= 3
    estimates = left.select("target_id").join(estimates, "target_id", "left").select(
        "target_id", F.when(enough, "estimated").otherwise("insufficient_comparables").alias("status"), F.coalesce("comparables", F.lit(0)).alias("comparables"),
        *[F.when(enough, v).alias(n) for n, v in (("low", F.col("low")), ("median", upper), ("high", F.col("high")))], "explanations")
    rest = F.when(F.col("place") > TOP, F.array(F.lit("lower_rank_not_retained"))).otherwise(F.col("codes"))
    ledger = pairs.where(F.size("codes") > 0).select("target_id", F.col("c.comparable_id").alias("comparable_id"), "codes").unionByName(
        scored.where(F.size("codes") > 0).select("target_id", "comparable_id", "codes")).unionByName(ranked.select("target_id", "comparable_id", rest.alias("codes")))
    return estimates, ledger
