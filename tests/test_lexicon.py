"""Dictionaries in texts and profiles, against plain Python over random texts and hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from evidar.functions import claims, prices
from evidar.operators import lexicon, matching, profiles

NONE_ITEMS = "item_id string, names array<string>, aliases array<string>, canonical_name_en string, verification_status string, model_feature_status string"


def plain(text, keys, policy):
    """All occurrences, then the greedy choice over the whole text."""
    found = [(i, i + len(k), k) for k in keys for i in range(len(text)) if text.startswith(k, i)]
    chosen = []
    if policy == matching.LONGEST_FIRST:
        for a, b, k in sorted(found, key=lambda f: (f[0] - f[1], f[0], f[2])):
            if not any(a < d and c < b for c, d, _ in chosen):
                chosen.append((a, b, k))
    else:
        end = 0
        for a, b, k in sorted(found, key=lambda f: (f[0], -f[1], f[2])):
            if a >= end:
                chosen.append((a, b, k))
                end = b
    return sorted(chosen)


@pytest.mark.parametrize("most", [0, 1 << 20])
@pytest.mark.parametrize("policy", [matching.LONGEST_FIRST, matching.LEFTMOST_LONGEST])
def test_matching_of_random_texts(spark, monkeypatch, policy, most):
    monkeypatch.setattr(lexicon, "STRIDE", 7)
    rng = random.Random(4)
    keys = sorted({"".join(rng.choice("ab無") for _ in range(rng.randint(2, 5))) for _ in range(25)})
    texts = [(i, s, "".join(rng.choice("ab無c") for _ in range(rng.randint(0, 40)))) for i in range(40) for s in ("x", "y")] + [(90, "x", None), (91, "x", "")]
    rows = spark.createDataFrame(texts, "id long, source string, text string")
    aliases = spark.createDataFrame([(k,) for k in keys], "alias string")
    hits = lexicon.settled(lexicon.occurrences(rows, aliases, 4, most), policy).collect()
    want = [(i, s, a, b, k, t[max(0, a - 4) : a]) for i, s, t in texts if t for a, b, k in plain(t, keys, policy)]
    assert sorted((h.id, h.source, h.start, h.stop, h.alias, h.before) for h in hits) == sorted(want) and len(want) > 150
    assert lexicon.occurrences(rows, aliases.limit(0), 4, most).count() == 0 and lexicon.occurrences(rows.limit(0), aliases, 4, most).count() == 0


def test_large_dictionaries_refuse_single_characters(spark):
    rows = spark.createDataFrame([(1, "x", "a")], "id long, source string, text string")
    with pytest.raises(ValueError, match="2 characters"):
        lexicon.occurrences(rows, spark.createDataFrame([("a",)], "alias string"), most=0)


def test_alias_rules(spark):
    items = spark.createDataFrame([
        ("i1", ["鹿角", "Deer-Horn"], ["角", "deer", "ab"], "Deer-Horn", "verified", "eligible"), ("i2", ["x", None], ["Deer", "long name"], None, "verified", "excluded_pending_verification"),
        ("i3", [], [], "Deer Horn!", "needs_review", "eligible")], NONE_ITEMS)
    master = spark.createDataFrame([("item", "i3", "ef", True), ("item", "i3", "gh", False), ("item", "nobody", "ghi", True), ("set", "i3", "set name", True), ("item", "i3", None, True)],
                                   "target_type string, target_id string, alias_text string, verified boolean")
    got = {r.alias: r.item_id for r in lexicon.alias_table(items, master).collect()}
    # two characters name an item, three nickname it, two if a verified row says so; deer has two owners
    assert got == {"鹿角": "i1", "deerhorn": "i1", "longname": "i2", "ef": "i3"}
    assert [(r.item_id, r.token) for r in lexicon.approved_tokens(items).collect()] == [("i1", "deerhorn")]


def test_sidecar_rows(spark):
    accounts = spark.createDataFrame([("a", ["l1"], "seller_listing", "single_account"), ("b", ["l1", "l2"], "seller_listing", "single_account"), ("c", ["l2"], "seller_listing", "single_account"),
                                      ("d", None, None, None), ("e", ["gone"], None, None)], "account_id string, listing_ids array<string>, offer_kind string, entity_kind string")
    listings = spark.createDataFrame([("l1", "seller_listing", "single_account", "有甲乙丙，沒有丁戊己", ["甲乙丙", "無甲乙丙"]), ("l2", "mixed", "single_account", "甲乙丙", None)],
                                     "listing_id string, offer_kind string, entity_kind string, listing_text string, feature_summary array<string>")
    keys = spark.createDataFrame([("甲乙丙", "q1"), ("丁戊己", "q2")], "alias string, owner string")
    texts = spark.createDataFrame([("a", "t", "有甲乙丙沒有丁戊己"), ("a", "s", "甲乙丙無甲乙丙"), ("c", "t", "甲乙丙")], "id string, source string, text string")
    hits = lexicon.settled(lexicon.occurrences(texts, keys, lexicon.SIDECAR_WINDOW), matching.LEFTMOST_LONGEST)
    got = {r.account_id: r for r in lexicon.sidecar(accounts, listings, hits, keys).collect()}
    assert [(m.owner, m.assertion) for m in got["a"].matches] == [("q1", "conflict"), ("q2", "negative")]
    assert {k: r.matching_eligibility for k, r in got.items() if k != "a"} == dict.fromkeys("bcde", "suppressed_not_seller_single_account")
    assert all(not r.matches and r.review_only and not r.model_feature for k, r in got.items() if k != "a") and got["b"].listing_id is None


def test_white_space_and_digits_of_any_script(spark):
    value = lambda t: spark.range(1).select(claims.resource_claim(F.lit(t), "white_candles").alias("c")).first().c
    assert value("白蠟１８３１").value == value("白蠟　1831").value == value("1831　白蠟").value == 1831
    assert value("白蠟　約　３００").kind == "approximate" and value("白蠟１０００　以上").value is None and value("約１８３１白蠟").value is None
    said = lambda f, t: spark.range(1).select(f(F.lit(t)).alias("x")).first().x
    assert said(prices.sale_and_exchange, "售　／　換") and not said(prices.urgent_claim, "不　急售")
    assert said(lambda t: prices.price_semantic_review(t, F.lit("asking")), "分　３　期 另加500").multi_price
    assert said(claims.ownership_history, "第　2　任") == "second_owner" and said(claims.ownership_history, "第２任") == "unknown"  # holders are numbered in ASCII or Han


def test_sources_of_seasons_agree_or_conflict(spark):
    aliases, order = {"破曉": "dawn", "極光": "aurora", "表演": "stage"}, {"dawn": 1, "aurora": 2, "stage": 3}
    texts = spark.createDataFrame([(1, "破曉畢業", "破曉"), (2, "破曉畢業", "破曉未畢"), (3, "缺破曉", "破曉畢業"), (4, "", "極光"), (5, "表演半畢業", "表演畢業"), (6, None, None)], "id long, text string, summary string")
    got = {r.id: (r.season_id, r.status, r.evidence_state) for r in profiles.season_profiles(texts, aliases, order).collect()}
    assert got == {1: ("dawn", "complete", "text_claim"), 2: ("dawn", "unknown", "conflict"), 3: ("dawn", "unknown", "conflict"), 4: ("aurora", "owned_not_complete", "text_claim"), 5: ("stage", "unknown", "conflict")}


def test_profiles_of_awkward_listings(spark):
    schema = "listing_id long, account_id long, offer_kind string, entity_kind string, listing_text string, feature_summary array<string>, known_bindings map<string,string>, binding_risk string"
    seller = ("seller_listing", "single_account")
    rows = [(1, 1, *seller, "白蠟 5，雪人斗篷，冬季套裝", ["白蠟 6", None], {"google": "restricted"}, "clean_claimed"), (2, 2, *seller, None, None, None, None), (3, 3, "mixed", "single_account", "白蠟 5 雪人斗篷", [], {}, "restricted"),
            (4, 4, *seller, "沒有雪人斗篷", ["雪人斗篷"], {"steam": "unbound"}, "odd")]
    names = spark.createDataFrame([("雪人斗篷", "item", "i1"), ("冬季套裝", "set", "s1")], "alias string, target_type string, target_id string")
    items = spark.createDataFrame([("i1", True, None, ["s1"], "event", "limited_time")], "item_id string, ultimate_reward boolean, collaboration boolean, set_ids array<string>, source_type string, availability_status string")
    sets = spark.createDataFrame([("s1", "bundle"), ("s1", "bundle")], "set_id string, set_type string")
    made = {r.listing_id: r for r in profiles.profiles(spark.createDataFrame(rows, schema), {"破曉": "dawn"}, {"dawn": 1}, names, items, sets).collect()}
    assert len(made) == 4 and made[1].review_status == "needs_review" and made[1].resources["values"].white_candles is None and made[1].resources.evidence.white_candles.sources == ["listing_text", "normalized_feature_summary"]
    google = {b.platform: b.status for b in made[1].bindings}["google"]
    assert google == "high_risk" and made[1].risk_state == "low" and made[4].risk_state == "unknown" and {b.platform: b.status for b in made[4].bindings}["steam"] == "available"
    own = made[1].collection
    assert own.owned_item_ids == own.graduation_rewards == own.bundle_item_ids == own.event_limited_item_ids == ["i1"] and own.collaboration_items == []
    assert [s.target_id for s in made[1].item_sets] == ["s1"] and made[4].collection.sources == ["normalized_feature_summary"]
    assert made[2].collection is None and made[3].collection is None and made[3].resources["values"].white_candles is None and made[2].review_status == "unknown"


def test_only_places_that_may_be_keys_leave_their_task(spark):
    """Long texts with few keys: the join gets little more than the hits, whatever begins like a key."""
    rng = random.Random(9)
    keys = ["ab" + "".join(rng.choice("cdef") for _ in range(6)) for _ in range(50)]
    texts = [(i, "x", "abcd" * 500 + keys[i % 50] + "ab" * 300) for i in range(20)]
    rows, aliases = spark.createDataFrame(texts, "id long, source string, text string"), spark.createDataFrame([(k,) for k in set(keys)], "alias string")
    found = lexicon.occurrences(rows, aliases, 4, 0)
    assert sorted((h.id, h.start, h.alias, h.before) for h in found.collect()) == sorted((i, 2000, keys[i % 50], "abcd") for i, _, _ in texts)
    plan = found._jdf.queryExecution().optimizedPlan()
    assert "explode(sequence" not in plan.toString() and "LeftSemi" in plan.toString()
