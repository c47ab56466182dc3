"""Known cases of splits, text, states, similarity, provenance and models."""

import hashlib
import json
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidar.functions import claims, digests, prices, similarity, text
from evidar.operators import audit, estimator, matching, modelling, provenance, relate, seasons, splits
from evidar.sources import readers, sinks


def one(spark, column, **values):
    kinds = {str: "string", int: "long", float: "double", bool: "boolean", type(None): "string", date: "date"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return df.select(column.alias("x")).first().x


# splits


def spans(spark, rows):
    return spark.createDataFrame(rows, "cluster string, begin date, end date")


def test_time_forward_split(spark):
    a, b = date(2025, 1, 1), date(2025, 2, 1)
    rows = [(f"a{i}", a, a) for i in range(300)] + [(f"b{i}", b, b) for i in range(100)]
    cut = splits.best_cut(spans(spark, rows), []).first()
    assert (cut.cut, cut.training, cut.holdout, cut.spanning, cut.requirements_met) == (b, 300, 100, 0, True)
    crossing = splits.best_cut(spans(spark, [*rows[:399], ("c", a, b)]), []).first()
    assert not crossing.requirements_met and crossing.spanning >= 1
    assert splits.best_cut(spans(spark, rows[:300]), []).count() == 0


def test_grouped_folds_keep_groups_together(spark):
    rows = spark.range(1000).withColumn("g", F.col("id") % 97)
    per = splits.grouped_folds(rows, "g", 4).groupBy("g").agg(F.countDistinct("fold").alias("n"))
    assert per.where("n > 1").count() == 0 and per.count() == 97


# text and claims

A = {"表演": "season_performance", "破曉": "season_shattering", "極光": "season_aurora", "狂歡": "season_carnival", "預言": "season_prophecy"}
ORDER = {"season_prophecy": 0, "season_performance": 1, "season_shattering": 2, "season_aurora": 3, "season_carnival": 4}


def season_rows(spark, text, aliases=A, order=ORDER):
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, text string")
    return seasons.season_claims(rows, "id", "text", aliases, order)


def test_season_range_with_gap(spark):
    found = season_rows(spark, "表演～狂歡無斷，缺破曉；預言季卡")
    by = {r.season_id: r for r in found.collect()}
    assert by["season_shattering"].status == "confirmed_missing" and by["season_aurora"].status == "owned_not_complete"
    assert by["season_prophecy"].pass_owned == "yes" and by["season_prophecy"].id == 1
    assert [(r["first"], r["last"]) for r in seasons.season_runs(found, ORDER, ("confirmed_missing",)).collect()] == [(2, 2)]
    assert sorted((r["first"], r["last"]) for r in seasons.season_runs(found, ORDER).collect()) == [(0, 1), (3, 4)]
    assert seasons.season_summary(found, ORDER).first().earliest_season_id == "season_prophecy"
    assert {r.season_id: r.status for r in season_rows(spark, "表演～狂歡").collect()}["season_aurora"] == "unknown"


def test_season_rules(spark):
    cases = [
        ("狂歡畢業，極光有卡未畢", {"season_carnival": ("complete", "yes"), "season_aurora": ("owned_not_complete", "yes")}),
        ("表演1/2 破曉", {"season_performance": ("partial", "unknown"), "season_shattering": ("owned_not_complete", "unknown")}),
        ("表演與極光半畢業", {"season_performance": ("partial", "unknown"), "season_aurora": ("partial", "unknown")}),
        ("畢業季節：表演、極光", {"season_performance": ("complete", "unknown"), "season_aurora": ("complete", "unknown")}),
        ("極光無卡，狂歡全畢業但狂歡未畢", {"season_aurora": ("owned_not_complete", "no"), "season_carnival": ("owned_not_complete", "no")}),
        ("預言～表演全畢", {"season_prophecy": ("complete", "unknown"), "season_performance": ("complete", "unknown")}),
        ("凜冬畢業", {}), (None, {}), ("", {}),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id long, text string")
    got = {i: {} for i in range(len(cases))}
    for r in seasons.season_claims(rows, "id", "text", A, ORDER).collect():
        got[r.id][r.season_id] = (r.status, r.pass_owned)
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_everyday_words_are_seasons_only_where_presented_as_such(spark):
    cases = [("破碎半畢業", True), ("破碎季", True), ("季節：破碎", True), ("破碎～表演", True), ("破碎的翅膀", False), ("不含破碎季", False), ("表演破碎畢業", False), ("集結大家一起玩", False)]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id long, text string")
    found = {r.id: r.status for r in seasons.season_claims(rows, "id", "text", {"破碎": "s", "集結": "s", "表演": "p"}, {"s": 1, "p": 5}).where("season_id = 's'").collect()}
    assert set(found) == {i for i, (_, counts) in enumerate(cases) if counts} and found[0] == "partial"


def test_bindings(spark):
    get = lambda t: one(spark, claims.binding_matrix(F.col("t")), t=t)
    said = get("GG、GC、NS 前號主不出")
    assert {said[p] for p in ("google", "game_center", "nintendo")} == {"high_risk"} and said["steam"] == "unknown"
    later = get("Google、Apple ID、任天堂綁定不出，Google、PlayStation、Steam 可出")
    assert later["google"] == "high_risk" and later["steam"] == "available"
    two = one(spark, claims.binding_matrix(F.col("t"), F.col("u")), t="GG 可出", u="GG 遺失；FB")
    assert two["google"] == "high_risk" and two["facebook"] == "mentioned_unknown" and set(get(None).values()) == {"unknown"}


def test_resources(spark):
    def get(t, r):
        x = one(spark, claims.resource_claim(F.col("t"), r), t=t)
        return x.value, x.kind

    t = "白蠟約 1831、愛心近130、紅蠟12；季蠟89"
    assert [get(t, r) for r in claims.RESOURCE_WORDS] == [(1831, "approximate"), (130, "approximate"), (12, "exact"), (89, "exact")]
    assert get("白蠟1000以上、愛心200+", "white_candles") == (None, None) == get("白蠟1000以上、愛心200+", "hearts")


def test_ownership_and_maps(spark):
    own = lambda t: one(spark, claims.ownership_history(F.col("t")), t=t)
    assert [own("第一任"), own("第 2 手"), own("第三任"), own("自創"), own("二手"), own("x")] == ["first_owner", "second_owner", "multiple_owners", "first_owner", "second_owner", "unknown"]
    assert one(spark, claims.map_completion(F.col("t")), t="全圖畢、全二級斗").asDict() == {"standard_maps": "complete", "second_tier_capes": "complete"}


def test_merged_claims(spark):
    merged = lambda a, b: one(spark, claims.merged((F.col("a"), "listing"), (F.col("b"), "summary"), unknown="unknown"), a=a, b=b)
    assert merged("x", "x").value == "x" and merged("x", "x").sources == ["listing", "summary"]
    assert (merged("x", "y").value, merged("x", "y").evidence_state) == ("unknown", "conflict")
    assert merged("unknown", None).evidence_state == "unknown" and merged("unknown", "y").value == "y"


def test_price_words(spark):
    urgent = lambda p, t: one(spark, prices.urgent_override(F.col("p"), F.col("t")), p=p, t=t)
    assert urgent("asking", "急售 100") == "urgent_sale" and urgent("sold_explicit", "急售後已售") == "sold_claim" and urgent("asking", "不急售") == "normal_listing"
    assert all(urgent("asking", t) == "normal_listing" for t in ("不是急售", "非急出", "不 急售", "並非急出")) and urgent("asking", "沒有急售") == "urgent_sale" and urgent("asking", "不急售，急出") == "urgent_sale"
    review = lambda t: one(spark, prices.price_semantic_review(F.col("t"), F.lit("asking")), t=t)
    assert review("標價 56000 台幣；最多分三期，超過一期加 500；").multi_price and review("可分三期付款") is None
    assert review("即付不含勳章7.0萬、含勳章7.2萬，分期7.3至7.5萬").reason_codes == ["multiple_price_terms", "badge_inclusion_price_variants", "installment_price_variants"]
    line = lambda p: one(spark, prices.training_line(F.col("p")), p=p)
    assert [line(p) for p in ("asking", " Reduced ", "verified_sale", "buyout", None)] == ["normal_listing", "urgent_sale", "verified_sale", "unknown", "unknown"]
    kind = lambda p, v, d: one(spark, prices.estimator_price_type(F.col("p"), F.col("v"), F.col("d")), p=p, v=v, d=d)
    assert kind("sold_explicit", False, 1.0) == "last_public_price" and kind("asking", True, 1.0) == "verified_sale"


def test_normalisers_differ(spark):
    assert one(spark, text.lower_alnum(F.col("t")), t="Ab_ c-1") == "abc1" and one(spark, text.nfkc_word(F.col("t")), t="Ａb_ c") == "ab_c"
    assert one(spark, text.fold_alnum(F.col("t")), t="Straße!") == "strasse" and one(spark, text.strip_fold(F.col("t")), t=" Ab c ") == "ab c"
    assert one(spark, text.ascii_alnum(F.col("t")), t="é-A1") == "a1" and one(spark, text.is_cjk_key(F.col("t")), t="九色鹿")
    assert one(spark, text.safe_date(F.col("t")), t="2025-02-30") is None


# matching and states


def test_overlaps_and_negation():
    assert [m[2] for m in matching.Matcher(["九色鹿角", "鹿角"]).find("只有九色鹿角")] == ["九色鹿角"]
    keys = ["abc", "bcde"]
    assert [m[2] for m in matching.Matcher(keys).find("abcde")] == ["bcde"]
    assert [m[2] for m in matching.Matcher(keys, matching.LEFTMOST_LONGEST).find("abcde")] == ["abc"]
    assert matching.Matcher(["測斗"]).find("沒有測斗")[0][3] and not matching.Matcher(["測斗"]).find("有測斗")[0][3]


def test_text_states():
    catalog = {"a": {"eligible": True, "tokens": ["測斗"]}, "b": {"eligible": False, "tokens": []}}
    names = {"測斗": "a", "測面": "b"}
    said = lambda *t, **k: matching.text_states(list(t), catalog, names, **k)
    both = said(("listing", "有測斗與測面"))
    assert both["a"]["state"] == both["b"]["state"] == "owned" and both["a"]["model_feature"] and not both["b"]["model_feature"]
    clash = said(("listing", "含測斗"), ("summary", "沒有測斗"))["a"]
    assert clash["state"] == "unknown" and clash["conflict"] and clash["sources"] == ["listing", "summary"]
    assert said(("listing", "無"))["a"]["state"] == "unknown" and said(("listing", "有測斗"), seller=False)["a"] == {
        "state": "unknown", "conflict": False, "aliases": [], "sources": [], "model_feature": False}


def test_set_completion(spark):
    members = spark.createDataFrame([("s", "a"), ("s", "b")], "set_id string, item_id string")

    def done(a, b):
        states = spark.createDataFrame([("x", "a", a), ("x", "b", b)], "account string, item_id string, state string")
        r = matching.set_completion(states, "account", members).first()
        return r.ratio, r.complete

    assert done("owned", "unknown") == (None, None) and done("owned", "confirmed_missing") == (0.5, False) and done("owned", "owned") == (1.0, True)


# similarity and the estimator


def test_weights_and_unknowns(spark):
    assert sum(similarity.WEIGHTS.values()) == 100
    level = lambda a, b: one(spark, similarity.level_similarity(F.col("a"), F.col("b")), a=a, b=b)
    assert level("unknown", "unknown") == 0 and level("low", "high") == 0.5 and level("x", "x") == 1 and level(None, "low") == 0


PROFILE = """account_id string, comparable_id string, input_ordinal int, base_account_type string, currency string, server string, currency_verified boolean, server_verified boolean, offer_kind string,
entity_kind string, price_type string, valuation_date date, post_date date, source_listing_ids array<string>, duplicate_cluster_id string, authorized boolean, selected_price_twd double,
price_semantic_review struct<review_status:string,brokerage_included:boolean,multi_price:boolean>, seasons map<string,string>, earliest_season_id string, owned_item_ids array<string>,
complete_set_ids array<string>, mentioned_set_ids array<string>, map_completion_ratio double, map_completion map<string,string>, collection_ids array<string>,
resources struct<white_candles:double,hearts:double,red_candles:double,season_candles:double>, resource_level string, bindings map<string,string>, binding_state string, ownership_generation string, evidence_quality string"""


def profile(i, price=None, **more):
    base = dict(zip([p.split(" ")[0] for p in PROFILE.replace("\n", " ").split(", ")], [None] * 40))
    base |= {"account_id": f"account_{i}", "comparable_id": f"c{i}", "input_ordinal": i, "base_account_type": "winged", "currency": "TWD", "server": "international", "currency_verified": True,
             "server_verified": True, "offer_kind": "seller_listing", "entity_kind": "single_account", "price_type": "normal_listing", "valuation_date": date(2026, 8, 1), "post_date": date(2026, 7, 1),
             "source_listing_ids": [f"l{i}"], "duplicate_cluster_id": "unknown", "authorized": True, "selected_price_twd": price, "seasons": {"s1": "complete", "s2": "partial"}, "owned_item_ids": ["a", "b"],
             "complete_set_ids": ["x"], "mentioned_set_ids": [], "map_completion_ratio": 0.9, "collection_ids": ["q"], "resources": (1000.0, 100.0, 10.0, None), "bindings": {"google": "available"},
             "ownership_generation": "first_owner", "evidence_quality": "high"}
    return tuple((base | more).values())


def test_estimator(spark):
    target = spark.createDataFrame([profile(0)], PROFILE)
    rows = [profile(1, 9000.0), profile(2, 7000.0), profile(3, 8000.0), profile(4, 5000.0, server="china")]
    estimates, ledger = estimator.estimate(target, spark.createDataFrame(rows, PROFILE))
    got = estimates.first()
    assert (got.status, got.low, got.median, got.high, got.comparables) == ("estimated", 7000.0, 8000.0, 9000.0, 3)
    said = {r.comparable_id: r.codes for r in ledger.collect()}
    assert said["c4"] == ["server_mismatch"] and set(said) == {"c1", "c2", "c3", "c4"} and said["c1"] == []
    few, _ = estimator.estimate(target, spark.createDataFrame(rows[:2], PROFILE))
    assert few.first().status == "insufficient_comparables" and few.first().median is None
    none, _ = estimator.estimate(target, spark.createDataFrame([profile(i, 1.0, authorized=None) for i in range(1, 5)], PROFILE))
    assert none.first().comparables == 0


# joins, provenance, sources


def test_nearest_date_both_ways(spark):
    left = spark.createDataFrame([(1, "k", date(2025, 1, 10)), (2, "k", date(2025, 1, 1)), (3, "other", date(2025, 1, 1))], "id int, k string, d date")
    right = spark.createDataFrame([(7, "k", date(2025, 1, 8)), (5, "k", date(2025, 1, 12)), (9, "k", date(2025, 1, 2))], "rid int, k string, rd date")
    got = {r.id: (r.nearest_id, r.gap_days) for r in relate.nearest_date(left, "d", right, "rd", "rid", "k").collect()}
    assert got == {1: (5, 2), 2: (9, 1), 3: (None, None)}


def test_evidence_replay(spark):
    snapshot = json.dumps({"a": [{"b": 1}]}).encode()
    row = {"claim_locator": "/a/0/b", "claim_value": 1, "claim_hash": digests.canonical_digest(1), "source_snapshot_sha256": hashlib.sha256(snapshot).hexdigest()}
    assert provenance.replay(row, snapshot) == []
    assert provenance.replay(row, snapshot + b" ") == ["snapshot_digest_mismatch"]
    assert provenance.replay(row | {"claim_value": True}, snapshot)[0] == "claim_value_mismatch"
    assert provenance.replay(row | {"claim_locator": "/a/1"}, snapshot) == ["claim_locator_unresolved"]


def test_authorization_enters_as_data(spark):
    rows = spark.createDataFrame([("d", "h1", "a", "o", "l", 5.0), ("d", "h2", "a", "o", "l", None)], "dataset_id string, history_id string, account_id string, observation_id string, price_line string, price double")
    assert provenance.authorize(rows, rows.where("history_id = 'h2'"), facts=("price",)).where("authorized").count() == 1
    assert provenance.authorize(rows, rows.limit(0)).where("authorized").count() == 0


def test_pointer_and_merkle():
    assert digests.pointer_path("/a~1b/0") == "$['a/b'][0]" and digests.resolve_pointer({"a/b": [3]}, "/a~1b/0") == 3
    leaves = [hashlib.sha256(bytes([i])).hexdigest() for i in range(5)]
    assert digests.merkle_root(leaves) == digests.merkle_root(leaves[::-1])


def test_json_schema():
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "exclusiveMinimum": 0}, "b": {"type": "array", "maxItems": 1, "uniqueItems": True}},
              "additionalProperties": False, "if": {"properties": {"a": {"const": 2}}}, "then": {"required": ["b"]}}
    assert audit.schema_errors({"a": 1}, schema) == [] and audit.schema_errors({"a": True}, schema) == ["$.a: type"]
    assert audit.schema_errors({"a": 0}, schema) == ["$.a: exclusiveMinimum"] and audit.schema_errors({"a": 2}, schema) == ["$: required b"]
    assert audit.schema_errors({"a": 1, "b": [1, 2], "c": 0}, schema) == ["$.b: maxItems", "$.c: false"]


def test_jsonl_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('﻿{"a": 1}\n\n{"a": 2}\n')
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("a", LongType())])
    assert sorted(r.a for r in readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema).collect()) == [1, 2]
    assert readers.read_jsonl(spark, str(tmp_path / "none.jsonl"), schema, missing_ok=True).count() == 0
    (tmp_path / "b.jsonl").write_text("[1]\n")
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path / "b.jsonl"), schema).collect()
    lines = [r.value for r in sinks.json_lines(spark.createDataFrame([(2, None), (1, "x")], "b int, a string"), ["b"]).collect()]
    assert lines == ['{"a":"x","b":1}', '{"a":null,"b":2}']
    digest = sinks.append_records(tmp_path / "c.jsonl", [{"id": 1}], hashlib.sha256(b"").hexdigest(), "id")
    with pytest.raises(ValueError):
        sinks.append_records(tmp_path / "c.jsonl", [{"id": 2}], "0" * 64, "id")
    with pytest.raises(ValueError):
        sinks.append_records(tmp_path / "c.jsonl", [{"id": 1}], digest, "id")
    assert (tmp_path / "c.jsonl").read_bytes() == b'{"id":1}\n'
    for bad in ("../x", "/x", "a\\b", "C:x"):
        with pytest.raises(ValueError):
            readers.safe_relative(bad)


def test_wikitext(spark):
    page = "==A==\n{{Item|x}}\n{{Item|y}}\n==B==\n{{Item|z}}\n"
    rows = readers.wikitext_records(spark.createDataFrame([(1, page)], "p int, t string"), "p", "t", "Item").collect()
    assert sorted((r.section, r.ordinal, r.body) for r in rows) == [("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z")]


# models


def test_elastic_net_matches_coordinate_descent(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    y = x @ [2.0, -1.0, 0.0] + 5 + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    model = modelling.ElasticNet(["a", "b", "c"], "y").fit(df, 0.3, 0.5)
    z, w = (x - x.mean(0)) / x.std(0), np.zeros(3)
    for _ in range(500):
        for j in range(3):
            rho = z[:, j] @ (y - y.mean() - z @ w + z[:, j] * w[j]) / 200
            w[j] = np.sign(rho) * max(abs(rho) - 0.15, 0) / (1 + 0.15)
    assert np.allclose([c["coefficient"] for c in model["columns"][:3]], w, atol=1e-6)
    said = df.select(modelling.portable_score(df, model).alias("s")).toPandas()["s"]
    assert np.allclose(said, z @ w + y.mean())


def test_bootstrap_and_ensemble(spark):
    rows = spark.createDataFrame([("k", float(i % 10)) for i in range(500)], "k string, v double")
    a, b = modelling.bootstrap_ci(rows, ["k"], "v").first(), modelling.bootstrap_ci(rows.repartition(7), ["k"], "v").first()
    assert a == b and a.low < a.mean < a.high and a.n == 500
    p = spark.createDataFrame([("r", 2.0, 0.5), ("r", 4.0, 0.0), ("q", 1.0, None)], "id string, log_price double, mae double")
    got = {r.id: r for r in modelling.ensemble(p, "id").collect()}
    assert abs(got["r"].price - np.exp(2)) < 1e-9 and got["q"].status == "insufficient_training_data" and got["q"].price is None


def test_streams(spark, tmp_path):
    from evidar.streaming.ledger import latest_by_cluster

    spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, t int").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t int").parquet(str(tmp_path / "in"))
    q = latest_by_cluster(stream, ["k"], ["t"]).writeStream.format("memory").queryName("latest_rows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.k, r.latest.t, r.seen) for r in spark.table("latest_rows").collect()) == [("a", 3, 2), ("b", 2, 1)]
