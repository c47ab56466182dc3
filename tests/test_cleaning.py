"""Cleaning of market observations against known cases."""

import pytest
from pyspark.sql import functions as F

from evidar.operators.cleaning import clean_market

SCHEMA = """history_id string, account_id string, selected_price_twd double, price_type string, currency string, currency_verified boolean, server string, server_verified boolean,
offer_kind string, entity_kind string, base_account struct<account_type:string>, post_date string, observed_at string, mixed_price boolean,
price_semantic_review struct<brokerage_included:boolean,multi_price:boolean>"""
GOOD = {"history_id": "history_0001", "account_id": "account_0001", "selected_price_twd": 1000.0, "price_type": "asking", "currency": "TWD", "currency_verified": True, "server": "international",
        "server_verified": True, "offer_kind": "seller_listing", "entity_kind": "single_account", "base_account": ("winged",), "post_date": "2026-08-01", "observed_at": "2026-08-01",
        "mixed_price": False, "price_semantic_review": None}


def cleaned(spark, rows, authorized=True, **how):
    df = spark.createDataFrame([tuple((GOOD | r)[k] for k in GOOD) for r in rows], SCHEMA)
    out = clean_market(df, F.lit(True) if authorized else None, **how)
    return {r.history_id: r for r in out.collect()}


@pytest.mark.parametrize("fault, code", [
    ({"currency_verified": False}, "currency_unverified"), ({"currency": "USD"}, "currency_not_twd"), ({"server_verified": False}, "server_unverified"),
    ({"server": "china"}, "server_not_international"), ({"offer_kind": "buyer"}, "not_seller_listing"), ({"entity_kind": "bundle"}, "not_single_account"),
    ({"selected_price_twd": 0.0}, "invalid_price"), ({"selected_price_twd": None}, "invalid_price"), ({"selected_price_twd": float("inf")}, "invalid_price"),
    ({"price_type": "buyout"}, "price_type_not_training_line"), ({"mixed_price": True}, "mixed_price"), ({"currency": None}, "currency_not_twd"),
    ({"price_type": "verified_sale"}, "verified_sale_requires_separate_pool")])
def test_single_fault(spark, fault, code):
    row = cleaned(spark, [fault])["history_0001"]
    assert row.reason_codes == [code] and row.disposition == "excluded"


def test_without_authorization_nothing_is_kept(spark):
    row = cleaned(spark, [{}], authorized=False)["history_0001"]
    assert row.reason_codes == ["market_data_external_authorization_evaluator_required"]


def test_cluster_keeps_the_latest_of_each_line(spark):
    out = cleaned(spark, [{}, {"history_id": "history_0002", "post_date": "2026-08-02"}, {"history_id": "history_0003", "price_type": "reduced"}])
    assert out["history_0002"].disposition == "kept" and out["history_0003"].price_line == "urgent_sale" and out["history_0003"].disposition == "kept"
    assert out["history_0001"].reason_codes == ["cluster_rank_2", "duplicate_account_cluster"]


def test_brokerage_needs_review(spark):
    row = cleaned(spark, [{"price_type": "reduced", "price_semantic_review": (True, False)}])["history_0001"]
    assert row.disposition == "needs_review" and row.reason_codes == ["brokerage_included_price"]


@pytest.mark.parametrize("n, code, disposition", [(8, "log_price_outlier_insufficient_group", "needs_review"), (10, "log_price_modified_z_outlier", "excluded")])
def test_outlier_needs_a_group_of_ten(spark, n, code, disposition):
    rows = [{"history_id": f"history_{i:04}", "account_id": f"account_{i:04}", "selected_price_twd": 1000.0 + 10 * i} for i in range(1, n + 1)]
    out = cleaned(spark, [*rows, {"history_id": "history_9999", "account_id": "account_9999", "selected_price_twd": 1e6}])
    assert out["history_9999"].reason_codes == [code] and out["history_9999"].disposition == disposition
    assert sum(r.disposition == "kept" for r in out.values()) == n
