"""Targets and comparables of a market against plain Python."""

from pyspark.sql import functions as F

from evidar.functions.gates import joined_codes, reason_codes
from evidar.operators import estimator


def test_a_market_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(estimator, "BLOCK", 8)
    monkeypatch.setattr(estimator, "PAIRS_A_TASK", 64)
    rows = [(i, None if i % 50 == 7 else "wide" if i < 240 else "narrow") for i in range(300)]
    own = spark.createDataFrame(rows, "id long, market string")
    targets = own.where("id % 6 = 0").select(F.col("id").alias("t_id"), F.col("market").alias("t_market"))
    pairs = estimator.market_pairs(targets, own, ("t_market", "market"), ("t_id", "id"))
    assert pairs.columns == ["t_id", "t_market", "id", "market"]
    found = pairs.select("t_id", "id", "market", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.t_id, r.id) for r in found) == sorted((a, b) for a, m in rows if a % 6 == 0 for b, n in rows if m is not None and m == n)
    wide = [r.task for r in found if r.market == "wide"]
    assert len(set(wide)) > 20 and max(map(wide.count, set(wide))) < len(wide) / 4
    assert estimator.market_pairs(targets.limit(0), own, ("t_market", "market"), ("t_id", "id")).count() == 0


def test_joined_codes_are_the_codes(spark):
    rows = spark.createDataFrame([(1, 2), (None, 2), (3, None), (5, 5), (2, 1)], "a int, b int")
    gates = [("less", F.col("a") < F.col("b")), ("odd", F.col("a") % 2 == 1), ("same", F.col("a") == F.col("b"))]
    got = rows.select(joined_codes(gates).alias("x"), F.array_join(reason_codes(gates), ",").alias("y")).collect()
    assert [r.x for r in got] == [r.y for r in got] == ["less,odd", "less,odd,same", "less,odd,same", "odd,same", ""]


def test_overlaps_of_a_market_stand_beside_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(estimator, "BLOCK", 4)
    market = {i: "ab"[i % 2] for i in range(40)}
    sets = {i: {j for j in range(12) if (i * 7 + j * j) % 5 < 2} for i in range(36)}  # the last four have none
    own = spark.createDataFrame(list(market.items()), "id long, market string")
    given = spark.createDataFrame([(i, j, market[i]) for i, s in sets.items() for j in s], "owner long, item long, market string")
    overlaps = estimator.market_overlaps(given, F.col("owner") % 4 == 0, "owner", "item", "market")
    targets = own.where("id % 4 = 0").select(F.col("id").alias("t_id"), F.col("market").alias("t_market"))
    pairs = estimator.market_pairs(targets, own, ("t_market", "market"), ("t_id", "id"), overlaps).where("t_id <> id")
    assert pairs.columns == ["t_id", "t_market", "id", "market", "jaccard"]
    share = lambda a, b: len(a & b) / len(a | b) if a & b else 0.0
    assert {(r.t_id, r.id): r.jaccard for r in pairs.collect()} == {
        (a, b): share(sets.get(a, set()), sets.get(b, set())) for a in market if a % 4 == 0 for b in market if a != b and market[a] == market[b]}


def test_no_pair_is_shuffled(spark):
    """The plan of the weighted pairs joins them with nothing more once they are made."""
    from evidar.plans import match_queries

    plan = match_queries.weighted_similarity(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    lines = [x.lstrip(" :+-") for x in plan.splitlines()]
    assert [x for x in lines if x.startswith("Join")][0].startswith("Join Inner") and sum(x.startswith("RepartitionByExpression") for x in lines) == 2
    above = lines[: next(i for i, x in enumerate(lines) if x.startswith("Join"))]
    assert all(x.startswith("Project") for x in above)


def test_a_total_that_can_be_enough_is_never_left_out(spark):
    from evidar.functions import similarity as sim

    rows = spark.createDataFrame([(k / 100000, 0.39999 + k / 10000000) for k in range(2000)], "a double, b double")
    dimensions, weights = {"a": F.col("a"), "b": F.col("b")}, {"a": 30, "b": 70}
    scored = rows.select(sim.total(sim.weighted(dimensions, weights)).alias("score"), sim.may_total(dimensions, weights, 28.3).alias("may"))
    assert scored.where("score >= 28.3 and not may").count() == 0 and scored.where("score >= 28.3").count() > 0 and scored.where("not may").count() > 0


def test_whole_values_are_not_rounded_anew(spark):
    from evidar.functions import similarity as sim

    rows = spark.createDataFrame([(0.0,), (1.0,), (-0.0,), (0.123455,), (0.00000499,), (float("nan"),), (None,), (1 / 3,)], "a double")
    got = rows.select(sim.weighted({"a": F.col("a")}, {"a": 30})["a"].alias("x"), F.bround(F.col("a") * 30.0, 4).alias("y"))
    assert got.where("x is distinct from y").count() == 0
    plan = rows.select(sim.weighted({"a": F.col("a")}, {"a": 30})["a"])._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in plan.lower()


def test_descriptions_as_strings_are_those_of_arrays(spark):
    """Explanations of many pairs make no arrays."""
    from evidar.functions import similarity as sim
    from evidar.plans import match_queries

    rows = spark.createDataFrame([(a / 4, b / 4) for a in range(5) for b in range(5)] + [(None, 0.9)], "a double, b double")
    parts, flags, weights = {"a": F.col("a") * 30, "b": F.col("b") * 70}, {"a": F.lit(True), "b": F.col("a") > 0.3}, {"a": 30, "b": 70}
    arrays, strings = sim.describe(parts, flags, weights, ("a",)), sim.describe(parts, flags, weights, ("a",), ",")
    got = rows.select(*[F.array_join(v, ",").alias(f"{k}_x") for k, v in arrays.items()], *[v.alias(f"{k}_y") for k, v in strings.items()]).collect()
    assert all(r[f"{k}_x"] == r[f"{k}_y"] for r in got for k in arrays) and len({tuple(r) for r in got}) > 6
    plan = match_queries.explain_dims(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "concat_ws" in plan
