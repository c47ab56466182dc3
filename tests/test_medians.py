"""Exact medians of many columns in few passes against Spark's own."""

import pytest
from pyspark.sql import functions as F

from evidar.operators import modelling, selection


@pytest.mark.parametrize("accuracy", [10_000, 200])
def test_medians_are_those_of_spark(spark, monkeypatch, accuracy):
    monkeypatch.setattr(selection, "COARSE", accuracy)
    rows = spark.range(9001).select(
        F.col("id"), (F.rand(3) * 100 - 50).alias("real"), (F.col("id") % 7).alias("few"), F.when(F.col("id") % 3 > 0, F.sin("id")).alias("some"), F.when(F.col("id") < 2, F.col("id") * 1.5).alias("two"),
        F.when(F.col("id") < 0, 1.0).alias("none"), F.lit(4.25).alias("one"), F.when(F.col("id") % 5 > 1, float("nan")).otherwise(F.col("id")).cast("double").alias("gaps")).repartition(5).cache()
    names = rows.columns[1:]
    values = {n: F.col(n) for n in names} | {f"{n}|{k}": F.when(F.col("id") % 3 != k, F.col(n)) for n in names for k in range(3)}
    want = rows.agg(*[F.median(v.cast("double")).alias(k) for k, v in values.items()]).first()
    got = selection.medians(rows, values)
    assert {k: repr(v) for k, v in got.items()} == {k: repr(want[k]) for k in values}
    assert selection.medians(rows.limit(0), values) == dict.fromkeys(values)


def test_cross_validation_keeps_no_list_of_values(spark, monkeypatch):
    """No buffer of a task grows with the distinct values."""
    def refused(*_):
        raise AssertionError("holds every distinct value of a column")

    monkeypatch.setattr(modelling.F, "median", refused)
    rows = spark.range(300).select((F.col("id") % 60).alias("g"), F.sin("id").alias("a"), (F.sin("id") * 2 + F.rand(1) / 10).alias("y"))
    found = modelling.nested_cv(rows, modelling.ElasticNet(["a"], "y"), "g", 3)
    assert found["rows"] == 300 and found["beats_baseline"]
