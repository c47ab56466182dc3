"""The sparse elastic net against a dense fit in numpy, and joined scoring against row-by-row rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidar.operators import sparse_net


def data(n=140, seed=3):
    rng = np.random.default_rng(seed)
    rows, features = [], []
    for i in range(n):
        a, b, colour, size = rng.normal(5, 2), rng.normal(0, 1), str(rng.choice(["red", "blue", "green"])), str(rng.choice(["s", "m"]))
        y = 1 + 0.5 * a - 0.7 * b + (0.8 if colour == "red" else 0) + rng.normal(0, 0.2)
        rows.append((i, float(y)))
        features.append((i, "g.a", repr(float(a))))
        features += [(i, "g.b", f"{b:.6e}")] * (rng.random() < 0.7) + [(i, "k.colour", colour)] * (rng.random() < 0.8) + [(i, "k.size", size), (i, "k.size2", "unknown"), (i, "same", "1")]
    return rows, features


def dense(rows, features):
    """Columns, matrix and target as a dense preparation gives them: numbers standardised with indicators, one-hot categories as they are."""
    by = {}
    for i, f, v in features:
        if v != "unknown":
            by.setdefault(f, {})[i] = v
    ids, y = [r[0] for r in rows], np.array([r[1] for r in rows])
    names, columns = [], []
    for f in ("g.a", "g.b", "same"):
        x = np.array([float(by[f].get(i, "nan")) for i in ids])
        missing = np.isnan(x)
        names += [f"n:{f}", f"m:{f}"]
        columns += [np.where(missing, np.nanmedian(x), x), missing.astype(float)]
    for f in ("k.colour", "k.size"):
        said = [by[f].get(i, sparse_net.ABSENT) for i in ids]
        for v in sorted(set(said)):
            names.append(f"c:{f}={v}")
            columns.append(np.array([float(s == v) for s in said]))
    x = np.array(columns).T
    mean, scale = x.mean(0), np.where([n.startswith("c:") for n in names], 1.0, x.std(0))
    use = x.std(0) > 1e-12
    return [n for n, u in zip(names, use) if u], ((x - mean) / np.where(scale > 0, scale, 1))[:, use], y, mean[use], scale[use]


def plain_fit(x, y, alpha, l1):
    w = np.zeros(x.shape[1])
    centred = y - y.mean()
    for _ in range(20_000):
        before = w.copy()
        for j in range(len(w)):
            rho = x[:, j] @ (centred - x @ w + x[:, j] * w[j]) / len(y)
            w[j] = math.copysign(max(abs(rho) - alpha * l1, 0), rho) / (x[:, j] @ x[:, j] / len(y) + alpha * (1 - l1))
        if np.abs(w - before).max() < 1e-12:
            return w


@pytest.fixture(scope="module")
def frames(spark):
    rows, features = data()
    return spark.createDataFrame([*rows, (999, None)], "id long, y double"), spark.createDataFrame([*features, (999, "g.a", "1e9"), (5, "nothing", None)], "id long, feature string, value string")


@pytest.mark.parametrize("alpha, l1, at_once", [(0.01, 0.5, 1 << 20), (0.1, 0.9, 1 << 20), (0.3, 0.5, 0)])
def test_coefficients_equal_a_dense_fit(frames, monkeypatch, alpha, l1, at_once):
    if not at_once:
        monkeypatch.setattr(sparse_net, "TOLERANCE", 1e-4)  # steps over joins: few are enough to see that they lead there
    intercept, terms, about = sparse_net.fit(*frames, "id", "y", alpha, l1, at_once)
    names, x, y, mean, scale = dense(*data())
    want = plain_fit(x, y, alpha, l1)
    got = {r.column: r for r in terms.collect()}
    assert sorted(got) == sorted(names)
    near = 1e-6 if at_once else 2e-3
    assert all(math.isclose(got[n].coefficient, w, abs_tol=near) and math.isclose(got[n].mean, m, abs_tol=1e-9) and math.isclose(got[n].scale, s, abs_tol=1e-9) for n, w, m, s in zip(names, want, mean, scale))
    kinds = {r.feature: r for r in about.collect()}
    assert kinds["g.b"].numeric and kinds["g.b"].missing and not kinds["k.size"].missing and "k.size2" not in kinds and "nothing" not in kinds
    if at_once:
        scores = {r.id: r for r in sparse_net.score(*frames, "id", intercept, terms, about).collect()}
        fitted = y.mean() + x @ want
        assert all(scores[i].violation is None and math.isclose(scores[i].log_price, fitted[i], abs_tol=1e-5) for i in range(len(y)))
        assert scores[999].log_price is None and scores[999].violation == "out_of_distribution:g.a"


def test_admission_of_rows(spark, frames):
    intercept, terms, about = sparse_net.fit(*frames, "id", "y", 0.05, 0.5)
    rows = {1: [("g.a", "5"), ("k.size", "s"), ("same", "1")], 2: [("g.a", "5"), ("k.size", "xl"), ("same", "1")], 3: [("k.size", "s"), ("same", "1")], 4: [], 5: [("g.a", "odd"), ("k.size", "s"), ("same", "1")],
            6: [("g.a", "5"), ("k.colour", "pink"), ("k.size", "s"), ("same", "1"), ("g.b", "77")], 7: [("g.a", "5"), ("k.size", "unknown"), ("same", "1"), ("other", "3")]}
    given = spark.createDataFrame([(i, f, v) for i, fs in rows.items() for f, v in fs], "id long, feature string, value string")
    got = {r.id: (r.log_price is not None, r.violation) for r in sparse_net.score(spark.createDataFrame([(i,) for i in rows], "id long"), given, "id", intercept, terms, about).collect()}
    miss = "out_of_distribution:missing_unobserved:"
    assert got == {1: (True, None), 2: (False, "out_of_distribution:k.size"), 3: (False, miss + "g.a"), 4: (False, miss + "g.a"), 5: (False, miss + "g.a"), 6: (False, "out_of_distribution:g.b"), 7: (False, miss + "k.size")}


def test_empty_and_minimum(spark, frames):
    none = frames[0].limit(0)
    with pytest.raises(ValueError, match="no rows"):
        sparse_net.fit(none, frames[1], "id", "y", 0.1, 0.5)
    assert frames[1].where("value is not null").agg(sparse_net.minimum_rows(frames[1]).alias("n")).first().n == 100
    wide = spark.range(30).select(F.concat(F.lit("g"), "id", F.lit(".x")).alias("feature"))
    assert wide.agg(sparse_net.minimum_rows(wide).alias("n")).first().n == 300


def test_too_few_rows_are_not_fitted(spark):
    from evidar.operators import modelling

    rows = spark.createDataFrame([(i % 9, float(i), float(i)) for i in range(99)], "g int, x double, y double")
    found = modelling.nested_cv(rows, modelling.ElasticNet(["x"], "y"), "g", 3)
    assert found["rows"] == 99 and found["alpha"] is None
    assert modelling.nested_cv(rows, modelling.ElasticNet(["x"], "y"), "g", 3, least=50)["alpha"] is not None
