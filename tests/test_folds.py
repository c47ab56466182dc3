"""Greedy grouped folds against the list version."""

import random

import pytest

from evidar.operators import splits


def plain(sizes, folds):
    loads = [0] * folds
    for n in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += n
    return loads


@pytest.mark.parametrize("folds", [1, 2, 3, 7])
def test_quotas_are_those_of_dealing_one_by_one(folds):
    rng = random.Random(folds)
    for _ in range(300):
        loads, size, count = [rng.randint(0, 30) for _ in range(folds)], rng.randint(1, 9), rng.randint(0, 40)
        want, filled = [0] * folds, list(loads)
        for _ in range(count):
            k = filled.index(min(filled))
            want[k] += 1
            filled[k] += size
        assert splits._quotas(loads, size, count) == want


@pytest.mark.parametrize("folds", [1, 3, 5])
def test_folds_of_random_groups(spark, folds):
    rng = random.Random(1)
    sizes = [rng.choice([1, 1, 1, 2, 3, 5, 40]) for _ in range(80)] + [300]
    rows = [(None if g == 3 else f"g{g}", i) for g, n in enumerate(sizes) for i in range(n)]
    got = splits.greedy_folds(spark.createDataFrame(rows, "group string, i long"), "group", folds).collect()
    by = {}
    for r in got:
        by.setdefault(r.group, set()).add(r.fold)
    loads = [sum(r.fold == k for r in got) for k in range(folds)]
    assert len(got) == len(rows) and all(len(f) == 1 for f in by.values()) and loads == plain(sizes, folds)
    assert splits.greedy_folds(spark.createDataFrame([], "group string, i long"), "group", folds).count() == 0
