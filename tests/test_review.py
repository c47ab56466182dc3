"""Blind queues: their constraints over random cases, and small hand-made ones."""

from collections import Counter

from evidar.operators import review


def test_constraints(spark):
    people = spark.createDataFrame([(f"r{i}", f"s{i % 3}" if i else None) for i in range(7)], "reviewer string, source string")
    rows = [(i, None if i % 11 == 0 else f"s{i * i % 5}") for i in range(400)]
    cases = spark.createDataFrame(rows, "case_id long, source string")
    own, source = {r.reviewer: r.source for r in people.collect()}, dict(rows)
    queue = review.blind_queue(cases, people).collect()
    by, loads = {}, {}
    for r in queue:
        by.setdefault(r.case_id, {})[r.slot] = r.reviewer
        loads.setdefault(source[r.case_id], Counter())[r.reviewer] += 1
        assert own[r.reviewer] is None or own[r.reviewer] != source[r.case_id]
    assert len(by) == 400 and all(set(v) == {"A", "B"} and v["A"] != v["B"] for v in by.values())
    for s, counts in loads.items():
        able = [p for p, o in own.items() if o is None or o != s]
        assert max(counts[p] for p in able) - min(counts[p] for p in able) <= 2
    assert len({r.packet_id for r in queue}) == 800
    assert sorted(queue) == sorted(review.blind_queue(cases.repartition(5), people).collect())


def test_small_cases(spark):
    people = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "t")], "reviewer string, source string")
    cases = spark.createDataFrame([(1, "s"), (2, "t"), (3, "u")], "case_id long, source string")
    got = {(r.case_id, r.slot): r.reviewer for r in review.blind_queue(cases, people).collect()}
    assert got[1, "A"] is None and got[1, "B"] is None and {got[2, "A"], got[2, "B"]} == {"a", "b"} and got[3, "A"] != got[3, "B"]
    assert review.blind_queue(cases.limit(0), people).count() == 0 and review.blind_queue(cases, people.limit(0)).where("reviewer is not null").count() == 0
    decided = spark.createDataFrame([(2, "A", "a", "x"), (2, "B", "b", "y"), (3, "A", "a", "x"), (3, "B", "c", "y"), (1, "A", "c", "x")], "case_id long, slot string, reviewer string, label string")
    assert {r.case_id: r.adjudicator for r in review.conflict_queue(decided, cases, people).collect()} == {2: None, 3: "b"}
    queue = spark.createDataFrame([(2, "A", "a"), (2, "B", "b"), (3, "A", "a"), (3, "B", "b"), (1, "A", "c"), (1, "B", "c")], "case_id long, slot string, reviewer string")
    settled = spark.createDataFrame([(2, "a", "z")], "case_id long, adjudicator string, label string")
    got = {r.case_id: (r.label, r.status) for r in review.finalised(queue, decided, settled).collect()}
    assert got == {1: (None, "decision_missing"), 2: (None, "adjudicator_not_independent"), 3: (None, "reviewer_differs_from_queue")}
