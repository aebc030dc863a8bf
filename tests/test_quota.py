from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.operators import quota as q


@given(st.integers(0, 500), st.lists(st.integers(0, 20), min_size=1, max_size=5).filter(any))
@settings(max_examples=150, deadline=None)
def test_quota_is_exact_and_fair(n, weights):
    w = {str(i): x for i, x in enumerate(weights)}
    got = q.quota(n, w)
    assert sum(got.values()) == n
    for k, x in w.items():
        assert abs(got[k] - Fraction(n * x, sum(weights))) < 1


def test_exact_decimals_and_ties():
    assert q.quota(100, {"a": Decimal("0.29"), "b": Decimal("0.71")}) == {"a": 29, "b": 71}
    assert q.quota(7, {"a": Decimal("0.4"), "b": Decimal("0.3"), "c": Decimal("0.3")}) == {"a": 3, "b": 2, "c": 2}
    assert q.quota(1, {"a": 0, "b": 1, "c": 1}) == {"a": 0, "b": 1, "c": 0}
    assert q.quota(0, {"a": 1}) == {"a": 0}


def test_two_way_margins_for_many_counts():
    modes, tones = {"t": 4, "p": 3, "o": 3}, {"n": 4, "g": 2, "s": 4}
    for n in range(1, 101):
        rows, cols = q.quota(n, modes), q.quota(n, tones)
        table = q.two_way(rows, cols, str(n))
        assert {r: sum(v.values()) for r, v in table.items()} == rows
        assert {c: sum(v[c] for v in table.values()) for c in cols} == cols
        assert all(x >= 0 for v in table.values() for x in v.values())


@pytest.mark.parametrize("bad", [{"a": -0.1, "b": 1.1}, {"a": True, "b": 0}, {"a": "0.4", "b": 0.6}, {"a": None, "b": 1}, {"a": float("nan"), "b": 1}, {"a": 0.4, "b": 0.5}, {"a": 1.0}, {"a": 0.5, "b": 0.5, "c": 0}])
def test_bad_weights(bad):
    with pytest.raises(ValueError):
        q.checked_weights(bad, ("a", "b"))


def test_sample_product_sparse_and_dense(spark):
    for n, sizes in ((50, [40, 30, 20]), (90, [10, 10]), (100, [10, 10]), (1, [1]), (0, [3])):
        rows = q.sample_product(spark, n, sizes, "x").collect()
        cells = {tuple(r[f"i{i}"] for i in range(len(sizes))) for r in rows}
        assert len(rows) == len(cells) == n
        assert sorted(r.draw for r in rows) == list(range(1, n + 1))
        assert all(0 <= r[f"i{i}"] < s for r in rows for i, s in enumerate(sizes))
    with pytest.raises(ValueError):
        q.sample_product(spark, 5, [2, 2], "x")


def test_override_and_numbers(spark):
    assert q.override({"a": Decimal(1), "b": Decimal(0)}, "b") == {"a": 0, "b": 1}
    with pytest.raises(ValueError):
        q.override({"a": Decimal(1)}, "z")
    ids = spark.createDataFrame([("dialogue_00009",), ("dialogue_100000",), ("x_7",), (None,)], "dialogue_id string")
    assert q.next_number(ids).first() == (100001, "dialogue_100001")
    assert q.next_number(ids.where("false")).first() == (1, "dialogue_00001")


def test_random_rank_is_a_permutation_with_hot_groups(spark):
    from dialoom.operators.ranks import random_rank

    df = spark.range(3000).selectExpr("id", "CASE WHEN id < 2500 THEN 'hot' WHEN id < 2990 THEN 'mild' END AS g", "1 AS rank")
    rows = random_rank(df, ["g"], ["id"], "s").collect()
    for g in ("hot", "mild", None):
        own = sorted(r.rank for r in rows if r.g == g)
        assert own == list(range(1, len(own) + 1))
    assert sorted(r.id for r in rows) == list(range(3000))
