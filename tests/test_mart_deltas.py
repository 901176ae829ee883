"""Signed deltas against a mart that is built anew after every change."""

import random

import pytest

from bayline.plans import mart_deltas as md

SCHEMA = "ro_number string, service_date date, dealer_key int, total_amount decimal(18,2), satisfaction_score int"


def orders(spark, state):
    rows = [(k, *v) for k, v in state.items()]
    return spark.createDataFrame(rows, "ro_number string, day string, dealer_key int, amount string, score int").selectExpr(
        "ro_number", "cast(day as date) service_date", "dealer_key", "cast(amount as decimal(18,2)) total_amount",
        "score satisfaction_score")


def whole(spark, state):
    return sorted(map(str, md.signed_sums(orders(spark, state), 1).selectExpr(
        "month", "dealer_key", "ro_count", "cast(total_revenue as decimal(28,2)) total_revenue", "score_sum",
        "score_count").collect()))


def got(spark, mart):
    return sorted(map(str, mart.read(spark).collect()))


def value(rng):
    return (f"2024-0{rng.randint(1, 3)}-1{rng.randint(0, 9)}", rng.randint(1, 3), f"{rng.randint(0, 9999)}.{rng.randint(10, 99)}",
            rng.choice([None, 1, 3, 5]))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_changes_equals_a_rebuild(spark, tmp_path, seed):
    rng, mart = random.Random(seed), md.DeltaMart(str(tmp_path / "mart"))
    mart.create(spark)
    state = {f"R{i}": value(rng) for i in range(30)}
    mart.apply(None, orders(spark, state), 1)
    assert got(spark, mart) == whole(spark, state)
    for load in range(2, 6):
        after = {k: value(rng) if rng.random() < 0.3 else v for k, v in state.items() if rng.random() > 0.2}
        after |= {f"N{load}-{i}": value(rng) for i in range(3)}
        was, now = md.changes(orders(spark, state), orders(spark, after))
        mart.apply(was, now, load)
        mart.apply(was, now, load)  # a replay
        state = after
        assert got(spark, mart) == whole(spark, state)
        if load == 4:
            mart.compact(spark)
            assert got(spark, mart) == whole(spark, state)


def test_a_key_without_orders_leaves(spark, tmp_path):
    mart = md.DeltaMart(str(tmp_path / "mart"))
    mart.create(spark)
    one = {"R1": ("2024-01-05", 7, "10.00", 4)}
    moved = {"R1": ("2024-02-05", 7, "10.00", 4)}
    mart.apply(None, orders(spark, one), 1)
    mart.apply(orders(spark, one), orders(spark, moved), 2)
    assert got(spark, mart) == whole(spark, moved) and len(got(spark, mart)) == 1
    mart.apply(orders(spark, moved), None, 3)
    assert got(spark, mart) == []
    with pytest.raises(ValueError):
        mart.apply(None, None, 4)
