"""Loads one after the other against one load of everything."""

import pytest
from pyspark.sql import functions as F, types as T

from bayline.operators import gates
from bayline.operators.registry import KeyRegistry, LoadLog
from bayline.plans import incremental, warehouse

TEXT = T.StructType([T.StructField("vin", T.StringType())])
ORDERS = ("ro_number string, dealer_id string, vin string, service_type string, open_date string, days_to_close string, "
          "labor_amount string, parts_amount string, pay_type string, repeat_repair_flag string, customer_email string, "
          "customer_phone string, arrival long")


def registry(spark, path):
    keys = KeyRegistry.at(str(path), TEXT, "vehicle_key")
    keys.create(spark)
    return keys


def rows(spark, *vins, start=0):
    return spark.createDataFrame([(v, start + i) for i, v in enumerate(vins)], "vin string, arrival long")


def numbers(keys, spark):
    return {r.vin: (r.vehicle_key, r.load) for r in keys.read(spark).collect()}


def test_old_keys_stay_and_new_ones_go_on_without_gaps(spark, tmp_path):
    keys = registry(spark, tmp_path / "keys")
    keys.extend(rows(spark, "c", "a", "c", None), "arrival", 1)
    first = numbers(keys, spark)
    assert first == {"c": (1, 1), "a": (2, 1), None: (3, 1)}
    keys.extend(rows(spark, "z", "a", None, "b", "z"), "arrival", 2)
    assert numbers(keys, spark) == {**first, "z": (4, 2), "b": (5, 2)}
    keys.extend(rows(spark, "a", "b"), "arrival", 3)
    keys.extend(rows(spark, "n"), "arrival", 4)
    assert numbers(keys, spark)["n"] == (6, 4)


def test_a_load_can_be_run_again_until_another_builds_on_it(spark, tmp_path):
    keys = registry(spark, tmp_path / "keys")
    keys.extend(rows(spark, "a", "b"), "arrival", 1)
    keys.extend(rows(spark, "wrong"), "arrival", 2)
    keys.extend(rows(spark, "b", "c"), "arrival", 2)
    assert numbers(keys, spark) == {"a": (1, 1), "b": (2, 1), "c": (3, 2)}
    for load in (1, 4, 0):
        with pytest.raises(ValueError, match="load"):
            keys.extend(rows(spark, "x"), "arrival", load)


def test_lookups_keep_rows_apart(spark, tmp_path):
    keys = registry(spark, tmp_path / "keys")
    keys.extend(rows(spark, "a", None), "arrival", 1)
    found = keys.resolve(rows(spark, "a", "a", None, "unknown")).collect()
    assert sorted((r.arrival, r.vehicle_key) for r in found if r.vehicle_key) == [(0, 1), (1, 1), (2, 2)]
    assert len(found) == 4


def test_an_empty_log_of_an_empty_load(spark, tmp_path):
    log = LoadLog(str(tmp_path / "log"), TEXT)
    log.create(spark)
    log.put(rows(spark).select("vin"), 1)
    log.put(rows(spark, "a").select("vin"), 2)
    assert log.last_load(spark) == 2 and log.read(spark, before=2).count() == 0


def order(n, arrival, vin="V1", dealer="1", service="recall", labor="10.00", email="a@x.test"):
    return (n, dealer, vin, service, "2024-01-05", "3", labor, "1.00", "customer", "0", email, "555-0001", arrival)


def delivered(spark, orders, dealers=("1", "2"), vins=("V1", "V2")):
    frame = lambda data, schema: spark.createDataFrame(data, schema)
    return warehouse.Sources(
        orders=frame(orders, ORDERS),
        dealers=frame([(d, f"D{d}", "W", "4", i) for i, d in enumerate(dealers)],
                      "dealer_id string, dealer_name string, region string, service_bays string, arrival long"),
        vehicles=frame([(v, "M", "2020", "36", "2020-01-01", i) for i, v in enumerate(vins)],
                       "vin string, model string, model_year string, warranty_months string, in_service_date string, arrival long"),
        surveys=frame([], "survey_id string, ro_number string, response struct<satisfaction:int,would_recommend:boolean,"
                          "comments_present:boolean>, channel string, arrival long"))


LOADS = [
    [order("R1", 1), order("R2", 2, labor="-1"), order("R1", 3), order(None, 4), order("R3", 5, vin=None)],
    [order("R2", 11), order("R1", 12, service="odd"), order("R3", 13), order("", 14), order("R4", 15, email="b@x.test")],
    [order("R2", 21), order("R4", 22), order("R5", 23, vin="V9"), order("R6", 24, email=None), order("R6", 25)],
]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    stored = incremental.IncrementalWarehouse(str(tmp_path_factory.mktemp("loads")))
    stored.create(spark)
    for n, orders in enumerate(LOADS, 1):
        stored.load(delivered(spark, orders), n)
    return stored


def test_n_loads_reject_what_one_load_rejects(spark, loaded):
    whole = gates.quarantine(gates.gate_orders(spark.createDataFrame(sum(LOADS, []), ORDERS)))
    got = loaded.rejects.read(spark).where("reason not like 'orphan%'")
    pairs = lambda df: sorted((r.ro_number or "", r.reason) for r in df.collect())
    assert pairs(got) == pairs(whole)
    assert ("R1", "duplicate_ro_number,invalid_service_type") in pairs(got)


def test_facts_of_n_loads_are_those_of_one(spark, loaded):
    whole = warehouse.build_warehouse(delivered(spark, sum(LOADS, []))).fact_repair_orders
    columns = [c for c in whole.columns if c != "ro_key"]
    got = loaded.fact(spark)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))
    assert sorted(r.ro_key for r in got.collect()) == list(range(1, whole.count() + 1))


def test_no_contact_data_is_stored(spark, loaded):
    text = " ".join(str(r) for r in [*loaded.rejects.read(spark).collect(), *loaded.keys(spark).collect()])
    assert "@x.test" not in text and "555-0001" not in text


def test_the_last_load_can_be_replayed(spark, loaded):
    before = [sorted(map(str, log.read(spark).collect())) for log in loaded._logs()]
    loaded.load(delivered(spark, LOADS[2]), 3)
    assert [sorted(map(str, log.read(spark).collect())) for log in loaded._logs()] == before


def test_only_new_rows_are_gated(spark, loaded):
    """The state comes in as order numbers; the plan reads no earlier order."""
    gated = gates.gate_orders(delivered(spark, LOADS[0]).orders, seen=loaded.accepted.read(spark))
    plan = gated._jdf.queryExecution().optimizedPlan().toString()
    assert "/facts" not in plan and "raw_row" not in plan
    assert {r.reason for r in gated.where(F.col("ro_number") == "R1").collect()} == {"duplicate_ro_number"}
