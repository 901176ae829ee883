"""Zone maps against the files, and the curve against plain sorting."""

import pytest
from pyspark.sql import functions as F

from bayline.operators import zones


@pytest.fixture(scope="module")
def fact(spark):
    return spark.range(40_000).select(
        F.date_add(F.lit("2024-01-01"), F.pmod(F.xxhash64("id"), F.lit(300)).cast("int")).alias("day"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).alias("dealer"),
        F.concat(F.lit("type "), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(6))).alias("kind"), "id")


@pytest.fixture(scope="module")
def stored(spark, fact, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layouts"))
    fact.repartitionByRange(16, "day").write.parquet(f"{root}/day")
    fact.repartitionByRange(16, "day", "dealer", "kind").sortWithinPartitions("day", "dealer").write.parquet(f"{root}/sorted")
    zones.write_curve(fact, f"{root}/curve", ["day", "dealer", "kind"], 16)
    return {n: (f"{root}/{n}", zones.zone_map(spark, f"{root}/{n}", ["day", "dealer", "kind"]).cache()) for n in ("day", "sorted", "curve")}


def test_zones_are_those_of_the_files(spark, fact, stored):
    path, found = stored["curve"]
    assert found.where("column_name = 'day'").agg(F.sum("row_count")).first()[0] == 40_000
    per_file = spark.read.schema(fact.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min("dealer").alias("low"), F.max("dealer").alias("high"), F.min("kind").alias("a"), F.max("day").alias("z")).collect()
    ends = {}
    for r in found.collect():
        ends.setdefault(r.file.rsplit("/")[-1], {})[r.column_name] = (r.low, r.high)
    for r in per_file:
        assert ends[r.f]["dealer"] == (str(r.low), str(r.high)) and ends[r.f]["kind"][0] == r.a and ends[r.f]["day"][1] == str(r.z)


@pytest.mark.parametrize("wanted", [
    {"dealer": (7, 7)}, {"kind": ("type 3", "type 3")}, {"day": ("2024-02-01", "2024-02-29"), "dealer": (7, 9)},
    {"dealer": (500, 600)}, {"dealer": (-5, 99)}])
def test_what_is_skipped_holds_no_row(spark, fact, stored, wanted):
    hit = F.lit(True)
    for column, (low, high) in wanted.items():
        hit = hit & F.col(column).cast("string" if isinstance(low, str) else "double").between(low, high)
    matching = fact.where(hit).count()
    for path, found in stored.values():
        got = zones.touched(found, wanted).first()
        assert matching <= got.rows <= 40_000 and got.groups <= got.all_groups and got.bytes <= got.all_bytes
        files = {r.file.rsplit("/")[-1] for r in found.collect()}
        assert len(files) == 16


def test_the_curve_skips_on_every_column(stored):
    """Files by day hold all dealers; along the curve a dealer is in some files only."""
    rows = {n: zones.touched(found, {"dealer": (7, 7)}).first().rows for n, (_, found) in stored.items()}
    assert rows["day"] == rows["sorted"] == 40_000 and rows["curve"] < 0.6 * rows["day"]
    curve = stored["curve"][1]
    both = zones.touched(curve, {"dealer": (7, 7), "day": ("2024-02-01", "2024-02-29")}).first().rows
    assert both < 0.8 * rows["curve"] and zones.touched(curve, {"kind": ("type 3", "type 3")}).first().rows < 40_000


def test_the_curve_takes_bits_in_turn(spark):
    df = spark.createDataFrame([(0b11, 0b00), (0b01, 0b10), (0b10, 0b11)], "a long, b long")
    got = [r[0] for r in df.select(zones.curve([F.col("a"), F.col("b")], 2)).collect()]
    assert got == [0b0101, 0b1001, 0b1110]


def test_nulls_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, None, 1), (None, "x", 2)], "d date, t string, n int")
    zones.write_curve(df, str(tmp_path / "t"), ["d", "t", "n"], 2)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    found = zones.zone_map(spark, str(tmp_path / "t"), ["d", "n"])
    assert zones.touched(found, {"d": ("2024-01-01", "2024-01-02")}).first().rows == 2
    zones.write_curve(df.limit(0), str(tmp_path / "e"), ["d", "n"], 2)
    assert zones.touched(zones.zone_map(spark, str(tmp_path / "e"), ["n"]), {"n": (1, 1)}).first().rows == 0
