"""Erasure leaves untouched files alone and no row behind."""

import pytest
from pyspark.sql import functions as F

from bayline.operators.commits import CommitConflict
from bayline.plans.erasure import ErasableTable


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(400).select(
        F.sha2(F.col("id").cast("string"), 256).alias("email_hash"), F.col("id").alias("k"))
    stored = ErasableTable(str(tmp_path / "t"), rows.schema, "email_hash")
    stored.create(rows.repartitionByRange(8, "k"))
    return stored


def requests(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long").select(F.sha2(F.col("id").cast("string"), 256).alias("email_hash"))


def test_untouched_files_keep_their_names_and_no_hash_remains(spark, table):
    before = set(table.files(spark))
    receipts = {r.file: r for r in table.erase(requests(spark, 3, 5, 399, 5000)).collect()}
    after = set(table.files(spark))
    assert sorted(r.k for r in table.read(spark).collect()) == [i for i in range(400) if i not in (3, 5, 399)]
    gone = before - after
    assert len(before) == 8 and gone == {f for f, r in receipts.items() if r.rewritten} and len(gone) == 2
    assert sum(r.erased for r in receipts.values()) == 3 and len(receipts) < 8
    assert table.read(spark).join(requests(spark, 3, 5, 399), "email_hash").isEmpty()
    assert set(receipts) <= before


def test_an_erased_hash_is_in_no_file_after_a_sweep(spark, table):
    reader = table.read(spark)
    table.erase(requests(spark, 7))
    assert reader.count() == 400 and table.sweep(spark, older_than=3600) == []
    assert len(table.sweep(spark, older_than=0)) == 1
    everything = spark.read.schema(table.schema).option("recursiveFileLookup", True).parquet(f"{table.root}/data")
    assert everything.count() == 399 and everything.where("k = 7").isEmpty()
    assert table.read(spark).count() == 399


def test_nothing_asked_for_writes_nothing(spark, table):
    files = table.files(spark)
    assert table.erase(requests(spark, 1000)).where("rewritten = 1").isEmpty()
    assert table.files(spark) == files and table.commits.numbers(spark) == [1]
    assert table.erase(requests(spark)).isEmpty()


def test_all_rows_of_a_file_can_go(spark, table):
    table.erase(requests(spark, *range(0, 50)))
    assert table.read(spark).count() == 350
    table.erase(requests(spark, *range(0, 400)))
    assert table.read(spark).count() == 0
    table.erase(requests(spark, 1))


def test_two_requests_at_once_do_not_lose_one(spark, table):
    assert table.commits.latest(spark) == 1
    table.erase(requests(spark, 1))
    with pytest.raises(CommitConflict):
        table._commit(spark, table.files(spark), table.commits.open(spark, "summaries"), 1)
