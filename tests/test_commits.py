"""Numbered versions: two writers, readers beside a sweep."""

import pytest

from bayline.operators import layout
from bayline.operators.commits import CommitConflict, Commits
from bayline.operators.files import Folder


def table(spark, n):
    return {"t": spark.range(n)}


def test_of_two_writers_one_is_refused(spark, tmp_path):
    commits = Commits(str(tmp_path))
    assert commits.commit(table(spark, 1)) == 1
    seen = commits.latest(spark)
    assert commits.commit(table(spark, 2), after=seen) == 2
    with pytest.raises(CommitConflict):
        commits.commit(table(spark, 3), after=seen)
    assert commits.open(spark, "t").count() == 2 and commits.open(spark, "t", 1).count() == 1


def test_the_highest_number_counts_whatever_the_clock_says(spark, tmp_path):
    for n in range(1, 12):
        layout.publish(table(spark, n), str(tmp_path))
    first = Folder(spark, str(tmp_path))
    first._files.setTimes(first._path("commits/000000000002"), 4102444800000, -1)
    assert layout.open_published(spark, str(tmp_path), "t").count() == 11


def test_nothing_committed(spark, tmp_path):
    commits = Commits(str(tmp_path / "none"))
    assert commits.latest(spark) is None and commits.sweep(spark, 0) == []
    with pytest.raises(ValueError):
        commits.open(spark, "t")


def test_a_reader_finishes_beside_a_sweep(spark, tmp_path):
    commits = Commits(str(tmp_path))
    commits.commit(table(spark, 10))
    reader = commits.open(spark, "t")
    commits.commit(table(spark, 20))
    assert commits.sweep(spark, older_than=3600) == [] and reader.count() == 10
    assert len(commits.sweep(spark, older_than=0)) == 1
    assert commits.numbers(spark) == [2] and commits.open(spark, "t").count() == 20
    with pytest.raises(CommitConflict):
        commits.commit(table(spark, 3), after=1)


def test_an_unfinished_writer_is_spared_and_its_rest_removed_later(spark, tmp_path):
    commits = Commits(str(tmp_path))
    commits.commit(table(spark, 1))
    spark.range(5).write.parquet(f"{tmp_path}/versions/unfinished/t")
    assert commits.sweep(spark, older_than=3600) == []
    assert commits.sweep(spark, older_than=0) == ["unfinished"]
    assert commits.open(spark, "t").count() == 1
