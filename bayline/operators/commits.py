"""Versions of a set of tables as numbered commits.

A commit writes its tables into a folder of its own and then claims the next number by creating one
small file, which the store does for one writer only. Readers take the highest number, never a
clock. A failed or beaten writer leaves an unnamed folder. `sweep` marks what may still be read,
the newest commit and those replaced not long ago, and removes the other commits' folders and old
unnamed ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from bayline.operators.files import Folder
from bayline.session import shuffles_freed

DAY = 86_400.0
_COMMITS, _DATA = "commits", "versions"


class CommitConflict(RuntimeError):
    """Another writer has committed since this one began."""


def _file(number: int) -> str:
    return f"{_COMMITS}/{number:012d}"


@dataclass(frozen=True)
class Commits:
    root: str

    def numbers(self, spark: SparkSession) -> list[int]:
        return [int(n) for n in Folder(spark, self.root).names(_COMMITS)]

    def latest(self, spark: SparkSession) -> int | None:
        return max(self.numbers(spark), default=None)

    def commit(self, tables: Mapping[str, DataFrame], after: int | None = None) -> int:
        """Store the tables as the next version and return its number.

        `after` is the number that the writer has built upon (the newest at the start, unless
        given); the commit is refused when there is a later one by then.
        """
        spark = next(iter(tables.values())).sparkSession
        if after is None:
            after = self.latest(spark) or 0
        version = uuid.uuid4().hex
        for name, df in tables.items():
            with shuffles_freed(spark):
                df.write.parquet(f"{self.root}/{_DATA}/{version}/{name}")
        entry = {"version": version, "schemas": {name: df.schema.json() for name, df in tables.items()}}
        if not Folder(spark, self.root).create(_file(after + 1), json.dumps(entry)):
            raise CommitConflict(f"{self.root} has gone beyond commit {after}")
        return after + 1

    def _entry(self, spark: SparkSession, number: int | None) -> dict:
        number = self.latest(spark) if number is None else number
        if number is None:
            raise ValueError(f"{self.root} has no commit")
        return json.loads(Folder(spark, self.root).text(_file(number)))

    def open(self, spark: SparkSession, name: str, number: int | None = None) -> DataFrame:
        """A table of the newest commit, or of a given one that still exists."""
        entry = self._entry(spark, number)
        schema = T.StructType.fromJson(json.loads(entry["schemas"][name]))
        return spark.read.schema(schema).parquet(f"{self.root}/{_DATA}/{entry['version']}/{name}")

    def sweep(self, spark: SparkSession, older_than: float = 7 * DAY) -> list[str]:
        """Remove what no reader of the last `older_than` seconds can have opened; what was removed.

        Folders without a commit are spared for as long, since a writer may still be at work.
        """
        folder = Folder(spark, self.root)
        numbers = sorted(self.numbers(spark))
        # A commit may be read until some time after its successor came.
        gone = [n for n, later in zip(numbers, numbers[1:]) if folder.age(_file(later)) >= older_than]
        kept = {self._entry(spark, n)["version"] for n in numbers if n not in gone}
        for number in gone:
            # The commit goes first, so that nobody opens what is about to go.
            folder.remove(_file(number))
        unnamed = [v for v in folder.names(_DATA) if v not in kept]
        swept = [v for v in unnamed if folder.age(f"{_DATA}/{v}") >= older_than]
        for version in swept:
            folder.remove(f"{_DATA}/{version}")
        return swept
