"""Type-2 history for a dimension stored as plain Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def open_history(dim: DataFrame, since) -> DataFrame:
    """First load: every row is current from `since` on."""
    return dim.withColumns({
        "effective_from": F.lit(since).cast("date"),
        "effective_to": F.lit(None).cast("date"),
        "is_current": F.lit(True),
    })


def apply_changes(
    history: DataFrame, incoming: DataFrame, key: str, attributes: Sequence[str], as_of
) -> DataFrame:
    """History after a new extract: changed members are closed and reopened, new ones opened,
    members missing from the extract closed; closed rows are carried over.

    The current rows meet the extract in one full outer join, and each pair emits the rows it
    leaves behind, so nothing is scanned twice.
    """
    day = F.lit(as_of).cast("date")
    past = history.where(~F.col("is_current"))
    now = history.where("is_current").select(
        F.col(key), F.struct(*attributes).alias("_old"), "effective_from")
    new = incoming.select(F.col(key), F.struct(*attributes).alias("_new"))
    pair = now.join(new, key, "full_outer")
    same = F.col("_old").eqNullSafe(F.col("_new"))

    def row(values: str, since, until, current: bool) -> F.Column:
        return F.struct(
            F.col(values).alias("v"), since.cast("date").alias("effective_from"),
            until.cast("date").alias("effective_to"), F.lit(current).alias("is_current"),
        )

    no_date = F.lit(None)
    kept = F.when(F.col("_old").isNotNull() & same,
                  row("_old", F.col("effective_from"), no_date, True))
    closed = F.when(F.col("_old").isNotNull() & ~same,
                    row("_old", F.col("effective_from"), day, False))
    opened = F.when(F.col("_new").isNotNull() & ~same, row("_new", day, no_date, True))
    changed = pair.select(
        key, F.explode(F.array_compact(F.array(kept, closed, opened))).alias("r")
    ).select(key, "r.v.*", "r.effective_from", "r.effective_to", "r.is_current")
    return past.select(*changed.columns).unionByName(changed)
