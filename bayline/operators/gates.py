"""Data-quality gates for repair orders.

A gate is a name and a predicate that is true for a bad row. All row-level gates run in one
projection. The duplicate gate needs the other rows of the same order: a row is a duplicate when
an *earlier row that passed every other gate* carries its number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from bayline import schemas
from bayline.functions import email_hash, in_domain, last4, money, parse_date, present
from bayline.operators.joins import spread_lookup
from bayline.session import stage

KEY, ARRIVAL, REASON = "ro_number", "arrival", "reason"

# Optional column of raw orders and surveys that a present order number determines, and by which the
# source's own join has brought the rows together: work per number then needs no shuffle of its own.
NEAR = "_near"


def near(df: DataFrame) -> list[str]:
    return [NEAR] if NEAR in df.columns else []


def _number() -> Column:
    """The order number as it is compared: a missing one is empty, as in the files."""
    return F.coalesce(F.col(KEY).cast("string"), F.lit(""))


@dataclass(frozen=True)
class Gate:
    """`fails` gives the predicate of a bad row; None marks the duplicate gate.

    `passes` may give a cheaper predicate of a good row (NULL counts as bad). It may answer for
    another gate too, which is then marked `covered` and left out of the pass-or-fail test.
    """

    name: str
    fails: Callable[[], Column] | None
    passes: Callable[[], Column] | None = None
    covered: bool = False


def _labor() -> Column:
    return money(F.col("labor_amount"))


def _parts() -> Column:
    return money(F.col("parts_amount"))


# Reason names are fixed values and are listed in reporting order. The three `unparsable_*`
# gates cover input that cannot be loaded at all; without them it would turn into silent NULLs.
ORDER_GATES: tuple[Gate, ...] = (
    Gate("missing_vin", lambda: ~present(F.col("vin"))),
    Gate("negative_amount",
         lambda: F.coalesce(_labor() < 0, F.lit(False)) | F.coalesce(_parts() < 0, F.lit(False)),
         passes=lambda: (_labor() >= 0) & (_parts() >= 0)),
    Gate("duplicate_ro_number", None),
    Gate("invalid_service_type",
         lambda: ~in_domain(F.col("service_type"), schemas.SERVICE_TYPES),
         passes=lambda: F.col("service_type").isin(*schemas.SERVICE_TYPES)),
    Gate("unparsable_amount", lambda: _labor().isNull() | _parts().isNull(), covered=True),
    Gate("unparsable_date", lambda: parse_date(F.col("open_date")).isNull()),
    Gate("unparsable_number",
         lambda: F.col("days_to_close").try_cast("int").isNull()
         | F.col("repeat_repair_flag").try_cast("int").isNull()),
)


def _row_passes(gates: Sequence[Gate]) -> Column:
    """True when no row-level gate rejects the row; false or NULL otherwise."""
    ok = F.lit(True)
    for gate in gates:
        if gate.fails is not None and not gate.covered:
            ok = ok & (gate.passes() if gate.passes else ~gate.fails())
    return ok


def clean_orders(raw: DataFrame, gates: Sequence[Gate] = ORDER_GATES) -> DataFrame:
    """The rows that pass: per order number, the first arrival that no row-level gate rejects.

    `row_number() = 1` is cut to one row per key inside each map task before the shuffle, so
    copies of a hot order number never pile up in one task. A column `NEAR` stays in the result.
    """
    passing = raw.where(_row_passes(gates))
    first = Window.partitionBy(*near(raw), _number()).orderBy(ARRIVAL)
    cut = passing.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    if not near(raw):
        return cut
    # Missing numbers are one number, wherever their rows lie.
    place = F.struct(ARRIVAL, NEAR)
    earliest = passing.where(_number() == "").agg(F.min(place)).scalar()
    return cut.where((_number() != "") | place.eqNullSafe(earliest))


def gate_orders(
    raw: DataFrame, gates: Sequence[Gate] = ORDER_GATES, seen: DataFrame | None = None
) -> DataFrame:
    """All rows with the comma-joined reasons they fail; an empty text means clean.

    `seen` holds the order numbers that earlier loads have accepted (column ro_number, each once):
    every row with such a number is a duplicate. Only this load's numbers are joined to it. A
    column `NEAR` is used and dropped.
    """
    beside = near(raw)
    tested = raw.withColumn("_ok", F.coalesce(_row_passes(gates), F.lit(False))).withColumn("_number", _number())
    # One row per order number that can make a duplicate, combined inside each map task before it
    # is shuffled. Stored, because both steps of the lookup read it and Spark should choose between
    # broadcast and shuffle from its real size.
    numbers = tested.groupBy(*beside, "_number").agg(
        F.min(F.when(F.col("_ok"), F.col(ARRIVAL))).alias("_first_clean"),
        F.count("*").alias("_rows"),
    )
    repeats = (F.col("_rows") > 1) & F.col("_first_clean").isNotNull()
    if seen is None:
        numbers = numbers.withColumn("_seen", F.lit(False))
    else:
        before = seen.select(_number().alias("_number"), F.lit(True).alias("_seen"))
        # Only a repeated number's first arrival decides anything; the shuffle goes without the others.
        # Missing numbers are repeated over all places together.
        decides = F.col("_rows") > 1
        if beside:
            decides = decides | (F.col("_number") == "")
        numbers = numbers.withColumn("_first_clean", F.when(decides, F.col("_first_clean")))
        numbers = numbers.join(before, "_number", "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    kept = repeats | F.col("_seen")
    if beside:  # missing numbers are one number, wherever their rows lie
        kept = kept | (F.col("_number") == "")
    repeated = stage(numbers.where(kept), "repeated")
    if beside:
        earliest = repeated.where("_number = ''").agg(F.min("_first_clean")).scalar()
        repeated = repeated.withColumn(
            "_first_clean", F.when(F.col("_number") == "", earliest).otherwise(F.col("_first_clean")))
    looked_up = spread_lookup(
        tested, repeated, [*beside, "_number"], "_rows", ["_first_clean", "_seen"],
        [F.col("_number"), F.col(ARRIVAL)],
    )
    duplicate = F.coalesce(F.col("_seen"), F.lit(False)) | F.coalesce(
        F.col("_first_clean") < F.col(ARRIVAL), F.lit(False))
    # concat_ws skips the NULLs of the gates a row has passed.
    reason = F.concat_ws(",", *[
        F.when(duplicate if gate.fails is None else gate.fails(), F.lit(gate.name))
        for gate in gates
    ])
    return looked_up.withColumn(REASON, reason).drop("_ok", "_number", "_first_clean", "_seen", NEAR)


def protect_contacts(orders: DataFrame) -> DataFrame:
    """Plain e-mail and phone replaced by `email_hash` and `phone_last4`; others unchanged."""
    if "customer_email" in orders.columns:
        orders = orders.withColumn("customer_email", email_hash(F.col("customer_email"))).withColumnRenamed(
            "customer_email", "email_hash")
    if "customer_phone" in orders.columns:
        orders = orders.withColumn("customer_phone", last4(F.col("customer_phone"))).withColumnRenamed(
            "customer_phone", "phone_last4")
    return orders


def passed(gated: DataFrame) -> DataFrame:
    return gated.where(F.col(REASON) == "").drop(REASON)


def quarantine(gated: DataFrame) -> DataFrame:
    """Rejected rows: order number, comma-joined reasons, the raw row as JSON text.

    Contact data goes in as its hash and last digits only.
    """
    gated = protect_contacts(gated)
    raw = [c for c in gated.columns if c not in (ARRIVAL, REASON)]
    return gated.where(F.col(REASON) != "").select(
        KEY, REASON,
        F.to_json(
            F.struct(*[F.col(c).cast("string").alias(c) for c in raw]),
            {"ignoreNullFields": "false"},
        ).alias("raw_row"),
    )
