"""Coverage rows: current primary, primary in force on a date, recent change.

The three differ on purpose. "Current" needs an active row valid today, "at dispense" a row valid
on the dispense date whatever its active flag, and "recent change" only a recent edit.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.functions.predicates import at_midnight, is_active, valid_on, wall_clock
from covdrift.operators.latest import latest_per
from covdrift.operators.narrow import keys_of, only_keys
from covdrift.operators.work import staged

PRIMARY = "P"
#: Rows of a patient that its days look through one by one.
LISTED = 64


def _latest_edit_first() -> list[Column]:
    edited = F.coalesce("changed_date", "created_date", at_midnight(F.col("start_date")))
    return [edited.desc_nulls_last(), F.col("sr_id").desc_nulls_last()]


def _primary_rows(insurance: DataFrame) -> DataFrame:
    return insurance.where(F.col("priority") == PRIMARY)


def current_primary(insurance: DataFrame, as_of: date) -> DataFrame:
    """Each patient's last edited active primary row that is valid on ``as_of``."""
    rows = _primary_rows(insurance).where(
        is_active(F.col("active")) & valid_on(F.col("start_date"), F.col("end_date"), F.lit(as_of))
    )
    return latest_per(rows, ["patient_id"], _latest_edit_first())


def recent_primary_edits(insurance: DataFrame, as_of_ts: datetime, days: int) -> DataFrame:
    """Primary rows edited in the last ``days`` days.

    "Edited" is the change time, or the creation time of a row never changed. Written as two
    plain comparisons, which the scan can push down; a comparison on the coalesced value cannot.
    """
    bound = wall_clock(as_of_ts - timedelta(days=days))
    changed, created = F.col("changed_date"), F.col("created_date")
    return (
        _primary_rows(insurance)
        .where((changed >= bound) | (changed.isNull() & (created >= bound)))
        .withColumn("insurance_change_ts", F.coalesce(changed, created))
    )


def recent_primary_change(edits: DataFrame) -> DataFrame:
    """Each patient's last of the recent edits."""
    return latest_per(edits, ["patient_id"], _latest_edit_first())


def primary_at_dispense(
    last_dispense: DataFrame, insurance: DataFrame, oldest: date | None = None
) -> DataFrame:
    """Primary row in force on each dispense date: the latest to start, then the highest row id.

    An equi-join on the patient with the interval test as its residual, then top-1. The left side
    has one row per (patient, drug), so a row of ``insurance`` meets at most one row per drug.
    ``oldest`` is a lower bound of the dispense dates, and lets the scan skip coverage that had
    ended by then.
    """
    rows = _primary_rows(insurance)
    if oldest is not None:
        rows = rows.where(F.col("end_date").isNull() | (F.col("end_date") >= F.lit(oldest)))
    dispensed = last_dispense.select("patient_id", "biologic_drug", "dispense_date")
    in_force = valid_on(F.col("start_date"), F.col("end_date"), F.col("dispense_date"))
    latest_start = F.coalesce("start_date", F.lit(date(1900, 1, 1)))
    return latest_per(
        dispensed.join(rows, "patient_id").where(in_force),
        ["patient_id", "biologic_drug"],
        [latest_start.desc(), F.col("sr_id").desc_nulls_last()],
        own_stage=True,
    )


def _blocks(first: str, last: str, levels: int) -> Column:
    """The fewest aligned blocks (level, block) that make up the days from ``first`` to ``last``.

    A block of level k is 2**k days long. Of each level at most the outermost two are needed: the
    first where its number is odd, the last where it is even; all between lie in larger blocks.
    """
    low = f"shiftright({first} + shiftleft(1L, k) - 1L, k)"
    high = f"(shiftright({last} + 1L, k) - 1L)"
    level = f"""array(
        if({low} <= {high} and {low} % 2 = 1, named_struct('level', k, 'block', {low}), null),
        if({low} <= {high} and {high} % 2 = 0, named_struct('level', k, 'block', {high}), null))"""
    return F.expr(f"filter(flatten(transform(sequence(0, {levels}), k -> {level})), b -> b is not null)")


def in_force_at(events: DataFrame, insurance: DataFrame) -> DataFrame:
    """Primary row in force on each (patient_id, event_date): (patient_id, event_date, row's columns).

    Of the rows valid on a day the latest to start counts, then the highest row id. A patient's few
    rows are listed once and every day looks through the list, so a row is shuffled once. A day
    costs at most ``LISTED`` tests: the days of patients with more rows look in blocks of days.

    Both sides of the joins grow with the data. They are merged whatever the size of the files: a
    file of days and keys is a tenth of what they take in the driver's memory.
    """
    days = staged(events.where("patient_id is not null and event_date is not null").select("patient_id", "event_date").distinct())
    rows = only_keys(_primary_rows(insurance), "patient_id", keys_of(days, "patient_id"))
    rows = rows.select(
        "patient_id",
        F.struct(
            F.coalesce("start_date", F.lit(date(1900, 1, 1))).alias("_start"),
            F.col("sr_id").alias("_id"),
            F.struct(*[F.col(c) for c in insurance.columns if c != "patient_id"]).alias("row"),
        ).alias("_row"),
    )
    counted = rows.groupBy("patient_id").agg(F.count("*").alias("_rows"))
    crowded = staged(counted.where(F.col("_rows") > LISTED).select("patient_id"))
    found = _in_list(days, rows.join(crowded, "patient_id", "left_anti"))
    if not crowded.isEmpty():
        dense, many = (only_keys(df, "patient_id", crowded) for df in (days, rows))
        found = found.unionByName(_in_blocks(dense, many))
    return found.select("patient_id", "event_date", "_row.row.*")


def _in_list(days: DataFrame, rows: DataFrame) -> DataFrame:
    """(patient_id, event_date, _row): each day looks through the list of its patient's rows."""
    listed = rows.groupBy("patient_id").agg(F.collect_list("_row").alias("_rows"))
    valid = F.filter(
        "_rows", lambda r: valid_on(r["row"]["start_date"], r["row"]["end_date"], F.col("event_date"))
    )
    best = F.array_max(valid).alias("_row")
    return days.hint("merge").join(listed, "patient_id").select("patient_id", "event_date", best).where("_row is not null")


def _in_blocks(days: DataFrame, rows: DataFrame) -> DataFrame:
    """(patient_id, event_date, _row): the same without testing a patient's days and rows in pairs.

    A row is stored under the few aligned blocks of days that make up its validity, where only the
    best row per block is kept, and a day is looked up under the one block of each size that holds
    it. A patient costs at most one row per day and block size, however many events and rows it
    has, and its blocks lie in many partitions.
    """
    bounds = days.agg(F.min("event_date"), F.max("event_date")).first()
    # Only days asked for matter, so the blocks cover these.
    first = bounds[0] or date(1900, 1, 1)
    span = (bounds[1] - bounds[0]).days if bounds[0] else 0
    levels = span.bit_length()
    origin = f"date'{first.isoformat()}'"
    best = (
        rows.select(
            "patient_id",
            F.expr(f"greatest(coalesce(datediff(_row.row.start_date, {origin}), 0), 0)").cast("long").alias("_first"),
            F.expr(f"least(coalesce(datediff(_row.row.end_date, {origin}), {span}), {span})").cast("long").alias("_last"),
            "_row",
        )
        .where("_first <= _last")
        .select("patient_id", "_row", F.explode(_blocks("_first", "_last", levels)).alias("_at"))
        .groupBy("patient_id", "_at.level", "_at.block")
        .agg(F.max("_row").alias("_row"))
    )
    looked = days.select(
        "patient_id",
        "event_date",
        F.expr(f"cast(datediff(event_date, {origin}) as bigint)").alias("_day"),
        F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"),
    ).withColumn("block", F.expr("shiftright(_day, level)"))
    return (
        looked.hint("merge")
        .join(best, ["patient_id", "level", "block"])
        .groupBy("patient_id", "event_date")
        .agg(F.max("_row").alias("_row"))
    )


def change_after_dispense(last_dispense: DataFrame, change: DataFrame) -> DataFrame:
    """Last dispenses whose patient's newest change came after and is more than an edit.

    Both sides hold one row per patient before the test: when the newest change fails it, an
    older one that would pass is not considered.
    """
    dispensed_at = at_midnight(F.col("dispense_date"))
    starts_after = F.col("start_date") >= F.col("dispense_date")
    created_after = F.col("created_date") >= dispensed_at
    return last_dispense.join(change, "patient_id").where(
        (F.col("insurance_change_ts") >= dispensed_at) & (starts_after | created_after)
    )
