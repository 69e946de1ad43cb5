"""Coverage kept as of a dispense or an approval, because coverage rows are edited in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.functions.text import or_blank
from covdrift.operators.coverage import in_force_at
from covdrift.operators.drift import NO_ALERT, drift
from covdrift.operators.enrich import prefixed
from covdrift.operators.latest import latest_per
from covdrift.schemas import conform, make_schema

COVERAGE_FIELDS = ["insurance_id", "insurance_no", "membership_id", "group_no", "group_name"]
DISPENSE, APPROVAL = "DISPENSE", "APPROVAL"
SNAPSHOT_KEY = ["patient_id", "biologic_drug", "source_event", "source_tran_id"]
#: What happened to a snapshot. Events are only ever added; ``has_coverage`` marks those that took it.
EVENT_SCHEMA = make_schema(
    "patient_id bigint, biologic_drug string, source_event string, source_tran_id bigint, "
    "source_date date, event_ts timestamp_ntz, has_coverage int, insurance_id bigint, "
    "insurance_no string, membership_id string, group_no string, group_name string, "
    "pa_status string, pa_expiration_date date, resolved_status string, resolved_by string"
)


def coverage_snapshot(last_dispense: DataFrame, at_dispense: DataFrame) -> DataFrame:
    """One snapshot row per last dispense with coverage, as it is when it is taken."""
    coverage = at_dispense.select("patient_id", "biologic_drug", *COVERAGE_FIELDS)
    unset = {
        "pa_status": "string",
        "pa_expiration_date": "date",
        "resolved_status": "string",
        "resolved_by": "string",
        "resolved_at": "timestamp_ntz",
    }
    return last_dispense.join(coverage, ["patient_id", "biologic_drug"]).select(
        "patient_id",
        "biologic_drug",
        F.lit(DISPENSE).alias("source_event"),
        F.col("dispense_tran_id").alias("source_tran_id"),
        F.col("dispense_date").alias("source_date"),
        *COVERAGE_FIELDS,
        *[F.lit(None).cast(kind).alias(name) for name, kind in unset.items()],
    )


def dispense_sources(charges: DataFrame) -> DataFrame:
    """Every dispense, once per patient, drug and transaction, as the source of a snapshot."""
    return (
        charges.groupBy("patient_id", "biologic_drug", F.col("dispense_tran_id").alias("source_tran_id"))
        .agg(F.max("dispense_date").alias("source_date"))
        .withColumn("source_event", F.lit(DISPENSE))
        .withColumn("event_ts", F.col("source_date").cast("timestamp_ntz"))
    )


def approval_sources(approvals: DataFrame) -> DataFrame:
    """Approvals and their later states as sources of snapshots.

    ``approvals`` has patient_id, biologic_drug, source_tran_id, source_date, event_ts, pa_status
    and pa_expiration_date, one row per state.
    """
    return approvals.withColumn("source_event", F.lit(APPROVAL))


def taken_events(sources: DataFrame, insurance: DataFrame) -> DataFrame:
    """Events that take the coverage in force on each source's date; those without any are left out."""
    dated = sources.withColumnRenamed("source_date", "event_date")
    coverage = in_force_at(dated, insurance).select("patient_id", "event_date", *COVERAGE_FIELDS)
    found = dated.hint("merge").join(coverage, ["patient_id", "event_date"]).withColumnRenamed("event_date", "source_date")
    return conform(found.withColumn("has_coverage", F.lit(1)), EVENT_SCHEMA)


def resolution_events(resolutions: DataFrame) -> DataFrame:
    """Events that close a snapshot.

    ``resolutions`` has the snapshot's key, resolved_status, resolved_by and resolved_at.
    """
    return conform(
        resolutions.withColumnRenamed("resolved_at", "event_ts").withColumn("has_coverage", F.lit(0)), EVENT_SCHEMA
    )


def new_events(events: DataFrame, known: DataFrame) -> DataFrame:
    """``events`` that are not in ``known`` yet, each once.

    The growing history is cut to the patients at hand first, on the key it is bucketed by.
    """
    patients = events.select("patient_id").distinct()
    near = known.join(patients, "patient_id", "left_semi")
    same = [*SNAPSHOT_KEY, "event_ts", "has_coverage"]
    return events.dropDuplicates(same).join(near.select(*same).distinct(), same, "left_anti")


def fold_events(events: DataFrame) -> DataFrame:
    """The state of each snapshot: coverage as first taken, the last approval state and resolution.

    The fold takes minima and maxima, so an event that stands twice, or comes late, does no harm,
    and a snapshot with very many events is combined before the shuffle. A resolution of what was
    never taken is no snapshot.
    """
    taken = F.struct("event_ts", "source_date", *COVERAGE_FIELDS)
    approved = F.struct("event_ts", "pa_status", "pa_expiration_date")
    resolved = F.struct("event_ts", "resolved_status", "resolved_by")
    folded = events.groupBy(*SNAPSHOT_KEY).agg(
        F.min(F.when(F.col("has_coverage") == 1, taken)).alias("taken"),
        F.max(F.when(F.col("pa_status").isNotNull(), approved)).alias("approved"),
        F.max(F.when(F.col("resolved_status").isNotNull(), resolved)).alias("resolved"),
    )
    return folded.where("taken is not null").select(
        *SNAPSHOT_KEY,
        "taken.source_date",
        *[f"taken.{name}" for name in COVERAGE_FIELDS],
        "approved.pa_status",
        "approved.pa_expiration_date",
        "resolved.resolved_status",
        "resolved.resolved_by",
        F.col("resolved.event_ts").alias("resolved_at"),
    )


def unresolved(snapshots: DataFrame) -> DataFrame:
    """Snapshots that nobody has closed: those that drift is looked for in."""
    return snapshots.where("resolved_status is null")


def snapshot_drift(snapshots: DataFrame, current: DataFrame) -> DataFrame:
    """Newest snapshot per patient and drug against current coverage, by the drift rules.

    Only the rules on missing or differing coverage can fire: a snapshot needs none on edit times.
    """
    newest_first = [
        F.col(c).desc_nulls_last() for c in ("source_date", "source_tran_id", "source_event")
    ]
    newest = latest_per(snapshots, ["patient_id", "biologic_drug"], newest_first)
    now = prefixed(current, "current", COVERAGE_FIELDS, ["patient_id"]).withColumn(
        "has_current", F.lit(True)
    )
    then = prefixed(
        newest,
        "dispense",
        COVERAGE_FIELDS,
        ["patient_id", "biologic_drug", "source_event", "source_tran_id", "source_date"],
    )
    base = then.join(now, "patient_id", "left").select(
        "*",
        F.lit(True).alias("has_dispense"),
        F.lit(True).alias("has_at_dispense"),
        F.col("source_date").alias("dispense_date"),
        F.lit(None).cast("date").alias("current_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("current_changed_date"),
    )
    return (
        drift(base)
        .where(F.col("alert_reason") != NO_ALERT)
        .select(
            "patient_id",
            "biologic_drug",
            "source_tran_id",
            "source_date",
            "alert_reason",
            "alert_priority",
        )
    )


def alert_text(report: DataFrame) -> DataFrame:
    """(schedule_tran_id, alert_text): a report row as the wording shown to staff."""

    def value(name: str):
        return or_blank(F.col(name).cast("string"))

    def line(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def coverage(side: str):
        return (
            value(f"{side}_plan_name"),
            " / ",
            value(f"{side}_membership_id"),
            " / group ",
            value(f"{side}_group_no"),
        )

    lines = [
        line("Biologic PA check needed before administration."),
        line("Reason: ", value("alert_reason")),
        line("Drug: ", value("biologic_drug")),
        line(
            "Appointment: ",
            value("schedule_date"),
            " ",
            value("schedule_time"),
            " ",
            value("office_code"),
        ),
        line("Last dispense: ", value("dispense_date"), " ", value("dispense_code")),
        line("Current primary: ", *coverage("current")),
        line("Primary at dispense: ", *coverage("dispense")),
    ]
    return report.select("schedule_tran_id", F.concat_ws("\n", *lines).alias("alert_text"))
