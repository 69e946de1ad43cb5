"""As-of join on a key: the newest log entry near each probe, without pairing probes and entries.

A plain range join meets every entry of a window with every probe of it, which is quadratic when a
bulk load puts a large share of both in one window. Here every probe looks back from its upper
time edge instead, so entries and probes are only ever sorted together, never paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000


def window_width(minutes: int) -> int:
    """Length of the whole search window, in microseconds."""
    return 2 * minutes * 60 * SECOND


def _micros(ts: str) -> str:
    """Microseconds since 1970 of a zone-free timestamp; no session zone takes part."""
    seconds = f"cast(cast({ts} - timestamp_ntz'1970-01-01' as interval second) as decimal(20, 6))"
    return f"cast({seconds} * {SECOND} as bigint)"


def _floor(value: str, width: int) -> str:
    return f"({value} - pmod({value}, {width}))"


def upper_edge(ts: str, minutes: int) -> Column:
    """Upper time edge of the search around ``ts``, in microseconds."""
    return F.expr(f"{_micros(ts)} + {window_width(minutes) // 2}")


def entry_bin(ts: str, minutes: int) -> Column:
    """The bin of a log entry: bins are as long as the search window."""
    return F.expr(_floor(_micros(ts), window_width(minutes)))


def searched_bins(edge: str, minutes: int) -> Column:
    """The two bins that the window below ``edge`` can touch."""
    width = window_width(minutes)
    last = _floor(edge, width)
    return F.expr(f"array({last} - {width}, {last})")


def _carry_forward(rows: DataFrame, group: str) -> DataFrame:
    """Give each probe the newest entry at or before it within its group."""
    so_far = (
        Window.partitionBy("match_key", group)
        .orderBy("at", "is_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    newest = F.last("entry", ignorenulls=True).over(so_far)
    return rows.withColumn("entry", newest).where("is_probe and entry is not null")


def newest_within(probes: DataFrame, entries: DataFrame, minutes: int) -> DataFrame:
    """Newest entry within ``minutes`` of each probe, both ends included, on equal ``match_key``.

    ``probes`` has (match_key, edge), where ``edge`` is the ``upper_edge`` of the probe's time, and
    ``entries`` has (match_key, audit_ts, audit_user). The result has (match_key, edge, audit_ts,
    audit_user), one row per distinct probe that has an entry; entries of one moment resolve to
    the highest user.

    The search runs in two sorted passes. The first works on one entry per second and finds the
    newest one before the probe's own second; the second adds the entries of that second. Equal
    moments are merged beforehand, so a group holds at most one row per second of two windows in
    the first pass and one row per microsecond of one second in the second, however many rows a
    key or a window has.
    """
    width = window_width(minutes)
    no_entry = "cast(null as struct<audit_ts: timestamp_ntz, audit_user: string>) as entry"
    moments = (
        entries.groupBy("match_key", "audit_ts")
        .agg(F.max("audit_user").alias("audit_user"))
        # Every use of the moments reads the user through this, so all share one shuffle.
        .where("audit_user is not null")
        .selectExpr(
            "match_key",
            f"{_micros('audit_ts')} as at",
            "struct(audit_ts, audit_user) as entry",
        )
        .selectExpr("*", f"{_floor('at', SECOND)} as second")
    )
    # Most keys asked for are in no log: keep only probes with an entry in one of their two bins.
    present = moments.selectExpr(
        f"xxhash64(match_key, {_floor('second', width)}) as key_hash"
    ).distinct()
    sought = (
        probes.select("match_key", "edge")
        .distinct()
        .select("match_key", "edge", F.explode(searched_bins("edge", minutes)).alias("bin"))
        .selectExpr("match_key", "edge", "xxhash64(match_key, bin) as key_hash")
        .join(present, "key_hash", "left_semi")
        .select("match_key", "edge")
        .distinct()
        .selectExpr("match_key", "edge as at", f"{_floor('edge', SECOND)} as second")
    )

    # Pass 1: per-second maxima, each also standing at the start of the next bin.
    own_bin = _floor("second", width)
    seconds = moments.groupBy("match_key", "second").agg(F.max("entry").alias("entry"))
    carried = seconds.selectExpr(
        "match_key",
        f"explode(array({own_bin}, {own_bin} + {width})) as bin",
        "second as at",
        "false as is_probe",
        "entry",
    )
    starts = sought.select("match_key", "second").distinct()
    looking = starts.selectExpr(
        "match_key", f"{own_bin} as bin", "second - 1 as at", "true as is_probe", no_entry
    )
    earlier = _carry_forward(carried.unionByName(looking), "bin")

    # Pass 2: the probe's own second, with the result of pass 1 standing before it.
    columns = ["match_key", "at", "false as is_probe", "entry"]
    candidates = earlier.selectExpr("at + 1 as second", *columns).unionByName(
        moments.selectExpr("second", *columns)
    )
    looking = sought.selectExpr("second", "match_key", "at", "true as is_probe", no_entry)
    found = _carry_forward(candidates.unionByName(looking), "second")
    return found.where(f"{_micros('entry.audit_ts')} >= at - {width}").selectExpr(
        "match_key", "at as edge", "entry.audit_ts", "entry.audit_user"
    )
