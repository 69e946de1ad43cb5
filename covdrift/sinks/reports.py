"""CSV reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from covdrift.operators.ids import positions


def report_order() -> list[Column]:
    """Reading order of the alert report; the appointment's id makes it total."""
    keys = ("alert_priority", "biologic_drug", "schedule_date", "schedule_time", "patient_name")
    return [F.col(k).asc_nulls_first() for k in (*keys, "schedule_tran_id")]


def candidate_order() -> list[Column]:
    """Reading order of the reminder candidates; the patient's id makes it total."""
    return [
        F.col("biologic_drug").asc_nulls_first(),
        F.col("insurance_change_ts").desc_nulls_last(),
        F.col("patient_name").asc_nulls_first(),
        F.col("patient_id").asc_nulls_first(),
    ]


def order_report(report: DataFrame) -> DataFrame:
    return report.orderBy(*report_order())


def order_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.orderBy(*candidate_order())


def numbered_report(report: DataFrame) -> DataFrame:
    """The alert report with each row's ``position`` in reading order, from 1."""
    return positions(report, report_order(), "position")


def numbered_candidates(candidates: DataFrame) -> DataFrame:
    """The candidates with each row's ``position`` in reading order, from 1."""
    return positions(candidates, candidate_order(), "position")


def report_metrics(report: DataFrame) -> DataFrame:
    """One row: the number of report rows, which line breaks inside a field do not change."""
    return report.agg(F.count("*").alias("report_rows"))


def write_report(report: DataFrame, folder: str, name: str, stamp: str) -> tuple[str, int]:
    """Write a CSV report with one header to the file ``<folder>/<name>_<stamp>.csv``; count its rows.

    Tasks write their ranges of an ordered frame side by side; the parts are then joined in their
    order, byte by byte, so nothing is sorted in one task or held in memory. The count is observed
    while writing. Quotes inside a field are doubled. The file appears whole, and is never
    overwritten.
    """
    spark = report.sparkSession
    path = f"{folder.rstrip('/')}/{name}_{stamp}.csv"
    parts = f"{folder.rstrip('/')}/.{name}_{stamp}-{uuid.uuid4().hex}"
    seen = Observation()
    (
        report.observe(seen, F.count(F.lit(1)).alias("report_rows"))
        .write.option("header", False)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(parts)
    )
    _join_parts(spark, parts, path, ",".join(report.columns))
    return path, seen.get.get("report_rows", 0)


def _join_parts(spark: SparkSession, parts: str, path: str, header: str) -> None:
    """The part files of ``parts`` in their order as one file ``path`` below a header line."""
    hadoop = spark._jvm.org.apache.hadoop
    source, target = hadoop.fs.Path(parts), hadoop.fs.Path(path)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        raise FileExistsError(f"{path} already exists")
    whole = hadoop.fs.Path(f"{parts}/_whole")
    out = files.create(whole, False)
    try:
        out.write(bytearray(f"{header}\n".encode()))
        found = sorted(files.listStatus(source), key=lambda part: part.getPath().getName())
        for part in found:
            if part.getPath().getName().startswith("part-"):
                opened = files.open(part.getPath())
                hadoop.io.IOUtils.copyBytes(opened, out, 1 << 16, False)
                opened.close()
    finally:
        out.close()
    files.rename(whole, target)
    files.delete(source, True)
