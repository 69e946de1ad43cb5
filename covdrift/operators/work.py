"""Intermediate tables of a run, in a folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; on one machine, where it is unset, a folder in the warehouse.

    It must be shared, so a cluster without that setting is an error. The folder holds one
    subfolder per staged table; a table may be removed once the frames read from it are no longer
    used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared or spark.conf.get("spark.sql.warehouse.dir") + "/_work"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once and read back: fixed rows of a measured size, with no lineage.

    Spark knows the size of what it reads from files, and picks joins with it by that size.
    """
    path = f"{work_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
