"""Reading the domain tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from covdrift.schemas import SCHEMAS, conform


def load_table(
    spark: SparkSession,
    name: str,
    location: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read one table by its declared schema.

    ``jdbc`` takes its columns from the database; give ``url`` and, to read in parallel,
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in ``options``.
    """
    schema = SCHEMAS[name]
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "jdbc":
        return conform(reader.option("dbtable", name).load(), schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.schema(schema).load(f"{location.rstrip('/')}/{name}")


def load_tables(
    spark: SparkSession,
    location: str = "",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    names: Iterable[str] | None = None,
    table_options: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """All domain tables, or ``names``, as frames; nothing is read until a query runs.

    ``table_options`` adds options for single tables, such as a table's own partition column.
    """
    per_table = table_options or {}
    return {
        name: load_table(
            spark, name, location, fmt, {**(options or {}), **per_table.get(name, {})}
        )
        for name in (names or SCHEMAS)
    }
