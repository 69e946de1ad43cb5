from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from covdrift.llm.common import join_split


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [1, 10, 10**6])
def test_equals_a_plain_join(spark, how, share):
    """No key, one key of a third of all rows, and every key is hot; some keys have no partner."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400)
    rows = spark.range(3000).select(key.alias("k"), F.when(F.col("id") % 11 > 0, 1).alias("j"), "id")
    table = rows.groupBy("k", "j").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("k % 2 = 1")
    got = join_split(rows, table, ["k", "j"], 3000, how, share)
    want = rows.join(table.drop("n"), ["k", "j"], how)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_empty_sides(spark, how):
    rows = spark.range(5).select(F.col("id").alias("k"))
    table = spark.createDataFrame([], "k long, n long, least long")
    assert join_split(rows, table, ["k"], 5, how).count() == (5 if how == "left" else 0)
    assert join_split(rows.limit(0), table, ["k"], 0, how).count() == 0
