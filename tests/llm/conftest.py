from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def _interpreted(spark):
    """Small inputs: compiling the plans would take most of the time."""
    kept = spark.conf.get("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", kept)
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
