"""Small inputs: inline roster tables and JSON overlay / cohort documents -> rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OVERLAY_VALUE = T.StructType([
    T.StructField("joined", T.DateType()), T.StructField("rate_before", T.IntegerType()),
    T.StructField("rate_after", T.IntegerType()), T.StructField("switch", T.DateType()),
    T.StructField("inst_before", T.LongType()), T.StructField("inst_after", T.LongType()),
])


def roster(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """An inline roster / enrol-date / impacted table (a parameter, not data)."""
    return spark.createDataFrame(rows, schema)


def overlay_rows(docs: DataFrame, col: str = "json") -> DataFrame:
    """JSON objects {partner: {joined?, rate_before?, ...}} -> one row per partner.

    Each document is parsed where it lies (from_json + explode), so a large overlay is
    never gathered into one row or one task.
    """
    m = F.from_json(F.col(col), T.MapType(T.StringType(), OVERLAY_VALUE))
    return (docs.select(F.explode(m).alias("partner_key", "v"))
            .select("partner_key", "v.joined", "v.rate_before", "v.rate_after", "v.switch", "v.inst_before", "v.inst_after"))


def cohort_rows(docs: DataFrame, col: str = "json") -> DataFrame:
    """JSON cohort documents -> rows; an array of ids, or a map id -> outcome group."""
    as_map = F.from_json(F.col(col), T.MapType(T.StringType(), T.StringType()))
    return docs.select(F.explode(as_map).alias("partner_key", "outcome"))


def cohort_ids(docs: DataFrame, col: str = "json") -> DataFrame:
    """S8 (array form): ["id", ...] -> one row per id."""
    return docs.select(F.explode(F.from_json(F.col(col), T.ArrayType(T.StringType()))).alias("partner_key"))
