"""Stage flags and task/partner funnels over raw attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.functions.leads import flag, is_installed


def stage_flags(attempts: DataFrame) -> DataFrame:
    """Per attempt (task): which funnel stages it reached, as 0/1 ints."""
    return attempts.select(
        "*",
        flag(F.col("proposed_slot_date").isNotNull()).alias("slot_proposed"),
        flag(F.col("confirmed_slot_at").isNotNull()).alias("slot_confirmed"),
        flag(F.col("executor_id").isNotNull()).alias("tech"),
        flag((F.col("current_state") == "ARRIVED_AT_SITE") | (F.col("completed_step") >= 1)).alias("arrived"),
        flag(is_installed(strict=False)).alias("installed"),
    )
