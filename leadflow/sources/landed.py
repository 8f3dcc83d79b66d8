"""Readers for the landed tables: one Parquet folder a table, with the schemas of FIXTURES section 1.

``LandedTables`` has the same attributes as the test mapping (``TestData``), so the refresh and streaming jobs take either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "attempts": "partner_id bigint, connection_id bigint, attempt_id string, current_state string, reason_code string, "
                "failure_reason string, failure_subreason string, zone_id string, executor_id string, otp_verified boolean, "
                "completed_step int, updated_at timestamp_ntz, created_at timestamp_ntz, confirmed_slot_at timestamp_ntz, "
                "confirmed_slot_date date, proposed_slot_date date, installation_completed_at timestamp_ntz, active boolean",
    "ledger": "partner_id bigint, connection_id bigint, terminal_outcome string, terminal_at timestamp_ntz, ledger_id bigint",
    "transitions": "attempt_id string, to_state string",
    "users": "user_id bigint, partner_id bigint, role string, status string, active boolean",
    "profiles": "profile_id bigint, partner_id bigint, deleted boolean, last_seen timestamp_ntz",
    "events": "event_id bigint, profile_id bigint, event_name string, ts timestamp_ntz, deleted boolean, campaign string",
    "rosters": "partner_id bigint, category string, flow int, is_test boolean",
    "overlay": "partner_id bigint, joined date, rate_before int, rate_after int, switch date, inst_before bigint, inst_after bigint",
    "impacted": "connection_id bigint",
    "optins": "partner_id bigint, opted_at timestamp_ntz",
    "audits": "partner_id bigint, scan_complete_at timestamp_ntz",
    "quality": "partner_id bigint, tier string, amount bigint",
    "inventory": "event_name string, campaign string",
    "accounts": "account_name string, partner_id bigint",
}


class LandedTables:
    """Lazy tables under ``root``; the schema is given, so no file is opened to infer it and a missing column is NULL."""

    def __init__(self, spark: SparkSession, root: str, overrides: dict[str, str] | None = None):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), SCHEMAS | (overrides or {})

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.__dict__.get("schemas", {}):
            raise AttributeError(name)
        return self.spark.read.schema(self.schemas[name]).parquet(self.path(name))

    def stream(self, name: str) -> DataFrame:
        """The same table as a stream of its new files."""
        return self.spark.readStream.schema(self.schemas[name]).parquet(self.path(name))
