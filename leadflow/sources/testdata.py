"""Logical input tables derived from the driver's Parquet test data.

The mapping (FIXTURES.md §2) is deterministic and written as plain column
expressions over the raw scans, so Catalyst prunes columns and pushes filters
on raw columns into the Parquet reader. On a real deployment these functions
are replaced by direct reads of the landed tables with the same schemas.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# fixed values of the mapping: attempt state block by h = (partkey + 3*linenumber) % 20
# h -> (current_state, reason_code, failure_reason, failure_subreason)
STATE_BLOCK = {
    0: ("DECLINED", None, None, None),
    1: ("CANCELLED_BY_UPSTREAM", "ALLOCATION_ACCEPTED", "TIMEOUT_P74", "CSP_NO_SHOW"),
    2: ("CANCELLED_BY_UPSTREAM", "TIMEOUT_P41", None, None),
    3: ("CANCELLED_BY_CUSTOMER", None, None, None),
    4: ("CANCELLED_BY_CUSTOMER", None, None, None),
    5: ("INSTALLATION_REPORTED_FAILED", None, None, None),
    6: ("CANCELLED_BY_UPSTREAM", "RETRY_EXHAUSTION", None, None),
    7: ("CANCELLED_BY_UPSTREAM", "OTHER", None, None),
    8: ("INSTALLATION_CANCELLED_ONSITE", None, None, None),
    9: ("INSTALLATION_EXPIRED", None, None, None),
    10: ("CANCELLED_BY_CUSTOMER", None, None, "CSP_NO_SHOW"),
    11: ("ACCEPTED", None, None, None),
    12: ("AWAITING_SLOT_PROPOSAL", None, None, None),
    13: ("SLOT_SELECTED", None, None, None),
    14: ("AWAITING_CUSTOMER_SLOT_CONFIRMATION", None, None, None),
    15: ("SLOT_CONFIRMED_BY_CUSTOMER", None, None, None),
    16: ("AWAITING_TECHNICIAN_ASSIGNMENT", None, None, None),
    17: ("TECHNICIAN_ASSIGNED", None, None, None),
    18: ("ARRIVED_AT_SITE", None, None, None),
    19: ("AWAITING_CUSTOMER_OTP", None, None, None),
}

# fixed values: ledger outcome by o_orderkey % 8
LEDGER_OUTCOME = {
    0: "ON_TIME_ACTIVE", 1: "ON_TIME_ACTIVE", 2: "ON_TIME_ACTIVE", 3: "LATE_ACTIVE",
    4: "REPORTED_FAILED", 5: "CANCELLED_ONSITE", 6: "CUSTOMER_CANCELLED", 7: "UPSTREAM_CANCEL_PRE_CONFIRM",
}

# fixed values: campaign inventory (several event variants per logical campaign)
INVENTORY = [("banner_opened", "a"), ("signup", "a"), ("click", "b"), ("purchase", "b")]


def _minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n.cast("int"), ts)


def _case(key: Column, mapping: dict, pos: int | None = None) -> Column:
    """Lookup in a literal map (one folded constant instead of a long CASE chain); missing -> NULL."""
    pairs = []
    for k, v in mapping.items():
        val = v if pos is None else v[pos]
        if val is not None:
            pairs += [F.lit(k), F.lit(val)]
    return F.try_element_at(F.create_map(*pairs), key.cast("int"))


def tables(spark: SparkSession, sf_dir: str) -> "TestData":
    """The logical tables of one data folder. Plans are built anew for each call, so files that were added are seen."""
    return TestData(spark, sf_dir)


class TestData:
    """Lazy logical tables over ``{sf_dir}/<table>.parquet``."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def n_sup(self) -> Column:
        # scalar subquery: Catalyst runs it once and inlines the value
        return self.raw("supplier").select(F.count(F.lit(1))).scalar()

    # ---------------------------------------------------------------- attempts
    @cached_property
    def attempts(self) -> DataFrame:
        return map_attempts(self.raw("lineitem"))

    @cached_property
    def transitions(self) -> DataFrame:
        return self.attempts.where(F.col("executor_id").isNotNull()).select(
            "attempt_id", F.lit("TECHNICIAN_ASSIGNED").alias("to_state"))

    @cached_property
    def impacted(self) -> DataFrame:
        return (self.attempts.select("connection_id")
                .where(F.col("connection_id") % 50 == 0).distinct())

    # ------------------------------------------------------------------ ledger
    @cached_property
    def ledger(self) -> DataFrame:
        o = self.raw("orders")
        ok, ck = F.col("o_orderkey"), F.col("o_custkey")
        return o.select(
            (ck % self.n_sup).alias("partner_id"),
            F.floor(ok / 30).cast("bigint").alias("connection_id"),
            _case(ok % 8, LEDGER_OUTCOME).alias("terminal_outcome"),
            F.when(ok % 97 != 0, _minutes(F.col("o_orderdate"), (ck * 37 + ok) % 1440)).alias("terminal_at"),
            ok.alias("ledger_id"),
        )

    # ------------------------------------------------------------------- users
    @cached_property
    def users(self) -> DataFrame:
        c = self.raw("customer")
        seg = F.col("c_mktsegment")
        role = (F.when(seg == "BUILDING", "OWNER").when(seg == "AUTOMOBILE", "MANAGER_PLUS")
                .when(seg == "MACHINERY", "MANAGER").otherwise("STAFF"))
        return c.select(
            F.col("c_custkey").alias("user_id"),
            (F.col("c_custkey") % self.n_sup).alias("partner_id"),
            role.alias("role"),
            F.when(F.col("c_acctbal") >= 0, "ACTIVE").otherwise("INACTIVE").alias("status"),
            (F.col("c_custkey") % 23 != 0).alias("active"),
        )

    # ---------------------------------------------------------- events/profiles
    @cached_property
    def events(self) -> DataFrame:
        return map_events(self.raw("events"))

    @cached_property
    def profiles(self) -> DataFrame:
        e = self.raw("events").where(F.col("user_id") % 4 != 0)
        one = e.groupBy(F.col("user_id").alias("profile_id")).agg(F.max("ts").alias("last_seen"))
        # a few devices are shared by two partners
        step = F.when(F.col("profile_id") % 37 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return one.withColumn("step", F.explode(step)).select(
            "profile_id", ((F.col("profile_id") + F.col("step")) % self.n_sup).alias("partner_id"),
            (F.col("profile_id") % 29 == 1).alias("deleted"), "last_seen")

    # ---------------------------------------------------------- partner tables
    @cached_property
    def rosters(self) -> DataFrame:
        s = self.raw("supplier")
        r = F.col("s_suppkey") % 10
        return s.select(
            F.col("s_suppkey").alias("partner_id"),
            F.when(F.col("s_suppkey") % 23 == 1, "eligible").when(r <= 4, "enrolled").when(r <= 6, "eligible")
            .otherwise("rest").alias("category"),
            F.when(F.col("s_suppkey") % 29 == 2, F.lit(None)).when(r <= 3, F.lit(1)).when(r == 4, F.lit(2)).alias("flow"),
            (F.col("s_suppkey") == 0).alias("is_test"),
        )

    @cached_property
    def overlay(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        has_rate = k % 7 == 3
        return s.select(
            k.alias("partner_id"),
            F.when(k % 5 == 1, F.date_add(F.lit("1998-07-01").cast("date"), (k % 28).cast("int"))).alias("joined"),
            F.when(has_rate, F.lit(300)).alias("rate_before"),
            F.when(has_rate, F.when(k % 2 == 0, F.lit(750)).otherwise(F.lit(1000))).alias("rate_after"),
            F.when(has_rate, F.lit("1998-07-27").cast("date")).alias("switch"),
            F.when(has_rate, k % 4).alias("inst_before"),  # as the overlay file states them
            F.when(has_rate, k % 3).alias("inst_after"),
        ).where(F.col("joined").isNotNull() | F.col("rate_after").isNotNull())

    @cached_property
    def optins(self) -> DataFrame:
        o = self.raw("orders").where(F.col("o_orderstatus") == "F")
        return o.select((F.col("o_custkey") % self.n_sup).alias("partner_id"), F.col("o_orderdate").alias("opted_at"))

    @cached_property
    def audits(self) -> DataFrame:
        o = self.raw("orders").where(F.col("o_orderstatus") == "P")
        return o.select((F.col("o_custkey") % self.n_sup).alias("partner_id"),
                        F.col("o_orderdate").alias("scan_complete_at"))

    @cached_property
    def quality(self) -> DataFrame:
        s = self.raw("supplier")
        t = F.col("s_nationkey") % 5
        tier = (F.when(t == 0, "very_good").when(t == 1, "good").when(t == 2, "average")
                .when(t == 3, "poor"))
        return s.select(
            F.col("s_suppkey").alias("partner_id"),
            tier.alias("tier"),
            F.when(F.col("s_suppkey") % 3 == 0, 100 * (F.col("s_suppkey") + 1)).alias("amount"),
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.spark.createDataFrame(INVENTORY, "event_name string, campaign string")

    @cached_property
    def accounts(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(F.col("s_name").alias("account_name"), F.col("s_suppkey").alias("partner_id"))


def _sql_map(mapping: dict, pos: int | None = None) -> str:
    """A Spark SQL map literal built from a fixed-value table (NULL entries left out)."""
    parts = []
    for k, v in mapping.items():
        val = v if pos is None else v[pos]
        if val is not None:
            parts.append(f"{k}, '{val}'")
    return f"map({', '.join(parts)})"


def map_attempts(li: DataFrame) -> DataFrame:
    """attempts <- lineitem, batch or stream. SQL-text projection: one analyzer call instead of hundreds of Column round trips."""
    pre = li.selectExpr(
        "*", "CAST((l_partkey + 3 * l_linenumber) % 20 AS INT) AS h",
        "(l_returnflag = 'A' AND l_quantity > 10) AS otp",
        "CASE WHEN l_partkey % 10 < 7 THEN l_shipdate END AS slot_at")
    return pre.selectExpr(
        "l_suppkey AS partner_id",
        "CAST(FLOOR(l_orderkey / 4) AS BIGINT) AS connection_id",
        "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, "
        "CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS attempt_id",
        f"try_element_at({_sql_map(STATE_BLOCK, 0)}, h) AS current_state",
        f"try_element_at({_sql_map(STATE_BLOCK, 1)}, h) AS reason_code",
        f"try_element_at({_sql_map(STATE_BLOCK, 2)}, h) AS failure_reason",
        f"try_element_at({_sql_map(STATE_BLOCK, 3)}, h) AS failure_subreason",
        "concat('zone_', l_partkey % 40) AS zone_id",
        "CASE WHEN (otp OR l_linenumber >= 6 OR l_linestatus = 'O') AND l_partkey % 101 <> 3 THEN concat('t', l_partkey % 50) END"
        " AS executor_id",
        "otp AS otp_verified",
        "l_linenumber AS completed_step",
        "timestampadd(MINUTE, CAST((l_partkey * 7 + l_linenumber * 131) % 1440 AS INT), l_shipdate) AS updated_at",
        "timestampadd(MINUTE, CAST(-1440 * (l_partkey % 10 + 1) AS INT), l_shipdate) AS created_at",
        "slot_at AS confirmed_slot_at",
        "CAST(timestampadd(MINUTE, -1440, timestampadd(MINUTE, CAST(1440 * (l_suppkey % 3) AS INT), slot_at)) AS DATE)"
        " AS confirmed_slot_date",
        "CASE WHEN l_partkey % 10 < 8 THEN CAST(l_shipdate AS DATE) END AS proposed_slot_date",
        "CASE WHEN l_linenumber = 6 THEN l_shipdate END AS installation_completed_at",
        "l_partkey % 17 <> 0 AS active",
    )


def map_events(e: DataFrame) -> DataFrame:
    """events <- raw events (view -> banner_opened), batch or stream."""
    return e.select(
        "event_id",
        F.col("user_id").alias("profile_id"),
        F.when(F.col("event_type") == "view", "banner_opened").otherwise(F.col("event_type")).alias("event_name"),
        "ts",
        (F.col("event_id") % 31 == 5).alias("deleted"),
        F.concat(F.lit("cmp_"), F.col("event_id") % 3).alias("campaign"),
    )
