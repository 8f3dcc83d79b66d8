"""The same logical tables as ``testdata.py``, as DuckDB CTE text for the oracle SQL.

Oracle queries are ``with_fixtures("<more CTEs>, SELECT ...")``: the fixture
CTEs come first, named ``f_<table>`` so they never shadow the raw views.
"""

from __future__ import annotations

_MIN = "to_minutes(CAST({} AS BIGINT))"

FIXTURE_CTES = """
f_nsup AS (SELECT count(*) AS n FROM supplier),
f_attempts AS (
  SELECT l_suppkey AS partner_id,
    CAST(FLOOR(l_orderkey / 4) AS BIGINT) AS connection_id,
    concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(ROUND(l_extendedprice*100) AS BIGINT)) AS attempt_id,
    CASE h WHEN 0 THEN 'DECLINED' WHEN 1 THEN 'CANCELLED_BY_UPSTREAM' WHEN 2 THEN 'CANCELLED_BY_UPSTREAM'
      WHEN 3 THEN 'CANCELLED_BY_CUSTOMER' WHEN 4 THEN 'CANCELLED_BY_CUSTOMER' WHEN 5 THEN 'INSTALLATION_REPORTED_FAILED'
      WHEN 6 THEN 'CANCELLED_BY_UPSTREAM' WHEN 7 THEN 'CANCELLED_BY_UPSTREAM' WHEN 8 THEN 'INSTALLATION_CANCELLED_ONSITE'
      WHEN 9 THEN 'INSTALLATION_EXPIRED' WHEN 10 THEN 'CANCELLED_BY_CUSTOMER' WHEN 11 THEN 'ACCEPTED'
      WHEN 12 THEN 'AWAITING_SLOT_PROPOSAL' WHEN 13 THEN 'SLOT_SELECTED' WHEN 14 THEN 'AWAITING_CUSTOMER_SLOT_CONFIRMATION'
      WHEN 15 THEN 'SLOT_CONFIRMED_BY_CUSTOMER' WHEN 16 THEN 'AWAITING_TECHNICIAN_ASSIGNMENT' WHEN 17 THEN 'TECHNICIAN_ASSIGNED'
      WHEN 18 THEN 'ARRIVED_AT_SITE' WHEN 19 THEN 'AWAITING_CUSTOMER_OTP' END AS current_state,
    CASE h WHEN 1 THEN 'ALLOCATION_ACCEPTED' WHEN 2 THEN 'TIMEOUT_P41' WHEN 6 THEN 'RETRY_EXHAUSTION' WHEN 7 THEN 'OTHER' END AS reason_code,
    CASE h WHEN 1 THEN 'TIMEOUT_P74' END AS failure_reason,
    CASE h WHEN 1 THEN 'CSP_NO_SHOW' WHEN 10 THEN 'CSP_NO_SHOW' END AS failure_subreason,
    concat('zone_', l_partkey % 40) AS zone_id,
    CASE WHEN (otp OR l_linenumber >= 6 OR l_linestatus = 'O') AND l_partkey % 101 <> 3 THEN concat('t', l_partkey % 50) END AS executor_id,
    otp AS otp_verified,
    l_linenumber AS completed_step,
    l_shipdate + to_minutes(CAST((l_partkey*7 + l_linenumber*131) % 1440 AS BIGINT)) AS updated_at,
    l_shipdate - to_minutes(CAST(1440 * (l_partkey % 10 + 1) AS BIGINT)) AS created_at,
    CASE WHEN l_partkey % 10 < 7 THEN l_shipdate END AS confirmed_slot_at,
    CAST(CASE WHEN l_partkey % 10 < 7 THEN l_shipdate END + to_minutes(CAST(1440 * (l_suppkey % 3) AS BIGINT))
         - to_minutes(CAST(1440 AS BIGINT)) AS DATE) AS confirmed_slot_date,
    CASE WHEN l_partkey % 10 < 8 THEN CAST(l_shipdate AS DATE) END AS proposed_slot_date,
    CASE WHEN l_linenumber = 6 THEN l_shipdate END AS installation_completed_at,
    l_partkey % 17 <> 0 AS active
  FROM (SELECT *, (l_partkey + 3*l_linenumber) % 20 AS h,
               (l_returnflag = 'A' AND l_quantity > 10) AS otp FROM lineitem) li
),
f_transitions AS (
  SELECT attempt_id, 'TECHNICIAN_ASSIGNED' AS to_state FROM f_attempts WHERE executor_id IS NOT NULL
),
f_impacted AS (
  SELECT DISTINCT connection_id FROM f_attempts WHERE connection_id % 50 = 0
),
f_ledger AS (
  SELECT o_custkey % (SELECT n FROM f_nsup) AS partner_id,
    CAST(FLOOR(o_orderkey / 30) AS BIGINT) AS connection_id,
    CASE o_orderkey % 8 WHEN 0 THEN 'ON_TIME_ACTIVE' WHEN 1 THEN 'ON_TIME_ACTIVE' WHEN 2 THEN 'ON_TIME_ACTIVE'
      WHEN 3 THEN 'LATE_ACTIVE' WHEN 4 THEN 'REPORTED_FAILED' WHEN 5 THEN 'CANCELLED_ONSITE'
      WHEN 6 THEN 'CUSTOMER_CANCELLED' WHEN 7 THEN 'UPSTREAM_CANCEL_PRE_CONFIRM' END AS terminal_outcome,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_minutes(CAST((o_custkey*37 + o_orderkey) % 1440 AS BIGINT)) END AS terminal_at,
    o_orderkey AS ledger_id
  FROM orders
),
f_users AS (
  SELECT c_custkey AS user_id, c_custkey % (SELECT n FROM f_nsup) AS partner_id,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'OWNER' WHEN 'AUTOMOBILE' THEN 'MANAGER_PLUS'
      WHEN 'MACHINERY' THEN 'MANAGER' ELSE 'STAFF' END AS role,
    CASE WHEN c_acctbal >= 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
    c_custkey % 23 <> 0 AS active
  FROM customer
),
f_events AS (
  SELECT event_id, user_id AS profile_id,
    CASE WHEN event_type = 'view' THEN 'banner_opened' ELSE event_type END AS event_name, ts,
    event_id % 31 = 5 AS deleted, concat('cmp_', event_id % 3) AS campaign
  FROM events
),
f_profiles AS (
  SELECT user_id AS profile_id, (user_id + step) % (SELECT n FROM f_nsup) AS partner_id,
    user_id % 29 = 1 AS deleted, last_seen
  FROM (SELECT user_id, max(ts) AS last_seen FROM events WHERE user_id % 4 <> 0 GROUP BY user_id) devices,
       (VALUES (0), (1)) steps(step)
  WHERE step = 0 OR user_id % 37 = 0
),
f_rosters AS (
  SELECT s_suppkey AS partner_id,
    CASE WHEN s_suppkey % 23 = 1 THEN 'eligible' WHEN s_suppkey % 10 <= 4 THEN 'enrolled' WHEN s_suppkey % 10 <= 6 THEN 'eligible' ELSE 'rest' END AS category,
    CASE WHEN s_suppkey % 29 = 2 THEN NULL WHEN s_suppkey % 10 <= 3 THEN 1 WHEN s_suppkey % 10 = 4 THEN 2 END AS flow,
    s_suppkey = 0 AS is_test
  FROM supplier
),
f_overlay AS (
  SELECT * FROM (
    SELECT s_suppkey AS partner_id,
      CASE WHEN s_suppkey % 5 = 1 THEN DATE '1998-07-01' + CAST(s_suppkey % 28 AS INTEGER) END AS joined,
      CASE WHEN s_suppkey % 7 = 3 THEN 300 END AS rate_before,
      CASE WHEN s_suppkey % 7 = 3 THEN CASE WHEN s_suppkey % 2 = 0 THEN 750 ELSE 1000 END END AS rate_after,
      CASE WHEN s_suppkey % 7 = 3 THEN DATE '1998-07-27' END AS switch,
      CASE WHEN s_suppkey % 7 = 3 THEN s_suppkey % 4 END AS inst_before,
      CASE WHEN s_suppkey % 7 = 3 THEN s_suppkey % 3 END AS inst_after
    FROM supplier) s
  WHERE joined IS NOT NULL OR rate_after IS NOT NULL
),
f_optins AS (
  SELECT o_custkey % (SELECT n FROM f_nsup) AS partner_id, o_orderdate AS opted_at FROM orders WHERE o_orderstatus = 'F'
),
f_audits AS (
  SELECT o_custkey % (SELECT n FROM f_nsup) AS partner_id, o_orderdate AS scan_complete_at FROM orders WHERE o_orderstatus = 'P'
),
f_quality AS (
  SELECT s_suppkey AS partner_id,
    CASE s_nationkey % 5 WHEN 0 THEN 'very_good' WHEN 1 THEN 'good' WHEN 2 THEN 'average' WHEN 3 THEN 'poor' END AS tier,
    CASE WHEN s_suppkey % 3 = 0 THEN 100 * (s_suppkey + 1) END AS amount
  FROM supplier
),
f_inventory AS (
  SELECT * FROM (VALUES ('banner_opened', 'a'), ('signup', 'a'), ('click', 'b'), ('purchase', 'b')) v(event_name, campaign)
),
f_accounts AS (
  SELECT s_name AS account_name, s_suppkey AS partner_id FROM supplier
)"""


def with_fixtures(body: str) -> str:
    """``body`` is either ``"x AS (...), y AS (...) SELECT ..."`` or a bare ``SELECT``."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {FIXTURE_CTES.strip()}\n{body}"
    return f"WITH {FIXTURE_CTES.strip()},\n{body}"
