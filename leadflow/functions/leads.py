"""Column-level lead predicates and classifications (pure Column expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadflow.functions.timecols import local_date

# fixed values: states that make an attempt an open install ticket
OPEN_TICKET_STATES = (
    "ACCEPTED", "AWAITING_SLOT_PROPOSAL", "SLOT_SELECTED", "AWAITING_CUSTOMER_SLOT_CONFIRMATION",
    "SLOT_CONFIRMED_BY_CUSTOMER", "SLOT_AUTO_CONFIRMED", "AWAITING_TECHNICIAN_ASSIGNMENT", "TECHNICIAN_ASSIGNED",
    "ARRIVED_AT_SITE", "INSTALLATION_IN_PROGRESS_PRE_FEE", "FEE_COLLECTION_PENDING",
    "INSTALLATION_IN_PROGRESS_POST_FEE", "AWAITING_CUSTOMER_OTP",
)

# fixed values: ticket state rank (higher = further along); any other open state ranks 1
TICKET_RANK = {
    "ARRIVED_AT_SITE": 8,
    "TECHNICIAN_ASSIGNED": 7,
    "AWAITING_TECHNICIAN_ASSIGNMENT": 6,
    "SLOT_CONFIRMED_BY_CUSTOMER": 5,
    "SLOT_AUTO_CONFIRMED": 5,
    "AWAITING_CUSTOMER_SLOT_CONFIRMATION": 4,
    "SLOT_SELECTED": 3,
    "AWAITING_SLOT_PROPOSAL": 2,
}

# buckets that never enter a denominator
EXCLUDED_BUCKETS = ("open", "system_other")

# ledger outcomes that count as an onsite lead / an install
ONSITE_OUTCOMES = ("ON_TIME_ACTIVE", "LATE_ACTIVE", "REPORTED_FAILED", "CANCELLED_ONSITE")
INSTALL_OUTCOMES = ("ON_TIME_ACTIVE", "LATE_ACTIVE")


def is_installed(strict: bool = True) -> Column:
    """OTP verified OR completed timestamp (strict only) OR step >= 7; never NULL."""
    cond = F.coalesce(F.col("otp_verified"), F.lit(False)) | F.coalesce(F.col("completed_step") >= 7, F.lit(False))
    if strict:
        cond = cond | F.col("installation_completed_at").isNotNull()
    return cond


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int, NULL counted as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def lead_bucket(variant: str = "full") -> Column:
    """Ordered terminal-outcome classification of a collapsed lead (first match wins).

    Needs columns has_installed, reached_slot, last_state, rc, fr, fsc.
    ``legacy`` is the 11-way dashboard variant without csp_retryx / install_expired.
    """
    st, rc, fr, fsc = F.col("last_state"), F.col("rc"), F.col("fr"), F.col("fsc")
    up = st == "CANCELLED_BY_UPSTREAM"
    cust = st == "CANCELLED_BY_CUSTOMER"
    b = (F.when(F.col("has_installed") == 1, "installed")
         .when(st == "DECLINED", "csp_denied")
         .when(up & (fr == "TIMEOUT_P74") & (fsc == "CSP_NO_SHOW") & (rc == "ALLOCATION_ACCEPTED"), "csp_no_show")
         .when(fsc == "CSP_NO_SHOW", "csp_abandoned")
         .when(up & (rc == "TIMEOUT_P41"), "csp_timeout")
         .when(cust & (F.col("reached_slot") == 1), "cust_cancel_after_slot")
         .when(cust & (F.col("reached_slot") == 0), "cust_cancel_before_slot")
         .when(st == "INSTALLATION_REPORTED_FAILED", "install_failed"))
    if variant == "full":
        b = b.when(up & (rc == "RETRY_EXHAUSTION"), "csp_retryx")
    b = b.when(up, "system_other").when(st == "INSTALLATION_CANCELLED_ONSITE", "cancelled_onsite")
    if variant == "full":
        b = b.when(st == "INSTALLATION_EXPIRED", "install_expired")
    return b.otherwise("open")


def is_open_ticket() -> Column:
    return F.col("current_state").isin(*OPEN_TICKET_STATES)


def ticket_rank() -> Column:
    r = None
    for state, rank in TICKET_RANK.items():
        r = F.when(F.col("current_state") == state, rank) if r is None else r.when(F.col("current_state") == state, rank)
    return r.otherwise(1)


def is_on_time(offset_minutes: int = 330) -> Column:
    """Installed, and the local completion date is on/before the confirmed slot date."""
    done = F.coalesce(F.col("installation_completed_at"), F.lit(None))
    return (is_installed(True) & done.isNotNull() & F.col("confirmed_slot_date").isNotNull()
            & (local_date(done, offset_minutes) <= F.col("confirmed_slot_date")))


def ticket_no(attempt_id: Column) -> Column:
    """'#' + last four characters of the attempt id."""
    return F.concat(F.lit("#"), F.right(attempt_id, F.lit(4)))
