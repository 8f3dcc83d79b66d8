"""Hand-worked goldens for payout, progress, rounding and the IST rule."""

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from leadflow.functions.arith import pct_half_even, pct_half_up
from leadflow.functions.scalars import zero_pad
from leadflow.functions.timecols import local_date
from leadflow.operators import payout as PO
from leadflow.plans.params import DEFAULT

# a 31-day month with no two-tier rate (flat 300)
AUG = replace(DEFAULT, month_start=dt.date(1998, 8, 1), month_end=dt.date(1998, 9, 1))


def _settle(spark, rows, joined=None):
    df = spark.createDataFrame([(i, d, joined) for i, d in rows], "installs long, denom long, joined date")
    return [(r["total"], r["case"], r["topup"]) for r in PO.settle(df, AUG).collect()]


def test_settlement_full_floor(spark):
    got = _settle(spark, [(35, 42), (22, 36), (9, 12), (0, 0), (1, 2), (21, 38)])
    assert got == [(10500, "above", 0), (10000, "topup", 3400), (10000, "deep", 7300),
                   (10000, "noleads", 10000), (10000, "fewleads", 9700), (6300, "below60", 0)]


def test_settlement_prorata_joined_19th(spark):
    got = _settle(spark, [(17, 25), (10, 15), (4, 5), (0, 0), (1, 2), (3, 8)], joined=dt.date(1998, 8, 19))
    assert [g[0] for g in got] == [5100, 4194, 4194, 4194, 4194, 900]
    assert [g[1] for g in got] == ["above", "topup", "deep", "noleads", "fewleads", "below60"]
    assert [g[2] for g in got] == [0, 1194, 2994, 4194, 3894, 0]


def test_prorata_table(spark):
    days = [1, 10, 20, 25, 31]
    df = spark.createDataFrame([(dt.date(1998, 7, d),) for d in days], "joined date")
    got = [r[0] for r in df.select(PO.prorata(F.col("joined"), dt.date(1998, 7, 1), 31, 10000)).collect()]
    assert got == [10000, 7097, 3871, 2258, 323]


def test_needed_growing_denominator(spark):
    rows = [(7, 14, 0), (9, 12, 0), (2, 11, 0), (0, 0, 0), (9, 17, 0), (3, 7, 0), (0, 0, 4)]
    df = spark.createDataFrame(rows, "installs long, denom long, pending long")
    got = [r[0] for r in df.select(PO.needed("growing")).collect()]
    assert got == [4, 0, 12, 0, 3, 3, 1]


def test_standing_routes(spark):
    rows = [(0, 0, 0, 0), (6, 10, 0, 0), (5, 10, 3, 0), (1, 10, 1, 0), (6, 12, 0, 3)]
    df = spark.createDataFrame(rows, "installs long, denom long, pending long, new_leads long")
    got = [r["screen"] for r in PO.standing(df).collect()]
    assert got == ["noleads", "secured", "almost", "keepgoing", "dropped"]


def test_rounding_modes(spark):
    df = spark.createDataFrame([(1, 8), (5, 8), (1, 3), (0, 0)], "n long, d long")
    up = [r[0] for r in df.select(pct_half_up(F.col("n"), F.col("d"))).collect()]
    even = [r[0] for r in df.select(pct_half_even(F.col("n"), F.col("d"))).collect()]
    assert up == [13, 63, 33, 0]
    assert even == [12, 62, 33, 0]


def test_ist_rollover(spark):
    df = spark.createDataFrame([("1998-06-30 20:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    assert df.select(local_date(F.col("ts"), 330)).first()[0] == dt.date(1998, 7, 1)


def test_zero_pad_never_truncates(spark):
    df = spark.createDataFrame([(42,), (1234567,)], "u long")
    assert [r[0] for r in df.select(zero_pad(F.col("u"))).collect()] == ["000042", "1234567"]


def test_idiv_is_exact_beyond_doubles(spark):
    from leadflow.functions.arith import idiv
    df = spark.createDataFrame([(9007199254740993, 1), (9007199254740993, 2), (-7, 2), (7, 2)], "a long, b long")
    assert [r[0] for r in df.select(idiv(F.col("a"), F.col("b"))).collect()] == [9007199254740993, 4503599627370496, -4, 3]


def test_previous_total_in_the_switch_month(spark):
    """60 installs, 40 at 300 and 20 at 750: 12,000 + 15,000."""
    july = replace(DEFAULT, month_start=dt.date(1998, 7, 1), month_end=dt.date(1998, 8, 1))
    snap = spark.createDataFrame([(7, 60, 70)], "partner_id long, installs long, denom long")
    overlay = spark.createDataFrame([(7, None, 750, dt.date(1998, 7, 27))], "partner_id long, joined date, rate_after int, switch date")
    enrolled = spark.createDataFrame([(7,)], "partner_id long")
    split = spark.createDataFrame([(7, 40, 20)], "partner_id long, inst_before long, inst_after long")
    assert PO.prev_total(snap, overlay, enrolled, july, split).first()["total"] == 27000


def test_settlement_record_splits_at_the_switch_day(spark):
    daily = spark.createDataFrame([(7, dt.date(1998, 7, 26), 40, 45), (7, dt.date(1998, 7, 27), 20, 25), (8, dt.date(1998, 7, 2), 1, 2)],
                                  "partner_id long, last_date date, i_d long, d_d long")
    overlay = spark.createDataFrame([(7, None, 750, dt.date(1998, 7, 27))], "partner_id long, joined date, rate_after int, switch date")
    enrolled = spark.createDataFrame([(7,), (8,), (9,)], "partner_id long")
    got = {r["partner_id"]: (r["installs"], r["denom"], r["inst_before"], r["inst_after"]) for r in PO.settle_record(enrolled, daily, overlay).collect()}
    assert got == {7: (60, 70, 40, 20), 8: (1, 2, None, None), 9: (0, 0, None, None)}


def test_metric_since_enrolment(spark):
    from leadflow.operators import leads as L
    leads = spark.createDataFrame([(1, 7, dt.date(1998, 7, 5), 1, 1), (2, 7, dt.date(1998, 7, 20), 1, 1), (3, 8, dt.date(1998, 7, 5), 0, 1), (4, 7, dt.date(1998, 6, 5), 1, 1)],
                                  "connection_id long, partner_id long, last_date date, has_installed int, tech_assigned int")
    dates = spark.createDataFrame([(7, dt.date(1998, 7, 10))], "partner_id long, joined date")
    run = lambda **k: {r["partner_id"]: (r["installs"], r["denom"]) for r in L.metric_tech(None, DEFAULT, leads=leads, **k).collect()}
    assert run() == {7: (2, 2), 8: (0, 1)} and run(since_enrolment=dates) == {7: (1, 1), 8: (0, 1)}
