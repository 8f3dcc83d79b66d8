"""Run parameters. The reference hard-codes these in SQL text; here they are arguments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    month_start: dt.date = dt.date(1998, 7, 1)     # month [ms, me) in local (IST) dates
    month_end: dt.date = dt.date(1998, 8, 1)
    prev_start: dt.date = dt.date(1998, 6, 1)      # previous (closed) month
    as_of: dt.datetime = dt.datetime(1998, 8, 15)  # snapshot instant (UTC); rows after it are not yet visible
    window_days: int = 120                          # rolling scan for the open-lead view
    offset_minutes: int = 330                       # UTC -> IST
    s4_cutoff: dt.date = dt.date(1998, 7, 16)      # hybrid gate: slot before/at, tech after
    two_tier_before: str = "1998-08"               # two-tier install rate applies to months < this
    events_since: dt.datetime = dt.datetime(2024, 1, 9)
    funnel_since: dt.datetime = dt.datetime(1998, 7, 9)   # attempts created since (funnel window)
    engagement_start: dt.datetime = dt.datetime(2024, 1, 5, 12, 30)
    engagement_today: dt.date = dt.date(2024, 1, 29)      # the current day of the event feed
    floor: int = 10000
    rate: int = 300
    gate_num: int = 3                               # gate = 3/5 = 0.60, kept as an exact fraction
    gate_den: int = 5
    few_leads: int = 2                              # <= this many leads -> floor protected

    @property
    def month_ym(self) -> str:
        return self.month_start.strftime("%Y-%m")

    @property
    def days_in_month(self) -> int:
        return (self.month_end - self.month_start).days


DEFAULT = Params()
