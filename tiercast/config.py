"""Settings for one scoring run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# The score scale and the stored audit text.
BUCKETS = 5
LOG_SOURCE = "daily_rfm_pipeline"

CALENDAR = "calendar"
ELAPSED = "elapsed"
RECENCY_MODES = (CALENDAR, ELAPSED)

AUTO = "auto"
WINDOW = "window"
DISTRIBUTED = "distributed"
STRATEGIES = (AUTO, WINDOW, DISTRIBUTED)

# Below this plan size (Catalyst's own estimate, bytes) "auto" ranks with a plain window,
# which needs one task per run date. Unknown sizes count as large.
SMALL_PLAN_BYTES = 8 << 20


@dataclass(frozen=True)
class OrderColumns:
    """SQL expressions that give each order role in a source table."""

    customer_id: str = "customer_id"
    order_id: str = "order_id"
    created_at: str = "created_at"
    total: str = "total"
    status: str = "status"


@dataclass(frozen=True)
class DailyConfig:
    """What to compute. ``run_date`` and ``run_ts`` default to the clock at call time,
    ``recency_mode`` to that of the variant: calendar, or elapsed for the detailed one."""

    run_date: dt.date | None = None
    run_ts: dt.datetime | None = None
    excluded_status: str = "cancelled"
    recency_mode: str | None = None
    strategy: str = AUTO

    def __post_init__(self) -> None:
        if self.recency_mode not in (None, *RECENCY_MODES):
            raise ValueError(f"recency_mode must be one of {RECENCY_MODES}")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")

    def resolved(self, recency_mode: str = CALENDAR) -> DailyConfig:
        """The same settings with the open ones filled in."""
        return replace(
            self,
            run_date=self.run_date or dt.date.today(),
            run_ts=self.run_ts or dt.datetime.now(),
            recency_mode=self.recency_mode or recency_mode,
        )
