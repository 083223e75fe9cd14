"""The values that stay fixed during one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta


@dataclass(frozen=True)
class RunContext:
    """Clock, week and audit values shared by every pipeline of one run.

    Operators never ask for the current time; they read it here, so a run can be repeated.
    """

    run_ts: datetime
    created_by: str = "supplyprep"
    snapshot_weekday: int = 5
    """Day on which weekly history is kept, 1 = Sunday (5 = Thursday)."""
    version_date: date | None = None
    """Planning version; edges that end before it are expired. Default: Monday of the run week."""

    @property
    def run_date(self) -> date:
        return self.run_ts.date()

    @property
    def version(self) -> str:
        """Feed version string of the run day, ``YYYYMMDD``."""
        return self.run_ts.strftime("%Y%m%d")

    @property
    def week_start(self) -> date:
        """Monday of the run week."""
        return self.run_date - timedelta(days=self.run_date.weekday())

    @property
    def plan_version(self) -> date:
        return self.version_date or self.week_start

    @property
    def year_start(self) -> date:
        return date(self.week_start.year, 1, 1)

    @property
    def calendar_week(self) -> str:
        """Week of the year counted in whole seven-day blocks from 1 January (not the ISO week)."""
        return f"{(self.week_start.timetuple().tm_yday - 1) // 7 + 1:02d}"

    @property
    def is_snapshot_day(self) -> bool:
        return self.run_date.isoweekday() % 7 + 1 == self.snapshot_weekday

    @property
    def receipt_cutoff(self) -> date:
        """Last Thursday strictly after the same day of last week; later movements do not count."""
        start = self.run_date - timedelta(days=7)
        ahead = (3 - start.weekday()) % 7 or 7
        return start + timedelta(days=ahead)
