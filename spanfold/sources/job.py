"""Parameters of one roll-up job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# Fixed values of the output layout and of the accepted grains.
SUMMARY_DIR = "assignmentSummary"
SUMMARY_KIND = "HouseholdByIpClientSummary"
REJECTS_DIR = "assignmentRejects"
FINE_GRAINS = ("Hourly", "Daily")
COARSE_GRAINS = ("Daily", "Monthly")


@dataclass(frozen=True)
class JobParameters:
    customer_ids: tuple[int, ...]
    date_from: datetime
    date_to: datetime
    grain_from: str = "Daily"
    grain_to: str = "Monthly"
    base_dir: str = ""
    input_dir: str = ""
    name: str | None = None

    def __post_init__(self) -> None:
        if not self.customer_ids:
            raise ValueError("no customer ids given")
        if self.grain_from not in FINE_GRAINS:
            raise ValueError(f"grain_from must be one of {FINE_GRAINS}: {self.grain_from}")
        if self.grain_to not in COARSE_GRAINS:
            raise ValueError(f"grain_to must be one of {COARSE_GRAINS}: {self.grain_to}")
        if self.grain_from == self.grain_to:
            raise ValueError(f"grain_from and grain_to must differ: {self.grain_to}")
        if self.date_from >= self.date_to:
            raise ValueError(f"the window ends at {self.date_to}, not after {self.date_from}")

    @property
    def job_name(self) -> str:
        return self.name or "cust=" + "_".join(str(c) for c in self.customer_ids)

    @property
    def input_path(self) -> str:
        """Rows of the finer grain, partitioned by customer and day (and hour)."""
        return f"{self.input_dir}{self.grain_from}"

    @property
    def output_path(self) -> str:
        return f"{self.base_dir}{SUMMARY_DIR}/{self._place}"

    @property
    def rejects_path(self) -> str:
        """Input rows that the roll-up could not place."""
        return f"{self.base_dir}{REJECTS_DIR}/{self._place}"

    @property
    def _place(self) -> str:
        def stamp(t: datetime) -> str:
            return t.strftime("%Y_%m_%d_%H_%M")

        return (
            f"{SUMMARY_KIND}/{self.job_name}/tailored/"
            f"y={self.date_from.year}/dt=d{stamp(self.date_from)}_to_{stamp(self.date_to)}"
        )
