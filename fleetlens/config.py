"""Parameters of the feature plans."""

from __future__ import annotations

from dataclasses import dataclass

FLAT = "flat"
KEYED = "keyed"


@dataclass(frozen=True)
class FeatureSpec:
    """How readings are binned and rolled.

    ``mode="flat"`` treats all machines as one sequence ordered by (machineID, datetime): rolling
    windows and fills run on from one machine into the next, and the rolling standard deviations
    are placed by position. ``mode="keyed"`` keeps every machine to itself. ``window_rows`` counts
    bins, so 24 bins of three hours span 72 hours.
    """

    bin_seconds: int = 3 * 3600
    window_rows: int = 24
    mode: str = FLAT
    start_after: str = "2015-01-01 00:00:00"
    error_statistic: str = "first"  # "sum" counts every error of a bin, not only its first slot
    chunk_bins: int = 1024
    chunk_rows: int = 65536

    def __post_init__(self) -> None:
        if self.mode not in (FLAT, KEYED):
            raise ValueError(f"mode must be {FLAT!r} or {KEYED!r}, not {self.mode!r}")
        if self.error_statistic not in ("first", "sum"):
            raise ValueError("error_statistic must be 'first' or 'sum'")
