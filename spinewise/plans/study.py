"""What a study fixes: its period, its end, its tolerances, and the names of the spine's columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from spinewise.operators.windowed import Span, anchor_to_date, between_anchors, fixed_period, look_back

PERSON = "pseudonhsno"
PERSON_ALT = "Der_Pseudo_NHS_Number"
ENTITY = "pseudocqcid"


@dataclass(frozen=True)
class Study:
    # The dates and limits of the study.
    period_start: str = "2023-06-01"
    period_end: str = "2023-10-31"
    after_end: str = "2023-11-01"
    lookback_days: int = 365
    tolerance_days: int = 30
    longest_stay: int = 14000
    long_attendance_minutes: int = 720
    score_scale: int = 5

    @property
    def in_both_waves(self) -> Column:
        return (F.col("ascotwave1") == 1) & (F.col("ascotwave2") == 1)

    @property
    def year_before(self) -> Span:
        return look_back("index_wave1", self.lookback_days)

    @property
    def between_waves(self) -> Span:
        return between_anchors("index_wave1", "index_wave2", "_wave", self.in_both_waves)

    @property
    def period(self) -> Span:
        return fixed_period(self.period_start, self.period_end, "_5m")

    @property
    def since_index(self) -> Span:
        return anchor_to_date("index_wave1", self.period_end)
