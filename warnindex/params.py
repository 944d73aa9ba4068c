"""Parameters of the duration, scoring and index rules.

Everything tunable is a frozen dataclass; the calculators take them as
arguments so one job can run with any rule set.  Durations are resolved to
whole seconds and weights to integers, or to decimals of four places, so that
every sum the library takes is exact; hours are derived once, after aggregation.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values (must equal the published rule for results to agree)
# ---------------------------------------------------------------------------
# Severity text -> level, matched after stripping, dropping one leading
# "Update " and lower-casing.
SEVERITY_LEVELS = {
    "severe flood warning": 1,
    "flood warning": 2,
    "flood alert": 3,
    "flood watch": 3,
    "warning no longer in force": 4,
}
# Default duration in hours by level; any other or null level gets 24.
DEFAULT_DURATION_HOURS = {1: 12.0, 2: 24.0, 3: 48.0, 4: 0.0}
FALLBACK_DURATION_HOURS = 24.0
# Severity weight by level; any other or null level gets 0.
SEVERITY_WEIGHTS = {1: 3, 2: 2, 3: 1, 4: 0}
FALLBACK_WEIGHT = 0
# A gap strictly longer than this many hours starts a new event.
MAX_GAP_HOURS = 72.0
# Composite weights (fluvial, coastal); must sum to 1.
FLUVIAL_WEIGHT = 0.55
COASTAL_WEIGHT = 0.45
# Quality: change time minus raise time above this many whole days is flagged.
MAX_WARNING_DURATION_DAYS = 14
# Completeness below this percentage is a warning, else info.
COMPLETENESS_WARN_PCT = 50.0
# Trend reports start at this year.
TREND_FIRST_YEAR = 2020
# Words in riverOrSea text that mark a coastal/tidal area (substring, lower case).
COASTAL_KEYWORDS = ("severn estuary", "sea", "tidal", "coast", "bristol channel")
# Raw source column -> schema column.
RAW_COLUMN_NAMES = {
    "DATE": "timeRaised",
    "CODE": "fwdCode",
    "TYPE": "severity",
    "WARNING / ALERT AREA NAME": "label",
    "AREA": "area_ref",
}
# Tokens read as null in CSV input (besides the empty field).
CSV_NULL_TOKENS = ("null", "NULL", "None")
# Levels reported in the severity breakdown.
BREAKDOWN_LEVELS = (1, 2, 3)
VALID_LEVELS = (1, 2, 3, 4)
# Optional columns whose completeness is reported.
OPTIONAL_COLUMNS = ("timeSeverityChanged", "timeMessageChanged", "isTidal")
TIMESTAMP_COLUMNS = ("timeRaised", "timeSeverityChanged", "timeMessageChanged")
REQUIRED_COLUMNS = ("fwdCode", "severityLevel", "timeRaised")
DURATION_REQUIRED_COLUMNS = ("fwdCode", "timeRaised", "severityLevel", "severity")
# Example rows attached to a quality issue.
ISSUE_EXAMPLES = 3
COVERAGE_EXAMPLES = 5
# Published baseline of the original region.
PUBLISHED_BASELINE_VALUES = {
    "year": 2020,
    "fluvial_score": 1051.6469444444444,
    "coastal_score": 2410.5730555555556,
    "total_score": 3462.2200000000003,
    "fluvial_hours": 1051.6469444444444,
    "coastal_hours": 2338.5730555555556,
    "fluvial_events": 23,
    "coastal_events": 72,
}
# ---------------------------------------------------------------------------
# Weights with a fraction are DECIMAL(9,4).
WEIGHT_DIGITS, WEIGHT_PLACES = 9, 4


def _whole_seconds(hours: float) -> int:
    secs = hours * 3600.0
    if not math.isclose(secs, round(secs), abs_tol=1e-6):
        raise ValueError(f"duration {hours} h is not a whole number of seconds")
    return int(round(secs))


@dataclass(frozen=True)
class DurationParams:
    """Rule for turning a message and its gap to the next one into a duration."""

    default_hours: dict = field(default_factory=lambda: dict(DEFAULT_DURATION_HOURS))
    fallback_hours: float = FALLBACK_DURATION_HOURS
    max_gap_hours: float = MAX_GAP_HOURS
    weights: dict = field(default_factory=lambda: dict(SEVERITY_WEIGHTS))
    fallback_weight: float = FALLBACK_WEIGHT
    # "year": gaps never cross a calendar year (each year's file on its own);
    # "all": gaps run across the whole frame.
    gap_scope: str = "year"
    # Width of the time buckets that split one area's window (skew guard).
    bucket_seconds: int = 3_600
    # Optional second level: bucket heads are ordered within coarse buckets
    # of this width, so ``bucket_seconds`` can go down to 1 s while every
    # window stays bounded (a multiple of ``bucket_seconds``; None = one level).
    coarse_bucket_seconds: int | None = None

    def __post_init__(self):
        if self.gap_scope not in ("year", "all"):
            raise ValueError("gap_scope must be 'year' or 'all'")
        if self.bucket_seconds <= 0:
            raise ValueError("bucket_seconds must be positive")
        if self.coarse_bucket_seconds is not None and (
            self.coarse_bucket_seconds < 2 * self.bucket_seconds or self.coarse_bucket_seconds % self.bucket_seconds
        ):
            raise ValueError("coarse_bucket_seconds must be a multiple (>= 2) of bucket_seconds")
        # durations must be whole seconds and weights fit their type (checked here, not at first use)
        _ = (self.default_seconds, self.fallback_seconds, self.max_gap_seconds, self.exact_weights)

    @property
    def default_seconds(self) -> dict:
        return {int(k): _whole_seconds(v) for k, v in self.default_hours.items()}

    @property
    def fallback_seconds(self) -> int:
        return _whole_seconds(self.fallback_hours)

    @property
    def max_gap_seconds(self) -> int:
        return _whole_seconds(self.max_gap_hours)

    @property
    def exact_weights(self) -> dict:
        """Weights by level, and the fallback under None: ints, or decimals of
        four places as soon as one of them has a fraction."""
        given = {**{int(k): v for k, v in self.weights.items()}, None: self.fallback_weight}
        exact = {k: Decimal(repr(v)) if isinstance(v, float) else Decimal(v) for k, v in given.items()}
        for v in exact.values():
            if not v.is_finite() or v != round(v, WEIGHT_PLACES) or abs(v) >= 10 ** (WEIGHT_DIGITS - WEIGHT_PLACES):
                raise ValueError(f"weight {v} does not fit DECIMAL({WEIGHT_DIGITS},{WEIGHT_PLACES})")
        if all(v == int(v) for v in exact.values()):
            return {k: int(v) for k, v in exact.items()}
        return {k: round(v, WEIGHT_PLACES) for k, v in exact.items()}

    @property
    def weight_type(self) -> str:
        whole = all(isinstance(v, int) for v in self.exact_weights.values())
        return "BIGINT" if whole else f"DECIMAL({WEIGHT_DIGITS},{WEIGHT_PLACES})"

    @property
    def int_weights(self) -> dict:
        return {k: int(v) for k, v in self.exact_weights.items() if k is not None}


@dataclass(frozen=True)
class Baseline:
    """Scores of the reference year; indices are score / baseline * 100."""

    year: int
    fluvial_score: float
    coastal_score: float
    total_score: float
    fluvial_hours: float = 0.0
    coastal_hours: float = 0.0
    fluvial_events: int = 0
    coastal_events: int = 0


@dataclass(frozen=True)
class IndexParams:
    """Composite weights and where the baseline comes from.

    ``baseline`` set: fixed scores.  Otherwise the annual scores of
    ``baseline_year`` (or, if that is None, the earliest year in the data)
    become the baseline.
    """

    fluvial_weight: float = FLUVIAL_WEIGHT
    coastal_weight: float = COASTAL_WEIGHT
    baseline: Baseline | None = None
    baseline_year: int | None = None

    def __post_init__(self):
        # Weight-sum check with a float tolerance (driver side).
        total = self.fluvial_weight + self.coastal_weight
        if not math.isclose(total, 1.0):
            raise ValueError(f"the two class weights add up to {total}, not to 1")


PUBLISHED_BASELINE = Baseline(**PUBLISHED_BASELINE_VALUES)
