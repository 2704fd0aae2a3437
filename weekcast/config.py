"""Settings shared by the operators.

``REFERENCE`` computes what the original batch job computes; ``CORRECTED``
computes what its formulas were meant to be (see the README for the table of
differences).  Every operator whose result depends on the choice takes a
``semantics`` argument and defaults to ``REFERENCE``.
"""

from __future__ import annotations

from dataclasses import dataclass

REFERENCE = "reference"
CORRECTED = "corrected"

# Parameter names, their defaults and the ranges accepted on entry.
AVERAGE_WINDOW = "average_window"
PREDICT_RANGE = "predict_range"
BASE_DATA = "base_data"
MAX_YEAR_WEEK = "maxyearweek"
PARAMETER_DEFAULTS = {
    AVERAGE_WINDOW: 5,
    PREDICT_RANGE: 5,
    BASE_DATA: 4,
    MAX_YEAR_WEEK: 201627,
}
PARAMETER_RANGES = {
    AVERAGE_WINDOW: (3, 8),
    PREDICT_RANGE: (4, 8),
    BASE_DATA: (4, 20),
}
REFERENCE_BASE_DIVISOR = 4
INACTIVE_AFTER_WEEKS = 7
ZERO_DEMAND_WEEKS = 8


def check_semantics(semantics: str) -> str:
    if semantics not in (REFERENCE, CORRECTED):
        raise ValueError(f"semantics must be {REFERENCE!r} or {CORRECTED!r}, not {semantics!r}")
    return semantics


@dataclass(frozen=True)
class ForecastConfig:
    """Resolved settings of one forecast.

    ``base_back`` is how many weeks before the cut-off week belong to the base
    window, the cut-off week itself being included on top.  ``max_week`` is a
    ``YYYYWW`` label, or ``None`` for "the latest week in the data".
    """

    average_window: int = 5
    predict_range: int = 5
    base_back: int = 3
    max_week: str | None = None
    semantics: str = REFERENCE

    def __post_init__(self):
        check_semantics(self.semantics)
        if self.average_window < 1:
            raise ValueError("average_window must be at least 1")
        if self.base_back < 0:
            raise ValueError("base_back must not be negative")

    @property
    def horizon(self) -> int:
        """Weeks to forecast: never fewer than one."""
        return max(self.predict_range, 1)

    @property
    def base_weeks(self) -> int:
        return self.base_back + 1

    @property
    def base_divisor(self) -> int:
        return REFERENCE_BASE_DIVISOR if self.semantics == REFERENCE else self.base_weeks
