"""Parameters of the warehouse; nothing in the operators is hard-wired to a data set."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Fixed values.
ORDER_STATUSES = ("Completed", "Returned", "Cancelled", "Pending")
UNKNOWN = "Unknown"
REVENUE_STATUS = "Completed"
PRICE_BAND_EDGES = (0, 1000, 5000, 20000, 100000)
PRICE_BAND_LABELS = ("Budget", "Mid-Range", "Premium", "Enterprise", "Luxury")
SEGMENTS = ("Enterprise", "Smb", "Startup", "Consumer")
REGIONS = ("North", "South", "East", "West", "Central")
CHANNELS = ("Online", "Sales Rep", "Partner", "Direct")
LTV_TIER_NAMES = ("Platinum", "Gold", "Silver", "Bronze")


@dataclass(frozen=True)
class Settings:
    """One run's parameters."""

    # Without bounds the calendar has the whole years from the first to the last order.
    calendar_start: date | None = None
    calendar_end: date | None = None
    # Tenure is counted up to this day, or up to the day of the run.
    as_of: date | None = None
    # Three years side by side, or the last three of the calendar.
    yoy_years: tuple[int, int, int] | None = None
    # Strict lower bounds of Platinum, Gold and Silver; everything else is Bronze.
    ltv_thresholds: tuple[int, int, int] = (500_000, 200_000, 50_000)
    high_value_quantile: float = 0.95
    price_fallback_factor: str = "1.5"
    max_null_percent: float = 5.0
    # CSV sources whose values hold no line breaks: their files are read in parallel, and refused if they do.
    single_line: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        unknown = set(self.single_line) - {"customers", "products", "orders", "order_items"}
        if unknown:
            raise ValueError(f"no CSV source: {', '.join(sorted(unknown))}")
        bounds = (self.calendar_start, self.calendar_end)
        if (None in bounds) != (bounds == (None, None)):
            raise ValueError("the calendar needs both bounds or none")
        if None not in bounds and not 0 <= (self.calendar_end - self.calendar_start).days < 100_000:
            raise ValueError("calendar must span between 1 and 100,000 days")
