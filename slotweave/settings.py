"""Thresholds and fixed values of the count-series model."""

from __future__ import annotations

from dataclasses import dataclass

#: What identifies a direction-slot's place: location, device, direction.
KEYS = ["SITE_SK", "COUNTER_SK", "DIRECTION_SK"]
SLOTS_A_DAY = 96

# The actions of decisions in the order in which they apply, those that change nothing, and the marks that they leave.
ACTIONS = ("zero_fill", "drop_duplicates", "subtract_other", "missing", "scale", "direction_unreliable")
NOTES = ("uncertain", "restore")
FIXES = ("drop_duplicates", "subtract_other", "missing", "scale")
WORKDAY_TYPE = "Weekday (excl. PH)"
CAMERA = "CAMERA"


@dataclass(frozen=True)
class Settings:
    zone: str = "Australia/Sydney"
    utc_vendors: tuple[str, ...] = ("VivaCity",)
    #: Non-zero slots of a day that, all on one quarter of the hour, make it hourly data.
    hourly_min_nonzero: int = 8
    #: Valid slots of a complete day.
    complete_slots: int = 90
    #: Non-zero slots of an all-even run, and days on either side that it is compared with.
    min_even_nonzero: int = 20
    reference_days: int = 60


DEFAULT = Settings()
