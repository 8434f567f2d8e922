"""Domain constants, in one place."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    """Thresholds of the marts. ``as_of`` is the only 'today'; nothing reads the clock."""

    as_of: dt.date = dt.date(2024, 1, 31)
    # Durations of the power curve in seconds.
    durations: tuple[int, ...] = (5, 15, 30, 60, 120, 300, 480, 720, 1200, 1800, 3600, 7200, 10800, 14400)
    window_share: float = 0.9
    smooth_s: int = 30
    # Upper ends of the power zones as shares of the threshold power.
    zones: tuple[float, ...] = (0.56, 0.76, 0.91, 1.06, 1.21, 1.51)
    # Names of the zones, and of seconds, minutes and hours behind a number.
    zone_labels: tuple[str, ...] = ("Z1 회복", "Z2 지구력", "Z3 템포", "Z4 임계", "Z5 VO2max", "Z6 무산소", "Z7 신경근")
    time_units: tuple[str, str, str] = ("초", "분", "시간")
    # Sport types by sport.
    sports: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "cycling": ("Ride", "VirtualRide", "MountainBikeRide", "GravelRide", "EBikeRide"),
        "running": ("Run", "TrailRun", "VirtualRun"),
        "swimming": ("Swim",),
        "walking": ("Walk", "Hike"),
    })
    other_sport: str = "other"
    unassigned: str = "unassigned"
    low_cadence: float = 75
    hard_share: float = 0.75
    climb_grade: float = 4.0
    long_ride_s: int = 10_800
    dropout_share: float = 0.2
    recent_days: int = 28
    curve_days: int = 90
    rest_share: float = 0.95
