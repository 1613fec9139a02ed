"""Parameters with the defaults that define the semantics."""

from __future__ import annotations

from dataclasses import dataclass, replace


# --- fixed values: these must equal the surveyed application's -------------
# Late threshold (minutes, inclusive), long-haul distance (km), home airport,
# earth radius (km), midnight-rollover limit (minutes, strict), start of the
# suspect-rain period, category cap, training clip, test share, seed, boosting
# rounds and rate, importance sample size and repeats.
LATE_MIN = 15.0
LONG_HAUL_KM = 3500.0
HOME_CODE = "LSZH"
EARTH_RADIUS_KM = 6371.0
ROLLOVER_MIN = -720.0
BAD_RAIN_FROM = "2020-11-11"
MAX_CATEGORIES = 60
CLIP_LO, CLIP_HI = -60.0, 180.0
TEST_SHARE = 0.2
SEED = 42
MAX_ITER = 120
LEARNING_RATE = 0.1
IMPORTANCE_ROWS = 8000
IMPORTANCE_REPEATS = 2
# Missing-value markers of the flight file and of the airport file.
FLIGHT_NULL_TOKENS = ("-", "#N/A", "")
AIRPORT_NULL_TOKENS = ("\\N", "")
# Direction codes of the flight file.
DIRECTION_CODES = {"S": "departure", "L": "arrival"}
# Load bins (flights in the same planned hour), right-closed.
LOAD_EDGES = (0, 20, 30, 40, 50, 60, 100)
LOAD_LABELS = ("1–20", "21–30", "31–40", "41–50", "51–60", "more than 60")
# Weather bins, left-closed: edges and labels per variable.
WEATHER_BINS = {
    "wpgt": ((0, 30, 40, 50, 60, 75, 250), ("< 30", "30–40", "40–50", "50–60", "60–75", "≥ 75")),
    "prcp": ((0, 1, 5, 15, 250), ("dry (< 1)", "1–5", "5–15", "≥ 15")),
    "tavg": ((-20, 0, 5, 10, 15, 20, 40), ("< 0", "0–5", "5–10", "10–15", "15–20", "≥ 20")),
    "tmin": ((-20, -3, 0, 5, 10, 15, 40), ("< −3", "−3–0", "0–5", "5–10", "10–15", "≥ 15")),
    "wspd": ((0, 5, 10, 15, 20, 60), ("< 5", "5–10", "10–15", "15–20", "≥ 20")),
    "pres": ((900, 1005, 1012, 1018, 1025, 1100), ("< 1005", "1005–1012", "1012–1018", "1018–1025", "≥ 1025")),
}
# Wind classes of the day scatter and actual-delay classes, left-closed.
WIND_EDGES = (0, 40, 60, 250)
WIND_LABELS = ("gusts < 40 km/h", "40–60 km/h", "≥ 60 km/h")
DELAY_CLASS_EDGES = (-2000, 0, 15, 30, 60, 5000)
DELAY_CLASS_LABELS = ("early", "0–15 min", "15–30 min", "30–60 min", "≥ 60 min")
# Histogram of delays: clip range and bin width (minutes).
HIST_LO, HIST_HI, HIST_WIDTH = -60.0, 119.9, 5.0
# Threshold slider range of the confusion view.
THRESHOLD_FROM, THRESHOLD_TO, THRESHOLD_STEP = 0.10, 0.80, 0.05
# Names of weekdays (Monday = 0) and months.
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# Feature sets, cumulative, in the order they are added.
FEATURE_STEPS = (
    ("schedule", ("hour", "weekday", "month", "hour_load", "day_load",
                  "direction", "aircraft", "runway", "airline")),
    ("+ places", ("distance_km", "lat", "lon")),
    ("+ weather", ("tavg", "tmin", "prcp", "wspd", "wpgt", "pres")),
    ("+ previous hour", ("prev_hour_delay",)),
)
CATEGORICAL = ("direction", "aircraft", "runway", "airline")
OTHER = "other"
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Operator parameters; every constant of §1.4 is a field with its default."""

    late_min: float = LATE_MIN
    rollover_min: float = ROLLOVER_MIN
    symmetric_rollover: bool = False
    long_haul_km: float = LONG_HAUL_KM
    earth_radius_km: float = EARTH_RADIUS_KM
    max_categories: int = MAX_CATEGORIES
    clip_lo: float = CLIP_LO
    clip_hi: float = CLIP_HI
    test_share: float = TEST_SHARE
    seed: int = SEED
    max_iter: int = MAX_ITER
    learning_rate: float = LEARNING_RATE
    max_depth: int = 5
    # share of the training days that decides when boosting stops; 0: all rounds
    validation_share: float = 0.1
    validation_tol: float = 0.001
    importance_rows: int | None = None  # all test rows; IMPORTANCE_ROWS samples as many as the application
    importance_repeats: int = IMPORTANCE_REPEATS
    # largest dimension / aggregate (in rows) that may be broadcast
    broadcast_max_rows: int = 2_000_000
    categorical: tuple = CATEGORICAL
    feature_steps: tuple = FEATURE_STEPS

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULTS = Params()
