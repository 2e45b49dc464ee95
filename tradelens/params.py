"""Parameters of the studies, as frozen dataclasses.

Operators take these objects (or plain arguments) instead of module globals,
so a caller can re-run any study with other months, weights or thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values that must equal the reference's for identical results ----
# Peak (pre-holiday) season months.
PEAK_MONTHS = (9, 10, 11)
# Partner codes that denote aggregates rather than countries.
AGGREGATE_PARTNER_CODES = (0, 99, 199, 299, 399, 459, 499, 568, 577, 581,
                           711, 829, 838, 839, 879, 899)
# Source spelling -> standard name; None means "drop, not a country".
COUNTRY_NAME_OVERRIDES = {
    "Bolivia (Plurinational State of)": "Bolivia",
    "Iran (Islamic Republic of)": "Iran",
    "Korea, Republic of": "South Korea",
    "Korea, Dem. People's Rep. of": "North Korea",
    "United States of America": "United States",
    "United Rep. of Tanzania": "Tanzania",
    "Russian Federation": "Russia",
    "Viet Nam": "Vietnam",
    "Lao People's Dem. Rep.": "Laos",
    "Syrian Arab Republic": "Syria",
    "Venezuela (Bolivarian Rep. of)": "Venezuela",
    "Türkiye": "Turkey",
    "Czechia": "Czech Republic",
    "Brunei Darussalam": "Brunei",
    "Eswatini": "Swaziland",
    "Cabo Verde": "Cape Verde",
    "Côte d'Ivoire": "Ivory Coast",
    "State of Palestine": "Palestine, State of",
    "China, Hong Kong SAR": "Hong Kong",
    "China, Macao SAR": "Macao",
    "Bosnia Herzegovina": "Bosnia and Herzegovina",
    "Cayman Isds": "Cayman Islands",
    "Dem. People's Rep. of Korea": "North Korea",
    "Dem. Rep. of the Congo": "Congo, The Democratic Republic of the",
    "Dominican Rep.": "Dominican Republic",
    "Norfolk Isds": "Norfolk Island",
    "Rep. of Korea": "South Korea",
    "Rep. of Moldova": "Moldova",
    "Solomon Isds": "Solomon Islands",
    "Turks and Caicos Isds": "Turks and Caicos Islands",
    "Other Asia, nes": None,
    "Areas, nes": None,
    "Bunkers": None,
    "Free Zones": None,
    "Special Categories": None,
}
# Product catalog: code -> (description, category).
PRODUCT_CATALOG = {
    "440929": ("Wood non-coniferous continuously shaped", "Handicraft-Wood"),
    "442090": ("Wooden articles for table/kitchen/indoor", "Handicraft-Wood"),
    "330749": ("Room deodorisers and perfuming preparations", "Handicraft-Fragrance"),
    "130232": ("Mucilages and thickeners from guar seeds", "Guar-Refined"),
    "130239": ("Mucilages and thickeners from other plants", "Guar-Other"),
}
HANDICRAFT_CODES = ("440929", "442090", "330749")
COMMODITY_CODES = ("130232", "130239")
KNOWN_SOURCES = ("COMTRADE", "VOLZA", "ZAUBA", "BAKER_HUGHES", "IMD")
# Risk signal weights (sum to 1).
RISK_WEIGHTS = (
    ("revenue_trend", 0.30),
    ("price_volatility", 0.25),
    ("shipment_irregular", 0.20),
    ("hs_concentration", 0.15),
    ("outlier_rate", 0.10),
)
FX_RATE = 83.0
FX_TABLE = (80.0, 83.0, 85.0, 87.0)
CAPTURE_RATE = 0.30
CRORE = 1e7
CALENDAR_START = "2018-01-01"
CALENDAR_END = "2030-12-31"
# Raw snapshot file name: comtrade_{code6}_{year}_{yyyymmdd}.json
SNAPSHOT_FILE_PATTERN = r"^comtrade_(\d{6})_(\d{4})_(\d{8})\.json$"
# Scenario levels for driver shocks, percent.
SCENARIO_LEVELS = tuple(range(-40, 45, 5))
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskParams:
    weights: tuple = RISK_WEIGHTS
    min_active_months: int = 6
    early_years: tuple = (2019, 2020)
    late_years: tuple = (2022, 2023)
    epsilon: float = 0.01
    band_low_q: float = 0.60
    band_high_q: float = 0.85
    score_min: float = 1.0
    score_max: float = 10.0
    exposure_top_n: int = 15

    def __post_init__(self):
        total = round(sum(w for _, w in self.weights), 9)
        if total != 1.0:
            raise ValueError(f"risk weights must sum to 1, got {total}")


@dataclass(frozen=True)
class SegmentParams:
    start_year: int = 2019
    end_year: int = 2023
    last_year: int = 2023
    min_active_months: int = 6
    k: int = 4
    seed: int = 42
    restarts: int = 10
    max_k_elbow: int = 10
    labels_high: tuple = ("Core", "Rising Star")
    labels_low: tuple = ("Declining", "Untapped")


@dataclass(frozen=True)
class BenchmarkParams:
    base_reporter: str = "India"
    competitors: tuple = ("Vietnam", "Morocco")
    base_year: int = 2023
    capture: float = CAPTURE_RATE
    fx: float = FX_RATE
    fx_table: tuple = FX_TABLE
    gap_threshold: float = 5.0
    world_partner: int = 0


@dataclass(frozen=True)
class ForecastParams:
    season: int = 12
    horizon: int = 6
    initial: int = 36
    step: int = 3
    min_points: int = 36
    z90: float = 1.645
    adf_lags: int = 1
    scenario_levels: tuple = SCENARIO_LEVELS


@dataclass(frozen=True)
class CleanParams:
    peak_months: tuple = PEAK_MONTHS
    aggregate_codes: tuple = AGGREGATE_PARTNER_CODES
    outlier_quantile: float = 0.99
    outlier_min_rows: int = 20
    source_tag: str = "COMTRADE"
    price_scale: int = 4
    dedupe_keys: tuple = ("shipment_date", "dest_iso_alpha3", "hs_code", "fob_usd")
    overrides: dict = field(default_factory=lambda: dict(COUNTRY_NAME_OVERRIDES))
