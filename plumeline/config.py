"""Study configuration: column map, features, phenotypes, model specs, limits.

Everything here is plan-time data.  It never travels through Spark except as
literals inside expressions, so changing a definition changes the plan and
nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Candidate source columns for each standard visit column, in
# order of preference, and the patterns of the repeated code columns.
# --------------------------------------------------------------------------
VISIT_COLUMN_MAP: dict[str, dict[str, object]] = {
    "defaults": {
        "year": ["YEAR", "year"],
        "admit_month": ["AMONTH", "admit_month"],
        "discharge_month": ["DMONTH", "discharge_month"],
        "visit_id": ["KEY", "VISITLINK", "key", "visit_id"],
        "person_key_candidates": ["PERSONKEY", "VISITLINK", "person_key"],
        "dx_primary": ["I10_DX1", "DX1", "dx1"],
        "dx_all_regex": "^(I10_)?DX[0-9]+$",
        "ecause_regex": "^(I10_)?ECODE[0-9]+$|^E_CODE[0-9]+$",
        "zip5": ["ZIP", "ZIPCODE", "ZIP5", "zip", "zip5"],
        "facility_state": ["HOSPST", "STATE", "state"],
        "facility_county_candidates": ["HOSP_COUNTY", "HOSPSTCO", "county"],
        "los_days": ["LOS", "los"],
        "duration_hours": ["DURATION", "duration"],
        "age": ["AGE"],
        "sex": ["FEMALE"],
        "race": ["RACE"],
    },
    "SID": {"dx_admitting_sid": ["I10_DX_Admitting", "DX_ADMITTING", "dx_admitting"]},
    "SEDD": {"dx_reason_sed_sasd": ["I10_DX_Visit_Reason1", "DXREASON1", "dx_reason"]},
    "SASD": {"dx_reason_sed_sasd": ["I10_DX_Visit_Reason1", "DXREASON1", "dx_reason"]},
}

# Overrides of the column map, by source state and source year.
STATE_OVERRIDES: dict[str, dict[str, object]] = {"NC": {}, "CA": {}}
YEAR_OVERRIDES: dict[int, dict[str, object]] = {
    2015: {"dx_all_regex": "^DX[0-9]+$"},
    2016: {},
    2017: {"dx_all_regex": "^I10_DX[0-9]+$"},
}

# The three source databases, in the order their names sort.
DB_TYPES: tuple[str, ...] = ("SASD", "SEDD", "SID")


@dataclass(frozen=True)
class Feature:
    """One exposure: its public id and the variable that carries it."""

    id: str
    source: str
    var: str
    description: str
    agg: str | None = None


# Exposure features.
FEATURES: tuple[Feature, ...] = (
    Feature("hms_smoke_light", "hms", "prop_light_coverage",
            "Proportion of light wilfire smoke cover", "month"),
    Feature("hms_smoke_medium", "hms", "prop_med_coverage",
            "Proportion of medium wilfire smoke cover", "month"),
    Feature("hms_smoke_heavy", "hms", "prop_heavy_coverage",
            "Proportion of heavy wilfire smoke cover", "month"),
    Feature("pm25_dust", "merra2", "dusmass25",
            "Dust surface mass concentration, particles <2.5 μm (kg m⁻³)", "zip-month-year"),
    Feature("pm25_black_carbon", "merra2", "bcsmass",
            "Black carbon surface mass concentration (kg m⁻³)", "daily_max"),
    Feature("ozone_daily_max_8hr", "aqs_daily_44201", "ozone",
            "Daily max 8-hour ozone (ppm)", "daily_8hr_max"),
    Feature("temp_min", "gridmet", "tmmn", "Mean temperature (°C)", "daily"),
    Feature("temp_max", "gridmet", "tmmx", "Maximum temperature (°C)", "daily"),
    Feature("temp_maximum", "terra_climate", "tmax", "Maximum temperature (°C)"),
    Feature("temp_minimum", "terra_climate", "tmin", "Minimum temperature (°C)"),
)

# Monthly variables kept from the exposure source, and the years
# that count as real years in its text year column.
EXPOSURE_VARIABLES: tuple[str, ...] = (
    "prop_light_coverage", "prop_med_coverage", "prop_heavy_coverage",
    "dusmass25", "bcsmass", "tmax", "tmin",
)
EXPOSURE_YEARS: tuple[int, int] = (2010, 2024)


@dataclass(frozen=True)
class Phenotype:
    """A disease defined by ICD code prefixes of the primary diagnosis."""

    name: str
    label: str
    icd9: tuple[str, ...]
    icd10: tuple[str, ...]
    description: str = ""

    @property
    def flag(self) -> str:
        return f"{self.name}_flag"


# Phenotype code prefixes.
PHENOTYPES: tuple[Phenotype, ...] = (
    Phenotype("asthma", "Asthma", ("493",), ("J45",), "Asthma encounters"),
    Phenotype("copd", "COPD", ("491", "492", "496"), ("J44",),
              "Chronic obstructive pulmonary disease"),
    Phenotype("respiratory_infection", "Respiratory Infection",
              ("460", "461", "462", "463", "464", "465", "466", "480", "481", "482", "483",
               "484", "485", "486", "487"),
              ("J00", "J01", "J02", "J03", "J04", "J05", "J06", "J09", "J10", "J11", "J12",
               "J13", "J14", "J15", "J16", "J17", "J18", "J20", "J21", "J22"),
              "Acute upper and lower respiratory infections"),
    Phenotype("cardiovascular", "Cardiovascular Disease",
              ("410", "411", "412", "413", "414"),
              ("I20", "I21", "I22", "I23", "I24", "I25"), "Ischemic heart disease"),
    Phenotype("stroke", "Stroke",
              ("430", "431", "432", "433", "434", "435", "436", "437", "438"),
              ("I60", "I61", "I62", "I63", "I64"), "Cerebrovascular accident"),
    Phenotype("diabetes", "Diabetes", ("250",), ("E10", "E11", "E13"), "Diabetes mellitus"),
    Phenotype("pregnancy", "Pregnancy/Delivery",
              ("630", "631", "632", "633", "634", "635", "636", "637", "638", "639", "640",
               "641", "642", "643", "644", "645", "646", "647", "648", "649", "650", "651",
               "652", "653", "654", "655", "656", "657", "658", "659", "660", "661", "662",
               "663", "664", "665", "666", "667", "668", "669", "670", "671", "672", "673",
               "674", "675", "676", "677", "678", "679", "V22", "V23", "V24", "V27", "V28"),
              ("O",), "Pregnancy and childbirth complications"),
    Phenotype("mental_health", "Mental Health",
              ("290", "291", "292", "293", "294", "295", "296", "297", "298", "299", "300",
               "301", "302", "303", "304", "305", "306", "307", "308", "309", "310", "311",
               "312", "313", "314", "315", "316", "317", "318", "319"),
              ("F",), "Mental and behavioral disorders"),
)


# What names of exposure columns begin with.
EXPOSURE_PREFIXES: tuple[str, ...] = ("hms_", "pm25_", "ozone_", "temp_")


@dataclass(frozen=True)
class ModelSpec:
    """One adjustment set fitted inside one sex stratum."""

    id: str
    strata: str = "all"
    covariates: tuple[str, ...] = ()
    factors: frozenset[str] = field(default_factory=frozenset)
    description: str = ""

    @property
    def formula(self) -> str:
        terms = [f"factor({c})" if c in self.factors else c for c in self.covariates]
        return " + ".join(["{outcome} ~ scale({exposure})", *terms])


def _specs(suffix: str, strata: str, who: str, full: tuple[str, ...]) -> tuple[ModelSpec, ...]:
    season = frozenset({"season"})
    return (
        ModelSpec(f"logit_unadjusted_{suffix}", strata, (), frozenset(), f"Unadjusted - {who}"),
        ModelSpec(f"logit_adjusted_temporal_{suffix}", strata, ("year", "season"), season,
                  f"Temporal adjusted - {who}"),
        ModelSpec(f"logit_adjusted_full_{suffix}", strata, full, season,
                  f"Fully adjusted - {who}"),
    )


# Adjustment sets; sex is a covariate only where it can vary.
_FULL = ("year", "season", "db_type", "age", "female", "race")
_FULL_ONE_SEX = ("year", "season", "db_type", "age", "race")
MODEL_SPECS: tuple[ModelSpec, ...] = (
    *_specs("overall", "all", "All", _FULL),
    *_specs("male", "male", "Males", _FULL_ONE_SEX),
    *_specs("female", "female", "Females", _FULL_ONE_SEX),
)

# The earlier model set, where year and month are both numeric.
# Its third entry also names a covariate that no data set carries, so it is
# reported and left out when it is used (see ``exwas.design.usable_specs``).
LEGACY_MODEL_SPECS: tuple[ModelSpec, ...] = (
    ModelSpec("logit_unadjusted", description="Unadjusted logistic regression"),
    ModelSpec("logit_adjusted_basic", covariates=("year", "month"),
              description="Adjusted for temporal trends"),
    ModelSpec("logit_adjusted_full", covariates=("year", "month", "zip5_cluster"),
              description="Adjusted for temporal + spatial clustering"),
)

# Metrics of the daily-to-monthly rollup.
ROLLUP_METRICS: tuple[str, ...] = (
    "mean", "sum", "max", "p90", "days_available", "days_above_threshold",
)


@dataclass(frozen=True)
class Threshold:
    """A daily limit on every exposure whose id starts with ``prefix``.

    ``unit_factor`` turns the stored unit into the unit of the limit; ``below``
    counts days under the limit (a cold warning) instead of over it.
    """

    id: str
    prefix: str
    value: float
    unit_factor: float = 1.0
    below: bool = False


# Thresholds.  The PM2.5 limits are in micrograms while the
# stored features are in kilograms, hence the factor.
THRESHOLDS: tuple[Threshold, ...] = (
    Threshold("pm25_unhealthy_sensitive", "pm25", 35.5, 1e9),
    Threshold("pm25_unhealthy", "pm25", 55.5, 1e9),
    Threshold("ozone_unhealthy_sensitive", "ozone", 0.070),
    Threshold("temp_heat_warning", "temp", 32.0),
    Threshold("temp_cold_warning", "temp", 0.0, below=True),
)

# Smallest publishable count, precision and geography defaults.
MIN_CELL_SIZE = 11
DATE_PRECISION = "month"
GEOGRAPHIC_PRECISION = "tract"
GEO_MODE = "tract"

# Version label and source names of the daily series.
DAILY_VERSION = "2024-10"
DAILY_SOURCES = {"hms_": "hms_smoke"}
DAILY_DEFAULT_SOURCE = "pm25_aqs"


def layered_map(db_type: str, column_map: Mapping[str, Mapping[str, object]] = VISIT_COLUMN_MAP,
                *, state: str | None = None, year: int | None = None,
                state_overrides: Mapping[str, Mapping[str, object]] = STATE_OVERRIDES,
                year_overrides: Mapping[int, Mapping[str, object]] = YEAR_OVERRIDES,
                ) -> dict[str, object]:
    """Column map of one source: defaults, then database, state and year entries."""
    merged: dict[str, object] = dict(column_map["defaults"])
    merged.update(column_map.get(db_type) or {})
    if state is not None:
        merged.update(state_overrides.get(state) or {})
    if year is not None:
        merged.update(year_overrides.get(year) or {})
    return merged


def feature_names(features: tuple[Feature, ...] = FEATURES) -> dict[str, str]:
    """Variable to exposure id; the first feature wins where two share a variable."""
    names: dict[str, str] = {}
    for feature in features:
        names.setdefault(feature.var, feature.id)
    return names


def select_specs(suffix: str, specs: tuple[ModelSpec, ...] = MODEL_SPECS) -> tuple[ModelSpec, ...]:
    """Specs whose id ends in ``_<suffix>``, for running one stratum at a time."""
    return tuple(s for s in specs if s.id.endswith(f"_{suffix}"))
