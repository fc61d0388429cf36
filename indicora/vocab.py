"""Controlled vocabularies.

Everything in this module is a FIXED VALUE: names, thresholds and wording that results must
carry exactly. Nothing here is logic.
"""

from __future__ import annotations

# --- fixed values: country names and spellings ---------------------------------------------
COUNTRIES = [
    "Brunei",
    "Cambodia",
    "Indonesia",
    "Laos",
    "Malaysia",
    "Myanmar",
    "Philippines",
    "Singapore",
    "Thailand",
    "Timor-Leste",
    "Vietnam",
]

# cleaned spelling -> canonical name
COUNTRY_SPELLINGS = {
    "brunei": "Brunei",
    "brunei darussalam": "Brunei",
    "brunnei darussalam": "Brunei",
    "cambodia": "Cambodia",
    "indonesia": "Indonesia",
    "lao pdr": "Laos",
    "laos pdr": "Laos",
    "lao s pdr": "Laos",
    "lao people s democratic republic": "Laos",
    "laos": "Laos",
    "malaysia": "Malaysia",
    "myanmar": "Myanmar",
    "philippines": "Philippines",
    "singapore": "Singapore",
    "thailand": "Thailand",
    "timor leste": "Timor-Leste",
    "viet nam": "Vietnam",
    "vietnam": "Vietnam",
}

# --- fixed values: column roles of raw files, in order of preference ------------------------
COUNTRY_HEADERS = [
    "country",
    "countries",
    "country_name",
    "countries_and_areas",
    "countries_areas",
    "location",
    "member_state",
    "economy",
    "area",
]
YEAR_HEADERS = ["year", "reference_year", "reference_year_s", "date"]
VALUE_HEADERS = [
    "value",
    "indicator_value",
    "rate",
    "amount",
    "percentage",
    "percent",
    "density",
    "prevalence",
]
NON_VALUE_HEADERS = [
    "country",
    "year",
    "indicator",
    "indicators",
    "sub_indicator",
    "sex",
    "unit",
    "source",
    "source_link",
    "remarks",
    "description",
    "reference_year_s",
]
FIRST_YEAR, LAST_YEAR = 1900, 2100

# --- fixed values: indicator names ------------------------------------------------------------
INDICATOR_FILE_NAMES = {"goverment_expence_in_health": "government_expenditure_in_health"}

# metadata label key -> indicators it documents (only the keys that differ from themselves)
METADATA_INDICATORS = {
    "maternal_mortality_rate_death_per_1000_live_births": ["maternal_mortality_rate"],
    "life_expectancy_rate": ["life_expentancy_rate"],
    "children_under_5_moderately_or_severely_underweight_percentage": ["underweight_children"],
    "immunization_against_measles_and_dpt_among_children_of_1_year_old_percentage": [
        "immunization_dpt",
        "immunization_measless",
    ],
    "prevalence_of_malaria_and_tb_percentage": ["malaria_prevalence", "tb_prevalence"],
    "medical_doctors_physicians_per_1_000_population": ["physicans_density"],
    "nurses_and_widwives_per_1_000_population": ["nurses_midwife_density"],
    "pharmaceutical_personnel_per_1_000_population": ["pharmaceutical_worker_density"],
    "prevalence_of_hiv_among_adults_aged_15_to_49": ["hiv_prevalence"],
    "deaths_due_to_hiv_aids": ["death_by_hiv_aids"],
}
METADATA_RENAMES = {
    "cleansed_data": "indicator_label",
    "source_link": "source_url",
    "link_to_issue": "issue_url",
    "cleansed": "is_cleansed",
    "combine": "should_combine",
}
METADATA_REQUIRED = ["indicator_label", "description", "source_url"]
METADATA_OPTIONAL = ["raw_data", "issue_url", "is_cleansed", "should_combine", "remarks"]

# --- fixed values: whether a high value is bad (+1) or good (-1), per scoring profile ----------
DIRECTIONS = {
    "peer_score": {
        "crude_death_ratio": 1,
        "death_by_hiv_aids": 1,
        "hiv_prevalence": 1,
        "infant_mortality_rate": 1,
        "malaria_prevalence": 1,
        "maternal_mortality_rate": 1,
        "tb_prevalence": 1,
        "under_5_mortality_rate": 1,
        "undernourished_population": 1,
        "underweight_children": 1,
        "government_expenditure_in_health": -1,
        "immunization_dpt": -1,
        "immunization_measless": -1,
        "life_expentancy_rate": -1,
        "nurses_midwife_density": -1,
        "pharmaceutical_worker_density": -1,
        "physicans_density": -1,
    },
    "trend_forecast": {
        "crude_death_ratio": 1,
        "hiv_prevalence": 1,
        "infant_mortality_rate": 1,
        "malaria_prevalence": 1,
        "maternal_mortality_rate": 1,
        "tb_prevalence": 1,
        "under_5_mortality_rate": 1,
        "undernourishment_rate": 1,
        "underweight_children": 1,
        "immunization_dpt": -1,
        "immunization_measles": -1,
        "life_expectancy_rate": -1,
    },
    "comparative_score": {
        "crude_death_ratio": 1,
        "hiv_prevalence": 1,
        "infant_mortality_rate": 1,
        "malaria_prevalence": 1,
        "maternal_mortality_rate": 1,
        "tb_prevalence": 1,
        "under_5_mortality_rate": 1,
        "undernourishment_rate": 1,
        "underweight_children": 1,
    },
}

# --- fixed values: event streams ---------------------------------------------------------------
STATION_PATTERN = r"^[A-Z]{2}-[A-Z]{3}-[0-9]{2}$"
SOURCE_TOPIC = "weather-events"
RETRY_DELAYS_SECONDS = [5, 15, 45, 120, 300]
MAX_RETRIES = 5
OUTCOMES = ["accepted", "duplicate", "retry", "dlq"]
QUALITY_ACCEPTED = ("accepted", "Record passed schema validation and was loaded.")

# --- fixed values: disease suitability ----------------------------------------------------------
DISEASES = {
    "dengue": "Dengue",
    "malaria": "Malaria",
    "mosquito_borne": "Mosquito-borne disease",
}
# disease -> (best temperature, temperature width, full rainfall, humidity floor, humidity width)
SUITABILITY = {"dengue": (29.0, 12.0, 200.0, 45.0, 45.0)}
SUITABILITY_OTHER = (27.0, 13.0, 160.0, 40.0, 50.0)
# (weight, evidence threshold, evidence text) for temperature, rainfall, humidity
SUITABILITY_PARTS = [
    (0.4, 0.7, "temperature is favorable for mosquito activity"),
    (0.35, 0.65, "high rainfall may increase mosquito breeding habitat"),
    (0.25, 0.65, "high humidity may support mosquito survival"),
]
DISEASE_ADVICE = (
    "Strengthen vector surveillance and remove standing-water breeding sites.",
    "Prepare targeted public-health messaging and clinical readiness.",
    "Continue routine monitoring and prevention communication.",
)

# --- fixed values: alerts ------------------------------------------------------------------------
SEVERITIES = {"critical": 4, "high": 3, "medium": 2, "low": 1, "info": 0}
EVENT_TYPES = [
    "pipeline_failure",
    "data_quality",
    "api_health",
    "climate_risk",
    "disease_risk",
    "recovery",
]
EVENT_STATUSES = [
    "info",
    "healthy",
    "warning",
    "degraded",
    "error",
    "failed",
    "critical",
    "recovered",
]
RESOLVING_STATUSES = ["recovered", "healthy"]
DEFAULT_EVENT_TYPE = "api_health"

EVIDENCE_LABELS = [
    ("missing_file", "Missing source or output file"),
    ("schema_errors", "Schema validation errors"),
    ("validation_failures", "Record validation failures"),
    ("duplicate_rate", "Duplicate-record rate"),
    ("dlq_count", "Dead-letter queue count"),
    ("retry_count", "Retry count"),
    ("latency_ms", "Observed latency in milliseconds"),
    ("last_success_minutes", "Minutes since last successful run"),
    ("rainfall_mm", "Rainfall in millimetres"),
    ("humidity_pct", "Relative humidity percentage"),
    ("temperature_c", "Temperature in Celsius"),
    ("risk_score", "Health-risk score"),
]

# event type -> (title, [(cause, confidence)], [action], [prevention])
ROOT_CAUSES = {
    "pipeline_failure": (
        "Pipeline delivery failure",
        [
            ("Source data is missing, late, or inaccessible", 0.82),
            ("Schema drift caused validation or transformation failure", 0.74),
            ("A downstream warehouse or storage dependency is unavailable", 0.61),
        ],
        [
            "Retry from the last successful checkpoint.",
            "Route malformed records to the dead-letter queue instead of blocking the batch.",
            "Validate source availability, schema version, and warehouse connectivity.",
        ],
        [
            "Add freshness and schema-contract checks before transformation.",
            "Track retry count, DLQ volume, and checkpoint age as alertable metrics.",
        ],
    ),
    "data_quality": (
        "Data-quality degradation",
        [
            ("Required values are missing or malformed", 0.86),
            ("Duplicate or replayed records bypassed idempotency controls", 0.72),
            ("A source-system definition changed without a matching contract update", 0.65),
        ],
        [
            "Quarantine failing records and preserve accepted records.",
            "Compare the current schema and key fields with the last trusted run.",
            "Re-run validation after correcting the source or transformation rule.",
        ],
        [
            "Version schemas and enforce required-field, range, and uniqueness checks.",
            "Publish quality metrics with every pipeline run.",
        ],
    ),
    "api_health": (
        "API availability or latency incident",
        [
            ("The application process restarted or failed its health check", 0.78),
            ("A required file, model, or database dependency is unavailable", 0.71),
            ("Traffic or a slow dependency increased request latency", 0.58),
        ],
        [
            "Check application logs and the /health endpoint.",
            "Verify processed data and external dependency availability.",
            "Restart the service only after preserving incident evidence.",
        ],
        [
            "Add readiness checks for data, model, and warehouse dependencies.",
            "Track error rate and p95 latency separately from process uptime.",
        ],
    ),
    "climate_risk": (
        "Climate-driven operational pressure",
        [
            ("Heavy rainfall or flooding increased disruption and vector habitat", 0.83),
            ("Heat or humidity moved conditions into a disease-favorable range", 0.76),
            ("Infrastructure disruption delayed health-data delivery", 0.62),
        ],
        [
            "Escalate climate-health surveillance for the affected country.",
            "Pre-position local data buffering and offline continuity procedures.",
            "Validate facilities, transport routes, and communication dependencies.",
        ],
        [
            "Integrate live weather feeds and regional disruption thresholds.",
            "Maintain local cache, delayed synchronization, and failover playbooks.",
        ],
    ),
    "disease_risk": (
        "Elevated disease-risk signal",
        [
            ("Weather conditions are favorable for transmission or vector survival", 0.84),
            ("Historical health indicators show elevated population vulnerability", 0.73),
            ("Recent health observations differ from the expected baseline", 0.66),
        ],
        [
            "Verify the signal with local surveillance and public-health teams.",
            "Increase case surveillance and targeted public-health messaging.",
            "Pre-position diagnostics, treatment supplies, and response staff.",
        ],
        [
            "Continuously recalibrate thresholds with verified outbreak labels.",
            "Keep the model explainable and require human confirmation before action.",
        ],
    ),
    "recovery": (
        "Recovery confirmation",
        [
            ("The affected dependency or data flow returned to a healthy state", 0.90),
            ("Retry, checkpoint replay, or manual correction restored service", 0.76),
        ],
        [
            "Verify data completeness from the last known-good checkpoint.",
            "Resolve related alerts only after health and quality checks pass.",
        ],
        [
            "Record the recovery method and time-to-recovery for future automation.",
        ],
    ),
}

# --- fixed values: service objectives and retention ----------------------------------------------
# name -> (comparison, target)
SLO_TARGETS = {
    "batch_success_rate_pct": (">=", 99.0),
    "duplicate_rate_pct": ("<", 1.0),
    "freshness_hours": ("<=", 24.0),
    "event_latency_seconds": ("<", 60.0),
    "dlq_review_hours": ("<", 24.0),
    "accepted_loss": ("<=", 0.0),
}
RETENTION_MONTHS = {"accepted": 12, "dlq": 12, "metrics": 24}
RETENTION_RETRY_DAYS = 30
