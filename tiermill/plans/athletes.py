"""Presets: average height and weight of athletes per sport, medal, sex and country."""

from __future__ import annotations

from tiermill.operators.messages import string_schema
from tiermill.plans.medallion import Dataset, Report

# Dataset, topic and column names of the athlete data.
BIO = "athlete_bio"
RESULTS = "athlete_event_results"
OUTPUT = "v_athlete_event_results_output"
KEY = "athlete_id"
RESULT_FIELDS = (
    "edition", "edition_id", "country_noc", "sport", "event", "result_id", "athlete", "athlete_id", "pos", "medal",
    "isTeamSport",
)
BIO_TEXT_COLUMNS = ("name", "sex", "born", "country", "country_noc", "description", "special_notes")
RESULT_TEXT_COLUMNS = ("edition", "country_noc", "sport", "event", "pos", "medal")
MEASURES = ("height", "weight")
FACT_KEYS = ("sport", "medal", "country_noc")
DIMENSION_KEYS = ("sex",)
OUTPUT_KEY = "sport"
OUTPUT_COLUMNS = ("sport", "medal", "sex", "country_noc", "avg_height", "avg_weight", "timestamp")

RESULT_SCHEMA = string_schema(RESULT_FIELDS)

REPORT = Report(
    facts=Dataset(RESULTS, text_columns=RESULT_TEXT_COLUMNS, infer=False),
    dimension=Dataset(BIO, text_columns=BIO_TEXT_COLUMNS, numeric_columns=MEASURES, infer=False),
    on=(KEY, KEY),
    fact_keys=FACT_KEYS,
    dimension_keys=DIMENSION_KEYS,
    dimension_measures=MEASURES,
    key_type="string",
    columns=OUTPUT_COLUMNS,
)
