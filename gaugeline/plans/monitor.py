"""From readings to verdicts, forecasts and warnings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeline.operators import validate, warnings
from gaugeline.plans import forecast


def validated_records(records: DataFrame, time_col: str = "timestamp", as_of=None) -> DataFrame:
    """Records that pass all rules."""
    return validate.keep_valid(validate.validate(records, time_col, as_of))


def flood_forecast(hourly: DataFrame, stations: DataFrame, scorer="seasonal_naive",
                   as_of=None) -> DataFrame:
    """Risk forecast of every station from its sparse hourly means."""
    return forecast.forecast_all(forecast.recent_series(hourly), stations, scorer, as_of=as_of)


def flood_warnings(hourly: DataFrame, stations: DataFrame, scorer="seasonal_naive",
                   as_of=None) -> DataFrame:
    """Warnings for the stations at risk."""
    return warnings.generate_flood_warnings(flood_forecast(hourly, stations, scorer, as_of), as_of)
