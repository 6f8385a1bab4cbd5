"""Whole daily jobs, each a composition of operators."""

from .covid import CASE_MEASURES, case_series, covid_daily, covid_forecast, forecast_gold, jhons_gold
from .energy import energy_load
from .snapshot import snapshot_daily, snapshot_gold, snapshot_rows
from .training import prepare_series, train_models
from .tweets import score_tweets, tweets_daily

__all__ = [
    "CASE_MEASURES",
    "case_series",
    "covid_daily",
    "covid_forecast",
    "energy_load",
    "forecast_gold",
    "jhons_gold",
    "prepare_series",
    "score_tweets",
    "snapshot_daily",
    "snapshot_gold",
    "snapshot_rows",
    "train_models",
    "tweets_daily",
]
