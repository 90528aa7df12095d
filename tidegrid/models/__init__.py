"""Forecast models on Spark ML: training, tuning, bands, registry, forecasts."""
