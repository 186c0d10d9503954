"""Operators put together: feature tables, loads, models, forecasts."""
