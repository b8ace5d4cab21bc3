"""Composed recipes: order base table, donor features, news sentiment, forecasts."""
