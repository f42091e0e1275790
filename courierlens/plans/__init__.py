"""Staging views, marts, reports, dashboard datasets, models and the whole pipeline."""
