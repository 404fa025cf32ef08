"""Whole runs: ingestion, statistical report, dashboard queries, modelling."""
