"""Whole models: staging, facts, gold marts, reports, data quality."""
