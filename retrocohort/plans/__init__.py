"""Whole pipelines: the extracts, the cohort analysis and the reports."""
