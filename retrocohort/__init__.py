"""Retrospective cohort studies on OMOP-shaped tables, as Spark DataFrame pipelines."""
