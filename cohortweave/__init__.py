"""Cohort harmonization and analytics expressed as Spark DataFrame jobs."""
