"""Readers and writers of the raw, harmonized and cohort tiers and of the registry."""
