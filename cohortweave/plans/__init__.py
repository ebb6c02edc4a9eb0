"""User-level jobs: ingest, cohort build, cohort query and exploration."""
