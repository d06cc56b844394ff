"""Cohort-scale variant, phenotype and text-corpus analytics as Spark jobs."""
