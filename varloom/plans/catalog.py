"""Importing this module registers every query of the library."""

from varloom.plans import cohort, genome, panel  # noqa: F401
