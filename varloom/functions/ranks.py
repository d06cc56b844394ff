"""Ordered ranks of annotation values, as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank tables.
IMPACT = {"HIGH": 4, "MODERATE": 3, "LOW": 2, "MODIFIER": 1}
REVIEW_STARS = {
    "classified_by_single_submitter": 1,
    "criteria_provided,_single_submitter": 1,
    "classified_by_multiple_submitters": 2,
    "criteria_provided,_multiple_submitters,_no_conflicts": 2,
    "reviewed_by_expert_panel": 3,
    "reviewed_by_professional_society": 4,
    "practice_guideline": 4,
}
HGMD = {"DM": 6, "DM?": 5, "DP": 4, "DFP": 3, "FTV": 2, "FP": 1}
#: Significance by the first substring that occurs, in this order.
SIGNIFICANCE = (
    ("Pathogenic", 8),
    ("pathogenic", 7),
    ("drug", 6),
    ("protect", 5),
    ("risk", 4),
    ("Affect", 4),
    ("association", 4),
    ("certain", 3),
    ("provided", 3),
    ("benign", 2),
    ("Benign", 1),
)
#: Deleterious values of each predictor.
DELETERIOUS = {
    "SIFT": ("D",),
    "LRT": ("D",),
    "FATHMM": ("D",),
    "MetaSVM": ("D",),
    "MetaLR": ("D",),
    "PROVEAN": ("D",),
    "Polyphen2_HDIV": ("D", "P"),
    "Polyphen2_HVAR": ("D", "P"),
    "MutationTaster": ("D", "A"),
    "MutationAssessor": ("H", "M"),
}


def _table(c: Column, ranks: dict[str, int]) -> Column:
    out = F.lit(0)
    for value, rank in ranks.items():
        out = F.when(c == value, rank).otherwise(out)
    return out


def impact_rank(c: Column) -> Column:
    return _table(F.upper(F.trim(c)), IMPACT)


def review_stars(c: Column) -> Column:
    return _table(F.lower(F.trim(c)), REVIEW_STARS)


def hgmd_rank(c: Column) -> Column:
    return _table(F.upper(F.trim(c)), HGMD)


def significance_rank(c: Column) -> Column:
    out = F.lit(0)
    for part, rank in reversed(SIGNIFICANCE):
        out = F.when(c.contains(part), rank).otherwise(out)
    return out


def deleterious_votes(columns: list[str]) -> Column:
    """How many of the predictor columns hold a deleterious value among their &-separated ones."""
    votes = F.lit(0)
    for name in columns:
        hit = F.arrays_overlap(F.split(F.col(name), "&"), F.array(*map(F.lit, DELETERIOUS[name])))
        votes = votes + F.coalesce(hit, F.lit(False)).cast("int")
    return votes
