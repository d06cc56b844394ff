"""Column expressions on alleles, genotypes and missing-value tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "missing".
MISSING = ("NA", ".", "-9", "-1", "nan")


def missing_to_null(c: Column, tokens: tuple[str, ...] = MISSING) -> Column:
    return F.when(~c.isin(*tokens), c)


def plain_chrom(c: Column) -> Column:
    """Upper case, without the CHR prefix."""
    return F.regexp_replace(F.upper(c.cast("string")), "^CHR", "")


def complement(allele: Column) -> Column:
    return F.translate(allele, "ACGT", "TGCA")


def palindromic(a: Column, b: Column) -> Column:
    return complement(a) == b


def canonical_pair(a: Column, b: Column) -> Column:
    """The two alleles in one order, whatever order they come in."""
    return F.concat_ws(":", F.least(F.lower(a), F.lower(b)), F.greatest(F.lower(a), F.lower(b)))


def is_base(a: Column) -> Column:
    return a.rlike("^[ACGT]$")


def variant_type(ref: Column, alt: Column) -> Column:
    """SNP, MNP, INDEL, or MIXED for alternatives (comma list) of different kinds."""
    kinds = F.array_distinct(F.transform(F.split(alt, ","), lambda a: F.when(F.length(a) != F.length(ref), "INDEL").when(F.length(ref) == 1, "SNP").otherwise("MNP")))
    return F.when(F.size(kinds) > 1, "MIXED").otherwise(F.element_at(kinds, 1))


def transition(ref: Column, alt: Column) -> Column:
    return F.concat(ref, alt).isin("AG", "GA", "CT", "TC")


def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix."""
    n = F.least(F.length(a), F.length(b))
    differs = F.filter(F.sequence(F.lit(1), n), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    return F.when(n == 0, 0).otherwise(F.coalesce(F.get(differs, F.lit(0)) - 1, n))


def strip_alleles(pos: Column, ref: Column, alt: Column) -> Column:
    """struct(pos, ref, alt) without the common prefix (the position moves on) and, for equal lengths, without
    the common suffix, one base being kept; an allele with nothing left is '.'."""
    single = (F.length(ref) == 1) & (F.length(alt) == 1)
    n = F.when(single, 0).otherwise(_common(ref, alt))
    r, a = F.substring(ref, n + 1, F.length(ref)), F.substring(alt, n + 1, F.length(alt))
    tail = F.least(_common(F.reverse(r), F.reverse(a)), F.length(a) - 1)
    m = F.when((F.length(r) == F.length(a)) & (F.length(r) > 1), tail).otherwise(0)
    r, a = F.substring(r, F.lit(1), F.length(r) - m), F.substring(a, F.lit(1), F.length(a) - m)
    dot = lambda x: F.when(F.length(x) == 0, ".").otherwise(x)
    return F.struct((pos + n).alias("pos"), dot(r).alias("ref"), dot(a).alias("alt"))


def fix_monomorphic(a: Column, b: Column, panel_a: Column, panel_b: Column) -> Column:
    """array(a, b): an allele 0 filled from the panel pair; both complemented if that gives the panel pair; null
    where neither rule applies."""
    panel, own = F.array(panel_a, panel_b), F.array(a, b)
    shared = F.array_intersect(own, panel)
    other = F.element_at(F.array_except(panel, shared), 1)
    fill = F.array_contains(own, "0") & (F.size(shared) > 0) & (F.length(other) == 1)
    flipped = F.array(complement(a), complement(b))
    same = F.array_sort(F.array_distinct(flipped)) == F.array_sort(F.array_distinct(panel))
    first = F.element_at(shared, 1)
    return F.when(fill, F.when(a == "0", F.array(other, first)).otherwise(F.array(first, other))).when(~F.array_contains(own, "0") & same, flipped)


def hard_call(p11: Column, p12: Column, p22: Column, least: float = 0.9) -> Column:
    """Copies of the second allele by the first probability that reaches `least`, else null."""
    return F.when(p11 >= least, 0).when(p12 >= least, 1).when(p22 >= least, 2)


def gt_alleles(gt: Column) -> Column:
    """array<int> of a GT text, split on / and |; null alleles for '.'."""
    return F.transform(F.split(gt, "[/|]"), lambda a: F.when(a != ".", a.cast("int")))


def gt_dosage(gt: Column) -> Column:
    """Number of alternative alleles, null unless all alleles are called."""
    alleles = gt_alleles(gt)
    return F.when(F.forall(alleles, lambda a: a.isNotNull()), F.size(F.filter(alleles, lambda a: a > 0)).cast("long"))
