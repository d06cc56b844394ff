"""Association tests and multiple-test correction, data-parallel over markers, traits or bins.

Sufficient statistics are summed in SQL; only small dense solves (a few covariates) run in Python, on one row per
model.  Iterative fits get bounded groups: distinct covariate patterns, not rows, where the model allows it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.operators.durable import durable
from varloom.operators.intervals import position_rank


def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of values from 0 on, relative error below 1e-13: the series of the error function
    below 2, the continued fraction of the tail (Lentz) beyond."""
    x = np.asarray(x, dtype=np.float64)
    out = np.full(x.shape, np.nan)
    small, large = x < 2, x >= 2
    if small.any():
        v = x[small]
        term = total = v.copy()
        for k in range(1, 60):
            term = term * (2 * v * v / (2 * k + 1))
            total = total + term
        out[small] = 1 - 2 / math.sqrt(math.pi) * np.exp(-v * v) * total
    if large.any():
        v = np.minimum(x[large], 1e8)
        f = c = v.copy()
        d = np.zeros_like(v)
        for k in range(1, 120):
            d = 1 / (v + k / 2 * d)
            c = v + k / 2 / c
            f = f * c * d
        out[large] = np.exp(-v * v) / (math.sqrt(math.pi) * f)
    return out


@F.pandas_udf(T.DoubleType())
def chisq1_p(x: pd.Series) -> pd.Series:
    """Upper tail of chi-square with one degree of freedom."""
    v = x.to_numpy(np.float64, na_value=np.nan)
    return pd.Series(erfc(np.sqrt(np.where(v >= 0, v, np.nan) / 2)))


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p of a normal score."""
    return pd.Series(erfc(np.abs(z.to_numpy(np.float64, na_value=np.nan)) / math.sqrt(2)))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive values: Stirling's series beyond 10, reached by the recurrence."""
    x, shift = np.asarray(x, dtype=np.float64).copy(), 0.0
    for _ in range(10):
        low = x < 10
        shift = shift + np.where(low, np.log(np.where(low, x, 1.0)), 0.0)
        x = np.where(low, x + 1, x)
    y = 1 / (x * x)
    series = (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y * (1 / 1680 - y * (1 / 1188 - y * 691 / 360360))))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - shift


def beta_tail(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function, by its continued fraction (Lentz), for arrays."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, dtype=np.float64) for v in (x, a, b)))
    out = np.where(x >= 1, 1.0, np.where(x <= 0, 0.0, np.nan))
    inside = (x > 0) & (x < 1)
    if not inside.any():
        return out
    x, a, b = x[inside], a[inside], b[inside]
    turn = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(turn, 1 - x, x), np.where(turn, b, a), np.where(turn, a, b)
    front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    tiny = 1e-300
    kept = lambda v: np.where(v == 0, tiny, v)
    d = 1 / kept(1 - (a + b) * x / (a + 1))
    c, f = np.ones_like(x), d
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / kept(1 + top * d)
            c = kept(1 + top / c)
            f = f * c * d
        if np.abs(c * d - 1).max() < 1e-14:
            break
    out[inside] = np.where(turn, 1 - front * f, front * f)
    return out


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of Student's t."""
    v, n = t.to_numpy(np.float64, na_value=np.nan), df.to_numpy(np.float64, na_value=np.nan)
    good = ~np.isnan(v) & (n > 0)
    out = np.full(len(v), np.nan)
    out[good] = beta_tail(n[good] / (n[good] + v[good] * v[good]), n[good] / 2, np.full(good.sum(), 0.5))
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided Fisher test of 2 x 2 tables: the probability of all tables no more likely than the one seen."""

    def one(a: int, b: int, c: int, d: int) -> float:
        n, row, col = a + b + c + d, a + b, a + c
        x = np.arange(max(0, col - (n - row)), min(row, col) + 1)
        lf = np.vectorize(math.lgamma)
        logs = -(lf(x + 1.0) + lf(row - x + 1.0) + lf(col - x + 1.0) + lf(n - row - col + x + 1.0))
        p = np.exp(logs - logs.max())
        seen = p[a - x[0]]
        return float(min(1.0, p[p <= seen * (1 + 1e-9)].sum() / p.sum()))

    return pd.Series([one(*map(int, t)) for t in zip(a, b, c, d)], dtype=float)


def assoc_allelic(genotypes: DataFrame, status: DataFrame) -> DataFrame:
    """Allele counts of cases (2) and controls (1), chi-square, odds ratio and p of every marker."""
    rows = genotypes.filter("dosage is not null").join(status.filter("case_status in (1, 2)").select("sample_id", "case_status"), "sample_id")
    case = F.col("case_status") == 2

    def side(who: Column, alt: bool) -> Column:
        return F.coalesce(F.sum(F.when(who, F.col("dosage") if alt else 2 - F.col("dosage"))), F.lit(0))

    c = rows.groupBy("variant_id").agg(side(case, True).alias("a"), side(case, False).alias("b"), side(~case, True).alias("c"), side(~case, False).alias("d"))
    a, b, cc, d = (F.col(n).cast("double") for n in "abcd")
    n = a + b + cc + d
    bottom = (a + b) * (cc + d) * (a + cc) * (b + d)
    out = c.withColumn("chisq", F.when(bottom > 0, n * (a * d - b * cc) * (a * d - b * cc) / bottom)).withColumn("odds_ratio", F.when(b * cc > 0, a * d / (b * cc)))
    return out.withColumn("p", F.when(F.col("chisq").isNotNull(), chisq1_p("chisq")))


def assoc_linear(genotypes: DataFrame, samples: DataFrame, trait: str) -> DataFrame:
    """Least squares of the trait on dosage: n, slope, r2, the t statistic and its p."""
    rows = genotypes.filter("dosage is not null").join(samples.select("sample_id", F.col(trait).cast("double").alias("y")).filter("y is not null"), "sample_id")
    out = rows.groupBy("variant_id").agg(F.count("*").alias("n"), F.regr_slope("y", "dosage").alias("beta"), F.regr_r2("y", "dosage").alias("r2"))
    t = F.when((F.col("n") > 2) & (F.col("r2") < 1), F.signum("beta") * F.sqrt(F.col("r2") * (F.col("n") - 2) / (1 - F.col("r2"))))
    out = out.withColumn("t", t)
    return out.withColumn("p", F.when(F.col("t").isNotNull(), student_p("t", (F.col("n") - 2).cast("double"))))


def gram(rows: DataFrame, by: list[str], columns: list[str], y: str) -> DataFrame:
    """X'X (upper triangle), X'y, y'y and n of each group, with an intercept; sums combine before the shuffle."""
    x = [F.lit(1.0), *(F.col(c).cast("double") for c in columns)]
    sums = [F.sum(x[i] * x[j]).alias(f"g_{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    return rows.groupBy(*by).agg(*sums, *(F.sum(x[i] * F.col(y)).alias(f"h_{i}") for i in range(len(x))), F.sum(F.col(y) * F.col(y)).alias("yy"), F.count("*").alias("n"))


def solve_gram(table: DataFrame, by: list[str], size: int, at: int) -> DataFrame:
    """by, n, beta, se of coefficient `at` from Gram rows; null where the system is singular."""

    def one(batches):
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                g = np.array([[getattr(r, f"g_{min(i, j)}_{max(i, j)}") for j in range(size)] for i in range(size)])
                h = np.array([getattr(r, f"h_{i}") for i in range(size)])
                beta = se = None
                if r.n > size and np.linalg.cond(g) < 1e12:
                    inverse = np.linalg.inv(g)
                    b = inverse @ h
                    s2 = max(0.0, r.yy - b @ h) / (r.n - size)
                    beta, se = float(b[at]), float(math.sqrt(s2 * inverse[at, at]))
                rows.append((*(getattr(r, c) for c in by), r.n, beta, se))
            yield pd.DataFrame(rows, columns=[*by, "n", "beta", "se"])

    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "n long", "beta double", "se double"])
    return table.mapInPandas(one, schema)


def assoc_linear_adjusted(genotypes: DataFrame, samples: DataFrame, trait: str, covariates: list[str]) -> DataFrame:
    rows = genotypes.filter("dosage is not null").join(samples.select("sample_id", F.col(trait).cast("double").alias("y"), *covariates).dropna(), "sample_id")
    size = 2 + len(covariates)
    out = solve_gram(gram(rows, ["variant_id"], ["dosage", *covariates], "y"), ["variant_id"], size, 1)
    return out.withColumn("p", F.when(F.col("se") > 0, student_p(F.try_divide("beta", "se"), (F.col("n") - size).cast("double"))))


def phewas(genotypes: DataFrame, samples: DataFrame, traits: list[str]) -> DataFrame:
    """All traits against all markers: trait, variant_id, n, slope and r2 in one shuffle."""
    long = samples.unpivot(["sample_id"], [F.col(t).cast("double").alias(t) for t in traits] and traits, "trait", "y").filter("y is not null")
    rows = genotypes.filter("dosage is not null").join(long, "sample_id")
    return rows.groupBy("trait", "variant_id").agg(F.count("*").alias("n"), F.regr_slope("y", "dosage").alias("beta"), F.regr_r2("y", "dosage").alias("r2"))


def categorical_dummies(samples: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """0/1 columns for all levels but the first; null stays null."""
    return samples.select("sample_id", *((F.col(column) == v).cast("int").alias(f"{column}_{v}".replace(" ", "_").lower()) for v in levels[1:]))


def score_stats(genotypes: DataFrame, samples: DataFrame, trait: str) -> DataFrame:
    """Score U, its variance V and the p of U^2 / V of every marker under the null model of a constant mean."""
    null = samples.filter(F.col(trait).isNotNull()).agg(F.avg(trait).alias("mean"), F.var_pop(trait).alias("s2"))
    y = samples.select("sample_id", F.col(trait).cast("double").alias("y")).filter("y is not null").join(F.broadcast(null))
    rows = genotypes.filter("dosage is not null").join(y, "sample_id")
    g = F.col("dosage").cast("double")
    out = rows.groupBy("variant_id").agg(F.count("*").alias("n"), F.sum(g * (F.col("y") - F.col("mean"))).alias("u"), F.sum(g * g).alias("gg"), F.sum(g).alias("g"), F.first("s2").alias("s2"))
    out = out.select("variant_id", "n", "u", (F.col("s2") * (F.col("gg") - F.col("g") * F.col("g") / F.col("n"))).alias("v"))
    return out.withColumn("p", F.when(F.col("v") > 1e-9, chisq1_p(F.try_divide(F.col("u") * F.col("u"), F.col("v")))))


def score_stats_adjusted(genotypes: DataFrame, samples: DataFrame, trait: str, covariates: list[str]) -> DataFrame:
    """variant_id, n, u, v, p of the score test under a null model of the covariates.

    The null model is fitted once on all samples with trait and covariates (one Gram row).  Every marker's variance
    takes out what its called samples' covariates explain of the dosage; covariates without variation there count
    as absent.  Samples with a null trait or covariate and missing calls take no part; markers whose called samples
    the covariates explain whole have v = 0, and p is null where v is not above 1e-9.
    """
    z = [f"z{i}" for i in range(len(covariates))]
    kept = samples.select("sample_id", F.col(trait).cast("double").alias("y"), *(F.col(c).cast("double").alias(n) for c, n in zip(covariates, z))).dropna()
    size = len(z) + 1

    def square(r) -> np.ndarray:
        return np.array([[getattr(r, f"g_{min(i, j)}_{max(i, j)}") for j in range(size)] for i in range(size)])

    def null_model(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.n:
                    h = np.array([getattr(r, f"h_{i}") for i in range(size)])
                    w = np.linalg.pinv(square(r), hermitian=True) @ h
                    yield pd.DataFrame({"w": [w], "s2": [max(0.0, r.yy - w @ h) / r.n]})

    null = gram(kept, [], z, "y").mapInPandas(null_model, "w array<double>, s2 double")
    fitted = sum((F.col("w")[i + 1] * F.col(n) for i, n in enumerate(z)), F.col("w")[0])
    left = kept.join(F.broadcast(null)).select("sample_id", *z, (F.col("y") - fitted).alias("e"), "s2")
    rows = genotypes.filter("dosage is not null").select("variant_id", "sample_id", F.col("dosage").cast("double").alias("d")).join(left, "sample_id")
    sums = rows.withColumn("de", F.col("d") * F.col("e"))
    table = gram(sums, ["variant_id"], z, "d").join(sums.groupBy("variant_id").agg(F.sum("de").alias("u"), F.first("s2").alias("s2")), "variant_id")

    def variance(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                h = np.array([getattr(r, f"h_{i}") for i in range(size)])
                out.append((r.variant_id, r.n, r.u, r.s2 * max(0.0, r.yy - h @ np.linalg.pinv(square(r), hermitian=True) @ h)))
            yield pd.DataFrame(out, columns=["variant_id", "n", "u", "v"])

    out = table.mapInPandas(variance, "variant_id long, n long, u double, v double")
    return out.withColumn("p", F.when(F.col("v") > 1e-9, chisq1_p(F.try_divide(F.col("u") * F.col("u"), F.col("v")))))


def cov_window(genotypes: DataFrame, variants: DataFrame, width: int) -> DataFrame:
    """Covariance of dosages of marker pairs up to `width` apart, over samples called at both.

    Pairs of sites come from a binned join of the (small) site table; genotypes meet on (site, sample) after it.
    """
    sites = variants.select("variant_id", "chrom", "pos").withColumn("bin", F.floor(F.col("pos") / width))
    a = sites.select("chrom", F.col("variant_id").alias("v1"), F.col("pos").alias("p1"), F.explode(F.array(F.col("bin"), F.col("bin") + 1)).alias("bin"))
    b = sites.select("chrom", F.col("variant_id").alias("v2"), F.col("pos").alias("p2"), "bin")
    near = a.join(b, ["chrom", "bin"]).filter(F.col("p2").between(F.col("p1"), F.col("p1") + width) & ((F.col("p2") > F.col("p1")) | (F.col("v2") > F.col("v1"))))
    called = genotypes.filter("dosage is not null")
    left = near.select("v1", "v2").join(called.select(F.col("variant_id").alias("v1"), "sample_id", F.col("dosage").alias("d1")), "v1")
    both = left.join(called.select(F.col("variant_id").alias("v2"), "sample_id", F.col("dosage").alias("d2")), ["v2", "sample_id"])
    return both.groupBy("v1", "v2").agg(F.count("*").alias("n"), F.covar_samp("d1", "d2").alias("cov"), (F.covar_pop("d1", "d2") / F.nullif(F.stddev_pop("d1") * F.stddev_pop("d2"), F.lit(0.0))).alias("r"))


def burden_regression(scores: DataFrame, samples: DataFrame, trait: str) -> DataFrame:
    """Trait on bin score; samples without a rare allele in the bin count with score 0.

    Zero scores need no rows: their part of the sums is that of all samples minus the carriers.
    """
    y = samples.select("sample_id", F.col(trait).cast("double").alias("y")).filter("y is not null")
    whole = y.agg(F.count("*").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"))
    s = F.col("score").cast("double")
    sums = scores.join(y, "sample_id").groupBy("bin").agg(F.sum(s).alias("sx"), F.sum(s * s).alias("sxx"), F.sum(s * F.col("y")).alias("sxy")).join(F.broadcast(whole))
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    dxx = F.col("sxx") - sx * sx / n
    return sums.select("bin", "n", F.when(dxx > 0, (F.col("sxy") - sx * sy / n) / dxx).alias("beta"))


def outer_sums(rows: DataFrame, column: str) -> DataFrame:
    """i, j, value: the sum of the outer products of an array column with itself; partial sums are made in tasks."""

    def partial(batches):
        total = None
        for batch in batches:
            if len(batch):
                x = np.stack(batch[column].to_numpy())
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "value": total.ravel()})

    return rows.select(column).mapInPandas(partial, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))


def stacked(predictors: DataFrame, ridge: float, tolerance: float = 1e-12, most_rounds: int = 1000) -> DataFrame:
    """sample_id, chrom, offset: the ridge prediction of y from all blocks' predictions but those of the chromosome.

    Blocks without a sample's prediction count as 0.  The ridges of all left-out chromosomes are solved together by
    conjugate gradients: a round sums, by block, each sample's predictions times its fitted values, so that no matrix of
    blocks by blocks is made.  What goes to every task is a number for each block and chromosome.
    """
    blocks = predictors.select("chrom", "block").distinct()
    order = Window.orderBy("chrom", "block")  # one row for each block
    numbered = durable(blocks.withColumn("at", F.row_number().over(order) - 1))
    own = np.array([r["chrom"] for r in numbered.orderBy("at").select("chrom").toLocalIterator()])
    chroms = np.unique(own)
    free = own[:, None] != chroms[None, :]  # blocks that a left-out chromosome's ridge may use
    size, wide = free.shape
    entries = F.collect_list(F.struct("at", "prediction"))
    per = predictors.join(F.broadcast(numbered), ["chrom", "block"]).groupBy("sample_id").agg(F.first("y").alias("y"), entries.alias("m"))
    per = durable(per.select("sample_id", "y", F.col("m.at").alias("at"), F.col("m.prediction").alias("prediction")))
    context = predictors.sparkSession.sparkContext

    def flat(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(batch)), [len(x) for x in batch["at"]])
        return rows, np.concatenate(batch["at"].tolist()).astype(np.int64), np.concatenate(batch["prediction"].tolist())

    def by_block(values) -> np.ndarray:
        """Sums over samples by block, of the columns that values gives for a batch's entries."""

        def partial(batches):
            total = None
            for batch in batches:
                if len(batch):
                    rows, at, x = flat(batch)
                    made = values(batch, rows, at, x)
                    total = np.zeros((size, made.shape[1])) if total is None else total
                    for k in range(made.shape[1]):
                        total[:, k] += np.bincount(at, made[:, k], size)
            if total is not None:
                some = np.flatnonzero(total.any(axis=1))
                yield pd.DataFrame({"at": some, "k": list(total[some])})

        made = per.mapInPandas(partial, "at long, k array<double>").select("at", F.posexplode("k").alias("column", "value"))
        summed = made.groupBy("at", "column").agg(F.sum("value").alias("value")).toPandas()
        out = np.zeros((size, int(summed["column"].max()) + 1 if len(summed) else 1))
        out[summed["at"], summed["column"]] = summed["value"]
        return out

    start = by_block(lambda batch, rows, at, x: np.column_stack([x * batch["y"].to_numpy()[rows], x * x]))
    h, scale = start[:, :1] * free, start[:, 1:] + ridge
    w, r = np.zeros((size, wide)), h.copy()
    z = r / scale
    p, rz = z.copy(), (r * z).sum(axis=0)
    least = tolerance**2 * rz
    for _ in range(most_rounds):
        if (rz <= least).all():
            break
        sent = context.broadcast(p)

        def product(batch, rows, at, x, sent=sent):
            terms, fitted = x[:, None] * sent.value[at], np.zeros((len(batch), wide))
            for k in range(wide):
                fitted[:, k] = np.bincount(rows, terms[:, k], len(batch))
            return x[:, None] * fitted[rows]

        ap = np.where(free, by_block(product) + ridge * p, 0.0)
        sent.destroy()
        open_ = rz > least
        step = np.where(open_, rz / np.where(open_, (p * ap).sum(axis=0), 1.0), 0.0)
        w, r = w + step * p, r - step * ap
        z = r / scale
        after = np.where(open_, (r * z).sum(axis=0), rz)
        p = np.where(open_, z + after / np.where(open_, rz, 1.0) * p, 0.0)
        rz = after
    else:
        raise RuntimeError(f"the ridges of the blocks did not settle in {most_rounds} rounds")
    weights, names = context.broadcast(w), [c.item() for c in chroms]

    def offsets(batches):
        for batch in batches:
            if len(batch):
                rows, at, x = flat(batch)
                made = [np.bincount(rows, x * weights.value[at, k], len(batch)) for k in range(wide)]
                yield pd.DataFrame({"sample_id": np.tile(batch["sample_id"].to_numpy(), wide), "chrom": np.repeat(names, len(batch)), "offset": np.concatenate(made)})

    kinds = {f.name: f.dataType.simpleString() for f in predictors.schema}
    return per.mapInPandas(offsets, f"sample_id {kinds['sample_id']}, chrom {kinds['chrom']}, offset double")


def whole_genome_regression(genotypes: DataFrame, variants: DataFrame, samples: DataFrame, trait: str, block: int, ridge: float, least_mac: int = 5) -> DataFrame:
    """Step 1: ridge predictors per block of markers, stacked by a second ridge, leaving out each chromosome.
    Step 2: the score of every marker against what is left of the trait."""
    y = samples.select("sample_id", F.col(trait).cast("double").alias("y")).filter("y is not null")
    mean = y.agg(F.avg("y").alias("mean"))
    y = y.join(F.broadcast(mean)).select("sample_id", (F.col("y") - F.col("mean")).alias("y"))
    ranked = position_rank(variants.select("variant_id", "chrom", "pos"), "variant_id")
    blocks = ranked.select("variant_id", "chrom", F.floor((F.col("rank") - 1) / block).cast("int").alias("block"))
    centred = genotypes.filter("dosage is not null").join(blocks, "variant_id").withColumn("x", F.col("dosage") - F.avg("dosage").over(Window.partitionBy("variant_id")))
    rows = centred.join(y, "sample_id").select("chrom", "block", "variant_id", "sample_id", "x", "y")

    def level0(group: pd.DataFrame) -> pd.DataFrame:
        x = group.pivot_table(index="sample_id", columns="variant_id", values="x", fill_value=0.0)
        target = group.drop_duplicates("sample_id").set_index("sample_id")["y"].reindex(x.index).to_numpy()
        m = x.to_numpy()
        # leave-one-out predictions from the hat matrix of the ridge
        inverse = np.linalg.inv(m.T @ m + ridge * np.eye(m.shape[1]))
        fitted = m @ (inverse @ (m.T @ target))
        leverage = np.einsum("ij,jk,ik->i", m, inverse, m)
        out = target - (target - fitted) / np.maximum(1e-6, 1 - leverage)
        return pd.DataFrame({"chrom": group["chrom"].iloc[0], "block": group["block"].iloc[0], "sample_id": x.index, "y": target, "prediction": out})

    predictors = durable(rows.groupBy("chrom", "block").applyInPandas(level0, "chrom int, block int, sample_id long, y double, prediction double"))
    # level 1: for each chromosome left out, one ridge over the predictors of all other blocks, on their summed Gram
    # matrix (a row for each pair of blocks)
    offsets = stacked(predictors, ridge)
    tested = rows.join(offsets, ["sample_id", "chrom"], "left").withColumn("e", F.col("y") - F.coalesce("offset", F.lit(0.0)))
    mac = genotypes.groupBy("variant_id").agg(F.least(F.sum("dosage"), 2 * F.count("dosage") - F.sum("dosage")).alias("mac")).filter(F.col("mac") >= least_mac)
    out = tested.groupBy("variant_id").agg(F.count("*").alias("n"), F.sum(F.col("x") * F.col("e")).alias("xe"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("e") * F.col("e")).alias("ee"))
    out = out.join(mac, "variant_id", "left_semi")
    return out.select("variant_id", "n", F.when((F.col("xx") > 0) & (F.col("ee") > 0), F.col("xe") * F.col("xe") * F.col("n") / (F.col("xx") * F.col("ee"))).alias("chisq"))


def batch_effect(genotypes: DataFrame, batches: DataFrame) -> DataFrame:
    """Allelic test of the batch label (sample_id, pseudo_case), the strongest differences first."""
    status = batches.select("sample_id", F.when(F.col("pseudo_case"), 2).otherwise(1).alias("case_status"))
    return assoc_allelic(genotypes, status).orderBy(F.desc_nulls_last("chisq"), "variant_id")


def interaction_pairs(genotypes: DataFrame, pairs: DataFrame, samples: DataFrame, trait: str) -> DataFrame:
    """Trait on d1 + d2 + d1 * d2 for listed marker pairs (v1, v2): the product's coefficient."""
    called = genotypes.filter("dosage is not null")
    rows = pairs.join(called.select(F.col("variant_id").alias("v1"), "sample_id", F.col("dosage").alias("d1")), "v1")
    rows = rows.join(called.select(F.col("variant_id").alias("v2"), "sample_id", F.col("dosage").alias("d2")), ["v2", "sample_id"])
    rows = rows.join(samples.select("sample_id", F.col(trait).cast("double").alias("y")).filter("y is not null"), "sample_id").withColumn("product", F.col("d1") * F.col("d2"))
    return solve_gram(gram(rows, ["v1", "v2"], ["d1", "d2", "product"], "y"), ["v1", "v2"], 4, 3)


# ---- correction and ordering


def bonferroni(results: DataFrame, p: str = "p") -> DataFrame:
    """min(1, p * m); m is one aggregate, not a window over all rows."""
    m = results.agg(F.count(p).alias("__m"))
    return results.join(F.broadcast(m)).withColumn("bonferroni", F.least(F.lit(1.0), F.col(p) * F.col("__m"))).drop("__m")


def fdr_bh(results: DataFrame, key: str, p: str = "p", parts: int = 4096) -> DataFrame:
    """Benjamini-Hochberg q: the running minimum, from the largest p, of p * m / rank.

    Ranks and running minima are taken within `parts` ranges of p and joined with the few per-range totals, so
    the global order needs no single task.
    """
    rows = results.filter(F.col(p).isNotNull()).withColumn("__part", F.least(F.floor(F.sqrt(F.sqrt(F.col(p))) * parts), F.lit(parts - 1)).cast("int"))
    own = Window.partitionBy("__part").orderBy(p, key)
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    by_part = Window.orderBy("__part")
    before = sizes.select(
        "__part", F.coalesce(F.sum("__n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__m")
    )
    ranked = rows.withColumn("__rn", F.row_number().over(own)).join(F.broadcast(before), "__part")
    ranked = ranked.withColumn("__raw", F.col(p) * F.col("__m") / (F.col("__before") + F.col("__rn")))
    least = ranked.groupBy("__part").agg(F.min("__raw").alias("__least"))
    after = least.select("__part", F.min("__least").over(by_part.rowsBetween(1, Window.unboundedFollowing)).alias("__after"))
    down = Window.partitionBy("__part").orderBy(F.desc(p), F.desc(key)).rowsBetween(Window.unboundedPreceding, 0)
    out = ranked.withColumn("__run", F.min("__raw").over(down)).join(F.broadcast(after), "__part")
    q = F.least(F.lit(1.0), F.col("__run"), F.coalesce("__after", F.lit(1.0)))
    return out.withColumn("q", q).drop(*(c for c in out.columns if c.startswith("__")))


def merge_sorted_results(parts: list[DataFrame], p: str = "p") -> DataFrame:
    """All results by ascending p (a range-partitioned sort)."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy(F.asc_nulls_last(p))


def exact_quantiles(rows: DataFrame, column: str, shares: list[float], *by: str) -> DataFrame:
    """by, share, value: interpolated quantiles of the non-null values of each group (few groups).

    A sketch gives two values that enclose each quantile; rows below are only counted, and only the few thousandths
    of a group in between are ranked.
    """
    x = rows.filter(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("x"))
    edges = [min(1.0, max(0.0, q + e)) for q in shares for e in (-0.001, 0.001)]
    sketch = x.groupBy(*by).agg(F.percentile_approx("x", edges, 10000).alias("e"), F.count("*").alias("n"))
    ranges = F.array(*(F.struct(F.lit(float(q)).alias("share"), F.col("e")[2 * i].alias("low"), F.col("e")[2 * i + 1].alias("high"), ((F.col("n") - 1) * F.lit(float(q))).alias("place")) for i, q in enumerate(shares)))
    ranges = durable(sketch.select(*by, ranges.alias("ranges")))
    with_ranges = x.join(F.broadcast(ranges), list(by)) if by else x.join(F.broadcast(ranges))
    sides = []
    for i, q in enumerate(shares):
        r, v = F.col("ranges")[i], F.col("x")
        beyond = [F.max(F.when(v < r["low"], v)).alias(f"p{i}"), F.min(F.when(v > r["high"], v)).alias(f"q{i}")]
        sides += [F.count_if(v < r["low"]).alias(f"b{i}"), F.count_if(v.between(r["low"], r["high"])).alias(f"c{i}"), *beyond, F.first(r["place"]).alias(f"w{i}")]
    one = [F.struct(F.lit(float(q)).alias("share"), F.col(f"b{i}").alias("below"), F.col(f"c{i}").alias("inside"), F.col(f"p{i}").alias("before"), F.col(f"q{i}").alias("after"), F.col(f"w{i}").alias("place")) for i, q in enumerate(shares)]
    counts = durable(with_ranges.groupBy(*by).agg(*sides).select(*by, F.explode(F.array(*one)).alias("y")).select(*by, "y.*"))
    inside = F.filter("ranges", lambda r: F.col("x").between(r["low"], r["high"]))
    inside = with_ranges.select(*by, "x", F.explode(inside).alias("r")).select(*by, "x", "r.share", "r.place")
    keys = [*by, "share"]
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("x")) - 1
    ranked = inside.withColumn("at", at).join(F.broadcast(counts.select(*keys, "below")), keys).withColumn("at", F.col("at") + F.col("below")).select(*keys, "x", "place", "at")
    # the values next to the enclosed ones, as a small group's quantile may lie between such
    for value, place in (("before", F.col("below") - 1), ("after", F.col("below") + F.col("inside"))):
        ranked = ranked.unionByName(counts.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("x"), "place", place.alias("at")))
    near = ranked.filter((F.col("at") == F.floor("place")) | (F.col("at") == F.ceil("place")))
    part = F.col("place") - F.floor("place")
    value = F.min("x") + (F.max("x") - F.min("x")) * F.first(part)
    return near.groupBy(*keys).agg(value.alias("value"))


def exact_median(rows: DataFrame, column: str) -> float | None:
    """The median (the mean of the middle two of an even number), null values left out; None without values."""
    found = exact_quantiles(rows, column, [0.5]).first()
    return found["value"] if found else None


def genomic_control(results: DataFrame, statistic: str = "chisq") -> DataFrame:
    """Statistics divided by lambda = max(1, median / 0.456)."""
    results = durable(results)
    lam = max(1.0, (exact_median(results, statistic) or 0.0) / 0.456)
    return results.withColumn("lambda", F.lit(lam)).withColumn("chisq_gc", F.col(statistic) / F.col("lambda"))


def variance_fraction(eigenvalues: DataFrame, n: int, *keys: str) -> DataFrame:
    """keys, pc, fraction = eigenvalue / (n - 2) from an array of eigenvalues in each row."""
    return eigenvalues.select(*keys, F.posexplode("eigenvalues").alias("i", "value")).select(*keys, (F.col("i") + 1).alias("pc"), (F.col("value") / (n - 2)).alias("fraction"))


def label_duplicates(markers: DataFrame) -> DataFrame:
    """New ids of repeated rsids: with a type 2, type 0 gets _t0 and type 3 _t3; otherwise type 3 gets _t3 where a
    type 0 exists.  '.' becomes chrC:pos.  unresolved marks ids that still repeat; a null rsid stays null.

    Counts are combined before the shuffle and only repeated ids are joined back, so '.' meets in no task."""
    has = [F.max((F.col("type") == t).cast("int")).alias(f"__has{t}") for t in (0, 2)]
    named = markers.filter("rsid <> '.'")
    repeated = named.groupBy("rsid").agg(*has, F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    rest = markers.filter("rsid is null or rsid = '.'")
    out = named.join(repeated, "rsid", "left").unionByName(rest, allowMissingColumns=True)
    two, zero = F.col("__has2") == 1, F.col("__has0") == 1
    suffix = F.when(two & (F.col("type") == 0), "_t0").when((two | zero) & (F.col("type") == 3), "_t3").otherwise("")
    place = F.concat(F.lit("chr"), F.col("chrom").cast("string"), F.lit(":"), F.col("pos").cast("string"))
    out = out.withColumn("marker", F.when(F.col("rsid") == ".", place).otherwise(F.concat("rsid", suffix))).select(*markers.columns, "marker")
    again = out.groupBy(F.col("marker").alias("__marker")).agg(F.count("*").alias("__n")).filter("__n > 1")
    out = out.join(again, F.col("marker").eqNullSafe(F.col("__marker")), "left")
    return out.withColumn("unresolved", F.col("__n").isNotNull()).drop("__marker", "__n")


def top_annotations(transcripts: DataFrame, most: int = 3) -> DataFrame:
    """Per site, the features of the transcripts with the longest proteins as columns, the rest in extra."""
    order = Window.partitionBy("variant_id").orderBy(F.desc("aa_len"), "k")
    rows = transcripts.withColumn("rank", F.row_number().over(order))
    label = F.concat_ws("|", "effect", "impact", "gene")
    tops = [F.min(F.when(F.col("rank") == i, label)).alias(f"top{i}") for i in range(1, most + 1)]
    extra = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") > most, F.struct("rank", label.alias("l"))))), lambda x: x["l"]), ",")
    return rows.groupBy("variant_id").agg(*tops, extra.alias("extra"))
