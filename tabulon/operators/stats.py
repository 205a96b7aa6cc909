"""Statistics on tables: moments, tests, intervals, resampling."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, safe_divide
from .ordered import Ordered, ordered, stable_hash
from .quantiles import with_quantiles


def moments(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """n, mean, sample variance and sample standard deviation per key."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.var_samp(value).alias("variance"),
        F.stddev_samp(value).alias("std"),
    )


def iqr_bounds(df: DataFrame, value: str, keys: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """``df`` with the quartile fences of its key on every row."""
    wide = with_quantiles(df, value, {"_q1": 0.25, "_q3": 0.75}, keys)
    iqr = F.col("_q3") - F.col("_q1")
    return wide.withColumns({"lower": F.col("_q1") - k * iqr, "upper": F.col("_q3") + k * iqr}).drop("_q1", "_q3")


def robust_z(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Adds ``robust_z``: distance from the median in units of the median absolute deviation."""
    a = with_quantiles(df, value, {"_median": 0.5}, keys).withColumn("_dev", F.abs(F.col(value) - F.col("_median")))
    b = with_quantiles(a, "_dev", {"_mad": 0.5}, keys)
    z = safe_divide(0.6745 * (F.col(value) - F.col("_median")), F.col("_mad"))
    return b.withColumn("robust_z", z).drop("_median", "_dev", "_mad")


def sample_skewness(value: str) -> Column:
    """The bias-corrected skewness; the built-in is the population form."""
    n = F.count(value)
    return F.skewness(value) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0))


def sample_kurtosis(value: str) -> Column:
    """The bias-corrected excess kurtosis; the built-in is the population form."""
    n = F.count(value)
    return (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0)) * ((n + 1) * F.kurtosis(value) + 6)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and the largest value; the largest falls in the last bin."""
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("e")).scalar()
    x = F.col(value)
    at = F.floor((x - F.col("_e.lo")) / F.nullif(F.col("_e.hi") - F.col("_e.lo"), F.lit(0)) * bins)
    place = F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1))
    return df.filter(x.isNotNull()).withColumn("_e", ends).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


# Coefficients of the normal tail approximation (Abramowitz and Stegun 26.2.17, error below 7.5e-8).
TAIL_P = 0.2316419
TAIL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by a polynomial."""
    t = 1 / (1 + TAIL_P * F.abs(z))
    poly = sum((b * F.pow(t, i + 1) for i, b in enumerate(TAIL_B)), F.lit(0.0))
    upper = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


# Coefficients of the Lanczos approximation of the gamma function with g = 7, error below 1e-14.
LANCZOS_G = 7.0
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def log_factorial(n: Column) -> Column:
    """ln(n!) by one closed formula, whatever the size of n."""
    x = n.cast("double")
    series = sum((F.lit(c) / (x + i) for i, c in enumerate(LANCZOS) if i), F.lit(LANCZOS[0]))
    t = x + LANCZOS_G + 0.5
    return F.when(x < 2, 0.0).otherwise(0.5 * math.log(2 * math.pi) + (x + 0.5) * F.ln(t) - t + F.ln(series))


def binomial_pmf(k: Column, n: Column, p: float) -> Column:
    logs = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log(1 - p)
    return F.when((k >= 0) & (k <= n), F.exp(logs)).otherwise(0.0)


def poisson_cdf(k: Column, mean: float) -> Column:
    """P(X <= k). The terms fall off on either side of the mean, so the side of k away from it is summed:
    a number of terms that depends on the mean alone."""
    terms = F.array(*[F.lit(float(j)) for j in range(1, int(40 + 12 * math.sqrt(mean)) + 1)])
    x = F.floor(k).cast("double")
    pmf = lambda i: F.exp(i * math.log(mean) - mean - log_factorial(i))

    def series(ratio) -> Column:
        one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

        def add(s, j):
            term = s["term"] * ratio(j)
            return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

        return F.aggregate(terms, one, add, lambda s: s["total"])

    above = 1 - pmf(x + 1) * series(lambda j: mean / (x + 1 + j))
    below = pmf(x) * series(lambda j: F.greatest(x - j + 1, F.lit(0.0)) / mean)
    return F.when(x < 0, 0.0).when(x >= mean, above).otherwise(below)


def exponential_tail(x: Column, rate: float) -> Column:
    return F.exp(-rate * x)


def welch(a: str, b: str) -> tuple[Column, Column]:
    """t and degrees of freedom from the moment columns with the suffixes ``a`` and ``b``."""
    va = F.col(f"variance{a}") / F.col(f"n{a}")
    vb = F.col(f"variance{b}") / F.col(f"n{b}")
    t = safe_divide(F.col(f"mean{a}") - F.col(f"mean{b}"), F.sqrt(va + vb))
    df = safe_divide(F.pow(va + vb, 2), F.pow(va, 2) / (F.col(f"n{a}") - 1) + F.pow(vb, 2) / (F.col(f"n{b}") - 1))
    return t, df


def cohens_d(a: str, b: str) -> Column:
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    pooled = F.sqrt(((na - 1) * F.col(f"variance{a}") + (nb - 1) * F.col(f"variance{b}")) / (na + nb - 2))
    return safe_divide(F.col(f"mean{b}") - F.col(f"mean{a}"), pooled)


def adjust_p_values(df: DataFrame, p: str, key: str) -> DataFrame:
    """Adds ``bonferroni`` and ``benjamini_hochberg`` to a table of p-values."""
    m = df.agg(F.count(p)).scalar()
    placed = ordered(df, Ordered(order=p, tie=[key], row_number="_rank")).withColumn("_m", m)
    raw = placed.withColumns({"_raw": F.col(p) * F.col("_m") / F.col("_rank"), "_down": -F.col("_rank")})
    least = ordered(raw, Ordered(order="_down", running={"_bh": ("min", "_raw")}))
    return least.select(
        *df.columns,
        F.least(F.col(p) * F.col("_m"), F.lit(1.0)).alias("bonferroni"),
        F.least(F.col("_bh"), F.lit(1.0)).alias("benjamini_hochberg"),
    )


def poisson_steps() -> list[float]:
    """The distribution function of Poisson(1), as far as draws of 40 bits reach: no draw lies beyond the last."""
    steps, total, k = [], 0.0, 0
    while total < 1 - 2.0**-42:
        total += math.exp(-1) / math.factorial(k)
        steps.append(total)
        k += 1
    return steps


def bootstrap_state(df: DataFrame, key: str, value: str, replicates: int, seed: int = 42) -> DataFrame:
    """(replicate, w, wx): the rows drawn and the sum of their values per replicate, from one pass over the rows.

    A task keeps two numbers per replicate and adds up whole batches; states of tasks are added up by replicate, so what is
    shuffled is tasks * replicates numbers however many rows there are. Rows without a value are left out.
    """
    # a row enters a replicate a Poisson(1) number of times, by xxhash64(key, replicate, seed): the engine hashes the key,
    # the two whole numbers behind it are hashed here, for all replicates of a batch at once
    one, two, three, five = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 2870177450012600261))
    steps = np.array(poisson_steps())

    def with_int(hashes: np.ndarray, number) -> np.ndarray:
        h = (hashes + five + np.uint64(4)) ^ (number * one)
        h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * two + three
        h = (h ^ (h >> np.uint64(33))) * two
        h = (h ^ (h >> np.uint64(29))) * three
        return h ^ (h >> np.uint64(32))

    def work(batches):
        count, total = np.zeros(replicates, np.int64), np.zeros(replicates)
        numbers = np.arange(1, replicates + 1, dtype=np.uint64)
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            x = batch.column(1).to_numpy(zero_copy_only=False)
            for lo in range(0, len(x), 4096):
                with np.errstate(over="ignore"):
                    draw = with_int(with_int(hashes[lo : lo + 4096, None], numbers[None, :]), np.uint64(seed))
                u = ((draw & np.uint64((1 << 40) - 1)).astype(float) + 0.5) / float(1 << 40)
                weight = np.searchsorted(steps, u, "left")
                count += weight.sum(axis=0)
                total += x[lo : lo + 4096] @ weight
        yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), pa.array(count), pa.array(total)], names=["replicate", "w", "wx"])

    rows = df.select(F.xxhash64(key).alias("h"), F.col(value).cast("double").alias("x")).filter("x is not null")
    parts = rows.mapInArrow(work, "replicate int, w long, wx double")
    return parts.groupBy("replicate").agg(F.sum("w").alias("w"), F.sum("wx").alias("wx"))


def bootstrap_means(df: DataFrame, key: str, value: str, replicates: int, seed: int = 42) -> DataFrame:
    """One mean per replicate; a replicate that draws no row has none."""
    state = bootstrap_state(df, key, value, replicates, seed).filter("w > 0")
    return state.select("replicate", (F.col("wx") / F.col("w")).alias("mean"))
