"""Numbers behind the check plots: histograms, boxes, summaries, point sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomframe.session import stored

_BINS = 4096


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    width = (high - low) / F.lit(float(bins))
    return F.when(high > low, F.least(F.floor((value - low) / width), F.lit(bins - 1)))\
        .otherwise(F.lit(0)).cast("long")


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())


def _one_row(df: DataFrame, *names: str) -> Column:
    """A one-row table as one struct value, for use in another table."""
    return df.select(F.struct(*names)).scalar()


def histogram_density(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Count and density per bin of equal width between minimum and maximum."""
    x = _values(df, column)
    ends = x.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))
    spread = x.select("v", _one_row(ends, "low", "high", "n").alias("e"))
    counted = (spread.groupBy("e", _bin(F.col("v"), F.col("e.low"), F.col("e.high"), bins)
                              .alias("bin"))
               .agg(F.count(F.lit(1)).alias("n")))
    width = (F.col("e.high") - F.col("e.low")) / F.lit(float(bins))
    return counted.select(
        "bin", (F.col("e.low") + F.col("bin") * width).alias("bin_start"),
        (F.col("e.low") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.col("n"), F.try_divide(F.col("n"), F.col("e.n") * width).alias("density"))


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    """v, c: each value with its count, missing ones included; written, so that ``df`` is read once for all steps."""
    values = df.select(F.col(column).cast("double").alias("v"))
    return stored(values.groupBy("v").agg(F.count(F.lit(1)).alias("c")), "value-counts")


def _known(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("v").isNotNull())


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> DataFrame:
    """One row ``n, min, q0, q1, ..., max`` with linear interpolation.

    Exact at any size without gathering the values in one task: equal values
    are counted first, and bins locate the wanted ranks in two steps.  The
    first bins are even on a logarithmic scale, so far values do not crowd
    the others into one bin; the second divide, between its own ends, each
    bin that holds a rank.  Only the small bins left are ordered.
    """
    return _quantiles(_known(_value_counts(df, column)), probs)


def _even(v: Column) -> Column:
    """A logarithmic scale that keeps the order of all numbers."""
    return F.signum(v) * F.log1p(F.abs(v))


def located_bins(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Values of the small bins that hold a rank: v, c, e, bin, part, before, n."""
    ends = counts.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    spread = counts.select("v", "c", _one_row(ends, "low", "high").alias("e"))
    binned = spread.withColumn("bin", _bin(
        _even(F.col("v")), _even(F.col("e.low")), _even(F.col("e.high")), _BINS))

    # At most _BINS rows here, so one window task is enough.
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding,
                                              Window.unboundedFollowing)
    totals = (binned.groupBy("bin")
              .agg(F.sum("c").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
              .select("bin", "c", "low", "high",
                      F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"),
                      F.sum("c").over(whole).alias("n")))
    held = _holding(probs)
    wanted = totals.filter(held).select("bin", "low", "high", "before", "n")
    parted = binned.join(F.broadcast(wanted), "bin").withColumn(
        "part", _bin(F.col("v"), F.col("low"), F.col("high"), _BINS)).drop("low", "high")

    # At most _BINS rows for each of the few bins.
    earlier = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    smaller = (parted.groupBy("bin", "part", "n", "before").agg(F.sum("c").alias("c"))
               .withColumn("before", F.col("before") + F.coalesce(F.sum("c").over(earlier), F.lit(0))))
    small = smaller.filter(held).select("bin", "part", F.col("before").alias("first"))
    return parted.join(F.broadcast(small), ["bin", "part"]).withColumn("before", F.col("first")).drop("first")


def _positions(probs: Sequence[float]) -> list[Column]:
    return [(F.col("n") - 1) * F.lit(float(p)) for p in probs]


def _holding(probs: Sequence[float]) -> Column:
    """Whether ``before`` and ``c`` enclose a wanted rank."""
    ranks = F.array(*[f(h) for h in _positions(probs) for f in (F.floor, F.ceil)])
    return F.exists(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("c")))


def _quantiles(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    position = _positions(probs)
    inside = Window.partitionBy("bin", "part").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (located_bins(counts, probs)
              .withColumn("end", F.col("before") + F.sum("c").over(inside))
              .withColumn("start", F.col("end") - F.col("c")))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("end")), F.col("v")))

    out = [F.max("n").alias("n"), F.max("e.low").alias("min")]
    for i, h in enumerate(position):
        lower, upper = at(F.floor(h)), at(F.ceil(h))
        out.append((lower + (upper - lower) * F.max(h - F.floor(h))).alias(f"q{i}"))
    return placed.agg(*out, F.max("e.high").alias("max"))


_QUARTILES = (0.25, 0.5, 0.75)


def summary_stats(df: DataFrame, column: str) -> DataFrame:
    """Minimum, quartiles, mean, maximum and number of missing values."""
    counts = _value_counts(df, column)
    plain = counts.agg((F.sum(F.col("v") * F.col("c")) / F.sum(F.when(F.col("v").isNotNull(), F.col("c")))).alias("mean"),
                       F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)).alias("missing"))
    q = _quantiles(_known(counts), _QUARTILES).select(
        "*", _one_row(plain, "mean", "missing").alias("p"))
    return q.select("min", F.col("q0").alias("q1"), F.col("q1").alias("median"),
                    F.col("p.mean").alias("mean"), F.col("q2").alias("q3"), "max",
                    F.col("p.missing").alias("missing"))


def box_stats(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (last value within ``reach`` box heights) and
    the number of values beyond them."""
    counts = _known(_value_counts(df, column))
    box = _quantiles(counts, _QUARTILES)
    x = counts.select("v", "c", _one_row(box, "q0", "q1", "q2").alias("q"))
    height = reach * (F.col("q.q2") - F.col("q.q0"))
    inside = F.col("v").between(F.col("q.q0") - height, F.col("q.q2") + height)
    return x.agg(F.max("q.q0").alias("q1"), F.max("q.q1").alias("median"),
                 F.max("q.q2").alias("q3"),
                 F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
                 F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
                 F.sum(F.when(inside, 0).otherwise(F.col("c"))).alias("outliers"))


def pair_projection(df: DataFrame, x: str, y: str, label: Column | None = None) -> DataFrame:
    """Point set of two columns where both are known, optionally labelled."""
    cols = [F.col(x), F.col(y)] + ([] if label is None else [label.alias("label")])
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*cols)


def local_curve(df: DataFrame, x: str, y: str, bins: int = 40, reach: float = 0.3) -> DataFrame:
    """The smoothed curve behind a scatter plot: bin, x, n, fitted.

    Local linear regression at the middle of each bin of equal width that holds points.  The points come down to the
    moments of their bins in one aggregation, whatever their number; a bin counts by the distance of its mean from the
    place of the fit, with tricube weights that end at ``reach`` of the whole range.  Where all weight lies at one
    place the fit is its mean.  Points with a missing or infinite value are left out; without points the result is empty.
    """
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    points = points.filter((F.abs("x") < float("inf")) & (F.abs("y") < float("inf")))
    ends = points.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    spread = points.select("x", "y", _one_row(ends, "low", "high").alias("e"))
    gap = F.col("x") - F.col("e.low")  # moments about the lower end keep their digits
    moments = spread.groupBy("e", _bin(F.col("x"), F.col("e.low"), F.col("e.high"), bins).alias("bin")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(gap).alias("sx"), F.sum("y").alias("sy"),
        F.sum(gap * gap).alias("sxx"), F.sum(gap * F.col("y")).alias("sxy"))
    names = ("n", "sx", "sy", "sxx", "sxy")
    # one row with at most as many entries as bins
    whole = moments.groupBy("e").agg(F.array_sort(F.collect_list(F.struct("bin", *names))).alias("all"))
    each = whole.select("e", "all", F.explode("all").alias("own"))
    width = (F.col("e.high") - F.col("e.low")) / F.lit(float(bins))
    each = each.withColumn("at", (F.col("own.bin") + 0.5) * width).withColumn("h", F.lit(float(reach)) * (F.col("e.high") - F.col("e.low")))

    def weight(b: Column) -> Column:
        near = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.abs(b["sx"] / b["n"] - F.col("at")), F.col("h")), F.lit(0.0)))
        return F.pow(1 - F.pow(near, 3), 3)

    total = F.aggregate("all", F.struct(*[F.lit(0.0).alias(n) for n in names]),
                        lambda s, b: F.struct(*[(s[n] + weight(b) * b[n]).alias(n) for n in names]))
    fit = each.withColumn("s", total)
    s = {n: F.col(f"s.{n}") for n in names}
    across = s["n"] * s["sxx"] - s["sx"] * s["sx"]
    slope = F.when(across > 1e-12 * s["n"] * s["sxx"], (s["n"] * s["sxy"] - s["sx"] * s["sy"]) / across).otherwise(0.0)
    mean = F.try_divide(s["sy"], s["n"])
    return fit.select(F.col("own.bin").alias("bin"), (F.col("e.low") + F.col("at")).alias("x"), F.col("own.n").cast("long").alias("n"),
                      (mean + slope * (F.col("at") - F.try_divide(s["sx"], s["n"]))).alias("fitted"))
