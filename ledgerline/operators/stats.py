"""Grouped statistics, divergences and outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.columns import relative_divergence, safe_ratio


#: A group of up to so many values is ranked as a whole; of larger ones only what lies in brackets about the wanted ranks.
SMALL = 20_000
#: Accuracy of the sketch that gives the brackets: ranks are off by one in so many at most.
ACCURACY = 10_000
#: Half the width of a bracket as a share of the ranks: more than the sketch's error and two ranks of a group that isn't small.
MARGIN = 3 / ACCURACY + 4 / SMALL
#: Parts that a group's values are dealt to, so that no task holds a group.
PARTS = 64


def _dealt(df: DataFrame, by: str, value: Column) -> DataFrame:
    """_g (the group, which may be NULL) and _v of all rows, dealt once: every pass over them reads the same shuffle."""
    rows = df.select(F.struct(F.col(by).alias("k")).alias("_g"), value.cast("double").alias("_v"))
    return rows.repartition(F.col("_g"), F.pmod(F.xxhash64("_v"), F.lit(PARTS)))


def _percentiles(dealt: DataFrame, value: Column, points: tuple[float, ...], name: str) -> DataFrame:
    """_g and name: the percentiles of an expression of _v; groups without values are left out."""
    v = F.when(~F.isnan(value), value)
    edges = F.array(*[F.lit(min(1.0, max(0.0, p + x))) for p in points for x in (-MARGIN, MARGIN)])
    sketched = dealt.groupBy("_g").agg(F.count(v).alias("_all"), F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.percentile_approx(v, edges, ACCURACY).alias("_e"))
    edge = lambda k, whole: F.when(F.col("_all") <= SMALL, F.col(whole)).otherwise(F.col("_e")[k])
    brackets = sketched.filter("_all > 0").select("_g", "_all", *[edge(2 * k + x, whole).alias(f"_{whole}{k}") for k in range(len(points)) for x, whole in ((0, "_lo"), (1, "_hi"))])
    near = dealt.join(brackets, "_g")
    # below a bracket only the count matters (NULL stands for all such values), above it nothing does
    each = [F.when(F.coalesce(v <= F.col(f"__hi{k}"), F.lit(False)), F.struct(F.lit(k).alias("k"), F.when(v >= F.col(f"__lo{k}"), v).alias("v"))) for k in range(len(points))]
    counted = near.select("_g", "_all", F.explode(F.array_compact(F.array(*each))).alias("_x")).groupBy("_g", "_all", "_x").agg(F.count(F.lit(1)).alias("_n"))
    order = W.partitionBy("_g", "_x.k").orderBy(F.asc_nulls_first("_x.v"))
    ranked = counted.withColumn("_until", F.sum("_n").over(order))
    place = F.element_at(F.array(*map(F.lit, points)), F.col("_x.k") + 1) * (F.col("_all") - 1)
    holds = lambda r: F.max(F.when((r >= F.col("_until") - F.col("_n")) & (r < F.col("_until")), F.col("_x.v")))
    both = ranked.groupBy("_g", F.col("_x.k").alias("_k")).agg(holds(F.floor(place)).alias("_a"), holds(F.ceil(place)).alias("_b"), F.first(place - F.floor(place)).alias("_part"))
    known = lambda c: F.coalesce(c, F.raise_error(F.lit("a wanted rank lies outside of its bracket")).cast("double"))
    between = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(known(F.col("_a")) + (known(F.col("_b")) - F.col("_a")) * F.col("_part"))
    found = both.select("_g", "_k", between.alias("_p"))
    return found.groupBy("_g").agg(F.array(*[F.max(F.when(F.col("_k") == k, F.col("_p"))) for k in range(len(points))]).alias(name))


def exact_percentiles(df: DataFrame, by: str, value: Column, points: tuple[float, ...], name: str = "_p") -> DataFrame:
    """by and name: the linearly interpolated percentiles of each group, exact; NULL and NaN don't count. A mergeable sketch of
    each group brackets the wanted ranks; then the values below each bracket are counted and those inside are
    ranked, about a thousandth of a large group. No job runs before the action, df is computed once, and the passes share
    one shuffle of group and value in which a group is dealt to many tasks. A rank that a bracket misses would be an error, not a wrong value."""
    return _percentiles(_dealt(df, by, value), F.col("_v"), points, name).select(F.col("_g.k").alias(by), name)


def divergence_summary(df: DataFrame, metric: str, value: str) -> DataFrame:
    """Signed and absolute statistics of each metric, with linearly interpolated percentiles."""
    v, a = F.col("_v"), F.abs(F.col("_v"))
    share = lambda limit: 100.0 * F.count_if(a <= limit) / F.count(v)
    dealt = _dealt(df, metric, F.col(value))
    points = _percentiles(dealt, a, (0.5, 0.9, 0.95, 0.99), "_p")
    made = dealt.groupBy("_g").agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.min(v).alias("least"), F.max(v).alias("most"), F.avg(a).alias("abs_mean"), *[share(k).alias(f"within_{k}") for k in (5, 10, 20)])
    return made.join(points, "_g", "left").select(F.col("_g.k").alias(metric), "n", "mean", "sd", "least", "most", "abs_mean", *[F.col("_p")[k].alias(f"p{p}") for k, p in enumerate((50, 90, 95, 99))], "within_5", "within_10", "within_20")


def outliers(df: DataFrame, metric: str, value: str) -> DataFrame:
    """Rows at or over the 95th percentile of their metric's absolute values; extreme: the 99th."""
    a = F.abs(F.col(value))
    limits = exact_percentiles(df, metric, a, (0.95, 0.99))
    return df.join(limits, metric).filter(a >= F.col("_p")[0]).withColumn("extreme", a >= F.col("_p")[1]).drop("_p")


def implied_input(df: DataFrame, reference: Column, factor: Column, actual: Column) -> DataFrame:
    """The input that the reference implies, its difference to the actual one in percent, and whether
    that explains the divergence."""
    implied = safe_ratio(reference, factor)
    diff = relative_divergence(implied, actual)
    return df.withColumns({"implied": implied, "diff": diff, "hypothesis": F.when(F.abs(diff) <= 10, "input explains it").when(diff.isNotNull(), "input does not explain it")})


def describe_groups(df: DataFrame, by: str, value: str) -> DataFrame:
    dealt, v = _dealt(df, by, F.col(value)), F.col("_v")
    made = dealt.groupBy("_g").agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("least"), F.max(v).alias("most"), F.stddev_samp(v).alias("sd"))
    q = _percentiles(dealt, v, (0.25, 0.5, 0.75), "_q")
    return made.join(q, "_g", "left").select(F.col("_g.k").alias(by), "n", "mean", "least", "most", "sd", *[F.col("_q")[k].alias(f"q{k + 1}") for k in range(3)])


def group_sizes(df: DataFrame, keys: list[str], keep_null: bool = True) -> DataFrame:
    rows = df if keep_null else df.dropna(subset=keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def mode_first_seen(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """The commonest value of each group; the one seen first on ties."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_seq"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("_n"), -F.col("_seq"))).alias("mode"))


def sample_groups(df: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """n rows of each group, in an order by a hash of the key that any engine can repeat."""
    order = W.partitionBy(by).orderBy(F.md5(F.col(key).cast("string")), key)
    return df.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n).drop("_rn")
