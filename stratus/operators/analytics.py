"""Statistics over the readings and the daily frame: correlation, seasonal
statistics, seasonal decomposition, z-score anomalies.

Windows over the daily frame are partitioned by (year, month) or by calendar
month, so every window partition is bounded by the calendar, not by the data
volume.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus import sinks
from stratus.functions.exprs import resolve, season
from stratus.operators.quality import _inline
from stratus.session import shared_dir

METRICS = ("temperatureC", "humidity", "wind_speed_kmh", "pressure_millibars", "visibility_km")


def metric_correlation(df: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """metric_a, metric_b, corr (Pearson) for every pair of present metrics, one scan."""
    present = [m for m in (resolve(df, x) for x in metrics) if m is not None]
    pairs = list(combinations(present, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return _inline(row, [F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"),
                                  F.col(f"c{i}").alias("corr"))
                         for i, (a, b) in enumerate(pairs)])


def rank_correlation(df: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """metric_a, metric_b, n, corr (Spearman: of average ranks) for every pair of present
    metrics, over the rows that have both.

    All pairs go through together. Equal value pairs are counted first; values are
    then dealt by ranges, so a value's rank is the rows in earlier ranges (one count
    per range reaches the driver) plus those before it in its own. No window spans
    more than a range, and equal values, however many, are one row.
    """
    present = [m for m in (resolve(df, x) for x in metrics) if m is not None]
    pairs = [F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(a).cast("double").alias("x"),
                      F.col(b).cast("double").alias("y")) for a, b in combinations(present, 2)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "metric_a string, metric_b string, n long, corr double")
    pair = ["metric_a", "metric_b"]
    both = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*").where("x is not null and y is not null")
    points = _written(both.groupBy(*pair, "x", "y").agg(F.count(F.lit(1)).alias("n")), "rank-points")
    sides = points.select(*pair, "n", F.explode(F.array(F.struct(F.lit("x").alias("side"), F.col("x").alias("value")),
                                                       F.struct(F.lit("y").alias("side"), F.col("y").alias("value")))).alias("s"))
    values = sides.groupBy(*pair, "s.side", "s.value").agg(F.sum("n").alias("n"))
    keys = [*pair, "side"]
    dealt = _written(values.repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id()), "rank-values")
    totals, offsets = {}, []
    for r in sorted(dealt.groupBy(*keys, "part").agg(F.sum("n").alias("n")).collect()):  # a row per range, and pair at its ends
        key = (r["metric_a"], r["metric_b"], r["side"])
        offsets.append((*key, r["part"], totals.get(key, 0)))
        totals[key] = totals.get(key, 0) + r["n"]
    spark = df.sparkSession
    before = spark.createDataFrame(offsets, "metric_a string, metric_b string, side string, part int, before long")
    own = Window.partitionBy(*keys, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("before") + F.coalesce(F.sum("n").over(own), F.lit(0)) + (F.col("n") + 1) / 2
    ranks = _written(dealt.join(before, [*keys, "part"]).select(*keys, "value", rank.alias("rank")), "ranks")

    def of(side: str) -> DataFrame:
        return ranks.where(F.col("side") == side).select(*pair, F.col("value").alias(side), F.col("rank").alias(f"rank_{side}"))
    middle = spark.createDataFrame([(a, b, (n + 1) / 2) for (a, b, side), n in totals.items() if side == "x"],
                                   "metric_a string, metric_b string, middle double")
    a, b = F.col("rank_x") - F.col("middle"), F.col("rank_y") - F.col("middle")  # the mean rank is exact
    joined = points.join(of("x"), [*pair, "x"]).join(of("y"), [*pair, "y"]).join(middle, pair)
    sums = joined.groupBy(*pair).agg(F.sum("n").alias("n"), F.sum(F.col("n") * a * b).alias("ab"),
                                     F.sum(F.col("n") * a * a).alias("aa"), F.sum(F.col("n") * b * b).alias("bb"))
    spread = F.sqrt(F.col("aa")) * F.sqrt(F.col("bb"))
    return sums.select(*pair, "n", (F.col("ab") / F.when(spread > 0, spread)).alias("corr"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder: read several times below, computed once."""
    return sinks.read_back(df.sparkSession, sinks.write_parquet(df, shared_dir(df.sparkSession, name), verify=False))


def seasonal_stats(daily: DataFrame, value: str = "avg_tempC", date_column: str = "date",
                   series_keys: tuple[str, ...] = ()) -> DataFrame:
    """[series keys], season, n, mean, p50 (exact median), skewness, kurtosis
    (population, excess) of ``value`` per season.

    The input is a daily frame: a group holds at most one row per day of the
    season, so the exact median's buffer is bounded by the calendar.
    """
    v = F.col(value)
    return (daily.withColumn("season", season(F.month(date_column)))
            .groupBy(*series_keys, "season")
            .agg(F.count(v).alias("n"), F.avg(v).alias("mean"),
                 F.percentile(v, 0.5).alias("p50"),
                 F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis")))


def seasonal_decomposition(daily: DataFrame, value: str = "avg_tempC", date_column: str = "date",
                           half_width: int = 3, series_keys: tuple[str, ...] = ()) -> DataFrame:
    """[series keys], date, observed, trend, seasonal, remainder.

    trend: centred moving average over +-``half_width`` rows within the month;
    seasonal: mean detrended value of the calendar month across years;
    remainder: observed - trend - seasonal.

    Both windows run on one exchange: rows are hash-partitioned by (series,
    calendar month), which also clusters every (series, year, month); the
    trend window is partitioned in the order (series, month, year) so that
    its sort already orders the seasonal window's partitions. A partition is
    one calendar month of one series across the years: bounded by the
    calendar, however large the readings behind the daily frame.
    """
    date = F.col(date_column)
    keys = [F.col(k) for k in series_keys]
    base = daily.select(*keys, date.alias("date"), F.col(value).alias("observed"),
                        F.year(date).alias("_y"), F.month(date).alias("_m"))
    base = base.repartition(*keys, F.col("_m"))
    centred = (Window.partitionBy(*keys, "_m", "_y").orderBy("date")
               .rowsBetween(-half_width, half_width))
    with_trend = base.withColumn("trend", F.avg("observed").over(centred))
    by_month = Window.partitionBy(*keys, "_m")
    with_season = with_trend.withColumn(
        "seasonal", F.avg(F.col("observed") - F.col("trend")).over(by_month))
    return with_season.select(
        *series_keys, "date", "observed", "trend", "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("remainder"))


def anomaly_zscore(daily: DataFrame, value: str = "avg_tempC", date_column: str = "date",
                   lookback: int = 7, threshold: float = 3.0,
                   series_keys: tuple[str, ...] = ()) -> DataFrame:
    """[series keys], date, <value>, zscore for rows whose value lies more than
    ``threshold`` trailing standard deviations from the trailing mean of the
    previous ``lookback`` rows of the same month (the current row excluded)."""
    date = F.col(date_column)
    w = (Window.partitionBy(*series_keys, F.year(date), F.month(date))
         .orderBy(date).rowsBetween(-lookback, -1))
    v = F.col(value)
    scored = daily.select(*series_keys, date.alias("date"), v, F.avg(v).over(w).alias("_mu"),
                          F.stddev_samp(v).over(w).alias("_sd"))
    z = F.when(F.col("_sd") > 0, (F.col(value) - F.col("_mu")) / F.col("_sd"))
    return (scored.withColumn("zscore", z).where(F.abs(F.col("zscore")) > threshold)
            .select(*series_keys, "date", value, "zscore"))


def change_points(daily: DataFrame, value: str = "avg_tempC", date_column: str = "date",
                  penalty: float = 3.0, series_keys: tuple[str, ...] = ()) -> DataFrame:
    """[series keys], segment, start_date, end_date, n_days, mean, change: the stretches of
    a series between shifts of its mean, numbered from 1 by date.

    The segmentation is the one of least cost: squared deviations from the segments' means
    plus, for each segment, ``penalty`` * s2 * ln(n), where s2 is the noise of the series:
    the squared median absolute difference of neighbouring days, scaled for normal noise.
    (At least 1e-6, so that a series whose days mostly agree is still cut where it shifts.)
    ``change`` is a segment's mean less the one before it, null for the first.

    Solved exactly by dynamic programming over the days; a start that already costs more
    than the best cut at some day can never win later and is dropped, so few are kept.
    The recurrence runs inside one series' array, a row per day of the calendar, however
    many readings stand behind a day. Days without a value are left out, rows of one date
    are taken as they come by (date, value), an empty frame gives no rows.
    """
    day = F.struct(F.col(date_column).alias("d"), F.col(value).cast("double").alias("v"))
    usable = daily.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    if series_keys:  # small arrays, much work each: as many tasks as the session has, not merged to few
        usable = usable.repartition(int(usable.sparkSession.conf.get("spark.sql.shuffle.partitions")), *series_keys)
    series = usable.groupBy(*series_keys).agg(F.array_sort(F.collect_list(day)).alias("days")).where("size(days) > 0")
    series = series.withColumn("n", F.size("days")).withColumn(
        "mu", F.aggregate("days", F.lit(0.0), lambda a, x: a + x["v"]) / F.col("n"))
    # Median absolute difference of neighbours; 0.9539 is that of unit normal noise.
    steps = F.when(F.col("n") > 1, F.array_sort(F.transform(
        F.sequence(F.lit(2), F.greatest(F.col("n"), F.lit(2))),
        lambda i: F.abs(F.col("days")[i - 1]["v"] - F.col("days")[i - 2]["v"]))))
    series = series.withColumn("steps", steps)
    m = F.size("steps")
    middle = (F.element_at("steps", ((m + 1) / 2).cast("int")) + F.element_at("steps", (m / 2).cast("int") + 1)) / 2
    noise = F.when(F.col("n") > 1, middle / 0.9539).otherwise(F.lit(0.0))
    series = series.withColumn("beta", F.greatest(F.lit(penalty) * noise * noise * F.log(F.col("n").cast("double")), F.lit(1e-6)))

    def begin(at, base, s):
        return F.struct(base.alias("now"), at.alias("at"), base.alias("base"), s.alias("s"))

    def turn(t, s, opened, best, cut):
        return F.struct(t.alias("t"), s.alias("s"), opened.alias("open"), best.alias("best"), cut.alias("cut"))

    zero = F.lit(0.0)
    first = begin(F.lit(0), zero, zero)

    # Costs are kept less the sum of squares up to their day, which is the same for all starts.
    def extend(state, x):
        """Each start's cost with one segment from there to this day, but for the penalty."""
        s, t = state["s"] + x["v"], state["t"] + 1
        opened = F.transform(state["open"], lambda c: F.struct(
            (c["base"] - (s - c["s"]) * (s - c["s"]) / (t - c["at"])).alias("now"), c["at"].alias("at"), c["base"].alias("base"), c["s"].alias("s")))
        return turn(t, s, opened, state["best"], state["cut"])

    def choose(state, x):
        """The least cost, and of equal ones the earliest start; kept, so that it is found once a day."""
        return turn(state["t"], state["s"], state["open"], F.array_min(state["open"]), state["cut"])

    def prune(state, x):
        best = state["best"]
        kept = F.filter(state["open"], lambda c: c["now"] <= best["now"] + x["beta"])
        return turn(state["t"], state["s"], F.array_append(kept, begin(state["t"], best["now"] + x["beta"], state["s"])),
                    best, F.array_append(state["cut"], best["at"]))

    centred = F.transform("days", lambda x: F.struct((x["v"] - F.col("mu")).alias("v"), F.col("beta").alias("beta")))
    # Each day goes in three times: costs of all starts, the best of them, starts that can no longer win.
    turns = F.flatten(F.transform(centred, lambda x: F.array(*[
        F.struct(x["v"], x["beta"], F.lit(k).alias("turn")) for k in range(3)])))
    start = turn(F.lit(0), zero, F.array(first), first, F.array().cast("array<int>"))
    series = series.withColumn("cut", F.aggregate(
        turns, start, lambda a, x: F.when(x["turn"] == 0, extend(a, x)).when(x["turn"] == 1, choose(a, x)).otherwise(prune(a, x)),
        lambda a: a["cut"]))
    back = F.aggregate(
        "cut", F.struct(F.col("n").alias("at"), F.array().cast("array<int>").alias("ends")),
        lambda a, _: F.when(a["at"] > 0, F.struct(F.element_at("cut", F.greatest(a["at"], F.lit(1))).alias("at"),
                                                  F.array_append(a["ends"], a["at"]).alias("ends"))).otherwise(a),
        lambda a: F.reverse(a["ends"]))
    series = series.withColumn("ends", back)
    bounds = F.transform("ends", lambda e, i: F.struct(
        (i + 1).alias("segment"), F.when(i > 0, F.col("ends")[i - 1]).otherwise(F.lit(0)).alias("a"), e.alias("b")))
    cuts = series.select(*series_keys, "days", F.explode(bounds).alias("c"))
    part = F.slice("days", F.col("c.a") + 1, F.col("c.b") - F.col("c.a"))
    found = cuts.select(*series_keys, "c.segment", F.col("days")[F.col("c.a")]["d"].alias("start_date"),
                        F.col("days")[F.col("c.b") - 1]["d"].alias("end_date"), (F.col("c.b") - F.col("c.a")).alias("n_days"),
                        (F.aggregate(part, F.lit(0.0), lambda a, x: a + x["v"]) / (F.col("c.b") - F.col("c.a"))).alias("mean"))
    earlier = Window.partitionBy(*series_keys).orderBy("segment")
    return found.withColumn("change", F.col("mean") - F.lag("mean").over(earlier))
