"""Scoping, unit normalisation, top-N, gap filling and event labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.functions.calendar import Grid, business_day, fiscal_year, interval_index


#: Fixed value: the label of spikes that no event explains.
UNEXPLAINED = "UNEXPLAINED_SPIKE"


def scope(rows: DataFrame, environments: list[str], lpars: list[str] | None = None, grid: Grid = Grid()) -> DataFrame:
    """Rows of the environments (and lpars) in prime time, with business_date, interval_idx and fiscal_year."""
    df = rows.where(F.col("environment").isin(environments))
    if lpars:
        df = df.where(F.col("lpar").isin(lpars))
    df = df.withColumns({"business_date": F.to_date("ts"), "interval_idx": interval_index(F.col("ts"), grid)})
    df = df.where((F.col("interval_idx") >= 0) & business_day(F.col("business_date"), grid))
    return df.withColumn("fiscal_year", fiscal_year(F.col("business_date"), grid))


def scope_report(rows: DataFrame, environments: list[str], grid: Grid = Grid()) -> DataFrame:
    """One row: rows in and out, and what each filter dropped, in order."""
    env = F.coalesce(F.col("environment").isin(environments), F.lit(False))
    prime = (interval_index(F.col("ts"), grid) >= 0) & business_day(F.to_date("ts"), grid)
    return rows.agg(
        F.count("*").alias("rows_in"), F.count_if(~env).alias("dropped_non_prod"), F.count_if(env & ~prime).alias("dropped_off_prime"), F.count_if(env & prime).alias("rows_out"),
        F.min(F.when(env & prime, F.to_date("ts"))).alias("first_date"), F.max(F.when(env & prime, F.to_date("ts"))).alias("last_date"),
    )


def _lookup(values: dict[str, float], key: Column, default: float) -> Column:
    return F.coalesce(*[F.when(key == k, F.lit(float(v))) for k, v in sorted(values.items())], F.lit(float(default)))


def normalise(rows: DataFrame, ratios: dict[str, float], ratio: float, factor: float) -> DataFrame:
    """mips = msu * factor / capture ratio where mips is missing; both factors are recorded."""
    if min([ratio, *ratios.values()]) <= 0:
        raise ValueError("capture ratios must be positive")
    df = rows.withColumns({"capture_ratio": _lookup(ratios, F.col("lpar"), ratio), "mips_per_msu": F.lit(float(factor))})
    made = F.col("msu") * F.col("mips_per_msu") / F.col("capture_ratio")
    return df.withColumn("mips", F.coalesce("mips", made) if "mips" in rows.columns else made)


def audit(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lpar", "capture_ratio", "mips_per_msu").agg(F.count("*").alias("n_rows"), F.avg("mips").alias("mean_mips"), F.max("mips").alias("max_mips"))


def top_apps(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the n apps with the largest mean load."""
    best = rows.groupBy("app_id").agg(F.avg("mips").alias("m")).orderBy(F.desc("m"), "app_id").limit(n).select("app_id")
    return rows.join(best, "app_id", "left_semi")


def densify(rows: DataFrame) -> DataFrame:
    """Every app, interval and date present anywhere; loads summed over lpars, gaps null."""
    cells = rows.groupBy("app_id", "business_date", "interval_idx").agg(F.sum("mips").alias("mips"))
    days = rows.select("business_date").distinct()
    lanes = rows.select("app_id").distinct().join(rows.select("interval_idx").distinct(), how="cross")  # apps by intervals of a day
    return lanes.join(days, how="cross").join(cells, ["app_id", "business_date", "interval_idx"], "left")


def fill(rows: DataFrame) -> DataFrame:
    """`densify`, with gaps interpolated by day position within app and interval; ends take the nearest."""
    lane = Window.partitionBy("app_id", "interval_idx").orderBy("business_date")
    df = densify(rows).withColumn("pos", F.row_number().over(lane))
    back, on = lane.rowsBetween(Window.unboundedPreceding, 0), lane.rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col("mips").isNotNull(), F.struct("pos", "mips"))
    df = df.withColumns({"a": F.last(known, True).over(back), "b": F.first(known, True).over(on)})
    between = F.col("a.mips") + (F.col("b.mips") - F.col("a.mips")) * (F.col("pos") - F.col("a.pos")) / F.nullif(F.col("b.pos") - F.col("a.pos"), F.lit(0))
    value = F.coalesce("mips", between, "a.mips", "b.mips")
    return df.select("app_id", "business_date", "interval_idx", value.alias("mips"), F.col("mips").isNull().alias("is_filled"))


def label(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows (ts, app_id, lpar) with event_label and is_anomaly from half-open windows; '*' matches all, the first event in order wins.

    Windows are spread over the hours they touch, so the join has an equality key; each row meets the few
    windows of its own hour. Rows that come with is_anomaly set keep it and their own event_label, whatever windows
    say; on others a label without is_anomaly stays where no window says otherwise.
    """
    for c, kind in (("is_anomaly", "boolean"), ("event_label", "string")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    hour = F.explode(F.sequence(F.date_trunc("hour", "start_ts").cast("timestamp_ntz"), F.col("end_ts"), F.expr("INTERVAL 1 HOUR")))
    w = windows.select(
        "event_seq", F.col("event_type").alias("kind"), F.col("lpar").alias("w_lpar"), F.col("app_id").alias("w_app"), "start_ts", "end_ts", hour.alias("hour")
    )
    keyed = rows.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    hit = keyed.select("hour", "ts", "app_id", "lpar").distinct().join(w, "hour").where(
        (F.col("ts") >= F.col("start_ts")) & (F.col("ts") < F.col("end_ts")) & F.col("w_lpar").isin("*") | (F.col("ts") >= F.col("start_ts")) & (F.col("ts") < F.col("end_ts")) & (F.col("w_lpar") == F.col("lpar"))
    ).where((F.col("w_app") == "*") | (F.col("w_app") == F.col("app_id")))
    first = hit.groupBy("ts", "app_id", "lpar").agg(F.min_by("kind", "event_seq").alias("_kind"))
    given = F.coalesce("is_anomaly", F.lit(False))
    out = keyed.drop("hour").join(first, ["ts", "app_id", "lpar"], "left")
    out = out.withColumn("event_label", F.when(given, F.col("event_label")).otherwise(F.coalesce("_kind", "event_label")))
    return out.withColumn("is_anomaly", given | F.col("_kind").isNotNull()).drop("_kind")


def spikes(rows: DataFrame, width: int = 20, z: float = 6.0, least: float = 0.0) -> DataFrame:
    """Rows with robust z scores from centred rolling medians per app and interval, and whether they are spikes.

    Loads below `least` and rows with is_anomaly set are none.
    """
    lane = Window.partitionBy("app_id", "interval_idx")
    near = lane.orderBy("business_date").rowsBetween(-(width // 2), width - width // 2 - 1)

    def rolled(c: str) -> Column:
        return F.when(F.count(c).over(near) >= 5, F.percentile(c, 0.5).over(near))

    def filled(c: str) -> Column:
        by = lane.orderBy("business_date")
        return F.coalesce(c, F.first(c, True).over(by.rowsBetween(0, Window.unboundedFollowing)), F.last(c, True).over(by.rowsBetween(Window.unboundedPreceding, 0)))

    df = rows.withColumns({"_n": F.count("*").over(lane), "_m": rolled("mips")}).withColumn("_m", filled("_m"))
    df = df.withColumn("_d", F.abs(F.col("mips") - F.col("_m"))).withColumn("_s", rolled("_d")).withColumn("_s", filled("_s") * 1.4826)
    score = F.when(F.col("_n") >= max(5, width // 2), (F.col("mips") - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0)))
    unexplained = ~F.coalesce("is_anomaly", F.lit(False)) if "is_anomaly" in rows.columns else F.lit(True)
    high = (F.col("z") > z) & F.coalesce(F.col("mips") >= least, F.lit(False)) & unexplained
    return df.withColumn("z", F.coalesce(score, F.lit(0.0))).withColumn("is_spike", high).drop("_n", "_m", "_d", "_s")


def anomaly_report(rows: DataFrame) -> DataFrame:
    """Per app and label: intervals, dates and largest load of the anomalies, and of spikes nothing explains where rows have is_spike."""
    figures = [F.count("*").alias("intervals"), F.countDistinct("business_date").alias("days"), F.max("mips").alias("max_mips")]
    out = rows.where("is_anomaly").groupBy("app_id", F.col("event_label").alias("label")).agg(*figures)
    if "is_spike" in rows.columns:
        out = out.unionByName(rows.where("is_spike").groupBy("app_id").agg(*figures).withColumn("label", F.lit(UNEXPLAINED)))
    return out.select("app_id", "label", "intervals", "days", "max_mips")


def missing(rows: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """One row: expected (intervals of all business days from the first date to the last, for each app), present, missing.

    `missing` is below 0 where apps have rows of several lpars.
    """
    seen = rows.agg(F.min("business_date").alias("a"), F.max("business_date").alias("b"), F.countDistinct("app_id").alias("apps"), F.count("*").alias("present"))
    day = F.explode_outer(F.sequence("a", "b", F.expr("INTERVAL 1 DAY")))
    days = seen.select("apps", "present", day.alias("d")).groupBy("apps", "present").agg(F.count_if(business_day(F.col("d"), grid)).alias("days"))
    expected = F.col("days") * F.col("apps") * grid.per_day
    return days.select(expected.alias("expected"), "present", (expected - F.col("present")).alias("missing"))


def clean_days(rows: DataFrame) -> DataFrame:
    """Dates without an anomaly in any app."""
    return rows.select("business_date").distinct().join(rows.where("is_anomaly").select("business_date").distinct(), "business_date", "left_anti")
