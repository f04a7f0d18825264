"""Fields the upstream job declared but filled with constants, computed for real.

None of these uses a window partitioned by site only (a site can hold a third
of all rows): neighbouring windows are found by equi-joins on (site, window),
and top-k per window is limited map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageflow.functions.timefn import micros_between


def with_trend(metrics: DataFrame, window_minutes: int = 1, band: float = 0.2) -> DataFrame:
    """trend = up / down / stable against the adjacent previous window of the same site.

    A previous window without rows counts as zero pages. ``up`` means more than
    (1 + band) times the previous count, ``down`` less than (1 - band) times.

    One pass: every metric row is emitted for its own window and, as history,
    for the next window; a single aggregation per (site, window) then holds the
    current row and the previous count. No self-join, so the metrics are
    computed once even when they are derived from raw events.
    """
    cols = [c for c in metrics.columns if c != "trend"]
    nxt = F.timestamp_add("MINUTE", F.lit(window_minutes), F.col("window_start"))
    copies = metrics.select(
        "domain",
        F.explode(F.array(
            F.struct(F.col("window_start").alias("at"), F.lit(True).alias("current")),
            F.struct(nxt.alias("at"), F.lit(False).alias("current")))).alias("_c"),
        F.struct(*cols).alias("_row"))
    grouped = copies.groupBy("domain", F.col("_c.at").alias("_at")).agg(
        F.max(F.when(F.col("_c.current"), F.col("_row"))).alias("_cur"),
        F.sum(F.when(~F.col("_c.current"), F.col("_row.pages_created"))).alias("_prev"))
    p = F.coalesce(F.col("_prev"), F.lit(0))
    n = F.col("_cur.pages_created")
    trend = (F.when(n > p * (1 + band), F.lit("up"))
             .when(n < p * (1 - band), F.lit("down"))
             .otherwise(F.lit("stable")))
    return (grouped.filter(F.col("_cur").isNotNull())
            .select(*[F.col(f"_cur.{c}").alias(c) for c in cols],
                    trend.alias("trend"), p.cast("int").alias("previous_pages")))


def top_actors(events: DataFrame, window: str = "1 minute", n: int = 3) -> DataFrame:
    """Top ``n`` user names by pages per (site, window), bots and humans separately, as JSON.

    Ties go to the most recently active name, then the name. Rows with a null
    is_bot are in neither list.
    """
    per_name = (events.filter(F.col("is_bot").isNotNull())
                .groupBy("domain", F.window("created_at", window).alias("w"), "is_bot",
                         F.col("user_name").alias("name"))
                .agg(F.count(F.lit(1)).alias("pages"), F.max("created_at").alias("_last")))
    rank = F.row_number().over(Window.partitionBy("domain", "w", "is_bot")
                               .orderBy(F.desc("pages"), F.desc("_last"), "name"))
    top = per_name.withColumn("_rank", rank).filter(F.col("_rank") <= n)

    def as_json(flag: bool):
        picked = F.collect_list(F.when(F.col("is_bot") == flag,
                                       F.struct("_rank", "name", "pages")))
        ordered = F.transform(F.sort_array(picked), lambda x: F.struct(x["name"].alias("name"),
                                                                        x["pages"].alias("pages")))
        return F.to_json(ordered)

    return top.groupBy("domain", "w").agg(
        as_json(True).alias("top_bots"), as_json(False).alias("top_humans")
    ).select("domain", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             "top_bots", "top_humans")


def spike_ratio(counts: DataFrame, window_minutes: int = 10, history: int = 6,
                min_occurrences: int | None = None) -> DataFrame:
    """occurrences / (mean occurrences over the ``history`` previous windows).

    Null when the previous windows hold no occurrence. A range frame over the counts of one (site,
    keyword) sums them, so the counts are shuffled once and a partition holds a row per window at
    most. With ``min_occurrences`` only windows at or above it are reported (the burst threshold);
    the others still count as history.
    """
    step = window_minutes * 60_000_000
    at = micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("window_start").cast("timestamp_ntz"))
    earlier = Window.partitionBy("domain", "keyword").orderBy("_at").rangeBetween(-history * step, -step)
    rows = counts.withColumn("_at", at).withColumn("_hist", F.sum("occurrences").over(earlier))
    if min_occurrences is not None:
        rows = rows.filter(F.col("occurrences") >= min_occurrences)
    ratio = F.when(F.col("_hist") > 0, (F.col("occurrences") * F.lit(history)).cast("double") / F.col("_hist"))
    return rows.select("domain", "keyword", *[c for c in counts.columns if c not in ("domain", "keyword")],
                       ratio.alias("spike_ratio"))
