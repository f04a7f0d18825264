"""``page_events``: canonical page-create events derived from the driver's tables.

``events`` supplies the event id, time, user and type, ``pages`` the url and
the HTML whose <title> becomes the page title. Each event is matched to page
``event_id mod count(pages)``. Thirty days of event time are compressed sixty
times into twelve hours so one- and ten-minute windows hold several rows.

Scale notes: the page count and the exact size of the page side come from one
aggregate over the page projection. The per-page work (two regex extractions over the whole HTML) runs once per
page, before the join. The join is an equi-join on the slot number, which is
uniform (no hot key). ``pages`` grows with the data, so its projected side is
measured first (exact byte count, one aggregate over the projection): within
the session's broadcast threshold it is cached and broadcast, and the events
are joined map-side without a shuffle; beyond it the join is a shuffle join.
The events side is never the broadcast side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.timefn import micros_between
from pageflow.operators.joins import checked_broadcast, measure
from pageflow.session import scratch_path

# Fixed values of the adapter (they define the test data's derived columns).
HOST_PATTERN = r"^https?://([^/?#]+)"
SITE_PATTERN = r"([^.]+[.][^.]+)$"
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
TIME_ORIGIN = "2024-01-01 00:00:00"
TIME_COMPRESSION = 60
URL_TITLE_EVERY, SHORT_TITLE_EVERY, DOUBLE_TITLE_EVERY = 97, 89, 83
BOT_USER_EVERY = 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Length and modification time of the adapter's two tables: what is derived from them is kept as long as they stay."""
    states = []
    for name in ("events", "pages"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        states.append((int(fs.getContentSummary(path).getLength()), int(fs.getFileStatus(path).getModificationTime())))
    return tuple(states)


def spread_small_input(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the cluster has cores.

    A small table stored as one file / row group scans in a single task, and so
    does everything fused onto that scan (join probe, tokenising, partial
    aggregation). Below ``defaultParallelism`` splits the rows are spread over
    all cores; a large table (more splits than cores) is returned unchanged,
    so no shuffle is ever added to a big scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def page_sites(pages: DataFrame) -> DataFrame:
    """pages -> (slot, url, site, title): the per-page work, done once per page before the join."""
    host = F.regexp_extract("url", HOST_PATTERN, 1)
    return pages.select(
        F.col("page_id").alias("_slot"),
        F.col("url").alias("_url"),
        F.regexp_extract(host, SITE_PATTERN, 1).alias("_site"),
        F.trim(F.regexp_extract("html", TITLE_PATTERN, 1)).alias("_title"),
    )


def compressed_time(ts: Column) -> Column:
    origin = F.lit(TIME_ORIGIN).cast("timestamp_ntz")
    return F.timestamp_add(
        "MICROSECOND", F.floor(micros_between(origin, ts) / TIME_COMPRESSION), origin)


def events_to_page_events(events: DataFrame, sites: DataFrame, n_pages: int) -> DataFrame:
    """Join events with their page and project the canonical event columns."""
    eid = F.col("event_id")
    title = (F.when(eid % URL_TITLE_EVERY == 0, F.col("_url"))
             .when(eid % SHORT_TITLE_EVERY == 0, F.substring("_title", 1, 2))
             .when(eid % DOUBLE_TITLE_EVERY == 0, F.concat_ws(" ", "_title", "_title"))
             .otherwise(F.col("_title")))
    slotted = events.select("event_id", "ts", "user_id", "event_type",
                            F.pmod(eid, F.lit(n_pages)).alias("_slot"))
    joined = slotted.join(sites, "_slot")
    return joined.select(
        F.concat(F.col("_site"), F.lit("/"), F.col("event_type")).alias("domain"),
        eid.alias("page_id"),
        title.alias("page_title"),
        F.col("user_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_name"),
        (F.col("user_id") % BOT_USER_EVERY == 0).alias("is_bot"),
        compressed_time(F.col("ts")).alias("created_at"),
    ).withColumn("title_length", F.length("page_title").cast("int"))


def page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events (created_at TIMESTAMP_NTZ, UTC wall clock) over ``sf_dir``."""
    events = spread_small_input(read_table(spark, sf_dir, "events")
                                .select("event_id", "ts", "user_id", "event_type"))
    sites, n_pages = _measured_sites(spark, sf_dir)
    return events_to_page_events(events, sites, n_pages)


def _measured_sites(spark: SparkSession, sf_dir: str, stored: bool = False) -> tuple[DataFrame, int]:
    """The page side and the page count, from one aggregate (count and exact size).

    ``stored``: a side too large to be broadcast is written once, for a reader that joins it many times.
    """
    sites = page_sites(read_table(spark, sf_dir, "pages"))
    n_pages, size = measure(sites)
    sites, small = checked_broadcast(sites, size=size)
    if stored and not small:
        path = scratch_path(spark, "sites")
        sites.write.parquet(path)
        sites = spark.read.parquet(path)
    return sites, n_pages


def files_by_time(events: DataFrame, column: str, n: int, folder: str) -> None:
    """The rows in about ``n`` files whose modification times are in the order of ``column``, as if they arrived like that.

    Every file holds one range, so a stream that takes a file per micro-batch meets no late row, and its state holds the
    windows that are still open, however many rows there are. Nulls come first.
    """
    spark = events.sparkSession
    events.repartitionByRange(n, F.asc_nulls_first(column)).write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def files():
        return [f for f in fs.listStatus(path) if f.getPath().getName().startswith("part-")]

    # part numbers are in the order of the ranges; whole seconds suit any file system
    named = sorted(files(), key=lambda f: f.getPath().getName())
    last = min((f.getModificationTime() for f in named), default=0) // 1000
    for i, f in enumerate(named):
        fs.setTimes(f.getPath(), (last - len(named) + i) * 1000, -1)
    arrived = [f.getPath().getName() for f in sorted(files(), key=lambda f: f.getModificationTime())]
    if arrived != [f.getPath().getName() for f in named]:
        raise RuntimeError(f"the file system of {folder} keeps no modification times, which order the files of a stream")


def stream_page_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None, batch_rows: int | None = None) -> DataFrame:
    """The same adapter with ``events`` read as a file stream (stream-static join).

    created_at becomes a TIMESTAMP (session zone UTC) because watermarks refuse NTZ. With ``batch_rows`` a larger table is
    read in the order of time, about so many rows per micro-batch (see :func:`files_by_time`).
    """
    columns = ("event_id", "ts", "user_id", "event_type")
    static = read_table(spark, sf_dir, "events")
    parts = -(-static.count() // batch_rows) if batch_rows else 1
    # same rule as the batch adapter, judged on a batch view of the source (a
    # stream has no partition count before it runs); a Kafka source would use
    # its ``minPartitions`` option for this instead
    cores = spark.sparkContext.defaultParallelism
    spread = parts > 1 or static.rdd.getNumPartitions() < cores
    if parts > 1:
        folder = scratch_path(spark, "arrivals")
        static = static.select(*columns)
        files_by_time(static, "ts", parts, folder)
        events = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    else:
        reader = (spark.readStream.schema(static.schema)
                  .option("pathGlobFilter", "events.parquet"))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        events = reader.parquet(sf_dir).select(*columns)
    if spread:
        events = events.repartition(cores)
    sites, n_pages = _measured_sites(spark, sf_dir, stored=parts > 1)
    out = events_to_page_events(events, sites, n_pages)
    return out.withColumn("created_at", F.col("created_at").cast("timestamp"))
