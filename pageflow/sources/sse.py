"""Server-sent-events dumps: blank-line separated frames -> one JSON text per event.

A frame is the block of lines between blank lines. Only ``data:`` lines count;
their payloads (trimmed) are joined with a newline. Comments (``:``) and other
fields (``event:``, ``id:``, ``retry:``) are ignored, and frames without data
produce nothing. Records are split by the text source itself (``lineSep``),
so every file is read in parallel splits and no frame is assembled on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FRAME_SEPARATOR = "\n\n"
BLANK_LINE = r"\n[ \t\r]*\n"


def frame_data(frame: Column) -> Column:
    """The joined ``data:`` payload of one frame (empty string when there is none)."""
    lines = F.transform(F.split(frame, "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    data = F.filter(lines, lambda x: x.startswith("data:"))
    return F.array_join(F.transform(data, lambda x: F.trim(F.substring(x, 6, 1 << 30))), "\n")


def sse_values(frames: DataFrame, frame_col: str = "value") -> DataFrame:
    """The payloads of all frames; a record that holds several (CRLF line ends, blank lines of spaces) is cut further."""
    one = frames.select(F.explode(F.split(F.col(frame_col), BLANK_LINE)).alias("frame"))
    return (one.select(frame_data(F.col("frame")).alias("value"))
            .filter(F.col("value") != ""))


def read_sse_dump(spark: SparkSession, path: str, streaming: bool = False,
                  max_files_per_trigger: int | None = None, separator: str = FRAME_SEPARATOR) -> DataFrame:
    """Captured SSE text files (batch or file stream) -> DataFrame[value: JSON text].

    Files with CRLF line ends give the same rows, but the default reads such a file as one record: name
    ``separator="\\r\\n\\r\\n"`` or read large ones by :func:`read_sse_lines`.
    """
    if streaming:
        reader = spark.readStream.option("lineSep", separator)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        frames = reader.text(path)
    else:
        frames = spark.read.option("lineSep", separator).text(path)
    return sse_values(frames)


def read_sse_lines(spark: SparkSession, path: str) -> DataFrame:
    """Captured SSE text files of any line ends (LF, CRLF, CR, mixed) -> DataFrame[value: JSON text]; a batch only.

    Files are read by lines in parallel splits of any size. A line's frame is the number of blank lines before it in its
    file: those of its split are counted in the order of lines, those of earlier splits come from one count per split.
    Frames are then put together by that number, wherever a split cuts them.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), F.btrim("value", F.lit(" \t\r")).alias("text"))
    blank = (F.col("text") == "").cast("long")
    # a file may end without a line end or blank line: frames never go on in another file
    per_split = lines.groupBy("file", "split").agg(F.sum(blank).alias("blanks"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    per_split = per_split.select("file", "split", F.coalesce(F.sum("blanks").over(earlier), F.lit(0)).alias("before"))
    in_split = Window.partitionBy("file", "split").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = lines.withColumn("here", F.sum(blank).over(in_split)).where(F.col("text").startswith("data:"))
    payload = F.trim(F.substring("text", 6, 1 << 30))
    frames = (numbered.join(per_split, ["file", "split"])
              .groupBy("file", (F.col("before") + F.col("here")).alias("frame"))
              .agg(F.sort_array(F.collect_list(F.struct("split", "line", payload.alias("data")))).alias("parts")))
    return frames.select(F.array_join(F.col("parts.data"), "\n").alias("value")).filter(F.col("value") != "")


def to_sse_frames(values: DataFrame, value_col: str = "value", id_col: str | None = None) -> DataFrame:
    """JSON texts -> SSE frame text (the writer's newline closes each frame).

    A comment line precedes every frame; a payload containing ``,"`` is split
    into two ``data:`` lines at that point, which the reader joins back with a
    newline (still the same JSON document).
    """
    v = F.col(value_col)
    pos = F.instr(v, ',"')
    payload = F.when(pos > 0, F.concat(F.lit("data: "), F.substring(v, 1, pos), F.lit("\ndata: "),
                                       F.expr(f"substring({value_col}, instr({value_col}, ',\"') + 1)")))\
        .otherwise(F.concat(F.lit("data: "), v))
    head = F.lit(":ok\nevent: message\n")
    if id_col:
        head = F.concat(head, F.lit("id: "), F.col(id_col).cast("string"), F.lit("\n"))
    return values.select(F.concat(head, payload, F.lit("\n")).alias("value"))
