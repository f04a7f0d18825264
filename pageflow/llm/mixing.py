"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Every source has a weight schedule over training time 0..1. Its integral, scaled to the source's target, is
the source's cumulative demand of words. A source's documents lie one after the other on that demand in a
fixed random order, again and again until it is met; inverting the demand gives every use of a document its
training position, and uses are range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm.common import staged

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: A source's schedule is linear: its weight at time t is proportional to 1 + SLOPES[i] * (2t - 1), so each
#: integrates to 1. Heavy sources fade, light sources grow.
SLOPES = (-0.5, 0.0, 0.5)


def words_in(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``, 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, rows, rank, target) from rows (source, size).

    Sources by code point, null last, take the weights in turn and share all words; a target stops at
    ``max_epochs`` times its source's size and the excess goes to the others by weight until none is above.
    Solved in closed form: sources reach their limit in order of size / weight, so running sums in that order
    say who does. One row per source; the windows hold that table alone.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.get(F.lit(list(weights)), F.pmod("rank", F.lit(len(weights)))).cast("double"))
    limit = F.col("source_size") * float(max_epochs)
    everything = Window.partitionBy()
    by_limit = Window.orderBy((limit / F.col("weight")).asc(), F.col("rank")).rowsBetween(Window.unboundedPreceding, -1)
    rest_words = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(by_limit), F.lit(0.0))
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0.0))
    # the level at which the remaining sources would share what earlier ones leave; the first source below its limit fixes it
    per = per.withColumn("level", rest_words / rest_weight).withColumn("limit_level", limit / F.col("weight"))
    per = per.withColumn("fixed", F.min(F.when(F.col("level") <= F.col("limit_level"), F.struct("limit_level", "rank", "level"))).over(everything))
    target = F.when(F.col("fixed").isNull(), limit).otherwise(F.least(limit, F.col("fixed.level") * F.col("weight")))
    return per.select("source", "source_size", "rows", "rank", target.alias("target"))


def position(share: Column, slope: Column) -> Column:
    """Training time at which a linear schedule has met ``share`` of its demand (inverse of its integral).

    The integral of 1 + s (2t - 1) is (1 - s) t + s t^2.
    """
    root = F.sqrt(F.greatest(F.lit(0.0), (1 - slope) * (1 - slope) + 4 * slope * share))
    return F.when(slope == 0, share).otherwise(2 * share / (1 - slope + root))


def _row_key(docs: DataFrame) -> Column:
    """One value for rows alike in all columns (maps left out, which have no hash)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()])


def _mixed(docs: DataFrame, weights, max_epochs: int, slopes) -> DataFrame:
    """One row per document: size, source's figures, its start on the source's stream, and uses."""
    rows = staged(docs.withColumn("row_key_", _row_key(docs)).select(
        "doc_id", "source", words_in(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text", F.lit("order")).alias("h"), F.xxhash64("text").alias("text_key"), F.col("row_key_").alias("row_key")))
    per = staged(targets(rows, weights, max_epochs))  # a row per source
    rows = _with_source(rows, per)
    # running words of a source in hash order: buckets of the hash keep a hot source out of one task
    # as many buckets as rows in each, so neither the buckets' sums nor the rows of one grow faster than the root
    buckets = F.ceil(F.sqrt(F.col("rows"))).cast("long")
    rows = rows.withColumn("bucket", F.floor((F.shiftrightunsigned(F.col("h"), 33).cast("double") / float(1 << 31)) * buckets).cast("long"))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("s"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("rank").alias("rank_"), F.col("bucket").alias("bucket_"),
                       F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"))
    inside = (Window.partitionBy("rank", "bucket").orderBy(F.shiftrightunsigned(F.col("h"), 0), "doc_id", "text_key", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("own", F.sum("size").over(inside) - F.col("size")).withColumn("place", F.count("*").over(inside))
    rows = rows.join(sums, (F.col("rank") == F.col("rank_")) & (F.col("bucket") == F.col("bucket_")))
    start = F.col("before") + F.col("own")
    # use u of a document begins at start + u * source_size; the mix takes the uses whose middle lies below the target
    uses = F.ceil((F.col("target") - start - F.col("size") / 2) / F.col("source_size"))
    uses = F.when(F.col("size") == 0, F.when(F.col("target") > 0, F.ceil(F.col("target") / F.col("source_size"))).otherwise(0)).otherwise(uses)
    uses = F.least(F.lit(max_epochs), F.greatest(F.lit(0), uses)).cast("int")
    slope = F.get(F.lit([float(s) for s in slopes]), F.pmod("rank", F.lit(len(slopes))))
    return rows.select("doc_id", "text_key", "row_key", F.struct("rank", "bucket", "place").alias("row"), "source", "size", "source_size", "target", start.cast("double").alias("start"),
                       F.when(F.col("source_size") == 0, 1).otherwise(uses).alias("uses"), slope.alias("slope"))


def _with_source(rows: DataFrame, per: DataFrame) -> DataFrame:
    """Rows with their source's figures; null is a source too."""
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    right = per.select(key.alias("key_"), "source_size", "rows", "rank", "target")
    return rows.withColumn("key_", key).join(right, "key_").drop("key_")


def mix_plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, slopes=SLOPES) -> DataFrame:
    """(doc_id, size, source_size, target, taken, uses, first_position) for every row of ``docs``.

    ``taken`` = size * uses. A null source is a source of its own; a null or empty text has size 0; repeated
    rows count each; an empty table gives no row. A source without any word is used once. The order depends on
    a hash of the id and the text alone, so reruns agree.
    """
    plan = _mixed(docs, weights, max_epochs, slopes)
    at = position(F.least(F.lit(1.0), F.col("start") / F.greatest(F.col("target"), F.lit(1.0))), F.col("slope"))
    return plan.select("doc_id", "text_key", "source", "size", "source_size", "target", (F.col("size") * F.col("uses")).alias("taken"),
                       "uses", F.when(F.col("uses") > 0, at).alias("first_position"))


def _uses(plan: DataFrame) -> DataFrame:
    """Every use of every row of a plan, with its training position."""
    share = (F.col("start") + F.col("use") * F.col("source_size")) / F.greatest(F.col("target"), F.lit(1.0))
    return plan.where("uses > 0").withColumn("use", F.explode(F.sequence(F.lit(0), F.col("uses") - 1))).withColumn(
        "position", position(F.least(F.lit(1.0), share), F.col("slope")))


def in_training_order(uses: DataFrame) -> DataFrame:
    """``uses`` range-sorted by position, with ``slot``, the number of uses before (gapless from 0).

    One range of the sort tells the next how many uses it holds; ties go by row and use, as in :func:`mix`.
    """
    ordered = staged(uses.orderBy("position", "row_key", "use").withColumn("at", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("range", F.shiftright("at", 33))  # the id is the range's number and the place in it
    held = ordered.groupBy("range").agg(F.count("*").alias("n"))  # a row per range
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    slot = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    return ordered.join(F.broadcast(held), "range").select(*uses.columns, slot.alias("slot"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, slopes=SLOPES) -> DataFrame:
    """What the mix makes of every row of ``docs``, counted in the training order itself.

    (doc_id, size, source_size, target, taken, uses, first_position, first_slot): ``taken`` and ``uses`` are the words and
    number of the row's uses in the order, ``first_slot`` how many uses of any row come before its first. Rows without
    a use stay, with 0 and nulls.
    """
    plan = staged(_mixed(docs, weights, max_epochs, slopes))
    found = in_training_order(_uses(plan).select("row", "row_key", "size", "use", "position"))
    found = found.groupBy("row").agg(F.sum("size").alias("taken"), F.count("*").cast("int").alias("uses"),
                                     F.min("position").alias("first_position"), F.min("slot").alias("first_slot"))
    nothing = F.lit(0)
    return plan.drop("uses").join(found, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", nothing).alias("taken"), F.coalesce("uses", nothing).alias("uses"),
        "first_position", "first_slot")


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, slopes=SLOPES) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is used, range-sorted by training position.

    Same columns as ``docs``. Rows alike in all columns stand for one another: their uses, each at its own position,
    are all of one of them.
    """
    plan = staged(_mixed(docs, weights, max_epochs, slopes).where("uses > 0"))
    uses = _uses(plan).select(F.col("row_key").alias("row_key_"), F.col("position").alias("position_"), F.col("use").alias("use_"))
    keyed = docs.withColumn("row_key_", _row_key(docs))
    if plan.groupBy("row_key").count().where("count > 1").limit(1).count():
        keyed = keyed.dropDuplicates(["row_key_"])
    return keyed.join(uses, "row_key_").orderBy("position_", "row_key_", "use_").select(*docs.columns)


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """Words that the curriculum takes from every document, and where its training order has them first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixed_documents(docs).select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                                        F.col("taken").cast("long").alias("taken"), "uses", "first_position", "first_slot")
