r"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

Numbers, names and units become typed placeholders, so a question whose values were replaced keeps its
template. Windows of template words are hash-joined with the benchmark's; an item whose windows a document
holds for the most part is a leak if the values in the placeholders are consistent: where the item repeats
a value, the document repeats the value it has there instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm.common import as_columns, join_narrow, staged

WINDOW = 8
#: Share of an item's windows that a document must hold, and placeholders that a window may have.
MIN_SHARE = 0.6
MAX_PLACEHOLDERS = 4
#: An item with fewer template words is too unspecific for its template, and looked for word by word.
MIN_WORDS = 5

# Unit names.
UNITS = ("km", "cm", "mm", "m", "mi", "ft", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "s", "ms", "min", "h", "hr", "hrs",
         "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years",
         "year", "meters", "metres", "miles", "feet", "inches", "pounds", "ounces", "grams", "liters", "litres", "dollars",
         "dollar", "cents", "euros", "euro", "percent", "degrees", "usd", "eur", "kwh", "kw", "w", "v", "hz", "gb", "mb", "kb")
#: Capitalised words wherever they stand, so that a name that opens a sentence, a line or a quote is one; a unit after a number isn't.
NAME = rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{Nd}}_])(?!(?<=\p{{Nd}} {{1,3}})(?i:{'|'.join(UNITS)})\b)(\p{{Lu}}\p{{L}}*(?: \p{{Lu}}\p{{L}}*)*)"
NUMBER = r"\p{Nd}+(?:[.,:]\p{Nd}+)*"
UNIT = rf"(?i)_num_ +({'|'.join(UNITS)})\b"
PLACEHOLDERS = ("_num_", "_name_", "_unit_")


def _named(text: Column) -> Column:
    return F.regexp_replace(text, NAME, " _name_ ")


def _numbered(text: Column) -> Column:
    return F.regexp_replace(_named(text), NUMBER, " _num_ ")


def template(text: Column) -> Column:
    """Template words of a text: lower case, without punctuation, values replaced by placeholders."""
    marked = F.regexp_replace(_numbered(text), UNIT, "_num_ _unit_")
    return F.array_remove(F.split(F.lower(marked), r"[^\p{L}\p{Nd}_]+"), "")


def slots(text: Column, words: Column) -> Column:
    """array<struct(at, kind, value)>: the values behind the placeholders of ``words`` = ``template(text)``.

    The n-th placeholder of a kind holds the n-th value that its pattern finds.
    """
    values = {"_name_": F.regexp_extract_all(text, F.lit(NAME), 1),
              "_num_": F.regexp_extract_all(_named(text), F.lit(NUMBER), 0),
              "_unit_": F.regexp_extract_all(_numbered(text), F.lit(UNIT), 1)}
    every = F.sequence(F.lit(0), F.greatest(F.size(words), F.lit(1)) - 1)

    def of(kind: str, found: Column) -> Column:
        at = F.filter(every, lambda i: F.get(words, i) == F.lit(kind))
        both = F.arrays_zip(at.alias("at"), F.slice(found, 1, F.greatest(F.size(at), F.lit(1))).alias("value"))
        return F.transform(both, lambda x: F.struct(x["at"].alias("at"), F.lit(kind).alias("kind"), F.lower(x["value"]).alias("value")))

    kinds = [of(kind, found) for kind, found in values.items()]
    return F.concat(*kinds)


def _window_hashes(words: Column, span: int) -> Column:
    """Hash of every window of ``span`` words."""
    n = F.size(words) - (span - 1)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, span)))
    return F.when(n > 0, each).otherwise(F.array().cast("array<bigint>"))


def _hits(words: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Windows of rows (doc_id, text_key, words) that are ``wanted``, with pos; one pass serves windows of all lengths."""
    spans = sorted(r.span for r in wanted.select("span").distinct().collect()) or [window]  # at most ``window`` values
    if len(spans) == 1:  # every item has at least a window's length
        each = words.select("doc_id", "text_key", F.lit(spans[0]).alias("span"), F.posexplode(_window_hashes(F.col("words"), spans[0])).alias("pos", "hash"))
    else:
        lists = F.array(*[F.struct(F.lit(span).alias("span"), _window_hashes(F.col("words"), span).alias("hashes")) for span in spans])
        each = words.select("doc_id", "text_key", F.explode(lists).alias("x"))
        each = each.select("doc_id", "text_key", "x.span", F.posexplode("x.hashes").alias("pos", "hash"))
    return join_narrow(each, wanted, ["span", "hash"], "inner").drop("span")


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, item_key, span, at, hash, n_windows) for every window looked for.

    An item of fewer words than ``window`` is one window of its own length.
    """
    size = F.least(F.size("words"), F.lit(window))
    kept = items.where(F.size("words") >= MIN_WORDS).withColumn("span", size)
    each = kept.select("item_id", "item_key", "span", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("span") + 1),
        lambda i: F.struct((i - 1).alias("at"), F.slice("words", i, F.col("span")).alias("w")))).alias("x"))
    marks = F.size(F.filter("x.w", lambda w: w.isin(*PLACEHOLDERS)))
    each = each.where(marks <= MAX_PLACEHOLDERS).select("item_id", "item_key", "span", F.col("x.at").alias("at"), F.xxhash64("x.w").alias("hash"))
    return each.withColumn("n_windows", F.count("*").over(Window.partitionBy("item_key")))


def raw_words(text: Column) -> Column:
    """Words of a text with the values in place: lower case, without punctuation."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{Nd}_]+"), "")


def _exact(docs: DataFrame, items: DataFrame, window: int, min_share: float) -> DataFrame:
    """(doc_id, text_key, item_id, item_key, n_windows, n_found) by windows of raw words."""
    raw = items.select("item_id", "item_key", raw_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    raw = raw.withColumn("span", F.least(F.size("words"), F.lit(window)))
    wanted = staged(raw.select("item_id", "item_key", "span", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("span") + 1), lambda i: F.xxhash64(F.slice("words", i, F.col("span")))))).alias("hash"))
        .withColumn("n_windows", F.count("*").over(Window.partitionBy("item_key"))))
    words = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("text_key"), raw_words(F.col("text")).alias("words"))
    found = _hits(words, wanted, window).drop("pos").distinct()
    pairs = found.groupBy("doc_id", "text_key", "item_id", "item_key", "n_windows").agg(F.count("*").alias("n_found"))
    return pairs.where(F.col("n_found") >= F.ceil(min_share * F.col("n_windows")))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, text_key, item_id, n_found, n_windows, n_slots, same_values) for every leaked item.

    Equal texts of an item or of one doc_id count once. ``same_values`` is false where the values differ, a
    re-parameterised item. Every item is also looked for by windows of its raw words, values included: a template can't
    tell names in a copy of another case, has no windows of more than ``MAX_PLACEHOLDERS`` placeholders, and is too
    unspecific below ``MIN_WORDS`` words. Null or empty texts match nothing; a null doc_id or item_id is kept as null; an empty table gives no row; other columns are not read.
    """
    items = as_columns(benchmark, "item_id", "text").where("text is not null").dropDuplicates(["item_id", "text"])
    items = items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"), "text", template(F.col("text")).alias("words"))
    wanted = staged(_item_windows(items, window))
    docs = as_columns(docs, "doc_id", "text").where("text is not null")
    key = F.xxhash64("doc_id", "text").alias("text_key")
    found = _hits(docs.select("doc_id", key, template(F.col("text")).alias("words")), wanted, window)
    # per document and item: distinct windows found, and the alignment that has most of them
    lines = found.groupBy("doc_id", "text_key", "item_id", "item_key", "n_windows", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.collect_set("at").alias("ats"))
    pairs = lines.groupBy("doc_id", "text_key", "item_id", "item_key", "n_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("n_found"),
        F.max_by("shift", F.struct(F.size("ats"), -F.col("shift"))).alias("shift"))
    pairs = staged(pairs.where(F.col("n_found") >= F.ceil(min_share * F.col("n_windows"))))
    # slot consistency along that alignment
    doc_slots = join_narrow(docs.withColumn("text_key", F.xxhash64("doc_id", "text")), pairs.select("text_key").distinct(), "text_key", "left_semi")
    doc_slots = doc_slots.dropDuplicates(["text_key"]).withColumn("words", template(F.col("text")))
    doc_slots = doc_slots.select("text_key", F.explode(slots(F.col("text"), F.col("words"))).alias("d"))
    item_slots = items.select("item_key", F.explode(slots(F.col("text"), F.col("words"))).alias("b"))
    aligned = (pairs.select("text_key", "item_key", "shift").join(item_slots, "item_key")
               .withColumn("at", F.col("b.at") + F.col("shift"))
               .join(doc_slots.withColumn("at", F.col("d.at")), ["text_key", "at"]).where("b.kind = d.kind"))
    # a capitalised word before the item runs into the name that opens it
    n_words, there = F.size(F.split("b.value", " ")), F.split("d.value", " ")
    opens = (F.col("b.at") == 0) & (F.col("b.kind") == "_name_") & (F.size(there) > n_words)
    value = F.when(opens, F.array_join(F.slice(there, F.size(there) - n_words + 1, n_words), " ")).otherwise(F.col("d.value"))
    values = aligned.groupBy("text_key", "item_key", "b.kind", "b.value").agg(
        F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    checked = values.groupBy("text_key", "item_key").agg(
        F.sum("n").alias("n_slots"), F.max((F.col("low") != F.col("high")).cast("int")).alias("clash"),
        F.min(((F.col("low") == F.col("value")) & (F.col("high") == F.col("value"))).cast("int")).alias("same"))
    by_template = staged(pairs.join(checked, ["text_key", "item_key"], "left").where("coalesce(clash, 0) = 0").drop("shift", "clash"))
    exact = (_exact(docs, items, window, min_share).join(by_template.select("text_key", "item_key"), ["text_key", "item_key"], "left_anti")
             .join(items.select("item_key", F.size(F.filter("words", lambda w: w.isin(*PLACEHOLDERS))).alias("in_item")), "item_key"))
    # without all of its raw windows the values may differ
    exact = exact.select("doc_id", "text_key", "item_id", "item_key", "n_windows", "n_found", F.col("in_item").cast("long").alias("n_slots"),
                         (F.col("n_found") == F.col("n_windows")).cast("int").alias("same"))
    return (by_template.select(exact.columns).unionByName(exact)
            .select("doc_id", "text_key", "item_id", F.col("n_found").cast("long").alias("n_found"),
                    F.col("n_windows").cast("long").alias("n_windows"), F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
                    (F.coalesce("same", F.lit(1)) == 1).alias("same_values")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns kept."""
    bad = staged(leaks(docs, benchmark).select("text_key").distinct())
    keyed = docs.withColumn("leak_key_", F.xxhash64("doc_id", "text"))
    return join_narrow(keyed, bad.withColumnRenamed("text_key", "leak_key_"), "leak_key_", "left_anti").select(*docs.columns)


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_key").distinct()
