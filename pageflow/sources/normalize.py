"""Raw upstream events (nested JSON text) -> canonical page-create events.

Each output field is the first *truthy* candidate among several JSON paths:
an empty string, a zero id and null all fall through to the next path. Text
that is not a JSON object goes to a separate rejects output with a reason,
instead of being dropped silently.

Documented differences from a per-event script: ``"meta": null`` is treated as
an absent object (not a failure), and a numeric-looking ``timestamp`` string is
read as epoch seconds, like a JSON number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.functions.timefn import parse_event_time
from pageflow.functions.truthy import first_truthy
from pageflow.schema import EVENT_COLUMNS, RAW_EVENT_SCHEMA
from pageflow.sources.events import parse_once

# Defaults when no candidate path holds a value, and the id range
# of the stand-in page id for events without one.
DEFAULT_DOMAIN = "unknown"
DEFAULT_USER_NAME = "unknown"
HASHED_ID_RANGE = 10_000_000_000

REASON_NOT_JSON = "not_json"
REASON_NOT_OBJECT = "not_a_json_object"
REASON_BAD_ID = "bad_id"
REASON_BAD_TIME = "bad_time"
_CORRUPT = "_corrupt_record"


def _number(text: Column) -> Column:
    """The integer part of a JSON number's text, null for anything else."""
    return text.try_cast("decimal(38,6)").try_cast("long")


def _nonzero_text(text: Column) -> Column:
    """The text unless it is blank, a zero or false."""
    return F.when(~text.isin("", "false") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0), text)


def _true(text: Column) -> Column:
    """Truth of a JSON value read as text: null, blank, false, zero and empty containers are false."""
    return F.coalesce(_nonzero_text(text).isNotNull() & ~text.isin("[]", "{}"), F.lit(False))


def normalize_columns(e: Column, ingest_time: Column) -> dict[str, Column]:
    """Canonical columns from the parsed raw struct ``e`` (see RAW_EVENT_SCHEMA)."""
    meta, page, perf = e["meta"], e["page"], e["performer"]
    domain = first_truthy(meta["domain"], e["database"], default=F.lit(DEFAULT_DOMAIN))
    page_text = F.coalesce(*[_nonzero_text(c) for c in (page["page_id"], page["id"], e["page_id"])])
    page_id = F.coalesce(_number(page_text), _number(page["page_id"]))
    title = first_truthy(page["page_title"], page["title"], e["page_title"], e["title"],
                         default=F.lit(""))
    user_text = F.coalesce(*[_nonzero_text(c) for c in (perf["user_id"], perf["id"], e["user_id"])])
    user_id = F.coalesce(_number(user_text), F.lit(0).cast("long"))
    user_name = first_truthy(perf["user_text"], perf["user_name"], perf["name"], e["user"],
                             default=F.lit(DEFAULT_USER_NAME))
    is_bot = _true(perf["user_is_bot"]) | _true(perf["is_bot"]) | _true(e["bot"])
    bad_id = ((page_text.isNotNull() & _number(page_text).isNull())
              | (user_text.isNotNull() & _number(user_text).isNull()))
    time_text = first_truthy(meta["dt"], e["dt"], e["timestamp"])
    created_at = F.when(time_text.isNull(), ingest_time).otherwise(parse_event_time(time_text))
    return {"domain": domain, "page_id": page_id, "page_title": title, "user_id": user_id,
            "user_name": user_name, "is_bot": is_bot, "created_at": created_at,
            "_reason": F.when(bad_id, F.lit(REASON_BAD_ID)).when(created_at.isNull(), F.lit(REASON_BAD_TIME)),
            "_time_text": F.coalesce(time_text, ingest_time.cast("string"))}


def normalize_events(raw: DataFrame, value_col: str = "value",
                     ingest_time: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split raw JSON text into (valid canonical events, rejects).

    ``ingest_time`` stands in for events without any time field (default: the
    query's current timestamp). Every row goes to one of the two outputs: rejects
    carry the raw text and a ``reject_reason`` (no JSON, no object, an id that is no
    number, a time that does not parse). A field of another type than expected is
    absent, the rest of its event kept. Each document is parsed once (see
    :func:`parse_once`); only where the parser reports a fault does a second look
    tell malformed text from a wrongly typed field.
    """
    if ingest_time is None:
        ingest = F.current_timestamp()
    elif isinstance(ingest_time, str):
        ingest = F.lit(ingest_time).cast("timestamp")
    else:
        ingest = ingest_time
    text = F.col(value_col).cast("string")
    schema = T.StructType(RAW_EVENT_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    staged = parse_once(raw, [text.alias("_raw"), parsed.alias("_e")])
    is_json = F.col(f"_e.{_CORRUPT}").isNull() | F.get_json_object("_raw", "$").isNotNull()
    is_object = F.coalesce(F.col("_raw").rlike(r"^\s*\{") & F.col("_e").isNotNull() & is_json, F.lit(False))
    cols = normalize_columns(F.col("_e"), ingest)
    reason = (F.when(is_object, cols.pop("_reason"))
              .when(F.get_json_object("_raw", "$").isNotNull(), F.lit(REASON_NOT_OBJECT))
              .otherwise(F.lit(REASON_NOT_JSON)))
    rejects = staged.select(F.col("_raw").alias("value"), reason.alias("reject_reason")).filter("reject_reason is not null")
    # columns and reason share their candidates: one projection computes them, and the filter stays above it
    good = parse_once(staged, [*[c.alias(n) for n, c in cols.items()], reason.alias("_reject")]).filter("_reject is null")
    # events without any id get a stable stand-in in [0, 1e10)
    hashed = F.pmod(F.xxhash64(F.concat_ws(":", "domain", "page_title", "_time_text")),
                    F.lit(HASHED_ID_RANGE))
    good = (good.withColumn("page_id", F.coalesce(F.col("page_id"), hashed))
            .withColumn("title_length", F.length("page_title").cast("int"))
            .select(*EVENT_COLUMNS))
    return good, rejects


def raw_event_json(events: DataFrame, shape: Column) -> Column:
    """Raw upstream JSON for canonical events, in one of four path layouts (0..3).

    Used to derive raw input from the driver's tables: every layout normalises
    back to the same canonical event.
    """
    iso = F.concat(F.date_format(F.col("created_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    d, pid, t = F.col("domain"), F.col("page_id"), F.col("page_title")
    uid, name, bot = F.col("user_id"), F.col("user_name"), F.col("is_bot")
    s = F.struct
    complete = F.to_json(s(s(d.alias("domain"), iso.alias("dt")).alias("meta"),
                           s(pid.alias("page_id"), t.alias("page_title")).alias("page"),
                           s(uid.alias("user_id"), name.alias("user_text"),
                             bot.alias("user_is_bot")).alias("performer")))
    flat = F.to_json(s(d.alias("database"), pid.alias("page_id"), t.alias("title"),
                       uid.alias("user_id"), name.alias("user"), bot.alias("bot"),
                       iso.alias("timestamp")))
    blanks = F.to_json(s(s(F.lit("").alias("domain"), iso.alias("dt")).alias("meta"),
                         d.alias("database"),
                         s(F.lit(0).alias("page_id"), pid.alias("id"), t.alias("title")).alias("page"),
                         s(uid.alias("id"), name.alias("user_name"), bot.alias("is_bot"))
                         .alias("performer")))
    fallbacks = F.to_json(s(s(d.alias("domain"), F.lit("").alias("dt")).alias("meta"),
                            iso.alias("dt"),
                            s(F.lit("").alias("page_title"), t.alias("title")).alias("page"),
                            pid.alias("page_id"),
                            s(F.lit(0).alias("user_id"), uid.alias("id"), F.lit("").alias("user_text"),
                              name.alias("name")).alias("performer"),
                            bot.alias("bot")))
    return (F.when(shape == 0, complete).when(shape == 1, flat).when(shape == 2, blanks)
            .otherwise(fallbacks))
