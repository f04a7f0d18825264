"""Named queries over the driver's tables, each with an equivalent DuckDB statement.

Every query reads the whole ``events`` / ``pages`` tables through the
``page_events`` adapter. Parameters that make a lookup a lookup (one site, one
user, one page) are the feature of that query, not a cut of the input.
Arrays are rendered as joined strings so both engines hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.text import NON_WORD_RUN, STOP_WORDS
from pageflow.operators import enrich, keyed, keywords, lookups, metrics, reports, spam, summaries
from pageflow.sources.fixtures import page_events

# Fixed parameters of the registered queries.
AS_OF = "2024-01-01 12:00:00"          # end of the compressed event-time range
ALERT_TIME = AS_OF                     # a fixed alert timestamp keeps results deterministic
REPORT_HOURS = 24                      # the widest report; covers the whole range
LOOKUP_DOMAIN = "example.com/view"
LOOKUP_USER = 42
LOOKUP_PAGE = 777
RANGE_FROM, RANGE_TO = "2024-01-01T03:00:00Z", "2024-01-01T05:00:00+00:00"
BURST_THRESHOLD = 5
MIN_EDITOR_PAGES = 5
TREND_BAND = 0.2
ESTIMATE_ERROR = 0.05                  # relative standard error of approx_count_distinct
COLLIDING_IDS = 100                    # page ids of the keyed-table query that several events share

Query = Callable[[SparkSession, str], DataFrame]


def _join_array(c: Column | str, sep: str = ",") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat_ws(sep, F.transform(c, lambda x: x.cast("string")))


def _lang(spark, sf):
    return metrics.language_activity(page_events(spark, sf), exact=True)


def estimate_checked(estimated: DataFrame, exact: DataFrame) -> DataFrame:
    """The exact rows, and whether the estimate of distinct authors lies within three standard errors of each."""
    keys = ["domain", "window_start"]
    near = F.abs(F.col("_estimate") - F.col("unique_authors")) <= F.lit(3 * ESTIMATE_ERROR) * F.col("unique_authors") + 1
    found = estimated.select(*keys, F.col("unique_authors").alias("_estimate"))
    return (exact.join(found, keys, "full").withColumn("estimate_ok", F.coalesce(near, F.lit(False)))
            .select(*exact.columns, "estimate_ok"))


def with_exact_authors(activity: DataFrame, events: DataFrame) -> DataFrame:
    """The rows of ``activity`` with the exact number of authors in place of the estimate, and whether that was near."""
    exact = events.groupBy("domain", F.window("created_at", "1 minute")["start"].alias("window_start")).agg(
        F.count_distinct("user_id").cast("int").alias("unique_authors"))
    return activity.drop("unique_authors").join(estimate_checked(activity, exact), ["domain", "window_start"])


def _lang_estimate(spark, sf):
    events = page_events(spark, sf)
    return with_exact_authors(metrics.language_activity(events), events)


def _top_burst_keywords(spark, sf):
    """By counts alone: titles are neither kept apart nor gathered."""
    counts = keywords.keyword_counts(page_events(spark, sf), titles=False).filter(F.col("occurrences") >= BURST_THRESHOLD)
    return summaries.top_keywords(counts.withColumnRenamed("occurrences", "pages_count"))


def _bots(spark, sf):
    return metrics.bot_activity(page_events(spark, sf))


def _bursts(spark, sf):
    return keywords.keyword_bursts(page_events(spark, sf), threshold=BURST_THRESHOLD)


def _burst_alerts(spark, sf):
    return keywords.burst_alerts(_bursts(spark, sf), ALERT_TIME)


def _spam(spark, sf):
    return spam.spam_alerts(page_events(spark, sf), ALERT_TIME)


def q_hourly_report(spark, sf):
    r = reports.hourly_report(page_events(spark, sf), None, REPORT_HOURS, AS_OF)
    top = F.concat_ws(";", F.transform("top_authors", lambda x: F.concat_ws(
        ":", x["name"], x["pages"].cast("string"), x["is_bot"].cast("string"))))
    return r.withColumn("top_authors", top)


def q_editor_patterns(spark, sf):
    r = reports.editor_patterns(page_events(spark, sf), MIN_EDITOR_PAGES)
    return (r.withColumn("domains", _join_array("domains"))
            .withColumn("active_hours_utc", _join_array("active_hours_utc")))


def q_spike_ratio(spark, sf):
    counts = keywords.keyword_counts(page_events(spark, sf), titles=False)
    return (enrich.spike_ratio(counts, min_occurrences=BURST_THRESHOLD)
            .withColumn("occurrences", F.col("occurrences").cast("int")))


QUERIES: dict[str, Query] = {
    # windowed metrics
    "language_activity_exact": _lang,
    "language_activity": _lang_estimate,
    "bot_activity": _bots,
    # keywords
    "title_tokens": lambda s, sf: keywords.title_tokens(page_events(s, sf))
    .select("domain", "page_id", "created_at", "keyword"),
    "keyword_bursts": _bursts,
    "burst_alerts": _burst_alerts,
    # spam
    "spam_alerts": _spam,
    "spam_reason_counts": lambda s, sf: summaries.reason_counts(_spam(s, sf)),
    # reports
    "hourly_report": q_hourly_report,
    "hourly_top_authors": lambda s, sf: reports.hourly_top_authors(
        page_events(s, sf), None, REPORT_HOURS, AS_OF),
    "editor_patterns": q_editor_patterns,
    "editor_gap_lag": lambda s, sf: reports.editor_gaps(page_events(s, sf)),
    "latest_window_per_domain": lambda s, sf: reports.latest_per_domain(_lang(s, sf)),
    # lookups
    "page_by_id": lambda s, sf: lookups.page_by_id(
        keyed.pages_by_id_latest(page_events(s, sf)), LOOKUP_PAGE),
    "pages_by_user": lambda s, sf: lookups.pages_by_user(
        page_events(s, sf).select(*keyed.PAGES_BY_USER.columns), LOOKUP_USER),
    "pages_by_domain": lambda s, sf: lookups.pages_by_domain(page_events(s, sf), LOOKUP_DOMAIN),
    "pages_by_domain_range": lambda s, sf: lookups.pages_by_domain(
        page_events(s, sf), LOOKUP_DOMAIN, RANGE_FROM, RANGE_TO, limit=500),
    "language_metrics_for_domain": lambda s, sf: lookups.metric_rows(_lang(s, sf), LOOKUP_DOMAIN),
    "bot_metrics_for_domain": lambda s, sf: lookups.metric_rows(_bots(s, sf), f"  {LOOKUP_DOMAIN} "),
    "spam_for_domain": lambda s, sf: lookups.alert_rows(_spam(s, sf), LOOKUP_DOMAIN),
    "bursts_for_domain": lambda s, sf: lookups.alert_rows(_burst_alerts(s, sf), LOOKUP_DOMAIN),
    "spam_by_severity": lambda s, sf: lookups.alert_rows(_spam(s, sf), None, 500, "medium"),
    # dashboard summaries
    "top_domains_by_pages": lambda s, sf: summaries.top_domains_by(_lang(s, sf), "pages_created"),
    "top_domains_by_authors": lambda s, sf: summaries.top_domains_by(_lang(s, sf), "unique_authors"),
    "bot_share_by_domain": lambda s, sf: summaries.top_domains_by(
        _bots(s, sf), "bot_percent", "avg", digits=6),
    "bot_human_by_domain": lambda s, sf: summaries.bot_human_by_domain(_bots(s, sf)),
    "top_burst_keywords": _top_burst_keywords,
    "overview": lambda s, sf: summaries.overview_from_events(
        page_events(s, sf), burst_threshold=BURST_THRESHOLD),
    # keyed tables
    "latest_per_key": lambda s, sf: keyed.latest_per_key(
        page_events(s, sf).select(*keyed.PAGES_BY_USER.columns), ["user_id"],
        [("created_at", True), ("page_id", False)]),
    "pages_by_id_latest": lambda s, sf: keyed.pages_by_id_latest(page_events(s, sf)),
    # enrichments
    "trend": lambda s, sf: enrich.with_trend(_lang(s, sf), 1, TREND_BAND),
    "top_actors": lambda s, sf: enrich.top_actors(page_events(s, sf)),
    "spike_ratio": q_spike_ratio,
}


# ---------------------------------------------------------------------------
# DuckDB oracle statements
# ---------------------------------------------------------------------------

PAGE_EVENTS_CTE = """
with p as (select page_id pid, url,
             regexp_extract(url,'^https?://([^/?#]+)',1) host,
             trim(regexp_extract(html,'(?is)<title[^>]*>(.*?)</title>',1)) title from pages),
n as (select count(*) n from p),
j as (select regexp_extract(host,'([^.]+[.][^.]+)$',1) || '/' || e.event_type as domain,
        e.event_id as page_id,
        case when e.event_id%97=0 then p.url
             when e.event_id%89=0 then substr(p.title,1,2)
             when e.event_id%83=0 then p.title||' '||p.title
             else p.title end as page_title,
        e.user_id, 'user'||e.user_id as user_name, (e.user_id%10=0) as is_bot,
        make_timestamp(epoch_us(timestamp '2024-01-01')
          + (epoch_us(ts)-epoch_us(timestamp '2024-01-01'))//60) as created_at
      from events e, n join p on p.pid = e.event_id % n.n),
page_events as (select *, length(page_title)::integer as title_length from j)"""

_STOP = ", ".join("'" + w + "'" for w in STOP_WORDS)

LANG_CTE = """,
lang as (select domain, time_bucket(interval '1 minute', created_at) as window_start,
         time_bucket(interval '1 minute', created_at) + interval '1 minute' as window_end,
         count(*)::integer as pages_created, count(distinct user_id)::integer as unique_authors,
         avg(title_length)::double as avg_title_length, 'stable' as trend
         from page_events group by 1, 2, 3)"""

BOT_CTE = """,
bots as (select domain, time_bucket(interval '1 minute', created_at) as window_start,
         time_bucket(interval '1 minute', created_at) + interval '1 minute' as window_end,
         count_if(is_bot)::integer as bot_pages, count_if(not is_bot)::integer as human_pages,
         case when count(*) > 0 then count_if(is_bot)::double / count(*) * 100 else 0.0 end
           as bot_percent,
         '[]' as top_bots, '[]' as top_humans
         from page_events group by 1, 2, 3)"""

TOKENS_CTE = f""",
words as (select domain, page_id, created_at, page_title,
          unnest(string_split_regex(lower(regexp_replace(page_title, '{NON_WORD_RUN}', ' ', 'g')),
                 '\\s+')) as keyword from page_events),
tokens as (select * from words where keyword <> '' and length(keyword) >= 4
           and not regexp_matches(keyword, '^[0-9]+$') and keyword not in ({_STOP}))"""

BURSTS_CTE = TOKENS_CTE + f""",
counts as (select domain, keyword, time_bucket(interval '10 minutes', created_at) as window_start,
           time_bucket(interval '10 minutes', created_at) + interval '10 minutes' as window_end,
           count(*) as occurrences,
           array_to_string(list_sort(list(distinct page_title)), ', ') as sample_pages
           from tokens group by 1, 2, 3, 4),
bursts as (select domain, keyword, window_start, window_end, occurrences::integer as occurrences,
           sample_pages from counts where occurrences >= {BURST_THRESHOLD}),
alerts as (select domain, timestamp '{ALERT_TIME}' as alert_time, 'keyword_burst' as alert_type,
           keyword, null::double as spike_ratio, occurrences as pages_count, sample_pages,
           window_start, window_end from bursts)"""

SPAM_CTE = f""",
flagged as (select *, case
    when regexp_matches(page_title, '(?i)(https?://|www\\.)') then 'title_contains_url'
    when regexp_matches(page_title, '[0-9]{{7,}}') then 'title_contains_many_digits'
    when title_length < 3 then 'title_too_short'
    when title_length > 100 then 'title_too_long' end as reason from page_events),
spam as (select domain, timestamp '{ALERT_TIME}' as alert_time,
         case reason when 'title_contains_url' then 'high'
                     when 'title_contains_many_digits' then 'medium' else 'low' end as severity,
         user_id, user_name, reason, page_title, page_id, created_at
         from flagged where reason is not null and is_bot = false)"""

REPORT_CTE = f""",
rows as (select *, time_bucket(interval '1 hour', created_at) as time_start,
         coalesce(nullif(user_name, ''), 'unknown') as name,
         row_number() over (partition by domain, time_bucket(interval '1 hour', created_at),
                            coalesce(nullif(user_name, ''), 'unknown')
                            order by created_at desc, page_id) as recency
         from page_events
         where created_at >= timestamp '{AS_OF}' - interval '{REPORT_HOURS} hours'
           and created_at <= timestamp '{AS_OF}'),
per_name as (select domain, time_start, name, count(*) as pages,
             max(created_at) filter (where recency = 1) as newest_ts,
             max(page_id) filter (where recency = 1) as newest_pid,
             bool_or(is_bot) filter (where recency = 1) as is_bot
             from rows group by 1, 2, 3),
ranked as (select *, row_number() over (partition by domain, time_start
                     order by pages desc, newest_ts desc, newest_pid asc, name) as rank
           from per_name),
top as (select domain, time_start, time_start + interval '1 hour' as time_end,
        rank::integer as rank, name, pages, is_bot from ranked where rank <= 10)"""

WINDOW_KEYS = "domain, window_start"

ORACLE_SQL: dict[str, str] = {
    "language_activity_exact": PAGE_EVENTS_CTE + LANG_CTE + "\nselect * from lang",
    "bot_activity": PAGE_EVENTS_CTE + BOT_CTE + "\nselect * from bots",
    "title_tokens": PAGE_EVENTS_CTE + TOKENS_CTE
    + "\nselect domain, page_id, created_at, keyword from tokens",
    "keyword_bursts": PAGE_EVENTS_CTE + BURSTS_CTE + "\nselect * from bursts",
    "burst_alerts": PAGE_EVENTS_CTE + BURSTS_CTE + "\nselect * from alerts",
    "spam_alerts": PAGE_EVENTS_CTE + SPAM_CTE + "\nselect * from spam",
    "spam_reason_counts": PAGE_EVENTS_CTE + SPAM_CTE
    + "\nselect reason, count(*) as count from spam group by reason",
    "hourly_report": PAGE_EVENTS_CTE + REPORT_CTE + """,
hourly as (select domain, time_start, count(*) as pages_created,
           count(distinct user_id) as unique_authors, count_if(is_bot) as bot_pages
           from rows group by 1, 2)
select h.time_start, h.time_start + interval '1 hour' as time_end, h.domain, h.pages_created,
       h.unique_authors,
       round_even(case when h.pages_created > 0
                       then h.bot_pages::double / h.pages_created * 100 else 0.0 end, 2) as bot_percent,
       (select string_agg(t.name || ':' || t.pages || ':' || t.is_bot::varchar, ';' order by t.rank)
          from top t where t.domain = h.domain and t.time_start = h.time_start) as top_authors
from hourly h""",
    "hourly_top_authors": PAGE_EVENTS_CTE + REPORT_CTE + "\nselect * from top",
    "editor_patterns": PAGE_EVENTS_CTE + f""",
newest as (select user_id, user_name, is_bot from page_events
           qualify row_number() over (partition by user_id order by created_at desc, page_id) = 1),
g as (select user_id, count(*) as pages_created, count(distinct domain)::integer as domains_count,
      array_to_string(list_sort(list(distinct domain)), ',') as domains,
      array_to_string(list_sort(list(distinct hour(created_at))), ',') as active_hours_utc,
      case when count(*) > 1 then (epoch_us(max(created_at)) - epoch_us(min(created_at)))::double
           / 1000000.0::double / (count(*) - 1) end as avg_seconds_between_pages,
      count(distinct domain) = 1 as has_domain_specialization
      from page_events group by user_id having count(*) >= {MIN_EDITOR_PAGES})
select g.user_id, n.user_name, n.is_bot, g.pages_created, g.domains_count, g.domains,
       g.active_hours_utc, g.avg_seconds_between_pages, g.has_domain_specialization
from g join newest n using (user_id)""",
    "editor_gap_lag": PAGE_EVENTS_CTE + """,
gaps as (select user_id, epoch_us(created_at) - epoch_us(lag(created_at) over
           (partition by user_id order by created_at, page_id)) as gap from page_events)
select user_id, count(*) as pages_created, coalesce(sum(gap), 0)::bigint as gap_micros,
       case when count(*) > 1 then coalesce(sum(gap), 0)::bigint::double / 1000000.0::double
            / (count(*) - 1) end as avg_seconds_between_pages
from gaps group by user_id""",
    "latest_window_per_domain": PAGE_EVENTS_CTE + LANG_CTE + """
select domain, window_start as latest_window_start, window_end as latest_window_end,
       pages_created as pages_created_last_window, unique_authors as unique_authors_last_window,
       avg_title_length, trend
from lang qualify row_number() over (partition by domain order by window_start desc) = 1
order by domain""",
    "page_by_id": PAGE_EVENTS_CTE + f"""
select page_id, domain, created_at, page_title, user_id, user_name, is_bot, title_length
from page_events where page_id = {LOOKUP_PAGE}""",
    "pages_by_user": PAGE_EVENTS_CTE + f"""
select user_id, created_at, page_id, domain, page_title, user_name, is_bot
from page_events where user_id = {LOOKUP_USER} order by created_at desc, page_id limit 100""",
    "pages_by_domain": PAGE_EVENTS_CTE + f"""
select * from page_events where domain = '{LOOKUP_DOMAIN}'
order by created_at desc, page_id limit 100""",
    "pages_by_domain_range": PAGE_EVENTS_CTE + f"""
select * from page_events where domain = '{LOOKUP_DOMAIN}'
  and created_at between timestamp '2024-01-01 03:00:00' and timestamp '2024-01-01 05:00:00'
order by created_at desc, page_id limit 500""",
    "language_metrics_for_domain": PAGE_EVENTS_CTE + LANG_CTE + f"""
select * from lang where domain = '{LOOKUP_DOMAIN}' order by window_start desc limit 100""",
    "bot_metrics_for_domain": PAGE_EVENTS_CTE + BOT_CTE + f"""
select * from bots where domain = '{LOOKUP_DOMAIN}' order by window_start desc limit 100""",
    "spam_for_domain": PAGE_EVENTS_CTE + SPAM_CTE + f"""
select * from spam where domain = '{LOOKUP_DOMAIN}'
order by alert_time desc, created_at desc, page_id limit 100""",
    "bursts_for_domain": PAGE_EVENTS_CTE + BURSTS_CTE + f"""
select * from alerts where domain = '{LOOKUP_DOMAIN}' order by window_start desc, keyword limit 100""",
    "spam_by_severity": PAGE_EVENTS_CTE + SPAM_CTE + """
select * from spam where severity = 'medium'
order by domain, alert_time desc, created_at desc, page_id limit 500""",
    "top_domains_by_pages": PAGE_EVENTS_CTE + LANG_CTE + """
select domain, sum(pages_created)::bigint as pages_created from lang group by domain
order by pages_created desc, domain limit 20""",
    "top_domains_by_authors": PAGE_EVENTS_CTE + LANG_CTE + """
select domain, sum(unique_authors)::bigint as unique_authors from lang group by domain
order by unique_authors desc, domain limit 20""",
    "bot_share_by_domain": PAGE_EVENTS_CTE + BOT_CTE + """
select domain, round(avg(bot_percent), 6) as bot_percent from bots group by domain
order by bot_percent desc, domain limit 20""",
    "bot_human_by_domain": PAGE_EVENTS_CTE + BOT_CTE + """
select domain, sum(bot_pages)::bigint as bot_pages, sum(human_pages)::bigint as human_pages from bots
group by domain order by human_pages desc, domain limit 20""",
    "top_burst_keywords": PAGE_EVENTS_CTE + BURSTS_CTE + """
select keyword, sum(pages_count)::bigint as pages_count from alerts group by keyword
order by pages_count desc, keyword limit 20""",
    "overview": PAGE_EVENTS_CTE + LANG_CTE + BURSTS_CTE + SPAM_CTE + """
select (select count(distinct domain) from lang) as tracked_domains,
       (select sum(pages_created) from lang)::bigint as pages_in_windows,
       (select count(*) from bursts) as breaking_alerts,
       (select count(*) from spam) as spam_alerts""",
    "latest_per_key": PAGE_EVENTS_CTE + """
select user_id, created_at, page_id, domain, page_title, user_name, is_bot from page_events
qualify row_number() over (partition by user_id order by created_at desc, page_id) = 1""",
    "pages_by_id_latest": PAGE_EVENTS_CTE + """
select page_id, domain, created_at, page_title, user_id, user_name, is_bot, title_length
from page_events
qualify row_number() over (partition by page_id order by created_at desc, domain) = 1""",
    "trend": PAGE_EVENTS_CTE + LANG_CTE + f"""
select c.domain, c.window_start, c.window_end, c.pages_created, c.unique_authors,
       c.avg_title_length,
       case when c.pages_created > coalesce(p.pages_created, 0)::double * {1 + TREND_BAND!r}::double
              then 'up'
            when c.pages_created < coalesce(p.pages_created, 0)::double * {1 - TREND_BAND!r}::double
              then 'down'
            else 'stable' end as trend,
       coalesce(p.pages_created, 0)::integer as previous_pages
from lang c left join lang p
  on p.domain = c.domain and p.window_start + interval '1 minute' = c.window_start""",
    "top_actors": PAGE_EVENTS_CTE + """,
per_name as (select domain, time_bucket(interval '1 minute', created_at) as window_start, is_bot,
             user_name as name, count(*) as pages, max(created_at) as last_ts
             from page_events where is_bot is not null group by 1, 2, 3, 4),
ranked as (select *, row_number() over (partition by domain, window_start, is_bot
                     order by pages desc, last_ts desc, name) as rank from per_name)
select domain, window_start, window_start + interval '1 minute' as window_end,
  coalesce(to_json(list({'name': name, 'pages': pages} order by rank) filter (where is_bot))::varchar,
           '[]') as top_bots,
  coalesce(to_json(list({'name': name, 'pages': pages} order by rank) filter (where not is_bot))::varchar,
           '[]') as top_humans
from ranked where rank <= 3 group by 1, 2, 3""",
    "spike_ratio": PAGE_EVENTS_CTE + BURSTS_CTE + f""",
hist as (select c.domain, c.keyword, c.window_start, sum(h.occurrences) as hist
         from counts c join counts h on h.domain = c.domain and h.keyword = c.keyword
          and h.window_start >= c.window_start - interval '60 minutes'
          and h.window_start < c.window_start
         group by 1, 2, 3)
select c.domain, c.keyword, c.window_start, c.window_end, c.occurrences::integer as occurrences,
       case when h.hist > 0 then (c.occurrences * 6)::double / h.hist::double end as spike_ratio
from counts c left join hist h using (domain, keyword, window_start)
where c.occurrences >= {BURST_THRESHOLD}""",
}


# ---------------------------------------------------------------------------
# Further registered queries: parity variants and sinks
# ---------------------------------------------------------------------------

REPORT_DOMAIN_HOURS = 6        # the source's default report span


def q_hourly_report_domain(spark, sf):
    r = reports.hourly_report(page_events(spark, sf), LOOKUP_DOMAIN, REPORT_DOMAIN_HOURS, AS_OF)
    top = F.concat_ws(";", F.transform("top_authors", lambda x: F.concat_ws(
        ":", x["name"], x["pages"].cast("string"), x["is_bot"].cast("string"))))
    return r.withColumn("top_authors", top)


def q_json_export(spark, sf):
    from pageflow.session import scratch_path
    from pageflow.sources.export import export_json

    path = scratch_path(spark, "json-export")
    export_json(spam.spam_alerts(page_events(spark, sf), ALERT_TIME), path)
    return spark.read.schema(
        "domain string, alert_time string, severity string, user_id long, user_name string, "
        "reason string, page_title string, page_id long, created_at string").json(path)


QUERIES.update({
    "hourly_report_domain": q_hourly_report_domain,
    "pages_by_id_per_domain": lambda s, sf: keyed.pages_by_id_latest(page_events(s, sf), per_domain=True),
    "json_export": q_json_export,
})

ORACLE_SQL.update({
    "hourly_report_domain": PAGE_EVENTS_CTE + REPORT_CTE.replace(
        f"interval '{REPORT_HOURS} hours'", f"interval '{REPORT_DOMAIN_HOURS} hours'")
    + f""",
hourly as (select domain, time_start, count(*) as pages_created,
           count(distinct user_id) as unique_authors, count_if(is_bot) as bot_pages
           from rows where domain = '{LOOKUP_DOMAIN}' group by 1, 2)
select h.time_start, h.time_start + interval '1 hour' as time_end, h.domain, h.pages_created,
       h.unique_authors,
       round_even(case when h.pages_created > 0
                       then h.bot_pages::double / h.pages_created * 100 else 0.0 end, 2) as bot_percent,
       (select string_agg(t.name || ':' || t.pages || ':' || t.is_bot::varchar, ';' order by t.rank)
          from top t where t.domain = h.domain and t.time_start = h.time_start) as top_authors
from hourly h""",
    "pages_by_id_per_domain": PAGE_EVENTS_CTE + """
select page_id, domain, created_at, page_title, user_id, user_name, is_bot, title_length
from page_events
qualify row_number() over (partition by domain, page_id order by created_at desc, domain) = 1""",
    "json_export": PAGE_EVENTS_CTE + SPAM_CTE + """
select domain, strftime(alert_time, '%Y-%m-%dT%H:%M:%S') as alert_time, severity, user_id,
       user_name, reason, page_title, page_id,
       case when microsecond(created_at) % 1000000 = 0 then strftime(created_at, '%Y-%m-%dT%H:%M:%S')
            else strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') end as created_at
from spam""",
})


def q_stored_pages_by_domain_range(spark, sf):
    """The range lookup answered from the stored raw table (compacted, day-partitioned)."""
    from pageflow.schema import RAW_PAGES
    from pageflow.session import scratch_path
    from pageflow.sources.tables import compact, read_latest, upsert_batch

    root = scratch_path(spark, "stored-raw")
    upsert_batch(page_events(spark, sf), RAW_PAGES, root, 0, 0)
    compact(spark, RAW_PAGES, root)
    lo, hi = lookups.parse_iso(RANGE_FROM), lookups.parse_iso(RANGE_TO)
    key = ((F.col("domain") == LOOKUP_DOMAIN)
           & F.col("created_at").between(F.lit(lo).cast("timestamp_ntz"),
                                         F.lit(hi).cast("timestamp_ntz")))
    days = F.col("date").between(F.lit(lo[:10]).cast("date"), F.lit(hi[:10]).cast("date"))
    pages = read_latest(spark, RAW_PAGES, root, key, days)
    return lookups.pages_by_domain(pages, LOOKUP_DOMAIN, RANGE_FROM, RANGE_TO, limit=500)


QUERIES["stored_pages_by_domain_range"] = q_stored_pages_by_domain_range
ORACLE_SQL["stored_pages_by_domain_range"] = PAGE_EVENTS_CTE + f"""
select domain, created_at, page_id, page_title, user_id, user_name, is_bot, title_length
from page_events where domain = '{LOOKUP_DOMAIN}'
  and created_at between timestamp '2024-01-01 03:00:00' and timestamp '2024-01-01 05:00:00'
order by created_at desc, page_id limit 500"""


def q_raw_fanout_latest(spark, sf):
    """One batch fanned out to the three query-shaped copies, a re-send resolved by key.

    Batch 1 re-sends the first hour's events (as a producer retry would); the
    resolved ``pages_by_id`` (newest write per page id) must equal the input.
    """
    from pageflow.schema import PAGES_BY_ID, PAGES_BY_USER, RAW_PAGES
    from pageflow.session import scratch_path
    from pageflow.sources.tables import read_latest, upsert_batch

    root = scratch_path(spark, "fanout")
    pe = page_events(spark, sf)
    resend = pe.filter(F.hour("created_at") == 0)
    for batch_id, batch in enumerate([pe, resend]):
        tables = keyed.raw_fanout(batch)
        for spec in (RAW_PAGES, PAGES_BY_USER, PAGES_BY_ID):
            upsert_batch(tables[spec.name], spec, root, 0, batch_id)
    return read_latest(spark, PAGES_BY_ID, root)


QUERIES["raw_fanout_latest"] = q_raw_fanout_latest
ORACLE_SQL["raw_fanout_latest"] = PAGE_EVENTS_CTE + """
select page_id, domain, created_at, page_title, user_id, user_name, is_bot, title_length
from page_events"""

ORACLE_SQL["language_activity"] = PAGE_EVENTS_CTE + LANG_CTE + "\nselect *, true as estimate_ok from lang"


def q_pages_by_shared_id(spark, sf):
    """Events that share page ids, in two batches: the later batch wins, then the newest row."""
    from pageflow.schema import PAGES_BY_ID
    from pageflow.session import scratch_path
    from pageflow.sources.tables import compact, read_latest, upsert_batch

    root = scratch_path(spark, "shared-ids")
    pe = page_events(spark, sf).withColumn("page_id", F.pmod("page_id", F.lit(COLLIDING_IDS)))
    upsert_batch(pe, PAGES_BY_ID, root, 0, 0)
    compact(spark, PAGES_BY_ID, root)
    upsert_batch(pe.filter(F.col("page_id") % 2 == 0).filter(F.hour("created_at") < 6), PAGES_BY_ID, root, 0, 1)
    return read_latest(spark, PAGES_BY_ID, root)


QUERIES["pages_by_shared_id"] = q_pages_by_shared_id
ORACLE_SQL["pages_by_shared_id"] = PAGE_EVENTS_CTE + f"""
select page_id % {COLLIDING_IDS} as page_id, * exclude (page_id)
from page_events
qualify row_number() over (partition by page_id % {COLLIDING_IDS}
    order by page_id % 2 = 0 and hour(created_at) < 6 desc, created_at desc, domain, page_title, user_id) = 1"""


def _stored_lookup(spec_name: str, value: int):
    def run(spark, sf):
        """A lookup over a compacted, bucketed base and a newer batch that re-sends an hour."""
        from pageflow.schema import TABLES
        from pageflow.session import scratch_path
        from pageflow.sources.tables import compact, read_key, upsert_batch

        spec, root = TABLES[spec_name], scratch_path(spark, "stored-lookup")
        pe = page_events(spark, sf)
        upsert_batch(pe, spec, root, 0, 0)
        compact(spark, spec, root)
        upsert_batch(pe.filter(F.hour("created_at") == 3), spec, root, 0, 1)
        return read_key(spark, spec, root, value)
    return run


def _rollup(spark, sf) -> DataFrame:
    """The report rollup of three batches, one of them written again and two of them compacted."""
    from pageflow.schema import AUTHOR_HOURS
    from pageflow.session import scratch_path
    from pageflow.sources.tables import compact, read_latest, upsert_batch

    root, pe = scratch_path(spark, "rollup"), page_events(spark, sf)
    for batch, third in enumerate((0, 1, 1, 2)):
        upsert_batch(reports.author_hours(pe.filter(F.col("page_id") % 3 == third)), AUTHOR_HOURS, root, 0, third)
        if batch == 2:
            compact(spark, AUTHOR_HOURS, root)
    return read_latest(spark, AUTHOR_HOURS, root)


def q_rollup_hourly_report(spark, sf):
    r = reports.hourly_report_from(_rollup(spark, sf), None, REPORT_HOURS, AS_OF)
    top = F.concat_ws(";", F.transform("top_authors", lambda x: F.concat_ws(
        ":", x["name"], x["pages"].cast("string"), x["is_bot"].cast("string"))))
    return r.withColumn("top_authors", top)


def q_rollup_editor_patterns(spark, sf):
    r = reports.editor_patterns_from(_rollup(spark, sf), MIN_EDITOR_PAGES)
    return (r.withColumn("domains", _join_array("domains"))
            .withColumn("active_hours_utc", _join_array("active_hours_utc")))


QUERIES |= {
    "stored_page_by_id": _stored_lookup("pages_by_id", LOOKUP_PAGE),
    "stored_pages_by_user": lambda s, sf: lookups.pages_by_user(_stored_lookup("pages_by_user", LOOKUP_USER)(s, sf), LOOKUP_USER),
    "rollup_hourly_report": q_rollup_hourly_report,
    "rollup_editor_patterns": q_rollup_editor_patterns,
}
ORACLE_SQL |= {
    "stored_page_by_id": ORACLE_SQL["page_by_id"],
    "stored_pages_by_user": ORACLE_SQL["pages_by_user"],
    "rollup_hourly_report": ORACLE_SQL["hourly_report"],
    "rollup_editor_patterns": ORACLE_SQL["editor_patterns"],
}
