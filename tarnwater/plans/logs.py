"""Access-log queries. The lines are rendered from ``events``, so that both engines read the same text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.operators import logs
from tarnwater.plans.registry import query, rounded
from tarnwater.session import Tables


def render_lines(t: Tables) -> DataFrame:
    """One access-log line per event."""
    suffix = F.get(F.array(*[F.lit(s) for s in (".de", ".ca", ".sg", ".jp")]), (F.col("user_id") % 4).cast("int"))
    code = F.get(F.array(F.lit("200"), F.lit("304"), F.lit("404")), (F.col("event_id") % 3).cast("int"))
    size = F.when(F.col("event_type") == "error", "-").otherwise(F.floor("value").cast("string"))
    return t.events.select(
        F.concat(
            F.lit("h"), F.col("user_id").cast("string"), suffix, F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
            F.lit(' -0400] "GET /'), "event_type", F.lit(' HTTP/1.0" '), code, F.lit(" "), size,
        ).alias("value")
    )


def parsed(t: Tables) -> DataFrame:
    """Parsed log."""
    return logs.parse_log(render_lines(t))


LINES_SQL = """
    lines AS (
        SELECT 'h' || user_id || (['.de', '.ca', '.sg', '.jp'])[(user_id % 4) + 1] || ' - - ['
            || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "GET /' || event_type || ' HTTP/1.0" '
            || (['200', '304', '404'])[(event_id % 3) + 1] || ' '
            || CASE WHEN event_type = 'error' THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS value
        FROM events
    )"""

LOG_SQL = (
    LINES_SQL
    + """,
    log AS (
        SELECT regexp_extract(value, '^(.*) - -.*', 1) AS host,
            regexp_extract(value, '.* - - \\[(.*)\\].*', 1) AS "timestamp",
            regexp_extract(value, '.*"(.*)".*', 1) AS request,
            try_cast(string_split(value, ' ')[-2] AS INTEGER) AS reply_code,
            try_cast(string_split(value, ' ')[-1] AS INTEGER) AS bytes
        FROM lines
    ),
    tagged AS (SELECT *, right(host, 3) AS suffix FROM log WHERE right(host, 3) IN ('.de', '.ca', '.sg')),
    hosts AS (SELECT suffix, host, count(*) AS n FROM tagged GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY suffix ORDER BY n DESC, host) AS rank FROM hosts),
    buckets AS (
        SELECT suffix, host, n FROM ranked WHERE rank <= 9
        UNION ALL
        SELECT suffix, 'Rest', CAST(sum(CASE WHEN rank > 9 THEN n ELSE 0 END) AS BIGINT) FROM ranked GROUP BY suffix
    ),
    visits AS (
        SELECT suffix, host, substr("timestamp", 1, 2) AS day, substr("timestamp", 13, 2) AS hour, count(*) AS n
        FROM tagged JOIN (SELECT suffix, host FROM ranked WHERE rank = 1) USING (suffix, host) GROUP BY ALL
    )"""
)


@query(f"WITH {LOG_SQL} SELECT host, \"timestamp\", request, reply_code, coalesce(bytes, -1) AS bytes, bytes IS NULL AS no_bytes FROM log")
def log_line_parse(t: Tables) -> DataFrame:
    return parsed(t).select("host", "timestamp", "request", "reply_code", F.coalesce("bytes", F.lit(-1)).alias("bytes"), F.isnull("bytes").alias("no_bytes"))


@query(f"WITH {LOG_SQL} SELECT suffix, count(*) AS n_requests FROM tagged GROUP BY suffix")
def log_suffix_counts(t: Tables) -> DataFrame:
    return logs.suffix_counts(parsed(t))


@query(f"WITH {LOG_SQL} SELECT suffix, count(DISTINCT host) AS n_hosts FROM tagged GROUP BY suffix")
def log_unique_hosts(t: Tables) -> DataFrame:
    return logs.unique_hosts(parsed(t))


@query(f"WITH {LOG_SQL} SELECT suffix, host, n, rank FROM ranked WHERE rank <= 9")
def log_top_hosts(t: Tables) -> DataFrame:
    return logs.top_hosts(parsed(t)).withColumn("rank", F.col("rank").cast("bigint"))


@query(f"WITH {LOG_SQL} SELECT suffix, host, n FROM buckets")
def log_rest_bucket(t: Tables) -> DataFrame:
    return logs.rest_bucket(parsed(t))


@query(
    f"WITH {LOG_SQL} SELECT suffix, host, n, round(100.0 * n / sum(n) OVER (PARTITION BY suffix), 6) AS percent FROM buckets"
)
def log_share_percent(t: Tables) -> DataFrame:
    return logs.share_percent(logs.rest_bucket(parsed(t))).withColumn("percent", rounded("percent"))


@query(f"WITH {LOG_SQL} SELECT suffix, host, day, hour, n FROM visits")
def log_top_host_heatmap(t: Tables) -> DataFrame:
    return logs.top_host_visits(parsed(t))


DAYS = [f"{d:02d}" for d in range(1, 32)]


@query(
    f"WITH {LOG_SQL} SELECT suffix, hour, "
    + ", ".join(f"CAST(sum(CASE WHEN day = '{d}' THEN n END) AS DOUBLE) AS d{d}" for d in DAYS)
    + " FROM visits GROUP BY suffix, hour"
)
def log_heatmap_pivot(t: Tables) -> DataFrame:
    matrix = logs.visit_matrix(logs.top_host_visits(parsed(t)), DAYS)
    return matrix.select("suffix", "hour", *[F.col(f"d{d}").cast("double").alias(f"d{d}") for d in DAYS])


@query(f"WITH {LINES_SQL} SELECT count(*) AS n_lines FROM lines WHERE contains(value, '.jp')")
def log_substring_count(t: Tables) -> DataFrame:
    return logs.containing(render_lines(t), ".jp")
