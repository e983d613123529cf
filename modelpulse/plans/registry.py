"""Registry that ties a named query to its equivalent ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its own name; without SQL only its rows are checked."""

    def wrap(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return wrap


# The canonical request log of sources.tables, in SQL.
REQUESTS = """
base AS (
  SELECT event_id AS request_id, user_id, event_type, ts,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         epoch_us(ts) AS start_us, value AS latency_ms,
         epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) AS end_us,
         value * 0.75 AS inference_ms
  FROM events),
typed AS (
  SELECT *, '/ep' || (k % 4) AS endpoint,
         CASE WHEN k % 3 = 0 THEN 'GET' ELSE 'POST' END AS method,
         CASE user_id % 3 WHEN 0 THEN 'sequential' WHEN 1 THEN 'async' ELSE 'threads' END AS run,
         CASE event_type WHEN 'view' THEN 'health' WHEN 'signup' THEN 'metrics' ELSE 'predict' END AS task,
         CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'HTTPException'
              WHEN event_type = 'error' THEN 'ValueError' END AS error_type
  FROM base),
requests AS (
  SELECT *, CASE WHEN error_type IS NULL THEN 200
                 WHEN error_type = 'HTTPException' AND k % 4 = 0 THEN 503 ELSE 500 END AS status
  FROM typed)
"""


def with_requests(body: str) -> str:
    return f"WITH {REQUESTS} {body}"


def histogram_sql(source: str, keys: str, value: str, bounds, ctes: str = "") -> str:
    """Cumulative buckets in SQL: one branch per bound, then +Inf, count and sum."""
    k = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    parts = [
        f"SELECT {k}'bucket' AS sample, '{float(b)}' AS le, "
        f"CAST(count(*) FILTER ({value} <= {float(b)}) AS DOUBLE) AS value FROM {source} {group}"
        for b in bounds
    ]
    parts.append(f"SELECT {k}'bucket', '+Inf', CAST(count({value}) AS DOUBLE) FROM {source} {group}")
    parts.append(f"SELECT {k}'count', '', CAST(count({value}) AS DOUBLE) FROM {source} {group}")
    parts.append(f"SELECT {k}'sum', '', round(CAST(sum({value}) AS DOUBLE), 4) FROM {source} {group}")
    return (f"WITH {ctes} " if ctes else "") + "\nUNION ALL ".join(parts)
