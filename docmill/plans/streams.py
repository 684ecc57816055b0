"""Streams over the event files, run to their end and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import scratch
from ..streaming import leases
from .registry import query

#: A lease lasts half a day, and events may be a day late.
HOURS, LATE = 12, "1 day"
_L = HOURS * 3_600_000_000


@query(f"""
WITH e AS (SELECT DISTINCT user_id AS u, epoch_us(ts) AS us, CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN 2 ELSE 1 END AS r, (event_id % 2)::VARCHAR AS w FROM events),
m AS (SELECT *, sum((r = 0)::INT) OVER x AS n, last_value(CASE WHEN r = 0 THEN w END IGNORE NULLS) OVER x AS holder FROM e WINDOW x AS (PARTITION BY u ORDER BY us, r, w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT *, coalesce(us > lag(us) OVER x + {_L}, false) OR coalesce(lag(r) OVER x = 2, false) AS broken FROM m WHERE n > 0 AND holder = w WINDOW x AS (PARTITION BY u, n ORDER BY us, r)),
g AS (SELECT *, sum(broken::INT) OVER (PARTITION BY u, n ORDER BY us, r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gone FROM b),
l AS (SELECT u, n, min(us) AS c, max(us) AS beat, max(w) AS w, bool_or(r = 2) AS done FROM g WHERE gone = 0 GROUP BY 1, 2), x AS (SELECT *, lead(c) OVER (PARTITION BY u ORDER BY n) AS following FROM l)
SELECT u AS user_id, w AS worker, c AS claimed_us, beat AS beat_us, beat + {_L} AS expired_us FROM x
WHERE NOT done AND (following IS NULL OR following > beat + {_L}) AND (beat + {_L}) // 1000 + 1 <= (SELECT max(us) // 1000 FROM e) - 86400000""")
def lease_stream(t):
    """Leases of users by what they did: a sign-up claims, an error ends, and all else is a sign of life."""
    leases.use_state_store(t.spark)
    # A pattern, as a stream takes a single file only by one.
    raw = t.spark.readStream.schema("event_id long, ts timestamp_ntz, user_id long, event_type string").parquet(f"{t.sf_dir}/events.parque[t]")
    kind = F.when(F.col("event_type") == "signup", leases.CLAIM).when(F.col("event_type") == "error", leases.DONE).otherwise(leases.BEAT)
    events = raw.select("user_id", F.col("ts").cast("timestamp").alias("ts"), kind.alias("kind"), (F.col("event_id") % 2).cast("string").alias("worker"))
    out = scratch.new_path(t.spark, "leases")
    stream = leases.expired(events, HOURS * 3600, LATE, key="user_id")
    us = {"claimed_us": "claimed_at", "beat_us": "last_beat", "expired_us": "expired_at"}
    told = stream.select("user_id", "worker", *[F.unix_micros(c).alias(n) for n, c in us.items()])
    told.writeStream.format("parquet").option("path", f"{out}/told").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(told.schema).parquet(f"{out}/told")
