"""Warehouse usage cost and ingestion freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import ladder, minutes_between, pct, safe_div
from stocktally.operators.joins import date_axis, fill_axis
from stocktally.operators.ordering import top_rows
from stocktally.operators.windows import top_n_else_other, trailing

GB, TB = 1024.0 ** 3, 1024.0 ** 4


def month_to_date(metering: DataFrame, ts: str, credits: str, as_of: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Spend this month against the same number of days of the month before.

    One scan: both periods are conditional sums over a two-month range.
    """
    today = F.lit(as_of).cast("date")
    start = F.trunc(today, "month")
    before = F.add_months(start, -1)
    elapsed = F.datediff(today, start) + 1
    day = F.col(ts).cast("date")
    now = (day >= start) & (day <= today)
    prior = (day >= before) & (day < start) & (day < F.date_add(before, elapsed))
    sums = metering.filter((day >= before) & (day <= today)).agg(
        F.sum(F.when(now, F.col(credits))).alias("c"), F.sum(F.when(prior, F.col(credits))).alias("p")
    )
    p = F.coalesce("p", F.lit(0))
    return sums.select(
        F.round("c", 2).alias("credits_mtd"), F.round(F.col("c") * cfg.credit_price, 2).alias("dollars_mtd"),
        F.round(p, 2).alias("credits_prior_mtd"), F.round(p * cfg.credit_price, 2).alias("dollars_prior_mtd"),
        elapsed.alias("days_elapsed"),
    )


def cost_by(metering: DataFrame, keys: Sequence[Column | str], credits: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Credits and dollars per key, for example day or month and resource."""
    return metering.groupBy(*keys).agg(
        F.round(F.sum(credits), 2).alias("credits"), F.round(F.sum(credits) * cfg.credit_price, 2).alias("dollars")
    )


def hourly_allocation(
    metering: DataFrame, work: DataFrame, resource: str, ts: str, credits: str, effort: str, who: Sequence[str],
) -> DataFrame:
    """Split each resource-hour's credits over its users by their effort.

    Effort is summed per user first. The hour's rate (credits per unit of effort) is
    worked out once per resource-hour and joined back, so the many users of a busy
    hour never meet in one window.
    """
    hour = F.date_trunc("hour", F.col(ts)).alias("hour")
    supply = metering.groupBy(resource, hour).agg(F.sum(credits).alias("__credits"))
    used = work.groupBy(*who, resource, hour).agg(F.sum(effort).alias("__effort"))
    rates = (
        used.groupBy(resource, "hour").agg(F.sum("__effort").alias("__all")).join(supply, [resource, "hour"])
        .select(resource, "hour", safe_div("__credits", "__all").alias("__rate"))
    )
    return used.join(rates, [resource, "hour"]).select(
        *who, resource, "hour", (F.col("__rate") * F.col("__effort")).alias("credits")
    )


def allocated_cost(shares: DataFrame, keys: Sequence[str], cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Allocated credits and dollars per key; keys that round to nothing are left out."""
    return shares.groupBy(*keys).agg(F.sum("credits").alias("__c")).select(
        *keys,
        F.round("__c", 2).alias("credits"), F.round(F.col("__c") * cfg.credit_price, 2).alias("dollars"),
    ).filter(F.col("credits") > 0)


def tag_label(tag: str, default: str = "<untagged>") -> Column:
    return F.coalesce(F.nullif(F.col(tag), F.lit("")), F.lit(default))


def daily_top_users(shares: DataFrame, user: str, n: int, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Daily cost of the top users of the whole period, the rest as one bucket."""
    daily = shares.groupBy(F.col("hour").cast("date").alias("usage_date"), user).agg(F.sum("credits").alias("credits"))
    labelled = top_n_else_other(daily, user, "credits", n).filter(F.col("credits") > 0)
    return labelled.groupBy("usage_date", "bucket").agg(
        F.round(F.sum("credits"), 2).alias("credits"), F.round(F.sum("credits") * cfg.credit_price, 2).alias("dollars")
    )


def cost_anomalies(daily: DataFrame, day: str, value: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Days above a multiple of the mean of the 28 days before."""
    framed = trailing(daily, [], day, value, -28, -1, {"avg_28d": "avg", "window_size": "count"})
    status = ladder([
        (F.col("window_size") < 7, "insufficient-history"),
        (F.col(value) > F.col("avg_28d") * cfg.anomaly_multiplier, "ANOMALY"),
    ], "normal")
    return framed.select(
        day, F.round(value, 2).alias("credits"), F.round(F.col(value) * cfg.credit_price, 2).alias("dollars"),
        F.round(F.coalesce("avg_28d", F.lit(0)), 2).alias("baseline_28d_credits"), status.alias("status"),
    )


def spike_status(daily: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """SPIKE above mean + 2 spreads of the 7 rows before, DROP below a fifth of it."""
    framed = trailing(daily, keys, day, value, -7, -1, {"m": "avg", "s": "stddev"}).filter(F.col("m").isNotNull())
    v, m = F.col(value), F.col("m")
    status = ladder([(v > m + 2 * F.coalesce("s", F.lit(0)), "SPIKE"), (v < m * 0.2, "DROP")], "NORMAL")
    return framed.select(
        *keys, day, F.round(v, 4).alias("total_credits"), F.round(m, 4).alias("rolling_7d_avg"),
        F.round("s", 4).alias("rolling_7d_stddev"), F.round(safe_div(v, m), 2).alias("ratio_vs_avg"), status.alias("anomaly_status"),
    )


def rolling_cost(daily: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Trailing 7- and 30-row means per resource."""
    week = trailing(daily, keys, day, value, -6, 0, {"credits_7d_avg": "avg"})
    return trailing(week, keys, day, value, -29, 0, {"credits_30d_avg": "avg"})


def utilization(load: DataFrame, resource: str, ts: str, running: str, queued: str, blocked: str) -> DataFrame:
    """Active and idle hours, concurrency and queueing per resource and day."""
    hourly = load.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"), resource).agg(
        F.avg(running).alias("r"), F.avg(queued).alias("q"), F.avg(blocked).alias("b"), F.max(running).alias("peak")
    )
    active = F.count_if(F.col("r") > 0)
    return hourly.groupBy(F.col("hour").cast("date").alias("usage_date"), resource).agg(
        active.alias("active_hours"), (24 - active).alias("idle_hours"), F.round(active / 24.0 * 100, 1).alias("utilization_pct"),
        F.avg("r").alias("avg_concurrency"), F.max("peak").alias("peak_concurrency"),
        F.sum("q").alias("total_queued"), F.sum("b").alias("total_blocked"),
    )


def with_event_counts(daily: DataFrame, events: DataFrame, resource: str, ts: str, kind: str, opens: str, closes: str) -> DataFrame:
    counts = events.groupBy(F.col(ts).cast("date").alias("usage_date"), resource).agg(
        F.count_if(F.col(kind) == opens).alias("resume_count"), F.count_if(F.col(kind) == closes).alias("suspend_count")
    )
    return daily.join(counts, ["usage_date", resource], "left").fillna(0, ["resume_count", "suspend_count"])


def cost_center(tag: str, role: str) -> Column:
    """Team that a query's cost belongs to."""
    t, r = F.col(tag), F.col(role)
    return ladder([
        (t.ilike("dbt%"), "dbt"), (t.ilike("airbyte%"), "airbyte"), (r.isin("POWERBI_ROLE", "POWERBI_READONLY_ROLE"), "powerbi"),
        (r == "STREAMLIT_ROLE", "streamlit"),
    ], "other")


def query_cost(history: DataFrame, keys: Sequence[Column | str], elapsed_ms: str, bytes_scanned: str, execution_ms: str) -> DataFrame:
    """Query counts, elapsed time, scanned volume and compute hours per key."""
    return history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("query_count"), F.round(F.sum(elapsed_ms) / 1000.0, 1).alias("total_elapsed_sec"),
        F.round(F.avg(elapsed_ms) / 1000.0, 2).alias("avg_elapsed_sec"),
        F.round(F.sum(bytes_scanned) / GB, 2).alias("total_gb_scanned"),
        F.round(F.sum(execution_ms) / 1000.0 / 3600.0, 2).alias("approx_compute_hours"),
    )


def tagged_cost(metering: DataFrame, tags: DataFrame, resource: str, ts: str, credits: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Cost per cost centre through tags on resources: tags(resource, cost_center)."""
    daily = metering.groupBy(resource, F.col(ts).cast("date").alias("usage_date")).agg(F.sum(credits).alias("compute_credits"))
    return daily.join(tags, resource).groupBy("cost_center", resource, "usage_date").agg(
        F.sum("compute_credits").alias("compute_credits"),
        (F.sum("compute_credits") * cfg.credit_price).alias("estimated_cost_usd"),
    )


def idle_spend(metering: DataFrame, load: DataFrame, resource: str, ts: str, credits: str, running: str) -> DataFrame:
    """Metered hours with credits but nothing running."""
    hour = F.date_trunc("hour", F.col(ts))
    hourly_load = load.select(F.col(resource), hour.alias("hour_ts"), F.col(running).alias("avg_running"))
    paid = metering.filter(F.col(credits) > 0).select(resource, hour.alias("hour_ts"), F.col(credits).alias("credits_used"))
    return (
        paid.join(hourly_load, [resource, "hour_ts"], "left").withColumn("avg_running", F.coalesce("avg_running", F.lit(0)))
        .filter(F.col("avg_running") == 0)
    )


def expensive_queries(history: DataFrame, order: str, tiebreak: str, n: int = 20) -> DataFrame:
    return top_rows(history, [F.col(order).desc_nulls_last(), F.col(tiebreak)], n)


def badly_pruned(history: DataFrame, scanned: str, total: str, tiebreak: str, n: int = 20, min_total: float = 100, ratio: float = 0.8) -> DataFrame:
    """Queries that scan most partitions of large tables."""
    bad = history.filter((F.col(total) > min_total) & (safe_div(scanned, total) > ratio))
    return top_rows(bad.withColumn("scan_pct", pct(scanned, total, 1)), [F.col(scanned).desc(), F.col(tiebreak)], n)


def spilling(history: DataFrame, local: str, remote: str, tiebreak: str, n: int = 20) -> DataFrame:
    """Queries that wrote to local or remote storage for lack of memory."""
    spilled = history.filter((F.col(local) > 0) | (F.col(remote) > 0))
    return top_rows(
        spilled.withColumns({"gb_spilled_local": F.col(local) / GB, "gb_spilled_remote": F.col(remote) / GB}),
        [F.col(remote).desc_nulls_last(), F.col(tiebreak)], n,
    )


def storage_snapshot(storage: DataFrame, day: str, database: str, active: str, failsafe: str, as_of: str) -> DataFrame:
    """Stored volume per database on the day before as_of."""
    rows = storage.filter((F.col(day) == F.date_sub(F.lit(as_of).cast("date"), 1)) & (F.col(active) > 0))
    return rows.select(
        database, F.round(F.col(active) / GB, 2).alias("active_gb"), F.round(F.col(failsafe) / GB, 2).alias("failsafe_gb"),
        F.round((F.col(active) + F.col(failsafe)) / GB, 2).alias("total_gb"),
    )


def storage_growth(databases: DataFrame, stages: DataFrame, day: str, name: str, active: str, failsafe: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Volume and monthly cost per day: databases plus one row for file stages."""
    files = stages.select(F.col(day), F.lit("STAGES").alias(name), F.col(active), F.lit(0.0).alias(failsafe))
    both = databases.select(day, name, active, failsafe).unionByName(files)
    total = (F.col(active) + F.col(failsafe)) / TB
    return both.select(
        day, name, F.round(F.col(active) / TB, 6).alias("active_tb"), F.round(F.col(failsafe) / TB, 6).alias("failsafe_tb"),
        F.round(total, 6).alias("total_tb"), F.round(total * cfg.storage_price_per_tb, 2).alias("estimated_monthly_cost_usd"),
    )


def combined_monthly(frames: dict[str, DataFrame], spark, as_of: str, months: int) -> DataFrame:
    """Monthly cost of several providers on one axis; each frame is (month, value)."""
    year, month = int(as_of[:4]), int(as_of[5:7])
    first = year * 12 + month - months
    start = f"{first // 12:04d}-{first % 12 + 1:02d}-01"
    axis = date_axis(spark, start, f"{as_of[:7]}-01", "month", "month")
    merged = fill_axis(axis, frames, "month")
    total = F.lit(0.0)
    for name in frames:
        total = total + F.col(name)
    return merged.withColumn("total", total)


# --- freshness --------------------------------------------------------------
def stream_freshness(records: DataFrame, connection: str, stream: str, extracted: str, now: str) -> DataFrame:
    """Newest record and its age in minutes per stream."""
    return records.groupBy(connection, stream).agg(F.max(extracted).alias("last_extracted_at")).withColumn(
        "staleness_min", minutes_between("last_extracted_at", F.lit(now).cast("timestamp"))
    )


def connection_freshness(streams: DataFrame, thresholds: DataFrame, connection: str, now: str) -> DataFrame:
    """Status per connection by its busiest stream; slow lookup tables do not alarm."""
    per = streams.groupBy(connection).agg(
        F.min("last_extracted_at").alias("oldest_extracted_at"), F.max("last_extracted_at").alias("newest_extracted_at"),
        F.count(F.lit(1)).alias("table_count"),
    ).withColumn("staleness_min", minutes_between("newest_extracted_at", F.lit(now).cast("timestamp")))
    status = ladder([
        (F.col("staleness_min") >= F.col("alert_minutes"), "ALERT"), (F.col("staleness_min") >= F.col("warn_minutes"), "WARN"),
    ], "OK")
    return per.join(thresholds, connection, "left").withColumn("status", status)


def crossed_since(freshness: DataFrame, status: str, threshold: str, now: str, last_run: str | None) -> DataFrame:
    """Connections that reached a level after the previous check; each alarms once."""
    gap = F.lit(1) if last_run is None else minutes_between(F.lit(last_run).cast("timestamp"), F.lit(now).cast("timestamp"))
    age, limit = F.col("staleness_min"), F.col(threshold)
    return freshness.filter((F.col("status") == status) & (age >= limit) & (age < limit + gap))


def repeat_incidents(audit: DataFrame, key: str, ts: str, action: str, kind: str, now: str, window_min: int) -> DataFrame:
    """Actions of a kind per key inside a time window ending now."""
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(mins=F.lit(window_min))
    return audit.filter((F.col(action) == kind) & (F.col(ts).cast("timestamp") >= since)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def first_abnormal_event(captures: DataFrame, key: str, events: str, started: str) -> DataFrame:
    """Earliest event of each capture's event array.

    Events have reason, first_ts, count. A repeated event, or one that began after
    the attempt, is only inferred evidence. The earliest entry is picked inside the
    row, so the array is not exploded over the cluster.
    """
    ordered = F.array_sort(F.transform(
        events, lambda e: F.struct(
            e["first_ts"].isNull().alias("none"), e["first_ts"].alias("first_ts"), e["reason"].alias("reason"), e["count"].alias("count")
        )
    ))
    first = captures.filter(F.size(events) > 0).withColumn("__e", F.element_at(ordered, 1))
    inferred = (F.col("__e")["count"] > 1) | (F.col("__e")["first_ts"] > F.col(started))
    return first.select(
        key, started, F.col("__e")["reason"].alias("first_reason"), F.col("__e")["first_ts"].alias("first_event_ts"),
        F.col("__e")["count"].alias("event_count"),
        F.when(inferred, "inferred").otherwise("authoritative").alias("confidence"),
    )


def first_abnormal_of_log(events: DataFrame, keys: Sequence[str | Column], reason: str | Column, ts: str, count: Column, started: Column | None = None) -> DataFrame:
    """The same from a log with one row per event: keys, started, first_reason, first_event_ts, event_count, confidence.

    One minimum per key, combined before the shuffle: no key's events come together in one cell or task. Events without
    a time come last, ties go to the smaller reason. `started` is the begin of the attempt, by default its first event.
    """
    named = lambda c: F.col(c) if isinstance(c, str) else c
    entry = F.struct(F.col(ts).isNull().alias("none"), F.col(ts).alias("first_ts"), named(reason).alias("reason"), count.alias("count"))
    first = events.groupBy(*keys).agg(F.min(entry).alias("__e"), F.min(started if started is not None else F.col(ts)).alias("started"))
    inferred = (F.col("__e")["count"] > 1) | (F.col("__e")["first_ts"] > F.col("started"))
    return first.withColumns({
        "first_reason": F.col("__e")["reason"], "first_event_ts": F.col("__e")["first_ts"], "event_count": F.col("__e")["count"],
        "confidence": F.when(inferred, "inferred").otherwise("authoritative"),
    }).drop("__e")
