"""Run metrics (M3-M5, M7-M9) over a batch-timing table derived from events.

Timing table: one event = one batch of run ``user_id``; ``seconds = value``,
``num_tokens = props.k``, ``num_samples = 1 + k mod 16``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from synthtext.functions.ratios import throughput_columns
from synthtext.operators import metrics as M
from synthtext.plans.registry import r6, register, table

_K = "json_extract(props, '$.k')::BIGINT"
TIMING_SQL = (
    f"SELECT user_id AS run_id, event_id AS batch_id, value AS seconds, {_K} AS num_tokens, "
    f"1 + {_K} % 16 AS num_samples FROM events"
)


def timing(spark, d):
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("batch_id"),
        F.col("value").alias("seconds"), k.alias("num_tokens"),
        (F.lit(1) + F.pmod(k, F.lit(16))).cast("long").alias("num_samples"),
    )


def _ratios_sql(tok, t, smp):
    # Ratios use the time total rounded to 6 places: both engines hold that
    # value identically, whatever order they summed the seconds in.
    t = f"round({t}, 6)"

    def div(a, b):
        return f"round(CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0 END, 6)"

    return (
        f"{div(tok, t)} AS tokens_per_second, {div(smp, t)} AS samples_per_second, "
        f"{div(tok, smp)} AS tokens_per_sample, {div(t, smp)} AS seconds_per_sample"
    )


RATIOS = ["tokens_per_second", "samples_per_second", "tokens_per_sample", "seconds_per_sample"]


def _round_ratios(df, keys):
    """Round the time total to 6 places and derive the M3 ratios from it (see
    ``_ratios_sql``); the operators themselves keep full precision."""
    r = df.select(*keys, "total_tokens", "total_samples", r6("total_time").alias("total_time"))
    return r.select(
        *keys, "total_tokens", "total_samples", "total_time",
        *[r6(x).alias(n) for x, n in zip(throughput_columns("total_tokens", "total_time", "total_samples"), RATIOS)],
    )


_TOTALS_SQL = (
    f"WITH t AS ({TIMING_SQL}), a AS (SELECT run_id, sum(num_tokens) AS tok, sum(num_samples) AS smp, "
    "sum(seconds) AS sec FROM t GROUP BY run_id) "
    "SELECT run_id, tok::BIGINT AS total_tokens, smp::BIGINT AS total_samples, round(sec, 6) AS total_time, "
    + _ratios_sql("tok", "sec", "smp") + " FROM a"
)


@register("q_run_totals", _TOTALS_SQL)
def q_run_totals(spark, d):
    return _round_ratios(M.run_totals(timing(spark, d), ["run_id"]), ["run_id"])


@register(
    "q_running_metrics",
    f"WITH t AS ({TIMING_SQL}), c AS (SELECT run_id, batch_id, "
    "sum(num_tokens) OVER w AS tok, sum(num_samples) OVER w AS smp, sum(seconds) OVER w AS sec FROM t "
    "WINDOW w AS (PARTITION BY run_id ORDER BY batch_id ROWS UNBOUNDED PRECEDING)) "
    "SELECT run_id, batch_id, tok::BIGINT AS total_tokens, smp::BIGINT AS total_samples, "
    "round(sec, 6) AS total_time, " + _ratios_sql("tok", "sec", "smp") + " FROM c",
)
def q_running_metrics(spark, d):
    # Small blocks so the two-level scan spans several blocks per run here too.
    run = M.running_metrics(timing(spark, d), ["run_id"], "batch_id", block_size=256)
    return _round_ratios(run, ["run_id", "batch_id"])


@register(
    "q_metrics_long",
    f"WITH x AS ({_TOTALS_SQL}) SELECT run_id, 'throughput/' || name AS name, value FROM "
    "(UNPIVOT (SELECT run_id, total_tokens::DOUBLE AS total_tokens, total_samples::DOUBLE AS total_samples, "
    "total_time::DOUBLE AS total_time, tokens_per_second::DOUBLE AS tokens_per_second, "
    "samples_per_second::DOUBLE AS samples_per_second, tokens_per_sample::DOUBLE AS tokens_per_sample, "
    "seconds_per_sample::DOUBLE AS seconds_per_sample FROM x) ON COLUMNS(* EXCLUDE (run_id)) "
    "INTO NAME name VALUE value)",
)
def q_metrics_long(spark, d):
    wide = _round_ratios(M.run_totals(timing(spark, d), ["run_id"]), ["run_id"])
    return M.flatten_metrics(wide, ["run_id"], prefix="throughput")


@register(
    "q_generation_report",
    f"WITH t AS ({TIMING_SQL}), a AS (SELECT run_id, sum(num_tokens) AS tok, sum(num_samples) AS smp, "
    "round(sum(seconds), 6) AS sec FROM t GROUP BY run_id) SELECT run_id, "
    "round(CASE WHEN sec > 0 THEN tok / sec ELSE 0 END, 6) AS \"throughput/tokens_per_second\", "
    "round(CASE WHEN sec > 0 THEN smp / sec ELSE 0 END, 6) AS \"throughput/samples_per_second\", "
    "round(CASE WHEN smp > 0 THEN tok / smp ELSE 0 END, 6) AS \"generation/tokens_per_sample\", "
    "tok::BIGINT AS \"generation/total_tokens\", smp::BIGINT AS \"generation/total_samples\", "
    "16::BIGINT AS \"generation/batch_size\", round(sec, 6) AS \"time/total_seconds\", "
    "round(CASE WHEN smp > 0 THEN sec / smp ELSE 0 END, 6) AS \"time/seconds_per_sample\" FROM a",
)
def q_generation_report(spark, d):
    totals = M.run_totals(timing(spark, d), ["run_id"]).withColumn("total_time", r6("total_time"))
    rep = M.generation_report(totals, 16, ["run_id"])
    dbl = [c for c, t in rep.dtypes if t == "double"]
    return rep.select(*[r6(F.col(f"`{c}`")).alias(c) if c in dbl else F.col(f"`{c}`") for c in rep.columns])


# --------------------------------------------------------------------------
# M8: device memory samples derived from events
# --------------------------------------------------------------------------
_GIB = 1024**3
DEVICE_SQL = (
    f"SELECT user_id AS device, event_id, (value * {_GIB})::BIGINT AS allocated_bytes, "
    f"({_K} * {_GIB})::BIGINT AS reserved_bytes FROM events"
)


def device_samples(spark, d):
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(
        F.col("user_id").alias("device"), "event_id",
        F.round(F.col("value") * F.lit(_GIB)).cast("long").alias("allocated_bytes"),
        (k * F.lit(_GIB)).cast("long").alias("reserved_bytes"),
    )


@register(
    "q_device_usage",
    f"WITH s AS ({DEVICE_SQL}) SELECT device, event_id, round(allocated_bytes / {_GIB}, 6) AS allocated_gb, "
    f"round(reserved_bytes / {_GIB}, 6) AS reserved_gb, round(CASE WHEN reserved_bytes > 0 THEN "
    "allocated_bytes / reserved_bytes ELSE 0 END, 6) AS utilization FROM s",
)
def q_device_usage(spark, d):
    u = M.device_usage(device_samples(spark, d))
    return u.select("device", "event_id", *[r6(c).alias(c) for c in ("allocated_gb", "reserved_gb", "utilization")])


@register(
    "q_device_usage_summary",
    f"WITH s AS ({DEVICE_SQL}), u AS (SELECT device, allocated_bytes / {_GIB} AS a, reserved_bytes / {_GIB} AS r, "
    "CASE WHEN reserved_bytes > 0 THEN allocated_bytes / reserved_bytes ELSE 0 END AS ut FROM s) "
    "SELECT device, count(*)::BIGINT AS n_samples, round(max(a), 6) AS max_allocated_gb, "
    "round(max(r), 6) AS max_reserved_gb, round(avg(ut), 6) AS avg_utilization, "
    "round(max(ut), 6) AS max_utilization FROM u GROUP BY device",
)
def q_device_usage_summary(spark, d):
    s = M.device_usage_summary(device_samples(spark, d))
    return s.select("device", "n_samples", *[r6(c).alias(c) for c in s.columns[2:]])


@register(
    "q_throughput",
    f"WITH t AS ({TIMING_SQL}), a AS (SELECT run_id, sum(num_tokens) AS tok, sum(num_samples) AS smp, "
    "sum(seconds) AS sec FROM t GROUP BY run_id) SELECT run_id, " + _ratios_sql("tok", "sec", "smp") + " FROM a",
)
def q_throughput(spark, d):
    """M3 on per-run totals: tokens/s, samples/s, tokens/sample, seconds/sample."""
    tot = _round_ratios(M.run_totals(timing(spark, d), ["run_id"]), ["run_id"])
    return tot.select("run_id", *RATIOS)
