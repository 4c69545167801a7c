"""Reconciling a ledger with what arrived, and reports over measured runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcdc.functions import codecs
from sparkcdc.operators.ordered import exact_median, nearest_ranks

# The screening limits on p99 latency, in milliseconds.
STEADY_P99_MS = 250
HELD_P99_MS = 1000
PERCENTILES = {"p50": (50, 100), "p95": (95, 100), "p99": (99, 100), "max": (1, 1)}


def reconcile_rows(expected: DataFrame, received: DataFrame) -> DataFrame:
    """One row per id with ``status``: ok, missing, corrupt or phantom.

    ``expected(id, sent_ns, checksum)``, ``received(id, sent_ns, checksum, recv_ns)``. The first arrival
    counts; further ones are ``duplicates``, and ``changed`` marks an id whose copies differ.
    """
    content = F.struct("sent_ns", "checksum")
    arrived = received.groupBy("id").agg(
        F.min(F.struct("recv_ns", "sent_ns", "checksum")).alias("_first"),
        (F.count("*") - 1).alias("duplicates"),
        (F.min(content) != F.max(content)).alias("changed"),
    )
    got = arrived.select(
        "id",
        "duplicates",
        "changed",
        F.col("_first")["recv_ns"].alias("recv_ns"),
        F.col("_first")["sent_ns"].alias("_sent"),
        F.col("_first")["checksum"].alias("_sum"),
    )
    joined = expected.join(got, "id", "full_outer")
    differs = (F.col("_sent") != F.col("sent_ns")) | (F.col("_sum") != F.col("checksum"))
    status = (
        F.when(F.col("recv_ns").isNull(), F.lit("missing"))
        .when(F.col("sent_ns").isNull(), F.lit("phantom"))
        .when(differs, F.lit("corrupt"))
        .otherwise(F.lit("ok"))
    )
    return joined.select(
        "id",
        status.alias("status"),
        F.coalesce(F.col("duplicates"), F.lit(0)).alias("duplicates"),
        F.coalesce(F.col("changed"), F.lit(False)).alias("changed"),
        F.when(status == "ok", F.col("recv_ns") - F.col("sent_ns")).alias("latency_ns"),
    )


def reconcile(rows: DataFrame) -> DataFrame:
    """Totals of ``reconcile_rows``."""

    def n(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return rows.agg(
        F.count_if(F.col("status") != "phantom").alias("expected"),
        n("missing").alias("missing"),
        n("corrupt").alias("corrupt"),
        n("phantom").alias("phantoms"),
        F.sum("duplicates").alias("duplicates"),
        F.count_if("changed").alias("changed_duplicates"),
    )


def wire_check(records: DataFrame) -> DataFrame:
    """Adds ``id, sent_ns, payload`` of a benchmark record and ``reason``: 8-byte id, 8-byte send time,
    text; the key is the id in decimal and the only header is ``id`` with the stable uuid."""
    ident = codecs.bytes_int8(F.col("value"))
    sent = codecs.bytes_int8(F.substr(F.col("value"), F.lit(9)))
    header = F.get("headers", F.lit(0))
    reason = (
        F.when(~F.coalesce(F.octet_length("value") >= 16, F.lit(False)) | ident.isNull(), F.lit("value too short"))
        .when(~F.coalesce(F.decode("key", "UTF-8") == ident.cast("string"), F.lit(False)), F.lit("key differs"))
        .when(F.coalesce(F.size("headers"), F.lit(0)) != 1, F.lit("one header expected"))
        .when(
            ~F.coalesce((header["key"] == "id") & (F.decode(header["value"], "UTF-8") == codecs.stable_uuid(ident)), F.lit(False)),
            F.lit("id header differs"),
        )
    )
    return records.select(
        "*",
        ident.alias("id"),
        sent.alias("sent_ns"),
        F.decode(F.substr(F.col("value"), F.lit(17)), "UTF-8").alias("payload"),
        reason.alias("reason"),
    )


def latency_profile(rows: DataFrame, by: Sequence[str], value: str, width: int, warmup: Column | None = None) -> DataFrame:
    """Nearest-rank p50, p95, p99 and max at index ``floor((n-1)*p/100)``; ``warmup`` rows are left out."""
    kept = rows if warmup is None else rows.where(~warmup)
    return nearest_ranks(kept, by, value, PERCENTILES, width)


def admission_delay(rows: DataFrame, start_us: Column, rate_per_second: int, index: str = "i", actual: str = "actual_us") -> DataFrame:
    """Adds ``scheduled_us`` (start plus index over rate) and ``delay_us``."""
    scheduled = start_us + F.floor(F.col(index) * 1_000_000 / rate_per_second)
    return rows.withColumn("scheduled_us", scheduled.cast("bigint")).withColumn("delay_us", F.col(actual) - scheduled.cast("bigint"))


RUN_SCHEMA = (
    "mode string, rate bigint, prepared_backlog bigint, committed bigint, measured_committed bigint, missing bigint, corrupt bigint,"
    " phantoms bigint, duplicates bigint, source_ack_complete boolean, producer_elapsed_s double, recovery_s double, queue_bytes bigint,"
    " latency_tx_start_to_decode_ms struct<p50:double,p95:double,p99:double,max:double>,"
    " samples map<string,array<struct<elapsed_s:double,cpu_seconds:double,memory_mib:double,anonymous_mib:double,process_rss_mib:double>>>"
)


def read_runs(documents: DataFrame, text: str = "document") -> DataFrame:
    """``(case, document)`` result documents as columns."""
    return documents.select("case", F.from_json(text, RUN_SCHEMA).alias("_r")).select("case", "_r.*")


def correct(row_prefix: str = "") -> Column:
    c = lambda n: F.coalesce(F.col(row_prefix + n), F.lit(0)) == 0
    return c("missing") & c("corrupt") & c("phantoms") & F.coalesce(F.col(row_prefix + "source_ack_complete"), F.lit(False))


def run_summary(runs: DataFrame) -> DataFrame:
    """Per run: correct, events per second, p99, queue MiB, and how a prepared backlog drained."""
    through = F.col("producer_elapsed_s") + F.col("recovery_s")
    backlog = F.col("prepared_backlog") > 0
    return runs.select(
        "case",
        "mode",
        "rate",
        correct().alias("correct"),
        "committed",
        "duplicates",
        (F.col("measured_committed") / F.col("producer_elapsed_s")).alias("events_per_s"),
        F.col("latency_tx_start_to_decode_ms")["p99"].alias("latency_p99_ms"),
        (F.col("queue_bytes") / (1 << 20)).alias("queue_mib"),
        F.when(backlog, through).alias("backlog_s"),
        F.when(backlog, F.col("prepared_backlog") / through).alias("backlog_per_s"),
    )


def resource_use(runs: DataFrame) -> DataFrame:
    """Per run and part: CPU percent of one core from first to last sample, and memory peaks."""
    parts = runs.select("case", F.explode("samples").alias("part", "_samples")).select("case", "part", F.explode("_samples").alias("s"))
    use = parts.groupBy("case", "part").agg(
        F.min_by("s", "s.elapsed_s").alias("_first"),
        F.max_by("s", "s.elapsed_s").alias("_last"),
        F.max("s.memory_mib").alias("memory_peak_mib"),
        F.max("s.anonymous_mib").alias("anonymous_peak_mib"),
        F.max("s.process_rss_mib").alias("process_rss_peak_mib"),
    )
    span = F.col("_last")["elapsed_s"] - F.col("_first")["elapsed_s"]
    cpu = F.when(span > 0, (F.col("_last")["cpu_seconds"] - F.col("_first")["cpu_seconds"]) / span * 100)
    return use.select("case", "part", cpu.alias("cpu_pct_one_core"), "memory_peak_mib", "anonymous_peak_mib", "process_rss_peak_mib")


def steady_medians(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """Median per mode over the ``steady-`` runs (mean of the two middle values)."""
    steady = rows.where(F.startswith(F.col("case"), F.lit("steady-")))
    out = steady.groupBy("mode").agg(F.count("*").alias("runs"))
    for v in values:
        middle = exact_median(steady, ["mode"], v).withColumnRenamed("mode", "_mode")
        out = out.join(middle, F.col("mode").eqNullSafe(F.col("_mode")), "left").drop("_mode")
    return out


def cohort_status(cases: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per cohort: how many cases have no run, and whether it is complete (none missing, all
    runs correct). ``cases(cohort, case)``, ``summary(case, correct)``."""
    joined = cases.join(summary.select("case", "correct"), "case", "left")
    return joined.groupBy("cohort").agg(
        F.count("*").alias("cases"),
        F.count_if(F.col("correct").isNull()).alias("missing_cases"),
        F.min(F.when(F.col("correct").isNull(), F.col("case"))).alias("first_missing"),
        F.bool_and(F.coalesce(F.col("correct"), F.lit(False))).alias("complete"),
    )


def latency_gates(summary: DataFrame) -> DataFrame:
    """Adds ``passed``: a correct run whose p99 is within the limit of its kind of case."""
    limit = F.when(F.startswith(F.col("case"), F.lit("steady")), F.lit(STEADY_P99_MS)).when(
        F.startswith(F.col("case"), F.lit("held")), F.lit(HELD_P99_MS)
    )
    within = limit.isNull() | F.coalesce(F.col("latency_p99_ms") <= limit, F.lit(False))
    return summary.select("case", "correct", "latency_p99_ms", limit.alias("limit_ms"), (F.col("correct") & within).alias("passed"))


def storage_trend(samples: DataFrame, by: Sequence[str], window_us: int, width: int) -> DataFrame:
    """Queue storage over a run: rotations seen, extremes, and exact medians of the first and last window.

    ``samples(by, at_us, rotation_us, bytes)``. The medians come from counted values, not one sort.
    """
    ends = samples.groupBy(*by).agg(
        F.min("at_us").alias("_from"),
        F.max("at_us").alias("_to"),
        F.countDistinct("rotation_us").alias("rotations"),
        F.min("bytes").alias("min_bytes"),
        F.max("bytes").alias("max_bytes"),
    )
    placed = samples.join(ends, list(by))
    early = F.col("at_us") < F.col("_from") + window_us
    late = F.col("at_us") > F.col("_to") - window_us
    halves = placed.select(
        *by, "bytes", F.explode(F.filter(F.array(F.when(early, F.lit("first")), F.when(late, F.lit("last"))), lambda w: w.isNotNull())).alias("_w")
    )
    ranks = nearest_ranks(halves, [*by, "_w"], "bytes", {"lower": (1, 2), "upper": (1, 2, "ceil")}, width)
    middle = (F.col("lower") + F.col("upper")) / 2
    medians = ranks.groupBy(*by).agg(
        F.max(F.when(F.col("_w") == "first", middle)).alias("first_median"),
        F.max(F.when(F.col("_w") == "last", middle)).alias("last_median"),
    )
    return ends.drop("_from", "_to").join(medians, list(by), "left")


def size_profile(rows: DataFrame, by: Sequence[str], raw: str, encoded: Column) -> DataFrame:
    """Bytes before and after encoding per group."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length(raw)).alias("raw_bytes"),
        F.sum(F.octet_length(encoded)).alias("encoded_bytes"),
        F.max(F.octet_length(raw)).alias("max_raw_bytes"),
    )


def top_statements(log: DataFrame, n: int = 20) -> DataFrame:
    """Heaviest statements by total time; ``log(query, calls, total_us)``."""
    return (
        log.groupBy("query")
        .agg(F.sum("calls").alias("calls"), F.sum("total_us").alias("total_us"), F.max("total_us").alias("max_us"))
        .orderBy(F.col("total_us").desc(), "query")
        .limit(n)
    )
