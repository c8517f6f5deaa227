"""Queries over a progress ledger derived from the events table.

Every event is a commit of one of fifty keys (event type, last digit of the user); totals run
over the key's events so far. It stands for the ledger of a long ingest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.text import strip
from textloom.operators import ledger as L
from textloom.operators.stats import running_totals
from textloom.plans.report import report_lines, report_table
from textloom.queries.base import query
from textloom.queries.sources import FILES, sql_size, text_files
from textloom.session import fresh_path
from textloom.sources.files import corrupt_checkpoints, inventory, scan_checkpoints
from textloom.sources.versions import read_current
from textloom.streaming.watch import ledger_stream, watch, watch_report

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _iso(column):
    return F.date_format(F.col(column).cast("timestamp"), _ISO)


def event_ledger(spark, sf):
    """One commit row per event with its key's running totals."""
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id",
        "ts",
        F.col("event_type").alias("dataset_name"),
        F.col("user_id"),
        F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")).alias("subset"),
        F.floor("value").cast("bigint").alias("whole"),
    )
    keys = ["dataset_name", "subset"]
    sums = {"samples": F.lit(1).cast("bigint"), "tokens": F.col("whole")}
    rows = running_totals(events, keys, "event_id", sums, {"first_ts": F.col("ts")})
    files = F.ceil(F.col("samples") / 100).cast("int")
    failed = (F.col("dataset_name") == "error") & (F.col("user_id") % 10 < 3)
    return rows.select(
        "dataset_name",
        "subset",
        F.lit("phase1").alias("phase"),
        F.col("samples").alias("total_samples_processed"),
        F.col("tokens").alias("total_tokens_processed"),
        files.alias("files_created"),
        (files - 1).alias("current_file_idx"),
        (F.col("samples") - (files - 1) * 100).cast("int").alias("samples_in_current_file"),
        ((F.col("user_id") % 2 == 0) & ~failed).alias("completed"),
        failed.alias("failed"),
        F.when(failed, F.concat(F.lit("value "), F.col("whole").cast("string"))).alias("error_message"),
        (F.col("user_id") % 4).cast("int").alias("retry_count"),
        _iso("first_ts").alias("started_at"),
        _iso("ts").alias("last_checkpoint_at"),
        F.col("event_id").alias("seq"),
        F.lit("commit").alias("op"),
    )


LEDGER = """base AS (SELECT *, event_type AS dataset_name, 'u' || (user_id % 10) AS subset,
    CAST(floor(value) AS BIGINT) AS whole, event_type = 'error' AND user_id % 10 < 3 AS failed FROM events),
run AS (SELECT *, count(*) OVER w AS samples, CAST(sum(whole) OVER w AS BIGINT) AS tokens,
    min(ts) OVER (PARTITION BY dataset_name, subset) AS first_ts FROM base
  WINDOW w AS (PARTITION BY dataset_name, subset ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
ledger AS (SELECT dataset_name, subset, 'phase1' AS phase, samples AS total_samples_processed,
    tokens AS total_tokens_processed, CAST(ceil(samples / 100.0) AS INTEGER) AS files_created,
    CAST(ceil(samples / 100.0) AS INTEGER) - 1 AS current_file_idx,
    CAST(samples - (CAST(ceil(samples / 100.0) AS INTEGER) - 1) * 100 AS INTEGER) AS samples_in_current_file,
    user_id % 2 = 0 AND NOT failed AS completed, failed,
    CASE WHEN failed THEN 'value ' || whole END AS error_message, CAST(user_id % 4 AS INTEGER) AS retry_count,
    strftime(first_ts, '%Y-%m-%dT%H:%M:%S.%f') AS started_at, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS last_checkpoint_at,
    event_id AS seq, 'commit' AS op FROM run),
latest AS (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY phase, dataset_name, subset ORDER BY seq DESC) = 1)"""

_STATUS = "CASE WHEN completed THEN 'Complete' WHEN failed THEN 'Failed' ELSE 'In Progress' END"
_FIELDS = ", ".join(f.name for f in L.RECORD_FIELDS)


def _state(spark, sf):
    return L.latest(event_ledger(spark, sf))


def _micros(a: str, b: str) -> str:
    return f"(epoch_us({b}::TIMESTAMP) - epoch_us({a}::TIMESTAMP))"


def _sql_duration(s: str) -> str:
    """Clock text of a non-negative number of whole seconds."""
    return (
        f"(CASE {s} // 86400 WHEN 0 THEN '' WHEN 1 THEN '1 day, ' ELSE ({s} // 86400) || ' days, ' END || "
        f"({s} % 86400) // 3600 || printf(':%02d:%02d', ({s} % 3600) // 60, {s} % 60))"
    )


@query("ledger_running", f"WITH {LEDGER} SELECT seq, dataset_name, subset, total_samples_processed, total_tokens_processed FROM ledger")
def ledger_running(spark, sf):
    return event_ledger(spark, sf).select(
        "seq", "dataset_name", "subset", "total_samples_processed", "total_tokens_processed"
    )


@query("ledger_latest", f"WITH {LEDGER} SELECT * FROM latest")
def ledger_latest(spark, sf):
    return _state(spark, sf)


_STATUS_LIST = f"""SELECT concat_ws('_', phase, dataset_name, subset) AS checkpoint_key, {_STATUS} AS status, dataset_name, subset,
  phase, total_samples_processed AS samples, total_tokens_processed AS tokens, files_created AS files, retry_count AS retries,
  started_at, last_checkpoint_at, error_message FROM latest ORDER BY checkpoint_key"""


@query("ledger_status", f"WITH {LEDGER} {_STATUS_LIST}")
def ledger_status(spark, sf):
    return L.status_list(_state(spark, sf))


_SUMMARY = f"""t AS (SELECT count(*) AS total_datasets, count(*) FILTER (completed) AS completed, count(*) FILTER (failed) AS failed,
  CAST(sum(total_samples_processed) AS BIGINT) AS total_samples, CAST(sum(total_tokens_processed) AS BIGINT) AS total_tokens,
  CAST(sum({_micros('started_at', 'last_checkpoint_at')}) AS BIGINT) / 1e6::DOUBLE AS total_time FROM latest),
summary AS (SELECT total_datasets, completed, failed, total_datasets - completed - failed AS in_progress, total_samples, total_tokens,
  total_time, CASE WHEN total_time > 0 THEN total_samples::DOUBLE / total_time ELSE 0.0 END AS samples_per_sec,
  CASE WHEN total_time > 0 THEN total_tokens::DOUBLE / total_time ELSE 0.0 END AS tokens_per_sec,
  {_sql_duration('CAST(trunc(total_time) AS BIGINT)')} AS processing_time FROM t)"""


@query("ledger_summary", f"WITH {LEDGER}, {_SUMMARY} SELECT * FROM summary")
def ledger_summary(spark, sf):
    return L.summary(_state(spark, sf))


@query(
    "ledger_duration",
    f"""WITH {LEDGER}, d AS (SELECT phase, dataset_name, subset, {_micros('started_at', 'last_checkpoint_at')} / 1e6::DOUBLE AS seconds FROM latest)
SELECT phase, dataset_name, subset, seconds, {_sql_duration('CAST(trunc(seconds) AS BIGINT)')} AS duration FROM d""",
)
def ledger_duration(spark, sf):
    return L.durations(_state(spark, sf))


# The time of the report: an hour after the end of the events' month.
_AS_OF = "2024-02-01 01:00:00"


def _as_of():
    return F.to_timestamp(F.lit(_AS_OF))


_IN_PROGRESS = f"""SELECT dataset_name, subset, total_samples_processed AS samples, total_tokens_processed AS tokens,
  files_created AS files, {_sql_duration(f"CAST(trunc({_micros('started_at', repr(_AS_OF))} / 1e6::DOUBLE) AS BIGINT)")} AS elapsed
  FROM latest WHERE NOT completed AND NOT failed"""


@query("ledger_in_progress", f"WITH {LEDGER} {_IN_PROGRESS}")
def ledger_in_progress(spark, sf):
    return L.in_progress(_state(spark, sf), _as_of())


_FAILED = "SELECT dataset_name, subset, error_message AS error, retry_count AS retries, 3 AS max_retries FROM latest WHERE failed"


@query("ledger_failed", f"WITH {LEDGER} {_FAILED}")
def ledger_failed(spark, sf):
    return L.failures(_state(spark, sf))


_NOW = "2024-02-01T00:00:00.000001"


@query(
    "ledger_reset",
    f"""WITH {LEDGER}, hit AS (SELECT *, dataset_name = 'click' AND subset = 'u2' AS h FROM latest)
SELECT dataset_name, subset, phase, CASE WHEN h THEN 0 ELSE total_samples_processed END AS total_samples_processed,
  CASE WHEN h THEN 0 ELSE total_tokens_processed END AS total_tokens_processed, CASE WHEN h THEN 0 ELSE files_created END AS files_created,
  CASE WHEN h THEN 0 ELSE current_file_idx END AS current_file_idx,
  CASE WHEN h THEN 0 ELSE samples_in_current_file END AS samples_in_current_file, completed AND NOT h AS completed,
  failed AND NOT h AS failed, CASE WHEN NOT h THEN error_message END AS error_message,
  CASE WHEN h THEN 0 ELSE retry_count END AS retry_count, CASE WHEN h THEN '{_NOW}' ELSE started_at END AS started_at,
  last_checkpoint_at, CASE WHEN h THEN seq + 1 ELSE seq END AS seq, CASE WHEN h THEN 'reset' ELSE op END AS op FROM hit""",
)
def ledger_reset(spark, sf):
    return L.latest(L.reset(event_ledger(spark, sf), "click", "u2", now=F.to_timestamp(F.lit(_NOW))))


@query("ledger_delete", f"WITH {LEDGER} SELECT * FROM latest WHERE NOT (dataset_name = 'view' AND subset = 'u3')")
def ledger_delete(spark, sf):
    return L.latest(L.delete(event_ledger(spark, sf), "view", "u3"))


@query(
    "ledger_clear_failed",
    f"WITH {LEDGER} SELECT * FROM latest WHERE NOT failed",
)
def ledger_clear_failed(spark, sf):
    return L.latest(L.clear_failed(event_ledger(spark, sf)))


@query(
    "resume_antijoin",
    f"""WITH {LEDGER}, work AS (SELECT DISTINCT 'phase1' AS phase, event_type AS dataset_name, 'u' || (user_id % 12) AS subset FROM events)
SELECT phase, dataset_name, subset FROM work w WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.completed
  AND l.phase = w.phase AND l.dataset_name = w.dataset_name AND l.subset = w.subset)""",
)
def resume_antijoin(spark, sf):
    work = spark.read.parquet(f"{sf}/events.parquet").select(
        F.lit("phase1").alias("phase"),
        F.col("event_type").alias("dataset_name"),
        F.concat(F.lit("u"), (F.col("user_id") % 12).cast("string")).alias("subset"),
    )
    return L.unfinished(work.distinct(), event_ledger(spark, sf))


def _write_checkpoints(state, path):
    """One JSON file per key, as an outside tool would leave them."""
    keyed = state.withColumn("checkpoint_key", L.checkpoint_key()).select(
        "checkpoint_key", *[f.name for f in L.RECORD_FIELDS]
    )
    keyed.repartition("checkpoint_key").write.partitionBy("checkpoint_key").option("ignoreNullFields", False).json(path)


@query("ledger_scan", f"WITH {LEDGER} SELECT {_FIELDS} FROM latest")
def ledger_scan(spark, sf):
    path = fresh_path(spark, "checkpoints")
    _write_checkpoints(_state(spark, sf), path)
    return scan_checkpoints(spark, path, recursive=True).drop("checkpoint_key")


_CUT_JSON = """'{"dataset_name": "' || dataset_name || '", "subset": "' || subset || '", "total_samples'"""


@query("ledger_corrupt", f"WITH {LEDGER} SELECT {_CUT_JSON} AS content FROM latest WHERE failed")
def ledger_corrupt(spark, sf):
    """Failed records are written cut off in the middle; only those files are reported."""
    path = fresh_path(spark, "corrupt")
    head = F.concat(
        F.lit('{"dataset_name": "'), "dataset_name", F.lit('", "subset": "'), "subset", F.lit('", "total_samples')
    )
    tail = F.concat(F.lit('_processed": '), F.col("total_samples_processed").cast("string"), F.lit("}"))
    content = F.when(F.col("failed"), head).otherwise(F.concat(head, tail))
    rows = _state(spark, sf).select(L.checkpoint_key().alias("checkpoint_key"), content.alias("content"))
    rows.repartition("checkpoint_key").write.partitionBy("checkpoint_key").text(path)
    corrupt = corrupt_checkpoints(spark, path, recursive=True, pattern="*.txt")
    return corrupt.select(strip(F.col("content")).alias("content"))


def _figures(section: str, table: str, numbers: tuple[str, ...], text: str) -> str:
    rows = [f"SELECT '{section}' AS section, '{n}' AS item, {n}::DOUBLE AS amount, NULL AS shown FROM {table}" for n in numbers]
    return " UNION ALL ".join([*rows, f"SELECT '{section}', '{text}', NULL, {text} FROM {table}"])


def _records(section: str, table: str, item: str, numbers: str, shown: str) -> str:
    return f"SELECT '{section}', {item}, dataset_name, subset, {numbers}, NULL, {shown} FROM {table}"


_TOTALS = ("total_datasets", "completed", "failed", "in_progress", "total_samples", "total_tokens", "total_time",
           "samples_per_sec", "tokens_per_sec")


def _report_sql(storage: bool) -> str:
    """The report as typed rows; ``storage`` adds the figures of the text files."""
    size = sql_size("CAST(total_bytes AS DOUBLE)")
    views = f"""{FILES}, stored AS (SELECT count(*) AS n_files, sum(length)::BIGINT AS total_bytes,
  CAST(sum(length) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_bytes FROM files),
sized AS (SELECT *, {size} AS total_size FROM stored), """ if storage else ""
    figures = _figures("summary", "summary", _TOTALS, "processing_time")
    if storage:
        figures += " UNION ALL " + _figures("storage", "sized", ("n_files", "total_bytes", "mean_bytes"), "total_size")
    counts = "samples::BIGINT, tokens::BIGINT, files::BIGINT"
    none = "NULL, NULL, NULL"
    return f"""WITH {views}{LEDGER}, {_SUMMARY}, active AS ({_IN_PROGRESS}), broken AS ({_FAILED}), listed AS ({_STATUS_LIST}),
figures AS ({figures})
SELECT section, item, NULL::VARCHAR AS dataset_name, NULL::VARCHAR AS subset, NULL::BIGINT AS samples, NULL::BIGINT AS tokens,
  NULL::BIGINT AS files, NULL::BIGINT AS retries, amount, shown FROM figures
UNION ALL {_records("in progress", "active", "NULL", f"{counts}, NULL", "elapsed")}
UNION ALL {_records("failed", "broken", "NULL", f"{none}, retries::BIGINT", "error")}
UNION ALL {_records("status", "listed", "checkpoint_key", f"{counts}, retries::BIGINT", "status")}"""


@query("progress_report", _report_sql(storage=True))
def progress_report_query(spark, sf):
    return report_table(_state(spark, sf), text_files(spark, sf), _as_of())


@query("report_stream", _report_sql(storage=False))
def report_stream(spark, sf):
    """The ledger arrives in four parts, not in the order of its numbers; the last refresh is the report."""
    path = fresh_path(spark, "ledger")
    rows = event_ledger(spark, sf)
    parts = rows.repartition(4, F.xxhash64("seq")).sortWithinPartitions(F.desc("seq"))
    parts.write.parquet(f"{path}/rows")
    stream = ledger_stream(spark, f"{path}/rows", files_per_batch=1)
    run = watch_report(stream, f"{path}/report", _as_of, seconds=None, checkpoint=f"{path}/checkpoint")
    run.awaitTermination()
    return read_current(spark, f"{path}/report")


@query(
    "progress_report_ledger",
    f"""WITH {LEDGER}, {_SUMMARY}, active AS ({_IN_PROGRESS}), broken AS ({_FAILED})
SELECT 'summary' AS section, 'total_datasets' AS item, CAST(total_datasets AS VARCHAR) AS value FROM summary
UNION ALL SELECT 'summary', 'completed', CAST(completed AS VARCHAR) FROM summary
UNION ALL SELECT 'summary', 'failed', CAST(failed AS VARCHAR) FROM summary
UNION ALL SELECT 'summary', 'in_progress', CAST(in_progress AS VARCHAR) FROM summary
UNION ALL SELECT 'summary', 'total_samples', CAST(total_samples AS VARCHAR) FROM summary
UNION ALL SELECT 'summary', 'total_tokens', CAST(total_tokens AS VARCHAR) FROM summary
UNION ALL SELECT 'summary', 'processing_time', processing_time FROM summary
UNION ALL SELECT 'in progress', dataset_name || ' (' || subset || ')',
  'Samples: ' || samples || ' | Tokens: ' || tokens || ' | Files: ' || files || ' | Elapsed: ' || elapsed FROM active
UNION ALL SELECT 'failed', dataset_name || ' (' || subset || ')', 'Error: ' || error || ' | Retries: ' || retries || '/3' FROM broken""",
)
def progress_report_ledger(spark, sf):
    """The report without file sizes and without speeds shown as text."""
    rows = report_lines(_state(spark, sf), inventory(spark, sf), _as_of())
    shown = ~F.col("item").isin("total_time", "samples_per_sec", "tokens_per_sec")
    return rows.where((F.col("section") != "storage") & shown)


@query(
    "ledger_stream",
    f"""WITH {LEDGER} SELECT {_STATUS} AS status, count(*) AS records, CAST(sum(total_samples_processed) AS BIGINT) AS samples,
  CAST(sum(total_tokens_processed) AS BIGINT) AS tokens FROM latest GROUP BY 1""",
)
def ledger_stream_query(spark, sf):
    path = fresh_path(spark, "ledger")
    event_ledger(spark, sf).write.parquet(f"{path}/rows")
    query_run = watch(ledger_stream(spark, f"{path}/rows"), f"{path}/status", seconds=None, checkpoint=f"{path}/checkpoint")
    query_run.awaitTermination()
    return read_current(spark, f"{path}/status")
