"""The ingest of a whole catalogue: its phases, datasets and subsets as streams and batches of one run.

A unit of work is a (phase, dataset, subset) of the catalogue. A streaming unit is a query with its own
checkpoint; a batch unit is written in two steps: first its data, then the ledger row that makes them
visible, so a run that stops between them does the unit again and nothing twice. Units that the ledger
calls completed are not started.

With an ``interval``, a batch has a ledger row every so many samples. Its raw texts are moved once to a
staged table in which every row has the exact number of its interval; then a step of intervals at a time
is encoded, written and committed. A run that stops goes on after the last step that was committed, from
the staged table, so the intervals of a batch stay what they were.

The stored ledger has a generation a key. A reset or a delete opens the next one: totals, quotas and
checkpoint start anew, and records of earlier generations are no longer read. Every row is a folder named
by its ``seq``, so a batch that is replayed writes the same row, and two writers cannot take one number.
One run at a time writes to an output.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.functions.text import long_enough
from textloom.functions.tokens import Codec
from textloom.operators.encoding import TOKENIZED_SCHEMA, encode_records
from textloom.operators.ledger import KEY, LEDGER_SCHEMA, MAX_RETRIES, latest, unfinished
from textloom.operators.quota import TEST_SAMPLES, take_with_room
from textloom.operators.slots import file_slots, place_of_row
from textloom.sources.catalog import ROW_GROUP_ROWS, catalog_subsets, marker_of
from textloom.sources.sinks import write_records
from textloom.streaming.ingest import SEQ_STEP, IngestOptions, _exists, stream_files

# Numbers of ledger rows that a generation of a key can use.
GENERATION = 1 << 40
STORED_SCHEMA = StructType(
    [
        *LEDGER_SCHEMA.fields,
        StructField("generation", LongType()),
        StructField("batch_id", LongType()),
        StructField("step", LongType()),
        StructField("unit", StringType()),
    ]
)
DATA_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        *(f for f in TOKENIZED_SCHEMA.fields if f.name != "dataset"),
        StructField("subset", StringType()),
        StructField("unit", StringType()),
        StructField("generation", LongType()),
        StructField("batch_id", LongType()),
        StructField("step", LongType()),
        StructField("phase", StringType()),
        StructField("dataset", StringType()),
    ]
)
STAGED_SCHEMA = "doc_id bigint, text string, language string, dataset string, phase string, subset string, slot int"


class IngestFailed(RuntimeError):
    """Units of a run failed; ``errors`` has them, and the ledger and the data lack what they hold."""

    def __init__(self, errors: Mapping[Unit, str]) -> None:
        self.errors = dict(errors)
        super().__init__("; ".join(f"{u.phase}/{u.dataset}/{u.subset}: {e}" for u, e in self.errors.items()))


@dataclass(frozen=True)
class Layout:
    """Where a dataset lies and what its columns mean. ``subset`` selects a subset's rows by its name."""

    path: str
    schema: str
    key: Column
    language: Column
    subset: Column | None = None


@dataclass(frozen=True)
class Unit:
    phase: str
    dataset: str
    subset: str | None
    streaming: bool
    text_field: str
    generation: int = 0

    @property
    def name(self) -> str:
        """A folder name for the key."""
        key = json.dumps([self.phase, self.dataset, self.subset])
        return "u" + hashlib.sha256(key.encode()).hexdigest()[:24]


def stored_ledger(spark: SparkSession, output: str) -> DataFrame:
    """All rows of the stored ledger."""
    path = f"{output}/ledger"
    if not _exists(spark, path):
        return spark.createDataFrame([], STORED_SCHEMA)
    return spark.read.schema(STORED_SCHEMA).parquet(path).select(*STORED_SCHEMA.fieldNames())


def newest(ledger: DataFrame) -> DataFrame:
    """The newest row of each key, deletes included."""
    row = F.max_by(F.struct(*ledger.columns), "seq").alias("row")
    return ledger.groupBy(F.struct(*KEY).alias("key")).agg(row).select("row.*")


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%f")


def _append_rows(spark: SparkSession, output: str, unit: Unit, rows: list[dict], replay: bool = False) -> None:
    """Write ledger rows into the folder of the first one's number; a number that is taken is an error
    unless the rows are a replay of themselves."""
    own = {"phase": unit.phase, "dataset_name": unit.dataset, "subset": unit.subset}
    own |= {"generation": unit.generation, "unit": unit.name, "last_checkpoint_at": _now()}
    values = [tuple((row | own).get(n) for n in STORED_SCHEMA.fieldNames()) for row in rows]
    path = f"{output}/ledger/unit={unit.name}/number={rows[0]['seq']}"
    mode = "overwrite" if replay else "errorifexists"
    spark.createDataFrame(values, STORED_SCHEMA).drop("unit").coalesce(1).write.mode(mode).parquet(path)


def _append(spark: SparkSession, output: str, unit: Unit, replay: bool = False, **values) -> None:
    """Write one ledger row."""
    _append_rows(spark, output, unit, [values], replay)


_START = {
    "total_samples_processed": 0,
    "total_tokens_processed": 0,
    "files_created": 0,
    "current_file_idx": 0,
    "samples_in_current_file": 0,
    "retry_count": 0,
    "completed": False,
    "failed": False,
}


def _rows_of(spark: SparkSession, output: str, unit: Unit) -> DataFrame:
    """Ledger rows of the unit's generation."""
    return stored_ledger(spark, output).where(
        (F.col("unit") == unit.name) & (F.col("generation") == unit.generation) & (F.col("op") != "delete")
    )


def _state(spark: SparkSession, output: str, unit: Unit, before: int | None = None) -> dict:
    """The newest row of the unit's generation (of those numbered below ``before``), or the start."""
    rows = _rows_of(spark, output, unit)
    if before is not None:
        rows = rows.where(F.col("seq") < before)
    found = newest(rows).first()
    if found is None:
        return {**_START, "seq": unit.generation * GENERATION, "started_at": None}
    return {n: found[n] for n in LEDGER_SCHEMA.fieldNames()}


def _first_number(spark: SparkSession, output: str, unit: Unit, batch_id: int) -> int:
    """The number of a batch's first commit: the one it had before, if it is a replay, else the next."""
    had = _rows_of(spark, output, unit).where(F.col("batch_id") == batch_id).agg(F.min("seq")).first()[0]
    return had if had is not None else (_state(spark, output, unit)["seq"] // SEQ_STEP + 1) * SEQ_STEP


def plan_units(
    spark: SparkSession, catalog: DataFrame, output: str, phases: list[str] | None = None
) -> list[Unit]:
    """The units that are not completed, in the catalogue's order of phase, dataset and subset.

    A catalogue has a row a subset, so what reaches the driver does not grow with the data.
    """
    work = catalog_subsets(catalog).withColumnRenamed("dataset", "dataset_name")
    if phases is not None:
        work = work.where(F.col("phase").isin(phases))
    ledger = stored_ledger(spark, output)
    generations = {tuple(r[k] for k in KEY): r["generation"] for r in newest(ledger).select(*KEY, "generation").collect()}
    rows = unfinished(work, ledger.select(*LEDGER_SCHEMA.fieldNames())).orderBy(*KEY).collect()
    return [
        Unit(r["phase"], r["dataset_name"], r["subset"], r["streaming"], r["text_field"], generations.get(tuple(r[k] for k in KEY), 0))
        for r in rows
    ]


def open_unit(
    spark: SparkSession, unit: Unit, layout: Layout, files_per_batch: int | None = None, places: bool = False
) -> DataFrame:
    """(doc_id, text, language, dataset, phase, subset) of a unit, as a stream or as a table; with
    ``places``, also ``_place``, which tells all of its rows apart."""
    if unit.streaming:
        rows = stream_files(spark, layout.path, layout.schema, files_per_batch)
    else:
        rows = spark.read.schema(layout.schema).parquet(layout.path)
    if unit.subset is not None and layout.subset is not None:
        rows = rows.where(layout.subset == unit.subset)
    return rows.select(
        layout.key.cast("bigint").alias("doc_id"),
        F.col(unit.text_field).alias("text"),
        layout.language.alias("language"),
        F.lit(unit.dataset).alias("dataset"),
        F.lit(unit.phase).alias("phase"),
        F.lit(unit.subset).cast("string").alias("subset"),
        *([place_of_row().alias("_place")] if places else []),
    )


def _encoded(rows: DataFrame, codec: Codec, options: IngestOptions, *keep: str) -> DataFrame:
    return encode_records(
        rows,
        codec,
        marker=marker_of(F.col("language")) if options.markers else None,
        keep=["doc_id", "phase", "subset", *keep],
        max_length=options.max_length,
        pad_to_max=options.pad_to_max,
    )


def _commits(state: dict, counts: Iterable[tuple[int, int, int]], number: int, **values) -> list[dict]:
    """Ledger rows with running totals, one for each (offset, samples, tokens)."""
    samples, tokens = state["total_samples_processed"], state["total_tokens_processed"]
    before, rows = samples, []
    for offset, n, added in counts:
        samples, tokens = samples + n, tokens + added
        row = {
            "total_samples_processed": samples,
            "total_tokens_processed": tokens,
            "files_created": state["files_created"] + 1,
            "current_file_idx": state["files_created"] + 1,
            "samples_in_current_file": samples - before,
            "completed": False,
            "failed": False,
            "started_at": state["started_at"] or _now(),
            "seq": number + offset * SEQ_STEP,
            "op": "commit",
        }
        rows.append(row | values)
    rows[-1]["samples_in_current_file"] = 0
    return rows


def write_unit(
    rows: DataFrame, unit: Unit, batch_id: int, codec: Codec, output: str, options: IngestOptions, retries: int, last: bool
) -> None:
    """Write a batch of a unit, then commit it. ``last`` marks the unit as completed in the same row.

    Raw texts are spread before they are encoded, so the shuffle moves no ids. A batch whose commits are
    all there is not done again; one that was staged goes on in steps whatever the options now are.
    """
    spark = rows.sparkSession
    place = f"unit={unit.name}/generation={unit.generation}/batch_id={batch_id}"
    staged = _exists(spark, f"{output}/staged/{place}/_SUCCESS")
    if not staged and not _rows_of(spark, output, unit).where(F.col("batch_id") == batch_id).isEmpty():
        return
    number = _first_number(spark, output, unit, batch_id)
    state = _state(spark, output, unit, number)
    rows = rows.where(long_enough(F.col("text"), options.min_chars))
    if options.max_samples is not None:
        left = max(0, options.max_samples - state["total_samples_processed"])
        room = spark.createDataFrame([(unit.phase, unit.dataset, left)], "phase string, dataset string, room bigint")
        rows = take_with_room(rows, room, ["phase", "dataset"])
    values = {"retry_count": retries, "batch_id": batch_id}
    if options.interval is not None or staged:
        _write_steps(rows, unit, f"{output}/staged/{place}", f"{output}/data/{place}", number, codec, output, options, last, values)
        return
    path = f"{output}/data/{place}/step=0"
    write_records(_encoded(rows.hint("rebalance"), codec, options), path, compact=False)
    written = spark.read.schema(DATA_SCHEMA).parquet(path)
    n, tokens = written.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    row = _commits(state, [(0, n, tokens)], number, **values)[0]
    _append(spark, output, unit, replay=True, **row | {"step": 0, "completed": last})


def _stage(rows: DataFrame, path: str, interval: int | None) -> DataFrame:
    """Raw texts with the number of their interval, moved once and kept until the batch is committed.

    All intervals but the last have ``interval`` rows. A file holds a row group of whole intervals, so a
    step reads no other's files. What an earlier try has staged is taken as it is.
    """
    spark = rows.sparkSession
    if not _exists(spark, f"{path}/_SUCCESS"):
        numbered, total = file_slots(rows, ["phase", "dataset"], "_place", interval)
        each = max(1, ROW_GROUP_ROWS // interval)
        files = max(1, -(-total // each))
        file = F.floor(F.col("slot") / each).cast("int")
        numbered.drop("_place").repartitionById(files, file).write.mode("overwrite").parquet(path)
    return spark.read.schema(STAGED_SCHEMA).parquet(path)


def _write_steps(
    rows: DataFrame,
    unit: Unit,
    staged_path: str,
    data_path: str,
    number: int,
    codec: Codec,
    output: str,
    options: IngestOptions,
    last: bool,
    values: dict,
) -> None:
    """Write and commit a batch in steps of ``step_intervals`` intervals, those committed before left out.

    What reaches the driver is the counts of a step's intervals.
    """
    spark, width = rows.sparkSession, options.step_intervals
    staged = _stage(rows, staged_path, options.interval)
    top = staged.agg(F.max("slot")).first()[0]
    mine = _rows_of(spark, output, unit).where(F.col("batch_id") == values["batch_id"])
    done = mine.agg(F.max((F.col("seq") - number) / SEQ_STEP).cast("int"), F.max("step")).first()
    first, step = (0, 0) if done[1] is None else (done[0] + 1, done[1] + 1)
    empty = top is None and not step
    while empty or (top is not None and first <= top):
        end = min(first + width - 1, top or 0)
        part = staged.where(F.col("slot").between(first, end))
        path = f"{data_path}/step={step}"
        write_records(_encoded(part, codec, options, "slot"), path, compact=False)
        written = spark.read.schema("slot int, length int").parquet(path)
        counts = written.groupBy("slot").agg(F.count(F.lit(1)), F.sum("length")).orderBy("slot").collect()
        state = _state(spark, output, unit, number + first * SEQ_STEP)
        commits = _commits(state, counts or [(0, 0, 0)], number, step=step, **values)
        commits[-1]["completed"] = last and end == (top or 0)
        _append_rows(spark, output, unit, commits, replay=True)
        first, step, empty = end + 1, step + 1, False
    _remove(spark, staged_path)


def _remove(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def _close(spark: SparkSession, output: str, unit: Unit, **values) -> None:
    state = _state(spark, output, unit)
    _append(spark, output, unit, **{**state, "started_at": state["started_at"] or _now(), "op": "commit", **values, "seq": state["seq"] + 1, "batch_id": -1})


def run_unit(
    spark: SparkSession, unit: Unit, layout: Layout, codec: Codec, output: str, options: IngestOptions, retries: int, files_per_batch: int | None
) -> None:
    rows = open_unit(spark, unit, layout, files_per_batch, options.interval is not None)
    if not unit.streaming:
        write_unit(rows, unit, 0, codec, output, options, 0, True)
        return
    for attempt in range(retries + 1):
        query = (
            rows.writeStream.foreachBatch(
                lambda batch, i, n=attempt: write_unit(batch, unit, i, codec, output, options, n, False)
            )
            .option("checkpointLocation", f"{output}/checkpoint/{unit.name}/{unit.generation}")
            .trigger(availableNow=True)
            .start()
        )
        try:
            query.awaitTermination()
            break
        except StreamingQueryException:
            if attempt == retries:
                raise
    if options.complete:
        _close(spark, output, unit, completed=True, failed=False, error_message=None)


def run_catalog(
    spark: SparkSession,
    catalog: DataFrame,
    layouts: Mapping[str, Layout],
    codec: Codec,
    output: str,
    options: IngestOptions | None = None,
    test: bool = False,
    max_units: int | None = None,
    retries: int = MAX_RETRIES,
    files_per_batch: int | None = None,
    strict: bool = False,
) -> dict[Unit, str]:
    """Ingest every unit of the catalogue that is not completed; returns the errors of those that failed.

    A unit that fails, or has no layout, is marked in the ledger and the others go on; the next run tries
    it again. ``test`` takes at most TEST_SAMPLES rows a unit; ``max_units`` ends the run after so many.
    With ``strict`` a run with failed units ends in IngestFailed once the others are done, so what it wrote
    cannot be taken for the whole.
    """
    options = options or IngestOptions(complete=True)
    if (options.interval is not None and options.interval < 1) or options.step_intervals < 1:
        raise ValueError("interval and step_intervals must be positive")
    if test:
        options = replace(options, max_samples=min(TEST_SAMPLES, options.max_samples or TEST_SAMPLES))
    errors: dict[Unit, str] = {}
    cause = None
    for unit in plan_units(spark, catalog, output, options.phases)[:max_units]:
        try:
            run_unit(spark, unit, layouts[unit.dataset], codec, output, options, retries, files_per_batch)
        except Exception as error:
            cause = cause or error
            errors[unit] = (str(error).splitlines() or [type(error).__name__])[0]
            _close(spark, output, unit, failed=True, error_message=errors[unit], retry_count=retries if unit.streaming else 0)
    if strict and errors:
        raise IngestFailed(errors) from cause
    return errors


def _turn(spark: SparkSession, output: str, key: tuple, op: str) -> int:
    """Open the next generation of a key with a reset or a delete; 0 if there is no such record."""
    phase, dataset, subset = key
    same = (F.col("phase") == phase) & (F.col("dataset_name") == dataset) & F.col("subset").eqNullSafe(F.lit(subset))
    found = newest(stored_ledger(spark, output).where(same)).where("op <> 'delete'").first()
    if found is None:
        return 0
    unit = Unit(phase, dataset, subset, False, "", found["generation"] + 1)
    _append(spark, output, unit, **_START, started_at=_now(), seq=unit.generation * GENERATION, op=op, batch_id=-1)
    return 1


def reset(spark: SparkSession, output: str, phase: str, dataset: str, subset: str | None = None) -> int:
    """Set a stored record back to its start: the next run does all of it again."""
    return _turn(spark, output, (phase, dataset, subset), "reset")


def delete(spark: SparkSession, output: str, phase: str, dataset: str, subset: str | None = None) -> int:
    """Take a record out of the stored ledger, and its data out of what is read."""
    return _turn(spark, output, (phase, dataset, subset), "delete")


def clear_failed(spark: SparkSession, output: str) -> int:
    """Delete every failed record; returns how many."""
    rows = stored_ledger(spark, output)
    failed = latest(rows.select(*LEDGER_SCHEMA.fieldNames())).where("failed").select(*KEY).collect()
    return sum(_turn(spark, output, tuple(r), "delete") for r in failed)


def read_ingested(spark: SparkSession, output: str) -> DataFrame:
    """Records of committed batches of each key's present generation."""
    ledger = stored_ledger(spark, output).fillna(0, "step")
    present = newest(ledger).where("op <> 'delete'").select("unit", "generation")
    batches = ledger.where("op = 'commit' AND batch_id >= 0").select("unit", "generation", "batch_id", "step")
    visible = batches.join(present, ["unit", "generation"], "left_semi")
    rows = spark.read.schema(DATA_SCHEMA).parquet(f"{output}/data").fillna(0, "step")
    return rows.join(visible, ["unit", "generation", "batch_id", "step"], "left_semi")
