"""Linear pipelines: extract, validate, transform, store.

A stage takes a frame and returns one, so a pipeline is a single lazy plan until its sink runs.
Row counts are observed on the way, without jobs of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradelake.operators.flow_totals import check_choice
from tradelake.operators.ingest import REASON, accepted, parse_records, quarantined
from tradelake.operators.numbering import next_number, number_rows
from tradelake.operators.quality import dataset_warnings, first_wins, latest_wins
from tradelake.schema import COLUMNS, COMPOSITE_KEY, SEQ, reading_order
from tradelake.session import SPLIT, setting, shuffles_released, work_folder
from tradelake.sources import datasets, registry
from tradelake.sources.responses import read_lines, read_responses

SUCCESS, FAILED = "success", "failed"


@dataclass(frozen=True)
class Stage:
    """A named step ``DataFrame -> DataFrame``."""

    name: str
    run: Callable[[DataFrame], DataFrame]


@dataclass
class PipelineResult:
    status: str
    #: Row counts; None where the sink ran no action that would have counted.
    records_in: int | None = 0
    records_out: int | None = 0
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    failed_stage: str | None = None
    counts: dict[str, int | None] = field(default_factory=dict)
    #: What made the run fail.
    cause: Exception | None = None


class Pipeline:
    """Stages in order, then a sink action.  The first failure stops the run."""

    def __init__(self, name: str, stages: Sequence[Stage]):
        names = [s.name for s in stages]
        if not stages:
            raise ValueError("a pipeline needs at least one stage")
        if len(set(names)) != len(names):
            raise ValueError(f"stage names must differ; got {names}")
        self.name, self.stages = name, tuple(stages)

    def plan(self, source: DataFrame) -> DataFrame:
        """The whole pipeline as one lazy frame."""
        for stage in self.stages:
            source = source.transform(stage.run)
        return source

    def run(self, source: DataFrame, sink: Callable[[DataFrame], object]) -> PipelineResult:
        """Build the stages and run the sink once.

        Building fails for a stage that asks for something impossible; whatever only the data
        can break shows up at the sink.
        """
        count = F.count(F.lit(1)).alias("n")
        given, watched = Observation(f"{self.name}-in"), []
        df = source.observe(given, count)
        for stage in self.stages:
            try:
                df = df.transform(stage.run)
            except Exception as exc:
                return PipelineResult(
                    FAILED, errors=[f"{stage.name}: {exc}"], failed_stage=stage.name, cause=exc
                )
            seen = Observation(f"{self.name}-{stage.name}")
            df = df.observe(seen, count)
            watched.append((stage.name, seen))
        try:
            sink(df)
        except Exception as exc:
            return PipelineResult(FAILED, errors=[f"sink: {exc}"], failed_stage="sink", cause=exc)
        spark = source.sparkSession
        counts = {name: observed(spark, seen) for name, seen in watched}
        return PipelineResult(
            SUCCESS, observed(spark, given), counts[self.stages[-1].name], counts=counts
        )


def observed(spark: SparkSession, seen: Observation) -> int | None:
    """The row count an observation has taken, None if no action ran that would have fired it."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return seen.get["n"] if seen._jo.future().isCompleted() else None


def to_dataset(raw: DataFrame, *, order: Sequence[str] | None = None) -> DataFrame:
    """Raw records of one parse call to a clean table: good rows, first row per key."""
    return first_wins(accepted(parse_records(raw)), order=order)


def resolve(
    records: DataFrame, *, conflict: str = "latest", order: Sequence[str] | None = None
) -> DataFrame:
    """Clean records, possibly from several parse calls, to one table.

    ``latest`` keeps the newest revision of each key; ``first`` trusts the parse calls and
    changes nothing.
    """
    check_choice("conflict", conflict, ("latest", "first"))
    return latest_wins(records, order=order) if conflict == "latest" else records


#: Number of a parsed row, and the columns that decide which rows stay.
_ROW = "_parsed_row"
_DECIDING = (*COMPOSITE_KEY, "ref_period_id")

#: Bytes of input a parse task reads at most: parsing takes so long a byte that few large tasks end apart.
PARSE_SPLIT = 16 << 20


def _parse_split(spark: SparkSession) -> int:
    return min(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes(), PARSE_SPLIT)


def ingest(
    spark: SparkSession,
    source_paths: str | Sequence[str],
    target: str,
    *,
    name: str = "trade",
    layout: str = "responses",
    fmt: str = "parquet",
    mode: str = "error",
    conflict: str = "latest",
    quarantine_path: str | None = None,
    registry_path: str | None = None,
    compression: str | None = None,
) -> PipelineResult:
    """Read saved responses, keep clean rows, store them, and record what happened.

    Each file is one parse call: the first row of a key in it stays.  Between files ``conflict``
    decides: ``latest`` keeps a key's newest revision, ``first`` the row read first.  Rows are
    numbered in reading order, from where the numbers of a dataset that is appended to end.

    Parsed rows are written once to the shared work folder and read back, so the text is parsed a
    single time however many outputs are made of it, and a lost executor costs one stage at most.
    Which rows stay, and their numbers, are found on the few columns that decide it; whole rows are
    moved once, to meet their numbers.  Only rejected rows are kept with their record.  The shuffle
    files of each write go with it, the written tables once the dataset stands.
    """
    check_choice("layout", layout, ("responses", "lines"))
    check_choice("conflict", conflict, ("latest", "first"))
    reader = read_responses if layout == "responses" else read_lines
    work = f"{work_folder(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    parse_seen = Observation(f"{name}-parse")
    rows = F.count(F.lit(1))
    try:
        with shuffles_released(spark):
            with setting(spark, SPLIT, str(_parse_split(spark))):
                parsed = parse_records(reader(spark, source_paths)).observe(
                    parse_seen,
                    rows.alias("given"),
                    F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
                )
                # as a variant: made into text only where rejected rows are asked for
                parsed = parsed.withColumn("rec", F.when(F.col(REASON).isNotNull(), F.col("rec")))
                parsed.withColumn(_ROW, F.monotonically_increasing_id()).write.parquet(
                    f"{work}/parsed", compression="zstd"
                )
            stored = spark.read.parquet(f"{work}/parsed")
            good = stored.filter(F.col(REASON).isNull())
            narrow = good.select(*_DECIDING, *reading_order(good), _ROW)
            single = latest_wins(first_wins(narrow, within=("_src_file",))) if conflict == "latest" else first_wins(narrow)
            going_on = mode == "append" and datasets.path_exists(spark, target)
            start = next_number(datasets.stored_numbers(spark, target, fmt)) if going_on else 0
            single.write.parquet(f"{work}/single", compression="zstd")
            numbered = number_rows(spark.read.parquet(f"{work}/single"), f"{work}/clean", start)
            written = numbered.count()
            warnings = [
                f"{w['aspect']}: {w['found']}" for w in dataset_warnings(numbered).collect()
            ]
            clean = good.select(*COLUMNS, _ROW).join(numbered.select(_ROW, SEQ), _ROW).drop(_ROW)
            datasets.write_dataset(clean, target, fmt, mode=mode, compression=compression)
            if quarantine_path is not None:
                quarantined(stored).write.mode("append").parquet(quarantine_path)
            datasets.delete_path(spark, f"{work}/parsed")
            datasets.delete_path(spark, f"{work}/single")
    except Exception as exc:
        return PipelineResult(FAILED, errors=[str(exc)], failed_stage="ingest", cause=exc)
    finally:
        if datasets.path_exists(spark, work):
            datasets.delete_path(spark, work)
    given, rejected_count = parse_seen.get["given"], parse_seen.get["rejected"]
    if registry_path is not None:
        registry.register(
            spark,
            registry_path,
            dataset_name=name,
            record_count=written,
            destination=target,
            backend=fmt,
            skipped=given - written,
            source_count=given,
        )
    return PipelineResult(
        SUCCESS,
        given,
        written,
        warnings=warnings,
        counts={"rejected": rejected_count, "duplicates": given - rejected_count - written},
    )
