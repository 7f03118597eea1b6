"""One analysis run: a filter chain, any number of metrics and any number of aggregations."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.operators.metrics import Aggregation, Filter, Metric, apply_all
from tradelake.session import work_folder


@dataclass(frozen=True)
class AnalysisResult:
    """Results over rows that the run has aggregated and written.

    ``metrics`` is one wide row (a failed metric is null), ``counts`` the rows before and after
    the filters, ``problems`` one row per failed metric or aggregation, with a reason.
    """

    name: str
    metrics: DataFrame
    aggregations: dict[str, DataFrame]
    counts: DataFrame
    problems: DataFrame
    filtered: DataFrame = field(repr=False)

    def metric(self, name: str):
        if name not in self.metrics.columns:
            raise KeyError(f"no metric {name!r}; known: {self.metrics.columns}")
        return self.metrics.first()[name]

    def aggregation(self, name: str) -> DataFrame:
        if name not in self.aggregations:
            raise KeyError(f"no aggregation {name!r}; known: {sorted(self.aggregations)}")
        return self.aggregations[name]


@dataclass(frozen=True)
class Analysis:
    """What to compute.  Of two metrics (or aggregations) with one name the later is used."""

    name: str = "analysis"
    filters: tuple[Filter, ...] = ()
    metrics: tuple[Metric, ...] = ()
    aggregations: tuple[Aggregation, ...] = ()

    def with_filter(self, *filters: Filter) -> Analysis:
        return Analysis(
            self.name, (*self.filters, *filters), self.metrics, self.aggregations
        )

    def with_metric(self, *metrics: Metric) -> Analysis:
        return Analysis(self.name, self.filters, (*self.metrics, *metrics), self.aggregations)

    def with_aggregation(self, *aggregations: Aggregation) -> Analysis:
        return Analysis(
            self.name, self.filters, self.metrics, (*self.aggregations, *aggregations)
        )

    def run(self, df: DataFrame) -> AnalysisResult:
        """Reads the facts once for everything that can be merged, then leaves the rest lazy.

        Facts are aggregated to the union of all group and distinct columns, with the buffers of all
        metrics, and these rows are written to the shared work folder; metrics and aggregations are
        made from them.  Metrics without buffers (``Metric.custom``) read the facts together, in a
        pass of their own.  A metric whose expressions stop the job is found by running the given ones
        one by one, becomes a problem, and the rest returns.
        """
        filtered = apply_all(df, self.filters)
        metrics = list({m.name: m for m in self.metrics}.values())
        aggregations = list({a.name: a for a in self.aggregations}.values())
        reasons: dict[tuple[str, str], str] = {}
        few = _few(filtered, metrics, aggregations, reasons)
        full = _with_plain(filtered, few, metrics, reasons)
        aggregated, failures = {}, []
        for one in aggregations:
            rows, failed = _aggregated(filtered, few, one, reasons)
            aggregated[one.name] = rows
            failures.append(failed)
        return AnalysisResult(
            self.name,
            full.select(*[f"`{m.name}`" for m in metrics]),
            aggregated,
            self._counts(df),
            _problems(full, metrics, failures, reasons),
            filtered,
        )

    def _counts(self, df: DataFrame) -> DataFrame:
        """Rows before and after the filters, in one pass."""
        kept = F.lit(True)
        for one in self.filters:
            kept = kept & one.column(df)
        return df.agg(
            F.count(F.lit(1)).alias("record_count"), F.count_if(kept).alias("filtered_count")
        )


def metric_row(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """All metrics over a frame in one pass.

    Several distinct counts in one aggregation would copy every fact once for each.  Where all
    metrics can be merged, facts are therefore grouped by the counted columns first, and only the
    few rows left are copied.
    """
    if not metrics:
        return df.agg(F.count(F.lit(1)).alias("_n")).select()
    keys = list(dict.fromkeys(k for m in metrics for k in m.keys))
    if len(keys) > 1 and all(m.merge for m in metrics):
        buffers = dict(b for m in metrics for b in m.buffers) or {"_rows": lambda: F.count(F.lit(1))}
        few = df.groupBy(*keys).agg(*[build().alias(n) for n, build in buffers.items()])
        return few.agg(*[m.merged() for m in metrics])
    return df.agg(*[m.column() for m in metrics])


#: What a metric's own expressions may raise while a job is set up or runs.
ERRORS = (PySparkException, Py4JJavaError)


def _written(df: DataFrame) -> DataFrame:
    """``df`` in the shared work folder: worked out once, whatever is read from it."""
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/analysis-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _few(filtered: DataFrame, metrics, aggregations, reasons) -> DataFrame:
    """One row per combination of all group and distinct columns, with all buffers."""

    def made(skip: set) -> DataFrame:
        used = [m for m in metrics if ("metric", m.name) not in skip]
        grouped = [a for a in aggregations if ("aggregation", a.name) not in skip]
        merged = [m for m in (*used, *(a.metric for a in grouped)) if m.merge]
        groups = [k for a in grouped if a.metric.merge for k in a.group_by]
        keys = list(dict.fromkeys([*groups, *(k for m in merged for k in m.keys)]))
        buffers = {"_rows": lambda: F.count(F.lit(1))} | dict(b for m in merged for b in m.buffers)
        return _written(filtered.groupBy(*keys).agg(*[build().alias(n) for n, build in buffers.items()]))

    try:
        return made(set())
    except ERRORS:
        given = [(("metric", m.name), m) for m in metrics] + [(("aggregation", a.name), a.metric) for a in aggregations]
        for key, metric in given:
            if metric.given and metric.merge:
                _tried(lambda m=metric: filtered.agg(*[build().alias(n) for n, build in m.buffers]).collect(), key, reasons)
        if not reasons:
            raise
        return made(set(reasons))


def _tried(run, key, reasons):
    """The result, or None and a reason under ``key``."""
    try:
        return run()
    except ERRORS as problem:
        reasons[key] = str(problem).strip().splitlines()[0][:300]
        return None


def _with_plain(filtered: DataFrame, few: DataFrame, metrics, reasons) -> DataFrame:
    """One row of all metrics and, as ``_over_n``, whether the n-th lacks its value for an overflow."""
    plain = [m for m in metrics if not m.merge]
    values: dict[str, Column] = {}

    def read(some: Sequence[Metric]) -> dict[str, Column]:
        frame = filtered.agg(*[m.column() for m in some])
        row = frame.first()
        return {m.name: F.lit(row[i]).cast(frame.schema[i].dataType) for i, m in enumerate(some)}

    if plain:
        try:
            values = read(plain)
        except ERRORS:
            for m in plain:
                values |= _tried(lambda m=m: read([m]), ("metric", m.name), reasons) or {}
    made, over = [], []
    for n, m in enumerate(metrics):
        alive = m.merge and ("metric", m.name) not in reasons
        made.append(m.merged() if alive else values.get(m.name, F.lit(None).cast("double")).alias(m.name))
        over.append((m.overflown() if alive else F.lit(False)).alias(f"_over_{n}"))
    return few.agg(F.count(F.lit(1)).alias("_n"), *made, *over)


def _aggregated(filtered: DataFrame, few: DataFrame, one: Aggregation, reasons) -> tuple[DataFrame, DataFrame]:
    """An aggregation's rows, and its problem if it has one: a failed group fails it as a whole."""
    key = ("aggregation", one.name)
    rows = None
    if not one.metric.merge:
        rows = _tried(lambda: _written(one.apply(filtered)), key, reasons)
    elif key not in reasons:
        rows = few.groupBy(*one.group_by).agg(
            one.metric.merge().alias("metric_value"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("record_count")
        )
        rows = rows if one.group_by else rows.filter(F.col("record_count") > 0)
        rows = rows.select(*one.group_by, F.lit(one.metric.name).alias("metric_name"), "metric_value", "record_count")
    columns = [F.lit(x).alias(n) for n, x in (("level", "error"), ("kind", "aggregation"), ("name", one.name))]
    if rows is None:
        nothing = [F.lit(None).cast("double").alias("metric_value"), F.lit(0).cast("long").alias("record_count")]
        rows = filtered.select(*one.group_by, F.lit(one.metric.name).alias("metric_name"), *nothing).filter("false")
        alone = filtered.sparkSession.range(1)
        return rows, alone.select(*columns, F.lit(reasons[key]).alias("reason"))
    bad = rows.agg(F.count_if(F.col("metric_value").isNull()).alias("failed"))
    failed = bad.filter(F.col("failed") > 0).select(*columns, F.lit("a group has no value").alias("reason"))
    return rows.filter(bad.scalar() == 0), failed


def _problems(full: DataFrame, metrics: Sequence[Metric], failures, reasons) -> DataFrame:
    """``level, kind, name, reason`` of metrics without a value and of failed aggregations."""
    kind = "array<struct<level:string,kind:string,name:string,reason:string>>"
    found = [
        F.when(
            F.col(f"`{m.name}`").isNull(),
            F.struct(
                F.lit("warning").alias("level"),
                F.lit("metric").alias("kind"),
                F.lit(m.name).alias("name"),
                F.when(F.lit(("metric", m.name) in reasons), F.lit(reasons.get(("metric", m.name))))
                .when(F.col(f"_over_{n}"), "a sum does not fit")
                .otherwise("no value")
                .alias("reason"),
            ),
        )
        for n, m in enumerate(metrics)
    ]
    listed = F.array_compact(F.array(*found)) if found else F.array().cast(kind)
    out = full.select(F.explode(listed).alias("p")).select("p.level", "p.kind", "p.name", "p.reason")
    for frame in failures:
        out = out.unionByName(frame)
    return out
