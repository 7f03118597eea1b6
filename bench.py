"""Headline timings.  Prints one JSON line.

The trade table is built from the star-schema tables at ``$BENCH_SF_DIR`` and stored once, as an
ingest would leave it; the reports then run on the stored dataset, and each write format and the
record parser are timed on the same rows.  Every entry is the median of the timed runs after one
warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tradelake.operators import (  # noqa: E402
    balance,
    commodity,
    compare,
    country,
    ingest,
    partner,
    quality,
    timeseries,
    update,
)
from tradelake.operators.query import Query  # noqa: E402
from tradelake.plans import pipeline  # noqa: E402
from tradelake.schema import SEQ  # noqa: E402
from tradelake.session import local_session  # noqa: E402
from tradelake.sources import datasets, fixtures  # noqa: E402
from tradelake.sources.responses import read_lines  # noqa: E402

REPORTER = 15


def reports(t):
    """Name to a frame-making call, over the stored table."""
    codes = [15, 3, 8, 12, 20]
    return {
        "country_balance": lambda: balance.country_balance(t),
        "country_ranking_top10": lambda: country.country_ranking(t, limit=10),
        "country_trend": lambda: country.country_trend(t, REPORTER),
        "partner_trade_balance": lambda: balance.partner_trade_balance(t, reporter_code=REPORTER),
        "top_partners_top10": lambda: partner.top_partners(t, reporter_code=REPORTER, limit=10),
        "country_vs_country": lambda: compare.country_vs_country(
            t, reporter_codes=codes, breakdown_by="partner"
        ).rows,
        "query_filter": lambda: Query(t)
        .filter(reporter_code=REPORTER)
        .frame()
        .select("period", "partner_code", "trade_value_primary_value"),
        "query_group_by": lambda: Query(t).group_by("reporter_code").groups(),
        "summarize_by_reporter": lambda: Query(t)
        .group_by("reporter_code")
        .summarize("primary_value"),
        "commodity_balance": lambda: balance.commodity_balance(t),
        "sector_summaries": lambda: commodity.sector_summaries(t),
        "monthly_rolling_average": lambda: timeseries.rolling_average(
            timeseries.monthly_trend(t, reporter_code=REPORTER)
        ),
        "first_wins": lambda: quality.first_wins(t).agg(F.count(F.lit(1))),
    }


def timed(call, runs: int) -> float:
    call()
    spent = []
    for _ in range(runs):
        started = time.perf_counter()
        call()
        spent.append(time.perf_counter() - started)
    return statistics.median(spent)


def once(call):
    started = time.perf_counter()
    call()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    work = tempfile.mkdtemp(prefix="bench-")
    folders = {"spark.sql.warehouse.dir": f"{work}/warehouse", "spark.checkpoint.dir": f"{work}/shared"}
    spark = local_session(cores, **folders)

    stored = f"{work}/trade"
    fresh = iter(range(10**6))
    table = fixtures.full_table(spark, sf_dir)
    started = time.perf_counter()
    datasets.write_dataset(table, stored, partition_by=("reporter_code",))
    build = time.perf_counter() - started
    t = datasets.read_dataset(spark, stored)
    rows = t.count()

    queries = {}
    for name, make in reports(t).items():
        queries[name] = timed(lambda make=make: make().collect(), runs)

    def write(fmt):
        datasets.write_dataset(t, f"{work}/{fmt}-{next(fresh)}", fmt, partition_by=())

    for fmt in datasets.FORMATS:
        queries[f"write_{fmt}"] = timed(lambda fmt=fmt: write(fmt), 1)

    raw = f"{work}/raw"
    fixtures.raw_trade(spark, sf_dir).repartition(cores * 2).select("json").write.text(raw)

    def parse():
        parsed = ingest.parse_records(read_lines(spark, raw))
        kept = ingest.accepted(parsed).drop("_src_file", "_src_pos")
        kept.write.format("noop").mode("overwrite").save()

    queries["parse_records"] = timed(parse, 1)

    # the default layout, an update of it, and a whole ingest; timed once, as each leaves a dataset,
    # and not part of the headline
    layout = f"{work}/layout"
    headline = round(sum(queries.values()), 3)
    queries["write_parquet_layout"] = once(lambda: datasets.write_dataset(t, layout))
    batch = t.filter("ref_year >= 2000").withColumn(SEQ, F.col(SEQ) + 1)
    queries["update_merge"] = once(lambda: update.update_dataset(batch, layout))
    queries["ingest_lines"] = once(
        lambda: pipeline.ingest(spark, raw, f"{work}/ingested", layout="lines")
    )
    result = {
        "metric": "headline_total",
        "value": headline,
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "rows": rows,
        "rows_per_sec": {k: round(rows / v) for k, v in queries.items()},
        "build_store_sec": round(build, 3),
        "cores": cores,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
