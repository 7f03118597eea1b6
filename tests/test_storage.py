"""Stored datasets: round trips, updates, pipelines."""

import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.rows import frame, records, row
from tests.test_ingest import with_
from tradelake import schema as S
from tradelake.operators import balance, coverage, update
from tradelake.plans import pipeline, reports
from tradelake.sources import codelists, datasets, registry


@pytest.fixture(scope="module")
def t(spark):
    rows = [
        row(1 + i % 5, 100 + i, 2020 + i % 2, "XM"[i % 2], "27", "12345.678901234",
            commodity_name=['plain', 'with "quotes", commas', "naïve — ñ", None][i % 4],
            provenance=json.dumps({"n": i}) if i % 3 else None,
            partner2_code=None if i % 2 else 7, quantity_qty=D(i))
        for i in range(40)
    ]
    return frame(spark, rows).cache()


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("fmt", datasets.FORMATS)
@pytest.mark.parametrize("folders", [S.PARTITION_COLUMNS, ()])
def test_round_trip(spark, t, tmp_path, fmt, folders):
    path = str(tmp_path / "d")
    datasets.write_dataset(t, path, fmt, partition_by=folders)
    back = datasets.open_dataset(spark, path)
    assert back.columns == t.columns
    same(back, t)
    (one,) = records(balance.global_balance(back))
    assert one["total_exports"] == 20 * D("12345.678901234")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_gzip_and_wrong_compression(spark, t, tmp_path, fmt):
    path = str(tmp_path / "d")
    datasets.write_dataset(t, path, fmt, compression="gzip")
    assert list((tmp_path / "d").rglob("*.gz"))
    same(datasets.open_dataset(spark, path), t)
    with pytest.raises(datasets.StorageError):
        datasets.write_dataset(t, str(tmp_path / "e"), fmt, compression="zip")


def test_json_documents(spark, t, tmp_path):
    rows = t.drop(S.SEQ).orderBy("partner_code").limit(4)
    text = "[" + ",".join(r.value for r in rows.select(F.to_json(F.struct("*")).alias("value"))
                          .collect()) + "]"
    (tmp_path / "bare.json").write_text(text)
    (tmp_path / "wrapped.json").write_text('{"schema_version":"1","count":4,"records":' + text + "}")
    (tmp_path / "wrapped.meta.json").write_text('{"dataset_name":"d"}')
    same(datasets.read_json_documents(spark, str(tmp_path)), rows.unionByName(rows))


def test_work_folder_is_the_one_the_session_names(spark):
    from tradelake.session import work_folder

    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_opening_single_files_and_nothing(spark, t, tmp_path):
    path = str(tmp_path / "d")
    datasets.write_dataset(t.coalesce(1), path, "csv", partition_by=())
    (part,) = (tmp_path / "d").glob("*.csv")
    same(datasets.open_dataset(spark, str(part)), t)
    (tmp_path / "x.xlsx").write_text("")
    for bad in ("x.xlsx", "none"):
        with pytest.raises(datasets.StorageError):
            datasets.open_dataset(spark, str(tmp_path / bad))
    with pytest.raises(datasets.StorageError):
        datasets.write_dataset(t, path, "xml")


def test_broken_csv_is_an_error(spark, t, tmp_path):
    datasets.write_dataset(t.limit(1), str(tmp_path / "d"), "csv", partition_by=())
    (part,) = (tmp_path / "d").glob("*.csv")
    text = part.read_text().replace("12345.678901234000000000", "12,345")
    for stale in (tmp_path / "d").glob(".*.crc"):
        stale.unlink()
    part.write_text(text)
    with pytest.raises(Exception):
        datasets.read_dataset(spark, str(tmp_path / "d"), "csv").collect()


def test_rows_are_sorted_as_text_inside_files(spark, tmp_path):
    rows = frame(spark, [row(1, p, 2020, "X", "27", 1) for p in (9, 10, 100, 2)])
    datasets.write_dataset(rows, str(tmp_path / "d"), partition_by=())
    stored = spark.read.parquet(str(tmp_path / "d")).collect()
    assert [r["partner_code"] for r in stored] == [10, 100, 2, 9]
    assert [r["partner_code"] for r in datasets.canonical_order(rows).collect()] == [10, 100, 2, 9]


def test_one_partition_reads_one_folder(spark, t, tmp_path):
    path = str(tmp_path / "d")
    datasets.write_dataset(t, path)
    part = datasets.load_partition(datasets.open_dataset(spark, path), (1, 2020, "A"), "slice")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reporter_code" in plan
    assert part.count() == spark.table("slice").count() == t.filter(
        "reporter_code = 1 and ref_year = 2020").count()
    with pytest.raises(datasets.StorageError):
        datasets.load_partition(t, (1, 2020))


def test_tables(spark, t):
    datasets.write_table(t, "trade_rows", overwrite=True)
    same(datasets.read_table(spark, "trade_rows"), t)
    datasets.write_table(t, "trade_rows")
    assert datasets.read_table(spark, "trade_rows").count() == 80
    datasets.write_table(t.limit(3), "trade_rows", overwrite=True)
    assert datasets.read_table(spark, "trade_rows").count() == 3
    with pytest.raises(datasets.StorageError):
        datasets.read_table(spark, "no_such_table")
    got = datasets.sql(t, "select flow_code, count(*) as n from trade group by 1 order by 1")
    assert [tuple(r) for r in got.collect()] == [("M", 20), ("X", 20)]


def test_overwriting_a_table_from_itself(spark, t):
    datasets.write_table(t, "own_rows", overwrite=True)
    datasets.write_table(datasets.read_table(spark, "own_rows").limit(7), "own_rows", overwrite=True)
    assert datasets.read_table(spark, "own_rows").count() == 7
    broken = t.withColumn("period", F.when(F.col("partner_code") > 0, F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        datasets.write_table(broken, "own_rows", overwrite=True)
    assert datasets.read_table(spark, "own_rows").count() == 7


def test_json_documents_open_by_path(spark, t, tmp_path):
    flat = t.drop(S.SEQ)
    rows = [json.loads(r) for r in flat.toJSON().collect()]
    for name, text in (
        ("wrapped", json.dumps({"schema_version": "1", "count": len(rows), "records": rows})),
        ("pretty", json.dumps({"records": rows}, indent=1)),
        ("bare", json.dumps(rows)),
        ("lines", "\n".join(json.dumps(r) for r in rows)),
    ):
        (tmp_path / name).mkdir()
        (tmp_path / name / "rows.json").write_text(text)
        same(datasets.open_dataset(spark, str(tmp_path / name)).drop(S.SEQ), flat)
    (tmp_path / "rows.json").write_text(json.dumps({"period": "2020"}))
    with pytest.raises(Exception, match="no value in required column"):
        datasets.open_dataset(spark, str(tmp_path / "rows.json")).collect()


def test_nested_view_and_back(t):
    flat = t.drop(S.SEQ)
    same(flat.select(*S.nested_record()).select(*S.flat_record()), flat)
    with pytest.raises(ValueError):
        S.as_canonical(flat.drop("period"))


def test_provenance_rows(spark, t, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.latest(spark, path, "d") is None
    for n in (40, 41):
        registry.register(spark, path, dataset_name="d", record_count=n, destination="x",
                          backend="parquet", skipped=2)
    newest = registry.latest(spark, path, "d").first()
    assert newest["record_count"] == 41 and newest["source_count"] == 41
    assert registry.history(spark, path).count() == 2
    assert registry.partition_keys(t).count() == 10
    assert registry.dataset_summary(t, parser_name="p").first()["record_count"] == 40
    fits = update.check_compatible(registry.latest(spark, path, "d"),
                                   schema_version=S.SCHEMA_VERSION, parser_name="other")
    assert fits[0] is False and "parser_name" in fits[1]
    assert update.check_compatible(None, schema_version="9", parser_name="x") == (True, "")


def small(spark, *rows):
    return frame(spark, [row(1, 2, y, "X", c, v, **o) for y, c, v, o in rows])


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "stored")
    old = small(spark, (2020, "27", 1, {}), (2020, "28", 2, {}), (2021, "27", 3, {}),
                (2022, "27", 4, {}))
    datasets.write_dataset(old, path)
    return path


def values(spark, path):
    df = datasets.open_dataset(spark, path)
    return sorted((r["ref_year"], r["commodity_code"], int(r[S.VALUE])) for r in df.collect())


BATCH = ((2020, "27", 10, {}), (2020, "27", 11, {}), (2023, "27", 12, {}))


@pytest.mark.parametrize("mode", ["merge", "replace"])
def test_merge(spark, stored, mode):
    done = update.update_dataset(small(spark, *BATCH), stored, mode=mode)
    want = [(2020, "27", 11), (2020, "28", 2), (2021, "27", 3), (2022, "27", 4), (2023, "27", 12)]
    assert values(spark, stored) == want
    assert (done.records_added, done.records_merged, done.duplicates_in_input) == (2, 1, 1)
    # The same update again changes nothing.
    again = update.update_dataset(small(spark, *BATCH), stored, mode=mode)
    assert values(spark, stored) == want and again.records_merged == 2


def test_append_keeps_collisions(spark, stored):
    done = update.update_dataset(small(spark, *BATCH), stored, mode="append",
                                 duplicates="keep_first")
    assert values(spark, stored) == [(2020, "27", 1), (2020, "27", 10), (2020, "28", 2),
                                     (2021, "27", 3), (2022, "27", 4), (2023, "27", 12)]
    assert done.records_merged == 1


def test_merge_leaves_other_folders_alone(spark, stored):
    from pathlib import Path

    def files(year):
        folder = Path(stored) / f"reporter_code=1/ref_year={year}"
        return {p.name: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}

    before = files(2022)
    update.update_dataset(small(spark, *BATCH), stored)
    assert files(2022) == before


def test_an_update_lists_the_batch_folders_only(spark, stored, monkeypatch):
    read = []
    scan = datasets.read_dataset

    def watched(*a):
        read.append(scan(*a))
        return read[-1]

    monkeypatch.setattr(datasets, "read_dataset", watched)
    frames = []
    inside = update._in_folders
    monkeypatch.setattr(update, "_in_folders", lambda *a: frames.append(inside(*a)) or frames[-1])
    update.update_dataset(small(spark, (2020, "27", 11, {})), stored)
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in frames]
    assert len(plans) == 2 and "PartitionFilters: [" in plans[0] and "reporter_code" in plans[0]
    assert "ref_year" in plans[1].split("PartitionFilters: [")[1].split("]")[0]


def test_rows_added_later_are_numbered_later(spark, stored, tmp_path):
    path = str(tmp_path / "registry")
    update.update_dataset(small(spark, *BATCH), stored, mode="append", registry_path=path, name="d")
    numbers = [r[S.SEQ] for r in datasets.open_dataset(spark, stored).collect()]
    assert len(set(numbers)) == len(numbers) == 6
    kept = update.first_wins(datasets.open_dataset(spark, stored))
    assert (2020, "27", 1) in [(r["ref_year"], r["commodity_code"], int(r[S.VALUE])) for r in kept.collect()]
    newest = registry.latest(spark, path, "d").first()
    assert newest["record_count"] == 6 and newest["source_count"] == 3


def test_a_row_may_move_to_another_folder(spark, stored):
    from pathlib import Path

    moved = small(spark, (2021, "27", 30, {"ref_year": 2019}))
    update.update_dataset(moved, stored)
    assert values(spark, stored) == [(2019, "27", 30), (2020, "27", 1), (2020, "28", 2),
                                     (2022, "27", 4)]
    assert not (Path(stored) / "reporter_code=1/ref_year=2021/frequency_code=A").exists()


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_merge_into_text_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    update.update_dataset(small(spark, (2020, "27", 1, {}), (2021, "27", 2, {})), path, fmt)
    update.update_dataset(small(spark, (2020, "27", 5, {})), path, fmt)
    assert values(spark, path) == [(2020, "27", 5), (2021, "27", 2)]


def test_update_of_a_table(spark):
    spark.sql("drop table if exists kept_rows")
    update.update_table(small(spark, (2020, "27", 1, {}), (2021, "27", 2, {})), "kept_rows")
    done = update.update_table(small(spark, (2021, "27", 7, {}), (2024, "27", 9, {})), "kept_rows")
    got = datasets.read_table(spark, "kept_rows").orderBy("ref_year").collect()
    assert [int(r[S.VALUE]) for r in got] == [1, 7, 9] and done.records_merged == 1


def test_incompatible_batches_are_refused(spark, stored, tmp_path):
    path = str(tmp_path / "registry")
    registry.register(spark, path, dataset_name="d", record_count=1, destination=stored,
                      backend="parquet", parser_name="another")
    with pytest.raises(update.SchemaIncompatibleError):
        update.update_dataset(small(spark, *BATCH), stored,
                              latest_metadata=registry.latest(spark, path, "d"))
    with pytest.raises(ValueError):
        update.update_dataset(small(spark, *BATCH), stored, mode="upsert")


def test_ingest_to_store(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = json.loads(with_())
    other = json.loads(with_(reporterCode=1, reporterISO="AFG", extra=1))
    bad = json.loads(with_(flowCode="DX"))
    (source / "1.json").write_text(json.dumps({"data": [good, bad, good]}))
    (source / "2.json").write_text(json.dumps({"data": [other]}))
    target, reg = str(tmp_path / "out"), str(tmp_path / "reg")
    done = pipeline.ingest(spark, str(source), target, registry_path=reg,
                           quarantine_path=str(tmp_path / "bad"))
    assert done.status == pipeline.SUCCESS, done.errors
    assert (done.records_in, done.records_out) == (4, 2)
    assert done.counts == {"rejected": 1, "duplicates": 1}
    assert done.warnings == ["reporter_code: 2"]
    assert sorted(r[S.SEQ] for r in datasets.open_dataset(spark, target).collect()) == [0, 1]
    assert registry.latest(spark, reg, "trade").first()["skipped"] == 2
    (wrong,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert wrong["reason"].startswith("flowCode") and json.loads(wrong["record"])["flowCode"] == "DX"
    report = reports.stored_analysis(spark, target, reporter_code=699)
    assert report["summary"].first()["partner_count"] == 1
    failed = pipeline.ingest(spark, str(source), target)
    assert failed.status == pipeline.FAILED and failed.errors


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_ingest_of_lines(spark, tmp_path, fmt):
    lines = [with_(), with_(period="2021", refYear=2021), "", "{broken", with_(), "[]"]
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    done = pipeline.ingest(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"),
                           layout="lines", fmt=fmt, compression="gzip")
    assert (done.records_in, done.records_out) == (5, 2), done.errors
    assert done.counts == {"rejected": 2, "duplicates": 1}
    assert datasets.open_dataset(spark, str(tmp_path / "out")).count() == 2
    with pytest.raises(ValueError):
        pipeline.ingest(spark, "x", "y", layout="pages")


def test_overwrite_replaces_everything(spark, t, tmp_path):
    path = str(tmp_path / "d")
    datasets.write_dataset(t, path)
    datasets.write_dataset(t.filter("reporter_code = 1"), path, mode="overwrite")
    assert datasets.open_dataset(spark, path).count() == 8


def test_pipeline_stops_at_the_first_failure(t):
    got = []
    keep = pipeline.Stage("keep", lambda df: df.filter("flow_code = 'X'"))
    broken = pipeline.Stage("broken", lambda df: df.select("no_such_column"))
    done = pipeline.Pipeline("p", [keep]).run(t, lambda df: got.extend(df.collect()))
    assert (done.status, done.records_in, done.records_out) == ("success", 40, 20) and len(got) == 20
    failed = pipeline.Pipeline("p", [keep, broken]).run(t, lambda df: df.collect())
    assert failed.status == "failed" and failed.failed_stage == "broken"
    sunk = pipeline.Pipeline("p", [keep]).run(
        t.withColumn("period", F.raise_error(F.lit("late"))), lambda df: df.collect())
    assert sunk.failed_stage == "sink"
    with pytest.raises(ValueError):
        pipeline.Pipeline("p", [keep, keep])
    with pytest.raises(ValueError):
        pipeline.Pipeline("p", [])


def test_resolve(spark):
    rows = frame(spark, [row(1, 0, 2020, "X", "27", 1, ref_period_id=2),
                         row(1, 0, 2020, "X", "27", 2, ref_period_id=3)])
    assert [int(r[S.VALUE]) for r in pipeline.resolve(rows).collect()] == [2]
    assert pipeline.resolve(rows, conflict="first").count() == 2


def test_slices_check_their_arguments(t):
    for bad in (
        dict(reporter_code=-1, period="2020"), dict(reporter_code=1, period="20"),
        dict(reporter_code=1, period=""), dict(reporter_code=1, period="2020", flow_code="DX"),
        dict(reporter_code=1, period="2020", max_records=0),
        dict(reporter_code=1, period="2020", max_records=250_001),
        dict(reporter_code=1, period="2020", customs_code=" "),
    ):
        with pytest.raises(ValueError):
            coverage.Slice(**bad)
    with pytest.raises(TypeError):
        coverage.Slice(True, "2020")
    got = coverage.exports(t, 1, "2020, 2021", commodity_code="27", max_records=2)
    assert got.count() == 2
    assert [len(p) for p in coverage.pages([str(y) for y in range(1990, 2020)])] == [12, 12, 6]
    assert coverage.coverage_totals(
        coverage.grid_coverage(t, [1, 99], [2020], [100, 105])).first()["failed"] == 3


def test_revisions_over_files_and_ingests(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n, (period, value) in enumerate(((1, 10), (2, 20))):
        (source / f"{n}.json").write_text(json.dumps([json.loads(with_(refPeriodId=period, primaryValue=value))]))
    for conflict, want in (("latest", 20), ("first", 10)):
        target = str(tmp_path / conflict)
        for _ in range(2):
            done = pipeline.ingest(spark, str(source), target, conflict=conflict, mode="append")
            assert done.status == pipeline.SUCCESS, done.errors
        rows = datasets.open_dataset(spark, target).orderBy(S.SEQ).collect()
        assert [(r[S.SEQ], int(r[S.VALUE])) for r in rows] == [(0, want), (1, want)]
        assert update.first_wins(datasets.open_dataset(spark, target)).first()[S.SEQ] == 0
    with pytest.raises(ValueError):
        pipeline.ingest(spark, "x", "y", conflict="newest")


def test_malformed_lines_keep_their_text(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text(with_() + "\n{broken\n")
    pipeline.ingest(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"), layout="lines",
                    quarantine_path=str(tmp_path / "bad"))
    (wrong,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert (wrong["record"], wrong["reason"]) == ("{broken", "malformed")


def test_a_sink_without_an_action_does_not_hang(t):
    done = pipeline.Pipeline("p", [pipeline.Stage("keep", lambda df: df)]).run(t, lambda df: df)
    assert done.status == pipeline.SUCCESS and done.records_in is None and done.counts == {"keep": None}


def test_lists_by_table_name(spark):
    for name, known in codelists.TABLE_NAMES.items():
        edition = "HS2012" if name in codelists.OF_AN_EDITION else None
        assert codelists.code_list(name, edition=edition).name == known
    with pytest.raises(ValueError, match="edition"):
        codelists.code_list("R05")
    with pytest.raises(KeyError):
        codelists.code_list("R99")


def test_the_registry_is_the_gate(spark, stored, tmp_path):
    rows = str(tmp_path / "registry")
    batch = datasets.open_dataset(spark, stored).limit(2)
    update.update_dataset(batch, str(tmp_path / "new"), registry_path=rows, name="n")
    assert registry.latest(spark, rows, "n").first().record_count == update.reduce_batch(batch).count()
    with pytest.raises(update.SchemaIncompatibleError, match="schema_version"):
        update.update_dataset(batch, str(tmp_path / "new"), registry_path=rows, name="n", schema_version="9")
    update.update_dataset(batch, str(tmp_path / "new"), registry_path=rows, name="other", schema_version="9")


@pytest.mark.parametrize("fmt", datasets.FORMATS)
def test_stored_rows_are_written_where_they_lie(spark, t, tmp_path, fmt):
    first, again = str(tmp_path / "first"), str(tmp_path / "again")
    datasets.write_dataset(t, first)
    stored = datasets.open_dataset(spark, first)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    datasets.write_dataset(stored, again, fmt, laid_out=True)
    same(datasets.open_dataset(spark, again), t)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    rows = [
        [r["commodity_code"] + str(r[S.SEQ]) for r in datasets.load_partition(df, (1, 2020, "A")).collect()]
        for df in (stored, datasets.open_dataset(spark, again))
    ]
    assert rows[0] and rows[0] == rows[1]


def test_an_update_in_place_writes_its_rows_once(spark, stored, monkeypatch):
    from pathlib import Path

    held = []
    delete = datasets.delete_path

    def watched(spark, path):
        if "/update-" in path:
            held.extend(p.name for p in Path(path.removeprefix("file:")).iterdir())
        return delete(spark, path)

    monkeypatch.setattr(datasets, "delete_path", watched)
    update.update_dataset(small(spark, *BATCH), stored)
    assert {"batch", "folders"} <= set(held) and "rows" not in held


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    import time

    from tradelake.session import RELEASE

    def moved():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {str(files.apply(i).getName()) for i in range(files.size())}

    t = frame(spark, [row(1 + i % 3, 2, 2020, "M", f"{i:02}", i) for i in range(10, 60)])
    before, setting = moved(), spark.conf.get(RELEASE, None)
    datasets.write_dataset(t, str(tmp_path / "d"))
    for _ in range(20):
        if not {f for f in moved() - before if f.startswith("shuffle_")}:
            break
        time.sleep(0.5)
    assert not {f for f in moved() - before if f.startswith("shuffle_")}
    assert spark.conf.get(RELEASE, None) == setting
    assert datasets.open_dataset(spark, str(tmp_path / "d")).count() == 50
