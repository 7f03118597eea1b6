"""Versioned datasets: updates that come into force in one step."""

from pathlib import Path

import pytest

from tests.rows import frame, row
from tradelake import schema as S
from tradelake.operators import update
from tradelake.plans import pipeline
from tradelake.sources import datasets, paths, registry, versions

OLD = ((2020, "27", 1, {}), (2020, "28", 2, {}), (2021, "27", 3, {}), (2022, "27", 4, {}))
BATCH = ((2020, "27", 10, {}), (2020, "27", 11, {}), (2023, "27", 12, {}))
#: A key whose row moves from 2021 to 2019, which leaves a folder empty.
MOVED = ((2021, "27", 30, {"ref_year": 2019}),)
BEFORE = [(2020, "27", 1), (2020, "28", 2), (2021, "27", 3), (2022, "27", 4)]
AFTER = [(2020, "27", 11), (2020, "28", 2), (2021, "27", 3), (2022, "27", 4), (2023, "27", 12)]


def small(spark, *rows):
    return frame(spark, [row(1, 2, y, "X", c, v, **o) for y, c, v, o in rows])


def values(df):
    return sorted((r["ref_year"], r["commodity_code"], int(r[S.VALUE])) for r in df.collect())


def begun(spark, tmp_path, how="begun"):
    path = str(tmp_path / "stored")
    datasets.write_dataset(small(spark, *OLD), path, versioned=how == "begun")
    if how != "begun":
        datasets.take_over(spark, path)
    return path


@pytest.fixture
def stored(spark, tmp_path):
    return begun(spark, tmp_path)


@pytest.mark.parametrize("how", ["begun", "taken over"])
def test_merge(spark, tmp_path, how):
    stored = begun(spark, tmp_path, how)
    opened = datasets.open_dataset(spark, stored)
    done = update.update_dataset(small(spark, *BATCH), stored)
    assert values(datasets.open_dataset(spark, stored)) == AFTER
    assert (done.records_added, done.records_merged, done.duplicates_in_input) == (2, 1, 1)
    # who was reading goes on with the rows of that time, and they can be asked for
    assert values(opened) == values(datasets.open_dataset(spark, stored, 1)) == BEFORE
    part = datasets.load_partition(datasets.open_dataset(spark, stored), (1, 2023, "A"))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and values(part) == [(2023, "27", 12)]


def test_append_and_a_folder_left_empty(spark, stored):
    update.update_dataset(small(spark, *BATCH), stored, mode="append", duplicates="keep_first")
    assert values(datasets.open_dataset(spark, stored)) == sorted([*BEFORE, (2020, "27", 10), (2023, "27", 12)])
    numbers = [r[S.SEQ] for r in datasets.open_dataset(spark, stored).collect()]
    assert len(set(numbers)) == 6
    update.update_dataset(small(spark, *MOVED), stored)
    years = [r[0] for r in values(datasets.open_dataset(spark, stored))]
    assert years == [2019, 2020, 2020, 2020, 2022, 2023]
    assert versions.listed(spark, stored).filter("ref_year = 2021").isEmpty()


STEPS = {
    "the rows are aside": (datasets, "write_version"),
    "the set is written": (versions, "commit"),
    "the list is written": (versions, "move_new"),
    "put in force": (registry, "register"),
}


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_updates_that_break_off(spark, stored, monkeypatch, mode):
    """Whatever step an update stops after, readers see the old rows or the new ones."""

    def stop(*_, **__):
        raise OSError("gone")

    for step, where in STEPS.items():
        with monkeypatch.context() as broken:
            broken.setattr(*where, stop)
            with pytest.raises(OSError):
                update.update_dataset(
                    small(spark, *BATCH, *MOVED), stored, mode=mode, registry_path=f"{stored}-rows"
                )
        got = values(datasets.open_dataset(spark, stored))
        if step == "put in force":
            new = [(2019, "27", 30), (2020, "27", 11), (2023, "27", 12)]
            assert got == sorted(new + (BEFORE if mode == "append" else [BEFORE[1], BEFORE[3]])), step
        else:
            assert got == BEFORE and versions.newest(spark, stored) == 1, step


def test_the_first_write_can_be_made_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "new")
    with monkeypatch.context() as broken:
        broken.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            update.update_dataset(small(spark, *OLD), path)
    assert datasets.open_dataset(spark, path).isEmpty()
    update.update_dataset(small(spark, *OLD), path)
    assert values(datasets.open_dataset(spark, path)) == BEFORE


def test_of_two_updates_at_once_one_is_refused(spark, stored, monkeypatch):
    write = datasets.write_version

    def overtaken(*args, **kept):
        monkeypatch.setattr(datasets, "write_version", write)
        update.update_dataset(small(spark, (2024, "27", 9, {})), stored)
        return write(*args, **kept)

    monkeypatch.setattr(datasets, "write_version", overtaken)
    with pytest.raises(versions.ConflictError):
        update.update_dataset(small(spark, *BATCH), stored)
    assert values(datasets.open_dataset(spark, stored)) == [*BEFORE, (2024, "27", 9)]
    assert not list((Path(stored) / versions.LISTS).glob(".new-*"))


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_formats(spark, tmp_path, fmt):
    path, rows = str(tmp_path / fmt), str(tmp_path / "rows")
    for given in (OLD, BATCH):
        update.update_dataset(small(spark, *given), path, fmt, registry_path=rows, name="d")
    assert versions.is_versioned(spark, path) and datasets.detect_format(spark, path) == fmt
    assert values(datasets.open_dataset(spark, path)) == AFTER
    assert [r.record_count for r in registry.history(spark, rows, "d").collect()] == [5, 4]


def test_writes_become_versions(spark, stored):
    datasets.write_dataset(small(spark, (2022, "28", 5, {})), stored, mode="overwrite", touched_only=True)
    assert values(datasets.open_dataset(spark, stored)) == [*BEFORE[:3], (2022, "28", 5)]
    # the new rows may come from the dataset itself
    kept = datasets.open_dataset(spark, stored).filter("ref_year = 2020")
    datasets.write_dataset(kept, stored, mode="overwrite")
    assert values(datasets.open_dataset(spark, stored)) == BEFORE[:2]
    datasets.write_dataset(kept.limit(0), stored, mode="overwrite")
    assert datasets.open_dataset(spark, stored).isEmpty() and datasets.stored_count(spark, stored, "parquet") == 0
    assert [values(datasets.open_dataset(spark, stored, n))[:1] for n in (1, 2, 3)] == [BEFORE[:1]] * 3
    for wrong in ({"mode": "append", "partition_by": ()}, {"versioned": True}):
        with pytest.raises(datasets.StorageError):
            datasets.write_dataset(kept, stored, **wrong)
    with pytest.raises(datasets.StorageError):
        datasets.take_over(spark, stored)
    with pytest.raises(ValueError, match="no version 9"):
        datasets.open_dataset(spark, stored, 9)


def test_cleaning(spark, stored):
    update.update_dataset(small(spark, *BATCH), stored)
    update.update_dataset(small(spark, (2020, "27", 13, {})), stored)
    assert versions.clean(spark, stored, keep=3, hours=0) == []
    assert versions.clean(spark, stored) == [] and versions.numbers(spark, stored) == [3]
    sets = len(list(Path(stored).glob("_set=*")))
    gone = versions.clean(spark, stored, hours=0)
    assert len(list(Path(stored).glob("_set=*"))) == sets - len(gone)
    assert [v for _, _, v in values(datasets.open_dataset(spark, stored))] == [13, 2, 3, 4, 12]
    with pytest.raises(ValueError):
        versions.clean(spark, stored, keep=0)


def test_an_ingest_adds_a_version(spark, tmp_path):
    from tests.test_ingest import with_

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(with_() + "\n")
    target = str(tmp_path / "out")
    datasets.write_dataset(small(spark, *OLD), target, versioned=True)
    done = pipeline.ingest(spark, str(tmp_path / "in"), target, layout="lines", mode="append")
    assert done.status == pipeline.SUCCESS, done.errors
    rows = datasets.open_dataset(spark, target)
    assert rows.count() == 5 == len({r[S.SEQ] for r in rows.collect()}) and versions.newest(spark, target) == 2


def test_moving_onto_what_is_there(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
    assert paths.move_new(spark, str(tmp_path / "a"), str(tmp_path / "b")) is False
    assert paths.move_new(spark, str(tmp_path / "a"), str(tmp_path / "c")) is True
    with pytest.raises(Exception):
        paths.move_new(spark, str(tmp_path / "a"), str(tmp_path / "d"))
