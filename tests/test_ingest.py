"""Reading saved responses and judging their records."""

import json
import random
from decimal import Decimal as D

import pytest

from tests.rows import records
from tradelake import schema as S
from tradelake.operators.numbering import number_rows
from tradelake.operators import ingest, quality
from tradelake.sources import codelists
from tradelake.sources.responses import (
    read_envelopes,
    read_lines,
    read_responses,
    records_from_text,
)

GOOD = {
    "typeCode": "C", "freqCode": "A", "refPeriodId": 20220101, "refYear": 2022, "refMonth": 52,
    "period": "2022", "reporterCode": 699, "reporterISO": "IND", "reporterDesc": "India",
    "flowCode": "X", "flowDesc": "Export", "partnerCode": 0, "partnerISO": "W00",
    "partnerDesc": "World", "partner2Code": 0, "partner2ISO": "W00", "partner2Desc": "World",
    "classificationCode": "H6", "classificationSearchCode": "HS",
    "isOriginalClassification": True, "cmdCode": "TOTAL", "cmdDesc": "All", "customsCode": "C00",
    "customsDesc": "TOTAL CPC", "mosCode": "0", "motCode": 0, "motDesc": "TOTAL MOT",
    "qtyUnitCode": -1, "qtyUnitAbbr": "N/A", "qty": 0, "isQtyEstimated": False,
    "altQtyUnitCode": -1, "altQtyUnitAbbr": "N/A", "altQty": None, "isAltQtyEstimated": False,
    "netWgt": None, "isNetWgtEstimated": False, "grossWgt": 0.5, "isGrossWgtEstimated": False,
    "cifvalue": None, "fobvalue": 452684213646.743, "primaryValue": 452684213646.743,
    "legacyEstimationFlag": 0, "isReported": False, "isAggregate": True, "aggrLevel": 0,
    "isLeaf": False,
}


def judged(spark, *texts):
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_seq bigint, json string")
    parsed = ingest.parse_records(records_from_text(raw, "json", "_seq"))
    return sorted(records(parsed.drop("rec")), key=lambda r: r["_seq"])


def with_(**changes):
    record = {**GOOD, **changes}
    return json.dumps({k: v for k, v in record.items() if v is not ...})


def test_good_record(spark):
    (r,) = judged(spark, with_())
    assert r["_reject_reason"] is None
    assert r["trade_value_primary_value"] == D("452684213646.743")
    assert r["edition"] == "H6" and r["partner2_code"] is None and r["partner2_name"] is None
    assert r["gross_weight_kg"] == D("0.5") and r["quantity_qty_unit_code"] == -1
    assert r["is_aggregate"] is True and r["provenance"] is None
    assert set(S.COLUMNS) <= set(r)


REJECTED = [
    ("typeCode", "Z"), ("typeCode", ""), ("typeCode", ...), ("freqCode", "Q"),
    ("classificationCode", None), ("classificationSearchCode", "  "), ("refYear", 1899),
    ("refYear", 2101), ("refYear", "two"), ("refYear", True), ("refYear", "2022.5"),
    ("refMonth", 13), ("refMonth", 0), ("period", "20221"), ("period", "2022-1"),
    ("reporterCode", -1), ("reporterCode", None), ("reporterISO", "in1"), ("reporterISO", "IN"),
    ("reporterDesc", " "), ("partnerCode", "x"), ("partnerISO", "w00"),
    ("partner2Code", -2), ("partner2Code", True), ("flowCode", "DX"), ("cmdCode", "123"),
    ("cmdCode", "total"), ("customsCode", " "), ("mosCode", None), ("motCode", -1),
    ("motCode", ""), ("qtyUnitCode", None), ("qty", "a lot"), ("qty", -1), ("qty", True),
    ("altQtyUnitCode", "n/a"), ("netWgt", "NaN"), ("primaryValue", None), ("primaryValue", -0.01),
    ("primaryValue", ""), ("primaryValue", "Infinity"), ("fobvalue", -5), ("refPeriodId", -1),
    ("isReported", 1), ("isReported", "yes"), ("isAggregate", 0), ("legacyEstimationFlag", -1),
    ("legacyEstimationFlag", "a"), ("isOriginalClassification", "maybe"),
]


def test_bad_values_are_rejected_with_their_field(spark):
    rows = judged(spark, *[with_(**{k: v}) for k, v in REJECTED], "not json", "[1]")
    for (key, value), r in zip(REJECTED, rows):
        assert r["_reject_reason"], (key, value)
        assert r["_reject_reason"].startswith(f"{key}:"), (key, value, r["_reject_reason"])
    assert rows[-2]["_reject_reason"] == ingest.MALFORMED
    assert rows[-1]["_reject_reason"]


ACCEPTED = [
    ({"refYear": " 2021 "}, "ref_year", 2021),
    ({"refYear": 2021.9}, "ref_year", 2021),
    ({"motCode": "+5"}, "mot_code", 5),
    ({"refPeriodId": None}, "ref_period_id", None),
    ({"period": "202203", "refMonth": 3, "freqCode": "M"}, "period", "202203"),
    ({"cmdCode": 27}, "commodity_code", "27"),
    ({"cmdCode": "2709001000"}, "commodity_code", "2709001000"),
    ({"reporterISO": ""}, "reporter_iso3", None),
    ({"primaryValue": "12345.678901234567891"}, "trade_value_primary_value",
     D("12345.678901234567891")),
    ({"primaryValue": "1e3"}, "trade_value_primary_value", D("1000")),
    ({"primaryValue": -0.0}, "trade_value_primary_value", D(0)),
    ({"isReported": " TRUE "}, "is_reported", True),
    ({"isReported": None}, "is_reported", False),
    ({"isOriginalClassification": None}, "is_original_classification", None),
    ({"legacyEstimationFlag": None}, "legacy_estimation_flag", 0),
    ({"partner2Code": 0, "partner2ISO": "USA"}, "partner2_code", 0),
    ({"partner2Code": "0"}, "partner2_code", 0),
    ({"partner2Code": 0.4, "partner2ISO": ""}, "partner2_code", None),
    ({"partner2Code": 842, "partner2ISO": "USA"}, "partner2_iso3", "USA"),
    ({"partner2Code": None, "partner2ISO": "bad"}, "partner2_iso3", None),
]


def test_odd_values_that_are_fine(spark):
    rows = judged(spark, *[with_(**c) for c, _, _ in ACCEPTED])
    for (changes, column, want), r in zip(ACCEPTED, rows):
        assert r["_reject_reason"] is None, (changes, r["_reject_reason"])
        assert r[column] == want, changes


def test_digits_beyond_doubles_survive(spark):
    text = with_(primaryValue="@").replace('"@"', "12345678901234.123456789012345678")
    (r,) = judged(spark, text)
    assert r["trade_value_primary_value"] == D("12345678901234.123456789012345678")


@pytest.mark.parametrize("value", ["0.1234567890123456789", "1e-19", "12.5e-18", '"1.0000000000000000001"'])
def test_amounts_finer_than_the_column_are_rejected(spark, value):
    (r,) = judged(spark, with_(qty="@").replace('"@"', value))
    assert r["_reject_reason"] == "qty: more than 18 decimals"


@pytest.mark.parametrize("value", ["0.1234567890123456780", "1e-18", "2500e-20", "1.5e3"])
def test_trailing_zeros_are_no_digits(spark, value):
    (r,) = judged(spark, with_(qty="@").replace('"@"', value))
    assert r["_reject_reason"] is None and r["quantity_qty"] == D(value)


def test_unknown_keys_become_provenance(spark):
    (r,) = judged(spark, with_(datasetCode=7, note={"a": [1, None]}))
    assert json.loads(r["provenance"]) == {"datasetCode": 7, "note": {"a": [1, None]}}


def test_envelopes_and_lists(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"count": 2, "error": "", "data": [GOOD, GOOD]}))
    (tmp_path / "a.json").write_text(json.dumps([{**GOOD, "reporterCode": 1}]))
    (tmp_path / "c d.json").write_text(json.dumps({"count": 0, "error": "none", "data": None}))
    (tmp_path / "e.json").write_text(json.dumps({"elapsed_seconds": 1.5}, indent=1))
    raw = read_responses(spark, str(tmp_path))
    good = ingest.accepted(ingest.parse_records(raw))
    for start in (0, 100):
        numbered = number_rows(good, f"{tmp_path}-numbered{start}", start)
        rows = sorted(records(numbered), key=lambda r: r["_seq"])
        assert [r["reporter_code"] for r in rows] == [1, 699, 699]
        assert [r["_seq"] - start for r in rows] == [0, 1, 2]
        assert [r["_src_pos"] for r in rows] == [0, 0, 1]
    kept = quality.first_wins(ingest.accepted(ingest.parse_records(raw)))
    assert kept.count() == 2
    heads = sorted(records(read_envelopes(spark, str(tmp_path))), key=lambda r: r["_src_file"])
    assert [h["record_count"] for h in heads] == [1, 2, 0, 0]
    assert heads[2]["error"] == "none" and heads[3]["elapsed_seconds"] == 1.5


@pytest.mark.parametrize("text", ['{"data": 5}', "{broken", '"text"'])
def test_responses_that_hold_no_list_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="list of records"):
        read_responses(spark, str(tmp_path)).collect()


def test_lines_keep_reading_order_over_splits(spark, tmp_path):
    rng = random.Random(3)
    for name in ("p", "q"):
        lines = [json.dumps({"n": i, "pad": "x" * rng.randint(0, 90)}) for i in range(4000)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n\nnot json\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = read_lines(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 10
        got = raw.selectExpr(
            "_src_file", "_src_pos", "try_variant_get(rec, '$.n', 'int') as n", "_text"
        )
        got = number_rows(got, f"{tmp_path}-numbered").orderBy("_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({r["_seq"] for r in got}) == len(got) == 8002
    assert [r["n"] for r in got] == [*range(4000), None] * 2
    assert [r["_seq"] for r in got] == list(range(8002))
    assert {r["_text"] for r in got if r["n"] is None} == {"not json"}
    assert got[0]["_src_file"].endswith("p.jsonl")


def test_a_response_may_be_larger_than_one_value(spark, tmp_path):
    """As many records as the service gives at once, which no single variant holds."""
    with open(tmp_path / "full.json", "w") as f:
        f.write('{"count": 250000, "data": [')
        f.write(",".join(with_(refMonth=1 + i % 12, pad="x" * 100) for i in range(250_000)))
        f.write("]}")
    raw = read_responses(spark, str(tmp_path))
    months = raw.selectExpr("try_variant_get(rec, '$.refMonth', 'int') as m").groupBy("m").count()
    assert sorted(r["count"] for r in months.collect())[0] >= 20_833
    assert read_envelopes(spark, str(tmp_path)).first()["record_count"] == 250_000


def test_revisions_and_scoped_duplicates(spark):
    from tests.rows import frame, row

    t = frame(
        spark,
        [
            row(1, 0, 2020, "X", "27", 1, ref_period_id=None),
            row(1, 0, 2020, "X", "27", 2, ref_period_id=5),
            row(1, 0, 2020, "X", "27", 3, ref_period_id=5, partner2_code=0),
            row(2, 0, 2020, "X", "27", 4, ref_period_id=None),
            row(1, 0, 2020, "X", "27", 5, ref_period_id=4),
            row(2, 0, 2020, "X", "27", 6, ref_period_id=0),
        ],
    )

    def values(df):
        return sorted(int(r["trade_value_primary_value"]) for r in df.collect())

    assert values(quality.first_wins(t)) == [1, 4]
    assert values(quality.last_wins(t)) == [5, 6]
    assert values(quality.latest_wins(t)) == [2, 4]
    assert values(quality.first_wins(t, within=("ref_period_id",))) == [1, 2, 4, 5, 6]
    ordered = quality.last_wins(t, keep_position=True).orderBy("_seq").collect()
    assert [(r["_seq"], int(r["trade_value_primary_value"])) for r in ordered] == [(0, 5), (3, 6)]
    assert [r["member_count"] for r in quality.duplicate_members(t).collect()].count(4) == 4
    assert quality.duplicate_keys(t, ("reporter_code", "mot_code")).count() == 2


def test_decreases_equal_a_plain_scan(spark):
    rng = random.Random(5)
    seen = sorted(rng.sample(range(1 << 45), 3000))
    values = [rng.choice([None, *range(50)]) for _ in seen]
    df = spark.createDataFrame(list(zip(seen, values)), "_seq bigint, v bigint")
    known = [v for v in values if v is not None]
    want = sum(a > b for a, b in zip(known, known[1:]))
    assert quality.count_decreases(df, "v").first()[0] == want
    assert quality.count_decreases(df.limit(0), "v").first()[0] == 0


def test_warnings_only_where_there_is_something(spark):
    from tests.rows import frame, row

    calm = frame(spark, [row(1, 0, 2020, "X", "27", 1), row(1, 0, 2021, "X", "27", 1)])
    assert records(quality.dataset_warnings(calm)) == []
    mixed = frame(spark, [row(10, 0, 2021, "X", "27", 1), row(9, 0, 2020, "M", "27", 1)])
    found = {w["aspect"]: (w["found"], w["members"]) for w in
             records(quality.dataset_warnings(mixed))}
    assert found == {
        "reporter_code": (2, "9, 10"),
        "flow_code": (2, "M, X"),
        "ref_period_id": (1, None),
    }


LISTS = {
    "references": [{"category": "a", "variable": "b", "description": "c", "fileuri": "d"},
                   {"category": "a", "variable": "b", "description": "again", "fileuri": "d"},
                   {"category": "a", "variable": "x", "description": "", "fileuri": "d"}],
    "frequencies": [{"id": "A", "text": "Annual"}, {"id": "Q", "text": "Quarterly"}],
    "flows": [{"id": "M", "text": "Import"}, {"id": "DX", "text": "Domestic"},
              {"id": "X", "text": None}],
    "transport_modes": [{"id": "0", "text": "TOTAL"}, {"id": 1000, "text": "Air"},
                        {"id": True, "text": "Odd"}, {"id": -1, "text": "Odd"}],
    "units": [{"qtyCode": -1, "qtyAbbr": "N/A", "qtyDescription": "none"},
              {"id": "8", "text": "kg", "qtyDescription": "Kilograms"}, {"qtyCode": 9}],
    "data_items": [{"dataItem": "period", "description": "Time"}, {"dataItem": " "}],
    "partners": [{"PartnerCode": 842, "PartnerCodeIsoAlpha2": "us", "PartnerCodeIsoAlpha3": "USA",
                  "PartnerDesc": "USA", "entryEffectiveDate": "1981-01-01T00:00:00"},
                 {"id": 4, "text": "Afghanistan", "PartnerCodeIsoAlpha2": ""}],
}


@pytest.mark.parametrize("name, kept", [
    ("references", 1), ("frequencies", 1), ("flows", 1), ("transport_modes", 2), ("units", 2),
    ("data_items", 1), ("partners", 2),
])
def test_code_lists(spark, tmp_path, name, kept):
    (tmp_path / "list.json").write_text(json.dumps(LISTS[name]))
    rows = codelists.read_code_list(spark, name, str(tmp_path / "list.json"))
    assert rows.count() == kept
    if name == "partners":
        one = codelists.by_code(rows, 842).first()
        assert one["iso_alpha2"] == "US" and str(one["entry_effective_date"]) == "1981-01-01"


def test_commodity_editions_and_lookups(spark, tmp_path):
    codes = [{"id": "27", "text": "27 - Mineral fuels"}, {"id": "2709", "text": ""},
             {"id": "270", "text": "no such level"}, {"id": "TOTAL", "text": "All"}]
    (tmp_path / "hs.json").write_text(json.dumps({"data": codes}))
    rows = codelists.read_code_list(spark, "hs", str(tmp_path), edition="H6").cache()
    assert {(r["commodity_code"], r["edition"]) for r in rows.collect()} == {
        ("27", "H6"), ("2709", "H6"), ("TOTAL", "H6")}
    assert [r["commodity_code"] for r in codelists.search_hs(rows, "FUEL").collect()] == ["27"]
    assert codelists.search(rows, "").count() == 0
    assert codelists.search(rows, "fuel", columns=["commodity_code"]).count() == 0
    assert codelists.by_name(rows, "all").count() == 1
    assert codelists.by_name(rows, "all", case_sensitive=True).count() == 0
    assert codelists.classifications(spark).count() == 4
    assert codelists.classification_editions(spark).count() == 7
    assert codelists.classification_editions(spark, "SITC").count() == 0
    with pytest.raises(KeyError):
        codelists.code_list("planets")


def test_ingest_keeps_one_working_table_and_no_text_of_good_records(spark, tmp_path, monkeypatch):
    from tradelake.plans import pipeline
    from tradelake.session import RELEASE
    from tradelake.sources import datasets

    (tmp_path / "in").mkdir()
    lines = [with_(), with_(refPeriodId=20220102), with_(flowCode="M"), with_(flowCode="DX"), "no json"]
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines))
    delete, seen, released = datasets.delete_path, [], []

    def watched(session, path):
        released.append(session.conf.get(RELEASE, None))
        if path.endswith("/parsed"):
            kept = session.read.parquet(path).select("rec", "_text", "_reject_reason").collect()
            seen.append(sorted(((r["rec"] is not None, r["_text"], r["_reject_reason"] is not None) for r in kept), key=str))
        elif path.endswith("/single"):
            seen.append(datasets.path_exists(session, path.removesuffix("single") + "parsed"))
        delete(session, path)

    monkeypatch.setattr(datasets, "delete_path", watched)
    done = pipeline.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), layout="lines")
    assert done.status == "success" and (done.records_in, done.records_out) == (5, 2)
    good, bad = (False, None, False), (True, None, True)
    assert seen[1] is False and [r for r in seen[0] if r[1] is None] == [good, good, good, bad]
    assert [r[1:] for r in seen[0] if r[1] is not None] == [("no json", True)]
    # shuffle files go with each write, and the session is as it was
    assert released[:2] == ["true", "true"] and spark.conf.get(RELEASE, None) != "true"
    target = str(tmp_path / "kept")
    pipeline.ingest(spark, str(tmp_path / "in"), target, layout="lines", quarantine_path=str(tmp_path / "bad"))
    records_kept = {r["record"][:8] for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert len(records_kept) == 2 and "no json" in records_kept


def test_ingest_decides_on_narrow_rows_of_small_splits(spark, tmp_path, monkeypatch):
    from tradelake.plans import pipeline
    from tradelake.session import SPLIT
    from tradelake.sources import datasets

    (tmp_path / "in").mkdir()
    old, new = with_(cmdCode="02", primaryValue=1.5), with_(cmdCode="02", primaryValue=2.5, refPeriodId=20220102)
    (tmp_path / "in" / "a.txt").write_text("\n".join([old, with_(cmdCode="0101"), with_(flowCode="DX"), "{"]))
    (tmp_path / "in" / "b.txt").write_text("\n".join([new, with_(cmdCode="0303"), with_(cmdCode="0101", primaryValue=9)]))
    read, number, splits, moved = pipeline.read_lines, pipeline.number_rows, [], []

    def reading(session, paths):
        splits.append(int(session.conf.get(SPLIT).rstrip("b")))
        return read(session, paths)

    def numbering(df, *args):
        moved.append(set(df.columns))
        return number(df, *args)

    monkeypatch.setattr(pipeline, "read_lines", reading)
    monkeypatch.setattr(pipeline, "number_rows", numbering)
    before = spark.conf.get(SPLIT)
    done = pipeline.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), layout="lines")
    assert done.status == "success" and done.counts == {"rejected": 2, "duplicates": 2}
    rows = datasets.open_dataset(spark, str(tmp_path / "out")).orderBy("_seq").collect()
    found = [(r["_seq"], r["commodity_code"], float(r["trade_value_primary_value"])) for r in rows]
    assert [f[:2] for f in found] == [(0, "0101"), (1, "02"), (2, "0303")] and found[1][2] == 2.5 and found[0][2] != 9
    # amounts and names stay where they are while rows are chosen and numbered
    assert not moved[0] & {"trade_value_primary_value", "quantity_qty", "reporter_name", "rec", "provenance"}
    assert splits == [pipeline.PARSE_SPLIT] and spark.conf.get(SPLIT) == before
