"""Hand-made trade tables."""

from __future__ import annotations

from decimal import Decimal

from tradelake import schema as S

NAMES = {1: ("AAA", "Aland"), 2: ("BBB", "Bland"), 3: ("CCC", "Cland"), 0: ("W00", "World")}


def row(reporter, partner, period, flow, commodity, value, **other):
    year = int(str(period)[:4])
    monthly = len(str(period)) == 6
    iso, name = NAMES.get(reporter, (None, None))
    partner_iso, partner_name = NAMES.get(partner, (None, None))
    base = {f.name: None for f in S.CANONICAL}
    base |= dict(
        type_code="C",
        frequency_code="M" if monthly else "A",
        classification_code="H6",
        edition="H6",
        ref_period_id=year * 10000 + 101,
        ref_year=year,
        ref_month=int(str(period)[4:]) if monthly else 52,
        period=str(period),
        reporter_code=reporter,
        reporter_iso3=iso,
        reporter_name=name,
        partner_code=partner,
        partner_iso3=partner_iso,
        partner_name=partner_name,
        flow_code=flow,
        commodity_code=commodity,
        customs_code="C00",
        mos_code="0",
        mot_code=0,
        quantity_qty_unit_code=-1,
        quantity_is_estimated=False,
        quantity_is_alt_qty_estimated=False,
        is_net_weight_estimated=False,
        is_gross_weight_estimated=False,
        trade_value_primary_value=None if value is None else Decimal(str(value)),
        legacy_estimation_flag=0,
        is_reported=False,
        is_aggregate=False,
    )
    unknown = set(other) - set(base)
    assert not unknown, unknown
    return base | other


def frame(spark, rows, numbered=True):
    """A canonical frame (value may be null here) with rows numbered in list order."""
    kind = S.T.StructType([S.T.StructField(f.name, f.dataType) for f in S.CANONICAL])
    kind = kind.add(S.SEQ, S.T.LongType())
    data = [tuple({**r, S.SEQ: i}[f.name] for f in kind) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, kind)
    return df if numbered else df.drop(S.SEQ)


def records(df):
    return [r.asDict(recursive=True) for r in df.collect()]
