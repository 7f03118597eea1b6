"""The registered queries as SQL over the test tables.

Amounts are cast to double at the very end, after exact sums; ratios divide two doubles made
from exact sums.  That is the comparison contract of ``__spark_entry__``.
"""

from __future__ import annotations

TRADE = """
trade as (
  select l_orderkey * 8 + l_linenumber as seq,
    'C' as type_code,
    case when l_linenumber % 3 = 0 then 'M' else 'A' end as frequency_code,
    'H6' as classification_code, 'H6' as edition,
    cast(case when l_linenumber % 3 = 0
      then year(l_shipdate) * 10000 + month(l_shipdate) * 100 + 1
      else year(l_shipdate) * 10000 + 101 end as bigint) as ref_period_id,
    cast(year(l_shipdate) as int) as ref_year,
    cast(case when l_linenumber % 3 = 0 then month(l_shipdate) else 52 end as int) as ref_month,
    case when l_linenumber % 3 = 0
      then cast(year(l_shipdate) * 100 + month(l_shipdate) as varchar)
      else cast(year(l_shipdate) as varchar) end as period,
    s_nationkey as reporter_code,
    'N' || chr(65 + cast(floor(s_nationkey / 5) as int)) || chr(65 + s_nationkey % 5)
      as reporter_iso3,
    rn.n_name as reporter_name,
    c_nationkey as partner_code,
    'N' || chr(65 + cast(floor(c_nationkey / 5) as int)) || chr(65 + c_nationkey % 5)
      as partner_iso3,
    pn.n_name as partner_name,
    cast(null as int) as partner2_code,
    case when l_returnflag = 'A' then 'X' when l_returnflag = 'R' then 'M'
      when l_linestatus = 'F' then 'RX' else 'RM' end as flow_code,
    case when p_partkey % 50 = 0 then 'TOTAL'
      when p_size % 5 = 0 then lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
      when p_size % 5 = 1 then lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
        || lpad(cast(p_partkey % 7 as varchar), 2, '0')
      else lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
        || lpad(cast(p_partkey % 7 as varchar), 2, '0') || '10' end as commodity_code,
    p_type as commodity_name, l_partkey as pk,
    'C00' as customs_code, '0' as mos_code,
    cast((l_linenumber % 4) * 1000 as int) as mot_code,
    cast(l_quantity as decimal(18,2)) as qty,
    cast(l_extendedprice as decimal(18,2)) as v,
    case when l_returnflag <> 'R' then cast(cast(l_extendedprice as decimal(18,2))
      * (1 - cast(l_discount as decimal(4,2))) as decimal(24,4)) end as fob,
    case when l_returnflag <> 'A' then cast(cast(l_extendedprice as decimal(18,2))
      * (1 + cast(l_tax as decimal(4,2))) as decimal(24,4)) end as cif
  from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join supplier on l_suppkey = s_suppkey
    join part on l_partkey = p_partkey
    join nation rn on s_nationkey = rn.n_nationkey
    join nation pn on c_nationkey = pn.n_nationkey
)"""

KEY = (
    "reporter_code, partner_code, period, flow_code, commodity_code, classification_code, "
    "edition, customs_code, mot_code, coalesce(partner2_code, 0)"
)


def q(body: str, *ctes: str) -> str:
    """A query over the trade table, with optional further table expressions."""
    return "with " + ",".join([TRADE, *ctes]) + "\n" + body


def dbl(expr: str, name: str) -> str:
    return f"cast({expr} as double) as {name}"


def big(expr: str, name: str) -> str:
    return f"cast({expr} as bigint) as {name}"


def div(a: str, b: str) -> str:
    """Ratio of two exact amounts as double, null for a zero denominator."""
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def flow_sum(flow: str, value: str = "v") -> str:
    return f"coalesce(sum(case when flow_code = '{flow}' then {value} end), 0)"


X, M = flow_sum("X"), flow_sum("M")


def four(total: str = "total_trade", x: str = "total_exports", m: str = "total_imports") -> str:
    return ", ".join(
        [
            dbl(X, x),
            dbl(M, m),
            dbl(f"{X} + {M}", total),
            dbl(f"{X} - {M}", "trade_balance"),
        ]
    )


def first(column: str, where: str = "") -> str:
    cond = f" filter (where {where})" if where else ""
    return f"first({column} order by seq, {column}){cond} as {column}"


COUNT = big("count(*)", "record_count")


def balance_by(key: str, labels: list[str], where: str = "true", tail: str = "") -> str:
    shown = ", ".join([key, *[first(c) for c in labels], four(), COUNT])
    return q(f"select {shown} from trade where {where} group by {key} {tail}")


REPORTER = ["reporter_iso3", "reporter_name"]
PARTNER = ["partner_iso3", "partner_name"]


def period_points(where: str) -> str:
    return q(
        f"""select ref_year as year, period, {dbl(f"{X} + {M}", "total_trade")},
        {dbl(X, "exports")}, {dbl(M, "imports")}, {COUNT}
        from trade where {where} group by ref_year, period"""
    )


def growth_rate(first_v: str, last_v: str, years: str) -> str:
    rate = f"pow({div(last_v, first_v)}, 1.0 / cast({years} as double)) - 1.0"
    return f"""case when {years} <= 0 then null when {first_v} = 0 and {last_v} = 0 then 0.0
      when {first_v} > 0 and {last_v} > 0 then {rate} end"""


def comparison(axis: str, values: list, dim: str, label: str, where: str, tail: str = "") -> str:
    """Sides of one axis against the first, with labels first seen anywhere."""

    def side(v):
        return f"{axis} = '{v}'" if isinstance(v, str) else f"{axis} = {v}"

    amount = [f"coalesce(sum(case when {side(v)} then v end), 0)" for v in values]
    shown = [dbl(amount[0], "value_0")]
    shown += [big(f"count(case when {side(v)} then v end)", f"record_count_{i}")
              for i, v in enumerate(values)]
    for i in range(1, len(values)):
        change = f"{amount[i]} - {amount[0]}"
        shown += [
            dbl(amount[i], f"value_{i}"),
            dbl(change, f"delta_{i}"),
            f"{div(f'({change})', amount[0])} * 100.0 as pct_change_{i}",
        ]
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    cells = f"""cells as (select cast({dim} as varchar) as dimension_key, {", ".join(shown)}
      from trade where {where} and {axis} in ({listed}) group by {dim})"""
    if label == "commodity":
        named = "first(commodity_name order by seq, commodity_name)"
    elif label == "partner":
        named = "first(partner_iso3 || ' — ' || partner_name order by seq, partner_iso3)"
    else:
        return q(f"select *, dimension_key as dimension_label from cells {tail}", cells)
    names = f"""names as (select cast({dim} as varchar) as dimension_key,
      {named} as dimension_label from trade group by {dim})"""
    return q(f"select cells.*, dimension_label from cells join names using (dimension_key) {tail}",
             cells, names)


def trend(where: str = "true", measure: str = "coalesce(sum(v), 0)") -> str:
    return f"""yearly as (select cast(substr(period, 1, 4) as int) as year, {measure} as value,
      count(*) as record_count from trade where {where} group by 1)"""


MONTHLY = """monthly as (select cast(substr(period, 1, 4) as int) as year,
  cast(substr(period, 5, 2) as int) as month, coalesce(sum(v), 0) as value,
  count(*) as record_count from trade where length(period) = 6 and reporter_code = 15
  group by 1, 2)"""

SECTIONS = """sections as (select * from (values
  (1, 'I', 'Live animals; animal products', 1, 5),
  (2, 'II', 'Vegetable products', 6, 14),
  (3, 'III', 'Animal or vegetable fats and oils', 15, 15),
  (4, 'IV', 'Prepared foodstuffs; beverages, spirits, vinegar; tobacco', 16, 24),
  (5, 'V', 'Mineral products', 25, 27),
  (6, 'VI', 'Products of the chemical or allied industries', 28, 38),
  (7, 'VII', 'Plastics and articles thereof; rubber and articles thereof', 39, 40),
  (8, 'VIII', 'Raw hides and skins, leather, furskins; saddlery', 41, 43),
  (9, 'IX', 'Wood; charcoal; cork; manufactures of straw', 44, 46),
  (10, 'X', 'Pulp; paper; paperboard', 47, 49),
  (11, 'XI', 'Textiles and textile articles', 50, 63),
  (12, 'XII', 'Footwear, headgear; umbrellas; feathers', 64, 67),
  (13, 'XIII', 'Articles of stone, plaster, cement; ceramic; glass', 68, 70),
  (14, 'XIV', 'Natural or cultured pearls; precious stones; metals', 71, 71),
  (15, 'XV', 'Base metals; articles of base metal', 72, 83),
  (16, 'XVI', 'Machinery and mechanical appliances; electrical equipment', 84, 85),
  (17, 'XVII', 'Vehicles, aircraft, vessels', 86, 89),
  (18, 'XVIII', 'Optical, photographic, cinematographic, measuring, medical instruments', 90, 92),
  (19, 'XIX', 'Arms and ammunition', 93, 93),
  (20, 'XX', 'Miscellaneous manufactured articles', 94, 96),
  (21, 'XXI', 'Works of art, collectors'' pieces, antiques', 97, 98),
  (22, '??', 'Unknown', null, null)) s(no, sector_id, sector_name, low, high))"""


def sectors(where: str = "true") -> str:
    chaptered = f"""chaptered as (select *, case when regexp_matches(commodity_code, '^[0-9][0-9]')
      then cast(substr(commodity_code, 1, 2) as int) end as chapter from trade where {where})"""
    placed = """placed as (select c.*, coalesce(s.sector_id, '??') as sid from chaptered c
      left join sections s on c.chapter between s.low and s.high)"""
    found = f"""found as (select sid, {X} as x, {M} as m, count(*) as n,
      string_agg(distinct cast(coalesce(chapter, 0) as varchar), ',' order by
        cast(coalesce(chapter, 0) as varchar)) as listed,
      list_sort(list(distinct coalesce(chapter, 0))) as chapters,
      count(distinct commodity_code) as codes from placed group by sid)"""
    return q(
        f"""select sector_id, sector_name, {dbl("coalesce(x, 0)", "total_exports")},
        {dbl("coalesce(m, 0)", "total_imports")}, {dbl("coalesce(x + m, 0)", "total_trade")},
        {dbl("coalesce(x - m, 0)", "trade_balance")}, {big("coalesce(n, 0)", "record_count")},
        coalesce(array_to_string(chapters, ','), '') as chapter_codes,
        {big("coalesce(codes, 0)", "hs_code_count")}
        from sections left join found on sid = sector_id""",
        SECTIONS,
        chaptered,
        placed,
        found,
    )


def partner_rows(where: str = "true") -> str:
    return f"""partners as (select partner_code, {", ".join(first(c) for c in PARTNER)},
      {X} as x, {M} as m, count(*) as n from trade where reporter_code = 15 and {where}
      group by partner_code)"""


METRICS = ", ".join(
    [
        big("count(*)", "count"),
        dbl("coalesce(sum(v), 0)", "sum_primary_value"),
        dbl("coalesce(sum(fob), 0)", "sum_fob_value"),
        dbl("coalesce(sum(cif), 0)", "sum_cif_value"),
        dbl("coalesce(sum(qty), 0)", "sum_quantity"),
        f"{div('sum(v)', 'count(v)')} as avg_primary_value",
        big("count(distinct reporter_code)", "distinct_reporters"),
        big("count(distinct partner_code)", "distinct_partners"),
        big("count(distinct commodity_code)", "distinct_commodities"),
        "min(ref_year) as min_year",
        "max(ref_year) as max_year",
    ]
)


def report_sql() -> dict[str, str]:
    out = {
        "country_balance": balance_by("reporter_code", REPORTER),
        "partner_trade_balance": balance_by("partner_code", PARTNER, "reporter_code = 15"),
        "commodity_balance": balance_by("commodity_code", ["commodity_name"]),
        "global_balance": q(f"select {four()}, {COUNT} from trade"),
        "total_imports": q(
            f"select {dbl('coalesce(sum(v), 0)', 'total_imports')} from trade "
            "where flow_code = 'M' and reporter_code = 15 and ref_year in (1996, 1998)"
        ),
        "total_exports": q(
            f"select {dbl('coalesce(sum(v), 0)', 'total_exports')} from trade "
            "where flow_code = 'X' and reporter_code = 15 and ref_year = 1997"
        ),
        "country_ranking": q(
            f"""select reporter_code, {", ".join(first(c) for c in REPORTER)},
            {four("total_trade_value")}, {big("count(v)", "record_count")}
            from trade group by reporter_code
            order by {X} + {M} desc, reporter_code limit 10"""
        ),
        "country_ranking_exports": q(
            f"""select reporter_code, {", ".join(first(c) for c in REPORTER)},
            {dbl(X, "total_exports")}, cast(0 as double) as total_imports,
            {dbl(X, "total_trade_value")}, {dbl(X, "trade_balance")},
            {big("count(case when flow_code = 'X' then v end)", "record_count")}
            from trade group by reporter_code having count(case when flow_code = 'X' then 1 end) > 0
            """
        ),
        "country_ranking_reexports": q(
            f"""select reporter_code, {", ".join(first(c) for c in REPORTER)},
            cast(0 as double) as total_exports, cast(0 as double) as total_imports,
            cast(0 as double) as total_trade_value, cast(0 as double) as trade_balance,
            {big("count(case when flow_code = 'RX' then v end)", "record_count")}
            from trade group by reporter_code having count(case when flow_code = 'RX' then 1 end) > 0
            """
        ),
        "country_summary": q(
            f"""select reporter_code, {", ".join(first(c) for c in REPORTER)}, {four()},
            {big("count(distinct partner_code)", "partner_count")}, {COUNT},
            min(ref_year) as first_year, max(ref_year) as last_year
            from trade where reporter_code = 15 group by reporter_code"""
        ),
        "country_trend": q(
            f"""select ref_year as year, {first("period")},
            {four("total_trade", "exports", "imports")}, {COUNT}
            from trade where reporter_code = 15 group by ref_year"""
        ),
        "country_trend_by_period": q(
            f"""select {first("ref_year").replace("as ref_year", "as year")}, period,
            {four("total_trade", "exports", "imports")}, {COUNT}
            from trade where reporter_code = 15 group by period"""
        ),
        "top_partners": q(
            f"""select partner_code, {", ".join(first(c, "flow_code = 'X'") for c in PARTNER)},
            {dbl(X, "total_exports")}, cast(0 as double) as total_imports,
            {dbl(X, "total_trade")}, {dbl(X, "trade_balance")},
            {big("count(case when flow_code = 'X' then 1 end)", "record_count")}
            from trade where reporter_code = 15 group by partner_code
            having count(case when flow_code = 'X' then 1 end) > 0
            order by {X} desc, partner_code limit 10"""
        ),
        "top_partners_reimports": q(
            f"""select partner_code, {", ".join(first(c, "flow_code = 'RM'") for c in PARTNER)},
            {four()}, {big("count(case when flow_code = 'RM' then 1 end)", "record_count")}
            from trade where reporter_code = 15 group by partner_code
            having count(case when flow_code = 'RM' then 1 end) > 0"""
        ),
        "partner_balance": q(
            f"""select partner_code, {", ".join(first(c) for c in PARTNER)}, {four()}, {COUNT}
            from trade where reporter_code = 15 group by partner_code
            order by abs({X} - {M}) desc, partner_code limit 12"""
        ),
        "partner_growth_points": period_points("reporter_code = 15 and partner_code = 7"),
        "bilateral_summary": q(
            f"""select 15 as reporter_code, 3 as partner_code,
            coalesce(first(partner_iso3 order by seq, partner_iso3) filter (where reporter_code = 15),
              first(partner_iso3 order by seq, partner_iso3)) as partner_iso3,
            coalesce(first(partner_name order by seq, partner_name) filter (where reporter_code = 15),
              first(partner_name order by seq, partner_name)) as partner_name,
            {dbl(flow_sum("X", "case when reporter_code = 15 then v end"),
                 "reporter_to_partner_exports")},
            {dbl(flow_sum("M", "case when reporter_code = 15 then v end"),
                 "reporter_to_partner_imports")},
            {dbl(flow_sum("X", "case when reporter_code = 3 then v end"),
                 "partner_to_reporter_exports")},
            {dbl(flow_sum("M", "case when reporter_code = 3 then v end"),
                 "partner_to_reporter_imports")},
            {dbl(X, "total_exports")}, {dbl(M, "total_imports")},
            {dbl(f"{X} + {M}", "total_trade")}, {COUNT},
            min(ref_year) as first_year, max(ref_year) as last_year
            from trade where (reporter_code = 15 and partner_code = 3)
              or (reporter_code = 3 and partner_code = 15) having count(*) > 0"""
        ),
        "top_hs_codes": q(
            f"""select commodity_code, {first("commodity_name")}, {four()}, {COUNT} from trade
            where reporter_code = 15 and regexp_matches(commodity_code, '^[0-9]{{4}}$')
            group by commodity_code order by {X} - {M}, commodity_code limit 25"""
        ),
        "commodity_ranking_share": q(
            f"""select commodity_code, {first("commodity_name")}, {four()}, {COUNT},
            {div(f"({X} + {M})", "(select sum(v) from trade where reporter_code = 15)")} as share
            from trade where reporter_code = 15 group by commodity_code
            order by {X} + {M} desc, commodity_code limit 20"""
        ),
        "ranked_commodities": q(
            f"""select row_number() over (order by x desc, commodity_code) as rank,
            commodity_code, commodity_name, {dbl("x", "export_value")},
            cast(0 as double) as import_value, {dbl("x", "total_trade")},
            {dbl("x", "trade_balance")}, {big("n", "record_count")} from ranked
            order by rank limit 10""",
            f"""ranked as (select commodity_code, {first("commodity_name")}, {X} as x,
            count(*) as n from trade where reporter_code = 15 and flow_code = 'X'
            and regexp_matches(commodity_code, '^[0-9]{{2}}$') group by commodity_code)""",
        ),
        "commodity_trend": period_points("commodity_code = 'TOTAL'"),
        "sector_summaries": sectors(),
        "sector_summaries_imports": sectors("reporter_code = 15 and flow_code = 'M'"),
        "commodity_partner_matrix": q(
            "select commodity_code, "
            + ", ".join(
                dbl(f"sum(case when partner_code = {p} then v end)", f"partner_{p}")
                for p in (3, 7, 12, 18)
            )
            + " from trade where partner_code in (3, 7, 12, 18) group by commodity_code"
        ),
        "balance_full_outer": q(
            f"""select coalesce(x.partner_code, m.partner_code) as partner_code,
            coalesce(x.iso, '') as partner_iso3, {dbl("coalesce(x.s, 0)", "export_value")},
            {dbl("coalesce(m.s, 0)", "import_value")},
            {dbl("coalesce(x.s, 0) - coalesce(m.s, 0)", "net_trade")}
            from x full outer join m on x.partner_code = m.partner_code""",
            """x as (select partner_code, sum(v) as s, first(partner_iso3 order by seq) as iso
            from trade where flow_code = 'X' and reporter_code = 15 and period = '1997'
            group by partner_code)""",
            """m as (select partner_code, sum(v) as s from trade
            where flow_code = 'M' and reporter_code = 15 and period = '1997'
            group by partner_code)""",
        ),
        "sql_top_net": q(
            f"""select partner_code, {dbl(X, "total_exports")}, {dbl(M, "total_imports")},
            {dbl(f"{X} - {M}", "net")} from trade group by partner_code
            order by abs({X} - {M}) desc, partner_code limit 5"""
        ),
        "partner_share_report": q(
            f"""select row_number() over (order by x + m desc, partner_code) as rank, partner_code,
            partner_iso3, partner_name, {dbl("x + m", "total_trade")},
            {dbl("x - m", "trade_balance")},
            case when (select sum(x) from partners) > 0 then
              {div("(x + m)", "(select sum(x) from partners)")} * 100.0 else 0.0 end as share_pct
            from partners""",
            partner_rows(),
        ),
        "annual_trend": q(
            f"""select year, cast(year as varchar) as period, {dbl("value", "value")},
            {big("record_count", "record_count")}, cast(null as int) as month from yearly""",
            trend(),
        ),
        "annual_trend_metric": q(
            f"""select year, cast(year as varchar) as period, value,
            {big("record_count", "record_count")}, cast(null as int) as month from yearly""",
            trend("reporter_code = 15 and flow_code = 'X'", div("sum(v)", "count(*)")),
        ),
        "monthly_trend": q(
            f"""select year, cast(year as varchar) || lpad(cast(month as varchar), 2, '0') as period,
            {dbl("value", "value")}, {big("record_count", "record_count")}, month from monthly""",
            MONTHLY,
        ),
        "rolling_average": q(
            f"""select year, cast(year as varchar) || lpad(cast(month as varchar), 2, '0') as period,
            cast(sum(value) over w as double) / cast(count(*) over w as double) as value,
            {big("record_count", "record_count")}, month from monthly
            window w as (order by year, month rows between 3 preceding and current row)""",
            MONTHLY,
        ),
        "growth_rates": q(
            f"""select year, cast(year as varchar) as period, {dbl("value", "value")},
            {dbl("lag(value) over (order by year)", "previous")},
            {div("(value - lag(value) over (order by year))", "lag(value) over (order by year)")}
              as growth,
            {big("record_count", "record_count")}, cast(null as int) as month from yearly""",
            trend("flow_code = 'X'"),
        ),
        "growth_by_reporter": q(
            f"""select reporter_code, year, cast(year as varchar) as period, {dbl("value", "value")},
            {dbl("lag(value) over w", "previous")},
            {div("(value - lag(value) over w)", "lag(value) over w")} as growth,
            {big("record_count", "record_count")}, cast(null as int) as month from series
            window w as (partition by reporter_code order by year)""",
            """series as (select reporter_code, cast(substr(period, 1, 4) as int) as year,
            coalesce(sum(v), 0) as value, count(*) as record_count from trade group by 1, 2)""",
        ),
        "cagr": q(
            f"""select round(case when count(*) >= 2 then {growth_rate(
                "arg_min(value, year)", "arg_max(value, year)", "(max(year) - min(year))")} end, 9)
            as cagr from yearly""",
            trend("reporter_code = 15 and flow_code = 'M'"),
        ),
        "cagr_by_reporter": q(
            f"""select reporter_code, round(case when count(*) >= 2 then {growth_rate(
                "arg_min(value, year)", "arg_max(value, year)", "(max(year) - min(year))")} end, 9)
            as cagr from series group by reporter_code""",
            """series as (select reporter_code, cast(substr(period, 1, 4) as int) as year,
            coalesce(sum(v), 0) as value from trade group by 1, 2)""",
        ),
        "trend_report": q(
            f"""select year, {dbl("value", "value")},
            {div("(value - lag(value) over (order by year))", "lag(value) over (order by year)")}
              as growth,
            {big("record_count", "record_count")},
            (select round({growth_rate("arg_min(value, year)", "arg_max(value, year)",
                                       "(max(year) - min(year))")}, 9) from yearly) as cagr
            from yearly""",
            trend("reporter_code = 15 and flow_code = 'X'"),
        ),
        "country_vs_country": comparison(
            "reporter_code", [15, 3, 8, 12, 20], "partner_code", "partner", "true"
        ),
        "year_vs_year": comparison(
            "period", ["1997", "1998"], "commodity_code", "commodity", "reporter_code = 15"
        ),
        "commodity_vs_commodity": comparison(
            "commodity_code", ["TOTAL", "01", "26"], "partner_code", "partner", "flow_code = 'X'"
        ),
        "partner_vs_partner": comparison(
            "partner_code",
            [7, 12],
            "period",
            "period",
            "reporter_code = 15 and flow_code = 'M'",
            "order by delta_1, dimension_key limit 20",
        ),
        "country_vs_country_summary": q(
            f"""select side_no, cast(code as varchar) as label,
            {dbl("coalesce(sum(v), 0)", "total_value")}, {big("count(v)", "total_records")}
            from (values (0, 15), (1, 3), (2, 8)) s(side_no, code)
            left join trade on reporter_code = code and flow_code = 'X'
            group by side_no, code"""
        ),
    }
    out["partner_growth"] = q(
        f"""select 15 as reporter_code, 7 as partner_code, {big("count(*)", "point_count")},
        min(year) as first_year, max(year) as last_year,
        {dbl("arg_max(t, k) - arg_min(t, k)", "absolute_change")},
        {div("(arg_max(t, k) - arg_min(t, k))", "arg_min(t, k)")} as relative_change,
        round(case when count(*) >= 2 then {growth_rate(
            "arg_min(t, k)", "arg_max(t, k)", "(max(year) - min(year))")} end, 9) as cagr
        from points having count(*) > 0""",
        f"""points as (select ref_year as year, period, {X} + {M} as t,
        cast(ref_year as varchar) || period as k
        from trade where reporter_code = 15 and partner_code = 7 group by ref_year, period)""",
    )
    return out


def count_of(condition: str, name: str) -> str:
    return big(f"count(case when {condition} then 1 end)", name)


def query_sql() -> dict[str, str]:
    grouped = f"flow_code, {big('count(*)', 'n')}, {dbl('sum(v)', 'value')}"
    ranked = f"ref_year, reporter_code, {dbl('v', 'value')}"
    five = ", ".join(
        [
            "cast(sum({0}) as double) as sum",
            "count({0}) as count",
            "cast(sum({0}) as double) / nullif(cast(count({0}) as double), 0) as average",
            "cast(min({0}) as double) as minimum",
            "cast(max({0}) as double) as maximum",
        ]
    )
    kept = "ref_year in (1996, 1997, 1998) and fob is not null"
    return {
        "filter_ops": q(
            "select "
            + ", ".join(
                [
                    count_of("reporter_code = 15", "eq"),
                    count_of("flow_code <> 'X'", "ne"),
                    count_of("v < 50000", "lt"),
                    count_of("v <= 20000.5", "le_float"),
                    count_of("period > '1998'", "gt"),
                    count_of("ref_year >= 1999", "ge"),
                    count_of("partner_code in (1, 2, 3)", "is_in"),
                    count_of("commodity_code not in ('TOTAL', '01')", "not_in"),
                    count_of("fob is null", "null_eq_null"),
                    count_of("fob is null or fob <> 5", "null_ne_value"),
                    count_of("fob < 1000000000", "null_has_no_order"),
                    count_of("true", "null_not_in"),
                    count_of("false", "text_is_not_number"),
                    count_of("true", "text_differs_from_number"),
                    count_of("partner_code = 0", "is_world"),
                ]
            )
            + " from trade"
        ),
        "filter_boolean": q(
            f"""select {grouped} from trade
            where (coalesce(fob < 30000, false) and partner_code in (1, 2, 3))
              or not (ref_year >= 1998 or coalesce(fob < 30000, false)) group by flow_code"""
        ),
        "exclude": q(
            f"""select {grouped} from trade
            where not (reporter_code = 15 and frequency_code = 'A')
              and not coalesce(fob > 40000, false) group by flow_code"""
        ),
        "named_filters": q(
            "select "
            + ", ".join(
                [
                    count_of("reporter_code = 15", "reporter"),
                    count_of("partner_code = 7", "partner"),
                    count_of("flow_code = 'X'", "exports"),
                    count_of("flow_code = 'M'", "imports"),
                    count_of("flow_code = 'RX'", "reexports"),
                    count_of("ref_year = 1997", "one_year"),
                    count_of("ref_year in (1996, 1998)", "years"),
                    count_of("period = '199703'", "one_period"),
                    count_of("commodity_code = 'TOTAL'", "total_rows"),
                    count_of("classification_code = 'H6'", "classification"),
                    count_of("reporter_code = 15 and flow_code = 'X'", "both"),
                    count_of("ref_year = 1997 or partner_code <> 7", "either_not"),
                    count_of("fob > 60000", "custom"),
                    count_of("not coalesce(fob > 60000, false)", "not_custom"),
                ]
            )
            + " from trade"
        ),
        "filter_hs_set": q(
            f"""select commodity_code, {four()}, {COUNT} from trade
            where commodity_code in (select commodity_code from codes
              where lower(display_name) like '%bolt%') group by commodity_code""",
            CODES,
        ),
        "sort_multi": q(
            f"""select {ranked} from trade
            order by ref_year desc, v desc, reporter_code desc limit 80"""
        ),
        "sort_mixed": q(
            f"select {ranked} from trade order by ref_year, v desc, reporter_code limit 60"
        ),
        "reverse": q(
            f"""select {ranked} from trade
            order by v desc, reporter_code desc, ref_year desc limit 50"""
        ),
        "offset_limit": q(
            f"""select {ranked} from trade where flow_code = 'X'
            order by v, reporter_code, ref_year limit 70 offset 100"""
        ),
        "offset_only": q(
            f"select {ranked} from trade order by v, reporter_code, ref_year offset 250"
        ),
        "group_keys": q(
            f"select reporter_code, period, {COUNT} from trade group by reporter_code, period"
        ),
        "group_members": q(
            f"""select flow_code, ref_year, seq as _seq, {dbl("v", "value")}
            from trade where reporter_code = 15"""
        ),
        "summarize_by_reporter": q(
            f"select reporter_code, {five.format('fob')} from trade group by reporter_code"
        ),
        "summarize_nothing": q(f"select {five.format('v')} from trade where reporter_code = -1"),
        "metrics_all": q(f"select {METRICS} from trade"),
        "metric_ratio": q(
            f"""select commodity_code, flow_code,
            '(sum_primary_value ÷ sum_quantity)' as metric_name,
            {div("sum(v)", "sum(qty)")} as metric_value, {COUNT}
            from trade group by commodity_code, flow_code"""
        ),
        "aggregate_by_flow_year": q(
            f"""select flow_code, ref_year, 'sum_cif_value' as metric_name,
            {dbl("coalesce(sum(cif), 0)", "metric_value")}, {COUNT}
            from trade group by flow_code, ref_year"""
        ),
        "engine_run": q(
            f"""select 'metric' as kind, 'count' as name, '' as key, {dbl("count(*)", "value")}
              from kept
            union all select 'metric', 'sum_fob_value', '', cast(sum(fob) as double) from kept
            union all select 'metric', 'avg_primary_value', '', {div("sum(v)", "count(v)")} from kept
            union all select 'metric', 'undefined', '', null
            union all select 'aggregation', 'by_flow', flow_code, cast(sum(qty) as double)
              from kept group by flow_code
            union all select 'aggregation', 'by_year', cast(ref_year as varchar),
              {div("sum(v)", "count(v)")} from kept group by ref_year
            union all select 'count', 'filtered', cast(count(*) as varchar),
              cast(count(case when {kept} then 1 end) as double) from trade
            union all select 'warning', 'undefined', 'metric', 0.0
            union all select 'error', 'failing', 'aggregation', 0.0""",
            f"kept as (select * from trade where {kept})",
        ),
    }


KEY_SHOWN = (
    "reporter_code, partner_code, period, flow_code, commodity_code, customs_code, mot_code, "
    "partner2_code"
)
SHOWN = f"{KEY_SHOWN}, seq as _seq, {dbl('v', 'value')}"


def pick(source: str, order: str, key: str = KEY) -> str:
    return f"""select * from {source}
      qualify row_number() over (partition by {key} order by {order}) = 1"""


BATCH = f"""batch as (
  select * replace (seq + 1099511627776 as seq, v + 1 as v) from trade where ref_year >= 1999
  union all
  select * replace (seq + 2199023255552 as seq, v + 2 as v) from trade
    where ref_year >= 1999 and seq % 10 = 0),
reduced as ({pick("batch", "seq desc, v desc, qty desc")}),
existing as (select * from trade where ref_year <= 1999)"""

JOIN_KEY = " and ".join(
    f"e.{c} = b.{c}"
    for c in (
        "reporter_code partner_code period flow_code commodity_code classification_code edition "
        "customs_code mot_code"
    ).split()
) + " and coalesce(e.partner2_code, 0) = coalesce(b.partner2_code, 0)"


def slice_of(where: str) -> str:
    return q(
        f"""select period, partner_code, flow_code, commodity_code, seq as _seq,
        {dbl("v", "value")} from trade where {where}"""
    )


def grid(reporters: str, years: str, partners: str) -> str:
    return f"""cells as (select row_number() over (order by r.i, y.i, p.i) - 1 as request_no,
      r.c as reporter_code, y.c as ref_year, p.c as partner_code
      from (select unnest({reporters}) as c, generate_subscripts({reporters}, 1) as i) r,
        (select unnest({years}) as c, generate_subscripts({years}, 1) as i) y,
        (select unnest({partners}) as c, generate_subscripts({partners}, 1) as i) p),
    held as (select reporter_code, ref_year, partner_code, count(*) as n from trade group by all),
    covered as (select cells.*, n from cells left join held
      using (reporter_code, ref_year, partner_code))"""


def record_sql() -> dict[str, str]:
    plain_order = "seq, v, qty"
    last_order = "seq desc, v desc, qty desc"
    pages = " union all ".join(
        f"select {i} as page, * replace (v + {i} as v) from trade "
        f"where ref_year between {a} and {b}"
        for i, (a, b) in enumerate([(1995, 1997), (1997, 1999), (1999, 2001)])
    )
    spans = " union all ".join(
        f"select '{c}' as aspect, cast(count(distinct {c}) as bigint) as found, "
        f"array_to_string(list_sort(list(distinct {c})), ', ') as members from trade "
        f"having count(distinct {c}) > 1"
        for c in ("reporter_code", "flow_code", "classification_code", "edition")
    )
    return {
        "dedup_first": q(f"select {SHOWN} from kept", f"kept as ({pick('trade', plain_order)})"),
        "dedup_last": q(f"select {SHOWN} from kept", f"kept as ({pick('trade', last_order)})"),
        "dedup_custom_key": q(
            f"select reporter_code, flow_code, ref_year, seq as _seq, {dbl('v', 'value')} from kept",
            f"kept as ({pick('trade', plain_order, 'reporter_code, flow_code, ref_year')})",
        ),
        "latest_wins": q(
            f"select {SHOWN} from kept",
            """revised as (select * from trade union all
              select * replace (seq + 1099511627776 as seq, v + 1 as v,
                case when qty % 7 <> 0 then ref_period_id + cast(qty as bigint) % 3 end
                  as ref_period_id) from trade)""",
            f"kept as ({pick('revised', 'coalesce(ref_period_id, 0) desc, ' + plain_order)})",
        ),
        "find_duplicates": q(
            f"""select {KEY_SHOWN.replace("partner2_code", "coalesce(partner2_code, 0) as partner2_code")},
            {big("count(*)", "member_count")} from trade group by {KEY}, partner2_code
            having count(*) > 1"""
        ),
        "duplicate_members": q(
            f"""select * from (select reporter_code, partner_code, commodity_code, flow_code,
            seq as _seq, {dbl("v", "value")}, count(*) over (partition by reporter_code,
              partner_code, commodity_code, flow_code) as member_count from trade)
            where member_count > 1"""
        ),
        "merge_update": q(
            f"""select {SHOWN} from (select * from existing e where not exists
              (select 1 from reduced b where {JOIN_KEY}) union all select * from reduced)""",
            BATCH,
        ),
        "append_update": q(
            f"select {SHOWN} from (select * from existing union all select * from reduced)", BATCH
        ),
        "update_counts": q(
            f"""select (select count(*) from reduced) as records_added,
            (select count(*) from (select distinct {KEY} from existing e where exists
              (select 1 from reduced b where {JOIN_KEY}))) as records_merged,
            (select count(*) from batch) - (select count(*) from reduced)
              as duplicates_in_input""",
            BATCH,
        ),
        "merge_pages": q(
            f"select {SHOWN} from kept",
            f"pages as ({pages})",
            f"kept as ({pick('pages', 'page, ' + plain_order)})",
        ),
        "combine_datasets": q(
            f"""select reporter_code, {first("reporter_iso3")}, {first("reporter_name")}, {four()},
            {COUNT} from many group by reporter_code""",
            """many as (select * from trade where ref_year in (1996, 1997)
              union all select * from trade where ref_year = 1997)""",
        ),
        "dataset_warnings": q(
            f"""{spans} union all select 'ref_period_id', count(*), null from (select ref_period_id,
              lag(ref_period_id) over (order by seq, ref_period_id) as before from trade)
            where before > ref_period_id having count(*) > 0"""
        ),
        "metadata_dedupe": """select id, code, p_partkey, 'R04' as resource from (
            select case when p_brand <> 'Brand#7' then p_type end as id, p_brand as code, p_partkey
            from part) qualify row_number() over (partition by coalesce(id, code)
              order by p_partkey) = 1""",
        "slice_exports": slice_of(
            "reporter_code = 15 and flow_code = 'X' and frequency_code = 'A' "
            "and period in ('1996', '1997') and commodity_code = 'TOTAL'"
        ),
        "slice_world": slice_of(
            "reporter_code = 15 and flow_code = 'X' and frequency_code = 'A' "
            "and period in ('1996', '1998') and commodity_code = 'TOTAL' and partner_code = 0"
        ),
        "slice_monthly": slice_of(
            "reporter_code = 9 and flow_code = 'M' and frequency_code = 'M' "
            "and period between '199701' and '199712' and length(period) = 6 and commodity_code = 'TOTAL'"
        ),
        "slice_line_level": slice_of(
            "reporter_code = 15 and flow_code = 'X' and frequency_code = 'A' "
            "and period in ('1997', '1998') and commodity_code = 'TOTAL'"
        ),
        "slice_matrix": slice_of(
            "reporter_code in (15, 3, 8) and frequency_code = 'A' and period = '1997' "
            "and commodity_code = 'TOTAL'"
        ),
        "slice_limited": q(
            "select seq as _seq from trade where reporter_code = 15 and frequency_code = 'A' "
            "and period = '1997' and commodity_code = 'TOTAL' order by seq limit 5"
        ),
        "grid_coverage": q(
            """select request_no, reporter_code, ref_year, partner_code,
            cast(coalesce(n, 0) as bigint) as record_count, n is not null as covered from covered""",
            grid("[15, 3, 99]", "[1996, 1997, 2050]", "[0, 7, 12]"),
        ),
        "grid_totals": q(
            f"""select count(*) as total, count(n) as successful, count(*) - count(n) as failed,
            {big("coalesce(sum(n), 0)", "records")} from covered""",
            grid("range(25)", "[1996, 1997]", "range(30)"),
        ),
        "load_partition": q(
            f"""select partner_code, commodity_code, seq as _seq, {dbl("v", "value")} from trade
            where reporter_code = 15 and ref_year = 1997 and frequency_code = 'A'"""
        ),
        "canonical_order": q(
            """select ref_period_id, reporter_code, partner_code, flow_code, commodity_code from trade
            order by cast(ref_period_id as varchar), cast(reporter_code as varchar),
              cast(partner_code as varchar), flow_code, commodity_code"""
        ),
    }


CODES = """codes as (select * from (
  select case when p_partkey % 11 = 0 then '123'
      when p_partkey % 50 = 0 then 'TOTAL'
      when p_size % 5 = 0 then lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
      when p_size % 5 = 1 then lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
        || lpad(cast(p_partkey % 7 as varchar), 2, '0')
      else lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
        || lpad(cast(p_partkey % 7 as varchar), 2, '0') || '10' end as commodity_code,
    case when p_partkey % 13 <> 0 then
      case when p_partkey % 50 = 0 then 'TOTAL'
        when p_size % 5 = 0 then lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
        when p_size % 5 = 1 then lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
          || lpad(cast(p_partkey % 7 as varchar), 2, '0')
        else lpad(cast(1 + p_partkey % 99 as varchar), 2, '0')
          || lpad(cast(p_partkey % 7 as varchar), 2, '0') || '10' end || ' - ' || p_name end
      as display_name,
    p_partkey from part)
  where commodity_code <> '123'
  qualify row_number() over (partition by commodity_code order by p_partkey) = 1)"""

REASONS = """case pk % 23 when 0 then 'flowCode: out of domain' when 1 then 'freqCode: out of domain'
  when 2 then 'cmdCode: out of domain' when 3 then 'refMonth: out of domain'
  when 4 then 'refYear: out of domain' when 5 then 'reporterISO: not a country code'
  when 6 then 'primaryValue: negative' when 7 then 'primaryValue: missing'
  when 8 then 'isReported: not a valid flag' when 14 then 'reporterDesc: blank'
  when 15 then 'partnerCode: not a valid int' end"""

PARSED = f"""parsed as (select *, {REASONS} as reason,
  case when pk % 23 = 11 then cast(v as decimal(38,12)) + cast(0.003456789012 as decimal(38,12))
    else cast(v as decimal(38,12)) end as exact,
  case when pk % 23 = 16 then 7 end as second from trade),
good as (select * replace (second as partner2_code) from parsed where reason is null)"""


def source_sql() -> dict[str, str]:
    good_key = KEY
    return {
        "parse_trade": q(
            """select seq as _seq, ref_period_id, ref_year, ref_month, period, reporter_code,
            reporter_iso3, partner_code, partner2_code,
            case when partner2_code is not null then 'NBC' end as partner2_iso3, flow_code,
            commodity_code, mot_code, pk % 23 = 17 as is_reported,
            case when pk % 23 = 10 then '{"dataset":"d7","revision":2}' end as provenance,
            cast(cast(exact as decimal(38,12)) as varchar) as value_text,
            cast(cast(fob as decimal(38,4)) as varchar) as fob_text from good""",
            PARSED,
        ),
        "quarantine_counts": q(
            "select reason, count(*) as skipped from parsed where reason is not null "
            "group by reason",
            PARSED,
        ),
        "pipeline_end_to_end": q(
            f"""select reporter_code, {first("reporter_iso3")}, {first("reporter_name")},
            {four().replace("then v", "then exact").replace("(v", "(exact")}, {COUNT}
            from kept group by reporter_code""",
            PARSED,
            f"kept as ({pick('good', 'seq, exact, qty', good_key)})",
        ),
        "ref_tables": """select n_nationkey as country_code,
            case n_nationkey % 7 when 2 then 'ABC' when 3 then null else 'XYZ' end as iso_alpha3,
            case when n_nationkey % 7 = 6 then n_name || ' again' else n_name end as display_name,
            '1990-01-01' as entry_effective_date,
            case when n_nationkey % 7 = 0 then '2001-05-06' end as entry_expired_date
            from nation where n_nationkey % 7 not in (4, 5)""",
        "lookup_name": """select n_nationkey as country_code, n_name as display_name, 'exact' as how
            from nation where lower(n_name) = 'nation_7' union all
            select n_nationkey, n_name, 'part' from nation where contains(n_name, 'ION_1')""",
        "lookup_code": """select n_nationkey as country_code, n_name as display_name from nation
            where n_nationkey = 7""",
        "search_ref": """select p_partkey, p_name, p_brand, p_type from part
            where contains(lower(p_name), 'small') or contains(lower(p_brand), 'small')
              or contains(lower(p_type), 'small')""",
        "search_hs": f"""with {CODES} select commodity_code, display_name from codes
            where contains(lower(display_name), 'blue')""",
        "enrich_labels": q(
            f"""select bal.*, display_name from (select commodity_code, {four()}, {COUNT}
            from trade group by commodity_code) bal left join codes using (commodity_code)""",
            CODES,
        ),
    }


def text(expression: str, name: str, scale: int = 2) -> str:
    return f"cast(cast({expression} as decimal(38,{scale})) as varchar) as {name}"


def storage_sql() -> dict[str, str]:
    rows = f"{KEY_SHOWN}, seq as _seq, {text('v', 'value')}"
    numbered = (
        "numbered as (select * replace (seq + (select max(seq) + 1 from existing) as seq) from reduced)"
    )
    first_rows = f"kept as ({pick('good', 'seq, exact, qty', KEY)})"
    return {
        "store_formats": q(
            f"""select f.format, reporter_code, ref_year, frequency_code,
            {big("count(*)", "record_count")}, {text("sum(v)", "value")}, {text("sum(fob)", "fob", 4)},
            {text("sum(seq)", "numbers", 0)}
            from trade, (select unnest(['csv', 'json', 'parquet', 'table']) as format) f group by all"""
        ),
        "stored_partition": q(
            f"""select partner_code, commodity_code, seq as _seq, {dbl("v", "value")} from trade
            where reporter_code = 15 and ref_year = 1997 and frequency_code = 'A'"""
        ),
        "stored_merge": q(
            f"""select {rows} from (select * from existing e where not exists
              (select 1 from reduced b where {JOIN_KEY}) union all select * from numbered)""",
            BATCH,
            numbered,
        ),
        "stored_append": q(
            f"select {rows} from (select * from existing union all select * from numbered)",
            BATCH,
            numbered,
        ),
        "versioned_merge": q(
            f"""select {rows} from (select * from existing e where not exists
              (select 1 from reduced b where {JOIN_KEY}) union all select * from numbered)""",
            BATCH,
            numbered,
        ),
        "versioned_history": q(
            """select v as version, n as listed_rows, n as read_rows, d as row_numbers from (
              select 1 as v, count(*) as n, count(distinct seq) as d from existing
              union all select 2, k.n + r.n, k.d + r.d from kept k, given r
              union all select 3, k.n + 2 * r.n, k.d + 2 * r.d from kept k, given r)""",
            BATCH,
            f"""kept as (select count(*) as n, count(distinct seq) as d from existing e
              where not exists (select 1 from reduced b where {JOIN_KEY}))""",
            # every update is numbered on from the last row, so its numbers are new ones
            "given as (select count(*) as n, count(distinct seq) as d from reduced)",
        ),
        "stored_update_counts": record_sql()["update_counts"],
        "stored_reports": f"""select *, (select count(*) from lineitem) as dataset_rows,
            'parse_records' as parser_name, '1.0.0' as schema_version
            from ({report_sql()["country_balance"]}) balances""",
        "ingest_twice": q(
            """select 2 * count(*) as row_count, 2 * count(*) as number_count, 0::bigint as first_number,
            2 * count(*) as next_number, count(*) as first_of_first, count(*) as last_of_second from kept""",
            PARSED,
            first_rows,
        ),
        "ingest_latest": q(
            """select reporter_code, count(*) as record_count, count(*) as revised from kept
            group by reporter_code""",
            PARSED,
            first_rows,
        ),
        "read_documents": q(
            """select reporter_code, count(*) as record_count, (select count(*) from lineitem) as held,
            0::bigint as off from good group by reporter_code""",
            PARSED,
        ),
        "exact_text": q(
            """select partner_code, cast(cast(coalesce(sum(case when flow_code = 'X' then v end), 0)
              - coalesce(sum(case when flow_code = 'M' then v end), 0) as decimal(38,18))
              + sum(case when flow_code = 'X' then cast('0.000000000000000001' as decimal(38,18))
                else cast(0 as decimal(38,18)) end) as varchar) as net_trade
            from trade where reporter_code = 15 and flow_code in ('X', 'M') group by partner_code"""
        ),
        "stored_recipe": q(
            f"""select 'summary' as kind, count(distinct partner_code) as code, count(*) as records, {dbl(f"{X} + {M}", "value")}
              from trade where reporter_code = 15
            union all select * from (select 'partner', partner_code, count(*), cast({X} + {M} as double)
              from trade where reporter_code = 15 group by partner_code order by {X} + {M} desc, partner_code limit 10)"""
        ),
        "registry_history": q(
            """select 'gated' as dataset_name, record_count, duplicates_removed, source_count, 'parquet' as backend,
              'parse_records' as parser_name, (select count(*) from final) as stored_rows,
              $$parser_name mismatch: existing='parse_records', new='other'$$ as refused
            from (select (select count(*) from first_write) as record_count, (select count(*) from existing) as source_count,
                (select count(*) from existing) - (select count(*) from first_write) as duplicates_removed
              union all select (select count(*) from final), (select count(*) from batch),
                (select count(*) from batch) - (select count(*) from reduced))""",
            BATCH,
            f"first_write as ({pick('existing', 'seq desc, v desc, qty desc')})",
            f"""final as (select seq from first_write e where not exists (select 1 from reduced b where {JOIN_KEY})
              union all select seq from reduced)""",
        ),
        "nested_and_back": q(
            """select reporter_code as nested_reporter, reporter_code, flow_code as nested_flow, flow_code, count(*) as n,
              cast(sum(v) as double) as value, count(*) as same_partner2 from trade group by reporter_code, flow_code"""
        ),
        "partner_report": q(
            f"""select 'rank' as kind, cast(row_number() over (order by value desc, code) as varchar) as key, code, value
              from (select partner_code as code, cast({X} as double) as value from trade where reporter_code = 15
                group by partner_code having count(case when flow_code = 'X' then 1 end) > 0 order by {X} desc, partner_code limit 10)
            union all select 'point', period, ref_year, cast({X} + {M} as double) from trade
              where reporter_code = 15 and partner_code = 7 group by ref_year, period
            union all select 'growth', '', count(distinct (ref_year, period)), null from trade
              where reporter_code = 15 and partner_code = 7"""
        ),
        "code_lists_by_name": """select 'References' as list, r_name as code, 'd' as label from region where r_regionkey <> 3
            union all select 'R03', cast(n_nationkey as varchar), n_name from nation where n_nationkey % 5 <> 0
            union all select 'HSEdition', lpad(cast(p_partkey % 10000 as varchar), 4, '0'), arg_min(p_name, p_partkey)
              from part where p_partkey % 9 <> 0 group by 2
            union all select 'Frequency', case s_suppkey % 3 when 0 then 'A' else 'M' end, arg_min(s_name, s_suppkey)
              from supplier where s_suppkey % 3 < 2 group by 2
            union all select 'R10', case s_suppkey % 3 when 0 then 'X' else 'RM' end, arg_min(s_name, s_suppkey)
              from supplier where s_suppkey % 3 < 2 group by 2
            union all select 'TransportModes', cast(n_nationkey * 100 - 300 as varchar), n_name from nation where n_nationkey >= 3
            union all select 'R14', cast(n_nationkey as varchar), n_name from nation where n_nationkey % 4 <> 0
            union all select 'DataItems', 'i' || (c_custkey % 40), arg_min(c_name, c_custkey) from customer group by 2""",
        "engine_isolated": q(
            """select 'count' as name, '' as key, cast(count(*) as double) as value from trade
            union all select 'largest_year', '', cast(max(ref_year) as double) from trade
            union all select 'median_year', '', quantile_cont(ref_year, 0.5) from trade
            union all select name, '', null from (values ('huge'), ('huge_too'), ('by_zero'), ('raising'), ('raising_alone')) x(name)
            union all select 'median_by_flow', flow_code, quantile_cont(ref_year, 0.5) from trade group by flow_code
            union all select * from (values
              ('warning metric huge', 'a sum does not fit', 0.0), ('warning metric huge_too', 'a sum does not fit', 0.0),
              ('warning metric by_zero', 'no value', 0.0), ('warning metric raising', 'raised', 0.0),
              ('warning metric raising_alone', 'raised', 0.0), ('error aggregation huge_by_flow', 'a group has no value', 0.0)) y"""
        ),
        "custom_metric": q(
            f"""select {dbl("max(v) - min(v)", "spread")},
            {dbl("coalesce(sum(cif), 0) - coalesce(sum(fob), 0)", "margin")},
            2 * count(*) as twice from trade"""
        ),
    }


def all_sql() -> dict[str, str]:
    return {**report_sql(), **query_sql(), **record_sql(), **source_sql(), **storage_sql()}
