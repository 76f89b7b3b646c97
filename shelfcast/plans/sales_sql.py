"""Reference SQL (DuckDB dialect) of the sales queries, by the same keys."""

from __future__ import annotations

from shelfcast.plans import sql_views as v
from shelfcast.plans.sql_views import CALENDAR, FILLED, GAPPED, LINE, MEDIANS, MERGED, MONTH_MEAN, ORDER_CALENDAR, PANEL, RAW, RUNS, TEXT

_W = "partition by family, store_nbr order by date"
_TO_DAY = "try_cast(date as date)"
_TO_NUM = "case when isnan(try_cast(sales as double)) then null else try_cast(sales as double) end"
_KEEP = "type in ('Holiday','Event','Additional') and not transferred"


def panel(body: str, *views: str) -> str:
    return v.with_views(body, PANEL, *views)


def raw(body: str, *views: str) -> str:
    return v.with_views(body, PANEL, RAW, *views)


# Candidates, then chains of candidates at most three rows apart, scanned in order by a recursive
# query that carries the values of the last three candidates of the chain.
def spike_views(source: str, name: str) -> list[str]:
    return [
        f"""{name}_seen as (
  select s.*, e.date is not null as is_event, row_number() over w as rn,
    median(sales) over (partition by family, store_nbr order by s.date rows between 3 preceding and 3 following) as med,
    quantile_cont(sales, 0.75) over (partition by family, store_nbr) as q3,
    quantile_cont(sales, 0.25) over (partition by family, store_nbr) as q1
  from {source} s left join event_days e on e.date = s.date window w as (partition by family, store_nbr order by s.date))""",
        f"""{name}_marked as (
  select *, not is_event and med > 0 and sales > med * 10.0::double and sales > q3 + 3.0::double * (q3 - q1) as candidate from {name}_seen)""",
        f"""{name}_numbered as (
  select family, store_nbr, rn, row_number() over (partition by family, store_nbr order by rn) as k, sales, med
  from {name}_marked where candidate)""",
        f"""{name}_calm as (
  select c.family, c.store_nbr, c.rn, c.k, c.sales, c.med,
    bool_and(n.rn is null or n.sales < c.sales * 0.5::double) filter (n.rn > c.rn or not n.candidate or n.rn is null) as calm
  from {name}_numbered c left join {name}_marked n
    on n.family = c.family and n.store_nbr = c.store_nbr and n.rn between c.rn - 3 and c.rn + 3 and n.rn <> c.rn
  group by all)""",
        f"""{name}_scan as (
  select family, store_nbr, k, rn, coalesce(calm, true) as hit,
    [{{'rn': rn, 'v': case when coalesce(calm, true) then med else sales end}}] as near
  from {name}_calm where k = 1
  union all
  select c.family, c.store_nbr, c.k, c.rn,
    coalesce(c.calm, true) and len(list_filter(p.near, lambda x: c.rn - x.rn <= 3 and not (x.v < c.sales * 0.5::double))) = 0,
    list_filter(p.near, lambda x: c.rn - x.rn <= 3) || [{{'rn': c.rn, 'v':
      case when coalesce(c.calm, true) and len(list_filter(p.near, lambda x: c.rn - x.rn <= 3 and not (x.v < c.sales * 0.5::double))) = 0
           then c.med else c.sales end}}]
  from {name}_scan p join {name}_calm c on c.family = p.family and c.store_nbr = p.store_nbr and c.k = p.k + 1)""",
        f"""{name}_done as (
  select m.date, m.family, m.store_nbr, case when s.hit then m.med else m.sales end as sales, m.onpromotion, m.is_event,
    coalesce(s.hit, false) as is_outlier
  from {name}_marked m left join {name}_scan s using (family, store_nbr, rn))""",
    ]


def spiked(body: str, source: str = "merged", extra: tuple[str, ...] = ()) -> str:
    return v.with_views(body, PANEL, RAW, CALENDAR, GAPPED, MERGED, *extra, *spike_views(source, "z"), recursive=True)


_GAP_VIEWS = (RUNS, LINE, MONTH_MEAN, MEDIANS, FILLED)
_SPLIT = """numbered as (select *, cast(row_number() over (partition by family, store_nbr order by date) as int) as rn,
  cast(count(*) over (partition by family, store_nbr) as int) as n from panel)"""
_CHRONO = """parts as (select *, case when rn <= cast(floor(n * 0.7::double) as int) then 'train'
  when rn <= cast(floor(n * 0.7::double) as int) + cast(floor(n * 0.15::double) as int) then 'val' else 'test' end as split from numbered)"""
_FORECAST = """parts as (select *, case when rn <= cast(floor(n * 0.7::double) as int) then 'train'
  when rn <= cast(floor(n * (0.7::double + 0.15::double)) as int) then 'val' else 'test' end as split from numbered)"""
_SPLIT_ROWS = "select family, store_nbr, split, count(*) as rows, min(date) as first_date, max(date) as last_date from parts group by all"

_CELL = """(case when date is null then 1 else 0 end) + (case when store_nbr is null then 1 else 0 end) + (case when family is null then 1 else 0 end)
  + (case when sales is null then 1 else 0 end) + (case when onpromotion is null then 1 else 0 end)"""
_TEXT_CELL = _CELL.replace("sales is null", "sales is null or sales in ('NaN', 'n/a')")

_FACTS = f"""facts as (select count(*) as rows, count(distinct date) as days, sum({_CELL}) as null_cells,
  count(*) filter (sales < 0) as neg, count(*) filter (onpromotion < 0) as negp,
  (select coalesce(sum(n), 0) from (select count(*) as n from raw_sales group by date, family, store_nbr) where n > 1) as dups from raw_sales)"""

_WEEKLY = """weeks as (select cast(date_trunc('week', date) as date) + 6 as d, sum(sales) as sales from panel group by 1),
  spine as (select cast(unnest(generate_series((select min(d) from weeks), (select max(d) from weeks), interval 7 day)) as date) as d)"""
_WEEKLY_BODY = """select strftime(spine.d, '%Y-W%W') as label, coalesce(sales, 0) as sales from spine left join weeks using (d)"""
_MONTHLY = """months as (select cast(date_trunc('month', date) as date) as d, sum(sales) as sales from panel group by 1),
  spine as (select cast(unnest(generate_series((select min(d) from months), (select max(d) from months), interval 1 month)) as date) as d)"""
_MONTHLY_BODY = "select strftime(spine.d, '%Y-%m') as label, coalesce(sales, 0) as sales from spine left join months using (d)"
_YEARS = "years as (select distinct year(date) as y from panel)"
_SPAN = "(select (year(max(date)) - year(min(date))) * 12 + month(max(date)) - month(min(date)) from panel) >= 13"
_MONTH_LONG = f"""month_long as (select cast(y as int) as year, cast(m as int) as month, s.sales as sales
  from years cross join generate_series(1, 12) as g(m)
  left join (select year(date) as yy, month(date) as mm, sum(sales) as sales from panel group by 1, 2) s on yy = y and mm = m where {_SPAN})"""
_PIVOT = ", ".join(f"max(case when year = {y} then sales end) as y{y}" for y in range(1995, 2002))
_YOY = """yoy as (select * from (select cast(year(date) as int) as year, sum(sales) as s, lag(sum(sales)) over (order by year(date)) as p,
  cast(lag(year(date)) over (order by year(date)) as int) as previous_year from panel group by year(date)) order by year desc limit 1)"""
_CORR = """totals as (select date, family, sum(sales) as s from panel group by 1, 2),
  dense as (select d.date, f.family, coalesce(s, 0) as s from (select distinct date from panel) d cross join (select distinct family from panel) f
    left join totals t on t.date = d.date and t.family = f.family),
  pairs as (select a.family as family_1, b.family as family_2, corr(a.s, b.s) as c from dense a join dense b using (date) group by 1, 2)"""
_CORR_OUT = "round(case when isnan(c) then null else c end, 6)"
_PROMO = """avg(case when onpromotion > 0 then sales end) as p, avg(case when onpromotion = 0 then sales end) as q"""
_PROMO_FAMILY = f"""promo_family as (select family, p as promo_avg, q as non_promo_avg, case when q > 0 then p / q end as lift
  from (select family, {_PROMO} from panel group by 1) order by coalesce(case when q > 0 then p / q end, 0) desc, family limit 10)"""
_PROMO_ALL = f"""promo_all as (select coalesce(p, 0) as promo_avg, coalesce(q, 0) as non_promo_avg,
  case when coalesce(q, 0) > 0 then coalesce(p, 0) / q end as lift from (select {_PROMO} from panel))"""
_TOP = """top_fam as (select family, sum(sales) as sales, avg(onpromotion) as onpromotion_avg from panel group by 1 order by 2 desc, 1 limit 10)"""
_SHARE = """share as (select family, sum(sales) as sales, sum(sum(sales)) over () as total, sum(sales) / sum(sum(sales)) over () * 100 as share from panel group by 1)"""
_WEEKDAY = """week as (select cast(w as int) as weekday, coalesce(a, 0) as avg_sales from generate_series(0, 6) as g(w)
  left join (select isodow(date) - 1 as d, avg(sales) as a from panel group by 1) on d = w)"""
_OVERVIEW = """over_all as (select sum(sales) as total_sales, sum(sales) / count(distinct date) as avg_daily_sales,
    min(date) as start, max(date) as "end", count(distinct date) as days, count(distinct store_nbr) as store_count, count(distinct family) as family_count from panel),
  best as (select family, sum(sales) as sales from panel group by 1 order by 2 desc, 1 limit 1)"""
_YOY_VALUE = "case when p > 0 then round((s - p) / p * 100, 2) end"


def _cells(view: str, section: str, label: str, names: list[str]) -> str:
    return " union all ".join(
        f"select '{section}' as section, '{n}' as key, {label} as label, round(cast({n} as double), 6) as value from {view}" for n in names
    )


_REPORT = " union all ".join(
    [
        _cells("(select * from over_all, (select family, sales as best_family_sales from best), (select " + _YOY_VALUE + " as yoy_growth from yoy))", "overview", "family",
               ["total_sales", "avg_daily_sales", "yoy_growth", "best_family_sales", "days", "store_count", "family_count"]),
        f"select 'trend', 'sales', label, round(sales, 6) from ({_MONTHLY_BODY})",
        "select 'monthly', cast(year as varchar), lpad(cast(month as varchar), 2, '0'), round(sales, 6) from month_long",
        _cells("share", "share", "family", ["sales", "share"]),
        _cells("top_fam", "top", "family", ["sales", "onpromotion_avg"]),
        f"select 'correlation', family_1, family_2, {_CORR_OUT} from pairs",
        "select 'weekday', 'avg_sales', cast(weekday as varchar), round(avg_sales, 6) from week",
        _cells("promo_all", "promo", "null", ["promo_avg", "non_promo_avg", "lift"]),
        _cells("promo_family", "promo_by_family", "family", ["promo_avg", "non_promo_avg", "lift"]),
    ]
)

_CHECKED = """select request_id, reason = 'ok' as ok, reason from (select r.request_id,
  case when r.family is null then 'family missing' when r.store_nbr is null or r.store_nbr = 0 then 'store missing' when models = 'none' then 'no model chosen'
    when models = 'bad' then 'model not supported' when horizon not between 7 and 90 then 'horizon out of range'
    when r.family not in (select family from panel) then 'family unknown'
    when r.store_nbr not in (select store_nbr from panel) then 'store unknown'
    when coalesce(s.n, 0) < 30 then 'series too short' else 'ok' end as reason
  from requests r left join (select family, store_nbr, count(*) as n from panel group by all) s on s.family = r.family and s.store_nbr = r.store_nbr)"""
_REQUESTS = """requests as (
  select c_custkey as request_id, (['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD','GARDEN',null])[c_custkey % 8 + 1] as family,
    cast(c_nationkey as int) as store_nbr, cast(c_custkey % 100 as int) as horizon,
    case when c_custkey % 11 = 0 then 'none' when c_custkey % 13 = 0 then 'bad' else 'good' end as models
  from customer)"""

_PAST = f"partition by family, store_nbr order by date rows between 30 preceding and 1 preceding"

_DAILY_BODY = """select strftime(d.d, '%Y-%m-%d') as label, coalesce(s, 0) as sales
  from (select cast(unnest(generate_series((select min(date) from panel where {where}), (select max(date) from panel where {where}), interval 1 day)) as date) as d) d
  left join (select date, sum(sales) as s from panel where {where} group by 1) t on t.date = d.d"""

ORACLES: dict[str, str] = {
    "panel": panel("select * from panel"),
    "filter_series": panel("select * from panel where family = 'PROMO' and store_nbr = 3"),
    "check_required_columns": raw(
        """select 'date' as "column", true as present, count(date) as filled from raw_sales union all
           select 'store_nbr', true, count(store_nbr) from raw_sales union all
           select 'family', true, count(family) from raw_sales union all select 'sales', false, 0"""
    ),
    "check_date_parse": raw(f"select count(*) filter (date is not null and {_TO_DAY} is null) as bad_dates, count(*) filter (date is not null and {_TO_DAY} is null) = 0 as ok from raw_text", TEXT),
    "check_sales_numeric": raw(f"select count({_TO_NUM}) as numeric_rows, count({_TO_NUM}) > 0 as ok from raw_text", TEXT),
    "count_duplicates": raw("select cast(coalesce(sum(n), 0) as bigint) as duplicate_rows from (select count(*) as n from raw_sales group by date, family, store_nbr) where n > 1"),
    "check_negatives": raw("select count(*) filter (sales < 0) as negative_sales, count(*) filter (onpromotion < 0) as negative_promo from raw_sales"),
    "check_min_history": raw("select count(distinct date) as days, count(distinct date) >= 90 as enough from raw_sales"),
    "profile_raw": raw(
        f"""select 'rows' as stat, cast(count(*) as varchar) as value from raw_text
        union all select 'start', cast(min({_TO_DAY}) as varchar) from raw_text
        union all select 'end', cast(max({_TO_DAY}) as varchar) from raw_text
        union all select 'days', cast(count(distinct {_TO_DAY}) as varchar) from raw_text
        union all select 'null_cells', cast(sum({_TEXT_CELL}) as varchar) from raw_text
        union all select 'duplicate_rows', cast(coalesce(sum(n) filter (n > 1), 0) as varchar) from (select count(*) as n from raw_text group by date, family, store_nbr)
        union all select distinct 'family', family from raw_text
        union all select distinct 'store', store_nbr from raw_text""",
        TEXT,
    ),
    "panel_completeness": panel(
        """select count(distinct store_nbr) as stores, count(distinct family) as families, count(distinct date) as days, count(*) as actual_rows,
        count(distinct store_nbr) * count(distinct family) * count(distinct date) as expected_rows,
        count(distinct store_nbr) * count(distinct family) * count(distinct date) = count(*) as complete from panel"""
    ),
    "validation_report": raw(
        """select * from (
        select 'warning' as level, 'duplicate_rows' as code, cast(dups as bigint) as n from facts where dups > 0
        union all select 'warning', 'negative_sales', neg from facts where neg > 0
        union all select 'warning', 'negative_promo', negp from facts where negp > 0
        union all select 'warning', 'short_history', days from facts where days < 90
        union all select 'stat', 'rows', rows from facts union all select 'stat', 'days', days from facts
        union all select 'stat', 'null_cells', cast(null_cells as bigint) from facts union all select 'stat', 'duplicate_rows', cast(dups as bigint) from facts)""",
        _FACTS,
    ),
    "validation_report_errors": raw(f"select 'error' as level, 'bad_date' as code, count(*) as n from raw_text where date is not null and {_TO_DAY} is null", TEXT),
    "options": panel("select distinct 'family' as kind, family as value, family as label from panel union all select distinct 'store', cast(store_nbr as varchar), cast(store_nbr as varchar) from panel"),
    "forecast_request_check": panel(
        _CHECKED,
        _REQUESTS,
    ),
    "coerce_types": raw(
        f"""select {_TO_DAY} as date, cast(store_nbr as int) as store_nbr, family, {_TO_NUM} as sales,
        coalesce(try_cast(onpromotion as bigint), 0) as onpromotion from raw_text""",
        TEXT,
    ),
    "canonical_sort": panel("select * from panel order by store_nbr, family, date"),
    "merge_duplicates": raw("select date, family, store_nbr, coalesce(sum(sales), 0) as sales, cast(sum(onpromotion) as bigint) as onpromotion from raw_sales group by all"),
    "clip_negative": raw("select date, store_nbr, family, case when sales < 0 then 0 else sales end as sales, cast(case when onpromotion < 0 then 0 else onpromotion end as bigint) as onpromotion from raw_sales"),
    "max_missing_run": raw("select * from runs", GAPPED, RUNS),
    "fill_time_linear": raw("select date, family, store_nbr, round(by_line, 6) as sales, onpromotion from line", GAPPED, LINE),
    "fill_month_mean": raw("select date, family, store_nbr, round(by_month, 6) as sales, onpromotion from month_mean", GAPPED, MONTH_MEAN),
    "fill_median": raw("select date, family, store_nbr, round(by_median, 6) as sales, onpromotion from medians", GAPPED, MEDIANS),
    "fill_promo": panel(
        f"""select date, store_nbr, family, sales, coalesce(
        last_value(p ignore nulls) over ({_W} rows between unbounded preceding and current row),
        first_value(p ignore nulls) over ({_W} rows between current row and unbounded following), 0) as onpromotion
        from (select *, case when day(date) > 15 then onpromotion end as p from panel)"""
    ),
    "handle_missing": raw("select date, family, store_nbr, round(sales, 6) as sales, onpromotion from filled", GAPPED, *_GAP_VIEWS),
    "flag_events": panel("select p.*, e.date is not null as is_event from panel p left join event_days e on e.date = p.date", CALENDAR),
    "rolling_median7": raw(f"select date, family, store_nbr, round(median(sales) over ({_W} rows between 3 preceding and 3 following), 6) as med from merged", GAPPED, MERGED),
    "iqr_fence": raw(
        """select family, store_nbr, round(q3 + 3 * (q3 - q1), 6) as fence from (
        select family, store_nbr, quantile_cont(sales, 0.75) as q3, quantile_cont(sales, 0.25) as q1 from merged group by all)""",
        GAPPED, MERGED,
    ),
    "spike_candidates": spiked("select date, family, store_nbr, sales, med from z_marked where candidate"),
    "replace_spikes": spiked("select date, family, store_nbr, sales from z_done where is_outlier"),
    "handle_outliers": spiked("select * from z_done"),
    "clean": spiked("select * replace (round(sales, 6) as sales) from z_done"),
    "clean_keep_missing": spiked("select * replace (round(sales, 6) as sales) from z_done", "filled", _GAP_VIEWS),
    "load_events": v.with_views(f"select distinct date from order_calendar where {_KEEP}", ORDER_CALENDAR),
    "calendar_parts": panel(
        """select date, family, store_nbr, cast(year(date) as int) as year, cast(month(date) as int) as month, cast(day(date) as int) as day,
        cast(isodow(date) - 1 as int) as weekday, cast(isodow(date) >= 6 as int) as is_weekend, cast(week(date) as int) as week_of_year,
        cast(quarter(date) as int) as quarter, cast(day(last_day(date)) - day(date) as int) as days_to_monthend from panel"""
    ),
    "is_holiday": panel("select p.date, family, store_nbr, cast(e.date is not null as int) as is_holiday from panel p left join event_days e on e.date = p.date", CALENDAR),
    "lags": panel(f"select *, lag(sales, 7) over ({_W}) as sales_lag7, lag(sales, 14) over ({_W}) as sales_lag14, lag(sales, 30) over ({_W}) as sales_lag30 from panel"),
    "rolling_means": panel(
        f"""select * replace (round(sales, 6) as sales), round(avg(sales) over ({_W} rows between 6 preceding and current row), 6) as sales_rolling7_mean,
        round(avg(sales) over ({_W} rows between 29 preceding and current row), 6) as sales_rolling30_mean from panel"""
    ),
    "feature_engineering": panel(
        f"""select p.* replace (round(sales, 6) as sales), cast(year(p.date) as int) as year, cast(month(p.date) as int) as month, cast(day(p.date) as int) as day,
        cast(isodow(p.date) - 1 as int) as weekday, cast(isodow(p.date) >= 6 as int) as is_weekend, cast(week(p.date) as int) as week_of_year,
        cast(quarter(p.date) as int) as quarter, cast(day(last_day(p.date)) - day(p.date) as int) as days_to_monthend,
        cast(e.date is not null as int) as is_holiday,
        lag(sales, 7) over w as sales_lag7, lag(sales, 14) over w as sales_lag14, lag(sales, 30) over w as sales_lag30,
        round(avg(sales) over (partition by family, store_nbr order by p.date rows between 6 preceding and current row), 6) as sales_rolling7_mean,
        round(avg(sales) over (partition by family, store_nbr order by p.date rows between 29 preceding and current row), 6) as sales_rolling30_mean
        from panel p left join event_days e on e.date = p.date window w as (partition by family, store_nbr order by p.date)""",
        CALENDAR,
    ),
    "minmax_train": panel(
        """select * exclude (lo, hi) replace (round(sales, 6) as sales), round(lo, 6) as train_min, round(case when hi = lo then 1 else hi - lo end, 6) as train_range,
        round((sales - lo) / (case when hi = lo then 1 else hi - lo end), 6) as scaled from (select *,
        min(case when split = 'train' then sales end) over (partition by family, store_nbr) as lo,
        max(case when split = 'train' then sales end) over (partition by family, store_nbr) as hi from parts)""",
        _SPLIT, _CHRONO,
    ),
    "split_chrono": panel(_SPLIT_ROWS, _SPLIT, _CHRONO),
    "split_forecast": panel(_SPLIT_ROWS, _SPLIT, _FORECAST),
    "sliding_windows": panel(
        f"""select family, store_nbr, date, sales as label, first_value(sales) over ({_PAST}) as oldest, last_value(sales) over ({_PAST}) as newest,
        sum(sales) over ({_PAST}) as window_sum from panel qualify count(*) over ({_PAST}) = 30"""
    ),
    "align_regressor": panel("select date, store_nbr, family, sales, case when day(date) % 2 = 0 then onpromotion else 0 end as onpromotion from panel"),
    "floor_zero": raw("select date, family, store_nbr, case when sales = 0 then 0.01::double else sales end as y from merged", GAPPED, MERGED),
    "holiday_windows": v.with_views(
        f"""select distinct description as holiday, date + cast(o as int) as date from order_calendar, generate_series(-1, 1) as g(o)
        where {_KEEP} and (type = 'Holiday' or o = 0)""",
        ORDER_CALENDAR,
    ),
    "difference": panel(f"select date, family, store_nbr, sales - 2 * lag(sales, 1) over ({_W}) + lag(sales, 2) over ({_W}) as diff from panel"),
    "future_dates": panel(
        """select family, store_nbr, cast(k as int) as step, last_date + cast(k as int) as date
        from (select family, store_nbr, max(date) as last_date from panel group by all), generate_series(1, 30) as g(k)"""
    ),
    "future_regressor": panel(
        f"""select f.family, f.store_nbr, cast(k as int) as step, last_date + cast(k as int) as date, coalesce(onpromotion, 0) as onpromotion
        from (select family, store_nbr, max(date) as last_date from panel group by all) f cross join generate_series(1, 30) as g(k)
        left join (select family, store_nbr, onpromotion, 11 - row_number() over (partition by family, store_nbr order by date desc) as step from panel) p
          on p.family = f.family and p.store_nbr = f.store_nbr and p.step = k"""
    ),
    "safe_key": "select p_partkey, trim(regexp_replace(upper(concat_ws(',', p_type, p_name, p_brand)), '[^A-Z0-9]+', '_', 'g'), '_') as key from part",
    "sanitize_numbers": panel(
        """select date, family, store_nbr, round(case when onpromotion between 1 and 3 then sales / onpromotion end, 6) as as_null,
        round(case when onpromotion between 1 and 3 then sales / onpromotion else 0 end, 6) as as_zero from panel"""
    ),
    "label_join": panel("select distinct family, family as label from panel"),
    "daily_total": panel("select date, sum(sales) as sales from panel group by 1"),
    "by_family": panel("select family, sum(sales) as total_sales from panel group by 1"),
    "by_store": panel("select store_nbr, sum(sales) as total_sales from panel group by 1"),
    "totals_grouping_sets": panel(
        """select 'date' as kind, cast(date as varchar) as key, sum(sales) as total_sales from panel group by date
        union all select 'family', family, sum(sales) from panel group by family
        union all select 'store', cast(store_nbr as varchar), sum(sales) from panel group by store_nbr"""
    ),
    "by_family_store": panel(
        """select family, store_nbr, cast(count(*) as int) as n, min(date) as first_date, max(date) as last_date,
        arg_max(sales, date) as last_sales, sum(sales) as total_sales from panel group by all"""
    ),
    "dataset_summary": spiked(
        """select count(*) as total_rows, min(date) as start, max(date) as "end", count(distinct date) as days, count(distinct family) as family_count,
        count(distinct store_nbr) as store_count, count(*) filter (sales is null) as missing_after, count(*) filter (is_outlier) as outliers_replaced,
        count(*) filter (is_event) as outliers_kept, string_agg(distinct family, ',' order by family) as family_names, sum(sales) as total_sales,
        string_agg(distinct cast(store_nbr as varchar), ',' order by cast(store_nbr as varchar)) as store_list from z_done"""
    ),
    "overview": panel(
        f"""select total_sales, round(avg_daily_sales, 6) as avg_daily_sales, {_YOY_VALUE} as yoy_growth, family as best_family, family as best_family_label,
        best.sales as best_family_sales, start, "end", days, store_count, family_count from over_all, best, yoy""",
        _OVERVIEW, _YOY,
    ),
    "yoy_growth": panel(f"select year, previous_year, {_YOY_VALUE} as yoy_growth from yoy", _YOY),
    "best_family": panel("select family, family as label, sales from best", _OVERVIEW),
    "trend_daily": panel(_DAILY_BODY.format(where="true")),
    "trend_daily_one_series": panel(_DAILY_BODY.format(where="family = 'SMALL' and store_nbr = 4")),
    "trend_daily_or_weekly": panel(
        f"""select label, sales from (
          select strftime(d.d, '%Y-%m-%d') as label, coalesce(s, 0) as sales
          from (select cast(unnest(generate_series((select min(date) from panel), (select max(date) from panel), interval 1 day)) as date) as d) d
          left join (select date, sum(sales) as s from panel group by 1) t on t.date = d.d
          where (select count(distinct date) from panel) <= 365
          union all select label, sales from ({_WEEKLY_BODY}) where (select count(distinct date) from panel) > 365)""",
        _WEEKLY,
    ),
    "trend_weekly": panel(_WEEKLY_BODY, _WEEKLY),
    "trend_monthly": panel(_MONTHLY_BODY, _MONTHLY),
    "monthly_comparison": panel(f"select month, {_PIVOT} from month_long group by 1", _YEARS, _MONTH_LONG),
    "monthly_comparison_long": panel("select * from month_long", _YEARS, _MONTH_LONG),
    "category_share": panel("select family, family as label, sales, total, round(share, 6) as share from share", _SHARE),
    "top_families": panel("select family, family as label, sales, round(onpromotion_avg, 6) as onpromotion_avg from top_fam", _TOP),
    "correlation": panel(f"select family_1, family_2, {_CORR_OUT} as corr from pairs", _CORR),
    "weekday_pattern": panel("select weekday, round(avg_sales, 6) as avg_sales from week", _WEEKDAY),
    "seasonal_classical": panel(
        f"""select family, store_nbr, date, observed, round(trend + 1e-8, 6) as trend, round(seasonal + 1e-8, 6) as seasonal, round(observed - trend - seasonal + 1e-8, 6) as residual
        from (select *, avg(observed - trend) over (partition by family, store_nbr, rn % 7) as seasonal from (
          select family, store_nbr, date, sales as observed, row_number() over ({_W}) as rn,
            avg(sales) over ({_W} rows between 3 preceding and 3 following) as trend, count(*) over (partition by family, store_nbr) as n from panel)
          where n >= 14)"""
    ),
    "promo_effect": panel("select round(promo_avg, 6) as promo_avg, round(non_promo_avg, 6) as non_promo_avg, round(lift, 6) as lift from promo_all", _PROMO_ALL),
    "promo_effect_by_family": panel(
        "select family, family as label, round(promo_avg, 6) as promo_avg, round(non_promo_avg, 6) as non_promo_avg, round(lift, 6) as lift from promo_family", _PROMO_FAMILY
    ),
    "analysis_report": panel(_REPORT, _OVERVIEW, _YOY, _MONTHLY, _YEARS, _MONTH_LONG, _SHARE, _TOP, _CORR, _WEEKDAY, _PROMO_ALL, _PROMO_FAMILY),
}
