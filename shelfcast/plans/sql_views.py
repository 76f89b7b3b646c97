"""Common table expressions shared by the reference SQL (DuckDB dialect)."""

from __future__ import annotations

PANEL = """panel as (
  select cast(l_shipdate as date) as date, cast(n_regionkey + 1 as int) as store_nbr, p_type as family,
         sum(l_quantity) as sales, cast(sum(case when l_discount > 0.085 then 1 else 0 end) as bigint) as onpromotion
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join part on l_partkey = p_partkey group by 1, 2, 3)"""

RAW = """raw_sales as (
  select date, store_nbr, family,
    case when store_nbr = 1 and family = 'PROMO' and day(date) = 10 then null
         when store_nbr = 2 and family = 'PROMO' and date between date '1997-03-01' and date '1997-03-25' then null
         when store_nbr = 3 and family = 'PROMO' and date between date '1998-01-01' and date '1998-12-31' then null
         when store_nbr = 4 and family = 'SMALL' and month(date) = 6 and day(date) = 10 then sales * 1000
         when store_nbr = 4 and family = 'SMALL' and month(date) = 6 and day(date) between 11 and 12 then sales * 100
         when store_nbr = 5 and family = 'LARGE' and day(date) = 1 then cast(-5 as double)
         else sales end as sales,
    case when store_nbr = 5 and family = 'LARGE' and day(date) = 1 then cast(-2 as bigint) else onpromotion end as onpromotion
  from panel
  union all
  select date, store_nbr, family, sales, onpromotion from panel where store_nbr = 1 and family = 'SMALL' and day(date) = 15)"""

TEXT = """raw_text as (
  select case when store_nbr = 3 and day(date) = 31 then 'bad-date' else cast(date as varchar) end as date,
    cast(store_nbr as varchar) as store_nbr, family,
    case when sales is null and store_nbr = 1 then 'NaN' when sales is null then 'n/a' else cast(sales as varchar) end as sales,
    case when store_nbr = 2 and day(date) = 5 then 'many' else cast(onpromotion as varchar) end as onpromotion
  from raw_sales)"""

CALENDAR = """calendar as (
  select cast(d as date) as date, type, locale, description, transferred from (values
    ('1995-12-25','Holiday','National','Xmas',false),
    ('1996-12-25','Holiday','National','Xmas',false),
    ('1997-12-25','Holiday','National','Xmas',true),
    ('1997-12-26','Transfer','National','Xmas moved',false),
    ('1998-12-25','Holiday','National','Xmas',false),
    ('1999-06-10','Event','National','Fair',false),
    ('2000-06-10','Additional','Local','Town day',false),
    ('2000-01-03','Work Day','National','Make-up',false),
    ('2000-12-26','Bridge','National','Bridge',false)) as v(d, type, locale, description, transferred)),
event_days as (select distinct date from calendar where type in ('Holiday','Event','Additional') and not transferred)"""

ORDER_CALENDAR = """order_calendar as (
  select cast(o_orderdate as date) as date,
    case o_orderpriority when '1-URGENT' then 'Holiday' when '2-HIGH' then 'Event' when '3-MEDIUM' then 'Additional'
      when '4-NOT SPECIFIED' then 'Transfer' else 'Work Day' end as type,
    'National' as locale, 'Event ' || cast(o_custkey % 100 as varchar) as description, o_orderstatus = 'P' as transferred
  from orders)"""

GAPPED = """gapped as (
  select date, family, store_nbr, case when s < 0 then 0 else s end as sales,
         cast(case when p < 0 then 0 else p end as bigint) as onpromotion
  from (select date, family, store_nbr, sum(sales) as s, sum(onpromotion) as p from raw_sales group by all))"""

MERGED = """merged as (select date, family, store_nbr, coalesce(sales, 0.0::double) as sales, onpromotion from gapped)"""

RUNS = """runs as (
  select family, store_nbr, max(run) as max_run from (
    select family, store_nbr, island, count(*) filter (sales is null) as run from (
      select *, count(sales) over (partition by family, store_nbr order by date) as island from gapped) group by all) group by all)"""

LINE = """line as (
  select g.*, coalesce(sales, case when d1 is null then s0
      else s0 + (s1 - s0) * (date_diff('day', d0, date)::double / date_diff('day', d0, d1)) end) as by_line
  from (select *,
      last_value(case when sales is not null then date end ignore nulls) over w as d0,
      last_value(sales ignore nulls) over w as s0,
      first_value(case when sales is not null then date end ignore nulls) over v as d1,
      first_value(sales ignore nulls) over v as s1
    from gapped
    window w as (partition by family, store_nbr order by date rows between unbounded preceding and current row),
           v as (partition by family, store_nbr order by date rows between current row and unbounded following)) g)"""

MONTH_MEAN = """month_mean as (
  select * exclude (carried), coalesce(sales, avg(carried) over (partition by family, store_nbr, month(date))) as by_month from (
    select *, last_value(sales ignore nulls) over (partition by family, store_nbr order by date
      rows between unbounded preceding and current row) as carried from gapped))"""

MEDIANS = """medians as (
  select *, coalesce(sales, quantile_cont(sales, 0.5) over (partition by family, store_nbr)) as by_median from gapped)"""

FILLED = """filled as (
  select date, family, store_nbr, onpromotion,
    coalesce(case when max_run <= 7 then by_line when max_run <= 30 then by_month else by_median end, 0) as sales
  from line join (select date, family, store_nbr, by_month from month_mean) using (date, family, store_nbr)
  join (select date, family, store_nbr, by_median from medians) using (date, family, store_nbr)
  join runs using (family, store_nbr))"""


def with_views(body: str, *views: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{', '.join(views)} {body}"
