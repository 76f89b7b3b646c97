"""Reference SQL (DuckDB dialect) of the file queries."""

from __future__ import annotations

from shelfcast.plans import sql_views as v
from shelfcast.plans.sales_sql import ORACLES as SALES
from shelfcast.plans.sales_sql import panel, raw, spiked
from shelfcast.plans.sql_views import ORDER_CALENDAR, TEXT

_PATH = "store_nbr || '-' || substr(date, 1, 7) || '-sales.csv'"
_NULLS = "case when sales in ('NaN', 'n/a') then null else cast(sales as double) end"

ORACLES: dict[str, str] = {
    "read_sales_csv": raw(f"select date, store_nbr, family, {_NULLS} as sales, onpromotion from raw_text", TEXT),
    "detect_encoding": raw(
        f"""select distinct {_PATH} as path, case when coalesce(try_cast(substr(date, 6, 2) as int), 0) % 3 = 2 then 'gbk' else 'utf-8' end as encoding,
        'ok' as reason from raw_text""",
        TEXT,
    ),
    "file_gate": raw(
        """select distinct store_nbr || '-' || substr(date, 1, 7) || '-sales' || ['.csv', '.CSV', '.xls', '.xlsx', '.json'][cast(store_nbr as int)] as path,
        ['.csv', '.csv', '.xls', '.xlsx', '.json'][cast(store_nbr as int)] as suffix, store_nbr in ('1', '2') as accepted,
        ['ok', 'ok', 'save .xls as .xlsx or CSV first', 'land .xlsx as CSV or Parquet', 'file type not supported'][cast(store_nbr as int)] as reason from raw_text""",
        TEXT,
    ),
    "read_sales_files": raw(
        f"""select {_PATH} as path, 'ok' as reason, count(*) as rows, coalesce(sum({_NULLS}), 0) as sales,
        count(*) filter (date = 'bad-date') as bad_dates from raw_text group by 1""",
        TEXT,
    ),
    "read_landed": raw(
        f"""select store_nbr, case when cast(store_nbr as int) % 2 = 0 then 'gbk' else 'utf-8' end as encoding, 'ok' as reason, count(*) as rows, round(sum({_NULLS}), 2) as sales,
        count(*) filter (date = 'bad-date') as bad_dates, count(onpromotion) filter (cast(store_nbr as int) % 2 = 0) as promotions from raw_text group by 1""",
        TEXT,
    ),
    "extract_subset": panel("select * from panel where store_nbr in (1, 3, 5)"),
    "process": SALES["handle_outliers"],
    "upload_summary": raw(
        """select 's1' as session_id, total_rows, missing_before, cast(0 as bigint) as missing_after, round(total_rows / expected, 6) as completeness_rate,
        concat_ws(', ', case when merged > 0 then 'merged_rows (' || merged || ')' end, case when neg > 0 then 'negative_sales (' || neg || ')' end,
          case when negp > 0 then 'negative_promo (' || negp || ')' end, case when missing_before > 0 then 'missing_sales (' || missing_before || ')' end,
          case when expected > total_rows then 'incomplete_panel (' || (expected - total_rows) || ')' end, case when days < 90 then 'short_history (' || days || ')' end) as warnings
        from (select count(distinct (date, family, store_nbr)) as total_rows, count(*) - count(distinct (date, family, store_nbr)) as merged, count(*) filter (sales is null) as missing_before,
          count(*) filter (sales < 0) as neg, count(*) filter (onpromotion < 0) as negp, count(distinct date) as days,
          count(distinct date) * count(distinct family) * count(distinct store_nbr) as expected from raw_sales)"""
    ),
    "write_clean": SALES["handle_outliers"],
    "load_clean": SALES["panel"],
    "write_summary": spiked(
        """select 's1' as session_id, count(*) as total_rows, cast(min(date) as varchar) as start, cast(max(date) as varchar) as "end", count(distinct date) as days,
        count(distinct family) as family_count, count(distinct store_nbr) as store_count, count(*) filter (is_outlier) as outliers_replaced,
        count(*) filter (is_event) as outliers_kept, sum(sales) as total_sales, string_agg(distinct family, ',' order by family) as labels from z_done"""
    ),
    "write_daily_total": SALES["daily_total"],
    "read_calendar": v.with_views("select distinct date from order_calendar where type in ('Holiday','Event','Additional') and not transferred", ORDER_CALENDAR),
    "export_forecast": panel(
        """select family, store_nbr, model, date, sales as forecast, case when model = 'ARIMA' then sales * 0.5::double end as lower_ci, case when model = 'ARIMA' then sales * 1.5::double end as upper_ci
        from (select *, row_number() over (partition by family, store_nbr order by date desc) as back from panel), (values ('ARIMA'), ('LSTM')) as m(model) where model = 'LSTM' or back > 2"""
    ),
    "ingest_stream": SALES["handle_outliers"],
    "ingest_ledger": raw(
        """select landing, 'ok' as reason, (select count(*) from raw_sales) as rows from (values (cast(1 as bigint)), (cast(2 as bigint))) as t(landing)
        union all select cast(0 as bigint), 'clean', count(distinct (date, family, store_nbr)) from raw_sales"""
    ),
}
