"""Reference SQL (DuckDB dialect) of the forecast queries that SQL can state."""

from __future__ import annotations

import math

from shelfcast.operators.decompose import TAU_STATIONARY
from shelfcast.operators.forecast import CHANGE_RANGE, CHANGEPOINTS, WEEKLY, YEARLY, Z80, Z95
from shelfcast.plans.forecast_queries import GIVEN_BETA, GIVEN_CONST, GIVEN_EFFECTS, GIVEN_INTERCEPT, GIVEN_PHI, GIVEN_SIGMA2, GIVEN_SPREAD, GIVEN_THETA, GIVEN_WEIGHTS
from shelfcast.plans.sales_sql import _CHECKED, _FORECAST, _REQUESTS, _SPLIT, panel
from shelfcast.plans.sql_views import CALENDAR, PANEL, with_views

_W = "partition by family, store_nbr order by date"
_HISTORY = f"""history as (select *, avg(sales) over ({_W} rows between 7 preceding and 1 preceding) as mean7,
    lag(sales, 7) over ({_W}) as week, lag(sales, 1) over ({_W}) as day_before from parts where split <> 'val')"""
_PAIRS = """pairs as (select 'ARIMA' as model, family, store_nbr, date, sales as actual, mean7 as predicted from history where split = 'test' and week is not null
  union all select 'Prophet', family, store_nbr, date, sales, week from history where split = 'test' and week is not null
  union all select 'LSTM', family, store_nbr, date, sales, day_before from history where split = 'test' and week is not null)"""
_METRICS = """metrics as (select model, family, store_nbr, avg(abs(actual - predicted)) as mae, sqrt(avg((actual - predicted) * (actual - predicted))) as rmse,
    coalesce(avg(case when abs(actual) > 1e-8 then abs(actual - predicted) / abs(actual) end) * 100, 0) as mape,
    avg(2 * abs(actual - predicted) / (abs(actual) + abs(predicted) + 1e-8)) * 100 as smape,
    case when min(actual) = max(actual) then case when sum(abs(actual - predicted)) = 0 then 1 else 0 end
      else 1 - sum((actual - predicted) * (actual - predicted)) / nullif(sum((actual - m) * (actual - m)), 0) end as r2, count(*) as sample_size
  from (select *, avg(actual) over (partition by model, family, store_nbr) as m from pairs) group by 1, 2, 3)"""


def _inverted(c: str) -> str:
    w = "over (partition by family, store_nbr)"
    return f"case when max({c}) {w} = min({c}) {w} then 1.0::double else (max({c}) {w} - {c}) / (max({c}) {w} - min({c}) {w}) end"


_RANKED = f"""scored as (select *, case when count(*) over (partition by family, store_nbr) = 1 then 1.0::double
    else 0.5::double * ({_inverted('mape')}) + 0.3::double * ({_inverted('rmse')}) + 0.2::double * ({_inverted('mae')}) end as score from metrics),
  ranked as (select *, cast(row_number() over (partition by family, store_nbr order by score desc, mape, rmse, mae, model) as int) as rank from scored)"""
_BASE = (_SPLIT, _FORECAST, _HISTORY, _PAIRS)
_R = lambda *cs: ", ".join(f"round({c}, 6) as {c}" for c in cs)


def _metric(name: str) -> str:
    return panel(f"select model, family, store_nbr, round({name}, 6) as {name}, sample_size from metrics", *_BASE, _METRICS)


_SCALED7 = """scaled7 as (select *, (sales - lo) / rg as x, case when least(nt, nv) <= 7 then greatest(1, least(nt, nv) - 1) else 7 end as used from (
  select *, min(case when split = 'train' then sales end) over s as lo,
    case when max(case when split = 'train' then sales end) over s = min(case when split = 'train' then sales end) over s then 1
      else max(case when split = 'train' then sales end) over s - min(case when split = 'train' then sales end) over s end as rg,
    count(case when split = 'train' then 1 end) over s as nt, count(case when split = 'val' then 1 end) over s as nv
  from parts window s as (partition by family, store_nbr)) where n >= 30 and least(nt, nv) > 1)"""
_PADDED = "list_concat(list_transform(range(7 - len(past)), lambda i: past[1]), past)"
_GIVEN = f"{GIVEN_INTERCEPT}::double" + "".join(f" + w[{i}] * {x}::double" for i, x in enumerate(GIVEN_WEIGHTS, 1))
_TREES = """(case when w[7] <= 0.4037::double then 0.31::double when w[1] <= 0.2519::double then 0.52::double else 0.83::double end
  + 0.5::double * case when w[4] <= 0.3571::double then -0.05::double else 0.11::double end)"""


def _given_arma(source: str) -> tuple[str, str]:
    """One-step errors of the given model over (family, store_nbr, date, y): a recursion along each series' list of values."""
    (f1, f2), (t1, t2) = GIVEN_PHI, GIVEN_THETA
    const = f"case when store_nbr % 2 = 1 then {GIVEN_CONST[0]}::double else {GIVEN_CONST[1]}::double end"
    lists = f"""lists as (select family, store_nbr, days, y, w, c, c / (1 - {f1 + f2}::double) as mean from (
      select *, {const} as c, case when store_nbr % 2 = 1 then y else list_transform(range(1, len(y)), lambda i: y[i + 1] - y[i]) end as w
      from (select family, store_nbr, list(date order by date) as days, list(y order by date) as y from ({source}) group by 1, 2)))"""
    steps = f"""bases as (select *, list_transform(range(1, len(w) + 1), lambda i: w[i] - c - {f1}::double * case when i > 1 then w[i - 1] else mean end
        - {f2}::double * case when i > 2 then w[i - 2] else mean end) as base from lists),
    steps as (select family, store_nbr, base, 0 as k, 0.0::double as e1, 0.0::double as e2 from bases
      union all select family, store_nbr, base, k + 1, base[k + 1] - ({t1}::double * e1 + {t2}::double * e2), e1 from steps where k < len(base))"""
    return lists, steps


_ONE_STEP = """values as (select l.family, l.store_nbr, l.days[pos] as date, l.y[pos] as actual, case when l.store_nbr % 2 = 1 or pos > 1 then l.y[pos] - e1 else l.y[pos] end as value, pos
  from (select *, k + len(y) - len(w) as pos from steps join lists using (family, store_nbr) where k > 0
    union all select *, 1 from steps join lists using (family, store_nbr) where k = 0 and store_nbr % 2 = 0) l)"""
_AHEAD = f"""lasts as (select family, store_nbr, days[len(days)] as last_day, y[len(y)] as last_y, c, w[len(w)] as w1, w[len(w) - 1] as w2, e1, e2
    from steps join lists using (family, store_nbr) where k = len(base)),
  path as (select family, store_nbr, 0 as h, w1, w2, e1, e2, last_y, 0.0::double as v, 0.0::double as p1, 0.0::double as p2, 0.0::double as p3, 0.0::double as s from lasts
    union all select family, store_nbr, h + 1, nxt, w1, 0, e1, nxt_y, nxt_y, psi, p1, p2, s + psi * psi from (
      select *, case when store_nbr % 2 = 1 then nxt else last_y + nxt end as nxt_y from (
        select *, case when store_nbr % 2 = 1 then {GIVEN_CONST[0]}::double else {GIVEN_CONST[1]}::double end + {GIVEN_PHI[0]}::double * w1 + {GIVEN_PHI[1]}::double * w2
            + {GIVEN_THETA[0]}::double * e1 + {GIVEN_THETA[1]}::double * e2 as nxt,
          case h when 0 then 1.0::double when 1 then {GIVEN_THETA[0]}::double when 2 then {GIVEN_THETA[1]}::double else 0 end
            + case when store_nbr % 2 = 1 then {GIVEN_PHI[0]}::double * p1 + {GIVEN_PHI[1]}::double * p2
              else {1 + GIVEN_PHI[0]}::double * p1 + ({GIVEN_PHI[1]}::double - {GIVEN_PHI[0]}::double) * p2 - {GIVEN_PHI[1]}::double * p3 end as psi
        from path where h < 10)))"""
_LONG_SERIES = "select family, store_nbr, date, sales as y from parts where n >= 30"


def _given_arma_sql(body: str, source: str, *views: str) -> str:
    return with_views(body, PANEL, _SPLIT, _FORECAST, *_given_arma(source), *views, recursive=True)


def _unit_root(lag: int, source: str, name: str) -> str:
    """Statistic of the regression of the change on the value before and at most one change before it, from covariances."""
    cells = lambda *names: ", ".join(f"covar_pop({a}, {b}) * count(*) as {a}_{b}" for i, a in enumerate(names) for b in names[i:])
    rows = f"""select family, store_nbr, v0, change, lag(change) over ({_W}) as v1 from (
      select *, lag(y) over ({_W}) as v0, y - lag(y) over ({_W}) as change from ({source}) where y is not null)"""
    known = "v0 is not null" + (" and v1 is not null" if lag else "")
    left = lambda a, b: f"{a}_{b}" if not lag else f"({a}_{b} - {a}_v1 * {'v1_' + b if b != 'v0' else 'v0_v1'} / v1_v1)"
    names = ("v0", "v1", "change") if lag else ("v0", "change")
    return f"""{name} as (select family, store_nbr, n, slope / sqrt((cc - slope * vc) / ((n - {lag + 2}) * vv)) as statistic from (
      select *, vc / vv as slope from (select family, store_nbr, n, {left('v0', 'v0')} as vv, {left('v0', 'change')} as vc, {left('change', 'change') if not lag else '(change_change - v1_change * v1_change / v1_v1)'} as cc
        from (select family, store_nbr, count(*) as n, {cells(*names)} from ({rows}) where {known} group by 1, 2))))"""


_TERMS = [
    "1", "t", *(f"greatest(0, t - {CHANGE_RANGE * j / CHANGEPOINTS!r}::double)" for j in range(1, CHANGEPOINTS + 1)),
    *(f"{f}(day_no * {2 * math.pi * k / period!r}::double)" for period, count in ((365.25, YEARLY), (7.0, WEEKLY)) for k in range(1, count + 1) for f in ("sin", "cos")),
]
_PARTS = {"trend": (0, 2 + CHANGEPOINTS), "yearly": (2 + CHANGEPOINTS, 2 + CHANGEPOINTS + 2 * YEARLY), "weekly": (2 + CHANGEPOINTS + 2 * YEARLY, len(_TERMS))}
_EFFECT = "case holiday " + " ".join(f"when '{k}' then {x}::double" for k, x in GIVEN_EFFECTS.items()) + " else 0 end"


def _given_design(days: str) -> str:
    """Components of the given decomposable model over (family, store_nbr, date, first_day, last_day, actual)."""
    sums = ", ".join(f"{' + '.join(f'{GIVEN_BETA[i]!r}::double * {_TERMS[i]}' for i in range(*at))} as {name}" for name, at in _PARTS.items())
    return f"""effects as (select date, sum({_EFFECT}) as effect from (select distinct holiday, date from (
      select description as holiday, cast(date + unnest(case type when 'Holiday' then [-1, 0, 1] else [0] end) as date) as date from calendar where type in ('Holiday', 'Event', 'Additional') and not transferred)) group by 1),
    scored as (select s.*, coalesce(effect, 0) as holidays from (select *, {sums} from (
      select *, date_diff('day', first_day, date)::double / greatest(date_diff('day', first_day, last_day), 1) as t, date_diff('day', date '1970-01-01', date) as day_no from ({days}))) s left join effects using (date))"""


#: The mean size of the given bends.
GIVEN_BEND = sum(map(abs, GIVEN_BETA[2 : 2 + CHANGEPOINTS])) / CHANGEPOINTS
_SPAN = "select family, store_nbr, min(date) as first_day, max(date) as last_day from panel group by 1, 2 having count(*) >= 30"


def _loss(predicted: str) -> str:
    """Loss per part of a model given as an expression over the window w."""
    return panel(
        f"""select split, round(avg(({predicted} - x) * ({predicted} - x)), 6) as loss, count(*) as windows from (
          select *, {_PADDED} as w from (select * replace (past[len(past) - used + 1 : len(past)] as past) from (
            select *, list(x) over (partition by family, store_nbr, split order by date rows between 7 preceding and 1 preceding) as past from scaled7 where split <> 'test')) where len(past) = used) group by 1""",
        _SPLIT, _FORECAST, _SCALED7,
    )


def _recursion(predicted: str) -> str:
    """Ten days ahead, each prediction shifted into the window."""
    return with_views(
        f"""select family, store_nbr, cast(last_date + k as date) as date, round(greatest(y * rg + lo, 0), 6) as forecast from steps where k > 0""",
        PANEL, _SPLIT, _FORECAST, _SCALED7,
        f"""steps as (select family, store_nbr, last_date, lo, rg, 0 as k, {_PADDED} as w, cast(null as double) as y from (
            select family, store_nbr, max(date) as last_date, any_value(lo) as lo, any_value(rg) as rg, list(x order by date) as past
            from scaled7 where rn > n - used group by 1, 2)
          union all select family, store_nbr, last_date, lo, rg, k + 1, list_concat(w[2:7], [nxt]), nxt from (select *, {predicted} as nxt from steps where k < 10))""",
        recursive=True,
    )


def _backtest(predicted: str) -> str:
    """One-step predictions of the test part."""
    return panel(
        f"""select family, store_nbr, date, sales as actual, round(greatest(({predicted}) * rg + lo, 0), 6) as predicted from (
          select *, {_PADDED} as w from (select * replace (past[len(past) - used + 1 : len(past)] as past) from (
            select *, list(x) over ({_W} rows between 7 preceding and 1 preceding) as past from scaled7 where split <> 'val')) where split = 'test')""",
        _SPLIT, _FORECAST, _SCALED7,
    )


def _shape(rows: int = 30) -> str:
    """What each series that is long enough must show of a forecast."""
    return panel(
        f"""select family, store_nbr, cast({rows} as bigint) as rows, cast({rows} as bigint) as days, 1 as starts_after, {rows - 1} as span, cast(0 as bigint) as odd
        from panel group by 1, 2 having count(*) >= 30"""
    )


_TESTED = panel(
    """select family, store_nbr, count(*) as rows, min(date) as first_day, round(sum(sales), 6) as actual, cast(0 as bigint) as odd
    from parts where split = 'test' and n >= 30 group by 1, 2""",
    _SPLIT, _FORECAST,
)

ORACLES: dict[str, str] = {
    "forecast_status": panel(
        "select family, store_nbr, count(*) as days, case when count(*) < 30 then 'fewer than 30 days' else 'ok' end as reason from panel group by 1, 2"
    ),
    "arima_forecast_shape": _shape(),
    "decomposable_forecast_shape": _shape(),
    "window_forecast_shape": _shape(),
    "backtest_arima_shape": _TESTED,
    "backtest_decomposable_shape": _TESTED,
    "unit_root_lag0": panel(
        f"select family, store_nbr, n, round(statistic, 6) as statistic, statistic < {TAU_STATIONARY}::double as is_stationary from root", _unit_root(0, "select *, sales as y from panel", "root")
    ),
    "unit_root_lag1": panel(
        f"select family, store_nbr, n, round(statistic, 6) as statistic, statistic < {TAU_STATIONARY}::double as is_stationary from root", _unit_root(1, "select *, sales as y from panel", "root")
    ),
    "difference_order_lag1": panel(
        f"""select family, store_nbr, case when a.statistic < {TAU_STATIONARY}::double then 0 when b.statistic < {TAU_STATIONARY}::double then 1 else 2 end as d
        from root a join step_root b using (family, store_nbr)""",
        _unit_root(1, "select *, sales as y from panel", "root"), _unit_root(1, f"select *, sales - lag(sales) over ({_W}) as y from panel", "step_root"),
    ),
    "decomposable_given": panel(
        f"""select family, store_nbr, date, round(greatest(exp(total), 0), 6) as forecast, round(greatest(exp(total - wide), 0), 6) as lower_ci,
          round(greatest(exp(total + wide), 0), 6) as upper_ci, round(exp(trend), 6) as trend, round(exp(weekly) - 1, 6) as weekly, round(exp(yearly) - 1, 6) as yearly,
          round(exp(holidays) - 1, 6) as holidays from (select *, trend + yearly + weekly + holidays as total,
            {Z80!r}::double * sqrt({GIVEN_SPREAD**2!r}::double + {2 * CHANGEPOINTS / 3 * GIVEN_BEND**2!r}::double * greatest(t - 1, 0) ** 3) as wide from scored)""",
        CALENDAR, _given_design(f"select family, store_nbr, cast(last_day + cast(h as int) as date) as date, first_day, last_day from ({_SPAN}), (select unnest(range(1, 11)) as h)"),
    ),
    "decomposable_history_given": panel(
        """select family, store_nbr, date, actual, round(greatest(trend + yearly + weekly + holidays, 0), 6) as forecast, round(holidays, 6) as holidays, round(weekly, 6) as weekly from scored""",
        CALENDAR,
        _given_design("select family, store_nbr, date, sales as actual, min(date) over (partition by family, store_nbr) as first_day, max(date) over (partition by family, store_nbr) as last_day from panel"),
    ),
    "backtest_decomposable_given": panel(
        "select family, store_nbr, date, actual, round(greatest(exp(trend + yearly + weekly + holidays), 0), 6) as predicted from scored",
        _SPLIT, _FORECAST, CALENDAR,
        _given_design(
            """select * exclude (split) from (select family, store_nbr, date, sales as actual, split, min(case when split = 'train' then date end) over (partition by family, store_nbr) as first_day,
              max(case when split = 'train' then date end) over (partition by family, store_nbr) as last_day from parts where n >= 30) where split = 'test'"""
        ),
    ),
    "changepoints_given": panel(
        f"""select family, store_nbr, cast(first_day + cast(round(date_diff('day', first_day, last_day) * j * {CHANGE_RANGE / CHANGEPOINTS!r}::double) as int) as date) as date,
          round(list_extract({GIVEN_BETA[2:2 + CHANGEPOINTS]}, j)::double, 6) as delta
        from (select family, store_nbr, min(date) as first_day, max(date) as last_day from panel group by 1, 2), (select unnest(range(1, {CHANGEPOINTS + 1})) as j)"""
    ),
    "window_loss_given": _loss(_GIVEN),
    "tree_loss_given": _loss(_TREES),
    "arima_given": _given_arma_sql(
        f"""select family, store_nbr, cast(last_day + h as date) as date, round(greatest(v, 0), 6) as value, round(greatest(v - {Z95}::double * se, 0), 6) as lower_ci,
          round(greatest(v + {Z95}::double * se, 0), 6) as upper_ci from (select *, sqrt({GIVEN_SIGMA2}::double * s) as se from path join (select family, store_nbr, last_day from lasts) using (family, store_nbr)) where h > 0""",
        _LONG_SERIES, _AHEAD,
    ),
    "fitted_given": _given_arma_sql("select family, store_nbr, cast(date as date) as date, actual, round(greatest(value, 0), 6) as value from values", _LONG_SERIES, _ONE_STEP),
    "backtest_arima_given": _given_arma_sql(
        "select v.family, v.store_nbr, cast(v.date as date) as date, actual, round(greatest(value, 0), 6) as value from values v join parts p on p.family = v.family and p.store_nbr = v.store_nbr and p.date = v.date where split = 'test'",
        _LONG_SERIES + " and split <> 'val'", _ONE_STEP,
    ),
    "recursive_forecast_given": _recursion(_GIVEN),
    "tree_recursion_given": _recursion(_TREES),
    "backtest_window_given": _backtest(_GIVEN),
    "tree_backtest_given": _backtest(_TREES),
    "seasonal_decomposition_sums": panel(
        """select family, store_nbr, count(*) as rows, round(sum(sales), 6) as observed, cast(0 as bigint) as odd from panel group by 1, 2
        having count(*) >= 14 and min(sales) < max(sales)"""
    ),
    "fitted_vs_actual_shape": panel(
        "select family, store_nbr, count(*) as rows, round(sum(greatest(sales, 0)), 6) as actual, cast(0 as bigint) as odd from panel group by 1, 2 having count(*) >= 30"
    ),
    "order_search_range": panel("select family, store_nbr, true as in_range from panel group by 1, 2 having count(*) >= 30"),
    "adf_stationarity_rows": panel(
        """select family, store_nbr, cast(count(*) as int) as n, case when count(*) < 20 then 'series too short' when min(sales) = max(sales) then 'constant series' else 'ok' end as reason,
        count(*) >= 20 and min(sales) < max(sales) as agree from panel group by 1, 2"""
    ),
    "series_fingerprint_classes": panel("select family, store_nbr, true as stable, store_nbr % 2 = 1 as changed from panel group by 1, 2"),
    "forecast_by_request": panel(
        f"""select c.request_id, c.reason, m.model, case when m.model is not null then cast(r.horizon as bigint) end as rows,
          cast(s.last_day + 1 as date) as first_day, cast(s.last_day + r.horizon as date) as last_day, case when m.model is not null then cast(0 as bigint) end as negative
        from ({_CHECKED}) c join requests r using (request_id)
        left join (values ('ARIMA'), ('Prophet')) as m(model) on c.ok
        left join (select family, store_nbr, max(date) as last_day from panel group by 1, 2) s on c.ok and s.family = r.family and s.store_nbr = r.store_nbr""",
        _REQUESTS,
    ),
    "request_ranking": panel(
        f"""select family, store_nbr, model, {_R('mae', 'rmse', 'mape', 'smape', 'r2')}, sample_size, 1.0::double as score, 1 as rank from metrics""",
        _SPLIT, _FORECAST, _HISTORY,
        "pairs as (select 'ARIMA' as model, family, store_nbr, date, sales as actual, greatest(mean7, 0) as predicted from history where split = 'test' and n >= 30)", _METRICS,
    ),
    "results_reuse": panel(
        """select model, family, store_nbr, false as hit1, true as hit2, not (store_nbr = 2 and family = 'PROMO') as hit3, cast(14 as bigint) as rows1, cast(30 as bigint) as rows2,
          cast(14 as bigint) as rows3, true as same2, true as same3
        from (select family, store_nbr from panel group by 1, 2 having count(*) >= 30), (values ('ARIMA'), ('Prophet'), ('LSTM')) as m(model)"""
    ),
    "decomposition_status": panel(
        """select family, store_nbr, count(*) as days, case when count(*) < 14 then 'series too short' when min(sales) = max(sales) then 'constant series' else 'ok' end as reason
        from panel group by 1, 2"""
    ),
    "backtest_rolling_mean": panel(
        "select family, store_nbr, date, sales as actual, round(case when mean7 < 0 then 0 else mean7 end, 6) as predicted from history where split = 'test' and n >= 30", *_BASE
    ),
    "recent_window": panel(
        """select family, store_nbr, max(date) as last_date, cast(count(*) as int) as size, round(arg_min(x, date), 6) as oldest, round(arg_max(x, date), 6) as newest, round(sum(x), 6) as window_sum
        from (select *, (sales - lo) / (case when hi = lo then 1 else hi - lo end) as x, case when least(nt, nv) <= 30 then greatest(1, least(nt, nv) - 1) else 30 end as used from (select *,
          min(case when split = 'train' then sales end) over s as lo, max(case when split = 'train' then sales end) over s as hi,
          count(case when split = 'train' then 1 end) over s as nt, count(case when split = 'val' then 1 end) over s as nv
          from parts window s as (partition by family, store_nbr))) where rn > n - used and n >= 30 and least(nt, nv) > 1 group by 1, 2""",
        _SPLIT, _FORECAST,
    ),
    "short_series_window": panel(
        """select *, cast(case when least(n_train, n_val) <= 1 then 0 when least(n_train, n_val) <= 60 then greatest(1, least(n_train, n_val) - 1) else 60 end as int) as "window",
        case when least(n_train, n_val) <= 1 then 'series too short' else 'ok' end as reason from (
          select family, store_nbr, count(*) filter (split = 'train') as n_train, count(*) filter (split = 'val') as n_val from parts group by 1, 2)""",
        _SPLIT, _FORECAST,
    ),
    "skip_unchanged": panel(
        """select model, family, store_nbr, model <> 'LSTM' and (store_nbr <> 2 or last_date < date '2001-01-01') as cache_hit
        from (select family, store_nbr, max(date) as last_date from panel group by 1, 2), (values ('ARIMA'), ('Prophet'), ('LSTM')) as m(model)"""
    ),
    "align_pairs": panel(
        f"""select family, store_nbr, date, cast(pos as int) as pos, actual, round(predicted, 6) as predicted from (
          select family, store_nbr, date, sales as actual, mean7 as predicted, row_number() over ({_W}) as pos,
            row_number() over (partition by family, store_nbr order by date desc) as back from history where split = 'test' and n >= 30) where back > 3""",
        *_BASE,
    ),
    "mae": _metric("mae"),
    "rmse": _metric("rmse"),
    "mape": _metric("mape"),
    "smape": _metric("smape"),
    "r2": _metric("r2"),
    "compute_all": panel(f"select model, family, store_nbr, {_R('mae', 'rmse', 'mape', 'smape', 'r2')}, sample_size from metrics", *_BASE, _METRICS),
    "compare_models": panel(f"select model, family, store_nbr, {_R('mae', 'rmse', 'mape', 'smape', 'r2', 'score')}, sample_size, rank from ranked", *_BASE, _METRICS, _RANKED),
    "radar": panel(
        "select model, family, store_nbr, indicator, round(value + 1e-8, 6) as value from ("
        + " union all ".join(f"select model, family, store_nbr, '{m}' as indicator, {_inverted(m)} as value from metrics" for m in ("mae", "rmse", "mape", "smape"))
        + " union all select model, family, store_nbr, 'r2', greatest(0, least(1, r2)) from metrics)",
        *_BASE, _METRICS,
    ),
    "best_model": panel("select family, store_nbr, model as best_model, round(mape, 6) as mape from ranked where rank = 1", *_BASE, _METRICS, _RANKED),
    "metric_bars": panel(
        " union all ".join(f"select family, store_nbr, rank, model, '{m}' as metric, round({m}, 6) as value from ranked" for m in ("mae", "rmse", "mape")),
        *_BASE, _METRICS, _RANKED,
    ),
    "evaluation_report": panel(
        """select family, store_nbr, family as label, 30 as forecast_days, cast(count(*) as int) as models, max(case when rank = 1 then model end) as best_model,
        round(max(case when rank = 1 then mape end), 6) as best_mape, round(arg_max(score, rank), 6) as last_score from ranked group by 1, 2""",
        *_BASE, _METRICS, _RANKED,
    ),
    "actual_vs_predicted": panel(
        """select family, store_nbr, date, model as name, round(coalesce(predicted, 0), 6) as value from pairs
        union all select family, store_nbr, date, 'actual', actual from pairs where model = 'ARIMA'""",
        *_BASE,
    ),
}
