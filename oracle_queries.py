"""The registered queries again, as SQL written directly on the raw tables.

The payload-based queries are stated on the events themselves, so the SQL
shares nothing with the JSON code that it checks.
"""

# Hourly forecasts of events: three runs per hour, one per day of lead.
_RUNS = """
with hourly as (
  select cast(user_id as varchar) as city, cast(ts as date) as day, hour(ts) as hour,
         floor(max(value) * 4) / 4 as high, min(value) as low, cast(max(user_id) as double) as wind,
         max(cast(json_extract_string(props, '$.k') as double)) as k
  from events group by all),
runs as (
  select city, day, day + to_hours(hour) as valid, cast(day - lead as timestamp) as made,
         if(lead = 2 and hour % 11 = 0, null, high + 0.25 * lead) as temp, k, low, wind
  from hourly cross join (values (0), (1), (2)) as leads(lead)),
history as (from runs where temp is not null),
latest as (from history where (city, made) in (select (city, max(made)) from runs group by city))
"""


def _gold_daily(source: str, rain: str) -> str:
    return f"""
  select city, 'XX' as country, day as forecast_date, md5(concat(city, '|', day)) as city_date_key,
         round(avg(temp), 1) as avg_temperature_c, round(avg(k), 1) as avg_humidity_pct,
         round(min(temp), 1) as min_temperature_c, round(max(temp), 1) as max_temperature_c,
         {rain} as total_precipitation_mm, max(wind) as max_wind_speed_kmh,
         max(made) as last_ingested_at
  from {source} group by city, day"""


def _gold_hourly(source: str) -> str:
    return f"""
  select city, 'XX' as country, valid as forecast_time, temp as temperature_c,
         made as last_ingested_at, md5(concat(city, '|', valid)) as city_hour_key from {source}"""


# Without a precipitation array, and with one that holds the hour's low.
_DRY, _RAIN = "cast(null as double)", "round(sum(low), 2)"
_GOLD = f"{_RUNS}, gold as ({_gold_daily('history', _RAIN)})"

# Daily observations of events after the second run corrected the first.
_ACTUALS = """
with daily as (
  select cast(user_id as varchar) as city, cast(ts as date) as day, max(value) as high, min(value) as low,
         cast(count(*) as double) as n
  from events group by 1, 2),
actuals as (
  select city, 'XX' as country, day as observed_date,
         case when second then high + 0.5 else high end as temperature_mean_c,
         high + 1 as temperature_max_c, low as temperature_min_c, low as precipitation_mm,
         n as wind_speed_max_kmh,
         case when second then timestamp '2024-02-11' else timestamp '2024-02-10' end as ingested_at
  from (select *, day(day) > 16 and day(day) % 3 <> 0 as second from daily))
"""

# Order prices per customer and day, with the features of each day.
_FEATURES = """
with daily as (
  select c_name as city, cast(o_orderdate as date) as observed_date,
         max(o_totalprice) as temperature_mean_c, min(o_totalprice) as precipitation_mm,
         cast(count(*) as double) as wind_speed_max_kmh
  from orders join customer on o_custkey = c_custkey group by 1, 2),
features as (
  select city, observed_date, temperature_mean_c,
         lag(temperature_mean_c, 1) over days as temp_lag_1,
         lag(temperature_mean_c, 2) over days as temp_lag_2,
         lag(temperature_mean_c, 3) over days as temp_lag_3,
         lag(temperature_mean_c, 7) over days as temp_lag_7,
         case when count(temperature_mean_c) over prior = 7
              then avg(temperature_mean_c) over prior end as temp_rolling_mean_7,
         case when count(temperature_mean_c) over prior = 7
              then stddev_samp(temperature_mean_c) over prior end as temp_rolling_std_7,
         lag(precipitation_mm, 1) over days as precip_lag_1,
         lag(wind_speed_max_kmh, 1) over days as wind_lag_1,
         sin(2 * pi() * dayofyear(observed_date) / 365.25) as doy_sin,
         cos(2 * pi() * dayofyear(observed_date) / 365.25) as doy_cos,
         lead(temperature_mean_c, 1) over days as target_temperature_next_day_c
  from daily
  window days as (partition by city order by observed_date),
         prior as (partition by city order by observed_date
                   rows between 7 preceding and 1 preceding)),
complete as (
  select * from features
  where temp_lag_1 is not null and temp_lag_2 is not null and temp_lag_3 is not null
    and temp_lag_7 is not null and temp_rolling_mean_7 is not null
    and temp_rolling_std_7 is not null and precip_lag_1 is not null
    and wind_lag_1 is not null and target_temperature_next_day_c is not null),
train as (select * from complete
          where observed_date <= (select max(observed_date) - 90 from complete)),
test as (select * from complete
         where observed_date > (select max(observed_date) - 90 from complete)),
persistence as (
  select 'persistence_baseline' as model_name, city, observed_date,
         target_temperature_next_day_c as actual_c, temperature_mean_c as predicted_c from test),
baselines as (
  select * from persistence union all
  select 'same_day_last_week', city, observed_date, target_temperature_next_day_c, temp_lag_7
  from test),
metrics as (
  select model_name, round_even(avg(abs(predicted_c - actual_c)), 3) as mae_c,
         round_even(sqrt(avg((predicted_c - actual_c) * (predicted_c - actual_c))), 3) as rmse_c,
         count(*) as n_test_rows
  from baselines group by model_name)
"""


# How daily forecasts (city, day, made, temp) differ from what was observed.
_ACCURACY = """
accuracy as (
  select city, day as forecast_date, made as forecast_made_on,
         cast(day - made as integer) as lead_time_days, temp as forecast_temperature_c,
         temperature_mean_c as actual_temperature_c, abs(temp - temperature_mean_c) as abs_error_c
  from forecasts join actuals using (city) where day = observed_date)"""

# Line prices as forecasts for a supplier's ship day, made on the order day.
_LINES = f"""
with lines as (
  select cast(l_suppkey as varchar) as city, cast(l_shipdate as date) as day, l_extendedprice,
         cast(o_orderdate as date) as made
  from lineitem join orders on l_orderkey = o_orderkey),
actuals as (
  select city, day as observed_date, max(l_extendedprice) as temperature_mean_c
  from lines group by all),
forecasts as (select city, day, made, avg(l_extendedprice) as temp from lines group by all),
{_ACCURACY}
"""

_ROUNDED_ACCURACY = """
select city, forecast_date, forecast_made_on, lead_time_days,
       round(round(forecast_temperature_c, 7), 4) as forecast_temperature_c, actual_temperature_c,
       round(round(abs_error_c, 7), 4) as abs_error_c
from accuracy"""

_CITIES = """
  select cast(user_id as varchar) as city, 'XX' as country, max(value) as latitude,
         min(value) as longitude
  from events group by user_id"""

# One answer per user and ingestion day.
_ANSWERS = """
  select distinct cast(user_id as varchar) as city, cast(ts as date) - lead as ingest_day
  from events cross join (values (0), (1), (2)) as leads(lead)"""

_JUDGED = f"""
with cities as ({_CITIES}),
fetched as (
  select city, day(ingest_day) as d,
         cast(case when day(ingest_day) % 7 = 0 then 503
                   when day(ingest_day) % 5 <> 0 then 200 end as integer) as status
  from ({_ANSWERS})),
judged as (
  select *, case when city = '4' then 'unknown city'
                 when status is null then 'no answer'
                 when status >= 400 then 'status ' || cast(status as varchar)
                 when d % 9 = 0 then 'body is not JSON' end as reason
  from fetched)
"""

_SLICE = """city in ('1', '2', '3')
  and {day} between date '2024-01-08' and date '2024-01-21'"""

# Column as shown, and what holds it in the runs.
_UNPACKED = {
    "city": "city",
    "country": "city",
    "latitude": "city",
    "longitude": "city",
    "ingested_at": "made",
    "forecast_time_raw": "valid",
    "temperature_c": "temp",
    "relative_humidity_pct": "k",
    "precipitation_mm": "cast(null as double)",
    "wind_speed_kmh": "wind",
}

_DECLARED = {
    "gold.gold_weather_daily": (
        "days",
        ["city_date_key", "city", "forecast_date", "avg_temperature_c"],
        ["city_date_key"],
    ),
    "gold.gold_weather_hourly": (
        "hours",
        ["city_hour_key", "city", "forecast_time", "temperature_c"],
        ["city_hour_key"],
    ),
    "silver.stg_weather_hourly": (
        "newest",
        ["city", "forecast_time", "temperature_c", "wind_speed_kmh"],
        [],
    ),
    "silver.stg_weather_hourly_history": (
        "every_run",
        ["city", "forecast_time", "ingested_at", "temperature_c"],
        [],
    ),
    "silver.stg_weather_historical_daily": (
        "actuals",
        ["city", "observed_date", "temperature_mean_c"],
        [],
    ),
}


def _not_null(table: str, source: str, column: str, shown: str | None = None) -> str:
    return f"""select '{table}' as "table", '{shown or column}' as "column",
      'not_null' as "check", count(*) - count({column}) as failures from {source}"""


def _unique(table: str, source: str, column: str) -> str:
    return f"""select '{table}' as "table", '{column}' as "column", 'unique' as "check",
      count(*) as failures
      from (select {column} from {source} where {column} is not null
            group by {column} having count(*) > 1)"""


def _declared_checks() -> str:
    checks = []
    for table, (source, not_null, unique) in _DECLARED.items():
        checks += [_not_null(table, source, column) for column in not_null]
        checks += [_unique(table, source, column) for column in unique]
    return " union all ".join(checks)


_FORECAST_REQUEST = """
       'temperature_2m,relative_humidity_2m,precipitation,wind_speed_10m' as hourly,
       cast(16 as integer) as forecast_days, 'auto' as timezone"""
_ARCHIVE_REQUEST = """
       '2024-02-11' as start_date, '2024-02-25' as end_date,
       'temperature_2m_mean,temperature_2m_max,temperature_2m_min,precipitation_sum,wind_speed_10m_max'
         as daily, 'auto' as timezone"""


def _silver(source: str) -> str:
    return f"""select city, 'XX' as country, 0::double as latitude, 0::double as longitude,
       valid as forecast_time, temp as temperature_c, k as relative_humidity_pct,
       null::double as precipitation_mm, wind as wind_speed_kmh, made as ingested_at
  from {source}"""


_INPUTS = """unnest(['intercept', 'temp_lag_1', 'temp_lag_2', 'temp_lag_3', 'temp_lag_7',
       'temp_rolling_mean_7', 'temp_rolling_std_7', 'precip_lag_1', 'wind_lag_1',
       'doy_sin', 'doy_cos'])"""

_SLICE_DAILY = f"""{_GOLD}
select *, avg_temperature_c * 9 / 5 + 32 as avg_temperature_display,
       min_temperature_c * 9 / 5 + 32 as min_temperature_display,
       max_temperature_c * 9 / 5 + 32 as max_temperature_display
from gold where {_SLICE.format(day='forecast_date')}"""

# Every feature by its place, and the features of a row one below the other.
_COLUMNS = [
    "temp_lag_1", "temp_lag_2", "temp_lag_3", "temp_lag_7", "temp_rolling_mean_7",
    "temp_rolling_std_7", "precip_lag_1", "wind_lag_1", "doy_sin", "doy_cos",
]


def _long(part: str) -> str:
    return " union all ".join(
        f"select city, observed_date, {k} as f, {c} as x from {part}"
        for k, c in enumerate(_COLUMNS)
    )


def _boosted(rounds: int) -> str:
    """Trees of one split each: the best of 255 quantiles per feature, leaves shrunk by 1."""
    text = f"""{_FEATURES},
train_long as ({_long('train')}), test_long as ({_long('test')}),
cuts as (
  select distinct f, unnest(quantile_disc(x, [k / 256 for k in range(1, 256)])) as cut
  from train_long group by f),
size as (
  select 4 * max(abs(target_temperature_next_day_c)) / 1073741824 as step,
         avg(target_temperature_next_day_c) as base from train),
train0 as (select city, observed_date, target_temperature_next_day_c as y, base as now
           from train, size),
test0 as (select city, observed_date, base as now from test, size)"""
    for r in range(rounds):
        text += f""",
left{r} as (
  select f, cut, sum(g) * any_value(step) as lg, count(*) as ln
  from (select city, observed_date, round_even((now - y) / step, 0) as g, step from train{r}, size)
  join train_long using (city, observed_date) join cuts using (f) where x < cut group by f, cut),
whole{r} as (
  select sum(round_even((now - y) / step, 0)) * any_value(step) as wg, count(*) as wn
  from train{r}, size),
best{r} as (
  select *, wg - lg as rg, wn - ln as rn from left{r}, whole{r} where ln < wn
  order by lg * lg / (ln + 1) + rg * rg / (rn + 1) - wg * wg / (wn + 1) desc, f, cut limit 1)"""
        for part, shown in (("train", "y, "), ("test", "")):
            text += f""",
{part}{r + 1} as (
  select city, observed_date, {shown}now
         + case when x < cut then -0.05::double * lg / (ln + 1) else -0.05::double * rg / (rn + 1) end as now
  from {part}{r} join {part}_long using (city, observed_date) join best{r} using (f))"""
    return f"{text} select city, observed_date, round(now, 4) as predicted_c from test{rounds}"


ORACLES = {
    "json_zip": f"""{_RUNS}
select city, made as ingested_at, strftime(valid, '%Y-%m-%dT%H:%M') as forecast_time_raw,
       temp as temperature_c, k as relative_humidity_pct, null::double as precipitation_mm,
       wind as wind_speed_kmh from runs""",
    "latest_snapshot": """
select o_custkey, o_orderdate, o_orderkey
from (select *, rank() over (partition by o_custkey order by o_orderdate desc) as r from orders)
where r = 1""",
    "silver_hourly": f"{_RUNS} {_silver('latest')}",
    "silver_hourly_history": f"{_RUNS} {_silver('history')}",
    "gold_daily": f"{_RUNS} {_gold_daily('latest', _DRY)}",
    "gold_daily_all_runs": f"{_RUNS} {_gold_daily('history', _RAIN)}",
    "gold_daily_ordered": f"{_RUNS} {_gold_daily('history', _RAIN)} order by forecast_date, city",
    "gold_hourly": f"{_RUNS} {_gold_hourly('latest')}",
    "attach_city": f"select * from ({_ANSWERS}) join ({_CITIES}) using (city)",
    "dedupe_latest": """
select event_type, user_id, ts, event_id, value
from (select *, row_number() over (partition by event_type, user_id
                                   order by ts desc, event_id desc) as r from events)
where r = 1""",
    "archive_runs": """
with daily as (select distinct cast(user_id as varchar) as city, cast(ts as date) as day from events)
select timestamp '2024-02-10' as ingested_at, city, 'XX' as country,
       cast(date_trunc('month', day) as date) as start_date, max(day) as end_date
from daily group by city, date_trunc('month', day)
union all
select timestamp '2024-02-11', city, 'XX', cast(date_trunc('month', day) as date), max(day)
from daily where day(day) > 16 group by city, date_trunc('month', day)""",
    "silver_daily_actuals": f"{_ACTUALS} select * from actuals",
    "dq_not_null": _RUNS
    + " union all ".join(
        _not_null("hourly_rows", "runs", held, shown) for shown, held in _UNPACKED.items()
    ),
    "dq_unique": f"""{_RUNS}, keyed as ({_gold_hourly('history')})
{_unique('all_runs', 'keyed', 'city_hour_key')}""",
    "dq_report": f"""{_RUNS}, {_ACTUALS.strip().removeprefix('with')},
days as ({_gold_daily('latest', _DRY)}), hours as ({_gold_hourly('latest')}),
newest as ({_silver('latest')}), every_run as ({_silver('history')})
{_declared_checks()}""",
    "features_lag": f"""{_FEATURES}
select city, observed_date, temp_lag_1, temp_lag_2, temp_lag_3, temp_lag_7, precip_lag_1,
       wind_lag_1 from features""",
    "features_rolling": f"""{_FEATURES}
select city, observed_date, round(temp_rolling_mean_7, 4) as temp_rolling_mean_7,
       round(temp_rolling_std_7, 4) as temp_rolling_std_7 from features""",
    "features_seasonal": f"""{_FEATURES}
select city, observed_date, round(doy_sin, 4) as doy_sin, round(doy_cos, 4) as doy_cos
from features""",
    "features_target": f"""{_FEATURES}
select city, observed_date, target_temperature_next_day_c from features""",
    "split_train": f"""{_FEATURES}
select city, observed_date, temperature_mean_c, temp_lag_7, target_temperature_next_day_c
from train""",
    "split_test": f"""{_FEATURES}
select city, observed_date, temperature_mean_c, temp_lag_7, target_temperature_next_day_c
from test""",
    "split_summary": f"""{_FEATURES}
select 'train' as part, count(*) as rows, count(distinct city) as cities from train
union all select 'test', count(*), count(distinct city) from test""",
    "lead_time_accuracy": f"{_LINES} {_ROUNDED_ACCURACY}",
    "lead_time_curve": f"""{_LINES}
select lead_time_days, round(round(avg(abs_error_c), 7), 4) as mean_absolute_error_c,
       count(abs_error_c) as n_observations
from accuracy group by lead_time_days order by lead_time_days""",
    "payload_accuracy": f"""{_RUNS}, {_ACTUALS.strip().removeprefix('with')},
forecasts as (
  select city, day, cast(made as date) as made, avg(temp) as temp from history group by all),
{_ACCURACY} {_ROUNDED_ACCURACY}""",
    "persistence_predictions": f"{_FEATURES} select * from persistence",
    "persistence_eval": f"""{_FEATURES}
select * from metrics where model_name = 'persistence_baseline'""",
    "baseline_eval": f"{_FEATURES} select * from metrics",
    "best_model": f"{_FEATURES} select * from metrics order by mae_c, model_name limit 1",
    "prediction_series": f"""{_FEATURES}
select observed_date, actual_c, predicted_c from persistence
where city = (select min(city) from persistence) order by observed_date""",
    "union_predictions": f"{_FEATURES} select * from baselines",
    "linear_regression_optimality": f"""{_FEATURES}
select (select count(*) from train) as n_train_rows, {_INPUTS} as input, true as orthogonal""",
    "scored_actuals": f"""{_FEATURES}
select unnest(['persistence_baseline', 'linear_regression', 'boosted_trees']) as model_name,
       city, observed_date, target_temperature_next_day_c as actual_c from test""",
    "published_baseline": f"""{_FEATURES}
select * from metrics where model_name = 'persistence_baseline'""",
    "slice_daily": _SLICE_DAILY,
    "slice_single_day": f"""{_GOLD}
select *, avg_temperature_c as avg_temperature_display,
       min_temperature_c as min_temperature_display, max_temperature_c as max_temperature_display
from gold where city in ('1', '2', '3') and forecast_date = date '2024-01-08'""",
    "slice_hourly": f"""{_RUNS}, gold as ({_gold_hourly('history')})
select *, temperature_c * 9 / 5 + 32 as temperature_display
from gold where {_SLICE.format(day='cast(forecast_time as date)')}""",
    "display_table": f"""
select city_date_key, city, country, forecast_date, avg_humidity_pct, total_precipitation_mm,
       max_wind_speed_kmh, last_ingested_at,
       round_even(avg_temperature_display, 1) as "avg_temperature (°F)",
       round_even(min_temperature_display, 1) as "min_temperature (°F)",
       round_even(max_temperature_display, 1) as "max_temperature (°F)"
from ({_SLICE_DAILY})""",
    "headline_metrics": f"""{_GOLD}
select count(distinct city) as cities_tracked, cast(3 as bigint) as cities_shown,
       substr(cast(max(last_ingested_at) as varchar), 1, 16) as last_ingested from gold""",
    "city_list": f"{_GOLD} select distinct city from gold order by city",
    "first_cities": "select distinct c_name as city from customer order by city limit 6",
    "date_bounds": f"""{_GOLD}
select min(forecast_date) as min_date, max(forecast_date) as max_date from gold""",
    "backfill_window": """
select o_custkey, as_of - 5 - 730 as start_date, as_of - 5 - 14 as recent_start_date,
       as_of - 5 as end_date
from (select o_custkey, cast(max(o_orderdate) as date) as as_of from orders group by o_custkey)""",
    "request_set": f"select city, country, latitude, longitude, {_FORECAST_REQUEST} from ({_CITIES})",
    "archive_request_set": f"select city, country, latitude, longitude, {_ARCHIVE_REQUEST} from ({_CITIES})",
    "snapshot_ingest": f"""{_JUDGED}
select city, country, latitude, longitude, timestamp '2024-03-01 06:30:00' as ingested_at,
       count(*) as payloads
from judged join cities using (city) where reason is null
group by city, country, latitude, longitude""",
    "snapshot_rejects": f"""{_JUDGED}
select city, status, reason, count(*) as payloads from judged where reason is not null
group by city, status, reason""",
    "csv_export": f"{_RUNS} {_gold_daily('history', _RAIN)}",
    "parameterised_sql": f"""{_GOLD}
select city, count(*) as days from gold where forecast_date >= date '2024-01-08' group by city""",
    "rounding": """
select l_orderkey, l_linenumber, round(price, 1) as away_1, round(price, 2) as away_2,
       round_even(price, 1) as even_1, round_even(price, 3) as even_3
from (select *, l_extendedprice * (1 - l_discount) as price from lineitem)""",
}

_INSTANTS = "(values (timestamp '2024-03-01 06:30:00'), (timestamp '2024-03-02 06:30:00')) as r(ingested_at)"

# Repeated runs land once, and so does what is kept up to date: the same rows as in one go.
ORACLES |= {
    "landed_forecasts": f"""{_JUDGED}
select city, country, latitude, longitude, ingested_at, count(*) as payloads
from judged join cities using (city) cross join {_INSTANTS} where reason is null
group by city, country, latitude, longitude, ingested_at""",
    "landed_archive": f"""{_JUDGED}
select city, country, ingested_at, date '2024-02-11' as start_date, date '2024-02-25' as end_date,
       count(*) as payloads
from judged join cities using (city) cross join {_INSTANTS} where reason is null
group by city, country, ingested_at""",
    "landed_rejects": f"""{_JUDGED}
select distinct ingested_at, 'bronze.weather_raw' as log, city, cast(null as varchar) as country,
       status, reason
from judged cross join {_INSTANTS} where reason is not null""",
    "parsed_bodies": """
select cast(user_id as varchar) as city,
       cast(json_object('last', max(event_id), 'first', min(event_type), 'none', null) as varchar)
         as raw_response
from events group by user_id""",
    "incremental_history": ORACLES["silver_hourly_history"],
    "newest_view": ORACLES["silver_hourly"],
    "incremental_actuals": ORACLES["silver_daily_actuals"],
    "incremental_accuracy": ORACLES["payload_accuracy"],
    "incremental_curve": f"""{_RUNS}, {_ACTUALS.strip().removeprefix('with')},
forecasts as (
  select city, day, cast(made as date) as made, avg(temp) as temp from history group by all),
{_ACCURACY}
select lead_time_days, round(round(avg(abs_error_c), 7), 4) as mean_absolute_error_c,
       count(abs_error_c) as n_observations
from accuracy group by lead_time_days""",
    "replaced_table": ORACLES["gold_daily"],
    "accuracy_ordered": ORACLES["lead_time_accuracy"],
    "lead_time_curve_states": ORACLES["lead_time_curve"],
    "metrics_states": ORACLES["baseline_eval"],
    "boosted_three_rounds": _boosted(3),
}
