"""One check statement per registered query."""

from __future__ import annotations

from orderloom.schemas import RAW

from .tables import statement

_TS = "try_cast({0} as timestamp) as {1}"
_NUM = "cast(try_cast({0} as decimal(38,0)) as bigint) as {1}"
_MONEY = "cast(try_cast({0} as decimal(18,2)) as double) as {1}"

_BODIES: dict[str, str] = {}

# ------------------------------------------------------------------- loading, staging

_BODIES["raw_csv_load"] = """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date, nullif(price, '') as price, freight_value
from r_items"""

_RAW_VIEWS = {
    "orders": "r_orders", "order_items": "r_items", "payments": "r_payments", "customers": "t_customers",
    "products": "(select *, cast(length(product_category_name) as varchar) as product_name_lenght, "
    "cast(null as varchar) as product_description_lenght, '1' as product_photos_qty from r_products)",
    "reviews": "r_reviews", "sellers": "t_sellers", "geolocation": "r_geolocation",
}
_BODIES["raw_csv_load_columns"] = " union all ".join(
    f"select '{table}' as table_name, '{c}' as column_name, count({v}) as filled, count(distinct {v}) as distinct_values, "
    f"min({v}) as least, max({v}) as greatest from {view}"
    for table, view in _RAW_VIEWS.items()
    for c in RAW[table].names
    for v in [f"nullif(cast({c} as varchar), '')"]
)

_BODIES["csv_rejects"] = "select * from broken_lines"

_BODIES["table_counts"] = " union all ".join(
    f"select '{name}' as table_name, count(*) as row_count from {view}"
    for name, view in [
        ("orders", "t_orders"), ("order_items", "t_items"), ("payments", "t_payments"), ("customers", "t_customers"),
        ("products", "t_products"), ("reviews", "t_reviews"), ("sellers", "t_sellers"), ("geolocation", "t_geolocation"),
    ]
)
_BODIES["full_refresh_roundtrip"] = "select * from daily"
# The payload's numbers as the text that both engines write for them is not the same; its keys and order are compared
# through brief_json, here only what SQL can write alike.
_BODIES["append_roundtrip"] = """
select kpi_date as brief_date, cast(kpi_date as timestamp) as generated_at, '{"total_orders":' || cast(total_orders as varchar)
  || '}' as kpi_json, '' as ai_summary, 'automated_pipeline' as channel, 'run-' || cast(kpi_date as varchar) as run_id from daily"""

_BODIES["stg_orders"] = (
    "select order_id, customer_id, order_status, "
    + ", ".join(
        [
            _TS.format("order_purchase_timestamp", "order_purchase_ts"),
            _TS.format("order_approved_at", "order_approved_ts"),
            _TS.format("order_delivered_carrier_date", "order_delivered_carrier_ts"),
            _TS.format("order_delivered_customer_date", "order_delivered_customer_ts"),
            _TS.format("order_estimated_delivery_date", "order_estimated_delivery_ts"),
        ]
    )
    + " from r_orders"
)
_BODIES["stg_order_items"] = (
    f"select order_id, {_NUM.format('order_item_id', 'order_item_id')}, product_id, seller_id, "
    f"{_TS.format('shipping_limit_date', 'shipping_limit_ts')}, {_MONEY.format('price', 'price')}, "
    f"{_MONEY.format('freight_value', 'freight_value')} from r_items"
)
_BODIES["stg_payments"] = (
    f"select order_id, {_NUM.format('payment_sequential', 'payment_sequential')}, payment_type, "
    f"{_NUM.format('payment_installments', 'payment_installments')}, {_MONEY.format('payment_value', 'payment_value')} "
    "from r_payments"
)
_BODIES["stg_customers"] = "select * from t_customers"
_BODIES["stg_products"] = (
    "select product_id, product_category_name, "
    + ", ".join(
        _NUM.format(c, c) for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    )
    + " from r_products"
)
_BODIES["stg_reviews"] = (
    f"select review_id, order_id, {_NUM.format('review_score', 'review_score')}, review_comment_title, "
    "review_comment_message, try_cast(review_creation_date as date) as review_creation_date, "
    f"{_TS.format('review_answer_timestamp', 'review_answer_ts')} from r_reviews"
)
_BODIES["stg_sellers"] = "select * from t_sellers"
_BODIES["stg_geolocation"] = """
select geolocation_zip_code_prefix, try_cast(geolocation_lat as double) as geolocation_lat,
  try_cast(geolocation_lng as double) as geolocation_lng, geolocation_city, geolocation_state from r_geolocation"""


def _failures() -> str:
    checks = [
        ("orders", "r_orders", [
            ("order_purchase_ts", "order_purchase_timestamp", "timestamp"),
            ("order_approved_ts", "order_approved_at", "timestamp"),
            ("order_delivered_carrier_ts", "order_delivered_carrier_date", "timestamp"),
            ("order_delivered_customer_ts", "order_delivered_customer_date", "timestamp"),
            ("order_estimated_delivery_ts", "order_estimated_delivery_date", "timestamp"),
        ]),
        ("order_items", "r_items", [
            ("order_item_id", "order_item_id", "decimal(38,0)"),
            ("shipping_limit_ts", "shipping_limit_date", "timestamp"),
            ("price", "price", "decimal(18,2)"),
            ("freight_value", "freight_value", "decimal(18,2)"),
        ]),
        ("payments", "r_payments", [
            ("payment_sequential", "payment_sequential", "decimal(38,0)"),
            ("payment_installments", "payment_installments", "decimal(38,0)"),
            ("payment_value", "payment_value", "decimal(18,2)"),
        ]),
        ("products", "r_products", [
            (c, c, "decimal(38,0)")
            for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
        ]),
        ("reviews", "r_reviews", [
            ("review_score", "review_score", "decimal(38,0)"),
            ("review_creation_date", "review_creation_date", "date"),
            ("review_answer_ts", "review_answer_timestamp", "timestamp"),
        ]),
        ("geolocation", "r_geolocation", [
            ("geolocation_lat", "geolocation_lat", "double"), ("geolocation_lng", "geolocation_lng", "double"),
        ]),
    ]
    return " union all ".join(
        f"select '{table}' as table_name, count(*) as row_count, '{target}' as column_name, "
        f"count({source}) as given_values, "
        f"count(*) filter (where {source} is not null and try_cast({source} as {kind}) is null) as failed_casts from {view}"
        for table, view, columns in checks
        for target, source, kind in columns
    )


_BODIES["cast_failures"] = _failures()

# ------------------------------------------------------------- joins, aggregates, marts

_BODIES["orders_with_customer"] = "select * from t_orders left join t_customers using (customer_id)"
_BODIES["customer_geo"] = """
select c.*, g.geolocation_lat as customer_lat, g.geolocation_lng as customer_lng from t_customers c
left join geo_dedup g on c.customer_zip_code_prefix = g.geolocation_zip_code_prefix"""
_BODIES["item_totals"] = """
select order_id, cast(items_total as double) as items_total, cast(freight_total as double) as freight_total from item_totals"""
_BODIES["payment_totals"] = "select order_id, cast(payment_total as double) as payment_total from payment_totals"
_BODIES["review_scores"] = "select * from review_scores"
_BODIES["geo_dedup"] = "select * from geo_dedup"
_BODIES["fct_orders"] = """
select * replace (cast(items_total as double) as items_total, cast(freight_total as double) as freight_total,
  cast(payment_total as double) as payment_total, cast(is_delayed as bigint) as is_delayed) from fct"""
_BODIES["daily_kpi"] = "select * from daily"
_BODIES["geo_kpi"] = "select * from geo"
_BODIES["customer_repeat_metrics"] = """
select count(*) as total_customers, cast(count(*) filter (where n > 1) as bigint) as repeat_customers,
  count(*) filter (where n > 1)::double * 100 / count(*) as repeat_customer_pct
from (select customer_unique_id, count(distinct order_id) as n from fct where customer_unique_id is not null group by 1)"""
_BODIES["exec_dashboard"] = "select * from exec"

# ---------------------------------------------------------------------------- features

_BODIES["demand_base"] = "select * from demand_base"
_BODIES["demand_features_train"] = "select * from demand_train"
_BODIES["demand_features_scoring"] = "select * from demand_scoring"
_DELAY = "cast(item_price as double) as item_price, cast(freight_value as double) as freight_value"
_BODIES["delay_features_train"] = f"""
select * replace ({_DELAY}, cast(is_delayed as bigint) as is_delayed) from delay_train"""
_BODIES["delay_features_scoring"] = f"select * replace ({_DELAY}) from delay_scoring"
_BODIES["drift_samples"] = "select cast(payment_value as double) as payment_value from t_payments where payment_value is not null"
_BODIES["drift_samples_capped"] = """
select cast(payment_value as double) as payment_value from (select * from t_payments where payment_value is not null
  order by md5(order_id || '|' || cast(payment_sequential as varchar)), order_id, payment_sequential, payment_value
  limit 1000)"""
_BODIES["demand_matrix"] = """
select kpi_date, customer_state, product_category_name, cast(daily_orders as double) as daily_orders,
  coalesce(daily_gmv, 0) as daily_gmv, coalesce(daily_review, 0) as daily_review,
  coalesce(cast(lag_1_orders as double), 0) as lag_1_orders, coalesce(cast(lag_7_orders as double), 0) as lag_7_orders,
  coalesce(rolling_7_orders, 0) as rolling_7_orders, cast(dow as double) as dow, cast(month_num as double) as month_num,
  cast(target_orders_next_7d as double) as target_orders_next_7d from demand_train"""
_BODIES["delay_matrix"] = """
select order_id, coalesce(customer_state, '__nan__') as customer_state, coalesce(seller_state, '__nan__') as seller_state,
  coalesce(payment_type, '__nan__') as payment_type, cast(item_price as double) as item_price,
  cast(freight_value as double) as freight_value, coalesce(cast(delivery_days as double), 0) as delivery_days,
  cast(is_delayed as bigint) as is_delayed from delay_train"""

# ------------------------------------------------------------------- splits and metrics

_BODIES["time_index"] = "select kpi_date, customer_state, product_category_name, row_index from time_indexed"
_BODIES["time_series_folds"] = """
select fold, count(*) filter (where row_index < lo) as train_rows,
  count(*) filter (where row_index >= lo and row_index < hi) as validation_rows,
  max(kpi_date) filter (where row_index < lo) as last_train_day,
  min(kpi_date) filter (where row_index >= lo and row_index < hi) as first_validation_day,
  cast(sum(target_orders_next_7d) filter (where row_index < lo) as double) as train_target,
  cast(sum(target_orders_next_7d) filter (where row_index >= lo and row_index < hi) as double) as validation_target
from time_indexed, time_folds group by fold"""
_BODIES["stratified_folds"] = f"""
select * replace ({_DELAY}, cast(is_delayed as bigint) as is_delayed) from stratified"""
_BODIES["fold_class_check"] = """
select fold, (select count(*) from stratified where is_delayed = 1) - val_pos as train_pos,
  (select count(*) from stratified where is_delayed = 0) - val_neg as train_neg, val_pos, val_neg,
  val_pos > 0 and val_neg > 0 and (select count(*) from stratified where is_delayed = 1) > val_pos
    and (select count(*) from stratified where is_delayed = 0) > val_neg as usable
from (select fold, count(*) filter (where is_delayed = 1) as val_pos, count(*) filter (where is_delayed = 0) as val_neg
  from stratified group by fold)"""
_APE = """abs(greatest(target_orders_next_7d::double, 1e-8) - greatest(coalesce(lag_7_orders, 0)::double, 1e-8))
  / greatest(target_orders_next_7d::double, 1e-8)"""
_BODIES["metric_mape"] = f"select customer_state, round(avg({_APE}), 6) as mape from demand_train group by 1"
_BODIES["metric_fold_mean"] = f"""
select round(avg(score), 6) as metric_value from (select fold, avg({_APE}) as score
  from time_indexed, time_folds where row_index >= lo and row_index < hi group by fold)"""
_BODIES["metric_auc"] = """
select round((sum(rk) filter (where y = 1) - p * (p + 1) / 2) / (p * n), 12) as roc_auc from (
  select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2 as rk,
    cast(sum(y) over () as double) as p, cast(sum(1 - y) over () as double) as n
  from (select o_totalprice - o_totalprice % 1000 as s, case when o_orderstatus = 'F' then 1 else 0 end as y from orders))
group by p, n"""

# -------------------------------------------------------------------- drift and registry

_BODIES["psi_cuts"] = "select round(unnest(cuts), 6) as cut from pay_cuts"
_BODIES["psi_histogram"] = "select bin, e as baseline_rows, a as current_rows from pay_hist"
_BODIES["drift_psi"] = "select round(psi_score, 12) as psi_score from pay_psi"
_BODIES["drift_flag"] = "select feature_name, drift_flag from audit"
_BODIES["drift_audit"] = "select run_ts, feature_name, round(psi_score, 9) as psi_score, drift_flag from audit"
_BODIES["drift_flag_count"] = "select count(distinct feature_name) filter (where drift_flag) as drifted_features from audit"
_BODIES["registry_champions"] = "select * from champions"
_BODIES["champion_rows"] = "select * from registry where model_type = 'forecast' and is_champion"
_BODIES["drift_flagged"] = "select run_ts, feature_name, round(psi_score, 9) as psi_score, drift_flag from audit where drift_flag"
_BODIES["score_to_beat"] = """
select 'forecast' as model_type, coalesce((select metric_value from champions where model_type = 'forecast'), 9999.0) as metric_to_beat
union all select 'delay_risk', -1.0"""
_BODIES["registry_promote"] = """
select r.model_type, r.model_resource_name, r.metric_name, r.metric_value,
  r.is_champion and not coalesce(d.promoted, false) as is_champion, r.drift_score, r.updated_at
from registry r left join decision d using (model_type)
union all
select model_type, model_resource_name, case model_type when 'forecast' then 'MAPE' else 'ROC_AUC' end, metric_value,
  true, (select round(psi_score, 9) from pay_psi), timestamp '2024-01-01 00:00:00' from decision where promoted"""
_BODIES["registry_result"] = """
select model_type, case when promoted then model_resource_name else coalesce(old_model, model_resource_name) end as champion,
  promoted from decision"""

# --------------------------------------------------------------------------------- brief

_BODIES["brief_kpis"] = "select * from brief_row"
_BODIES["brief_movements"] = " union all ".join(
    f"select kpi_date, '{k}' as kpi, cast({k}_latest as double) as latest, cast({k}_prev as double) as previous, "
    f"cast({k}_latest - {k}_prev as double) as change, "
    f"case when {s} * ({k}_latest - {k}_prev) > 0 then 'improved' when {s} * ({k}_latest - {k}_prev) < 0 "
    f"then 'needs attention' else 'unchanged' end as verdict from brief_row"
    for k, s in [("orders", 1), ("gmv", 1), ("aov", 1), ("review", 1), ("delay", -1)]
)
_BODIES["brief_json"] = "select * from brief_row"
_LISTED = "concat_ws(', ', " + ", ".join(
    f"case when {s} * ({k}_latest - {k}_prev) {{0}} 0 then '{k}' end" for k, s in [("orders", 1), ("gmv", 1), ("aov", 1), ("review", 1), ("delay", -1)]
) + ")"
_BODIES["client_daily_brief"] = f"""
select date '2024-01-01' as brief_date, timestamp '2024-01-01 00:00:00' as generated_at, 'automated_pipeline' as channel,
  'run-1' as run_id, 'Improved: ' || coalesce(nullif({_LISTED.format('>')}, ''), 'none') || '. Needs attention: '
  || coalesce(nullif({_LISTED.format('<')}, ''), 'none') || '.' as ai_summary, kpi_date, orders_latest, gmv_latest from brief_row"""
_BODIES["latest_brief"] = """
select kpi_date as brief_date, cast(kpi_date as timestamp) as generated_at, '{"total_orders":' || cast(total_orders as varchar)
  || '}' as kpi_json, '' as ai_summary, 'automated_pipeline' as channel, 'run-' || cast(kpi_date as varchar) as run_id
from daily where kpi_date = (select max(kpi_date) from daily)"""

# ----------------------------------------------------------------------------- dashboard

_LAST60 = "kpi_date >= (select max(kpi_date) from {0}) - 60"
_BODIES["exec_window"] = f"select * from exec where {_LAST60.format('exec')}"
_BODIES["latest_day_flag"] = """
select kpi_date, customer_state, kpi_date = (select max(kpi_date) from exec) as is_latest_day,
  'Data as of: ' || cast((select max(kpi_date) from exec) as varchar) as as_of_text from exec"""
_BODIES["latest_delay_pct"] = """
select kpi_date, customer_state, case when kpi_date = (select max(kpi_date) from exec)
  then coalesce(delayed_order_pct, 0) end as delayed_pct_display from exec"""
_BODIES["exec_dod_pct"] = (
    "select kpi_date, customer_state, "
    + ", ".join(
        f"case when kpi_date = (select max(kpi_date) from exec) and {prev} <> 0 "
        f"then (cast({now} as double) - {prev}) / {prev} end as {now}_dod"
        for now, prev in [
            ("gmv", "prev_day_gmv"), ("total_orders", "prev_day_orders"), ("aov", "prev_day_aov"),
            ("delayed_order_pct", "prev_day_delayed_pct"), ("avg_review_score", "prev_day_avg_review_score"),
        ]
    )
    + " from exec"
)
_BODIES["fct_gmv_dod"] = """
select customer_state, order_date, gmv, prev_gmv, case when prev_gmv <> 0 then (gmv - prev_gmv) / prev_gmv end as gmv_dod
from (select *, lag(gmv) over (partition by customer_state order by order_date) as prev_gmv from (
  select customer_state, order_date, cast(sum(payment_total) as double) as gmv from fct
  where order_date is not null and customer_state is not null group by 1, 2))"""
_BODIES["headline_kpis"] = """
select max(order_date) as order_date, cast(sum(payment_total) as double) as gmv, count(distinct order_id) as total_orders,
  cast(sum(payment_total) as double) / count(distinct order_id) as aov, avg(avg_review_score) as avg_review_score,
  coalesce(avg(cast(is_delayed as double)) * 100, 0) as delayed_order_pct
from fct where order_date = (select max(order_date) from fct)"""
_BODIES["top10_states"] = f"""
select customer_state, round(sum(gmv), 2) as gmv, cast(sum(total_orders) as bigint) as total_orders from exec
where {_LAST60.format('exec')} group by 1 order by 2 desc, 1 limit 10"""
_BODIES["national_strip"] = f"select * from daily where {_LAST60.format('daily')}"
_BODIES["geo_city_min_volume"] = """
select customer_state, customer_city, cast(sum(total_orders) as bigint) as total_orders, round(sum(gmv), 2) as gmv from geo
group by 1, 2 having sum(total_orders) >= 50"""
_BODIES["risk_buckets"] = """
select *, case when delay_risk_score >= 0.8 then 'Very High' when delay_risk_score >= 0.6 then 'High'
  when delay_risk_score >= 0.3 then 'Medium' else 'Low' end as risk_bucket from risk"""
_GRID = ", ".join(
    f"round(avg(delay_risk_score) filter (where coalesce(payment_type, 'no_payment') = '{kind}'), 12) as {kind}"
    for kind in ("credit_card", "boleto", "voucher", "debit_card", "no_payment")
)
_BODIES["risk_heatmap_grid"] = f"select customer_state, {_GRID} from risk group by 1"
_BODIES["risk_heatmap"] = """
select customer_state, payment_type, round(avg(delay_risk_score), 12) as avg_risk from risk group by 1, 2"""
_BODIES["forecast_by_state"] = "select * from forecast where customer_state = 'NATION_3'"
_BODIES["actual_vs_forecast"] = """
select coalesce(d.kpi_date, f.forecast_date) as day, d.total_orders as actual_orders, f.p as predicted_orders_7d
from daily d full join (select forecast_date, sum(predicted_orders_7d) as p from forecast
  where customer_state = 'NATION_3' group by 1) f on d.kpi_date = f.forecast_date"""

# --------------------------------------------------------------------- changes, streaming

_BODIES["orders_change_feed"] = """
select *, coalesce(order_id in (select order_id from snapshot_old) and order_id in (select order_id from snapshot_new), false)
  as is_update
from (select *, 'DELETE' as action from (from snapshot_old except all from snapshot_new)
  union all select *, 'INSERT' from (from snapshot_new except all from snapshot_old))"""
_BODIES["orders_stream_staging"] = _BODIES["stg_orders"]
_BODIES["daily_kpi_incremental"] = "select * from daily"
_BODIES["daily_kpi_corrected"] = """
select order_date as kpi_date, count(*) as total_orders, cast(coalesce(sum(payment_total), 0) as double) as gmv,
  cast(coalesce(sum(payment_total), 0) as double) / count(*) as aov, avg(avg_review_score) as avg_review_score,
  100 * avg(cast(is_delayed as double)) as delayed_order_pct
from fct where order_date is not null and cast(order_id as bigint) % 13 <> 0 group by order_date"""
_BODIES["orders_stream_rejects"] = "select * from broken_lines"
_BODIES["orders_stream_text"] = (
    f"select * from ({_BODIES['stg_orders']}) where order_id not in (select first_field from broken_lines)"
)
_BODIES["orders_feed_consumed"] = """
select order_id, customer_id, case when cast(order_id as bigint) % 9 <> 0 and cast(order_id as bigint) % 7 <> 0 then order_status end
  as order_status, order_purchase_ts
from t_orders, range(2) as copies(i)
where cast(order_id as bigint) % 13 <> 0 and (i = 0 or cast(order_id as bigint) % 5 = 0)"""

# -------------------------------------------------------------------------------- models

_BODIES["brief_variant"] = """
select date '2024-01-01' as brief_date, timestamp '2024-01-01 00:00:00' as generated_at, 'automated_pipeline' as channel,
  'run-1' as run_id, * from brief_row"""
_NUMBERS = ["item_price", "freight_value", "delivery_days"]
_CELLS = [
    f"select order_id, {i} as position, cast({c} as double) as value from delay_train where {c} <> 0"
    for i, c in enumerate(_NUMBERS)
] + ["select order_id, 3 + place as position, 1.0 as value from level_places"]
_BODIES["delay_matrix_encoded"] = f"""
select order_id, cast(position as bigint) as position, value, count(*) as matrix_rows from ({' union all '.join(_CELLS)}) group by all"""
_BODIES["forecast_cv"] = """
select cast(fold as bigint) as fold, lo as train_rows, hi - lo as validation_rows, true as is_error,
  true as better_than_nothing from time_folds"""
_BODIES["delay_cv"] = "select distinct fold, true as better_than_chance from stratified"
_BODIES["model_roundtrip"] = "select count(*) as scored_rows, 0 as differing from demand_scoring"
_BODIES["demand_forecast_daily"] = """
select forecast_date, customer_state, product_category_name, true as is_possible, 'v1' as model_version,
  timestamp '2024-01-01 00:00:00' as scored_at from demand_scoring"""
_BODIES["delay_risk_scores"] = """
select order_id, order_purchase_ts, customer_state, seller_state, payment_type, true as is_share, 'v1' as model_version,
  timestamp '2024-01-01 00:00:00' as scored_at from delay_scoring"""

_FEATURES = [
    "daily_orders", "daily_gmv", "daily_review", "lag_1_orders", "lag_7_orders", "rolling_7_orders", "dow", "month_num",
]
_LONG = " union all ".join(
    f"select r, target_orders_next_7d as y, {i} as f, '{c}' as name, ifnull(cast({c} as double), 0) as v from numbered"
    for i, c in enumerate(_FEATURES)
)
_GAIN = "gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1)"


def _best(nodes: str) -> str:
    """The best split of every node of a table (r, node) over the binned cells."""
    return f"""
  select node, f, name, b from (
    select *, sum(g) over (partition by node, f order by b) as gl, sum(h) over (partition by node, f order by b) as hl,
      sum(g) over (partition by node, f) as gt, sum(h) over (partition by node, f) as ht
    from (select node, f, name, b, cast(sum(1 - y) as double) as g, cast(count(*) as double) as h
      from cells join {nodes} using (r) group by all))
  where hl >= 1 and ht - hl >= 1 and {_GAIN} > 0 qualify row_number() over (partition by node order by {_GAIN} desc, f, b) = 1"""


_BODIES["boosted_tree"] = f"""
select * from (with numbered as (select row_number() over () as r, * from demand_train),
long as ({_LONG}),
cuts as (select f, list_distinct(quantile_cont(v, {[i / 16 for i in range(1, 16)]})) as cuts from long group by f),
cells as (select r, y, f, name, len(list_filter(cuts, lambda c: c < v)) as b from long join cuts using (f)),
root as (select r, 0 as node from numbered),
first as ({_best('root')}),
halves as (select r, case when c.b > s.b then 2 else 1 end as node from first s join cells c using (f)),
second as ({_best('halves')}),
quarters as (select r, 2 * node + case when c.b > s.b then 2 else 1 end as node
  from halves join second s using (node) join cells c using (r, f))
select cast(node as bigint) as node, name as feature, cast(b as bigint) as bin, cast(null as double) as value from first
union all select node, name, b, null from second
union all select coalesce(q.node, h.node, 0), null, null, round(sum(target_orders_next_7d - 1) / (count(*) + 1.0), 6)
  from numbered left join halves h using (r) left join quarters q using (r) group by 1)"""
_BODIES["boosted_forecast"] = "select hi - lo as validation_rows, true as better_than_naive from time_folds where fold = 4"

STATEMENTS = {name: statement(body) for name, body in _BODIES.items()}
