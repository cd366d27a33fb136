"""Named subqueries that the check statements are put together from."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

# ------------------------------------------------------------ typed staging tables

VIEWS["t_orders"] = """
select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
  case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end as order_status,
  o_orderdate + to_seconds(o_orderkey * 37 % 86400) as order_purchase_ts,
  o_orderdate + to_seconds(o_orderkey * 37 % 86400) + to_hours(1) as order_approved_ts,
  o_orderdate + to_seconds(o_orderkey * 37 % 86400) + to_days(1) as order_delivered_carrier_ts,
  case when o_orderstatus <> 'P' then
    o_orderdate + to_seconds(o_orderkey * 37 % 86400) + to_days(cast(3 + o_orderkey * 7 % 23 as integer)) end
    as order_delivered_customer_ts,
  o_orderdate + to_days(cast(10 + o_orderkey % 9 as integer)) as order_estimated_delivery_ts
from orders"""

VIEWS["t_items"] = """
select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as bigint) as order_item_id,
  cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
  l_shipdate as shipping_limit_ts, cast(l_extendedprice as decimal(18,2)) as price,
  cast(l_quantity as decimal(18,2)) as freight_value
from lineitem"""

VIEWS["t_payments"] = """
select cast(o_orderkey as varchar) as order_id, cast(1 as bigint) as payment_sequential,
  case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'boleto'
    when '3-MEDIUM' then 'voucher' else 'debit_card' end as payment_type,
  1 + o_orderkey % 10 as payment_installments, cast(o_totalprice as decimal(18,2)) as payment_value
from orders where o_orderkey % 50 <> 49
union all
select cast(o_orderkey as varchar), 2, 'voucher', 1 + o_orderkey % 10, cast(10 as decimal(18,2))
from orders where o_orderkey % 4 = 0"""

VIEWS["t_customers"] = """
select cast(c_custkey as varchar) as customer_id, c_name as customer_unique_id,
  lpad(cast(c_custkey % 200 as varchar), 5, '0') as customer_zip_code_prefix,
  c_mktsegment as customer_city, case when c_nationkey <> 24 then n_name end as customer_state
from customer left join nation on c_nationkey = n_nationkey"""

VIEWS["t_geolocation"] = """
select lpad(cast(c_custkey % 200 as varchar), 5, '0') as geolocation_zip_code_prefix,
  -33.0::double + cast(c_custkey % 97 as double) / 64 as geolocation_lat,
  -46.0::double + cast(c_custkey % 89 as double) / 64 as geolocation_lng,
  c_mktsegment as geolocation_city, n_name as geolocation_state
from customer left join nation on c_nationkey = n_nationkey where c_custkey % 20 <> 0"""

VIEWS["t_reviews"] = """
select 'R' || cast(o_orderkey as varchar) as review_id, cast(o_orderkey as varchar) as order_id,
  1 + o_orderkey * 13 % 5 as review_score, cast(o_orderdate as date) as review_creation_date
from orders where o_orderkey % 3 <> 0
union all
select 'R' || cast(o_orderkey as varchar), cast(o_orderkey as varchar), 1 + o_orderkey % 4, cast(o_orderdate as date)
from orders where o_orderkey % 10 = 0"""

VIEWS["t_products"] = """
select cast(p_partkey as varchar) as product_id, case when p_partkey % 41 <> 0 then p_type end as product_category_name,
  cast(p_size * 100 as bigint) as product_weight_g, cast(p_size as bigint) as product_length_cm,
  cast(p_size % 20 as bigint) as product_height_cm, cast(p_size % 15 as bigint) as product_width_cm
from part"""

VIEWS["t_sellers"] = """
select cast(s_suppkey as varchar) as seller_id, lpad(cast(s_nationkey as varchar), 5, '0') as seller_zip_code_prefix,
  n_name as seller_city, n_name as seller_state
from supplier left join nation on s_nationkey = n_nationkey"""

# ------------------------------------------------------------------ raw text tables

VIEWS["r_orders"] = """
select order_id, customer_id, order_status,
  case when cast(order_id as bigint) % 79 = 0 then 'bad-date' else cast(order_purchase_ts as varchar) end
    as order_purchase_timestamp,
  case when cast(order_id as bigint) % 71 = 0 then '2017' else cast(order_approved_ts as varchar) end
    as order_approved_at,
  cast(order_delivered_carrier_ts as varchar) as order_delivered_carrier_date,
  case when cast(order_id as bigint) % 73 = 0 then '' else cast(order_delivered_customer_ts as varchar) end
    as order_delivered_customer_date,
  cast(order_estimated_delivery_ts as varchar) as order_estimated_delivery_date
from t_orders"""

VIEWS["broken_lines"] = """
select order_id as first_field, case kind when 'short' then order_id || ',' || customer_id
    when 'long' then order_id || ',' || customer_id || ',' || order_status || ',a,b,c,d,e,f'
    else order_id || ',' || customer_id || ',"open' end as line,
  case kind when 'short' then 'too few fields' when 'long' then 'too many fields' else 'broken quote' end as reason,
  true as in_written_file, cast(0 as bigint) as block_start
from (select *, case when cast(order_id as bigint) % 17 = 0 then 'short' when cast(order_id as bigint) % 19 = 0 then 'long'
  when cast(order_id as bigint) % 23 = 0 then 'open' end as kind from t_orders) where kind is not null"""

VIEWS["r_items"] = """
select order_id,
  case when cast(order_id as bigint) % 67 = 0 then '1.7' else cast(order_item_id as varchar) end as order_item_id,
  product_id, seller_id,
  case when cast(order_id as bigint) % 79 = 0 then 'bad-date'
    else cast(cast(shipping_limit_ts as date) as varchar) || ' 10:56:33' end as shipping_limit_date,
  case when cast(order_id as bigint) % 97 = 0 then 'n/a' when cast(order_id as bigint) % 89 = 0 then ''
    when cast(order_id as bigint) % 83 = 0 then '1.005' else cast(price as varchar) end as price,
  cast(freight_value as varchar) as freight_value
from t_items"""

VIEWS["r_payments"] = """
select order_id, cast(payment_sequential as varchar) as payment_sequential, payment_type,
  case when cast(order_id as bigint) % 61 = 0 then 'many' else cast(payment_installments as varchar) end
    as payment_installments,
  case when cast(order_id as bigint) % 97 = 0 then 'n/a' else cast(payment_value as varchar) end as payment_value
from t_payments"""

VIEWS["r_products"] = """
select product_id, product_category_name,
  case when cast(product_id as bigint) % 59 = 0 then 'heavy' else cast(product_weight_g as varchar) end
    as product_weight_g,
  cast(product_length_cm as varchar) as product_length_cm, cast(product_height_cm as varchar) as product_height_cm,
  cast(product_width_cm as varchar) as product_width_cm
from t_products"""

VIEWS["r_reviews"] = """
select review_id, order_id,
  case when cast(order_id as bigint) % 101 = 0 then 'five' else cast(review_score as varchar) end as review_score,
  cast(null as varchar) as review_comment_title, cast(null as varchar) as review_comment_message,
  case when cast(order_id as bigint) % 103 = 0 then 'soon' else cast(review_creation_date as varchar) end
    as review_creation_date,
  cast(review_creation_date as varchar) || ' 08:30:00' as review_answer_timestamp
from t_reviews"""

VIEWS["r_geolocation"] = """
select geolocation_zip_code_prefix,
  case when cast(geolocation_zip_code_prefix as bigint) % 53 = 0 then 'south'
    else cast(geolocation_lat as varchar) end as geolocation_lat,
  cast(geolocation_lng as varchar) as geolocation_lng, geolocation_city, geolocation_state
from t_geolocation"""

# --------------------------------------------------------------------- fact and marts

VIEWS["item_totals"] = """
select order_id, sum(price) as items_total, sum(freight_value) as freight_total from t_items group by order_id"""

VIEWS["payment_totals"] = "select order_id, sum(payment_value) as payment_total from t_payments group by order_id"

VIEWS["review_scores"] = "select order_id, avg(review_score) as avg_review_score from t_reviews group by order_id"

VIEWS["geo_dedup"] = """
select geolocation_zip_code_prefix, avg(geolocation_lat) as geolocation_lat, avg(geolocation_lng) as geolocation_lng
from t_geolocation group by geolocation_zip_code_prefix"""

VIEWS["fct"] = """
-- one order at a time: everything else is looked up for it
select order_id, customer_id, buyer.customer_unique_id, buyer.customer_city, buyer.customer_state,
  (select avg(z.geolocation_lat) from t_geolocation z where z.geolocation_zip_code_prefix = zip) as customer_lat,
  (select avg(z.geolocation_lng) from t_geolocation z where z.geolocation_zip_code_prefix = zip) as customer_lng,
  order_status, order_purchase_ts, order_delivered_customer_ts, order_estimated_delivery_ts,
  (select sum(x.price) from t_items x where x.order_id = o.order_id) as items_total,
  (select sum(x.freight_value) from t_items x where x.order_id = o.order_id) as freight_total,
  (select sum(x.payment_value) from t_payments x where x.order_id = o.order_id) as payment_total,
  (select avg(x.review_score) from t_reviews x where x.order_id = o.order_id) as avg_review_score,
  cast(order_delivered_customer_ts > order_estimated_delivery_ts as integer) as is_delayed,
  order_purchase_ts::date as order_date
from t_orders o left join (select *, customer_zip_code_prefix as zip from t_customers) buyer using (customer_id)"""

_DAY_KPIS = """
  count(distinct order_id) as total_orders, cast(coalesce(sum(payment_total), 0) as double) as gmv,
  cast(coalesce(sum(payment_total), 0) as double) / count(distinct order_id) as aov,
  avg(avg_review_score) as avg_review_score, avg(cast(is_delayed as double)) * 100 as delayed_order_pct"""

VIEWS["daily"] = f"""
select order_date as kpi_date, {_DAY_KPIS} from fct where order_date is not null group by order_date"""

VIEWS["geo"] = """
select customer_state, customer_city, round(customer_lat, 4) as customer_lat, round(customer_lng, 4) as customer_lng,
  count(distinct order_id) as total_orders, cast(sum(payment_total) as double) as gmv,
  avg(cast(is_delayed as double)) * 100 as delayed_order_pct
from fct where customer_lat is not null and customer_lng is not null
group by customer_state, customer_city, round(customer_lat, 4), round(customer_lng, 4)"""

VIEWS["exec_base"] = f"""
select order_date as kpi_date, customer_state, {_DAY_KPIS} from fct
where order_date is not null and customer_state is not null group by order_date, customer_state"""

VIEWS["exec"] = """
select *, lag(gmv) over w as prev_day_gmv, lag(total_orders) over w as prev_day_orders, lag(aov) over w as prev_day_aov,
  lag(delayed_order_pct) over w as prev_day_delayed_pct, lag(avg_review_score) over w as prev_day_avg_review_score
from exec_base window w as (partition by customer_state order by kpi_date)"""

# --------------------------------------------------------------------------- features

VIEWS["demand_base"] = """
-- an order's payment and review count as often as it has items of the category
with pieces as (
  select order_id, product_category_name as category, count(*) as n
  from t_items left join t_products using (product_id) group by all
), weighted as (
  select order_date, customer_state, coalesce(category, 'unknown') as category, order_id, payment_total, avg_review_score,
    coalesce(n, 1) as n
  from (select * from fct where order_date is not null) left join pieces using (order_id)
)
select order_date as kpi_date, customer_state, category as product_category_name, count(distinct order_id) as daily_orders,
  cast(sum(payment_total * n) as double) as daily_gmv,
  sum(avg_review_score * n) / sum(n) filter (where avg_review_score is not null) as daily_review
from weighted group by order_date, customer_state, category"""

VIEWS["demand_feat"] = """
-- days numbered within each series; other days are found by their number
with numbered as (
  select *, row_number() over (partition by customer_state, product_category_name order by kpi_date) as nth from demand_base
), around as (
  select d.kpi_date, d.customer_state, d.product_category_name,
    max(e.daily_orders) filter (where e.nth = d.nth - 1) as lag_1_orders,
    max(e.daily_orders) filter (where e.nth = d.nth - 7) as lag_7_orders,
    avg(e.daily_orders) filter (where e.nth < d.nth) as rolling_7_orders,
    max(e.daily_orders) filter (where e.nth = d.nth + 7) as target_orders_next_7d
  from numbered d join numbered e
    on e.customer_state is not distinct from d.customer_state and e.product_category_name = d.product_category_name
      and (e.nth between d.nth - 7 and d.nth or e.nth = d.nth + 7)
  group by all
)
select b.*, a.lag_1_orders, a.lag_7_orders, a.rolling_7_orders, cast(strftime(b.kpi_date, '%w') as bigint) as dow,
  extract(month from b.kpi_date) as month_num, a.target_orders_next_7d
from demand_base b join around a
  on a.kpi_date = b.kpi_date and a.customer_state is not distinct from b.customer_state
    and a.product_category_name = b.product_category_name"""

VIEWS["demand_train"] = "select * from demand_feat where target_orders_next_7d is not null"

VIEWS["demand_scoring"] = """
select kpi_date as forecast_date, customer_state, product_category_name, daily_orders, daily_gmv, daily_review,
  lag_1_orders, lag_7_orders, rolling_7_orders, dow, month_num
from demand_train d
where not exists (select 1 from demand_train e where e.customer_state is not distinct from d.customer_state
  and e.product_category_name = d.product_category_name and e.kpi_date > d.kpi_date)"""

VIEWS["delay_train"] = """
-- an order without items, or without payments, has one row with the other side
with lines as (
  select x.order_id, x.price, x.freight_value, s.seller_state from t_items x left join t_sellers s on s.seller_id = x.seller_id
)
select f.order_id, f.order_purchase_ts, f.customer_state, l.seller_state, p.payment_type, ifnull(l.price, 0) as item_price,
  ifnull(l.freight_value, 0) as freight_value,
  f.order_delivered_customer_ts::date - f.order_purchase_ts::date as delivery_days, ifnull(f.is_delayed, 0) as is_delayed
from fct f left join lines l on l.order_id = f.order_id left join t_payments p on p.order_id = f.order_id
where f.order_purchase_ts is not null"""

VIEWS["delay_scoring"] = """
select order_id, order_purchase_ts, customer_state, seller_state, payment_type, item_price, freight_value, delivery_days
from (select *, row_number() over (partition by order_id order by order_purchase_ts desc, seller_state nulls last,
  payment_type nulls last, item_price nulls last, freight_value nulls last) as rn from delay_train) where rn = 1"""

VIEWS["time_indexed"] = """
select *, row_number() over (order by kpi_date, customer_state nulls first, product_category_name nulls first) - 1
  as row_index from demand_train"""

VIEWS["time_plan"] = """
select n, 4 as k, n // 5 as block, unnest(range(4)) as i from (select count(*) as n from demand_train)"""

VIEWS["time_folds"] = """
select i + 1 as fold, n - k * block + i * block as lo, n - k * block + (i + 1) * block as hi from time_plan"""

VIEWS["stratified"] = """
select *, cast((row_number() over (partition by is_delayed order by
  md5(concat_ws('|', order_id, coalesce(seller_state, '~'), coalesce(payment_type, '~'),
    cast(item_price as varchar), cast(freight_value as varchar))),
  order_id, seller_state nulls first, payment_type nulls first, item_price, freight_value,
  order_purchase_ts, customer_state nulls first, delivery_days nulls first) - 1) % 5 as bigint) as fold
from delay_train"""

VIEWS["levels"] = """
-- categories by falling frequency, then by name; those of a column stand behind those of the columns before
with said as (
  select 1 as nth, coalesce(customer_state, '__nan__') as level from delay_train
  union all select 2, coalesce(seller_state, '__nan__') from delay_train
  union all select 3, coalesce(payment_type, '__nan__') from delay_train
)
select nth, level, row_number() over (order by nth, count(*) desc, level) - 1 as place from said group by nth, level"""

VIEWS["level_places"] = """
select order_id, place from delay_train join levels on nth = 1 and level = coalesce(customer_state, '__nan__')
union all select order_id, place from delay_train join levels on nth = 2 and level = coalesce(seller_state, '__nan__')
union all select order_id, place from delay_train join levels on nth = 3 and level = coalesce(payment_type, '__nan__')"""

VIEWS["risk"] = """
select order_id, order_purchase_ts, customer_state, seller_state, payment_type,
  cast(cast(order_id as bigint) * 7 % 101 as double) / 100 as delay_risk_score from delay_scoring"""

VIEWS["forecast"] = """
select forecast_date, customer_state, product_category_name, cast(lag_7_orders as double) as predicted_orders_7d
from demand_scoring"""

VIEWS["brief_row"] = """
select d1.kpi_date, cast(coalesce(d1.total_orders, 0) as double) as orders_latest,
  cast(coalesce(d2.total_orders, 0) as double) as orders_prev, coalesce(d1.gmv, 0) as gmv_latest,
  coalesce(d2.gmv, 0) as gmv_prev, coalesce(d1.aov, 0) as aov_latest, coalesce(d2.aov, 0) as aov_prev,
  coalesce(d1.avg_review_score, 0) as review_latest, coalesce(d2.avg_review_score, 0) as review_prev,
  coalesce(d1.delayed_order_pct, 0) as delay_latest, coalesce(d2.delayed_order_pct, 0) as delay_prev
from (select *, row_number() over (order by kpi_date desc) as rn from daily) d1
left join (select *, row_number() over (order by kpi_date desc) as rn from daily) d2 on d2.rn = 2
where d1.rn = 1"""

# ------------------------------------------------------------------ drift and registry


def psi_views(name: str, values: str) -> None:
    """``values`` selects (v double, is_baseline boolean)."""
    VIEWS[f"{name}_values"] = values
    VIEWS[f"{name}_cuts"] = (
        "select list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) as cuts "
        f"from {name}_values where is_baseline"
    )
    VIEWS[f"{name}_binned"] = (
        "select is_baseline, least(len(list_filter(cuts, lambda k: k <= v)), len(cuts) - 1) as bin "
        f"from {name}_values, {name}_cuts where v between cuts[1] and cuts[len(cuts)]"
    )
    VIEWS[f"{name}_hist"] = (
        "select bin, count(*) filter (where is_baseline) as e, count(*) filter (where not is_baseline) as a "
        f"from {name}_binned group by bin"
    )
    VIEWS[f"{name}_psi"] = (
        "select case when (select len(cuts) from {n}_cuts) < 3 or not exists (select 1 from {n}_values where not is_baseline) "
        "then 0 else coalesce(sum((a1 - e1) * ln(a1 / e1)), 0) end as psi_score from ("
        "select greatest(e / greatest(sum(e) over (), 1), 1e-6) as e1, greatest(a / greatest(sum(a) over (), 1), 1e-6) as a1 "
        "from {n}_hist)"
    ).format(n=name)


psi_views(
    "pay",
    """select cast(payment_value as double) as v, coalesce(order_purchase_ts < timestamp '1998-01-01', false) as is_baseline
from t_payments join t_orders using (order_id) where payment_value is not null""",
)
psi_views(
    "price",
    """select cast(price as double) as v, coalesce(order_purchase_ts < timestamp '1998-01-01', false) as is_baseline
from t_items join t_orders using (order_id)""",
)
psi_views(
    "days",
    """select cast(date_diff('day', date '1995-01-01', cast(order_purchase_ts as date)) as double) as v,
  coalesce(order_purchase_ts < timestamp '1998-01-01', false) as is_baseline from t_orders""",
)

VIEWS["audit"] = """
select timestamp '2024-01-01 00:00:00' as run_ts, 'payment_value' as feature_name, psi_score, psi_score >= 0.25 as drift_flag
from pay_psi
union all select timestamp '2024-01-01 00:00:00', 'item_price', psi_score, psi_score >= 0.25 from price_psi
union all select timestamp '2024-01-01 00:00:00', 'purchase_day', psi_score, psi_score >= 0.25 from days_psi"""

VIEWS["monthly_scores"] = """
select 'forecast' as model_type, strftime(kpi_date, '%Y-%m') as month,
  round(avg(abs(greatest(target_orders_next_7d::double, 1e-8) - greatest(coalesce(lag_7_orders, 0)::double, 1e-8))
    / greatest(target_orders_next_7d::double, 1e-8)), 6) as metric_value
from demand_train group by 2
union all
select 'delay_risk', strftime(order_date, '%Y-%m'), round(1 - avg(cast(is_delayed as double)), 6)
from fct where order_date is not null group by 2"""

VIEWS["registry"] = """
select model_type, model_type || '-' || month as model_resource_name,
  case model_type when 'forecast' then 'MAPE' else 'ROC_AUC' end as metric_name, metric_value,
  month[6:7] = '06' as is_champion, cast(0 as double) as drift_score,
  cast(month || '-01' as timestamp) as updated_at
from monthly_scores where month < (select max(month) from monthly_scores)"""

VIEWS["challengers"] = """
select model_type, model_type || '-' || month as model_resource_name, metric_value
from (select *, row_number() over (partition by model_type order by month desc) as rn from monthly_scores) where rn = 1"""

VIEWS["champions"] = """
select model_type, model_resource_name, metric_value, updated_at
from (select *, row_number() over (partition by model_type order by updated_at desc, model_resource_name desc) as rn
  from registry where is_champion) where rn = 1"""

VIEWS["decision"] = """
select c.model_type, c.model_resource_name, c.metric_value, o.model_resource_name as old_model,
  coalesce(case c.model_type when 'forecast' then c.metric_value < coalesce(o.metric_value, 9999.0)
    else c.metric_value > coalesce(o.metric_value, -1.0) end, false)
  and not (select psi_score >= 0.25 from pay_psi) as promoted
from challengers c left join champions o using (model_type)"""

VIEWS["snapshot_old"] = """
select order_id, customer_id, order_status, order_purchase_ts from t_orders where cast(order_id as bigint) % 11 <> 0"""

VIEWS["snapshot_new"] = """
select order_id, customer_id, case when cast(order_id as bigint) % 7 = 0 then 'X' else order_status end as order_status,
  order_purchase_ts from t_orders where cast(order_id as bigint) % 13 <> 0"""

_ORDER = list(VIEWS)


def statement(body: str) -> str:
    """``body`` with the named subqueries it uses, directly or through others, in front."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & VIEWS.keys() - needed:
            needed.add(name)
            todo.append(VIEWS[name])
    parts = [f"{name} as ({VIEWS[name]})" for name in _ORDER if name in needed]
    return f"with {', '.join(parts)} {body}" if parts else body
