"""SQL twin of each registered query."""

from __future__ import annotations

from shelfcast.oracle.ctes import (
    AGE_FEATURES,
    EXPECTED_MEAN_COLUMNS,
    MEDIAN_COLUMNS,
    ORDER_SUMS,
    dbl,
    is_weekend,
    month,
    names,
    on_calendar_day,
    ratio,
    season,
)

PREVIEW_ROWS = 10

needed_digits = " ".join(f"when round(number * 1e{d}) / 1e{d} = number then {d}" for d in range(9))

BODIES: dict[str, str] = {
    # --- sources and inspection
    "scan_typed": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate,
               o_orderpriority
        from orders""",
    "forecast_publish": """
        select strftime(date, '%Y-%m-%d') as "Date", revenue_pred as "Revenue", cogs_pred as "COGS" from forecast""",
    "frame_profile": """
        select 'train' as frame, count(*) as row_count, cast(3 as int) as column_count, min(date) as first_date,
               max(date) as last_date from train
        union all select 'horizon', count(*), 1, min(date), max(date) from horizon
        union all select 'forecast', count(*), 3, min(date), max(date) from forecast""",
    "series_preview": f"""
        select 'head' as side, date, {dbl("revenue", "cogs")}
        from (select * from stg_sales order by date limit {PREVIEW_ROWS})
        union all
        select 'tail', date, {dbl("revenue", "cogs")}
        from (select * from stg_sales order by date desc limit {PREVIEW_ROWS})""",
    "calendar_parts": f"""
        select date, {dbl("revenue", "cogs")}, cast(year(date) as int) as year,
               cast(dayofyear(date) as int) as day_of_year, cast(month(date) as int) as month,
               cast(day(date) as int) as day
        from stg_sales""",
    "full_year_slice": "select * from growth_years",
    "validation_filter": f"""
        select date, {dbl("revenue", "cogs")} from stg_sales where year(date) in (1999, 2000)""",
    # --- seasonal baseline
    "annual_totals": "select * from annual",
    "yoy_change": """
        select year, round(revenue_change, 9) as revenue_change, round(cogs_change, 9) as cogs_change from changes""",
    "geo_mean_growth": """
        select round(revenue_growth, 9) as revenue_growth, round(cogs_growth, 9) as cogs_growth,
               round((revenue_growth - 1) * 100, 6) as revenue_growth_pct,
               round((cogs_growth - 1) * 100, 6) as cogs_growth_pct
        from growth""",
    "year_mean_normalise": f"""
        select date, {dbl("revenue", "cogs")}, round(revenue_norm, 9) as revenue_norm,
               round(cogs_norm, 9) as cogs_norm
        from normalised""",
    "seasonal_profile": """
        select month, day, round(revenue_season, 9) as revenue_season, round(cogs_season, 9) as cogs_season
        from profile""",
    "base_level": """
        select round(revenue_base, 6) as revenue_base, round(cogs_base, 6) as cogs_base from base""",
    "seasonal_join": """
        select h.date, cast(month(h.date) as int) as month, cast(day(h.date) as int) as day,
               round(coalesce(p.revenue_season, 1.0), 9) as revenue_season,
               round(coalesce(p.cogs_season, 1.0), 9) as cogs_season
        from horizon h left join profile p on month(h.date) = p.month and day(h.date) = p.day""",
    "seasonal_forecast": "select date, years_ahead, revenue_pred, cogs_pred from forecast",
    "seasonal_backcast": f"""
        select date, years_ahead, {dbl("revenue", "cogs")}, round(revenue_pred, 4) as revenue_pred,
               round(cogs_pred, 4) as cogs_pred
        from backcast""",
    "forecast_mape": f"""
        select 'in_sample' as sample,
               round(avg({ratio("abs(cast(revenue as double) - revenue_pred)", "revenue")}) * 100, 6)
                   as revenue_mape,
               round(avg({ratio("abs(cast(cogs as double) - cogs_pred)", "cogs")}) * 100, 6) as cogs_mape
        from backcast
        union all
        select 'hold_out',
               round(avg({ratio("abs(cast(s.revenue as double) - f.revenue_pred)", "s.revenue")}) * 100, 6),
               round(avg({ratio("abs(cast(s.cogs as double) - f.cogs_pred)", "s.cogs")}) * 100, 6)
        from forecast f join stg_sales s using (date)""",
    "seasonal_forecast_by_key": """
        select s.category, s.region, s.date, cast(year(s.date) - 2000 as int) as years_ahead,
               round(b.revenue_base * pow(g.revenue_growth, year(s.date) - 2000) * coalesce(p.revenue_season, 1.0), 2)
                   as revenue_pred,
               round(b.cogs_base * pow(g.cogs_growth, year(s.date) - 2000) * coalesce(p.cogs_season, 1.0), 2)
                   as cogs_pred
        from (select k.category, k.region, h.date
              from (select distinct category, region from k_series) k cross join horizon h) s
             left join k_profile p on s.category is not distinct from p.category
                                      and s.region is not distinct from p.region
                                      and month(s.date) = p.month and day(s.date) = p.day
             left join k_growth g on s.category is not distinct from g.category and s.region is not distinct from g.region
             left join k_base b on s.category is not distinct from b.category and s.region is not distinct from b.region""",
    # --- cleaning and quality
    "clean_standardise": """
        select o_orderkey, o_custkey, nullif(upper(trim(o_orderstatus)), '') as o_orderstatus,
               cast(try_cast(o_totalprice as decimal(12,2)) as double) as o_totalprice,
               try_cast(o_orderdate as date) as o_orderdate, nullif(upper(trim(o_orderpriority)), '') as o_orderpriority,
               o_orderdate is not null and try_cast(o_orderdate as date) is null as o_orderdate_invalid,
               o_totalprice is not null and not isnan(o_totalprice)
                   and try_cast(o_totalprice as decimal(12,2)) is null as o_totalprice_invalid,
               coalesce(cast(try_cast(o_totalprice as decimal(12,2)) as double) <> o_totalprice, false)
                   as o_totalprice_rounded
        from orders""",
    "clean_dedup": f"""
        select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               {dbl("l_quantity", "l_extendedprice", "l_discount", "l_tax")}, l_returnflag, l_linestatus, l_shipdate
        from (select *, row_number() over (
                         partition by l_orderkey, l_linenumber
                         order by l_partkey nulls first, l_suppkey nulls first, l_quantity nulls first,
                                  l_extendedprice nulls first, l_discount nulls first, l_tax nulls first,
                                  l_returnflag nulls first, l_linestatus nulls first, l_shipdate nulls first) as pick
              from (select l_orderkey, l_linenumber, l_partkey, l_suppkey,
                           cast(l_quantity as decimal(12,2)) as l_quantity,
                           cast(l_extendedprice as decimal(12,2)) as l_extendedprice,
                           cast(l_discount as decimal(14,4)) as l_discount, cast(l_tax as decimal(14,4)) as l_tax,
                           upper(trim(l_returnflag)) as l_returnflag, upper(trim(l_linestatus)) as l_linestatus,
                           cast(l_shipdate as date) as l_shipdate
                    from lineitem))
        where pick = 1""",
    "clean_scale_profile": f"""
        select 'lineitem' as table_name, column_name, digits, scale, coalesce(digits <= scale, false) as kept,
               count(*) as row_count
        from (select column_name, scale,
                     cast(case when isinf(number) then null {needed_digits} end as int) as digits
              from (select 'l_quantity' as column_name, 2 as scale, l_quantity as number from lineitem
                    union all select 'l_extendedprice', 2, l_extendedprice from lineitem
                    union all select 'l_discount', 4, l_discount from lineitem
                    union all select 'l_tax', 4, l_tax from lineitem)
              where number is not null and not isnan(number))
        group by all""",
    "clean_nulls": """
        select review_id, product_id, coalesce(rating, 3) as rating, n_chars, rating is null as rating_missing
        from stg_reviews""",
    "clean_link_check": "\nunion all\n".join(
        f"""
        select '{name}' as relationship, 'child_without_parent' as direction, cast({ck} as varchar) as orphan_key,
               count(*) as row_count
        from {child} where {ck} is null or {ck} not in (select {pk} from {parent} where {pk} is not null)
        group by {ck}
        union all
        select '{name}', 'parent_without_child', cast({pk} as varchar), count(*)
        from {parent} where {pk} is null or {pk} not in (select {ck} from {child} where {ck} is not null)
        group by {pk}"""
        for name, child, ck, parent, pk in (
            ("order_items.order_id", "stg_items", "order_id", "stg_orders", "order_id"),
            ("order_items.product_id", "stg_items", "product_id", "stg_products", "product_id"),
            ("orders.customer_id", "stg_orders", "customer_id", "stg_customers", "customer_id"),
            ("customers.nation_id", "stg_customers", "nation_id", "stg_geography", "nation_id"),
            ("reviews.product_id", "stg_reviews", "product_id", "stg_products", "product_id"),
            ("returns.product_id", "stg_returns", "product_id", "stg_products", "product_id"),
            ("payments.order_id", "stg_payments", "order_id", "stg_orders", "order_id"),
            ("inventory.product_id", "stg_inventory", "product_id", "stg_products", "product_id"),
            ("web_traffic.visitor", "stg_web", "visitor", "stg_customers", "customer_id"),
        )
    ),
    "rejected_lines": f"""
        select order_id, line_no, product_id, is_returned, ship_date,
               {dbl("units", "gross", "discount", "net", "cogs", "shipping_fee", "return_amount", "net_profit")}
        from stg_items where order_id is null or order_id not in (select order_id from stg_orders)""",
    # Sketches of days keep their stated error against the exact count of a month.
    "visitors_by_month": f"""
        select {month("date")} as month, source as traffic_source, count(distinct visitor) as unique_visitors,
               true as within_error
        from sessions group by 1, 2""",
    "customers_by_month": f"""
        select {month("order_date")} as month, category, count(distinct customer_id) as customers, true as within_error
        from f_item group by 1, 2""",
    "sales_reconciliation": f"""
        select coalesce(s.date, t.date) as date, cast(s.revenue as double) as series_revenue,
               cast(t.revenue as double) as transaction_revenue,
               cast(coalesce(s.revenue, 0) - coalesce(t.revenue, 0) as double) as difference,
               {ratio("(coalesce(s.revenue, 0) - coalesce(t.revenue, 0)) * 100", "s.revenue")} as difference_pct,
               case when s.revenue is null then 'series' when t.revenue is null then 'transactions' else 'none' end
                   as missing_side
        from stg_sales s full join (select order_date as date, sum(net) as revenue
                                    from f_item group by 1) t on s.date = t.date""",
    # --- dimensions
    "dim_date": "select * from dim_days",
    "dim_customer": "select * from stg_customers",
    "dim_product": """
        select product_id, name, brand, category, size, cast(price as double) as price from stg_products""",
    "dim_geography": "select * from stg_geography",
    "dim_promotion": "select * from stg_promotions",
    "dim_return_reason": "select * from reason_codes",
    "dim_traffic_source": "select * from source_codes",
    # --- facts
    "fact_sales_item": f"""
        select order_id, line_no, product_id, customer_id, nation_id, order_date, ship_date, status, is_cancelled,
               category, age_group, region, payment_method, is_returned, return_reason,
               {dbl("order_payment_value", "units", "gross", "discount", "net", "cogs", "shipping_fee",
                    "returned_units", "return_amount", "gross_profit", "net_profit")}
        from f_item""",
    "fact_orders": f"""
        select order_id, customer_id, order_date, status, is_cancelled, payment_method, line_count,
               {dbl("payment_value", *ORDER_SUMS)}
        from f_orders""",
    "order_line_shares": f"""
        select i.order_id, i.line_no, i.status, cast(i.net as double) as net, cast(o.net as double) as order_net,
               o.line_count, {ratio("i.net", "o.net")} as net_share
        from f_item i join f_orders o using (order_id)""",
    "fact_shipments": """
        select order_id, line_no, order_date, ship_date, lead_days, cast(shipping_fee as double) as shipping_fee,
               not is_valid as is_invalid_date
        from stg_shipments""",
    "fact_returns": f"""
        select r.order_id, r.product_id, o.customer_id, o.order_date, c.return_reason_id, c.return_reason,
               {dbl("units", "return_amount")}
        from stg_returns r join stg_orders o using (order_id) left join reason_codes c on r.reason = c.return_reason""",
    "fact_reviews": "select * from f_reviews",
    "fact_inventory_snapshot": f"""
        select product_id, month, cast(demand as double) as demand, received,
               cast(greatest(received - demand, 0) as double) as available, fill_rate, stockout, overstock,
               sell_through
        from stg_inventory""",
    "fact_sales_series": f"""
        select s.date, {dbl("revenue", "cogs")}, d.year, d.quarter, d.month, d.day, d.iso_weekday, d.is_weekend,
               d.season
        from stg_sales s left join dim_days d on s.date = d.date""",
    "fact_web_traffic": f"""
        select s.date, c.traffic_source_id, c.traffic_source, count(*) as sessions,
               count(distinct s.visitor) as unique_visitors,
               {ratio("count(*) filter (s.events = 1)", "count(*)")} as bounce_rate,
               {ratio("cast(sum(s.length_us) as double) / 1e6", "count(*)")} as mean_session_seconds
        from sessions s left join source_codes c on s.source = c.traffic_source group by 1, 2, 3""",
    # --- marts
    "mart_sales_overview": """
        select order_date, category, region, cast(sum(net) as double) as revenue,
               cast(sum(net_profit) as double) as profit, count(distinct order_id) as orders,
               count(distinct customer_id) as customers, cast(sum(cogs) as double) as cogs,
               cast(sum(return_amount) as double) as return_amount
        from f_item group by 1, 2, 3""",
    "mart_product_performance": f"""
        select m.product_id, m.category, m.month, cast(m.units as double) as units,
               cast(m.revenue as double) as revenue, cast(m.profit as double) as profit,
               {ratio("m.profit", "m.revenue")} as margin, {ratio("m.returned", "m.units")} as return_rate,
               r.mean_rating,
               rank() over (partition by m.category, m.month order by m.revenue desc) as rank_in_category
        from (select product_id, category, {month("order_date")} as month, sum(units) as units, sum(net) as revenue,
                     sum(net_profit) as profit, sum(returned_units) as returned
              from f_item group by 1, 2, 3) m
             left join (select product_id, {ratio("sum(rating)", "count(rating)")} as mean_rating
                        from f_reviews group by 1) r on m.product_id = r.product_id""",
    "mart_customer_insight": f"""
        select o.customer_id, c.age_group, g.region, count(*) as orders, cast(sum(o.net) as double) as revenue,
               cast(sum(o.net_profit) as double) as profit, min(o.order_date) as first_order,
               max(o.order_date) as last_order,
               cast((select max(order_date) from stg_orders) - max(o.order_date) as int) as recency_days,
               {ratio("sum(o.returned_units)", "sum(o.units)")} as return_rate
        from f_orders o left join stg_customers c using (customer_id) left join stg_geography g using (nation_id)
        group by 1, 2, 3""",
    "mart_promotion_effectiveness": f"""
        with_daily as (
            select order_date as date, category, sum(net) as net, sum(discount) as discount from f_item group by 1, 2),
        with_sides as (
            select p.promo_id, p.category, p.discount_pct,
                   greatest(any_value(least(p.end_date, s.last_day) - greatest(p.start_date, s.first_day)) + 1, 0)
                       as active_days,
                   any_value(s.last_day - s.first_day) + 1 as all_days,
                   coalesce(sum(d.net) filter (d.date between p.start_date and p.end_date), 0) as inside,
                   coalesce(sum(d.discount) filter (d.date between p.start_date and p.end_date), 0) as discount_amount,
                   sum(d.net) filter (d.date not between p.start_date and p.end_date) as outside
            from stg_promotions p
                 cross join (select min(date) as first_day, max(date) as last_day from with_daily) s
                 left join with_daily d on p.category = d.category group by 1, 2, 3)
        select promo_id, category, discount_pct, active_days, cast(inside as double) as revenue_inside,
               cast(discount_amount as double) as discount_amount,
               {ratio("inside", "active_days")} as revenue_per_active_day,
               {ratio("outside", "all_days - active_days")} as revenue_per_other_day,
               {ratio(ratio("inside", "active_days"), ratio("outside", "all_days - active_days"))} - 1 as lift
        from with_sides""",
    "mart_return_diagnostics": f"""
        select r.category, r.region, r.month, r.return_reason, cast(r.units as double) as returned_units,
               cast(r.return_amount as double) as return_amount, {ratio("r.units", "s.units")} as return_rate
        from (select category, region, {month("order_date")} as month, return_reason, sum(units) as units,
                     sum(return_amount) as return_amount
              from f_item where is_returned group by 1, 2, 3, 4) r
             join (select category, region, {month("order_date")} as month, sum(units) as units
                   from f_item group by 1, 2, 3) s
             on r.category is not distinct from s.category and r.region is not distinct from s.region
                and r.month is not distinct from s.month""",
    "mart_shipping_service": f"""
        select region, {month("order_date")} as month, count(*) as lines,
               {ratio("count(*) filter (ship_date >= order_date)", "count(*)")} as valid_share,
               {ratio("sum(ship_date - order_date) filter (ship_date >= order_date)",
                      "count(*) filter (ship_date >= order_date)")} as mean_lead_days,
               round(quantile_cont(cast(ship_date - order_date as double), 0.5)
                     filter (ship_date >= order_date), 6) as median_lead_days,
               round(quantile_cont(cast(ship_date - order_date as double), 0.9)
                     filter (ship_date >= order_date), 6) as p90_lead_days,
               cast(sum(shipping_fee) as double) as shipping_fee, {ratio("sum(shipping_fee)", "sum(net)")} as fee_share
        from f_item group by 1, 2""",
    "mart_inventory_risk": """
        select product_id, month, fill_rate, stockout, overstock, sell_through,
               case when stockout then 'stockout' when overstock then 'overstock' else 'healthy' end as risk
        from stg_inventory""",
    "mart_operations": f"""
        select coalesce(o.month, l.month, i.month) as month, o.orders, o.cancel_rate, l.mean_lead_days, l.return_rate,
               i.fill_rate, i.stockout_rate
        from (select {month("order_date")} as month, count(*) as orders,
                     {ratio("count(*) filter (is_cancelled)", "count(*)")} as cancel_rate
              from stg_orders group by 1) o
             full join (select {month("order_date")} as month,
                               {ratio("sum(ship_date - order_date) filter (ship_date >= order_date)",
                                      "count(*) filter (ship_date >= order_date)")} as mean_lead_days,
                               {ratio("sum(returned_units)", "sum(units)")} as return_rate
                        from f_item group by 1) l on o.month = l.month
             full join monthly_inventory i on coalesce(o.month, l.month) = i.month""",
    "mart_sales_forecast_ready": f"""
        select s.date, s.date < date '2001-01-01' as is_train, {dbl("s.revenue").replace("as s.", "as ")},
               cast(s.cogs as double) as cogs, cast(isodow(s.date) - 1 as int) as day_of_week,
               cast(day(s.date) as int) as day_of_month, cast(month(s.date) as int) as month,
               cast(quarter(s.date) as int) as quarter, {is_weekend("s.date")} as is_weekend,
               {season("s.date")} as season,
               round(sin(2.0 * pi() * dayofyear(s.date) / 365.0), 6) as sin365,
               round(cos(2.0 * pi() * dayofyear(s.date) / 365.0), 6) as cos365,
               coalesce(p.active_promo_count, 0) as active_promo_count,
               coalesce(p.max_discount_depth, 0) as max_discount_depth,
               coalesce(p.stacked_discount, 0) as stacked_discount,
               coalesce(p.is_stackable_day, false) as is_stackable_day,
               {EXPECTED_MEAN_COLUMNS}, coalesce(e_traffic.history, 0) = 0 as traffic_is_imputed,
               {names("median", MEDIAN_COLUMNS)}, coalesce(e_orders.history, 0) as history_years
        from (select coalesce(x.date, h.date) as date, x.revenue, x.cogs
              from stg_sales x full join horizon h on x.date = h.date) s
             left join promo_signals p on s.date = p.date
             {on_calendar_day("s", "e_orders", "e_inventory", "e_traffic")}""",
    # --- reports
    "report_business_overview": """
        select month, cast(revenue as double) as revenue, cast(profit as double) as profit, orders, customers,
               cast(cogs as double) as cogs, cast(return_amount as double) as return_amount,
               cast(revenue as double) / nullif(cast(lag(revenue) over m as double), 0) - 1 as revenue_growth,
               cast(profit as double) / nullif(cast(lag(profit) over m as double), 0) - 1 as profit_growth,
               cast(orders as double) / nullif(cast(lag(orders) over m as double), 0) - 1 as orders_growth
        from (select %s as month, sum(net) as revenue, sum(net_profit) as profit, count(*) as orders,
                     count(distinct customer_id) as customers, sum(cogs) as cogs, sum(return_amount) as return_amount
              from f_orders group by 1)
        window m as (order by month)"""
    % month("order_date"),
    "report_profit_diagnostic": f"""
        with_lead as (
            select date, category, promo_id,
                   row_number() over (partition by date, category order by discount_pct desc, promo_id) as pick
            from promo_days),
        with_lines as (
            select l.promo_id, i.* from f_item i
            left join (select * from with_lead where pick = 1) l
                 on i.order_date = l.date and i.category = l.category)
        select case when grouping(promo_id) = 0 then 'promotion' when grouping(category) = 0 then 'category'
                    when grouping(region) = 0 then 'region' else 'total' end as level,
               promo_id, category, region, cast(sum(net) as double) as revenue, cast(sum(cogs) as double) as cogs,
               cast(sum(discount) as double) as discount, cast(sum(shipping_fee) as double) as shipping_fee,
               cast(sum(return_amount) as double) as return_amount, cast(sum(net_profit) as double) as profit,
               {ratio("sum(net_profit)", "sum(net)")} as margin
        from with_lines group by grouping sets ((promo_id), (category), (region), ())""",
    "report_segment_insight": "select * from segment_insight",
    "report_segment_flags": """
        select segment_type, segment,
               revenue_rank >= 0.75 and margin_rank <= 0.25 as high_revenue_low_profit,
               mean_rating is not null and rating_rank >= 0.75 and return_rank >= 0.75 as good_rating_high_returns,
               segment_type = 'region' and fee_rank >= 0.75 as high_shipping_cost
        from (select *,
                     percent_rank() over (partition by segment_type order by revenue nulls first) as revenue_rank,
                     percent_rank() over (partition by segment_type order by margin nulls first) as margin_rank,
                     percent_rank() over (partition by segment_type order by mean_rating nulls first) as rating_rank,
                     percent_rank() over (partition by segment_type order by return_rate nulls first) as return_rank,
                     percent_rank() over (partition by segment_type order by shipping_fee_share nulls first)
                         as fee_rank
              from segment_insight)""",
    "report_abnormal_growth": """
        with_months as (
            select %s as month, sum(net) as revenue from f_orders group by 1),
        with_growth as (
            select month, cast(revenue as double) as revenue,
                   cast(revenue as double) / nullif(lag(cast(revenue as double)) over (order by month), 0) - 1
                       as growth
            from with_months),
        with_history as (
            select *, count(growth) over b as history, max(growth) over b as top,
                   max(growth) over b = min(growth) over b as flat,
                   case when max(growth) over b <> min(growth) over b
                        then (growth - avg(growth) over b) / nullif(stddev_samp(growth) over b, 0) end as z_score
            from with_growth where growth is not null
            window b as (order by month rows between 12 preceding and 1 preceding))
        select month, revenue, growth, round(z_score, 6) as z_score,
               case when coalesce(z_score > 0, growth > top) then 'growth' else 'decline' end as direction
        from with_history where history = 12 and (abs(z_score) > 2 or (flat and growth <> top))"""
    % month("order_date"),
    # --- features
    "feat_calendar": f"""
        select date, cast(isodow(date) - 1 as int) as day_of_week, cast(day(date) as int) as day_of_month,
               cast(month(date) as int) as month, cast(quarter(date) as int) as quarter,
               {is_weekend("date")} as is_weekend
        from dim_days""",
    "feat_season": "select date, season from dim_days",
    "feat_sincos365": """
        select date, round(sin(2.0 * pi() * dayofyear(date) / 365.0), 6) as sin365,
               round(cos(2.0 * pi() * dayofyear(date) / 365.0), 6) as cos365
        from dim_days""",
    "feat_promotion": """
        select d.date, coalesce(p.active_promo_count, 0) as active_promo_count,
               coalesce(p.max_discount_depth, 0) as max_discount_depth,
               coalesce(p.stacked_discount, 0) as stacked_discount,
               coalesce(p.is_stackable_day, false) as is_stackable_day
        from dim_days d left join promo_signals p on d.date = p.date""",
    "feat_traffic": """
        select date, session_count, mean_session_seconds, unique_visitors, bounce_rate from daily_traffic""",
    "feat_age_groups": f"select date, {', '.join(AGE_FEATURES)} from daily_operations",
    "feat_cancel_rate": "select date, cancel_rate from daily_operations",
    "feat_order_volume": """
        select date, aov, item_sold, unique_order from daily_operations""",
    "feat_inventory_health": """
        select date, fill_rate, stockout_rate, overstock_rate, sell_through from daily_inventory""",
    "feat_business_diagnostic": """
        select date, return_amount, shipping_fee, cogs, profit from daily_operations""",
    "feat_expected_mean": f"""
        select h.date, {EXPECTED_MEAN_COLUMNS}, coalesce(e_traffic.history, 0) = 0 as traffic_is_imputed
        from horizon h {on_calendar_day("h", "e_orders", "e_inventory", "e_traffic")}""",
    "feat_expected_median": f"""
        select h.date, {names("median", MEDIAN_COLUMNS)} from horizon h {on_calendar_day("h", "e_orders")}""",
    # --- model
    "trend_ridge": """
        with_time as (
            select date, (date - date '2001-01-01') / 365.0 as t, cast(revenue as double) as revenue,
                   cast(cogs as double) as cogs from stg_sales),
        with_fit as (
            select avg(t) as mt, avg(revenue) as mr, avg(cogs) as mc,
                   covar_pop(revenue, t) * count(*) / (var_pop(t) * count(*) + 1.0) as sr,
                   covar_pop(cogs, t) * count(*) / (var_pop(t) * count(*) + 1.0) as sc
            from with_time where date < date '2001-01-01')
        select date,
               round((select mr from with_fit) + (select sr from with_fit) * (t - (select mt from with_fit)), 2)
                   as revenue_trend,
               round((select mc from with_fit) + (select sc from with_fit) * (t - (select mt from with_fit)), 2)
                   as cogs_trend
        from with_time""",
    "trend_residual": """
        with_time as (
            select date, (date - date '2001-01-01') / 365.0 as t, cast(revenue as double) as revenue,
                   cast(cogs as double) as cogs from stg_sales),
        with_fit as (
            select regr_slope(revenue, t) as rs, regr_intercept(revenue, t) as ri, regr_slope(cogs, t) as cs,
                   regr_intercept(cogs, t) as ci
            from with_time where date < date '2001-01-01'),
        with_trend as (
            select date, revenue, cogs, (select ri from with_fit) + (select rs from with_fit) * t as rt,
                   (select ci from with_fit) + (select cs from with_fit) * t as ct
            from with_time)
        select date, round(rt, 2) as revenue_trend, round(ct, 2) as cogs_trend,
               round(revenue - rt, 2) as revenue_residual, round(cogs - ct, 2) as cogs_residual
        from with_trend""",
    "ts_cross_validation": "select fold, date, split from cv_rows",
    "forecast_metrics": """
        with_fit as (
            select fold, avg(t) as mt, avg(revenue) as mr, avg(cogs) as mc,
                   covar_pop(revenue, t) * count(*) / (var_pop(t) * count(*) + 1.0) as sr,
                   covar_pop(cogs, t) * count(*) / (var_pop(t) * count(*) + 1.0) as sc
            from cv_rows where split = 'train' group by 1),
        with_scores as (
            select r.fold, 'revenue' as target, r.revenue as actual, f.mr + f.sr * (r.t - f.mt) as pred
            from cv_rows r join with_fit f on r.fold = f.fold where r.split = 'test'
            union all
            select r.fold, 'cogs', r.cogs, f.mc + f.sc * (r.t - f.mt)
            from cv_rows r join with_fit f on r.fold = f.fold where r.split = 'test')
        select fold, target, count(*) as row_count, round(sqrt(avg((actual - pred) * (actual - pred))), 4) as rmse,
               round(avg(abs(actual - pred)), 4) as mae,
               round(1 - sum((actual - pred) * (actual - pred)) / nullif(var_pop(actual) * count(*), 0), 6) as r2
        from with_scores group by 1, 2""",
}

def _huber(rounds: int = 10) -> str:
    """The rounds of reweighted least squares, one block each; targets are rows."""
    blocks = ["""
        with_time as materialized (
            select date, t, target, actual from (
                select date, (date - date '2001-01-01') / 365.0 as t, cast(revenue as double) as revenue,
                       cast(cogs as double) as cogs from stg_sales) unpivot (actual for target in (revenue, cogs))),
        with_train as materialized (select * from with_time where date < date '2001-01-01'),
        with_fit_0 as materialized (
            select target, regr_slope(actual, t) as slope, avg(t) as mt, avg(actual) as m,
                   cast('infinity' as double) as scale
            from with_train group by 1)"""]
    for k in range(rounds + 1):
        blocks.append(f"""
        with_weight_{k} as (
            select *, case when abs(r) <= 1.35 * scale then 1.0 else 1.35 * scale / abs(r) end as w
            from (select target, scale, t - mt as dt, actual - (m + slope * (t - mt)) as r
                  from with_train join with_fit_{k} using (target))),
        with_sums_{k} as (
            select target, sum(w) as n, sum(w * dt) as st, sum(w * r) as sr, sum(w * dt * dt) as stt,
                   sum(w * dt * r) as srt, median(abs(r)) / 0.6745 as new_scale
            from with_weight_{k} group by 1),
        with_fit_{k + 1} as materialized (
            select target, slope + coalesce((srt - st * sr / n) / nullif(stt - st * st / n, 0), 0) as slope,
                   mt + st / n as mt, m + (slope * st + sr) / n as m, new_scale as scale
            from with_fit_{k} join with_sums_{k} using (target))""")
    trend = f"(select m + slope * (w.t - mt) from with_fit_{rounds + 1} where target = '{{}}')"
    return ",".join(blocks) + f"""
        select date, round({trend.format("revenue")}, 2) as revenue_trend, round({trend.format("cogs")}, 2) as cogs_trend
        from with_time w where target = 'revenue'"""


BODIES["trend_huber"] = _huber()

EXTRA_CTES = {
    "cv_rows": """
        select f.fold, s.date, (s.date - date '2001-01-01') / 365.0 as t, cast(s.revenue as double) as revenue,
               cast(s.cogs as double) as cogs, case when s.date < f.cut then 'train' else 'test' end as split
        from stg_sales s join (values (1, date '1998-01-01', date '1999-01-01'),
                                      (2, date '1999-01-01', date '2000-01-01'),
                                      (3, date '2000-01-01', date '2001-01-01'),
                                      (4, date '2001-01-01', date '2002-01-01')) f(fold, cut, stop)
             on s.date < f.stop""",
    "segment_insight": "\nunion all\n".join(
        f"""
        select '{column}' as segment_type, i.{column} as segment, cast(sum(net) as double) as revenue,
               cast(sum(net_profit) as double) as profit, {ratio("sum(net_profit)", "sum(net)")} as margin,
               count(distinct order_id) as orders, {ratio("sum(returned_units)", "sum(units)")} as return_rate,
               {ratio("sum(shipping_fee)", "sum(net)")} as shipping_fee_share,
               {"any_value(r.mean_rating)" if column == "category" else "cast(null as double)"} as mean_rating
        from f_item i {f'''left join (select category, {ratio("sum(rating)", "count(rating)")} as mean_rating
                                   from f_reviews group by 1) r on i.category = r.category'''
                       if column == "category" else ""}
        group by 2"""
        for column in ("age_group", "category", "region")
    ),
}

# Rows checked, missing cells, repeated keys, missing parents and bad dates per table:
# table, source, key, columns, bad-date rule, foreign keys.
CHECKS = (
    ("customers", "stg_customers", "customer_id", "customer_id age_group nation_id", "false",
     (("nation_id", "stg_geography"),)),
    ("geography", "stg_geography", "nation_id", "nation_id nation region", "false", ()),
    ("products", "stg_products", "product_id", "product_id name brand category size price", "false", ()),
    ("promotions", "stg_promotions", "promo_id", "promo_id start_date end_date discount_pct stackable category",
     "end_date < start_date", ()),
    ("orders", "stg_orders", "order_id", "order_id customer_id order_date status is_cancelled",
     "order_date is null", (("customer_id", "stg_customers"),)),
    ("order_items", "stg_items", "order_id, line_no",
     "order_id line_no product_id category units gross discount net cogs shipping_fee is_returned returned_units"
     " return_reason return_amount gross_profit net_profit ship_date",
     "ship_date is null", (("order_id", "stg_orders"), ("product_id", "stg_products"))),
    ("payments", "stg_payments", "order_id", "order_id payment_method payment_value", "false",
     (("order_id", "stg_orders"),)),
    ("shipments", "stg_shipments", "order_id, line_no",
     "order_id line_no ship_date shipping_fee order_date lead_days is_valid", "not is_valid",
     (("order_id", "stg_orders", "stg_lines"),)),
    ("returns", "stg_returns", "order_id, product_id", "order_id product_id units return_amount reason", "false",
     (("order_id", "stg_orders"), ("product_id", "stg_products"))),
    ("reviews", "stg_reviews", "review_id", "review_id product_id rating n_chars", "false",
     (("product_id", "stg_products"),)),
    ("inventory", "stg_inventory", "product_id, month",
     "product_id month demand received fill_rate stockout overstock sell_through", "month is null",
     (("product_id", "stg_products"),)),
    ("web_traffic", "stg_web", "event_id", "event_id ts visitor source event_date", "ts is null", ()),
    ("sales", "stg_sales", "date", "date revenue cogs", "date is null", ()),
)


def _quality(table: str, source: str, key: str, columns: str, bad: str, parents: tuple) -> str:
    nulls = " + ".join(f"count(*) - count({c})" for c in columns.split())
    orphans = " + ".join(
        f"(select count(*) from {child[0] if child else source} where {k} is null"
        f" or {k} not in (select {k} from {p} where {k} is not null))"
        for k, p, *child in parents
    )
    return f"""
        select '{table}' as table_name, count(*) as row_count, cast({nulls} as bigint) as null_cells,
               cast(count(*) - (select count(*) from (select distinct {key} from {source})) as bigint)
                   as duplicate_rows,
               cast({orphans or 0} as bigint) as orphan_rows, count(*) filter ({bad}) as bad_dates
        from {source}"""


BODIES["quality_report"] = "\nunion all\n".join(_quality(*check) for check in CHECKS)

SUMMARY_DATES = {
    "promotions": "start_date", "orders": "order_date", "order_items": "ship_date", "shipments": "ship_date",
    "inventory": "month", "web_traffic": "event_date", "sales": "date",
}


def _summary(table: str, source: str, columns: str) -> str:
    date = SUMMARY_DATES.get(table)
    span = f"min({date}), max({date})" if date else "cast(null as date), cast(null as date)"
    first, last = span.split("), ")
    return f"""
        select '{table}' as table_name, count(*) as row_count, cast({len(columns.split())} as int) as column_count,
               {first}) as first_date, {last} as last_date
        from {source}"""


BODIES["processed_table_summary"] = "\nunion all\n".join(
    _summary(table, source, columns) for table, source, _, columns, _, _ in CHECKS
)

# Column count of each warehouse table.
TABLE_COLUMNS = {
    "dim": {
        "dim_date": 8, "dim_customer": 3, "dim_product": 6, "dim_geography": 3, "dim_promotion": 6,
        "dim_return_reason": 2, "dim_traffic_source": 2,
    },
    "fact": {
        "fact_sales_item": 26, "fact_orders": 18, "fact_shipments": 7, "fact_returns": 8, "fact_reviews": 5,
        "fact_inventory_snapshot": 9, "fact_sales_series": 10, "fact_web_traffic": 7,
    },
    "mart": {
        "mart_sales_overview": 9, "mart_product_performance": 10, "mart_customer_insight": 10,
        "mart_promotion_effectiveness": 9, "mart_return_diagnostics": 7, "mart_shipping_service": 9,
        "mart_inventory_risk": 7, "mart_operations": 7, "mart_sales_forecast_ready": 42,
    },
}
