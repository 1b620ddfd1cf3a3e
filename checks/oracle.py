"""The named queries as one SQL statement each, over the plain test tables.

``VIEWS`` are the operator inputs of ``checks.views``; ``sql`` puts the ones a statement needs
in front of it, in order of their dependence.
"""

from __future__ import annotations

import re

PRODUCTS = "(values ('Deposit'), ('LARGE'), ('Loan'), ('MEDIUM'), ('SMALL'), ('STANDARD'))"

VIEWS = {
    # ---- facts ----
    "lines": """
        select 'R1' as run_id, r_name as business_unit, c_mktsegment as business_segment_group,
          concat('CC', cast(c_nationkey as varchar)) as cost_centre, n_name as nation,
          case p_type when 'ECONOMY' then 'Loan' when 'PROMO' then 'Deposit' else p_type end as product,
          p_brand as brand,
          case when r_name in ('AMERICA', 'ASIA') then 'USD' else 'EUR' end as currency,
          l_suppkey as supplier, l_returnflag as flag, cast(l_shipdate as date) as period_date,
          cast(l_extendedprice as decimal(18,4)) as amount,
          cast(l_extendedprice * l_discount as decimal(18,4)) as income,
          cast(l_extendedprice * l_tax as decimal(18,4)) as fee
        from lineitem join orders on l_orderkey = o_orderkey
          join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
          join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey""",
    "actuals": """
        select run_id, business_unit, business_segment_group, cost_centre, product, currency,
          cast(year(period_date) as int) as period_year,
          sum(amount) as actual_balance, sum(income) as actual_income
        from lines group by all""",
    "annual": """
        select run_id, business_unit,
          case when business_unit = 'AFRICA' then concat('NEW ', business_segment_group)
            else business_segment_group end as business_segment_group, product, currency,
          cast(sum(amount) as double) / count(distinct year(period_date)) * 1.05e0 as annual_forecast_amount,
          case when product in ('Loan', 'LARGE') then 'prior_actual'
               when product = 'SMALL' then 'unknown' else 'flat' end as substitution_code
        from lines group by 1, 2, 3, 4, 5""",
    "monthly_positions": """
        select run_id, business_unit, business_segment_group, cost_centre, product, currency,
          cast(date_trunc('month', period_date) as date) as period_date, sum(amount) as balance
        from lines group by all""",
    "postings": """
        select run_id, business_unit, product, period_date,
          case when flag = 'R' then 'INT_EXP' else 'INT_INC' end as accounting_element,
          income as amount, 'interest' as posting_category from lines
        union all
        select run_id, business_unit, product, period_date, 'FEE_INC', fee, 'fee' from lines""",
    "scenario_forecast": """
        select business_unit, product, currency,
          cast(date_trunc('month', period_date) as date) as target_date, amount as forecast_balance,
          case flag when 'A' then 'baseline' when 'N' then 'adverse' else 'upside' end as scenario
        from lines""",
    "segment_months": """
        select concat(business_unit, '|', product) as segment,
          cast(date_trunc('month', period_date) as date) as period_date,
          case when count(*) % 3 <> 0 then sum(amount) end as balance
        from lines group by 1, 2""",
    # ---- run configuration ----
    "unit_products": f"""
        select 'R1' as run_id, r_name as business_unit, r_regionkey, product
        from region, {PRODUCTS} p(product)""",
    "rules": """
        select 'R1' as run_id, x.code as substitution_code, x.code as substitution_type
        from (values ('flat'), ('prior_actual')) x(code)""",
    "windows": """
        select 'R1' as run_id, r_name as business_unit, date '2000-01-01' as window_start,
          date '2000-12-31' as window_end, cast(30 + r_regionkey as bigint) as window_days
        from region where r_regionkey <> 4""",
    "overlapping_windows": """
        select 'R1' as run_id, r_name as business_unit, x.a as window_start, x.b as window_end
        from region, (values (date '1999-01-01', date '1999-12-31'), (date '1999-06-01', date '2000-06-30'),
          (date '1996-01-01', date '1996-06-30')) x(a, b)
        where r_regionkey <> 4""",
    "proxies": """
        select run_id, business_unit, product, 'ASIA' as proxy_business_unit, product as proxy_product,
          0.9e0 as scale_ratio, 100e0 as fixed_adjustment
        from unit_products where r_regionkey in (0, 1) and product <> 'Loan'""",
    "inflation": """
        select run_id, business_unit, product, 0.5e0 as lag_0, 0.3e0 as lag_1,
          case when r_regionkey <> 2 then 0.2e0 end as lag_2, r_regionkey * 1e-1 as lag_3
        from unit_products where product <> 'STANDARD'""",
    "yield_map": """
        select run_id, business_unit, product, 'USD' as currency, concat(product, '_CURVE') as yield_index
        from unit_products""",
    "overrides": """
        select run_id, business_unit, product, 'EUR' as currency, 1.1e0 as override_factor
        from unit_products where product in ('Loan', 'Deposit')""",
    "period_overrides": """
        select run_id, business_unit, product, 'USD' as currency, 0.9e0 as period_override
        from unit_products where product in ('Loan', 'Deposit')""",
    "ratios": """
        select 'R1' as run_id, r_name as business_unit,
          concat('CC', cast(n_nationkey as varchar)) as cost_centre,
          (n_nationkey % 4 + 1) * 1e-1 as cc_ratio, 1e0 + 0.25e0 * (n_nationkey % 2) as fe_weight
        from nation join region on n_regionkey = r_regionkey where r_regionkey <> 3""",
    # ---- the stages ----
    "forecast": """
        select a.run_id, a.substitution_code, business_unit, business_segment_group, product, currency,
          annual_forecast_amount, substitution_type, annual_forecast_amount / 12 as monthly_forecast_balance,
          make_date(2001, m.month, 1) as forecast_month,
          annual_forecast_amount / 12
            * case when substitution_type = 'prior_actual' then 0.95e0 else 1e0 end as forecast_balance
        from annual a
          left join rules r on a.run_id = r.run_id and a.substitution_code = r.substitution_code,
          (select unnest(generate_series(1, 12)) as month) m""",
    "positions": """
        select a.run_id, a.business_unit, business_segment_group, cost_centre, product, currency,
          cast(sum(actual_balance) as double) / count(actual_balance) as launchpoint_balance,
          cast(sum(actual_income) as double) / count(actual_income) as launchpoint_income,
          max(window_days) as window_days, max(window_days) / 360e0 as launchpoint_day_count
        from actuals a join windows w on a.run_id = w.run_id and a.business_unit = w.business_unit
        group by a.run_id, a.business_unit, business_segment_group, cost_centre, product, currency""",
    "launch": """
        select p.*, f.forecast_month, f.forecast_balance
        from positions p left join forecast f
          on p.run_id = f.run_id and p.business_unit = f.business_unit
          and p.business_segment_group = f.business_segment_group
          and p.product = f.product and p.currency = f.currency""",
    "driven": """
        select *, case when currency = 'USD' then 1e0 else 0.95e0 end as currency_mix,
          0.98e0 as net_exposure_factor, 1.02e0 as net_rate_factor,
          case when product = 'Loan' then 0.055e0 else 0.015e0 end as base_yield
        from launch""",
    "proxied": """
        select d.*, proxy_business_unit, proxy_product, scale_ratio, fixed_adjustment,
          case when proxy_business_unit is not null
               then launchpoint_balance * scale_ratio + fixed_adjustment
               else launchpoint_balance end as proxy_adjusted_balance
        from driven d left join proxies x
          on d.run_id = x.run_id and d.business_unit = x.business_unit and d.product = x.product""",
    "inflated": """
        select p.*, lag_0, lag_1, lag_2, lag_3,
          1e0 + (coalesce(lag_0, 0e0) + coalesce(lag_1, 0e0) + coalesce(lag_2, 0e0)
                 + coalesce(lag_3, 0e0)) / 100 as inflation_adjustment_factor
        from proxied p left join inflation i
          on p.run_id = i.run_id and p.business_unit = i.business_unit and p.product = i.product""",
    "yields": """
        select i.*, yield_index, override_factor,
          coalesce(base_yield, 0.05e0) * coalesce(inflation_adjustment_factor, 1e0)
            * coalesce(override_factor, 1e0) as yield_delta
        from inflated i
          left join yield_map y on i.run_id = y.run_id and i.business_unit = y.business_unit
            and i.product = y.product and i.currency = y.currency
          left join overrides o on i.run_id = o.run_id and i.business_unit = o.business_unit
            and i.product = o.product and i.currency = o.currency""",
    "income": """
        select *, 1e0 as day_count_fraction,
          coalesce(forecast_balance, 0e0) - coalesce(launchpoint_balance, 0e0) as delta_balance,
          (coalesce(forecast_balance, 0e0) - coalesce(launchpoint_balance, 0e0)) * currency_mix
            * net_exposure_factor * yield_delta * 1e0 as nii_business_unit
        from yields""",
    "unit_weights": """
        select run_id, business_unit,
          cast(sum(cast(cc_ratio * fe_weight as decimal(38,18))) as double) as allocation_denominator
        from ratios group by run_id, business_unit""",
    "allocated": """
        select t.run_id, t.business_unit, t.nii_business_unit, cost_centre, cc_ratio, fe_weight,
          allocation_denominator,
          t.nii_business_unit * cc_ratio * fe_weight / nullif(allocation_denominator, 0) as nii_cost_centre
        from (select run_id, business_unit,
                cast(sum(cast(nii_business_unit as decimal(38,10))) as double) as nii_business_unit
              from income group by run_id, business_unit) t
          join ratios r on t.run_id = r.run_id and t.business_unit = r.business_unit
          join unit_weights w on t.run_id = w.run_id and t.business_unit = w.business_unit""",
    # ---- versioned configuration ----
    "versions": """
        select * from (values
          ('v1', 1e0, date '1995-01-01', date '1999-01-01'),
          ('v2', 2e0, date '1999-01-01', cast(null as date)))
          v(config_version, f, effective_date, expiry_date)""",
    "parameter_store": """
        select concat('CFG', cast(p_partkey as varchar)) as config_key, config_version,
          p_retailprice * f as configdouble1, effective_date, expiry_date
        from part, versions""",
    "active_versions": """
        select concat('CFG', cast(p_partkey as varchar)) as config_key, config_version,
          config_version = 'v1' or p_size % 2 = 0 as active_flag, effective_date as activated_at
        from part, versions""",
    "requested_versions": """
        select concat('CFG', cast(s_suppkey as varchar)) as config_key,
          case s_suppkey % 3 when 0 then 'v1' when 1 then 'v9' else 'v2' end as config_version
        from supplier""",
    "catalog": """
        select concat(case when p_size <= 25 then 'CFG' else 'OTHER' end, cast(p_partkey as varchar)) as config_key,
          p_type as config_category, p_name as description, p_brand as example_usage
        from part""",
    "supplier_store": """
        select concat('CFG', cast(s_suppkey as varchar)) as config_key, 'v1' as config_version,
          2 as configint1, make_date(1996 + s_suppkey % 3, 1, 1) as effective_date,
          make_date(1998 + s_suppkey % 3, 1, 1) as expiry_date from supplier
        union all
        select concat('CFG', cast(s_suppkey as varchar)), 'v2', 3,
          make_date(1998 + s_suppkey % 3, 1, 1), null from supplier""",
    # ---- scope, hierarchies, dated lookups ----
    "run_scope": """
        select distinct 'R1' as run_id, r_name as business_unit, c_mktsegment as business_segment_group,
          concat('CC', cast(c_nationkey as varchar)) as cost_centre,
          case when r_name in ('AMERICA', 'ASIA') then 'USD' else 'EUR' end as currency
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "chosen_versions": """
        select config_key, coalesce(q.config_version, a.config_version) as config_version
        from requested_versions q full join (
          select config_key, arg_max(config_version, activated_at) as config_version
          from active_versions where active_flag group by config_key) a using (config_key)""",
    "quality_rules": """
        select * from (values
          ('income agrees', 'income', 0.01e0, false, 'error'), ('income is near', 'income', 0.0001e0, true, 'warning'),
          ('fees agree', 'fee', 0.01e0, false, 'error'), ('fees are known', 'fee', 1e0, true, 'info'),
          ('balances agree', 'balance', 0.01e0, false, 'error'))
          r(rule, measure, tolerance, is_relative, severity)""",
    "scope": """
        select case when r_regionkey <> 2 then r_name end as business_unit,
          case r_regionkey when 0 then 'Loan' when 2 then 'Deposit' when 3 then 'LARGE' end as product,
          case when r_regionkey in (1, 2, 4) then 'USD' when r_regionkey = 3 then 'EUR' end as currency
        from region""",
    "unit_edges": """
        select n_name as node, r_name as up from nation join region on n_regionkey = r_regionkey
        union all select r_name, case when r_regionkey in (1, 3) then 'WEST' else 'EAST' end from region
        union all select 'WEST', 'GROUP' union all select 'EAST', 'GROUP'""",
    "product_edges": """
        select distinct p_brand as node, concat('House ', right(p_brand, 1)) as up from part
        union all select distinct concat('House ', right(p_brand, 1)), 'All brands' from part""",
    "element_edges": """
        select * from (values ('INT_INC', 'Net Interest Income'), ('INT_EXP', 'Net Interest Income'),
          ('FEE_INC', 'Non-Interest Income'), ('Net Interest Income', 'Income'),
          ('Non-Interest Income', 'Income')) e(node, up)""",
    "bridge": f"""
        select concat('CC', cast(n_nationkey as varchar)) as cost_centre, r_name as business_unit,
          product, n_nationkey % 5 <> 0 as is_leaf
        from nation join region on n_regionkey = r_regionkey, {PRODUCTS} p(product)""",
    "market": """
        select concat('A', cast(n_nationkey as varchar)) as assumption_id, 'OIS' as curve_type,
          '6M' as tenor, case when n_nationkey % 2 = 0 then 'USD' else 'EUR' end as currency,
          cast(n_nationkey * 1e-3 as decimal(18,8)) as value,
          make_date(1995 + cast(floor(n_nationkey / 4e0) as int), 1 + n_nationkey % 12, 1) as effective_date
        from nation""",
    "curve_map": """
        select business_unit, product, c.currency, 'OIS' as curve_type, '6M' as tenor
        from unit_products, (values ('EUR'), ('USD')) c(currency) where product <> 'STANDARD'""",
    "fx_rates": """
        select 'EUR' as currency, effective_date, 1e0 + cast(max(value) as double) as fx_rate
        from market group by effective_date""",
    "inflation_curves": """
        select n_name as country, 'CPI' as inflation_curve,
          cast(1 + (n_nationkey + step) * 1e-2 as decimal(9,6)) as adjustment_factor,
          make_date(1996 + n_nationkey % 3 + step * 2, 3, 15) as as_of_date
        from nation, (values (0), (1), (2)) s(step)""",
    "scaling": """
        select r_name as business_unit, 'season' as scaling_category,
          cast(1e0 + r_regionkey * 1e-2 as decimal(18,8)) as scale_value,
          date '1995-01-01' as valid_from, date '1998-12-31' as valid_to from region
        union all
        select r_name, 'season', cast(1.2e0 as decimal(18,8)), date '1999-01-01', date '2000-06-15'
        from region""",
    "balance_parameters": """
        select business_unit, product, make_date(y.y, m.m, 1) as period_date,
          cast(1 + m.m * 1e-2 as decimal(18,8)) as balance_scaler,
          concat('Q', cast((m.m + 2) // 3 as varchar)) as seasonality_flag
        from unit_products, (select unnest(generate_series(1996, 1999)) as y) y,
          (select unnest(generate_series(1, 12)) as m) m""",
    "relationships": """
        select concat(business_unit, '|', product) as source_segment,
          concat(x.unit, '|', product) as proxy_segment, x.w as proxy_weight
        from unit_products, (values ('ASIA', 0.6), ('AMERICA', 0.4)) x(unit, w)""",
    "dated_relationships": """
        select source_segment, proxy_segment, proxy_weight, date '1995-01-01' as effective_date from relationships
        union all
        select concat(business_unit, '|', product), concat('EUROPE|', product), 0.5, date '1999-01-01'
        from unit_products""",
    "edges_2001": """
        select node, case when node = 'ASIA' then 'WEST' else up end as up from unit_edges""",
    "product_groups": f"""
        select product, case product when 'Loan' then 'Assets' when 'Deposit' then 'Liabilities'
          else 'Other' end as product_group
        from {PRODUCTS} p(product) where product <> 'MEDIUM'""",
    "curve_points": """
        select concat('A', cast(n_nationkey as varchar)) as assumption_id, 'OIS' as curve_type, t.tenor,
          case when n_nationkey % 2 = 0 then 'USD' else 'EUR' end as currency,
          cast(n_nationkey * 1e-3 + i * 7e-4 as decimal(18,8)) as value,
          make_date(1995 + cast(floor(n_nationkey / 4e0) as int), 1 + n_nationkey % 12, 1) as effective_date
        from nation, (values (0, '1M'), (1, '3M'), (2, '6M'), (3, '1Y'), (4, '2Y'), (5, '5Y'), (6, 'spot')) t(i, tenor)
        where (n_nationkey + i) % 3 <> 0""",
    "tenor_length": """
        select * from (values ('1M', 1 / 12e0), ('3M', 3 / 12e0), ('6M', 6 / 12e0), ('1Y', 1e0), ('2Y', 2e0),
          ('5Y', 5e0)) l(tenor, years)""",
    "curve_grid": """
        select c.currency, c.day as effective_date, l.years, arg_max(cast(m.value as double), m.effective_date) as rate
        from (select distinct currency, effective_date as day from curve_points where tenor <> 'spot') c
          join curve_points m on m.currency = c.currency and m.effective_date <= c.day
          join tenor_length l on m.tenor = l.tenor
        group by 1, 2, 3""",
    "forwards": """
        select * from (values ('Loan', 6 / 12e0, 18 / 12e0), ('Deposit', 1 / 12e0, 3 / 12e0), ('LARGE', 2e0, 10e0),
          ('MEDIUM', 7 / 365e0, 1.5e0), ('SMALL', 1e0, 6 / 12e0), ('STANDARD', 1 / 365e0, 1e0)) f(product, t1, t2)""",
    "moving_edges": """
        select node, up, date '1990-01-01' as since from unit_edges
        union all
        select * from (values ('ASIA', 'WEST', date '2000-07-01'), ('CHINA', 'EUROPE', date '1997-03-15'),
          ('CHINA', 'ASIA', date '1999-03-15'), ('EAST', 'WEST', date '1998-01-01'),
          ('AFRICA', null, date '2001-05-05')) m(node, up, since)""",
    "supplier_history": """
        select concat('CFG', cast(s_suppkey as varchar)) as config_key, e.version, e.flag, e.moment
        from supplier, lateral (values ('v1', true, date '1995-06-01', true),
          ('v2', true, make_date(1998 + s_suppkey % 3, 3, 1), true), ('v2', false, date '2001-02-01', s_suppkey % 5 = 0),
          ('v1', true, date '2001-06-15', s_suppkey % 7 = 0), ('v1', false, date '1997-01-01', s_suppkey % 11 = 0),
          ('v1', true, date '1998-01-01', s_suppkey % 11 = 0)) e(version, flag, moment, told)
        where e.told""",
    "proxy_chains": f"""
        select concat(x.unit, '|', product) as source_segment, concat(x.proxy, '|', product) as proxy_segment, x.w
        from {PRODUCTS} p(product), (values ('AFRICA', 'AMERICA', 0.7), ('AFRICA', 'ASIA', 0.3), ('AMERICA', 'ASIA', 0.6),
          ('AMERICA', 'EUROPE', 0.3), ('ASIA', 'EUROPE', 0.8), ('ASIA', 'MIDDLE EAST', 0.2),
          ('EUROPE', 'MIDDLE EAST', 0.9), ('EUROPE', 'ATLANTIS', 0.1)) x(unit, proxy, w)""",
    "nation_codes": """
        select n_nationkey as k, n_name, case n_name when 'UNITED STATES' then 'USD' when 'UNITED KINGDOM' then 'GBP'
          else left(n_name, 3) end as code from nation""",
    "nation_positions": """
        select code as currency, cast(date_trunc('month', period_date) as date) as period_date, business_unit,
          sum(amount) as balance
        from lines join nation_codes on nation = n_name group by 1, 2, 3""",
    "nation_quotes": """
        select q.currency, q.quote_currency, make_date(1994 + a.k % 4 + step * 3, a.k % 12 + 1, 10) as effective_date,
          0.5e0 + a.k * 0.125e0 + step * 0.0625e0 as fx_rate
        from nation_codes a left join nation_codes b on b.k = a.k - 1, (values (0), (1)) s(step),
          lateral (values (a.code, 'USD', a.k % 5 = 0), ('USD', a.code, a.k % 5 = 1),
            (a.code, b.code, a.k % 5 in (2, 3)), (b.code, a.code, a.k % 10 = 3)) q(currency, quote_currency, told)
        where q.told and q.currency <> q.quote_currency""",
}

POSITION = "run_id, business_unit, business_segment_group, cost_centre, product, currency"

STATEMENTS = {
    # ---- metrics ----
    "weighted_metric": """
        select l_returnflag as key,
          round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 6) as complex_metric
        from lineitem where l_quantity >= 5 group by l_returnflag""",
    "metric_summary": """
        with m as (
          select cast(l_suppkey as varchar) as key,
            sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0) as metric
          from lineitem where l_quantity >= 5 group by 1)
        select key, round(metric, 6) as avg_metric,
          round((select avg(metric) from m), 6) as global_avg from m""",
    # ---- the ten stages ----
    "config_snapshot": """
        select distinct 'R1' as run_id, r_name as business_unit, c_mktsegment as business_segment_group,
          concat('CC', cast(c_nationkey as varchar)) as cost_centre,
          case when r_name in ('AMERICA', 'ASIA') then 'USD' else 'EUR' end as currency
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "actuals_enriched": f"""
        select {POSITION}, period_year, cast(actual_balance as double) as actual_balance,
          cast(actual_income as double) as actual_income, 0.5e0 as preallocation_factor,
          cast(actual_balance * 0.5 as double) as actual_balance_adjusted
        from actuals""",
    "calendar_months": """
        select run_id, business_unit, business_segment_group, product, currency, forecast_month,
          strftime(forecast_month, '%Y-%m-%d') as month_text
        from forecast""",
    "forecast_monthly": """
        select run_id, substitution_code, business_unit, business_segment_group, product, currency,
          round(annual_forecast_amount, 6) as annual_forecast_amount, substitution_type,
          round(monthly_forecast_balance, 6) as monthly_forecast_balance, forecast_month,
          round(forecast_balance, 6) as forecast_balance
        from forecast""",
    "launchpoint": f"""
        select {POSITION}, round(launchpoint_balance, 6) as launchpoint_balance,
          round(launchpoint_income, 6) as launchpoint_income, window_days,
          round(launchpoint_day_count, 6) as launchpoint_day_count, forecast_month,
          round(forecast_balance, 6) as forecast_balance
        from launch""",
    "driver_layer": f"""
        select {POSITION}, forecast_month, currency_mix, net_exposure_factor, net_rate_factor, base_yield
        from driven""",
    "proxy_literal": f"""
        select {POSITION}, forecast_month, proxy_business_unit, proxy_product, scale_ratio,
          fixed_adjustment, round(proxy_adjusted_balance, 6) as proxy_adjusted_balance,
          round(coalesce(proxy_adjusted_balance, launchpoint_balance), 6) as proxy_balance
        from proxied""",
    "inflation_factor": f"""
        select {POSITION}, forecast_month, lag_0, lag_1, lag_2, round(lag_3, 6) as lag_3,
          round(inflation_adjustment_factor, 6) as inflation_adjustment_factor
        from inflated""",
    "yield_delta": f"""
        select {POSITION}, forecast_month, yield_index, override_factor,
          round(yield_delta, 6) as yield_delta
        from yields""",
    "nii_business_unit": f"""
        select {POSITION}, forecast_month, round(delta_balance, 6) as delta_balance,
          day_count_fraction, round(nii_business_unit, 6) as nii_business_unit
        from income""",
    "nii_cost_centre_distinct": """
        select run_id, business_unit, nii_business_unit, cost_centre, round(cc_ratio, 6) as cc_ratio, fe_weight,
          round(denominator, 6) as allocation_denominator,
          round(nii_business_unit * cc_ratio * fe_weight / nullif(denominator, 0), 9) as nii_cost_centre
        from (
          select d.*, cost_centre, cc_ratio, fe_weight,
            cast(sum(cast(cc_ratio * fe_weight as decimal(38,18)))
              over (partition by d.run_id, d.business_unit) as double) as denominator
          from (select distinct run_id, business_unit,
                  round(nii_business_unit, 4) as nii_business_unit from income) d
            join ratios r on d.run_id = r.run_id and d.business_unit = r.business_unit)""",
    "nii_cost_centre_conserving": """
        select run_id, business_unit, round(nii_business_unit, 6) as nii_business_unit, cost_centre,
          round(cc_ratio, 6) as cc_ratio, fe_weight,
          round(allocation_denominator, 6) as allocation_denominator,
          round(nii_cost_centre, 6) as nii_cost_centre
        from allocated""",
    "nii_cost_centre_monthly": """
        select t.run_id, t.business_unit, forecast_month, round(nii, 6) as nii_business_unit, cost_centre,
          round(cc_ratio, 6) as cc_ratio, fe_weight,
          round(allocation_denominator, 6) as allocation_denominator,
          round(nii * cc_ratio * fe_weight / nullif(allocation_denominator, 0), 6) as nii_cost_centre
        from (select run_id, business_unit, forecast_month,
                cast(sum(cast(nii_business_unit as decimal(38,10))) as double) as nii
              from income group by run_id, business_unit, forecast_month) t
          join ratios r on t.run_id = r.run_id and t.business_unit = r.business_unit
          join unit_weights w on t.run_id = w.run_id and t.business_unit = w.business_unit""",
    # ---- configuration ----
    "config_row": """
        select config_key, config_version, round(configdouble1, 6) as configdouble1, effective_date, expiry_date
        from parameter_store where config_key = 'CFG7' and config_version = 'v2'""",
    "config_resolve": """
        select s.config_key, s.config_version, round(configdouble1, 6) as configdouble1,
          effective_date, expiry_date
        from parameter_store s
          left join requested_versions q on s.config_key = q.config_key
          left join (select config_key, arg_max(config_version, activated_at) as config_version
                     from active_versions where active_flag group by config_key) a
            on s.config_key = a.config_key
        where s.config_version = coalesce(q.config_version, a.config_version)""",
    "config_effective": """
        select l.config_key, config_version, count(*) as lines,
          cast(sum(amount * configint1) as double) as scaled
        from (select concat('CFG', cast(supplier as varchar)) as config_key, period_date, amount from lines) l
          left join supplier_store s on l.config_key = s.config_key and effective_date <= period_date
            and (expiry_date is null or period_date < expiry_date)
        group by l.config_key, config_version""",
    "config_on_day": """
        select config_key, config_version, configint1, effective_date, expiry_date from supplier_store
        where effective_date <= date '1999-01-01'
          and (expiry_date is null or expiry_date > date '1999-01-01')""",
    "config_catalog": """
        select s.config_key, config_version, round(configdouble1, 6) as configdouble1, effective_date,
          expiry_date, config_category, description as config_description, example_usage
        from parameter_store s left join catalog c on s.config_key = c.config_key""",
    "run_scope_filter": """
        select business_unit, product, currency, count(*) as lines, cast(sum(amount) as double) as amount
        from lines l
        where exists (select 1 from scope s
          where (s.business_unit is null or s.business_unit = l.business_unit)
            and (s.product is null or s.product = l.product)
            and (s.currency is null or s.currency = l.currency))
        group by business_unit, product, currency""",
    "launchpoint_day_weighted": """
        with daily as (
          select run_id, business_unit, business_segment_group, cost_centre, product, currency, period_date,
            sum(amount) as balance
          from lines where period_date <= date '2000-03-31' group by all),
        days as (
          select distinct business_unit, cast(d as date) as day
          from (select business_unit, unnest(generate_series(window_start, window_end, interval 1 day)) as d
                from overlapping_windows) where d <= date '2000-03-31'),
        segments as (
          select distinct run_id, business_unit, business_segment_group, cost_centre, product, currency from daily),
        wanted as (select * from segments join days using (business_unit))
        select w.run_id, w.business_unit, w.business_segment_group, w.cost_centre, w.product, w.currency,
          round(cast(sum(balance) as double) / count(*), 6) as launchpoint_balance, count(*) as days,
          count(distinct period_date) as positions
        from wanted w asof join daily p on w.run_id = p.run_id and w.business_unit = p.business_unit
          and w.business_segment_group = p.business_segment_group and w.cost_centre = p.cost_centre
          and w.product = p.product and w.currency = p.currency and w.day >= p.period_date
        group by 1, 2, 3, 4, 5, 6""",
    "quality_report": """
        with a as (
          select business_unit, product, cast(year(period_date) as int) as period_year,
            cast(sum(income) as double) as income, cast(sum(fee) as double) as fee
          from lines group by 1, 2, 3),
        b as (
          select business_unit, product,
            cast(case year(period_date) when 1997 then 2097 else year(period_date) end as int) as period_year,
            cast(sum(amount + case when product = 'Deposit' then 0.5 else 0 end)
              filter (posting_category = 'interest') as double) as income,
            cast(sum(amount) filter (posting_category = 'fee') as double) as fee
          from postings group by 1, 2, 3),
        totals as (
          select business_unit, product, period_year, 'income' as measure, a.income as l, b.income as r
          from a full join b using (business_unit, product, period_year)
          union all
          select business_unit, product, period_year, 'fee', a.fee, b.fee
          from a full join b using (business_unit, product, period_year)),
        judged as (
          select business_unit, product, period_year, rule, measure, severity, l, r,
            case when is_relative then tolerance * abs(r) else tolerance end as allowed,
            coalesce(abs(l - r) <= case when is_relative then tolerance * abs(r) else tolerance end, false) as passed
          from totals join quality_rules using (measure))
        select business_unit, product, period_year, rule, measure, severity, round(l, 6) as left_total,
          round(r, 6) as right_total, round(abs(l - r), 6) as gap, round(allowed, 6) as allowed, passed,
          count(*) over () as all_rows, count(*) filter (not passed and severity = 'error') over () as all_error,
          count(*) filter (not passed and severity = 'warning') over () as all_warning,
          count(*) filter (not passed and severity = 'info') over () as all_info
        from judged""",
    "nii_rollup_distinct": """
        select business_unit, product, currency,
          cast(grouping(business_unit, product, currency) as int) as grouping_id,
          cast(sum(income) as double) as income, cast(sum(amount) as double) as amount,
          round(cast(sum(income) as double) / nullif(cast(sum(amount) as double), 0), 6) as observed_rate,
          count(distinct supplier) as distinct_exact, true as estimate_holds
        from lines group by rollup (business_unit, product, currency)""",
    "run_metadata": """
        select run_id, business_unit, round(nii_business_unit, 6) as nii_business_unit, cost_centre,
          round(cc_ratio, 6) as cc_ratio, fe_weight,
          round(allocation_denominator, 6) as allocation_denominator,
          round(nii_cost_centre, 6) as nii_cost_centre,
          'exec-1' as execution_id, cast(978404645 as bigint) as run_timestamp
        from allocated""",
    # ---- hierarchies ----
    "hierarchy_rollup": """
        with recursive path(node, ancestor) as (
          select node, node from (select node from unit_edges union select up from unit_edges)
          union all
          select p.node, e.up from path p join unit_edges e on p.ancestor = e.node)
        select ancestor, cast(year(period_date) as int) as period_year, cast(sum(amount) as double) as amount
        from lines join path on nation = node group by 1, 2""",
    "product_rollup": """
        with recursive path(node, ancestor) as (
          select node, node from (select node from product_edges union select up from product_edges)
          union all
          select p.node, e.up from path p join product_edges e on p.ancestor = e.node)
        select ancestor, cast(sum(amount) as double) as amount, cast(sum(income) as double) as income
        from lines join path on brand = node group by ancestor""",
    "element_rollup": """
        with recursive path(node, ancestor) as (
          select node, node from (select node from element_edges union select up from element_edges)
          union all
          select p.node, e.up from path p join element_edges e on p.ancestor = e.node)
        select ancestor, business_unit, cast(sum(amount) as double) as amount
        from postings join path on accounting_element = node group by 1, 2""",
    "hierarchy_closure": """
        with recursive path(node, ancestor, depth) as (
          select node, node, 0 from (select node from product_edges union select up from product_edges)
          union all
          select p.node, e.up, p.depth + 1 from path p join product_edges e on p.ancestor = e.node)
        select node, ancestor, min(depth) as depth from path group by node, ancestor""",
    "hierarchy_asof": """
        with recursive path(node, ancestor) as (
          select node, node from (select node from edges_2001 union select up from edges_2001)
          union all
          select p.node, e.up from path p join edges_2001 e on p.ancestor = e.node)
        select ancestor, cast(sum(amount) as double) as amount
        from lines join path on nation = node group by ancestor""",
    "cost_centre_bridge": """
        select l.business_unit, l.product, period_year, amount, cost_centre
        from (select business_unit, product, cast(year(period_date) as int) as period_year,
                cast(sum(amount) as double) as amount from lines group by 1, 2, 3) l
          join bridge b on l.business_unit = b.business_unit and l.product = b.product and is_leaf""",
    "product_segments": """
        select business_unit, product_group, count(*) as lines, cast(sum(amount) as double) as amount
        from lines l left join product_groups g on l.product = g.product
        group by business_unit, product_group""",
    "nii_rollup": """
        select business_unit, product, forecast_month,
          cast(grouping(business_unit, product, forecast_month) as int) as grouping_id,
          cast(sum(cast(round(nii_business_unit, 4) as decimal(28,4))) as double) as nii_business_unit
        from income group by rollup (business_unit, product, forecast_month)""",
    # ---- dated lookups ----
    "curve_asof": """
        with spans as (
          select currency, value, effective_date,
            lead(effective_date) over (partition by currency order by effective_date) as until
          from (select currency, effective_date, arg_max(value, assumption_id) as value
                from market group by currency, effective_date))
        select business_unit, l.currency, cast(date_trunc('month', period_date) as date) as month,
          count(*) as lines, count(value) as priced, cast(sum(amount * value) as double) as weighted
        from lines l left join spans s on l.currency = s.currency and effective_date <= period_date
          and (until is null or period_date < until)
        group by 1, 2, 3""",
    "yield_parameters": """
        select q.business_unit, q.product, q.currency, reference_date, c.curve_type as yield_curve,
          cast((select arg_max(value, effective_date) from market m
                where m.curve_type = c.curve_type and m.tenor = c.tenor and m.currency = q.currency
                  and m.effective_date <= reference_date) as double) as forward_rate
        from (select distinct business_unit, product, currency,
                cast(date_trunc('month', period_date) as date) as reference_date from lines) q
          left join curve_map c on q.business_unit = c.business_unit and q.product = c.product
            and q.currency = c.currency""",
    "currency_conversion": """
        select business_unit, business_segment_group, cost_centre, product, p.currency, period_date,
          cast(balance as double) as balance,
          round(case when p.currency = 'USD' then 1e0 else fx_rate end, 6) as fx_rate,
          round(cast(balance as double) * case when p.currency = 'USD' then 1e0 else fx_rate end, 6)
            as converted_amount
        from monthly_positions p left join (
          select *, lead(effective_date) over (order by effective_date) as until from fx_rates) f
          on p.currency = f.currency and effective_date <= period_date
          and (until is null or period_date < until)""",
    "inflation_asof": """
        with spans as (
          select *, lead(as_of_date) over (partition by country order by as_of_date) as until
          from inflation_curves)
        select nation as country, cast(year(period_date) as int) as period_year, count(*) as lines,
          count(adjustment_factor) as adjusted,
          cast(sum(amount * adjustment_factor) as double) as adjusted_amount
        from lines left join spans on nation = country and as_of_date <= period_date
          and (until is null or period_date < until)
        group by 1, 2""",
    "scaling_range": """
        select l.business_unit, cast(year(period_date) as int) as period_year, count(*) as lines,
          count(scale_value) as scaled_lines, cast(sum(amount * scale_value) as double) as scaled_amount
        from lines l left join scaling s on l.business_unit = s.business_unit
          and period_date between valid_from and valid_to
        group by 1, 2""",
    "balance_scaling": """
        select l.business_unit, l.product, l.period_date, round(balance, 6) as balance,
          cast(balance_scaler as double) as balance_scaler, seasonality_flag,
          round(balance * coalesce(cast(balance_scaler as double), 1e0), 6) as scaled_balance
        from (select business_unit, product, cast(date_trunc('month', period_date) as date) as period_date,
                cast(sum(amount) as double) as balance from lines group by 1, 2, 3) l
          left join balance_parameters b on l.business_unit = b.business_unit
            and l.product = b.product and l.period_date = b.period_date""",
    "launchpoint_window_avg": """
        select p.run_id, p.business_unit, business_segment_group, cost_centre, product, currency,
          round(cast(sum(balance) as double) / count(balance), 6) as launchpoint_balance,
          count(*) as positions
        from monthly_positions p where exists (select 1 from overlapping_windows w where p.run_id = w.run_id
          and p.business_unit = w.business_unit and period_date between window_start and window_end)
        group by all""",
    # ---- proxies, substitution, rates ----
    "proxy_fill": """
        with fills as (
          select s.segment, s.period_date, sum(proxy_weight * k.balance) as fill, sum(proxy_weight) as weight
          from segment_months s join relationships r on s.segment = r.source_segment
            join segment_months k on k.segment = r.proxy_segment and k.period_date = s.period_date
          where s.balance is null and k.balance is not null
          group by s.segment, s.period_date)
        select s.segment, s.period_date, cast(balance as double) as balance,
          round(cast(coalesce(balance, fill) as double), 6) as filled_value,
          case when balance is null then round(cast(coalesce(weight, 0) as double), 6) end as proxy_weight_found
        from segment_months s left join fills f
          on s.segment = f.segment and s.period_date = f.period_date""",
    "proxy_fill_dated": """
        with fills as (
          select s.segment, s.period_date, sum(proxy_weight * k.balance) as fill, sum(proxy_weight) as weight
          from segment_months s join dated_relationships r on s.segment = r.source_segment
            and r.effective_date = (select max(d.effective_date) from dated_relationships d
              where d.source_segment = s.segment and d.effective_date <= s.period_date)
            join segment_months k on k.segment = r.proxy_segment and k.period_date = s.period_date
          where s.balance is null and k.balance is not null
          group by s.segment, s.period_date)
        select s.segment, s.period_date, cast(balance as double) as balance,
          round(cast(coalesce(balance, fill) as double), 6) as filled_value,
          case when balance is null then round(cast(coalesce(weight, 0) as double), 6) end as proxy_weight_found
        from segment_months s left join fills f
          on s.segment = f.segment and s.period_date = f.period_date""",
    "launchpoint_positions": """
        with rates as (
          select business_unit, product, cast(sum(income) as double) / nullif(cast(sum(amount) as double), 0) as rate
          from lines group by 1, 2)
        select p.business_unit, p.product,
          cast(cast(sum(cast(launchpoint_balance as decimal(38,10))) as decimal(18,4)) as double) as launchpoint_balance,
          cast(cast(any_value(rate) as decimal(9,6)) as double) as launchpoint_yield, date '2000-12-31' as launch_date
        from positions p left join rates r on p.business_unit = r.business_unit and p.product = r.product
        group by 1, 2""",
    "nii_drivers": """
        with d as (
          select business_unit, product, currency, max(period_date) as effective_date,
            case when currency = 'USD' then 1e0 else 0.95e0 end as currency_mix,
            case when product = 'Loan' then 0.055e0 else 0.015e0 end as base_yield
          from lines group by 1, 2, 3)
        select business_unit, product, 'currency_mix' as driver_type, currency_mix as driver_value, effective_date from d
        union all select business_unit, product, 'net_exposure_factor', 0.98e0, effective_date from d
        union all select business_unit, product, 'net_rate_factor', 1.02e0, effective_date from d
        union all select business_unit, product, 'base_yield', base_yield, effective_date from d""",
    "prior_actual_substitution": """
        with totals as (
          select run_id, business_unit, business_segment_group, product, currency, period_year,
            cast(sum(actual_balance) as double) as balance
          from actuals group by all),
        prior as (
          select run_id, business_unit, business_segment_group, product, currency,
            arg_max(balance, period_year) as balance
          from totals group by all)
        select f.business_unit, f.business_segment_group, f.product, f.currency, substitution_code,
          substitution_type, round(monthly_forecast_balance, 6) as monthly_forecast_balance,
          forecast_month, balance as prior_actual_balance,
          round(case when substitution_type = 'prior_actual'
                     then coalesce(balance, monthly_forecast_balance)
                     else monthly_forecast_balance end, 6) as forecast_balance
        from forecast f left join prior p on f.run_id = p.run_id and f.business_unit = p.business_unit
          and f.business_segment_group = p.business_segment_group
          and f.product = p.product and f.currency = p.currency""",
    "period_override": """
        select y.run_id, y.business_unit, y.business_segment_group, y.cost_centre, y.product, y.currency,
          forecast_month, round(yield_delta, 6) as yield_delta, period_override,
          round(yield_delta * coalesce(period_override, 1e0), 6) as period_yield_delta
        from yields y left join period_overrides o on y.run_id = o.run_id
          and y.business_unit = o.business_unit and y.product = o.product and y.currency = o.currency""",
    "drivers_long": f"""
        with d as (
          select *, case when currency = 'USD' then 1e0 else 0.95e0 end as currency_mix,
            case when product = 'Loan' then 0.055e0 else 0.015e0 end as base_yield
          from positions)
        select {POSITION}, 'currency_mix' as driver_type, currency_mix as driver_value from d
        union all select {POSITION}, 'net_exposure_factor', 0.98e0 from d
        union all select {POSITION}, 'net_rate_factor', 1.02e0 from d
        union all select {POSITION}, 'base_yield', base_yield from d""",
    "observed_rate": """
        select business_unit, product, currency, cast(date_trunc('month', period_date) as date) as period_date,
          cast(sum(amount) as double) as balance_amount, cast(sum(income) as double) as interest_income,
          round(cast(sum(income) as double) / nullif(cast(sum(amount) as double), 0), 6) as avg_rate
        from lines group by 1, 2, 3, 4""",
    "income_by_element": """
        select business_unit, product, cast(year(period_date) as int) as period_year, accounting_element,
          cast(sum(amount) as double) as amount
        from postings where posting_category = 'interest' group by 1, 2, 3, 4""",
    "day_count": f"""
        select {POSITION}, forecast_month,
          round(day(last_day(forecast_month)) / 360e0, 6) as day_count_fraction,
          round(delta_balance * currency_mix * net_exposure_factor * yield_delta
            * (day(last_day(forecast_month)) / 360e0), 6) as nii_business_unit
        from income""",
    # ---- scenarios, quality ----
    "scenario_compare": """
        with t as (
          select business_unit, product, currency, target_date,
            sum(case when scenario = 'baseline' then forecast_balance end) as baseline,
            sum(case when scenario = 'adverse' then forecast_balance end) as adverse,
            sum(case when scenario = 'upside' then forecast_balance end) as upside
          from scenario_forecast group by 1, 2, 3, 4)
        select business_unit, product, currency, target_date, cast(baseline as double) as baseline,
          cast(adverse as double) as adverse, cast(upside as double) as upside,
          cast(adverse - baseline as double) as adverse_delta,
          cast(upside - baseline as double) as upside_delta
        from t""",
    "scenario_rows": """
        select business_unit, scenario, count(*) as rows,
          cast(sum(forecast_balance) as double) as forecast_balance
        from scenario_forecast where scenario = 'adverse' group by 1, 2""",
    "reconcile": """
        with a as (
          select business_unit, nullif(product, 'STANDARD') as product,
            cast(year(period_date) as int) as period_year, cast(sum(income) as double) as left_total
          from lines group by 1, 2, 3),
        b as (
          select business_unit, nullif(product, 'STANDARD') as product,
            cast(case year(period_date) when 1997 then 2097 else year(period_date) end as int) as period_year,
            cast(sum(amount + case when product = 'Deposit' then 0.5 else 0 end) as double) as right_total
          from postings where posting_category = 'interest' group by 1, 2, 3)
        select coalesce(a.business_unit, b.business_unit) as business_unit,
          coalesce(a.product, b.product) as product, coalesce(a.period_year, b.period_year) as period_year,
          round(left_total, 6) as left_total, round(right_total, 6) as right_total,
          coalesce(abs(left_total - right_total) <= 0.01e0, false) as agrees
        from a full join b on a.business_unit = b.business_unit and a.product is not distinct from b.product
          and a.period_year = b.period_year""",
    "duplicate_keys": """
        select o_custkey, o_orderpriority, count(*) as rows from orders
        group by o_custkey, o_orderpriority having count(*) > 1""",
    "orphan_keys": """
        select l.run_id, l.business_unit, l.cost_centre, count(*) as rows
        from lines l where not exists (select 1 from ratios r where r.run_id = l.run_id
          and r.business_unit = l.business_unit and r.cost_centre = l.cost_centre)
        group by l.run_id, l.business_unit, l.cost_centre""",
    # ---- readers and writers ----
    "csv_roundtrip": """
        select business_unit, product, accounting_element, count(*) as rows,
          max(period_date) as last_date, cast(sum(amount) as double) as amount
        from postings group by business_unit, product, accounting_element""",
    "typed_extract": """
        select o_orderpriority as key, count(*) as rows,
          count(case when o_orderstatus <> 'F' then 1 end) as weights,
          cast(sum(cast(o_totalprice as decimal(18,4))) as double) as value,
          cast(sum(case when o_orderstatus <> 'F' then cast(o_custkey as decimal(18,4)) end) as double) as weight
        from orders group by o_orderpriority""",
    "catalog_roundtrip": f"""
        select {POSITION}, period_year, cast(actual_balance as double) as actual_balance from actuals""",
    "parquet_partition_overwrite": f"""
        select {POSITION}, period_year, cast(actual_balance as double) as actual_balance from actuals
        union all
        select 'R2', business_unit, business_segment_group, cost_centre, product, currency, period_year,
          cast(actual_balance * 0.5 as double) from actuals""",
    "curve_forward": """
        with asked as (
          select distinct l.product, l.currency, period_date, t1, t2,
            (select max(effective_date) from curve_grid g where g.currency = l.currency and g.effective_date <= period_date) as day
          from lines l join forwards f on l.product = f.product),
        ends as (
          select product, currency, period_date, day, t1 as t from asked
          union select product, currency, period_date, day, t2 from asked),
        around as (
          select e.product, e.currency, e.period_date, e.t,
            max(years) filter (where years <= t) as lt, arg_max(rate, years) filter (where years <= t) as lr,
            min(years) filter (where years >= t) as ht, arg_min(rate, years) filter (where years >= t) as hr
          from ends e join curve_grid g on g.currency = e.currency and g.effective_date = e.day group by 1, 2, 3, 4),
        z as (
          select *, case when lt is null then hr when ht is null then lr when lt = ht then lr
            else lr + (hr - lr) * ((t - lt) / (ht - lt)) end as rate from around),
        f as (
          select a.product, a.currency, a.period_date,
            case when t2 > t1 then cast((y.rate * t2 - x.rate * t1) / (t2 - t1) as decimal(18,8)) end as forward_rate
          from asked a join z x on x.product = a.product and x.currency = a.currency and x.period_date = a.period_date and x.t = t1
            join z y on y.product = a.product and y.currency = a.currency and y.period_date = a.period_date and y.t = t2)
        select business_unit, l.product, l.currency, cast(date_trunc('month', l.period_date) as date) as month,
          count(*) as lines, count(forward_rate) as priced, cast(sum(amount * forward_rate) as double) as weighted
        from lines l left join f on l.product = f.product and l.currency = f.currency and l.period_date = f.period_date
        group by 1, 2, 3, 4""",
    "curve_days": """
        select 'OIS' as curve_type, currency, effective_date, round(years, 6) as years, round(rate, 6) as rate
        from curve_grid""",
    "forward_yield_parameters": """
        with asked as (
          select distinct business_unit, l.product, l.currency, cast(date_trunc('month', period_date) as date) as reference_date,
            t1, t2 from lines l join forwards f on l.product = f.product),
        dated as (
          select *, (select max(effective_date) from curve_grid g
            where g.currency = a.currency and g.effective_date <= reference_date) as day from asked a),
        ends as (select currency, day, t1 as t from dated union select currency, day, t2 from dated),
        around as (
          select e.currency, e.day, e.t,
            max(years) filter (where years <= t) as lt, arg_max(rate, years) filter (where years <= t) as lr,
            min(years) filter (where years >= t) as ht, arg_min(rate, years) filter (where years >= t) as hr
          from ends e join curve_grid g on g.currency = e.currency and g.effective_date = e.day group by 1, 2, 3),
        z as (
          select *, t * ln(1 + case when lt is null then hr when ht is null then lr when lt = ht then lr
            else lr + (hr - lr) * ((t - lt) / (ht - lt)) end) as growth from around)
        select business_unit, product, a.currency, reference_date, 'OIS' as yield_curve,
          cast(case when t2 > t1 then cast(exp((y.growth - x.growth) / (t2 - t1)) - 1 as decimal(18,8)) end as double) as forward_rate
        from dated a left join z x on x.currency = a.currency and x.day = a.day and x.t = t1
          left join z y on y.currency = a.currency and y.day = a.day and y.t = t2""",
    "hierarchy_rollup_dated": """
        with recursive days as (select distinct period_date as day from lines),
        edges_on as (
          select day, node, up from days join moving_edges on since <= day
          qualify row_number() over (partition by day, node order by since desc) = 1),
        path(day, node, ancestor) as (
          select day, n_name, n_name from days, nation
          union all
          select p.day, p.node, e.up from path p join edges_on e on p.ancestor = e.node and p.day = e.day where e.up is not null)
        select ancestor, cast(year(period_date) as int) as period_year, cast(sum(amount) as double) as amount
        from lines join path on nation = node and period_date = day group by 1, 2""",
    "hierarchy_closure_dated": """
        with recursive cuts as (
          select d, row_number() over (order by d) as place, lead(d) over (order by d) as next
          from (select since as d from moving_edges union select date '0001-01-01')),
        edges_on as (
          select place, node, up from cuts join moving_edges on since <= d
          qualify row_number() over (partition by place, node order by since desc) = 1),
        path(place, node, ancestor) as (
          select place, node, node from cuts, (select node from moving_edges union select up from moving_edges where up is not null)
          union all
          select p.place, p.node, e.up from path p join edges_on e on p.ancestor = e.node and p.place = e.place
          where e.up is not null),
        runs as (
          select *, place - row_number() over (partition by node, ancestor order by place) as run from path)
        select node, ancestor, nullif(min(d), date '0001-01-01') as valid_from, arg_max_null(next, place) as valid_until
        from runs join cuts using (place) group by node, ancestor, run""",
    "config_as_known": """
        with l as (
          select concat('CFG', cast(supplier as varchar)) as config_key, period_date,
            period_date + cast(14 + supplier % 13 * 31 as int) as known_date, amount from lines),
        q as (select distinct config_key, known_date from l),
        told as (
          select q.config_key, known_date, version, arg_max(flag, moment) as flag, max(moment) as moment
          from q join supplier_history h on q.config_key = h.config_key and moment <= known_date group by 1, 2, 3),
        active as (
          select * from told where flag
          qualify row_number() over (partition by config_key, known_date order by moment desc, version desc) = 1)
        select l.config_key, s.config_version, count(*) as lines, cast(sum(amount * configint1) as double) as scaled
        from l left join active a on l.config_key = a.config_key and l.known_date = a.known_date
          left join supplier_store s on s.config_key = a.config_key and s.config_version = a.version
            and effective_date <= period_date and (expiry_date is null or period_date < expiry_date)
        group by 1, 2""",
    "known_versions": """
        with q as (select distinct config_key, moment as known_from from supplier_history),
        told as (
          select q.config_key, known_from, version, arg_max(flag, moment) as flag, max(moment) as moment
          from q join supplier_history h on q.config_key = h.config_key and moment <= known_from group by 1, 2, 3),
        active as (
          select * from told where flag
          qualify row_number() over (partition by config_key, known_from order by moment desc, version desc) = 1)
        select q.config_key, q.known_from, a.version as config_version
        from q left join active a on q.config_key = a.config_key and q.known_from = a.known_from""",
    "proxy_fill_chained": """
        with recursive walk(source, period_date, segment, weight, depth) as (
          select segment, period_date, segment, 1e0, 0 from segment_months where balance is null
          union all
          select w.source, w.period_date, r.proxy_segment, w.weight * cast(r.w as double), w.depth + 1
          from walk w join segment_months m on m.segment = w.segment and m.period_date = w.period_date and m.balance is null
            join proxy_chains r on r.source_segment = w.segment),
        fills as (
          select source, w.period_date, sum(weight * cast(balance as double)) as fill,
            sum(weight) filter (where balance is not null) as weight, max(depth) as depth
          from walk w left join segment_months k on k.segment = w.segment and k.period_date = w.period_date
          group by 1, 2)
        select s.segment, s.period_date, cast(balance as double) as balance,
          round(coalesce(cast(balance as double), fill), 6) as filled_value,
          case when balance is null then round(coalesce(weight, 0), 6) end as proxy_weight_found,
          depth as proxy_depth
        from segment_months s left join fills f on f.source = s.segment and f.period_date = s.period_date""",
    "currency_cross": """
        with recursive days as (select distinct period_date as day from nation_positions),
        held as (
          select day, currency as one, quote_currency as other, arg_max(fx_rate, {'d': effective_date, 'r': fx_rate}) as rate
          from days join nation_quotes on effective_date <= day group by 1, 2, 3),
        ways as (
          select day, one, other, rate, 0 as inverse from held
          union all select day, other, one, 1e0 / rate, 1 from held),
        best as (select * from ways qualify row_number() over (partition by day, one, other order by inverse) = 1),
        routes(day, currency, rate, route, hops, inverses) as (
          select day, 'USD', 1e0, 'USD', 0, 0 from days
          union all
          select b.day, b.one, b.rate * r.rate, concat(b.one, '>', r.route), r.hops + 1, r.inverses + b.inverse
          from routes r join best b on b.day = r.day and b.other = r.currency
          where r.hops < 3 and not contains(r.route, b.one)),
        shortest as (
          select * from routes qualify row_number() over (partition by day, currency order by hops, inverses, route) = 1)
        select p.business_unit, p.currency, period_date, cast(balance as double) as balance,
          case when p.currency = 'USD' then 1e0 else round(rate, 6) end as fx_rate,
          case when p.currency = 'USD' then 'USD' else route end as fx_route,
          round(cast(balance as double) * case when p.currency = 'USD' then 1e0 else rate end, 6) as converted_amount
        from nation_positions p left join shortest s on s.day = p.period_date and s.currency = p.currency""",
}
for _same in ("forecast_run_stored", "forecast_run_default"):
    STATEMENTS[_same] = STATEMENTS["nii_cost_centre_conserving"]
STATEMENTS["forecast_run_distinct"] = STATEMENTS["nii_cost_centre_distinct"]
STATEMENTS["run_replaced_by_empty"] = STATEMENTS["catalog_roundtrip"]
STATEMENTS["forecast_run_scoped"] = """
        select t.run_id, t.business_unit, round(nii, 6) as nii_business_unit, cost_centre,
          round(cc_ratio, 6) as cc_ratio, fe_weight,
          round(allocation_denominator, 6) as allocation_denominator,
          round(nii * cc_ratio * fe_weight / nullif(allocation_denominator, 0), 6) as nii_cost_centre
        from (select run_id, business_unit,
                cast(sum(cast(nii_business_unit as decimal(38,10))) as double) as nii
              from income where business_unit = 'ASIA'
                or (business_unit in ('EUROPE', 'AMERICA') and business_segment_group = 'BUILDING')
              group by run_id, business_unit) t
          join ratios r on t.run_id = r.run_id and t.business_unit = r.business_unit
          join unit_weights w on t.run_id = w.run_id and t.business_unit = w.business_unit"""
STATEMENTS["metric_run"] = STATEMENTS["metric_summary"]


def _content(name: str, table: str, columns: str) -> str:
    """Number and hash sums of a table's rows, a row being the text of its cells by column name."""
    cells = ", ".join(
        f"'{c}', coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar) || ';', '~;')"
        for c in sorted(columns.split())
    )
    sums = ", ':', ".join(
        f"coalesce(sum(cast(concat('0x', substr(h, {1 + 15 * i}, 15)) as bigint)), 0)" for i in range(4)
    )
    return (
        f"select '{name}' as table_name, sha256(concat('{name}', ':', count(*), ':', {sums})) as content_id "
        f"from (select sha256(concat({cells})) as h from {table})"
    )


STATEMENTS["run_identity"] = """
        with contents as (""" + " union all ".join(_content(*t) for t in (
    ("run_scope", "run_scope", "business_unit business_segment_group cost_centre currency"),
    ("yield_index_mapping", "yield_map", "business_unit product currency yield_index"),
    ("launchpoint_windows", "windows", "business_unit window_start window_end window_days"),
    ("proxy_source_mappings", "proxies",
     "business_unit product proxy_business_unit proxy_product scale_ratio fixed_adjustment"),
    ("inflation_adjustments", "inflation", "business_unit product lag_0 lag_1 lag_2 lag_3"),
    ("custom_yield_overrides", "overrides", "business_unit product currency override_factor"),
    ("forecast_substitution_rules", "rules", "substitution_code substitution_type"),
    ("launchpoint_period_yield_overrides", "period_overrides", "business_unit product currency period_override"),
    ("active_config_versions", "chosen_versions", "config_key config_version"),
)) + """),
        ids as (
          select sha256(string_agg(content_id, ':' order by table_name)) as config_snapshot_id,
            max(content_id) filter (table_name = 'active_config_versions') as active_config_version
          from contents)
        select run_id, business_unit, round(nii_business_unit, 6) as nii_business_unit, cost_centre,
          round(cc_ratio, 6) as cc_ratio, fe_weight,
          round(allocation_denominator, 6) as allocation_denominator,
          round(nii_cost_centre, 6) as nii_cost_centre,
          'exec-1' as execution_id, cast(978404645 as bigint) as run_timestamp,
          config_snapshot_id, active_config_version, 'nii_stage_cc' as output_table
        from allocated, ids"""


def _needed(text: str, found: dict[str, None]) -> None:
    for name in VIEWS:
        if name not in found and re.search(rf"\b(?:from|join|,)\s+{name}\b", text):
            _needed(VIEWS[name], found)
            found[name] = None


def sql(name: str) -> str:
    """The whole statement of one query."""
    text = STATEMENTS[name]
    found: dict[str, None] = {}
    _needed(text, found)
    views = [f"{v} as ({VIEWS[v]})" for v in found]
    body = text.strip()
    recursive = body.startswith("with recursive")
    if body.startswith("with"):
        own = body.removeprefix("with recursive" if recursive else "with").lstrip()
        own_views, rest = [own], ""
    else:
        own_views, rest = [], body
    if not views and not own_views:
        return body
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(views + own_views) + ("\n" + rest if rest else "")


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in STATEMENTS}
