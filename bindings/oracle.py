"""SQL twins of ``queries.py`` for DuckDB, written from the definitions and not from the Spark plans."""

from __future__ import annotations

STATUS = "['Single', 'Married', 'Divorced', 'Remarried']"

# --- views, in an order in which each uses only earlier ones -------------------------------------------------

VIEWS: dict[str, str] = {
    "places": """
        select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey""",
    "dim_customer": f"""
        select c_custkey * 2 + v as customer_sk, cast(c_custkey as varchar) as customer_id,
               case when v = 0 then upper(c_name) else c_name end as customer_name,
               c_mktsegment as customer_segment,
               {STATUS}[cast((c_custkey + v) % 4 + 1 as int)] as marital_status,
               case when c_custkey % 2 = 0 then 'Female' else 'Male' end as gender,
               case when v = 0 then date '1995-01-01' else date '1999-01-01' end as eff_start_dt,
               case when v = 0 and c_custkey % 3 <> 0 then date '1999-01-01' else date '9999-12-31' end as eff_end_dt,
               cast(case when v = 0 and c_custkey % 3 <> 0 then 0 else 1 end as int) as current_flag,
               r_name as region
        from customer join places on c_nationkey = n_nationkey
             join (values (0), (1)) as versions(v) on v = 0 or c_custkey % 3 <> 0""",
    "dim_policy": """
        select o_orderkey as policy_sk, 'P' || o_custkey as policy_id,
               'Plan ' || substr(o_orderpriority, 3) || ' ' || o_orderstatus as policy_name,
               substr(o_orderpriority, 1, 1) as policy_type_id, substr(o_orderpriority, 3) as policy_type,
               case o_orderstatus when 'F' then 'Quarterly' when 'O' then 'Half Yearly' else 'Yearly' end as policy_term,
               cast(o_orderdate as date) as policy_start_dt,
               cast(o_orderdate as date) + 3650 as policy_end_dt,
               cast(o_totalprice as decimal(18, 2)) as total_policy_amt
        from orders""",
    "dim_policy_type": """
        select distinct policy_type_id, policy_type as policy_type_name,
               'Cover for ' || lower(policy_type) as policy_type_desc
        from dim_policy where policy_type_id <> '5'""",
    "dim_address": """
        select s_suppkey as address_sk, 'USA' as country, n_name as state_province, s_name as city,
               cast(s_suppkey + 10000 as varchar) as postal_code
        from supplier join nation on s_nationkey = n_nationkey""",
    "transactions": """
        select l_linenumber as line, cast(o_custkey as varchar) as customer_id, o_orderkey as policy_sk,
               'P' || o_custkey as policy_id, case when l_suppkey % 10 <> 0 then l_suppkey end as address_sk,
               cast(l_shipdate as date) as txn_date, cast(strftime(l_shipdate, '%Y%m%d') as int) as date_sk,
               cast(l_extendedprice as decimal(18, 2)) as premium_amt,
               date_diff('day', cast(o_orderdate as date) + 90, cast(l_shipdate as date)) as late_days,
               cast(round_even(date_diff('day', cast(o_orderdate as date) + 90, cast(l_shipdate as date)) / 30.0, 0)
                    as int) as late_duration_months
        from lineitem join orders on l_orderkey = o_orderkey""",
    "fact_policy_txn": """
        select t.*, d.customer_sk
        from transactions t join dim_customer d
             on t.customer_id = d.customer_id and txn_date >= eff_start_dt and txn_date < eff_end_dt""",
    "postal_facts": """
        select * exclude (address_sk),
               case when policy_sk % 11 = 0 then '0' else cast(10000 + policy_sk % 7 as varchar) end as postal_code
        from transactions""",
    "customer_addresses": """
        select c_custkey * 100000 + code as address_sk, cast(c_custkey as varchar) as customer_id,
               cast(code as varchar) as postal_code
        from customer, range(10000, 10005) as codes(code)""",
    "left_keys": """
        select case when o_orderkey % 10 <> 0 then o_custkey % 2000 end as k, o_orderkey as id, o_orderstatus as tag
        from orders""",
    "right_keys": """
        select case when c_custkey <> 5 then c_custkey + 100 end as k, c_mktsegment as tag, c_nationkey as nation
        from customer""",
    "existing_customers": f"""
        select c_custkey as customer_sk, cast(c_custkey as varchar) as customer_id, c_name as customer_name,
               c_mktsegment as customer_segment,
               case when c_custkey % 4 <> 3 then {STATUS}[cast(c_custkey % 4 + 1 as int)] end as marital_status
        from customer where c_custkey % 10 <> 9""",
    "new_customers": f"""
        select cast(c_custkey as varchar) as customer_id,
               case when c_custkey % 6 = 0 then upper(c_name) else c_name end as customer_name,
               c_mktsegment as customer_segment,
               case when c_custkey % 5 = 0 then 'Remarried'
                    when c_custkey % 4 <> 3 then {STATUS}[cast(c_custkey % 4 + 1 as int)] end as marital_status,
               case when c_custkey % 3 <> 0 then date '1990-01-01' end as effective_start_dt
        from customer where c_custkey % 10 <> 8""",
    "changes": """
        select n.*, o.customer_sk as old_sk,
               o.customer_name is distinct from n.customer_name
               or o.customer_segment is distinct from n.customer_segment
               or o.marital_status is distinct from n.marital_status as differs
        from new_customers n left join existing_customers o using (customer_id)""",
    "dirty_events": """
        select case when event_id % 100 <> 0 then event_id end as event_id,
               case when event_id % 9 <> 0 then user_id end as user_id,
               case when event_id % 4 <> 0 then event_type end as event_type,
               case when event_id % 10 = 1 then null when event_id % 10 <> 0 then "value" end as "value"
        from events""",
    # The cleaned feed, one row per order, as it should come out of the raw text.
    "feed": f"""
        select o_orderkey as k, 1 + o_orderkey % 2 as batch_day, cast(c_custkey as varchar) as customer_id,
               case when r_name <> 'AFRICA' then c_name
                    else 'Mr. ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:])
                         || case when c_custkey % 2 = 1 then ' Q' else '' end
                         || ' O''' || upper(n_name[1]) || lower(n_name[2:]) end as customer_name,
               c_mktsegment as customer_segment,
               {STATUS}[cast((c_custkey + case when c_custkey % 5 = 0 then 1 + o_orderkey % 2 else 0 end) % 4 + 1 as int)]
                   as marital_status,
               case when c_custkey % 2 = 0 then 'Female' else 'Male' end as gender,
               date '1960-01-01' + cast(c_custkey % 10000 as int) as dob,
               case when c_custkey % 7 <> 0 then date '1990-01-01' end as effective_start_dt,
               cast(null as date) as effective_end_dt,
               substr(o_orderpriority, 1, 1) as policy_type_id, substr(o_orderpriority, 3) as policy_type,
               'Cover for ' || lower(substr(o_orderpriority, 3)) as policy_type_desc,
               substr(o_orderpriority, 1, 1) || '_' || c_nationkey as policy_id,
               'Plan ' || substr(o_orderpriority, 3) as policy_name,
               cast(o_totalprice as decimal(18, 2)) as premium_amt,
               case o_orderstatus when 'F' then 'Quarterly' when 'O' then 'Half Yearly' else 'Yearly' end as policy_term,
               cast(o_orderdate as date) as policy_start_dt, cast(o_orderdate as date) + 3650 as policy_end_dt,
               cast(o_orderdate as date) + 30 as next_premium_dt,
               case when o_orderkey % 97 <> 0 then cast(o_orderdate as date) + cast(o_orderkey % 400 + 10 as int) end
                   as actual_premium_paid_dt,
               ['USA', 'USA', 'USA', 'U.S.A', 'USA', 'USA', 'Canada'][cast(c_custkey % 7 + 1 as int)] as country,
               r_name as region, n_name as state_province, 'City ' || c_custkey % 50 as city,
               cast(10000 + c_nationkey * 10 + case when c_custkey % 3 = 0 then 1 + o_orderkey % 2 else 0 end as varchar)
                   as postal_code,
               cast(cast(o_totalprice as decimal(18, 2)) * 10 as decimal(18, 2)) as total_policy_amt,
               case when o_orderkey % 50 <> 0
                    then cast(cast(o_totalprice as decimal(18, 2)) * 2 as decimal(18, 2)) end as premium_amt_paid_tilldate,
               'Feed_' || r_name || '_day' || (1 + o_orderkey % 2) || '.csv' as source_file
        from orders join customer on o_custkey = c_custkey join places on c_nationkey = n_nationkey""",
    "feed_months": """
        select *, cast(coalesce(round_even(date_diff('day', next_premium_dt, actual_premium_paid_dt) / 30.0, 0), 0) as int)
                      as months
        from feed""",
    "feed_policies": """
        select * from (
            select policy_id, policy_type, policy_start_dt, policy_name, policy_type_id, policy_term, policy_end_dt,
                   total_policy_amt, batch_day,
                   row_number() over (partition by policy_id, policy_type, policy_start_dt
                       order by source_file, policy_name, policy_type_id, policy_term, policy_end_dt, total_policy_amt)
                       as n
            from feed) where n = 1""",
    # The same with files named by header form, loaded on two days: a policy version belongs to the first day it has.
    "load_policies": """
        select * from (
            select policy_id, policy_type, policy_start_dt, total_policy_amt, batch_day,
                   row_number() over (partition by policy_id, policy_type, policy_start_dt
                       order by batch_day, region <> 'AFRICA', policy_name, policy_type_id, policy_term, policy_end_dt,
                                total_policy_amt) as n
            from feed) where n = 1""",
    "load_customers": """
        select customer_id, min(customer_name) as customer_name,
               min(marital_status) filter (where batch_day = 1) as status1,
               min(marital_status) filter (where batch_day = 2) as status2,
               coalesce(min(effective_start_dt), date '1900-01-01') as first_start
        from feed group by customer_id""",
    "load_versions": """
        select customer_id, customer_name, coalesce(status1, status2) as marital_status, first_start as eff_start_dt,
               case when status1 <> status2 then date '1998-01-01' else date '9999-12-31' end as eff_end_dt,
               case when status1 <> status2 then 0 else 1 end as current_flag,
               case when status1 is null then 2 else 1 end as batch_day
        from load_customers
        union all
        select customer_id, customer_name, status2, date '1998-01-01', date '9999-12-31', 1, 2
        from load_customers where status1 <> status2""",
    "load_facts": """
        select f.*, v.marital_status as version_status, v.eff_start_dt, v.eff_end_dt, v.current_flag
        from feed_months f join load_versions v
             on f.customer_id = v.customer_id and f.actual_premium_paid_dt >= v.eff_start_dt
                and v.batch_day <= f.batch_day
                and (f.batch_day = 1 or f.actual_premium_paid_dt < v.eff_end_dt)""",
    # One version per policy, start and day it is known from.
    "load_policy_days": """
        select policy_id, policy_start_dt, day as known_on, min(policy_type) as policy_type
        from load_policies join (values (1), (2)) as days(day) on batch_day <= day
        group by all""",
}

# --- queries -------------------------------------------------------------------------------------------------

# Per policy, type and name: the first and last start. A later policy of another type exists if its last start lies
# after the first start of this one.
_TYPE_SPANS = """
    spans as (
        select policy_id, policy_type, policy_name, min(policy_start_dt) as first_start from dim_policy group by all),
    bought as (
        select distinct customer_sk, policy_id, policy_type, policy_name, policy_start_dt
        from dim_policy semi join fact_policy_txn using (policy_sk) natural join
             (select distinct policy_sk, customer_sk from fact_policy_txn))"""

# Amounts by customer version and policy, each policy once per transaction.
_SPENT = """
    counted as (select policy_sk, customer_sk, count(*) as txns from fact_policy_txn group by all),
    spent as (
        select customer_sk, policy_type, policy_term, policy_start_dt, total_policy_amt * txns as amount
        from counted natural join dim_policy),
    people as (select customer_sk, customer_id, customer_name, region, current_flag from dim_customer)"""

_JOIN = """
    select {key} as k, l.id, l.tag as tag_x, r.tag as tag_y, r.nation
    from left_keys l {how} join right_keys r on l.k is not distinct from r.k"""

_DIRTY_DATE = """
    case when o_orderkey % 20 = 0 then '31/31/2012'
         when o_orderkey % 20 <> 1 then strftime(o_orderdate, '%-m/%-d/%Y') end"""

_STATS = """
    round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, round(min({c}), 6) as "min",
    round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50,
    round(quantile_cont({c}, 0.75), 6) as p75, round(max({c}), 6) as "max" """

_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _money(*names: str) -> str:
    return ", ".join(f"cast({n} as double) as {n}" for n in names)


QUERIES: dict[str, str] = {
    "rpt_b": f"""
        with {_TYPE_SPANS}
        select distinct customer_id, customer_name, now.policy_type as current_policy_type,
               earlier.policy_type as previous_policy_type, policy_id
        from bought as now natural join (select customer_sk, customer_id, customer_name from dim_customer where current_flag = 1)
             join spans as earlier using (policy_id)
        where earlier.policy_type <> now.policy_type and earlier.first_start < now.policy_start_dt""",
    "rpt_b_revised": f"""
        with {_TYPE_SPANS}
        select distinct customer_id, customer_name, now.policy_type as current_policy_type, policy_id as current_policy_id,
               now.policy_name as current_policy_name, earlier.policy_type as previous_policy_type,
               policy_id as previous_policy_id, earlier.policy_name as previous_policy_name
        from bought as now natural join (select customer_sk, customer_id, customer_name from dim_customer)
             join spans as earlier using (policy_id)
        where earlier.policy_type <> now.policy_type and earlier.first_start < now.policy_start_dt""",
    "rpt_b_customer": """
        with days as (
            select policy_id as customer_id, policy_start_dt, min(policy_type) as policy_type
            from dim_policy group by all),
        steps as (
            select *, lag(policy_type) over (partition by customer_id order by policy_start_dt) as previous_policy_type
            from days)
        select customer_id, policy_start_dt, policy_type as current_policy_type, previous_policy_type
        from steps where policy_type <> previous_policy_type""",
    "rpt_c": f"""
        with {_SPENT}
        select customer_id, customer_name, region, cast(sum(amount) as double) as total_policy_amt
        from spent natural join people group by all""",
    "rpt_d": f"""
        with {_SPENT}
        select customer_id, customer_name, region, policy_type, cast(sum(amount) as double) as total_policy_amt
        from spent natural join people where policy_type = 'URGENT' group by all""",
    "rpt_e": f"""
        with {_SPENT}
        select customer_id, customer_name, region, policy_term, policy_start_dt, cast(sum(amount) as double) as total_policy_amt
        from (select * from spent where policy_term = 'Quarterly' and policy_start_dt between '1996-01-01' and '1996-12-31')
             natural join (select * from people where current_flag = 1 and region in ('ASIA', 'EUROPE'))
        group by all""",
    "rpt_f": """
        select customer_id, customer_name as customer_title, customer_name as customer_first_name,
               customer_name as customer_last_name, customer_segment, marital_status,
               eff_start_dt as start_dt, eff_end_dt as end_dt
        from dim_customer
        where customer_id in (select customer_id from dim_customer group by customer_id
                              having count(distinct marital_status) > 1)""",
    "rpt_g": """
        with described as (
            select p.*, (select any_value(t.policy_type_desc) from dim_policy_type t where t.policy_type_id = p.policy_type_id)
                       as policy_type_desc
            from dim_policy p)
        select region, customer_id, customer_name, customer_segment, marital_status, gender, city, state_province,
               postal_code, policy_id, policy_name, policy_type, policy_type_desc, policy_term, policy_start_dt,
               policy_end_dt, cast(total_policy_amt as double) as total_policy_amt
        from (select customer_sk, policy_sk, address_sk from fact_policy_txn) links
             join described using (policy_sk)
             join (select * from dim_customer where current_flag = 1) people using (customer_sk)
             left join (select address_sk, city, state_province, postal_code from dim_address) places using (address_sk)""",
    "rpt_h": """
        with seen as (
            select customer_sk, address_sk, strptime(cast(date_sk as varchar), '%Y%m%d')::date as day
            from fact_policy_txn where date_sk >= 19960101 and date_sk <= 19981231)
        select customer_id, customer_name, address_sk, city, state_province, postal_code, country,
               min(day) as first_seen_date, max(day) as last_seen_date
        from seen join (select customer_sk, customer_id, customer_name from dim_customer) people using (customer_sk)
             join (select address_sk, city, state_province, postal_code, country from dim_address) places using (address_sk)
        group by all""",
    "join_asof_scd2": """
        select t.policy_sk, t.line, t.customer_id, d.customer_sk, t.txn_date
        from transactions t join dim_customer d
             on t.customer_id = d.customer_id and txn_date between eff_start_dt and eff_end_dt""",
    "join_address_link": """
        select policy_sk, line, f.customer_id, f.postal_code, a.address_sk
        from postal_facts f left join customer_addresses a using (customer_id, postal_code)""",
    "join_policy_link": """
        select t.policy_id, t.txns, p.policy_sk
        from (select policy_id, count(*) as txns from transactions group by 1) t left join dim_policy p using (policy_id)""",
    "join_policy_version": """
        with versions as (
            select policy_id, policy_start_dt, arg_min(policy_sk, (policy_type, policy_sk)) as policy_sk
            from dim_policy group by 1, 2),
        earliest as (select policy_id, arg_min(policy_sk, policy_start_dt) as policy_sk from versions group by 1)
        select t.policy_sk as order_key, t.line, t.policy_id, t.txn_date, coalesce(v.policy_sk, e.policy_sk) as policy_sk
        from transactions t
             asof left join versions v on t.policy_id = v.policy_id and t.txn_date >= v.policy_start_dt
             left join earliest e on t.policy_id = e.policy_id""",
    "join_late_fee": """
        select policy_sk, line, late_duration_months,
               case when late_duration_months between 0 and 60 then late_duration_months end as late_fee_sk
        from transactions""",
    "dim_late_fee": """
        select cast(m as int) as duration_months, m * 5 / 1000.0 as penalty_percent, m || ' Months Delay' as description,
               count(t.line) as txns,
               cast(coalesce(cast(sum(premium_amt) as decimal(28, 2)) * cast(m * 5 as decimal(4, 0)) * 0.001, 0) as double)
                   as penalty
        from range(61) as months(m) left join transactions t on late_duration_months = m group by m""",
    "fact_policy_txn": """
        with versions as (
            select policy_id, policy_start_dt, arg_min(policy_sk, (policy_type, policy_sk)) as policy_sk
            from dim_policy group by 1, 2),
        earliest as (select policy_id, arg_min(policy_sk, policy_start_dt) as policy_sk from versions group by 1)
        select cast(c.customer_sk as varchar) as customer_sk,
               cast(coalesce(v.policy_sk, e.policy_sk) as varchar) as policy_sk,
               cast(a.address_sk as varchar) as address_sk,
               case when late_duration_months between 0 and 60 then late_duration_months end as late_fee_sk,
               date_sk, cast(premium_amt as double) as premium_amt,
               cast(round(premium_amt * greatest(late_duration_months, 0) * 0.005, 2) as double) as late_fee
        from postal_facts t
             asof left join versions v on t.policy_id = v.policy_id and t.txn_date >= v.policy_start_dt
             left join earliest e on t.policy_id = e.policy_id
             join dim_customer c on t.customer_id = c.customer_id and txn_date >= eff_start_dt and txn_date < eff_end_dt
             left join customer_addresses a on t.customer_id = a.customer_id and t.postal_code = a.postal_code""",
    "join_inner": _JOIN.format(how="inner", key="l.k"),
    "join_left": _JOIN.format(how="left", key="l.k"),
    "join_right": _JOIN.format(how="right", key="r.k"),
    "join_outer": _JOIN.format(how="full", key="coalesce(l.k, r.k)"),
    "agg_generic": """
        with rows as (
            select case when user_id % 7 <> 0 then event_type end as kind,
                   case when event_type <> 'view' then "value" end as part, "value" as v, user_id, event_id
            from events)
        select kind as event_type, round(coalesce(sum(part), 0), 6) as "value", round(avg(v), 6) as worth,
               round(stddev_samp(v), 6) as spread, round(median(v), 6) as middle, min(v) as least,
               count(distinct user_id) as users, min(event_id) as earliest,
               count(case when event_id % 3 <> 0 then event_id end) as hits
        from rows where kind is not null group by kind""",
    "set_union_outer": """
        select o_orderkey, o_orderstatus, cast(null as int) as l_linenumber from orders
        union all select l_orderkey, null, l_linenumber from lineitem""",
    "std_columns": """
        select c_custkey as customer_id, c_name as state_province, c_nationkey as marital_status,
               c_acctbal as policy_type_name
        from customer""",
    "std_currency": """
        select l_orderkey, l_linenumber,
               case when l_orderkey % 50 <> 0 then cast(cast(l_extendedprice as decimal(18, 2)) as double) end as price
        from lineitem""",
    "std_dates_formats": """
        select o_orderkey, case when o_orderkey % 5 < 4 then cast(o_orderdate as date) end as "day" from orders""",
    "load_rejects": """
        select 'cell' as kind, 'actual_premium_paid_dt' as item, 'no date in the given formats' as reason,
               cast(count(*) as bigint) as "rows" from feed where city like '%7'
        union all
        select 'row', 'fact_policy_txn', 'no customer version on the day', cast(count(*) as bigint)
        from feed where city like '%7' or actual_premium_paid_dt is null
        union all
        select 'file', 'a.zip/x_day1.csv', 'BadZipFile: damaged', null""",
    "load_rules": """
        select 'rule' as kind, 'premium_amt is positive' as item, 'failed' as reason, cast(count(*) as bigint) as "rows"
        from feed where city like '%3'
        union all select 'rule', 'policy_id is given', 'failed', cast(count(*) as bigint) from feed where city like '%4'
        union all select 'column', 'loyalty_code', 'no column of the feed', null
        union all select 'row', 'fact_policy_txn', 'no customer version on the day', cast(count(*) as bigint)
        from feed where actual_premium_paid_dt is null
        union all select 'table', 'feed', 'loaded', cast(count(*) as bigint) from feed""",
    "std_dates_inferred": """
        select o_orderkey, 'f' || (o_orderkey % 3) || '.csv' as source_file, cast(o_orderdate as date) + 7305 as "day" from orders""",
    "std_dates": """
        select o_orderkey, case when o_orderkey % 20 <> 0 then cast(o_orderdate as date) end as "day" from orders""",
    "std_trim": "select c_custkey, c_name as name from customer",
    "std_country": """
        select c_custkey,
               ['USA', 'USA', 'USA', 'U.S.A', 'USA', 'USA', 'Canada'][cast(c_custkey % 7 + 1 as int)] as country
        from customer""",
    "std_ids": """
        select o_orderkey, case when o_orderkey % 9 <> 0 then cast(o_custkey as varchar) else '' end as customer_id
        from orders""",
    "std_postal": """
        select s_suppkey, case when s_suppkey % 3 < 2 then cast(s_suppkey + 10000 as varchar) else '' end as postal_code
        from supplier""",
    "date_key": """
        select o_orderkey,
               cast(case when o_orderkey % 13 <> 0 then strftime(o_orderdate, '%Y%m%d') else '0' end as int) as date_sk
        from orders""",
    "date_key_parse": """
        select o_orderkey,
               cast(case when o_orderkey % 13 <> 0 then strftime(o_orderdate, '%Y%m%d') else '0' end as int) as date_sk,
               case when o_orderkey % 13 <> 0 then cast(o_orderdate as date) end as "day"
        from orders""",
    "std_value_map": """
        select c_custkey,
               case c_mktsegment when 'AUTOMOBILE' then 'Car' when 'HOUSEHOLD' then 'Home' when 'FURNITURE' then 'Home'
                                 else ' ' || c_mktsegment end as segment
        from customer""",
    "std_region_lookup": """
        select c_custkey, n_name as state_province, case when c_nationkey <> 3 then r_name end as region
        from customer join places on c_nationkey = n_nationkey""",
    "xf_customer_name": """
        select p_partkey,
               case when p_partkey % 4 = 0 then 'already named'
                    else 'Mr. O''' || array_to_string(list_transform(string_split(p_name, ' '),
                             lambda w: upper(w[1]) || lower(w[2:])), ' ')
                         || case when p_partkey % 2 = 0 then ' Van Der ' else ' ' end
                         || upper(p_type[1]) || lower(p_type[2:]) || '-X' end as customer_name
        from part""",
    "xf_late_fee": """
        with rows as (
            select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(18, 2)) as premium_amt,
                   case when l_orderkey % 40 <> 0
                        then date_diff('day', cast(o_orderdate as date) + 90, cast(l_shipdate as date)) end as days
            from lineitem join orders on l_orderkey = o_orderkey),
        months as (select *, cast(coalesce(round_even(days / 30.0, 0), 0) as int) as months from rows),
        fees as (select *, cast(greatest(months, 0) * 5 as decimal(6, 0)) as per_mille from months)
        select l_orderkey, l_linenumber, cast(premium_amt as double) as premium_amt,
               cast(days as int) as late_duration_days, months as late_duration_months,
               cast(per_mille as double) / 1000 as late_fee_pct,
               cast(cast(premium_amt as decimal(20, 5)) * per_mille * 0.001 as double) as late_fee_amount,
               cast(premium_amt + cast(premium_amt as decimal(20, 5)) * per_mille * 0.001 as double) as total_amount_to_pay
        from fees""",
    "xf_installments": """
        with rows as (
            select o_orderkey, cast(o_totalprice as decimal(18, 2)) as total,
                   case when o_orderkey % 30 <> 0 then o_orderkey % 900 * 10 end as premium,
                   case when o_orderkey % 8 <> 0 then 500 else 0 end as paid
            from orders)
        select o_orderkey,
               case when premium > 0
                    then cast(cast(total * 100 as bigint) // (premium * 100)
                              + case when cast(total * 100 as bigint) % (premium * 100) > 0 then 1 else 0 end as bigint)
                    end as installment_count,
               cast(total - paid as double) as remaining_amount
        from rows""",
    "xf_split": "select distinct o_custkey, o_orderstatus from orders",
    "xf_dedup_first": """
        select o_custkey, o_orderkey, o_orderstatus, o_orderpriority from orders
        qualify row_number() over (partition by o_custkey order by o_orderkey) = 1""",
    "scd2_inserts": """
        select customer_id, customer_name, customer_segment, marital_status, effective_start_dt,
               cast(1 as int) as current_flag, date '1997-01-01' as eff_start_dt, date '9999-12-31' as eff_end_dt
        from changes where old_sk is null or differs""",
    "scd2_expired": """
        select old_sk as customer_sk, cast(0 as int) as current_flag, date '1997-01-01' as eff_end_dt
        from changes where old_sk is not null and differs""",
    "scd2_initial": """
        select *, cast(1 as int) as current_flag, coalesce(effective_start_dt, date '1900-01-01') as eff_start_dt,
               date '9999-12-31' as eff_end_dt
        from new_customers""",
    "scd2_apply": """
        with old as (
            select e.customer_id, e.customer_name, e.customer_segment, e.marital_status, date '1992-01-01' as eff_start_dt,
                   case when c.differs then date '1998-01-01' else date '9999-12-31' end as eff_end_dt,
                   case when c.differs then 0 else 1 end as current_flag
            from existing_customers e left join changes c using (customer_id)),
        opened as (
            select customer_id, customer_name, customer_segment, marital_status,
                   case when old_sk is null then coalesce(effective_start_dt, date '1900-01-01')
                        else date '1998-01-01' end, date '9999-12-31', 1
            from changes where old_sk is null or differs)
        select customer_id, customer_name, customer_segment, marital_status, 'F' as gender, date '1980-01-01' as dob,
               eff_start_dt, eff_end_dt, cast(current_flag as int) as current_flag, 'West' as region
        from (from old union all from opened)""",
    "scd1_merge": """
        select o.customer_sk, coalesce(o.customer_id, n.customer_id) as customer_id,
               coalesce(n.customer_name, o.customer_name) as customer_name, o.customer_segment,
               coalesce(n.marital_status, o.marital_status) as marital_status,
               case when o.customer_id is null then n.effective_start_dt end as effective_start_dt
        from existing_customers o full join new_customers n on o.customer_id = n.customer_id""",
    "stg_customers": """
        select distinct customer_id, customer_name, customer_segment, marital_status, gender, dob, effective_start_dt,
               effective_end_dt, region, source_file
        from feed""",
    "stg_policy": f"""
        select distinct policy_id, policy_name, policy_type_id, policy_type, policy_type_desc, policy_term,
               policy_start_dt, policy_end_dt, {_money('total_policy_amt', 'premium_amt')}, next_premium_dt,
               actual_premium_paid_dt, {_money('premium_amt_paid_tilldate')}, customer_id, region, source_file
        from feed""",
    "stg_address": """
        select distinct customer_id, country, region, state_province, city, postal_code, source_file from feed""",
    "stg_transactions": """
        select distinct policy_id, customer_id, actual_premium_paid_dt as txn_date,
               cast(premium_amt as double) as premium_amount,
               cast(premium_amt_paid_tilldate as double) as premium_paid_tilldate,
               cast(total_policy_amt as double) as total_policy_amt, region, source_file
        from feed""",
    "dim_policy_type": """
        select distinct policy_type_id, policy_type as policy_type_name, policy_type_desc from feed""",
    "dim_policy": f"""
        select policy_id, policy_name, policy_type_id, policy_type, policy_term, policy_start_dt, policy_end_dt,
               {_money('total_policy_amt')}
        from feed_policies""",
    "dim_address": """
        select distinct customer_id, country, region, state_province, city, postal_code from feed""",
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as int) as date_sk, cast(d as date) as dt, cast(year(d) as int) as "year",
               cast(month(d) as int) as "month", cast(day(d) as int) as "day", cast(quarter(d) as int) as "quarter"
        from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)""",
    "pipe_batch": """
        select 'stg_customers' as table_name, count(*) as "rows"
        from (select distinct customer_id, customer_name, customer_segment, marital_status, gender, dob,
                     effective_start_dt, region, source_file from feed)
        union all select 'stg_policy', count(*)
        from (select distinct * exclude (k, batch_day, customer_name, customer_segment, marital_status, gender, dob,
                     effective_start_dt, effective_end_dt, country, state_province, city, postal_code) from feed)
        union all select 'stg_address', count(*)
        from (select distinct customer_id, country, region, state_province, city, postal_code, source_file from feed)
        union all select 'stg_transactions', count(*)
        from (select distinct policy_id, customer_id, actual_premium_paid_dt, premium_amt, premium_amt_paid_tilldate,
                     total_policy_amt, region, source_file from feed)
        union all select 'dim_customer', count(distinct customer_id) from feed
        union all select 'dim_policy_type', count(distinct policy_type_id) from feed
        union all select 'dim_policy', count(*) from feed_policies
        union all select 'dim_address', count(*) from (select distinct customer_id, postal_code from feed)
        union all select 'dim_date', max(actual_premium_paid_dt) - min(actual_premium_paid_dt) + 1 from feed
        union all select 'dim_late_fee', 61
        union all select 'fact_policy_txn', count(*) from feed where actual_premium_paid_dt is not null""",
    "pipe_two_days": """
        select cast(strftime(f.actual_premium_paid_dt, '%Y%m%d') as int) as date_sk,
               cast(f.premium_amt as double) as premium_amt,
               cast(f.premium_amt_paid_tilldate as double) as premium_paid_tilldate,
               cast(f.total_policy_amt as double) as total_policy_amt,
               cast(round(f.premium_amt * greatest(f.months, 0) * 0.005, 2) as double) as late_fee,
               f.region, f.customer_id, f.customer_name, f.version_status as marital_status, f.eff_start_dt, f.eff_end_dt,
               cast(f.current_flag as int) as current_flag, f.policy_id, p.policy_type, p.policy_start_dt,
               cast(p.total_policy_amt as double) as version_amt, f.postal_code, f.city, f.country,
               case when f.months between 0 and 60 then f.months end as duration_months
        from load_facts f
             asof left join load_policy_days v on f.policy_id = v.policy_id and f.batch_day = v.known_on
                                                  and f.actual_premium_paid_dt >= v.policy_start_dt
             left join (select policy_id, known_on, min(policy_start_dt) as policy_start_dt,
                               arg_min(policy_type, policy_start_dt) as policy_type
                        from load_policy_days group by 1, 2) e on f.policy_id = e.policy_id and f.batch_day = e.known_on
             left join load_policies p
                  on p.policy_id = f.policy_id and p.policy_type = coalesce(v.policy_type, e.policy_type)
                     and p.policy_start_dt = coalesce(v.policy_start_dt, e.policy_start_dt)""",
    "src_csv": "select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders",
    "src_folder_union": """
        select c_custkey as customer_id, c_name as customer_name, null as full_name, c_mktsegment as segment,
               'Customers_day' || d || '.csv' as source_file
        from customer join (values (1), (2)) as days(d) on c_custkey % 3 = d
        union all
        select c_custkey, null, c_name, c_mktsegment, 'Customers_day11.csv' from customer where c_custkey % 3 = 2""",
    "src_batch_days": """
        select cast(1 as int) as batch_day, count(*) as "rows" from customer where c_custkey % 3 = 1
        union all select 2, count(*) from customer where c_custkey % 3 = 2
        union all select 11, count(*) from customer where c_custkey % 3 = 2""",
    "src_batch_select": """
        select c_custkey as customer_id, c_name as customer_name, c_mktsegment as segment,
               'Customers_day1.csv' as source_file
        from customer where c_custkey % 3 = 1""",
    "src_zip_csv": """
        select c_custkey as customer_id, c_name || ', "' || c_mktsegment || '"' || chr(10) || 'next' as name,
               'customers_day1.csv' as source_file
        from customer""",
    "src_sql_query": """
        select o_orderstatus, count(*) as orders, count(distinct o_custkey) as customers from orders group by 1""",
    "src_table": "select * from supplier",
    "sink_append": """select event_id, user_id, event_type, "value" from events""",
    "chk_table_counts": " union all ".join(
        f"""select '{t}' as table_name, count(*) as "rows" from {t}"""
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "chk_preview": "select * exclude (o_orderdate) from orders order by o_orderkey limit 10",
    "val_nulls": " union all ".join(
        f"""select '{c}' as column_name, count(*) - count("{c}") as null_count from dirty_events"""
        for c in ("event_id", "user_id", "event_type", "value")
    ),
    "val_duplicates": """
        select count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as duplicate_rows
        from lineitem""",
    "val_orphans": """
        select policy_sk, line, address_sk from transactions
        where address_sk is null or address_sk not in (select address_sk from dim_address where address_sk % 7 <> 0)""",
    "val_report": """
        select count(*) as "rows", cast(2 as int) as "columns",
               cast(2 * count(*) - count(user_id) - count(event_type) as bigint) as nulls_total,
               count(*) - (select count(*) from (select distinct user_id, event_type from dirty_events)) as duplicates,
               'user_id bigint, event_type string' as dtypes
        from dirty_events""",
    "val_schema": """
        select 'event_id' as column_name, 'present' as status, count(event_id) as filled_rows from dirty_events
        union all select 'event_type', 'present', count(event_type) from dirty_events
        union all select 'value', 'present', count("value") from dirty_events
        union all select 'amount', 'missing', 0
        union all select 'user_id', 'unexpected', count(user_id) from dirty_events""",
    "val_schema_drift": """
        with drifts(batch_day, column_name, change, written, written_before, position, position_before) as (values
            (2, 'customer_name', 'respelled', 'Customer NAME', 'Customer Name', 1, 1),
            (2, 'nation', 'added', 'Nation', null, 3, null), (2, 'nation', 'unknown', 'Nation', null, 3, null),
            (3, 'customer_id', 'lost', null, 'Customer ID', null, 0),
            (3, 'customer_name', 'moved', 'Customer NAME', 'Customer NAME', 1, 1),
            (3, 'segment', 'moved', 'Segment', 'Segment', 0, 2), (3, 'nation', 'moved', 'Nation', 'Nation', 2, 3),
            (3, 'nation', 'unknown', 'Nation', null, 2, null)),
        filled as (
            select c_custkey % 3 + 1 as batch_day, count(c_name) as customer_name, count(c_mktsegment) as segment,
                   count(c_nationkey) as nation
            from customer where c_acctbal < 0 group by 1)
        select 'Debit' as feed, 'Debit_day' || batch_day || '.csv' as source_file, column_name, change, written,
               written_before, cast(position as int) as position, cast(position_before as int) as position_before,
               case column_name when 'customer_name' then customer_name when 'segment' then segment
                                when 'nation' then nation else 0 end as filled_rows
        from drifts join filled using (batch_day)""",
    "val_rules": """
        select 'event_id is given' as rule, count(*) - count(event_id) as failed_rows from dirty_events
        union all select 'user_id is given', count(*) - count(user_id) from dirty_events
        union all select 'value is positive',
                         count(*) filter (case when event_id % 10 = 1 then 0.0 else "value" end <= 5)
        from (select event_id, case when event_id % 10 <> 0 then "value" end as "value" from events)""",
    "val_dates": f"""
        select 'policy_start_dt' as column_name,
               count(*) filter (raw is not null and try_strptime(raw, '%m/%d/%Y') is null) as bad_rows
        from (select {_DIRTY_DATE} as raw from orders)
        union all select 'dob', count(*) from orders""",
    "eda_missing": """
        select * from (""" + " union all ".join(
        f"""select '{c}' as column_name, count(*) - count("{c}") as missing_values,
                   round((count(*) - count("{c}")) * 100.0 / count(*), 6) as percentage from dirty_events"""
        for c in ("event_id", "user_id", "event_type", "value")
    ) + ") where missing_values > 0",
    "eda_stats": f"""
        select 'user_id' as column_name, count(user_id) as "count", cast(null as bigint) as "unique",
               cast(null as varchar) as top, cast(null as bigint) as freq, {_STATS.format(c='cast(user_id as double)')}
        from dirty_events
        union all
        select 'value', count("value"), null, null, null, {_STATS.format(c='"value"')} from dirty_events
        union all
        select 'event_type', count(event_type), count(distinct event_type),
               (select event_type from dirty_events where event_type is not null
                group by 1 order by count(*) desc, event_type limit 1),
               (select count(*) from dirty_events where event_type is not null
                group by event_type order by count(*) desc limit 1),
               null, null, null, null, null, null, null
        from dirty_events""",
    "eda_corr": " union all ".join(
        f"select '{x}' as column_x, '{y}' as column_y, round(corr({x}, {y}), 6) as correlation from lineitem"
        for x in _NUMBERS
        for y in _NUMBERS
    ),
    "eda_histogram": """
        with ends as (select min("value") as low, max("value") as high from events),
        counts as (
            select least(cast(floor(("value" - low) / ((high - low) / 30)) as int) + 1, 30) as bin, count(*) as n
            from events, ends group by 1)
        select cast(b as int) as bin, round(low + (b - 1) * ((high - low) / 30), 6) as bin_start,
               round(low + b * ((high - low) / 30), 6) as bin_end, coalesce(n, 0) as "rows"
        from range(1, 31) as bins(b) cross join ends left join counts on bin = b""",
    "eda_value_counts": """
        select event_type as "value", count(*) as "rows" from dirty_events where event_type is not null group by 1""",
}

# However the days arrive, they give the same tables.
QUERIES["pipe_stream"] = QUERIES["pipe_two_days"]


def _with_views(sql: str) -> str:
    """Put the views a query needs in front of it."""
    needed: list[str] = []

    def need(text: str, before: list[str]) -> None:
        for name in before:
            if name in text and name not in needed:
                need(VIEWS[name], before[: before.index(name)])
                needed.append(name)

    need(sql, list(VIEWS))
    ctes = ", ".join(f"{name} as ({VIEWS[name]})" for name in VIEWS if name in needed)
    if not ctes:
        return sql.strip()
    body = sql.strip()
    return f"with {ctes}{',' + body[4:] if body.startswith('with ') else ' ' + body}"


ORACLE: dict[str, str] = {name: _with_views(sql) for name, sql in QUERIES.items()}
