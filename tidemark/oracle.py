"""The queries of the catalog as plain SQL over the sample tables, for cross-checking."""

from __future__ import annotations

VIEWS = {
    "raw": """
        select event_id as id, epoch_us(ts) // 1000 as ts, strftime(ts, '%Y%m%d') as day,
          'mid_' || user_id as mid, 'ar' || (user_id % 4) as ar, 'ch' || (user_id % 3) as ch,
          'v' || (event_id % 2) as vc,
          case when event_id % 4 = 0 then '0' else '1' end as is_new, event_type,
          case when event_type in ('view', 'purchase') then null
               when event_type = 'error' then '' else 'home' end as last_page_id,
          cast(json_extract(props, '$.k') as bigint) as k,
          cast(floor(value * 1000) as bigint) as during_time
        from events""",
    "log": """
        select * exclude (is_new),
          case when is_new = '1'
                 and day <> min(day) filter (where is_new = '1') over (partition by mid)
               then '0' else is_new end as is_new
        from raw""",
    "page": """
        select *, event_type as page_id, coalesce(last_page_id, '') = '' as is_entry
        from log where event_type <> 'signup'""",
    "uv": """
        select * from (
          select *, row_number() over (partition by mid, day order by ts, id) as rn
          from page where is_entry) where rn = 1""",
    "nxt": "select *, lead(ts) over (partition by mid order by ts, id) as next_ts from page",
    "after": """
        select * from (
          select id, mid, ts, is_entry, lead(struct_pack(id := id, ts := ts, page_id := page_id, is_entry := is_entry))
            over (partition by mid order by ts, id) as nxt from page)""",
    "outcomes": """
        select id, mid, ts,
          case when nxt is null or nxt.ts - ts >= 21600000 then 'timeout' when not nxt.is_entry then 'match' end as outcome,
          case when outcome = 'match' then nxt.id end as next_id, case when outcome = 'match' then nxt.ts end as next_ts,
          case when outcome = 'match' then nxt.page_id end as next_page
        from after where is_entry""",
    "jump10s": "select * from nxt where is_entry and (next_ts is null or next_ts - ts >= 10000)",
    "jump6h": "select * from nxt where is_entry and (next_ts is null or next_ts - ts >= 21600000)",
}


def _measures(jump: str) -> str:
    return f"""
        select ar, ch, vc, is_new, ts, 0::bigint as uv_ct, 1::bigint as pv_ct,
          is_entry::bigint as sv_ct, 0::bigint as uj_ct, during_time as dur_sum from page
        union all select ar, ch, vc, is_new, ts, 1, 0, 0, 0, 0 from uv
        union all select ar, ch, vc, is_new, ts, 0, 0, 0, 1, 0 from {jump}"""


# Log lines of which some are unusable. A line without its device or time takes no part in
# the repair of flags.
VIEWS["damaged"] = """
        select * exclude (way, timed, readable, repair, is_new),
          timed and readable and not (repair and way in (0, 1))
            and not (way = 2 and event_type = 'click' and k % 3 = 2)
            and (event_type = 'signup' or (id % 10 <> 3 and way <> 4)) as usable,
          case when repair then '0' else is_new end as is_new
        from (
          select *, event_type = 'signup' as start,
            is_new = '1' and day <> min(day)
              filter (where is_new = '1' and timed and readable) over (partition by mid) as repair
          from (select *, case when id % 10 = 4 then id // 10 % 5 else -1 end as way,
                  id % 10 not in (0, 1, 2) as timed,
                  id % 10 <> 4 or id // 10 % 5 <> 3 as readable
                from raw))"""
VIEWS["measures10s"] = _measures("jump10s")
VIEWS["measures6h"] = _measures("jump6h")

VIEWS["user_dim"] = """
        select c_custkey::varchar as id,
          strftime(date '1960-01-01' + (c_custkey * 7 % 16000)::int, '%Y-%m-%d') as birthday,
          c_mktsegment as gender
        from customer where c_custkey % 10 <> 0"""
VIEWS["numbered"] = """
        select *, l_orderkey * 1000000 + row_number() over (partition by l_orderkey order by
          l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
          l_returnflag, l_linestatus, l_shipdate) as detail_id
        from lineitem"""
VIEWS["ord"] = """
        select o_orderkey as id, o_custkey % 25 as province_id, o_orderstatus as order_status,
          o_custkey as user_id, o_totalprice::decimal(18, 2) as total_amount,
          strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time,
          strftime(o_orderdate, '%Y-%m-%d') as create_date,
          strftime(o_orderdate, '%H') as create_hour,
          epoch_us(o_orderdate) // 1000000 * 1000 as create_ts
        from orders"""
VIEWS["det"] = """
        select detail_id as id,
          l_orderkey as order_id, l_partkey as sku_id,
          l_extendedprice::decimal(18, 2) as order_price, l_quantity::bigint as sku_num,
          'sku_' || l_partkey as sku_name,
          strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as create_time,
          l_extendedprice::decimal(18, 2) as split_total_amount,
          epoch_us(l_shipdate) // 1000000 * 1000 as create_ts
        from numbered"""


def _pairs(millis: int) -> str:
    return f"""
        select o.id as order_id, d.id as detail_id, o.create_ts as order_ts,
          d.create_ts as detail_ts
        from ord o join det d on o.id = d.order_id
          and d.create_ts between o.create_ts - {millis} and o.create_ts + {millis}"""


def _wide(days: int) -> str:
    millis = days * 86_400_000
    return f"""
        select d.id as detail_id, o.id as order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
          o.province_id, o.order_status, o.user_id, o.total_amount,
          null::decimal(18, 2) as activity_reduce_amount,
          null::decimal(18, 2) as coupon_reduce_amount,
          null::decimal(18, 2) as original_total_amount,
          null::decimal(18, 2) as feight_fee, null::decimal(18, 2) as split_feight_fee,
          null::decimal(18, 2) as split_activity_amount,
          null::decimal(18, 2) as split_coupon_amount,
          d.split_total_amount, null::varchar as expire_time, o.create_time,
          null::varchar as operate_time, o.create_date, o.create_hour,
          null::varchar as province_name, null::varchar as province_area_code,
          null::varchar as province_iso_code, null::varchar as province_3166_2_code,
          null::int as user_age, null::varchar as user_gender, null::bigint as spu_id,
          null::bigint as tm_id, null::bigint as category3_id, null::varchar as spu_name,
          null::varchar as tm_name, null::varchar as category3_name
        from ord o join det d on o.id = d.order_id
          and d.create_ts between o.create_ts - {millis} and o.create_ts + {millis}"""


VIEWS["wide5d"] = _wide(5)
VIEWS["wide365d"] = _wide(365)
AGE = "((epoch_ms(timestamp '2024-01-01') - epoch_ms(birthday::timestamp)) // 31536000000)::int"

CHANGES = """
        select 'order_info' as source_table,
          case when o_orderkey % 3 = 0 then 'update' else 'insert' end as type,
          o_orderkey as id, o_custkey as user_id, o_orderstatus as order_status,
          o_totalprice::decimal(18, 2) as total_amount, null as name, null as gender from orders
        union all select 'user_info', 'insert', c_custkey, null, null, null, c_name, c_mktsegment
        from customer"""
VIEWS["change"] = f"select * from ({CHANGES}) where id % 11 > 3"


VIEWS["newest"] = f"""
        select user_id, max(id) as change_id, arg_max(gender, id) as gender from (
          select id, id::varchar as user_id, gender from ({CHANGES})
          where source_table = 'user_info' and id % 11 > 3
          union all select o_orderkey + 1000000000000, o_custkey::varchar, o_orderstatus from orders)
        group by user_id"""


def _stats(measures: str, window_ms: int) -> str:
    text = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S')"
    sums = ", ".join(
        f"sum({m})::bigint as {m}" for m in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
    )
    return f"""
        select {text.format("w")} as stt, {text.format(f"(w + {window_ms})")} as edt,
          vc, ch, ar, is_new, {sums}
        from (select *, (ts // {window_ms}) * {window_ms} as w from {measures})
        group by w, vc, ch, ar, is_new"""


def _with(query: str) -> str:
    """Prefix the views a query needs, in order of definition."""
    words = set(query.replace("(", " ").replace(")", " ").replace(",", " ").split())
    needed: set[str] = set()
    for name in reversed(VIEWS):
        if name in words:
            needed.add(name)
            words |= set(VIEWS[name].replace("(", " ").replace(")", " ").replace(",", " ").split())
    if not needed:
        return query
    if query.lstrip().startswith("with "):  # a query with views of its own
        query = ", " + query.lstrip()[len("with ") :]
    return "with " + ", ".join(f"{n} as ({VIEWS[n]})" for n in VIEWS if n in needed) + " " + query


QUERIES = {
    "log_repair_new_visitor": "select id, mid, ts, is_new from log",
    "log_split_start": """select id, mid, is_new, 'icon' as entry, id % 100 as loading_time, ts
        from log where event_type = 'signup'""",
    "log_split_page": """select id, mid, ar, ch, vc, is_new, page_id, last_page_id, during_time, ts
        from page""",
    "log_split_display": """select id, id::varchar as item, i::varchar as display_order, page_id
        from page cross join (values (0), (1)) t(i) where event_type = 'click' and i < k % 3""",
    "log_quarantine": "select id from damaged where not usable",
    "log_split_damaged": """
        select case when not usable then 'quarantine' when start then 'dwd_start_log'
            else 'dwd_page_log' end as topic, id,
          case when usable then mid end as mid, case when usable then ts end as ts,
          case when usable then is_new end as is_new,
          case when usable and not start then page_id end as page_id, true as filled
        from (select *, event_type as page_id from damaged)
        union all select 'dwd_display_log', id, null, null, null, event_type, true
          from damaged cross join (values (0), (1)) t(i)
          where usable and event_type = 'click' and i < k % 3""",
    "entry_pages": "select id, mid, page_id, ts from page where is_entry",
    "unique_visits": "select id, mid, day, is_new, ts from uv",
    "bounces_10s": "select id, mid, is_new, page_id, ts from jump10s",
    "page_pattern": "select * from outcomes where outcome is not null",
    "bounces_6h": "select id, mid, is_new, page_id, ts from jump6h",
    "page_view_measures": """select ar, ch, vc, is_new, ts, 0::bigint as uv_ct, 1::bigint as pv_ct,
        0::bigint as sv_ct, 0::bigint as uj_ct, during_time as dur_sum from page""",
    "session_measures": """select ar, ch, vc, is_new, ts, 0::bigint as uv_ct, 0::bigint as pv_ct,
        1::bigint as sv_ct, 0::bigint as uj_ct, 0::bigint as dur_sum from page where is_entry""",
    "pv_uv_sv_uj_union": "select * from measures6h",
    "visitor_stats_10s": _stats("measures10s", 10_000),
    "visitor_stats_1d": _stats("measures6h", 86_400_000),
    "order_create_date_hour": """select id, province_id, order_status, user_id, total_amount,
        create_time, create_date, create_hour, create_ts from ord""",
    "order_detail_parse": """select id, order_id, sku_id, order_price, sku_num, sku_name,
        create_time, split_total_amount, create_ts from det""",
    "order_interval_join_5ms": _pairs(5),
    "order_interval_join_5d": _pairs(5 * 86_400_000),
    "order_wide": "select * from wide365d",
    "order_wide_user": f"""select order_id, sku_id, total_amount, user_id, {AGE} as user_age,
        gender as user_gender from (select * exclude (user_age, user_gender) from wide5d) w
        left join user_dim u on u.id = w.user_id::varchar""",
    "order_wide_dims": """select detail_id, order_id, n.n_name as province_name,
          '0' || n.n_regionkey as province_area_code, 'CN-' || n.n_nationkey as province_iso_code,
          'CN-X' || n.n_nationkey as province_3166_2_code, p.p_partkey as spu_id,
          p.p_partkey % 10 as tm_id, p.p_size::bigint as category3_id, p.p_name as spu_name,
          s.s_name as tm_name, c.n_name as category3_name
        from wide365d w
        left join nation n on n.n_nationkey = w.province_id
        left join part p on p.p_partkey = w.sku_id and p.p_partkey % 7 <> 0
        left join supplier s on s.s_suppkey = p.p_partkey % 10
        left join nation c on c.n_nationkey = p.p_size""",
    "user_age": f"""select id, {AGE} as age from (
          select c_custkey::varchar as id,
            strftime(date '1960-01-01' + (c_custkey * 7 % 16000)::int, '%Y-%m-%d') as birthday
          from customer)""",
    "dim_lookup_id": """select o_orderkey, o_custkey, birthday, gender
        from orders left join user_dim on id = o_custkey::varchar""",
    "dim_lookup_cached": """select o_orderkey, o_custkey, birthday, gender
        from orders left join user_dim on id = o_custkey::varchar""",
    "dim_lookup_invalidated": """
        select o_orderkey, o_custkey, birthday, gender from orders left join (
          select c_custkey as key, strftime(date '1960-01-01' + (c_custkey * 7 % 16000)::int, '%Y-%m-%d') as birthday,
            case when c_custkey % 10 = 6 then 'again' when c_custkey % 5 = 1 then 'changed' else c_mktsegment end as gender
          from customer where c_custkey % 5 = 1 or (c_custkey % 5 <> 2 and c_custkey % 10 <> 0)) on key = o_custkey""",
    "dim_latest": "select user_id, change_id, gender from newest",
    "dim_lookup_fresh": """select o_orderkey, o_custkey, gender
        from orders left join newest on user_id = o_custkey::varchar""",
    "dim_lookup_composite": """
        select o_orderkey, nation, segment, c_custkey, c_name
        from (select o_orderkey, (o_custkey % 30)::varchar as nation,
                case o_orderkey % 4 when 0 then 'BUILDING' when 1 then 'MACHINERY'
                  when 2 then 'NONE' else 'FURNITURE' end as segment from orders) o
        left join (select *, row_number() over (
                     partition by c_nationkey, c_mktsegment order by c_custkey) as rn
                   from customer) c
          on c.rn = 1 and c.c_nationkey::varchar = nation and c.c_mktsegment = segment""",
    "order_wide_merge": """
        select coalesce(a.detail_id, b.detail_id) as detail_id,
          case when a.found then a.order_id else b.order_id end as order_id,
          coalesce(a.order_price, b.order_price) as order_price, b.order_status,
          coalesce(a.sku_id, b.sku_id) as sku_id,
          coalesce(a.split_total_amount, b.split_total_amount) as split_total_amount
        from (select detail_id,
                true as found, l_orderkey as order_id,
                case when l_linenumber % 2 = 0
                  then l_extendedprice::decimal(18, 2) end as order_price,
                l_partkey as sku_id,
                case when l_linenumber = 1
                  then l_extendedprice::decimal(18, 2) end as split_total_amount
              from numbered where l_linenumber <> 5) a
        full join (select detail_id,
                l_orderkey + 1 as order_id, l_quantity::decimal(18, 2) as order_price,
                l_linestatus as order_status, l_partkey + 1 as sku_id,
                l_extendedprice::decimal(18, 2) as split_total_amount
              from numbered where l_linenumber <> 3) b
          on a.detail_id = b.detail_id""",
    "order_quarantine": """select 'order' as kind, id from ord where id % 7 in (0, 1, 2)
        union all select 'detail', id from det where id % 7 in (0, 1, 3)""",
    "cdc_quarantine": f"select id from ({CHANGES}) where id % 13 in (0, 1)",
    "cdc_clean": "select source_table, type, id from change",
    "cdc_route": """
        select case when source_table = 'user_info' then 'hbase' else 'kafka' end as sink_type,
          case when source_table = 'user_info' then 'dim_user_info'
               when type = 'insert' then 'dwd_order_info'
               else 'dwd_order_info_update' end as sink_table,
          'id' as sink_pk, id::varchar as record_key, id::varchar as id,
          case when source_table = 'order_info' and type = 'insert'
               then user_id::varchar end as user_id,
          case when source_table = 'order_info' and type = 'insert'
               then total_amount end as total_amount,
          case when type = 'update' then order_status end as order_status,
          null::varchar as name, gender
        from change""",
}

QUERIES |= {
    "stream_log_split": """
        select 'dwd_start_log' as topic, id, is_new from damaged where usable and start
        union all select 'dwd_page_log', id, is_new from damaged where usable and not start
        union all select 'dwd_display_log', id, null
          from damaged cross join (values (0), (1)) t(i)
          where usable and event_type = 'click' and i < k % 3
        union all select 'quarantine', id, null from damaged where not usable""",
    "stream_unique_visits": "select id, mid, is_new, ts from uv",
    "stream_page_pattern": "select * exclude (next_page) from outcomes where outcome is not null",
    "stream_bounces_6h": "select id, mid, is_new, ts from jump6h",
    "stream_late_rows": """
        with pages as (
          select *, coalesce(last_page_id, '') = '' as is_entry, id % 10 = 7 as held_back from raw where event_type <> 'signup'),
        measures as (
          select held_back, ts, vc, ch, ar, is_new, 0::bigint as uv_ct, 1::bigint as pv_ct, is_entry::bigint as sv_ct,
            0::bigint as uj_ct, during_time as dur_sum from pages
          union all select held_back, ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 from pages
          union all select held_back, ts, vc, ch, ar, is_new, 0, 0, 0, 1, 0 from pages)
        select 'late' as kind, null as stt, * exclude (held_back) from measures where held_back
        union all
        select 'sum', strftime(make_timestamp(ts // 86400000 * 86400000000), '%Y-%m-%d %H:%M:%S'), null, vc, ch, ar, is_new,
          sum(uv_ct)::bigint, sum(pv_ct)::bigint, sum(sv_ct)::bigint, sum(uj_ct)::bigint, sum(dur_sum)::bigint
        from measures where not held_back group by 2, vc, ch, ar, is_new""",
    "stream_visitor_stats_1d": _stats("measures6h", 86_400_000),
    "stream_order_wide_user": QUERIES["order_wide_user"],
    "stream_order_wide_dims": f"""
        select detail_id, order_id, {AGE} as user_age, n.n_name as province_name,
          p.p_name as spu_name, s.s_name as tm_name, c.n_name as category3_name
        from (select * exclude (user_age) from wide5d) w
        left join user_dim u on u.id = w.user_id::varchar
        left join nation n on n.n_nationkey = w.province_id
        left join part p on p.p_partkey = w.sku_id and p.p_partkey % 7 <> 0
        left join supplier s on s.s_suppkey = p.p_partkey % 10
        left join nation c on c.n_nationkey = p.p_size""",
    "stream_order_quarantine": QUERIES["order_quarantine"],
    "stream_cdc_quarantine": QUERIES["cdc_quarantine"],
    "stream_table_source": """
        select case when id % 7 <> 2 then id end as id, user_id, total_amount, order_status, null::bigint as record
        from ord where id % 7 not in (0, 4, 5)
        union all select null, null, null, null, id from ord where id % 7 in (0, 4, 5)""",
    "stream_dim_upsert": QUERIES["dim_latest"],
    "stream_cdc_route": """
        select case when source_table = 'user_info' then 'dim_user_info'
               when type = 'insert' then 'dwd_order_info'
               else 'dwd_order_info_update' end as sink_table, id
        from change""",
}

QUERIES["stream_dedup_on_read"] = QUERIES["stream_log_split"]

ORACLE: dict[str, str] = {name: _with(query) for name, query in QUERIES.items()}
