"""Queries over the star schema and the events: joins, aggregates, windows, sets; and streams of them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.operators import relational as R
from lathework.sources.tables import table
from lathework.streaming import streams as S


def t(name):
    return lambda s, d: table(s, d, name)


lineitem, orders, customer, nation, region, part, supplier, events = (t(n) for n in "lineitem orders customer nation region part supplier events".split())


def revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def q1(s, d):
    g = lineitem(s, d).where("l_shipdate <= timestamp '1998-09-02'").groupBy("l_returnflag", "l_linestatus")
    return g.agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(revenue()), 2).alias("sum_disc_price"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"), F.count("*").alias("n")
    )


def q3(s, d):
    j = customer(s, d).where("c_mktsegment = 'BUILDING'").join(orders(s, d), F.expr("c_custkey = o_custkey")).join(lineitem(s, d), F.expr("o_orderkey = l_orderkey"))
    return j.groupBy("o_orderkey", "o_orderdate").agg(F.round(F.sum(revenue()), 2).alias("revenue")).orderBy(F.desc("revenue"), "o_orderkey").limit(10)


def q5(s, d):
    # small dimensions first; Spark broadcasts those that its size estimate allows
    n = nation(s, d).join(region(s, d), F.expr("n_regionkey = r_regionkey"))
    c = customer(s, d).join(n, F.expr("c_nationkey = n_nationkey"))
    j = lineitem(s, d).join(orders(s, d), F.expr("l_orderkey = o_orderkey")).join(c, F.expr("o_custkey = c_custkey")).join(supplier(s, d), F.expr("l_suppkey = s_suppkey and c_nationkey = s_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(revenue()), 2).alias("revenue"))


def q6(s, d):
    return lineitem(s, d).where("l_discount between 0.05 and 0.07 and l_quantity < 24").agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"))


def rollup(s, d):
    j = orders(s, d).join(customer(s, d), F.expr("o_custkey = c_custkey"))
    return j.rollup("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def cube(s, d):
    return lineitem(s, d).cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("gid"))


def outer(s, d):
    o = orders(s, d).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    e = events(s, d).groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("events"))
    return o.join(e, "k", "full_outer")


def windows(s, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return orders(s, d).select(
        "o_orderkey", F.rank().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"))).alias("price_rank"), F.round(F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("running"),
        F.lag("o_orderkey").over(w).alias("previous"), F.ntile(4).over(w).alias("quarter"),
    )


def asof(s, d):
    e = events(s, d)
    buy = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return R.as_of(buy, e.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click")), "user_id", "ts", ["click"], "event_id").select("event_id", "asof_click")


def in_range(s, d):
    sizes = s.range(0, 50, 7).select(F.col("id").cast("double").alias("lo"), (F.col("id") + 7).cast("double").alias("hi"))
    return R.range_join(lineitem(s, d).select("l_orderkey", "l_linenumber", "l_quantity"), F.col("l_quantity"), sizes, F.col("lo"), F.col("hi"), 7.0).groupBy("lo", "hi").agg(F.count("*").alias("n"))


def pivot(s, d):
    return events(s, d).groupBy("user_id").pivot("event_type", ["click", "purchase", "view"]).agg(F.count("event_id"))


def props(s, d):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    return events(s, d).select(k.alias("k")).groupBy("k").agg(F.count("*").alias("n"))


def sets(s, d):
    a, b = orders(s, d).select(F.col("o_custkey").alias("k")), customer(s, d).where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    return a.intersect(b).withColumn("kind", F.lit("both")).union(b.subtract(a).withColumn("kind", F.lit("without orders"))).groupBy("kind").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


def stream_first(s, d):
    return S.drain(S.first_seen(S.table_stream(s, d, "events").select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "4000 days"), name="first").select("user_id", "event_type")


def stream_counts(s, d):
    return S.drain(S.windowed_counts(S.table_stream(s, d, "events"), "ts", ["event_type"], "1 day"), "complete", "counts")


def stream_hops(s, d):
    return S.drain(S.windowed_counts(S.table_stream(s, d, "events"), "ts", [], "2 hours", "1 hour"), "complete", "hops")


def stream_profiles(s, d):
    got = S.drain(S.profiles(S.table_stream(s, d, "events"), "user_id", "value", "event_type", "ts"), "update", "profiles", ("user",))
    return got.select("user", "n", F.round("smoothed", 4).alias("smoothed"))


def stream_pairs(s, d):
    a = S.table_stream(s, d, "events").where("event_type = 'signup'")
    b = S.table_stream(s, d, "events").where("event_type = 'signup'")
    return S.drain(S.corroborated(a, b, "user_id", "event_id", "ts", 96), name="pairs")


QUERIES = {
    "tpch_q1": (q1, "select l_returnflag, l_linestatus, round(sum(l_quantity), 2) sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) sum_disc_price, round(avg(l_extendedprice), 4) avg_price, count(*) n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2"),
    "tpch_q3": (q3, "select o_orderkey, o_orderdate, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue from customer join orders on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey where c_mktsegment = 'BUILDING' group by 1, 2 order by revenue desc, o_orderkey limit 10"),
    "tpch_q5": (q5, "select n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey and s_nationkey = c_nationkey join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by 1"),
    "tpch_q6": (q6, "select round(sum(l_extendedprice * l_discount), 2) revenue from lineitem where l_discount between 0.05::DOUBLE and 0.07::DOUBLE and l_quantity < 24"),
    "rollup_orders": (rollup, "select c_mktsegment, o_orderpriority, count(*) n, round(sum(o_totalprice), 2) total from orders join customer on o_custkey = c_custkey group by rollup (c_mktsegment, o_orderpriority)"),
    "cube_lineitem": (cube, "select l_returnflag, l_linestatus, count(*) n, (grouping(l_returnflag) * 2 + grouping(l_linestatus))::INT gid from lineitem group by cube (l_returnflag, l_linestatus)"),
    "semi_join": (lambda s, d: customer(s, d).join(orders(s, d), F.expr("c_custkey = o_custkey"), "left_semi").select("c_custkey"), "select c_custkey from customer where c_custkey in (select o_custkey from orders)"),
    "anti_join": (lambda s, d: customer(s, d).join(orders(s, d), F.expr("c_custkey = o_custkey"), "left_anti").select("c_custkey"), "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null)"),
    "full_outer": (outer, "select coalesce(o.k, e.k) k, orders, events from (select o_custkey k, count(*) orders from orders group by 1) o full join (select user_id k, count(*) events from events group by 1) e on o.k = e.k"),
    "window_frames": (windows, "select o_orderkey, (rank() over (partition by o_custkey order by o_totalprice desc))::INT price_rank, round(sum(o_totalprice) over (w rows unbounded preceding), 2) running, lag(o_orderkey) over w previous, (ntile(4) over w)::INT \"quarter\" from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)"),
    "asof_join": (asof, "with b as (select event_id, user_id, ts from events where event_type = 'purchase'), c as (select user_id, ts, max(event_id) click from events where event_type = 'click' group by 1, 2) select b.event_id, c.click asof_click from b asof left join c on b.user_id = c.user_id and b.ts >= c.ts"),
    "range_join": (in_range, "select lo, hi, count(*) n from (select i::DOUBLE lo, (i + 7)::DOUBLE hi from range(0, 50, 7) r(i)) join lineitem on l_quantity >= lo and l_quantity < hi group by 1, 2"),
    "pivot_events": (pivot, "select user_id, nullif(count(*) filter (where event_type = 'click'), 0) click, nullif(count(*) filter (where event_type = 'purchase'), 0) purchase, nullif(count(*) filter (where event_type = 'view'), 0) \"view\" from events group by 1"),
    "json_props": (props, "select try_cast(json_extract_string(props, '$.k') as int) k, count(*) n from events group by 1"),
    "set_operations": (sets, "with a as (select distinct o_custkey k from orders), b as (select distinct c_custkey k from customer where c_acctbal > 0) select 'both' kind, count(*) n, sum(k)::BIGINT total from a join b using (k) union all select 'without orders', count(*), sum(k)::BIGINT from b where k not in (select k from a) having count(*) > 0"),
    "sessions": (lambda s, d: S.sessions(events(s, d), "ts", ["user_id"], "30 minutes"), "with r as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end c from events), g as (select *, sum(c) over (partition by user_id order by ts rows unbounded preceding) i from r) select user_id, min(ts) \"start\", max(ts) + interval 30 minute \"end\", count(*) n from g group by user_id, i"),
    "tumbling": (lambda s, d: events(s, d).groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "n", "total"), "select time_bucket(interval 1 hour, ts) \"start\", count(*) n, round(sum(value), 4) total from events group by 1"),
    "stream_first_seen": (stream_first, "select distinct user_id, event_type from events"),
    "stream_daily_counts": (stream_counts, "select date_trunc('day', ts) \"start\", date_trunc('day', ts) + interval 1 day \"end\", event_type, count(*) n from events group by 1, 2, 3"),
    "stream_hopping": (stream_hops, "select s \"start\", s + interval 2 hour \"end\", count(*) n from (select unnest([time_bucket(interval 1 hour, ts), time_bucket(interval 1 hour, ts) - interval 1 hour]) s from events) group by 1"),
    "stream_profiles": (stream_profiles, "with r as (select user_id u, value, row_number() over (partition by user_id order by ts, value) i, count(value) over (partition by user_id) nv, count(*) over (partition by user_id) n, count(value) over (partition by user_id order by ts, value rows unbounded preceding) j from events) select u \"user\", any_value(n) n, round(coalesce(sum(value * power(0.5::DOUBLE, nv - j + 1)), 0), 4) smoothed from r group by 1"),
    "stream_band_join": (stream_pairs, "select a.event_id a, b.event_id b, a.user_id \"key\" from events a join events b on a.user_id = b.user_id and a.event_id < b.event_id and abs(epoch(a.ts) - epoch(b.ts)) <= 345600 where a.event_type = 'signup' and b.event_type = 'signup'"),
}
