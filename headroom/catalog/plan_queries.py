"""Whole jobs: sizing, procurement, realised check, report."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from headroom.catalog import sizing_queries as sq
from headroom.catalog import views as v
from headroom.catalog.combine_queries import BRIDGE
from headroom.catalog.exceedance_queries import _NEWEST, CASCADE, KEYS
from headroom.catalog.series_queries import SLICES
from headroom.catalog.views import oracle
from headroom.scale import literal_table
from headroom.operators import areas as a
from headroom.operators.series import resample_mean, time_slices
from headroom.plans import procurement as pr
from headroom.plans import realised as rl
from headroom.plans import sizing as sz

PERIOD = (datetime(2024, 1, 4), datetime(2024, 1, 29))
TREE = {"SUBTRACT": [{"ADD": [{"product": "SA_mFRR", "kind": "volume"}, {"product": "DA_mFRR"}, {"product": "aFRR", "kind": "volume"}]}, {"kind": "procured"}]}
CAPACITY = {"ATC_SUBTRACT": [{"contract": "DA"}, {"contract": "ID"}]}
SPACINGS = [(95, 100, 0.5)]


def sizing_percentiles(spark, sf):
    means = resample_mean(v.imbalance(spark, sf), "PT15M", "quantity", "region")
    filled = sz.control_errors(means, period=(datetime(2024, 1, 2), datetime(2024, 1, 30)))
    return sz.sizing_percentiles(filled, [-99.5, 99.5]).withColumn("value", F.round("value", 6))


def control_error_limits(spark, sf):
    found = sz.control_error_limits(v.imbalance(spark, sf), sq.LEVELS, [-90, 90])
    names = ("down", "up", "down_percent", "up_percent", "share", "excess")
    return found.withColumns({n: F.round(n, 6) for n in names})


def _slices(spark):
    return time_slices(spark, datetime(2024, 2, 1) - timedelta(hours=1), datetime(2024, 2, 2) - timedelta(hours=1), 6, zone="CET")


def _out(df, *by):
    return df.select("position", "valid_from", *by, "spacing_step", "percentage_level", F.round("value", 6).alias("value"))


def bid_forecast(spark, sf):
    return _out(pr.bid_forecast(v.bids(spark, sf), PERIOD, _slices(spark), TREE, SPACINGS), "area", "product", "direction")


def capacity_forecast(spark, sf):
    return _out(pr.capacity_forecast(v.capacity(spark, sf), PERIOD, _slices(spark), CAPACITY, SPACINGS), "out_area", "in_area")


def limited_bids(spark, sf):
    bids = pr.bid_forecast(v.bids(spark, sf), PERIOD, _slices(spark), TREE, SPACINGS)
    capacity = pr.capacity_forecast(v.capacity(spark, sf), PERIOD, _slices(spark), CAPACITY, SPACINGS)
    return _out(pr.limited_bids(bids, capacity, a.correction_keys(spark, BRIDGE)), "area", "product", "direction")


def realised_check(spark, sf):
    proposed = v.proposed(spark, sf).withColumn("value", F.col("value") / 8)
    receivers = literal_table(spark, [(0,), (1,), (2,)], "receiver int")
    return rl.realised_check(proposed, v.realised(spark, sf), receivers, KEYS, tie="value").select("receiver", *KEYS, "level", "value")


REPORT_BRIDGE = [("A", "F", "A", "N"), ("A", "F", "N", "R"), ("N", "O", "N", "R"), ("R", "F", "R", "N"), ("R", "F", "N", "A")]


def _flows(spark, sf, factor):
    """Border capacity per level from line items: flag pairs as borders."""
    lines = v.table(spark, sf, "lineitem")
    to = F.expr("case when l_returnflag = 'N' then case when l_partkey % 2 = 0 then 'R' else 'A' end else 'N' end")
    return lines.groupBy(F.col("l_returnflag").alias("out_area"), to.alias("in_area"), (100 - F.col("l_linenumber")).alias("level")).agg(
        F.round(F.avg("l_extendedprice") / factor, 4).alias("value")
    )


def quarterly_report(spark, sf):
    realised = v.realised(spark, sf).withColumnRenamed("sender", "operator")
    flows = (_flows(spark, sf, 1000), _flows(spark, sf, 2000))
    report = rl.quarterly_report(v.proposed(spark, sf), realised, flows, a.correction_keys(spark, REPORT_BRIDGE), KEYS)
    return report.select(*KEYS, "level", "operator", "realised", "proposed")


QUERIES = {f.__name__: f for f in (
    sizing_percentiles, control_error_limits, bid_forecast, capacity_forecast, limited_bids, realised_check, quarterly_report,
)}


def _leaf(name: str, condition: str) -> str:
    """A leaf of the bid tree: one bid per exclusive group, pivot, as-of grid of the table's own times."""
    return f""" {name}_d as (select *, row_number() over (partition by exclusive_id order by quantity desc, id) rn from win where {condition}),
 {name}_p as (select valid_from, area, replace(replace(product,'SA_',''),'DA_','') product, direction, sum(quantity) q from {name}_d where rn=1 or exclusive_id is null group by all),
 {name}_t as (select distinct valid_from t from {name}_p), {name}_g as (select unnest(generate_series(min(t), max(t), interval 15 minutes)) g from {name}_t),
 {name} as (select g valid_from, area, product, direction, q from {name}_g asof join {name}_t on g >= t join {name}_p on {name}_p.valid_from = t)"""


_BIDS = """, win as (select * from bids where valid_from >= timestamp '2024-01-03' and valid_from < timestamp '2024-01-29'),
""" + ",\n".join([_leaf("sa", "product='SA_mFRR' and kind='volume'"), _leaf("da", "product='DA_mFRR'"), _leaf("af", "product='aFRR' and kind='volume'"), _leaf("pr", "kind='procured'")]) + """,
 adds as (select valid_from, area, product, direction, sum(q) q from (from sa union all from da union all from af)
  where valid_from in (select valid_from from sa) and valid_from in (select valid_from from da) and valid_from in (select valid_from from af) group by all),
 ka as (select distinct area, product, direction from adds), kp as (select distinct area, product, direction from pr),
 net as (select valid_from, area, product, direction, case when (area,product,direction) in (from ka) and (area,product,direction) in (from kp) then adds.q-pr.q else coalesce(adds.q,pr.q) end v
  from adds full join pr using (valid_from, area, product, direction) where valid_from in (select valid_from from adds) and valid_from in (select valid_from from pr)),
 cut as (select *, least(max(valid_from) over () + interval 15 minutes, timestamp '2024-01-29') fin from net where valid_from between timestamp '2024-01-04' and timestamp '2024-01-29'),
 wtd as (select *, case when valid_from >= fin - interval 10 days then 2 else 1 end w from cut),
 tag as (select sl.*, area, product, direction, v, w from wtd join slice sl on strftime(timezone('CET', timezone('UTC', valid_from)),'%H:%M:%S') between start_time and end_time
  where v is not null),
 rep as (select * from tag union all select * from tag where w=2),
 rnk as (select *, row_number() over (partition by "position",area,product,direction order by v)-1 rn, count(*) over (partition by "position",area,product,direction) n from rep),
 tk as (select unnest(generate_series(0,500,50)) tick),
 bq as (select "position", area, product, direction, round(100-tick/100,2)::double lv, greatest(v,0.0) v from rnk join tk on rn=(tick*(n-1))//10000)"""


def _border(name: str, contract: str) -> str:
    return f""" {name}_f as (select *, max("position") over (partition by valid_from,out_area,in_area,quantity) mp from cwin where contract='{contract}'),
 {name}_p as (select valid_from, out_area, in_area, sum(quantity) q from {name}_f where "position"=mp group by all),
 {name}_t as (select distinct valid_from t from {name}_p), {name}_g as (select unnest(generate_series(min(t), max(t), interval 15 minutes)) g from {name}_t),
 {name}_b as (select distinct out_area, in_area from {name}_p),
 {name}_a as (select g valid_from, t from {name}_g asof join {name}_t on g >= t),
 {name} as (select a.valid_from, b.out_area, b.in_area, last_value(q ignore nulls) over (partition by b.out_area, b.in_area order by a.valid_from rows unbounded preceding) q
  from {name}_a a cross join {name}_b b left join {name}_p p on p.valid_from=a.t and p.out_area=b.out_area and p.in_area=b.in_area)"""


_CAPACITY = """, cwin as (select * from capacity where valid_from >= timestamp '2023-12-05' and valid_from < timestamp '2024-01-29'),
""" + ",\n".join([_border("dd", "DA"), _border("ii", "ID")]) + """,
 cnet as (select dd.valid_from, dd.out_area, dd.in_area, dd.q-m.q+o.q v from dd join ii m using (valid_from,out_area,in_area)
  join ii o on o.valid_from=dd.valid_from and o.out_area=dd.in_area and o.in_area=dd.out_area where dd.q-m.q+o.q is not null),
 ccut as (select *, least(max(valid_from) over () + interval 15 minutes, timestamp '2024-01-29') fin from cnet where valid_from between timestamp '2024-01-04' and timestamp '2024-01-29'),
 ctag as (select sl.*, out_area, in_area, v, case when valid_from >= fin - interval 10 days then 2 else 1 end w from ccut
  join slice sl on strftime(timezone('CET', timezone('UTC', valid_from)),'%H:%M:%S') between start_time and end_time),
 crep as (select * from ctag union all select * from ctag where w=2),
 crnk as (select *, row_number() over (partition by "position",out_area,in_area order by v)-1 rn, count(*) over (partition by "position",out_area,in_area) n from crep),
 ctk as (select unnest(generate_series(0,500,50)) tick),
 cq as (select "position", out_area, in_area, round(100-tick/100,2)::double lv, greatest(v,0.0) v from crnk join ctk on rn=(tick*(n-1))//10000)"""

_HEAD = """"position", timestamp '2024-01-31 23:00:00' + ("position"-1)*interval 4 hours valid_from, 0.5::double spacing_step, lv percentage_level"""

_LIMITS = ", " + sq._grid_sql("g", 20) + ", " + sq._grid_sql("h", 40) + """,
 u as (select *, 'Level 1' "level", 30 a from g union all select *, 'Level 2', 5 from h),
 best as (select *, row_number() over (partition by region, "level" order by round(abs("off"-a),9), "percent") rn from u),
 pairs as (select region, 'Deterministic' label, quantile_cont(quantity,0.1) down, quantile_cont(quantity,0.9) up from imbalance group by 1
  union all select region, "level" || ' bounds', lower, upper from best where rn=1),
 tg("level", target, allowed) as (values ('Level 1', 20.0::double, 30.0::double), ('Level 2', 40.0::double, 5.0::double)),
 res as (select p.region, label, down, up, "level", target, allowed,
  case when down<=0 and up>=0 then (100.0*count(*) filter (quantity < down-target))/count(quantity) end dp,
  case when down<=0 and up>=0 then (100.0*count(*) filter (quantity > up+target))/count(quantity) end upp
  from pairs p cross join tg join imbalance m on m.region=p.region group by p.region, label, down, up, "level", target, allowed),
 ok as (select *, coalesce(round(dp+upp,9)<=allowed,false) passed from res),
 vd as (select region, label, count(*) filter (passed) k, min(case when passed then "level" end) one from ok group by 1,2),
 sh as (select region, "level", 100.0*count(*) filter (abs(quantity)>target)/count(*) share from imbalance, tg group by all)
select region, label, round(down,6) down, round(up,6) up, "level", target, round(dp,6)::double down_percent, round(upp,6)::double up_percent, round(share,6)::double share,
 case k when 0 then 'none of the levels' when 2 then 'both of the levels' else one end verdict, allowed, round(dp+upp,6)::double excess, passed
from ok join vd using (region,label) join sh using (region,"level")"""


def _flow_sql(name: str, factor: int) -> str:
    return f""" {name}_c as (select l_returnflag out_area, case when l_returnflag='N' then case when l_partkey%2=0 then 'R' else 'A' end else 'N' end in_area, 100-l_linenumber "level",
  round(avg(l_extendedprice)/{factor},4) v from lineitem group by all),
 {name} as (select area, direction, "level", min(v) lim from {name}_c join k using (out_area,in_area) group by all)"""


ORACLE = {
    "sizing_percentiles": oracle("imbalance", """, gr as (select region, g valid_from from (select unnest(generate_series(min(valid_from), max(valid_from), interval 15 minutes)) g from imbalance), (select distinct region from imbalance)),
 f as (select gr.region, gr.valid_from, last_value(quantity ignore nulls) over (partition by gr.region order by gr.valid_from rows unbounded preceding) q
  from gr left join imbalance i on i.region=gr.region and i.valid_from=gr.valid_from),
 p as (select region, unnest([0.005,0.995]::double[]) probability, unnest(quantile_cont(q,[0.005,0.995])) x from f where valid_from between timestamp '2024-01-02' and timestamp '2024-01-30' group by 1)
select region, probability, round(x,6) "value", case when probability<0.5 then '99.5% for -' else '99.5% for +' end percentile from p"""),
    "control_error_limits": oracle("imbalance", _LIMITS),
    "bid_forecast": oracle("bids", SLICES + _BIDS + f""" select {_HEAD}, area, product, direction, round(v,6) "value" from bq"""),
    "capacity_forecast": oracle("capacity", SLICES + _CAPACITY + f""" select {_HEAD}, out_area, in_area, round(v,6) "value" from cq"""),
    "limited_bids": oracle("bids capacity", SLICES + _BIDS + _CAPACITY + """,
 k(area, direction, out_area, in_area) as (values """ + ",".join(str(r) for r in BRIDGE) + f"""),
 lim as (select "position", lv, area, direction, min(v) m from cq join k using (out_area,in_area) group by all)
select {_HEAD}, area, product, direction, round(least(v, m),6) "value" from bq left join lim using ("position", lv, area, direction)"""),
    "realised_check": oracle("proposed realised", CASCADE + """
select area, direction, "level", sender receiver, round(realised/used*al,1) "value" from t where zr>zp and abs(realised/used*al-realised)>1e-9"""),
    "quarterly_report": oracle("proposed realised", _NEWEST + """,
 k(area, direction, out_area, in_area) as (values """ + ",".join(str(r) for r in REPORT_BRIDGE) + "),\n" + _flow_sql("lp", 1000) + ",\n" + _flow_sql("lr", 2000) + """
select r.area, r.direction, r."level", r.sender operator, least(r."value", lr.lim) realised, least(p."value", lp.lim) proposed from realised r
 left join pl p on p.area=r.area and p.direction=r.direction and p."level"=r."level"
 left join lr on lr.area=r.area and lr.direction=r.direction and lr."level"=r."level"
 left join lp on lp.area=r.area and lp.direction=r.direction and lp."level"=r."level\""""),
}
