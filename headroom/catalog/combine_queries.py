"""Combining tables, capacity, areas, triples."""

from __future__ import annotations

from pyspark.sql import functions as F

from headroom.catalog import views as v
from headroom.catalog.views import oracle
from headroom.operators import areas as a
from headroom.operators import capacity as cap
from headroom.operators import columns as c
from headroom.operators import combine as cb
from headroom.operators import triples as tr
from headroom.operators.filters import pick_group_argmax
from headroom.operators.quantiles import quantile_lower

BY = ["area", "product", "direction"]
BORDER = ["out_area", "in_area"]
BRIDGE = [
    ("North", "UP", "North", "Mid"), ("North", "UP", "Mid", "South"), ("North", "DOWN", "South", "Mid"), ("North", "DOWN", "Mid", "North"),
    ("Mid", "UP", "Mid", "North"), ("Mid", "UP", "Mid", "South"), ("Mid", "DOWN", "North", "Mid"), ("Mid", "DOWN", "South", "Mid"),
    ("South", "UP", "South", "Mid"), ("South", "UP", "Mid", "North"), ("South", "DOWN", "North", "Mid"), ("South", "DOWN", "Mid", "South"),
]


def _kinds(spark, sf, *names):
    bids = c.replace_values(v.bids(spark, sf), {"product": {"SA_mFRR": "mFRR"}})
    by = ["area", "direction"]
    return [cb.pivot_products(bids.where(F.col("product") == n), "quantity", by) for n in names], by


def _combined(function):
    def query(spark, sf):
        tables, by = _kinds(spark, sf, "mFRR", "DA_mFRR")
        return function(tables, by).withColumn("value", F.round("value", 6))

    return query


def combine_subtract(spark, sf):
    bids = v.bids(spark, sf)
    parts = [cb.pivot_products(bids.where(F.col("kind") == k), "quantity", ["area", "product"]) for k in ("volume", "procured")]
    return cb.combine_subtract(parts, ["area", "product"]).withColumn("value", F.round("value", 6))


TREE = {"SUBTRACT": [{"ADD": [{"product": "SA_mFRR", "kind": "volume"}, {"product": "DA_mFRR"}]}, {"kind": "procured"}]}
STEP_TREE = {"SUBTRACT": [{"ADD": [{"type": "1-URGENT"}, {"type": "2-HIGH"}]}, {"type": "3-MEDIUM"}]}


def combine_tree(spark, sf):
    """Curves given as daily steps, one kind of them as steps of two days: filled, summed per area, aligned to a day, combined."""
    two_days = F.col("type") == "2-HIGH"
    rows = v.steps(spark, sf).withColumn("area", F.concat(F.lit("a"), (F.col("series_id") % 3).cast("string")))
    slow = {
        "series_to": F.expr("series_from + interval 14 days"), "resolution": F.lit("P2D"),
        "valid_from": F.expr("series_from + (position-1)*interval 2 days"), "valid_to": F.expr("series_from + position*interval 2 days"),
    }
    rows = rows.withColumns({name: F.when(two_days, column).otherwise(F.col(name)) for name, column in slow.items()})
    result = cb.combine_tree(rows, STEP_TREE, "area", "quantity", steps={"types": ["series_id", "type", "area"]})
    return result.withColumn("value", F.round("value", 6))


def combine_tree_thinned(spark, sf):
    """Bids of one step: one bid per exclusive group and leaf, products renamed to one."""
    rename = {"product": {"SA_mFRR": "all", "DA_mFRR": "all", "aFRR": "all"}}
    def one_per_group(rows, keys):
        return pick_group_argmax(rows, ["exclusive_id", *keys], "quantity", tie="id")

    result = cb.combine_tree(v.bids(spark, sf), TREE, ["area", "product"], "quantity", replace=rename, prepare=one_per_group, align=False)
    return result.withColumn("value", F.round("value", 6))


def _border(spark, sf, contract):
    return cb.pivot_products(v.capacity(spark, sf).where(F.col("contract") == contract), "quantity", BORDER)


def net_border_capacity(spark, sf):
    """Two borders in both directions; one leads south and another comes from the east only."""
    east = F.when(F.col("out_area") == "South", "East").otherwise(F.col("out_area"))
    tables = [_border(spark, sf, contract).withColumn("out_area", east) for contract in ("DA", "ID")]
    return cap.net_border_capacity(tables).withColumn("value", F.round("value", 6))


def limit_bids_by_capacity(spark, sf):
    ticks = list(range(0, 501, 100))
    bids = quantile_lower(v.bids(spark, sf), "quantity", ticks, BY).drop("tick")
    capacity = quantile_lower(v.capacity(spark, sf).withColumn("quantity", F.col("quantity") * 0.8), "quantity", ticks, BORDER).drop("tick")
    return cap.limit_bids_by_capacity(bids, capacity, a.correction_keys(spark, BRIDGE)).withColumn("value", F.round("value", 6))


def compare_capacity_sources(spark, sf):
    keys = ["valid_from", *BORDER]
    return cap.compare_capacity_sources({"da": _border(spark, sf, "DA"), "id": _border(spark, sf, "ID")}, keys).withColumns(
        {n: F.round(n, 6) for n in ("da", "id", "lowest")}
    )


def pivot_products(spark, sf):
    bids = v.bids(spark, sf).withColumn("quantity", F.when(F.col("quantity") < 80, F.col("quantity")))
    total = cb.pivot_products(bids, "quantity", BY, how="sum").withColumn("how", F.lit("sum"))
    mean = cb.pivot_products(bids, "quantity", BY, how="mean").withColumn("how", F.lit("mean"))
    return total.unionByName(mean).withColumn("value", F.round("value", 6))


def areas_by_name(spark, sf):
    return a.areas_by_name(v.areas(spark, sf), v.table(spark, sf, "customer").selectExpr("concat('NATION_', c_nationkey * 2) name"))


def border_pairs(spark, sf):
    areas = v.areas(spark, sf).select("name", "code")
    return a.border_pairs(areas, [("nation_1", "NATION_2"), ("Nation_2", "nation_3"), ("nation_9", "nowhere")], "code")


def triples_roots(spark, sf):
    return tr.triples_roots(v.triples(spark, sf))


def triples_to_table(spark, sf):
    return tr.triples_to_table(v.triples(spark, sf), "Series", columns=["Type", "status", "segment", "Document_ID"])


QUERIES = {
    "combine_add": _combined(cb.combine_add), "combine_subtract": combine_subtract, "combine_min": _combined(cb.combine_min),
    "combine_max": _combined(cb.combine_max),
    **{q.__name__: q for q in (
        combine_tree, combine_tree_thinned, net_border_capacity, limit_bids_by_capacity, compare_capacity_sources, pivot_products, areas_by_name, border_pairs,
        triples_roots, triples_to_table,
    )},
}


def _pair(expression: str) -> str:
    return oracle("bids", f""", a as (select valid_from, valid_to, area, direction, sum(quantity) q from bids where product='SA_mFRR' group by all),
 b as (select valid_from, valid_to, area, direction, sum(quantity) q from bids where product='DA_mFRR' group by all),
 t as (select distinct valid_from from a intersect select distinct valid_from from b)
select valid_from, valid_to, area, direction, round({expression},6) "value" from a full join b using (valid_from, valid_to, area, direction) where valid_from in (from t)""")


_LEVELS = """, p as (select unnest(generate_series(0,500,100)) tick)"""

ORACLE = {
    "combine_add": _pair("coalesce(a.q+b.q, a.q, b.q)"),
    "combine_min": _pair("least(a.q, b.q)"),
    "combine_max": _pair("greatest(a.q, b.q)"),
    "combine_subtract": oracle("bids", """, a as (select valid_from, valid_to, area, product, sum(quantity) q from bids where kind='volume' group by all),
 b as (select valid_from, valid_to, area, product, sum(quantity) q from bids where kind='procured' group by all),
 t as (select distinct valid_from from a intersect select distinct valid_from from b),
 pa as (select distinct area, product from a), pb as (select distinct area, product from b)
select valid_from, valid_to, area, product, round(case when (area,product) in (from pa) and (area,product) in (from pb) then a.q-b.q else coalesce(a.q,b.q) end,6) "value"
from a full join b using (valid_from, valid_to, area, product) where valid_from in (from t)"""),
    "combine_tree": oracle("steps", """, s as (select *, 'a' || (series_id%3) area, case when "type"='2-HIGH' then 2 else 1 end w from steps where "type" in ('1-URGENT','2-HIGH','3-MEDIUM')),
 p as (select distinct series_id, "type", area, w, series_from from s),
 g as (select *, unnest(generate_series(series_from, series_from + to_days(6*w), to_days(w))) valid_from from p),
 f as (select g."type", g.area, g.valid_from, last_value(quantity ignore nulls) over (partition by g.series_id order by g.valid_from rows unbounded preceding) q
  from g left join s on s.series_id=g.series_id and s.series_from + to_days(cast((s."position"-1)*s.w as int)) = g.valid_from),
 cells as (select "type", area, valid_from, coalesce(sum(q),0) q from f group by all), t as (select distinct "type", valid_from t from cells),
 r as (select "type", min(t) lo, max(t) + to_days(case when "type"='2-HIGH' then 1 else 0 end) hi from t group by 1),
 gx as (select "type", unnest(generate_series(lo, hi, interval 1 day)) d from r),
 e as (select gx."type", d, t from gx asof join t on gx."type"=t."type" and gx.d >= t.t),
 al as (select e."type", e.d valid_from, c.area, c.q from e join cells c on c."type"=e."type" and c.valid_from=e.t),
 a as (from al where "type"='1-URGENT'), b as (from al where "type"='2-HIGH'), c as (from al where "type"='3-MEDIUM'),
 ab as (select valid_from, area, coalesce(a.q+b.q,a.q,b.q) q from a full join b using (valid_from,area) where valid_from in (select valid_from from a) and valid_from in (select valid_from from b))
select valid_from, valid_from + interval 1 day valid_to, area, round(ab.q-c.q,6) "value" from ab full join c using (valid_from,area)
where valid_from in (select valid_from from ab) and valid_from in (select valid_from from c)"""),
    "combine_tree_thinned": oracle("bids", """, x as (select * from bids where exclusive_id is null),
 l1 as (select valid_from, valid_to, area, quantity from (select *, row_number() over (partition by exclusive_id order by quantity desc, id) rn from bids where product='SA_mFRR' and kind='volume') where rn=1 or exclusive_id is null),
 l2 as (select valid_from, valid_to, area, quantity from (select *, row_number() over (partition by exclusive_id order by quantity desc, id) rn from bids where product='DA_mFRR') where rn=1 or exclusive_id is null),
 l3 as (select valid_from, valid_to, area, quantity from (select *, row_number() over (partition by exclusive_id order by quantity desc, id) rn from bids where kind='procured') where rn=1 or exclusive_id is null),
 a as (select valid_from, valid_to, area, sum(quantity) q from l1 group by all), b as (select valid_from, valid_to, area, sum(quantity) q from l2 group by all),
 c as (select valid_from, valid_to, area, sum(quantity) q from l3 group by all),
 ab as (select valid_from, valid_to, area, coalesce(a.q+b.q,a.q,b.q) q from a full join b using (valid_from,valid_to,area) where valid_from in (select valid_from from a) and valid_from in (select valid_from from b))
select valid_from, valid_to, area, 'all' product, round(ab.q-c.q,6) "value" from ab full join c using (valid_from,valid_to,area)
where valid_from in (select valid_from from ab) and valid_from in (select valid_from from c)"""),
    "net_border_capacity": oracle("capacity", """, k as (select valid_from, case out_area when 'South' then 'East' else out_area end out_area, in_area, contract, sum(quantity) q from capacity group by all),
 tb as (select distinct contract, out_area, in_area from k), tt as (select distinct contract, valid_from from k),
 f as (select contract, valid_from, out_area, in_area, last_value(q ignore nulls) over (partition by contract, out_area, in_area order by valid_from rows unbounded preceding) q
  from tt join tb using (contract) left join k using (contract, valid_from, out_area, in_area)),
 d as (from f where contract='DA'), i as (from f where contract='ID'), two as (select distinct in_area out_area, out_area in_area from d)
select d.valid_from, d.valid_from + interval 15 minutes valid_to, d.out_area, d.in_area, round(d.q-i.q+case when (d.out_area,d.in_area) in (select (out_area,in_area) from two) then o.q else i.q end,6) "value"
from d join i using (valid_from,out_area,in_area) left join i o on o.valid_from=d.valid_from and o.out_area=d.in_area and o.in_area=d.out_area where "value" is not null"""),
    "limit_bids_by_capacity": oracle("bids capacity", _LEVELS + """,
 rb as (select area, product, direction, quantity, row_number() over w-1 rn, count(*) over (partition by area,product,direction) n from bids window w as (partition by area,product,direction order by quantity)),
 b as (select *, round(100-tick/100,2)::double l from rb join p on rn=(tick*(n-1))//10000),
 rc as (select out_area, in_area, quantity*0.8::double quantity, row_number() over w-1 rn, count(*) over (partition by out_area,in_area) n from capacity window w as (partition by out_area,in_area order by quantity)),
 cq as (select *, round(100-tick/100,2)::double l from rc join p on rn=(tick*(n-1))//10000),
 k(area, direction, out_area, in_area) as (values """ + ",".join(str(r) for r in BRIDGE) + """),
 m as (select area, direction, l, min(quantity) lim from cq join k using (out_area,in_area) group by all)
select b.area, product, b.direction, b.l percentage_level, round(least(quantity, lim),6) "value" from b left join m on m.area=b.area and m.direction=b.direction and m.l=b.l"""),
    "compare_capacity_sources": oracle("capacity", """, d as (select valid_from, out_area, in_area, sum(quantity) da from capacity where contract='DA' group by all),
 i as (select valid_from, out_area, in_area, sum(quantity) id from capacity where contract='ID' group by all)
select valid_from, out_area, in_area, round(da,6) da, round(id,6) id, round(least(da,id),6) lowest, case when da is null or id<da then 'id' else 'da' end lowest_source from d full join i using (valid_from,out_area,in_area)"""),
    "pivot_products": oracle("bids", """, b as (select * replace (case when quantity<80 then quantity end as quantity) from bids)
select valid_from, valid_to, area, product, direction, 'sum' how, round(coalesce(sum(quantity),0),6) "value" from b group by all
union all select valid_from, valid_to, area, product, direction, 'mean', round(avg(quantity),6) from b group by all having avg(quantity) is not null"""),
    "areas_by_name": oracle("areas", """select * from areas where "name" in (select concat('NATION_', c_nationkey * 2) from customer)"""),
    "border_pairs": oracle("areas", """, b(x,y) as (values ('NATION_1','NATION_2'),('NATION_2','NATION_1'),('NATION_2','NATION_3'),('NATION_3','NATION_2'))
select o.code out_id, i.code in_id from b join areas o on o."name"=x join areas i on i."name"=y"""),
    "triples_roots": oracle("triples", "select distinct PARENT_ID from triples where PARENT_ID not in (select ID from triples)"),
    "triples_to_table": oracle("triples", """, s as (select ID, min(PARENT_ID) "Series_PARENT_ID", max(case when KEY='Type' then "VALUE" end) "Type", max(case when KEY='status' then "VALUE" end) status
  from triples where ID in (select ID from triples where KEY='Type' and "VALUE"='Series') group by ID)
select s.*, (select max("VALUE") from triples t where t.ID=s."Series_PARENT_ID" and KEY='segment') segment,
 (select max(ID) from triples t where t.ID=s."Series_PARENT_ID" and KEY='Type') "Document_ID" from s"""),
}
