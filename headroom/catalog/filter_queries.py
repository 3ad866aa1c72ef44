"""Scans, filter specs, column and row filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from headroom.catalog import views as v
from headroom.catalog.views import oracle
from headroom.scale import literal_table
from headroom.operators import areas as a
from headroom.operators import columns as c
from headroom.operators import filters as f
from headroom.operators import series as s
from headroom.sources import points as p

START, END = datetime(2024, 1, 10), datetime(2024, 1, 20)
SPEC = {"product": ["SA_mFRR", "DA_mFRR"], "must_not": [{"kind": "procured"}], "range": {"quantity": {"gte": 5, "lt": 90}}, "exists": {"field": "exclusive_id"}}


def scan_points(spark, sf):
    return p.scan_points(spark, f"{sf}/events.parquet", ["event_id", "ts", "value"])


def scan_time_range(spark, sf):
    events = v.table(spark, sf, "events")
    one = p.scan_time_range(events, START, END, "ts").select("event_id", F.lit("half-open").alias("rule"))
    two = p.scan_time_range(v.bids(spark, sf), START, END, ["valid_from", "valid_to"]).select(F.col("id").alias("event_id"), F.lit("closed").alias("rule"))
    return one.unionByName(two)


def filter_by_spec(spark, sf):
    should = {"should": [{"area": "North"}, {"bool": {"must": [{"area": "Mid"}, {"direction": "UP"}]}}]}
    return p.filter_by_spec(v.bids(spark, sf), SPEC, should).select("id", "area", "product", "direction", "quantity")


def flatten_nested(spark, sf):
    nested = v.bids(spark, sf).select(
        "id", F.struct(F.struct(F.col("area").alias("name")).alias("domain"), F.col("quantity").alias("value")).alias("available"),
        F.when(F.col("id") % 3 > 0, F.slice(F.array("product", "kind"), F.lit(1), (F.col("id") % 3).cast("int"))).alias("tags"),
    )
    flat = p.flatten_nested(nested)
    return flat.select(*[c.quoted(n).alias(n.replace(".", "_")) for n in flat.columns])


def flatten_long(spark, sf):
    """Tags as lists of structs with lists inside."""
    deep = F.struct("product", F.array("kind", "direction").alias("marks"))
    nested = v.bids(spark, sf).select(
        "id", F.struct(F.struct(F.col("area").alias("name")).alias("domain"), F.col("quantity").alias("value")).alias("available"),
        F.when(F.col("id") % 3 > 0, F.slice(F.array(deep, deep), F.lit(1), (F.col("id") % 3).cast("int"))).alias("tags"),
    )
    rows = p.flatten_long(nested, "id")
    return rows.select("id", "path", F.array_join(F.col("position").cast("array<string>"), ".").alias("position"),
                       F.when(F.col("number").isNull(), F.col("value")).alias("text"), "number")


def nest_columns(spark, sf):
    bids = v.bids(spark, sf).select("id", F.col("area").alias("domain.name"), F.col("direction").alias("direction.code"), F.col("position").alias("available.position"))
    return p.nested_json(bids)


def time_chunks(spark, sf):
    end = datetime(2024, 1, 31)
    chunks = p.time_chunks(spark, datetime(2024, 1, 1), end, "P7D")
    counts = p.tag_chunks(v.bids(spark, sf), datetime(2024, 1, 1), end, "P7D").groupBy("chunk").agg(F.count("*").alias("n"))
    return chunks.join(counts, "chunk")


def resolve_roles(spark, sf):
    stored = v.bids(spark, sf).select(
        "valid_from", "valid_to", F.col("area").alias("Domain.mRID"), F.col("product").alias("type.name"), F.col("direction").alias("direction"),
        F.col("quantity").alias("point.quantity"),
    )
    return c.resolve_roles(stored, c.BID_ROLES)


def rename_by_mapping(spark, sf):
    bids = v.bids(spark, sf).select("id", "area", "product", F.col("kind").alias("domain"))
    return c.rename_by_mapping(bids, {"area": "domain", "product": "process_type"})


def drop_columns(spark, sf):
    bids = v.bids(spark, sf).withColumn("empty", F.lit(None).cast("string"))
    return c.drop_columns(bids, ["kind", "exclusive_id", "valid_to"])


def add_constants(spark, sf):
    return c.add_constants(v.bids(spark, sf).select("id", "area"), {"source": "market", "area": "none"}, overwrite=False)


def convert_columns(spark, sf):
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.regexp_replace("o_orderpriority", "-.*", "").alias("o_priority_code"))
    mixed = orders.withColumn("o_mixed", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(F.col("o_priority_code")))
    converted = c.convert_columns(c.convert_columns(mixed, "string", ["key"], ["order"]), "int", ["code"])
    return c.convert_columns(converted, "double", ["mixed"], keep_text=True)


def filter_equals(spark, sf):
    return f.filter_equals(v.bids(spark, sf), {"area": "North", "exclusive_id": None}).select("id", "area", "quantity")


def filter_contains(spark, sf):
    return f.filter_contains(v.bids(spark, sf), {"product": ["mfrr"], "area": "nowhere", "direction": ["up"]}).select("id", "area", "product")


def filter_group_extreme(spark, sf):
    group = ["valid_from", "out_area", "in_area", "contract"]
    return f.filter_group_extreme(v.capacity(spark, sf), {"position": "max", "quantity": "max"}, group).select("id", *group, "position", "quantity")


def pick_group_argmax(spark, sf):
    return f.pick_group_argmax(v.bids(spark, sf), "exclusive_id", "quantity", tie="id").select("id", "exclusive_id", "quantity")


def slice_time(spark, sf):
    return f.slice_time(v.bids(spark, sf), [END, START, None]).select("id", "valid_from")


def slice_time_of_day(spark, sf):
    slices = literal_table(spark, [(1, "22:00:00", "05:59:59", "CET"), (2, "05:00:00", "12:29:59", "CET")], "position int, start_time string, end_time string, time_zone string")
    return f.slice_time_of_day(v.bids(spark, sf).select("id", "valid_from"), slices)


def negative_policy(spark, sf):
    cells = v.imbalance(spark, sf).select("valid_from", "valid_to", "region", F.col("quantity").alias("value"))
    cut = f.negative_policy(cells, "cut", product="region").withColumn("policy", F.lit("cut"))
    zero = f.negative_policy(cells, "zero", product="region").withColumn("policy", F.lit("zero"))
    return cut.unionByName(zero).withColumn("value", F.round("value", 6))


def filter_send_levels(spark, sf):
    return f.filter_send_levels(v.proposed(spark, sf).withColumn("level", F.col("level").cast("double")), 95, 97, 1, "level")


def replace_values(spark, sf):
    return c.replace_values(v.bids(spark, sf).select("id", "product", "direction"), {"product": c.PRODUCT_MERGE, "missing": {"a": "b"}})


def align_labels(spark, sf):
    areas = v.areas(spark, sf).select(
        F.col("id").alias("mrid_order"), F.concat(F.lit("EIC"), F.col("id")).alias("mrid"), F.concat("name", F.lit("X")).alias("name"), "code",
        F.concat(F.lit("P"), F.col("id")).alias("party_mrid"), F.concat(F.lit("TSO"), F.col("id"), F.lit("!")).alias("party_name"),
    )
    labels = v.table(spark, sf, "customer").select("c_custkey", F.expr(
        "case c_custkey % 4 when 0 then concat('EIC', c_nationkey) when 1 then concat('area nation_', c_nationkey, 'x') when 2 then concat('n', c_nationkey) else concat('other', c_nationkey) end"
    ).alias("label"))
    return a.align_labels(labels, "label", areas, "name", "mrid_order")


def latest_version(spark, sf):
    return f.latest_version(v.proposed(spark, sf), fixed_cols=["area", "direction", "level"])


def results_by_type(spark, sf):
    stored = v.proposed(spark, sf).withColumns({"result_type": F.when(F.col("direction") == "F", "ATC").otherwise("NCPB"), "note": F.lit(None).cast("string")})
    return f.results_by_type(stored, "NCPB", fixed_cols=["area", "direction", "level"])


def data_range(spark, sf):
    return f.data_range(v.bids(spark, sf), datetime(2023, 12, 1), datetime(2024, 1, 15), "valid_from", "valid_to")


def dedupe_last(spark, sf):
    return f.dedupe_last(v.bids(spark, sf), ["valid_from", "area"], ["quantity", "id"]).select("valid_from", "area", "id", "quantity")


def decode_codes(spark, sf):
    coded = v.bids(spark, sf).select("id", F.when(F.col("direction") == "UP", "a01").otherwise("A02").alias("code"), F.concat(F.lit("bid "), F.col("product")).alias("text"))
    named = c.decode_codes(coded, "code", c.DIRECTIONS, into="direction")
    return c.decode_codes(named, "text", c.PRODUCTS, "code", contained=True, into="process")


def classify_id_tokens(spark, sf):
    ids = v.bids(spark, sf).select("id", F.expr("concat(lower(substring(product, 1, 2)), '_', case when kind='procured' then 'procured' else 'volumes' end, '_', lower(right(product, 4)))").alias("mrid"))
    return c.classify_id_tokens(ids, "mrid")


def whitelist_products(spark, sf):
    return f.whitelist_products(v.bids(spark, sf), {"area": ["North", "Mid"], "product": {"SA_mFRR": "mFRR", "aFRR": "aFRR"}, "direction": ["UP"]}).select("id", "area", "product", "direction")


def single_value(spark, sf):
    bids = v.bids(spark, sf)
    unique = f.single_value(bids.where("area = 'North'").select(F.col("area").alias("found")), "found").withColumn("case", F.lit("unique"))
    many = f.single_value(bids.select(F.col("product").alias("found")), "found").withColumn("case", F.lit("many"))
    loose = f.single_value(bids.select(F.col("product").alias("found")), "found", strict=False).withColumn("case", F.lit("loose"))
    return unique.unionByName(many).unionByName(loose)


def infer_datetime_columns(spark, sf):
    text = v.table(spark, sf, "orders").select(
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm'Z'").alias("iso"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderkey") % 10 < 7, F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd")).otherwise("soon").alias("mixed"),
        F.col("o_orderkey").cast("string").alias("digits"),
    )
    return c.infer_datetime_columns(text).withColumn("share", F.round("share", 6))


def clear_text_nan(spark, sf):
    bids = v.bids(spark, sf).select("id", F.coalesce("exclusive_id", F.lit("nan")).alias("exclusive_id"), F.when(F.col("id") % 7 > 0, F.col("quantity")).otherwise(F.lit(float("nan"))).alias("quantity"))
    return f.clear_text_nan(bids, ["exclusive_id", "quantity"])


QUERIES = {q.__name__: q for q in (
    scan_points, scan_time_range, filter_by_spec, flatten_nested, flatten_long, nest_columns, time_chunks, resolve_roles, rename_by_mapping, drop_columns,
    add_constants, convert_columns, filter_equals, filter_contains, filter_group_extreme, pick_group_argmax, slice_time, slice_time_of_day,
    negative_policy, filter_send_levels, replace_values, align_labels, latest_version, results_by_type, data_range, dedupe_last, decode_codes,
    classify_id_tokens, whitelist_products, single_value, infer_datetime_columns, clear_text_nan,
)}

ORACLE = {
    "scan_points": "select event_id, ts, value from events",
    "scan_time_range": oracle("bids", """select event_id, 'half-open' rule from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20'
union all select id, 'closed' from bids where valid_from >= timestamp '2024-01-10' and valid_to <= timestamp '2024-01-20'"""),
    "filter_by_spec": oracle("bids", """select id, area, product, direction, quantity from bids where product in ('SA_mFRR','DA_mFRR') and not kind='procured'
 and quantity >= 5 and quantity < 90 and exclusive_id is not null and (area='North' or (area='Mid' and direction='UP'))"""),
    "flatten_long": oracle("bids", """, t as (select *, unnest(range(1, (id%3 + 1)::int)) n from bids)
select id, 'available.domain.name' "path", '' "position", area "text", null::double "number" from bids union all select id, 'available.value', '', null, quantity from bids
union all select id, 'tags.product', n::varchar, product, null from t union all select id, 'tags.marks', n || '.1', kind, null from t
union all select id, 'tags.marks', n || '.2', direction, null from t"""),
    "flatten_nested": oracle("bids", """select id, area available_domain_name, quantity available_value, case when id%3>0 then product end tags_1, case when id%3=2 then kind end tags_2 from bids"""),
    "nest_columns": oracle("bids", """select '{"id":' || id || ',"domain":{"name":"' || area || '"},"direction":{"code":"' || direction || '"},"available":{"position":' || "position" || '}}' "document" from bids"""),
    "time_chunks": oracle("bids", """, k as (select unnest(generate_series(0,4)) chunk)
select chunk, timestamp '2024-01-01' + chunk*interval 7 days chunk_from, least(timestamp '2024-01-01' + (chunk+1)*interval 7 days, timestamp '2024-01-31') chunk_to, count(*) n
from k join bids on valid_from >= timestamp '2024-01-01' + chunk*interval 7 days and valid_from < least(timestamp '2024-01-01' + (chunk+1)*interval 7 days, timestamp '2024-01-31') group by 1"""),
    "resolve_roles": oracle("bids", """select valid_from, valid_to, area, product, direction, quantity "value" from bids"""),
    "rename_by_mapping": oracle("bids", "select id, area domain, product process_type, kind domain_2 from bids"),
    "drop_columns": oracle("bids", """select id, valid_from, area, product, direction, "position", quantity from bids"""),
    "add_constants": oracle("bids", "select id, area, 'market' source from bids"),
    "convert_columns": "select o_orderkey, cast(o_custkey as varchar) o_custkey, o_orderpriority, cast(regexp_replace(o_orderpriority,'-.*','') as int) o_priority_code,"
    " case when o_orderkey%3<>0 then cast(regexp_replace(o_orderpriority,'-.*','') as double) end o_mixed, case when o_orderkey%3=0 then o_orderpriority end o_mixed_text from orders",
    "filter_equals": oracle("bids", "select id, area, quantity from bids where area='North' and exclusive_id is null"),
    "filter_contains": oracle("bids", "select id, area, product from bids where product like '%mFRR%' and direction='UP'"),
    "filter_group_extreme": oracle("capacity", """, g as (select *, max("position") over w mp, max(quantity) over w mq from capacity window w as (partition by valid_from,out_area,in_area,contract))
select id, valid_from, out_area, in_area, contract, "position", quantity from g where "position"=mp and quantity=mq"""),
    "pick_group_argmax": oracle("bids", """select id, exclusive_id, quantity from bids where exclusive_id is null
union all select id, exclusive_id, quantity from (select *, row_number() over (partition by exclusive_id order by quantity desc, id) rn from bids where exclusive_id is not null) where rn=1"""),
    "slice_time": oracle("bids", "select id, valid_from from bids where valid_from between timestamp '2024-01-10' and timestamp '2024-01-20'"),
    "slice_time_of_day": oracle("bids", """, t as (select id, valid_from, strftime(timezone('CET', timezone('UTC', valid_from)),'%H:%M:%S') clock from bids)
select id, valid_from, 1 "position" from t where clock >= '22:00:00' or clock <= '05:59:59' union all select id, valid_from, 2 from t where clock between '05:00:00' and '12:29:59'"""),
    "negative_policy": oracle("imbalance", """, g as (select *, count(*) filter (quantity>=0) over (partition by valid_from) good from imbalance)
select 'cut' policy, valid_from, valid_to, region, round(quantity,6) "value" from g where good=(select count(distinct region) from imbalance)
union all select 'zero', valid_from, valid_to, region, round(greatest(quantity,0),6) from imbalance"""),
    "filter_send_levels": oracle("proposed", """select area, direction, cast("level" as double) "level", version_number, "value" from proposed where "level" in (95,96,97)"""),
    "replace_values": oracle("bids", "select id, case when product in ('SA_mFRR','DA_mFRR') then 'mFRR' else product end product, direction from bids"),
    "align_labels": oracle("areas", """, l as (select c_custkey, c_nationkey k, case c_custkey%4 when 0 then concat('EIC', c_nationkey) when 1 then concat('area nation_', c_nationkey, 'x') when 2 then concat('n', c_nationkey) else concat('other', c_nationkey) end label from customer)
select c_custkey, coalesce((select "name" || 'X' from areas a where upper(label)=upper('EIC'||id) or contains(upper(label), upper("name"||'X')) or upper(label)=upper(code) order by id limit 1), label) label from l"""),
    "latest_version": oracle("proposed", """select area, direction, "level", version_number, "value" from (select *, max(cast(version_number as int)) over (partition by area,direction,"level") m from proposed) where cast(version_number as int)=m"""),
    "results_by_type": oracle("proposed", """select area, direction, "level", version_number, "value", 'NCPB' result_type from (select *, max(cast(version_number as int)) over (partition by area,direction,"level") m from proposed where direction<>'F') where cast(version_number as int)=m"""),
    "data_range": oracle("bids", "select greatest(min(valid_from), timestamp '2023-12-01') period_start, least(max(valid_to), timestamp '2024-01-15') period_end from bids"),
    "dedupe_last": oracle("bids", "select valid_from, area, id, quantity from (select *, row_number() over (partition by valid_from, area order by quantity desc, id desc) rn from bids) where rn=1"),
    "decode_codes": oracle("bids", """select id, case when direction='UP' then 'a01' else 'A02' end code, 'bid ' || product "text", direction,
 case when product like '%mFRR' then 'A47' when product='aFRR' then 'A51' end process from bids"""),
    "classify_id_tokens": oracle("bids", """select id, lower(substring(product,1,2)) || '_' || case when kind='procured' then 'procured' else 'volumes' end || '_' || lower(right(product,4)) mrid,
 case when kind='procured' then 'A15' else 'A37' end message_type, case when kind='procured' then 'B95' else 'B74' end business_type,
 case when product like '%mFRR' then 'A47' when product='RR' then 'A46' else 'A51' end process_type, case product when 'SA_mFRR' then 'A05' when 'DA_mFRR' then 'A07' end market_product_type from bids"""),
    "whitelist_products": oracle("bids", "select id, area, case product when 'SA_mFRR' then 'mFRR' else product end product, direction from bids where area in ('North','Mid') and product in ('SA_mFRR','aFRR') and direction='UP'"),
    "single_value": oracle("bids", """select 'unique' "case", case when count(distinct area)=1 then min(area) end found from bids where area='North'
union all select 'many', case when count(distinct product)=1 then min(product) end from bids union all select 'loose', case when count(distinct product)>1 then min(product) end from bids"""),
    "infer_datetime_columns": """select 'iso' "column", 1.0::double share, true is_datetime from (select count(*) from orders) union all select 'priority', 0.0::double, false
union all select 'mixed', round((select avg(case when o_orderkey%10<7 then 1.0 else 0.0 end) from orders),6)::double, false union all select 'digits', 0.0::double, false""",
    "clear_text_nan": oracle("bids", "select id, exclusive_id, case when id%7>0 then quantity end quantity from bids"),
}
