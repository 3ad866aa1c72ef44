"""Reserve-market views over the star-schema tables, for Spark and (as CTE text) for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUARTER = "date_trunc('minute', ts) - make_interval(0,0,0,0,0,cast(minute(ts)%15 as int))"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _quarters(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the start and end of their 15-minute interval (timestamp_ntz)."""
    return table(spark, sf, "events").withColumns(
        {
            "valid_from": F.expr(f"cast({QUARTER} as timestamp_ntz)"),
            "valid_to": F.expr(f"cast({QUARTER} + interval 15 minutes as timestamp_ntz)"),
            "k": F.expr("cast(regexp_extract(props,'([0-9]+)',1) as int)"),
        }
    )


def imbalance(spark, sf) -> DataFrame:
    region = F.expr("case user_id%3 when 0 then 'North' when 1 then 'Mid' else 'South' end").alias("region")
    return _quarters(spark, sf).groupBy("valid_from", "valid_to", region).agg(F.avg(F.col("value") - 50).alias("quantity"))


def bids(spark, sf) -> DataFrame:
    return _quarters(spark, sf).selectExpr(
        "event_id id", "valid_from", "valid_to",
        "case user_id%3 when 0 then 'North' when 1 then 'Mid' else 'South' end area",
        "case event_type when 'click' then 'SA_mFRR' when 'view' then 'DA_mFRR' when 'error' then 'RR' else 'aFRR' end product",
        "case when event_type='signup' then 'procured' else 'volume' end kind",
        "case when event_id%2=0 then 'UP' else 'DOWN' end direction",
        "case when k%5=0 then concat('X',cast(k as string)) end exclusive_id",
        "cast(1+event_id%3 as int) position", "value quantity",
    )


def capacity(spark, sf) -> DataFrame:
    return _quarters(spark, sf).selectExpr(
        "event_id id", "valid_from", "valid_to",
        "case user_id%4 when 0 then 'North' when 1 then 'Mid' when 2 then 'Mid' else 'South' end out_area",
        "case user_id%4 when 0 then 'Mid' when 1 then 'North' when 2 then 'South' else 'Mid' end in_area",
        "case when event_type in ('click','view') then 'DA' else 'ID' end contract",
        "cast(1+event_id%3 as int) position", "value quantity",
    )


def steps(spark, sf) -> DataFrame:
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", F.col("l_linenumber").alias("position")).agg(F.max("l_quantity").alias("quantity"))
    )
    orders = table(spark, sf, "orders")
    return orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "o_orderkey series_id", "o_orderdate series_from", "o_orderdate + interval 7 days series_to", "'P1D' resolution",
        "position", "o_orderdate + (position-1)*interval 1 day valid_from", "o_orderdate + position*interval 1 day valid_to",
        "o_orderpriority type", "quantity",
    )


def proposed(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("area"), F.col("l_linestatus").alias("direction"), "l_linenumber",
        F.expr("l_suppkey%4").alias("s"),
    ).agg(F.avg("l_extendedprice").alias("p")).selectExpr(
        "area", "direction", "100-l_linenumber level", "cast(cast(s as int) as string) version_number",
        "round(p*l_linenumber/1000,4) value",
    )


def realised(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("area"), F.col("l_linestatus").alias("direction"), "l_linenumber",
        F.expr("l_suppkey%3").alias("s"),
    ).agg(F.avg("l_quantity").alias("q"), F.max("l_shipdate").alias("received")).selectExpr(
        "area", "direction", "100-l_linenumber level", "cast(s as int) sender", "round(q*(1+s),4) value", "received",
    )


def areas(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey=r_regionkey")).selectExpr(
        "n_nationkey id", "n_name name", "concat('N',cast(n_nationkey as string)) code", "r_name block"
    )


def triples(spark, sf) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    oid, cid = "concat('o',cast(o_orderkey as string)) ID", "concat('c',cast(o_custkey as string)) PARENT_ID"
    own = "concat('c',cast(c_custkey as string)) ID"
    return (
        orders.selectExpr(oid, "'Type' KEY", "'Series' VALUE", cid)
        .unionAll(orders.selectExpr(oid, "'status' KEY", "o_orderstatus VALUE", cid))
        .unionAll(customer.selectExpr(own, "'Type' KEY", "'Document' VALUE", "'root' PARENT_ID"))
        .unionAll(customer.selectExpr(own, "'segment' KEY", "c_mktsegment VALUE", "'root' PARENT_ID"))
    )


SQL_VIEWS = {
    "imbalance": """select time_bucket(interval 15 minutes, ts) valid_from, time_bucket(interval 15 minutes, ts) + interval 15 minutes valid_to,
 case user_id%3 when 0 then 'North' when 1 then 'Mid' else 'South' end region, avg(value-50) quantity from events group by 1,2,3""",
    "bids": """select event_id id, time_bucket(interval 15 minutes, ts) valid_from, time_bucket(interval 15 minutes, ts) + interval 15 minutes valid_to,
 case user_id%3 when 0 then 'North' when 1 then 'Mid' else 'South' end area,
 case event_type when 'click' then 'SA_mFRR' when 'view' then 'DA_mFRR' when 'error' then 'RR' else 'aFRR' end product,
 case when event_type='signup' then 'procured' else 'volume' end kind,
 case when event_id%2=0 then 'UP' else 'DOWN' end direction,
 case when cast(regexp_extract(props,'([0-9]+)',1) as int)%5=0 then concat('X',cast(cast(regexp_extract(props,'([0-9]+)',1) as int) as varchar)) end exclusive_id,
 cast(1+event_id%3 as int) "position", value quantity from events""",
    "capacity": """select event_id id, time_bucket(interval 15 minutes, ts) valid_from, time_bucket(interval 15 minutes, ts) + interval 15 minutes valid_to,
 case user_id%4 when 0 then 'North' when 1 then 'Mid' when 2 then 'Mid' else 'South' end out_area,
 case user_id%4 when 0 then 'Mid' when 1 then 'North' when 2 then 'South' else 'Mid' end in_area,
 case when event_type in ('click','view') then 'DA' else 'ID' end contract, cast(1+event_id%3 as int) "position", value quantity from events""",
    "steps": """select o.o_orderkey series_id, o.o_orderdate series_from, o.o_orderdate + interval 7 days series_to, 'P1D' resolution, l."position",
 o.o_orderdate + (l."position"-1)*interval 1 day valid_from, o.o_orderdate + l."position"*interval 1 day valid_to, o.o_orderpriority "type", l.quantity
 from orders o join (select l_orderkey, l_linenumber "position", max(l_quantity) quantity from lineitem group by 1,2) l on l.l_orderkey=o.o_orderkey""",
    "proposed": """select l_returnflag area, l_linestatus direction, 100-l_linenumber "level", cast(cast(l_suppkey%4 as int) as varchar) version_number,
 round(avg(l_extendedprice)*l_linenumber/1000,4) "value" from lineitem group by l_returnflag,l_linestatus,l_linenumber,l_suppkey%4""",
    "realised": """select l_returnflag area, l_linestatus direction, 100-l_linenumber "level", cast(l_suppkey%3 as int) sender,
 round(avg(l_quantity)*(1+l_suppkey%3),4) "value", max(l_shipdate) received from lineitem group by l_returnflag,l_linestatus,l_linenumber,l_suppkey%3""",
    "areas": """select n_nationkey id, n_name "name", concat('N',cast(n_nationkey as varchar)) code, r_name "block" from nation join region on n_regionkey=r_regionkey""",
    "triples": """select concat('o',cast(o_orderkey as varchar)) ID,'Type' KEY,'Series' "VALUE",concat('c',cast(o_custkey as varchar)) PARENT_ID from orders
 union all select concat('o',cast(o_orderkey as varchar)),'status',o_orderstatus,concat('c',cast(o_custkey as varchar)) from orders
 union all select concat('c',cast(c_custkey as varchar)),'Type','Document','root' from customer
 union all select concat('c',cast(c_custkey as varchar)),'segment',c_mktsegment,'root' from customer""",
}


def oracle(names: str, body: str) -> str:
    """SQL text: the named views as CTEs, then `body` (its own CTEs first if it starts with a comma)."""
    ctes = ",\n".join(f"{n} as ({SQL_VIEWS[n]})" for n in names.split())
    joiner = "" if body.lstrip().startswith(",") else "\n"
    recursive = "recursive " if "/*recursive*/" in body else ""
    return f"with {recursive}{ctes}{joiner}{body}" if ctes else body
