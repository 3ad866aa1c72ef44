"""Reserve sizing: shares, grids, limits, bootstrap, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from headroom.catalog import views as v
from headroom.catalog.views import oracle
from headroom.operators import sizing as z
from headroom.operators.quantiles import quantile_linear

PROBS = [0.005, 0.1, 0.2, 0.8, 0.9, 0.995]
LEVELS = [("Level 1", 20.0, 30.0), ("Level 2", 40.0, 5.0)]  # limits that suit the events table
TARGETS = [(n, t) for n, t, _ in LEVELS]
ALLOWED = {n: p for n, _, p in LEVELS}
SIMULATIONS, SAMPLES, SEED = 50, 20_000, 7


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def block_total(spark, sf):
    return _rounded(z.block_total(v.imbalance(spark, sf), "Block", ["North", "Mid", "South"]), "quantity")


def share_over_target(spark, sf):
    return _rounded(z.share_over_target(v.imbalance(spark, sf), TARGETS, by="region"), "share")


def _grid(spark, sf, target):
    return z.symmetric_percentile_grid(v.imbalance(spark, sf), target, by="region")


def symmetric_percentile_grid(spark, sf):
    return _rounded(_grid(spark, sf, 20.0), "lower", "upper", "off", "within", "span")


def closest_percentile(spark, sf):
    parts = [z.closest_percentile(_grid(spark, sf, t), p, "region").withColumn("level", F.lit(n)) for n, t, p in LEVELS]
    return _rounded(parts[0].unionByName(parts[1]), "lower", "upper", "off", "within", "span")


def _pairs(spark, sf):
    found = quantile_linear(v.imbalance(spark, sf), "quantity", [0.1, 0.2, 0.8, 0.9], "region")

    def at(p):
        return F.max(F.when(F.col("probability") == p, F.col("value")))

    wide = found.groupBy("region").agg(at(0.1).alias("d1"), at(0.9).alias("u1"), at(0.2).alias("d2"), at(0.8).alias("u2"))
    return wide.select("region", F.inline(F.array(
        F.struct(F.lit("wide").alias("label"), F.col("d1").alias("down"), F.col("u1").alias("up")),
        F.struct(F.lit("narrow").alias("label"), F.col("d2").alias("down"), F.col("u2").alias("up")),
        F.struct(F.lit("wrong").alias("label"), F.lit(1.0).alias("down"), F.col("u2").alias("up")),
    )))


def residual_over_target(spark, sf):
    found = z.residual_over_target(v.imbalance(spark, sf), _pairs(spark, sf), TARGETS, by="region")
    return _rounded(found, "down", "up", "down_percent", "up_percent")


def limits_passed(spark, sf):
    found = z.residual_over_target(v.imbalance(spark, sf), _pairs(spark, sf), TARGETS, by="region")
    return z.limits_passed(found, {"Level 1": 2.0, "Level 2": 0.05}, "region")


def outside_center_lines(spark, sf):
    lines = _pairs(spark, sf).where("label = 'wide'").select("region", F.col("up").alias("low"), F.col("down").alias("high"))
    return _rounded(z.outside_center_lines(v.imbalance(spark, sf), lines, by="region"), "above", "below")


def signed_percentiles(spark, sf):
    return _rounded(z.signed_percentiles(v.imbalance(spark, sf), PROBS, by="region"), "value")


def bootstrap_percentiles(spark, sf):
    found = z.bootstrap_percentiles(v.imbalance(spark, sf), PROBS, by="region", simulations=SIMULATIONS, samples=SAMPLES, seed=SEED)
    return _rounded(found, "mean", "std", "ci95")


def sizing_report(spark, sf):
    imbalance = v.imbalance(spark, sf)
    labels = z.percentile_labels([-99.5, -90, -80, 80, 90, 99.5])
    fixed = quantile_linear(imbalance, "quantity", list(labels), "region")
    drawn = z.bootstrap_percentiles(imbalance, list(labels), by="region", simulations=SIMULATIONS, samples=SAMPLES, seed=SEED)
    return _rounded(z.sizing_report(fixed, drawn, labels, "region"), "value", "deviation").drop("text")


QUERIES = {f.__name__: f for f in (
    block_total, share_over_target, symmetric_percentile_grid, closest_percentile, residual_over_target, limits_passed, outside_center_lines,
    signed_percentiles, bootstrap_percentiles, sizing_report,
)}


def _grid_sql(name: str, target: int) -> str:
    return f"""{name}_q as (select region, unnest(generate_series(0,489)) i, unnest(quantile_cont(quantity, {[i / 2000 for i in range(490)]})) lo,
  unnest(quantile_cont(quantity, {[(2000 - i) / 2000 for i in range(490)]})) hi from imbalance group by 1),
 {name}_b as (select region, i/1000.0::double "percent", round(lo,9) lower, round(hi,9) upper from {name}_q),
 {name} as (select b.region, "percent", lower, upper,
  100.0::double/count(*)*count(*) filter (round(quantity,9) > round(upper+{target},9) or round(quantity,9) < round(lower-{target},9)) "off",
  100.0::double/count(*)*count(*) filter (round(quantity,9) <= round(upper+{target},9) and round(quantity,9) >= round(lower-{target},9)) "within",
  100.0::double/count(*)*count(*) filter (round(quantity,9) between lower and upper) span
  from {name}_b b join imbalance m on m.region=b.region group by b.region, "percent", lower, upper)"""


_OUT = 'region, "percent", round(lower,6) lower, round(upper,6) upper, round("off",6) "off", round("within",6) "within", round(span,6) span'
_PAIRS = """, w as (select region, quantile_cont(quantity,0.1) d1, quantile_cont(quantity,0.9) u1, quantile_cont(quantity,0.2) d2, quantile_cont(quantity,0.8) u2 from imbalance group by 1),
 pairs as (select region, 'wide' label, d1 down, u1 up from w union all select region, 'narrow', d2, u2 from w union all select region, 'wrong', 1.0::double, u2 from w),
 tg("level", target) as (values ('Level 1', 20.0::double), ('Level 2', 40.0::double)),
 res as (select p.region, label, down, up, "level", target,
  case when down<=0 and up>=0 then (100.0*count(*) filter (quantity < down-target))/count(quantity) end down_percent,
  case when down<=0 and up>=0 then (100.0*count(*) filter (quantity > up+target))/count(quantity) end up_percent
  from pairs p cross join tg join imbalance m on m.region=p.region group by p.region, label, down, up, "level", target)"""
_BOOT = f""", v as (select region, quantity, row_number() over (partition by region order by quantity)-1 rn, count(*) over (partition by region) n from imbalance),
 sz as (select region, max(n) n from v group by 1),
 dr as (select region, sim, ('0x' || substr(md5(concat_ws('-', '{SEED}', region, sim, d)),1,12))::bigint % n rk
  from sz, (select unnest(generate_series(0,{SIMULATIONS - 1})) sim) s, (select unnest(generate_series(0,{SAMPLES - 1})) d) k),
 vals as (select dr.region, sim, quantity from dr join v on v.region=dr.region and v.rn=dr.rk),
 sims as (select region, sim, unnest({PROBS}::double[]) probability, unnest(quantile_cont(quantity, {PROBS})) x from vals group by 1,2),
 boot as (select region, probability, avg(x) mean, stddev_samp(x) std from sims group by 1,2)"""

ORACLE = {
    "block_total": oracle("imbalance", """select valid_from, valid_to, 'Block' region, round(sum(quantity),6) quantity from imbalance group by 1,2"""),
    "share_over_target": oracle("imbalance", """, t("level", target) as (values ('Level 1', 20.0::double), ('Level 2', 40.0::double))
select region, "level", target, round(100.0*count(*) filter (abs(quantity)>target)/count(*),6)::double share from imbalance, t group by all"""),
    "symmetric_percentile_grid": oracle("imbalance", ", " + _grid_sql("g", 20) + f" select {_OUT} from g"),
    "closest_percentile": oracle("imbalance", ", " + _grid_sql("g", 20) + ", " + _grid_sql("h", 40) + f""",
 u as (select *, 'Level 1' "level", 30 a from g union all select *, 'Level 2', 5 from h),
 r as (select *, row_number() over (partition by region, "level" order by round(abs("off"-a),9), "percent") rn from u)
select "level", {_OUT} from r where rn=1"""),
    "residual_over_target": oracle("imbalance", _PAIRS + """
select region, label, round(down,6) down, round(up,6) up, "level", target, round(down_percent,6)::double down_percent, round(up_percent,6)::double up_percent from res"""),
    "limits_passed": oracle("imbalance", _PAIRS + """, p as (select region, label, bool_and(ok) all_passed, count(*) filter (ok) k, min(case when ok then "level" end) one
  from (select *, coalesce(round(down_percent+up_percent,9) <= case "level" when 'Level 1' then 2.0 else 0.05 end, false) ok from res) group by 1,2)
select region, label, all_passed, case k when 0 then 'none of the levels' when 2 then 'both of the levels' else one end verdict from p"""),
    "outside_center_lines": oracle("imbalance", """, w as (select region, quantile_cont(quantity,0.1) lo, quantile_cont(quantity,0.9) hi, avg(quantity) mu from imbalance group by 1)
select region, round(case when mu>lo and mu<hi then 100.0*count(*) filter (quantity>hi)/count(*) end,6)::double above,
 round(case when mu>lo and mu<hi then 100.0*count(*) filter (quantity<lo)/count(*) end,6)::double below from imbalance join w using (region) group by region, lo, hi, mu"""),
    "signed_percentiles": oracle("imbalance", """, a as (select region, unnest([0.8,0.9,0.995]::double[]) probability, unnest(quantile_cont(quantity,[0.8,0.9,0.995])) x from imbalance where quantity>=0 group by 1),
 b as (select region, unnest([0.005,0.1,0.2]::double[]) probability, unnest(quantile_cont(quantity,[0.005,0.1,0.2])) x from imbalance where quantity<=0 group by 1)
select region, probability, round(x,6) "value", 'positive' part from a union all select region, probability, round(x,6), 'negative' from b"""),
    "bootstrap_percentiles": oracle("imbalance", _BOOT + " select region, probability, round(mean,6) mean, round(std,6) std, round(1.96*std,6) ci95 from boot"),
    "sizing_report": oracle("imbalance", _BOOT + f""", det as (select region, unnest({PROBS}::double[]) probability, unnest(quantile_cont(quantity,{PROBS})) x from imbalance group by 1),
 u as (select region, probability, 'Deterministic' "method", x, 0.0::double dev from det union all select region, probability, 'Bootstrap', mean, std from boot)
select region, probability, "method", round(x,6) "value", round(dev,6) deviation,
 case probability when 0.005 then '99.5% for -' when 0.1 then '90% for -' when 0.2 then '80% for -' when 0.8 then '80% for +' when 0.9 then '90% for +' else '99.5% for +' end percentile from u"""),
}
