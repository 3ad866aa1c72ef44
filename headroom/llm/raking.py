"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic).  Each sweep rakes the cell
weights to the source, the language and the topic marginal in turn: every value's
cells are scaled so that their sum meets the target.  A document of a cell is then
kept with probability min(1, rate * raked / tokens of the cell), decided by a hash
of its id, and carries the weight that makes kept tokens an unbiased estimate of
the raked ones even where the probability is cut at 1.

Everything is DataFrame functions; only the cells (a row per combination that
occurs) are raked, with joins on the marginals' values.

Targets: the observed share of each value raised to `power` and normalised; 1 keeps
shares, 0 makes them equal.  Null source or language is the value `?`.

Topics are told by marks in the text: licence lines, contact data, symbol junk, else prose.

Defined results: documents without tokens have probability 1 and weight 1; a null
text has no tokens; a null id is hashed as `?`; the tokens of a text of any length
all count; repeated rows are decided alike;
an empty table gives an empty table; clashing names don't matter as cells have own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.scratch import stored
from headroom.llm.texts import documents

SWEEPS = 12
POWERS = {"__source": 0.7, "__lang": 0.7, "__topic": 1.0}
RATE = 0.8  # share of the tokens that is aimed at


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    lower = F.lower(F.coalesce(text, F.lit("")))
    return (F.when(F.contains(lower, F.lit("licens")) | F.contains(lower, F.lit("copyright")), "licence")
            .when(F.contains(lower, F.lit("@")) | F.contains(lower, F.lit("http")), "contact")
            .when(F.contains(lower, F.lit("###")) | F.contains(lower, F.lit("$$$")) | F.contains(lower, F.lit("&&&")), "symbols").otherwise("prose"))


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the id."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("?"))).cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def raked(cells: DataFrame, powers: dict[str, float] = POWERS, sweeps: int = SWEEPS) -> DataFrame:
    """cells (keys of `powers`, tokens) -> with `raked`, the fitted tokens, whose sum stays that of `tokens`."""
    fitted = cells.withColumn("raked", F.col("tokens").cast("double"))
    targets = {}
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    for axis, power in powers.items():
        marginal = stored(cells.groupBy(axis).agg(F.pow(F.sum("tokens").cast("double"), F.lit(float(power))).alias("mass")), "target")
        mass = marginal.agg(F.sum("mass")).first()[0] or 1.0
        targets[axis] = marginal.select(axis, (F.col("mass") / mass * total).alias("target"))
    for _ in range(sweeps):
        for axis in powers:
            sums = fitted.groupBy(axis).agg(F.sum("raked").alias("now"))
            factor = sums.join(targets[axis], axis).select(axis, (F.col("target") / F.col("now")).alias("factor"))
            # cells only; stored at each axis, as a plan over several would hold each axis twice as often as the one after it
            fitted = stored(fitted.join(factor, axis).withColumn("raked", F.col("raked") * F.col("factor")).drop("factor"), "raked")
    return fitted


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", seed: str = "mix", rate: float = RATE) -> DataFrame:
    """`docs` with __tokens, __probability, __kept, __weight and __copies.

    __copies are the whole copies of rate * raked / tokens and one more by the hash for
    the rest, so that tokens counted with them meet the targets without weights.
    """
    told = docs.withColumns({
        "__source": F.coalesce(F.col(source).cast("string"), F.lit("?")), "__lang": F.coalesce(F.col(lang).cast("string"), F.lit("?")),
        "__topic": topic_of(F.col(text)), "__tokens": token_count(F.col(text))})
    cells = told.filter("__tokens > 0").groupBy(*POWERS).agg(F.sum("__tokens").alias("tokens"))
    cells = stored(cells, "cells")
    shares = raked(cells).select(*POWERS, (F.col("raked") / F.col("tokens")).alias("__ratio"))
    joined = told.join(F.broadcast(shares) if shares.limit(MAX_CELLS + 1).count() <= MAX_CELLS else shares, list(POWERS), "left")
    ratio = F.when(F.col("__tokens") > 0, F.col("__ratio")).otherwise(1 / rate)
    joined = joined.withColumn("__probability", F.least(F.lit(1.0), ratio * rate))
    whole = F.floor(ratio * rate)
    joined = joined.withColumn("__copies", (whole + (uniform(F.col(key), seed) < ratio * rate - whole).cast("int")).cast("int"))
    joined = joined.withColumn("__kept", uniform(F.col(key), seed) < F.col("__probability")).withColumn("__weight", ratio * rate / F.col("__probability"))
    return joined.select(*docs.columns, "__source", "__lang", "__topic", "__tokens", "__probability", "__kept", "__weight", "__copies")


#: Cells are broadcast up to this number (some 10 MB) and joined by shuffle beyond it.
MAX_CELLS = 100_000


def op7_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(documents(spark, sf_dir))
    return out.select(
        "doc_id", F.col("__topic").alias("topic"), F.col("__tokens").alias("n_tokens"), F.round("__probability", 6).alias("probability"),
        F.col("__kept").cast("int").alias("kept"), F.round("__weight", 6).alias("weight"))


def cells_sql(table: str = "documents") -> str:
    """CTEs `told` (documents with cells and tokens) and `c0` ... (raked cells) in DuckDB SQL."""
    text = [f"""told as materialized (
        select *, coalesce(source, '?') as __source, coalesce(lang, '?') as __lang,
          case when contains(lower(coalesce(text, '')), 'licens') or contains(lower(coalesce(text, '')), 'copyright') then 'licence'
               when contains(lower(coalesce(text, '')), '@') or contains(lower(coalesce(text, '')), 'http') then 'contact'
               when contains(lower(coalesce(text, '')), '###') or contains(lower(coalesce(text, '')), '$$$') or contains(lower(coalesce(text, '')), '&&&') then 'symbols'
               else 'prose' end as __topic,
          coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as __tokens
        from {table})""",
            "cells as materialized (select __source, __lang, __topic, sum(__tokens) as tokens from told where __tokens > 0 group by all)"]
    for axis, power in POWERS.items():
        text.append(f"""t{axis} as materialized (
            select {axis}, power(sum(tokens)::double, {float(power)}) / sum(power(sum(tokens)::double, {float(power)})) over () * (select sum(tokens)::double from cells) as target
            from cells group by {axis})""")
    text.append("c0 as materialized (select *, tokens::double as raked from cells)")
    step = 0
    for _ in range(SWEEPS):
        for axis in POWERS:
            text.append(f"""c{step + 1} as materialized (
                select c.* exclude (raked), raked * (target / sum(raked) over (partition by c.{axis})) as raked from c{step} c join t{axis} using ({axis}))""")
            step += 1
    text.append(f"""mixed as materialized (
        select *, least(1.0::double, ratio * {RATE}) as __probability,
          (('0x' || substr(md5('mix' || coalesce(doc_id::varchar, '?')), 1, 12))::bigint)::double / 281474976710656.0 as draw
        from (select told.*, case when __tokens > 0 then raked / tokens else {1 / RATE} end as ratio from told left join c{step} using (__source, __lang, __topic)))""")
    return ",\n".join(text)


ORACLE_SQL = f"""with {cells_sql()}
select doc_id, __topic as topic, __tokens as n_tokens, round(__probability, 6) as probability,
  (draw < __probability)::int as kept, round(ratio * {RATE} / __probability, 6) as weight
from mixed"""

QUERIES = {"op7_raking": op7_raking}
ORACLE = {"op7_raking": ORACLE_SQL}
