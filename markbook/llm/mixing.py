"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations alone.

Each source's documents form blocks. Weights are rounded to units, of which a period has ``D`` in all, one slot each. The b-th block
(from 0) of a source with ``u`` units is released at slot ``floor(b D / u)`` and due by slot ``ceil((b + 1) D / u)``. In each slot
the released block with the earliest deadline runs. As the units fill the period, every block runs between release and deadline,
so that at any time a source is less than one block away from its share. All releases and deadlines repeat
with the period; the schedule of one period, ``D`` rows whatever the data, therefore gives every block its slot by a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16
PERIOD = 1000
# Rows of a source that are numbered in one task.
BUCKET_ROWS = 4096
_NEW = ["mix_block", "mix_slot", "mix_offset", "mix_release", "mix_deadline"]



def source_units(counts: DataFrame, weights: DataFrame | None, period: int) -> DataFrame:
    """``source, n, units, total``: a unit for each source, the rest by largest remainder. Integer arithmetic throughout.

    Without ``weights`` (``source, weight``) a source weighs the square root of its rows, which lifts small sources.
    """
    if weights is None:
        weighed = counts.withColumn("w", F.greatest(F.floor(F.sqrt("n") * 1000), F.lit(1)))
    else:
        given = weights.select(F.col("source").alias("given"), F.col("weight").cast("double").alias("weight"))
        weighed = counts.join(given, F.col("source").eqNullSafe(F.col("given")), "left")
        weighed = weighed.withColumn("w", F.greatest(F.floor(F.coalesce("weight", F.lit(0.0)) * 1000000), F.lit(0))).select("source", "n", "w")
    whole = Window.partitionBy()
    shares = weighed.withColumns({"k": F.count(F.lit(1)).over(whole), "all_w": F.greatest(F.sum("w").over(whole), F.lit(1))})
    shares = shares.withColumn("total", F.greatest(F.lit(period).cast("long"), F.col("k") * 4))
    shares = shares.withColumns({"part": F.expr("((total - k) * w) div all_w"), "over": F.expr("((total - k) * w) % all_w")})
    shares = shares.withColumn("left", F.col("total") - F.col("k") - F.sum("part").over(whole))
    place = F.row_number().over(whole.orderBy(F.desc("over"), F.col("source").asc_nulls_last()))
    # with no weight at all, nobody has a remainder and everyone shares what is left
    more = F.expr("left div k") + (place <= F.expr("left % k")).cast("long")
    return shares.select("source", "n", (1 + F.col("part") + more).alias("units"), "total")


def period_schedule(units: DataFrame) -> DataFrame:
    """``source, nth, slot, units, total``: the slot of each block of one period, by earliest deadline first."""
    rows = units.groupBy().agg(F.first("total").alias("total"), F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("missing"), "source", "units"))).alias("s"))
    # done: blocks of each source so far; runs: the source that each slot runs
    rows = rows.selectExpr(
        "total",
        "s",
        """aggregate(
            sequence(0L, total - 1),
            named_struct('done', transform(s, x -> 0L), 'runs', cast(array() as array<int>)),
            (state, t) -> transform(
                array(array_min(transform(s, (x, i) -> if(
                    state.done[i] < x.units and (state.done[i] * total) div x.units <= t,
                    named_struct('due', ((state.done[i] + 1) * total + x.units - 1) div x.units, 'i', i),
                    null)))),
                best -> named_struct(
                    'done', transform(state.done, (d, i) -> if(i = best.i, d + 1, d)),
                    'runs', concat(state.runs, array(best.i))))[0],
            state -> state.runs) as runs""",
    )
    slots = rows.select("total", "s", F.posexplode("runs").alias("slot", "i")).selectExpr("s[i].source as source", "s[i].units as units", "total", "cast(slot as long) as slot")
    nth = F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1
    return slots.withColumn("nth", nth.cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, source_column: str = "source", id_column: str = "doc_id", weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """All rows and columns of ``docs`` and the place of each in the mix; read in order of ``mix_slot, mix_offset``.

    Within a source rows stand in order of the md5 of their id, and ``block_rows`` of them form a block; the last may be
    shorter. Up to the slot where the first source ends, each source has its share to within one block; from then on the
    slots of an ended source stay empty, and nothing is dropped or repeated. A missing source is a source of its own, and a
    source without a weight gets one unit. Rows of a source with equal or missing ids stand together, in any order. Columns
    of ``docs`` that have the name of a new one are replaced.
    """
    docs = docs.drop(*_NEW)
    kept = docs.columns
    src, key = "__mix_source", "__mix_key"
    named = docs.withColumns({src: F.col(source_column).cast("string"), key: F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))})
    counts = named.groupBy(F.col(src).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    units = source_units(counts, weights, period)
    schedule = period_schedule(units).select(F.col("source").alias("s_source"), "nth", F.col("slot").alias("s_slot"))

    # numbers within a source: counts of key ranges, added up, and a number within each range
    place = F.expr(f"cast(conv(substr({key}, 1, 8), 16, 10) as long)")
    known = units.select(F.col("source").alias("u_source"), F.col("units").alias("__mix_units"), F.col("total").alias("__mix_total"), F.expr(f"(n + {BUCKET_ROWS - 1}) div {BUCKET_ROWS}").alias("__mix_buckets"))
    ranged = named.join(known, F.col(src).eqNullSafe(F.col("u_source"))).drop("u_source").withColumn("__mix_range", F.floor(place * F.col("__mix_buckets") / F.lit(1 << 32)))
    in_range = ranged.groupBy(src, "__mix_range").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy(src).orderBy("__mix_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = in_range.select(F.col(src).alias("r_source"), F.col("__mix_range").alias("r_range"), before.alias("__mix_before"))
    numbered = ranged.withColumn("__mix_n", F.row_number().over(Window.partitionBy(src, "__mix_range").orderBy(key, F.col(id_column))) - 1)
    numbered = numbered.join(starts, F.col(src).eqNullSafe(F.col("r_source")) & (F.col("__mix_range") == F.col("r_range")))
    numbered = numbered.withColumn("__mix_n", F.col("__mix_n") + F.col("__mix_before")).withColumns(
        {"mix_block": F.expr(f"__mix_n div {block_rows}"), "mix_offset": F.expr(f"__mix_n % {block_rows}")}
    )
    numbered = numbered.withColumn("__mix_nth", F.expr("mix_block % __mix_units"))
    out = numbered.join(schedule, F.col(src).eqNullSafe(F.col("s_source")) & (F.col("__mix_nth") == F.col("nth")))
    return out.withColumns(
        {
            "mix_slot": F.expr("(mix_block div __mix_units) * __mix_total + s_slot"),
            "mix_release": F.expr("(mix_block * __mix_total) div __mix_units"),
            "mix_deadline": F.expr("((mix_block + 1) * __mix_total + __mix_units - 1) div __mix_units"),
        }
    ).select(*kept, *_NEW)
