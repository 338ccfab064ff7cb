"""Mixing sources to target weights by Pareto order sampling.

Every document gets an expected number of copies; its whole part is certain,
and the rest is an inclusion probability ``p``.  Documents are ranked by their
random odds divided by their inclusion odds, ``u (1 - p) / ((1 - u) p)``, and a
source takes its documents in that order up to its remaining size.  ``u`` is a
hash of the key, so reruns, other partitionings and retried tasks agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Steps of the rank scale; sizes are summed by step before any ordering, and
#: only the one step in which a source's size runs out is ordered by row.
STEPS = 1 << 14


def _ratio(num: int, den: int) -> Column:
    """A size limit per unit of weight, in exact integers, as a test."""
    most = F.col("source_size").cast("decimal(20,0)") * F.col("most") * 100 * F.lit(den).cast("decimal(12,0)")
    return most < F.col("weight") * F.lit(num).cast("decimal(30,0)")


def targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources take the weights in turn, by code point, null last.  They share
    ``percent`` of the total by weight; a target stops at ``most`` times its
    source's size, and the excess is shared again by weight until none is
    above.  Each sharing is one aggregate of sums over the sources.
    """
    # Sources are numbered range by range, so any number of them can be ranked.
    s = sizes.withColumn("last", F.col("source").isNull().cast("int"))
    s = cut(s.repartitionByRange("last", "source").withColumn("part", F.spark_partition_id()), "sources")
    before = s.groupBy("part").count().select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("last", "source")) - 1 + F.col("before")
    turn = F.pmod(place, F.lit(len(weights))).cast("int")
    s = cut(s.join(F.broadcast(before), "part").select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("int").alias("weight"),
        F.lit(most).alias("most")), "source-weights")
    total, every = s.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return s.select("source", "source_size", F.lit(0.0).alias("target"))
    num, den, stopped = percent * total, every, 0
    while den:
        above = _ratio(num, den)
        n, held, rest = s.agg(F.count(F.when(above, 1)), F.sum(F.when(above, F.col("source_size") * most)),
                              F.sum(F.when(~above, F.col("weight")))).first()
        if n == stopped:
            break
        num, den, stopped = percent * total - 100 * held, rest or 0, n
    at_most = (F.col("source_size") * most).cast("double")
    if not den:
        return s.select("source", "source_size", at_most.alias("target"))
    share = F.col("weight") * F.lit(float(num)) / F.lit(100.0 * den)
    return s.select("source", "source_size", F.when(_ratio(num, den), at_most).otherwise(share).alias("target"))


def _rates(d: DataFrame, goal: DataFrame, most: int) -> DataFrame:
    """``goal`` plus ``rate``: a source's expected copies per unit of odds, such
    that copies held at ``most`` still add up to its target."""
    by = d.groupBy("_mix_s").agg(F.sum(F.col("_mix_w") * F.col("_mix_z")).alias("open"))
    g = goal.join(by, F.col("source").eqNullSafe(F.col("_mix_s"))).withColumn(
        "rate", F.coalesce(F.col("target") / F.nullif(F.col("open"), F.lit(0.0)), F.lit(0.0)))
    g, held = cut(g.select("source", "source_size", "target", "rate"), "rates"), 0
    while True:
        x = d.join(g, F.col("_mix_s").eqNullSafe(F.col("source")))
        full = F.col("rate") * F.col("_mix_w") >= most
        again = cut(x.groupBy("source", "source_size", "target", "rate").agg(
            F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, F.col("_mix_z") * most).otherwise(0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_mix_w") * F.col("_mix_z"))).alias("open")), "rates")
        now = again.agg(F.sum("n")).first()[0] or 0
        if now == held:
            return g
        held = now
        rate = F.when(F.col("open") > 0, (F.col("target") - F.col("held")) / F.col("open")).otherwise(F.col("rate"))
        g = cut(again.select("source", "source_size", "target", rate.alias("rate")), "rates")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), percent: int = 150, most: int = 2, seed: str = "mix",
        id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", odds_col: str | None = None) -> DataFrame:
    """``docs`` rows with ``source_size, target, copies, taken`` (copies times size).

    ``size_col`` is a document's size (null: 0).  A document's expected copies
    are ``target / source_size``, or in proportion to a positive ``odds_col``,
    held at ``most``.  After the certain copies, a source takes documents in
    Pareto order while they fit what is left of its target, and then the one
    further document that brings it closest, if any brings it closer.  Rows of
    equal id and size in a source share a rank and a decision.  ``copies`` is
    at most ``most``.  A document of size 0 is ranked like any other.  A null
    source is a source, a null id an id.  Columns named like an added one, or
    like the internal ``_mix_*`` ones, are replaced.
    """
    d = docs.drop("source_size", "target", "copies", "taken")
    base = {"_mix_s": F.col(source_col), "_mix_i": F.col(id_col), "_mix_z": F.coalesce(F.col(size_col).cast("long"), F.lit(0)),
            "_mix_w": F.lit(1.0) if odds_col is None else F.col(odds_col).cast("double")}
    slim = cut(d.select(*[c.alias(n) for n, c in base.items()]), "mix-sizes")
    goal = cut(targets(slim.groupBy(F.col("_mix_s").alias("source")).agg(F.sum("_mix_z").alias("source_size")), weights, percent, most), "targets")
    goal = cut(_rates(slim, goal, most).select(F.col("source").alias("_mix_g"), "source_size", "target", F.col("rate").alias("_mix_rate")), "goals")

    digits = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("_mix_i").cast("string"), F.col("_mix_z").cast("string"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << 52)
    expected = F.least(F.lit(float(most)), F.col("_mix_rate") * F.col("_mix_w"))

    def ranked(x: DataFrame) -> DataFrame:
        """Adds the certain copies, the rank (null: no further copy) and its step."""
        x = x.join(goal, F.col("_mix_s").eqNullSafe(F.col("_mix_g"))).drop("_mix_g")
        x = x.withColumn("_mix_sure", F.floor(expected)).withColumn("_mix_p", expected - F.floor(expected))
        x = x.withColumn("_mix_u", u).withColumn("_mix_q", F.when(F.col("_mix_p") > 0, F.col("_mix_u") * (1 - F.col("_mix_p")) / ((1 - F.col("_mix_u")) * F.col("_mix_p"))))
        typical = F.col("_mix_rate") - F.floor("_mix_rate")
        scaled = F.col("_mix_q") * F.when(typical > 0, typical / (1 - typical)).otherwise(1.0)
        return x.withColumn("_mix_step", F.floor(scaled / (1 + scaled) * STEPS).cast("int"))

    r = ranked(slim)
    steps = cut(r.groupBy("_mix_s", "target", "_mix_step").agg(
        F.sum(F.when(F.col("_mix_q").isNotNull(), F.col("_mix_z")).otherwise(0)).alias("z"), F.sum(F.col("_mix_z") * F.col("_mix_sure")).alias("sure")), "mix-steps")
    one = Window.partitionBy("_mix_s")
    steps = (steps.withColumn("left", F.col("target") - F.sum("sure").over(one))
             .withColumn("before", F.sum("z").over(one.orderBy("_mix_step").rowsBetween(Window.unboundedPreceding, 0)) - F.col("z")))
    # the step in which the remaining target runs out (none: all are taken)
    stops = steps.where("_mix_step is not null and before + z > left").groupBy(F.col("_mix_s").alias("_mix_g")).agg(
        F.min(F.struct("_mix_step", "before", "left")).alias("m")).select("_mix_g", F.col("m._mix_step").alias("_mix_stop"), "m.before", "m.left")
    stops = cut(stops, "mix-stops")
    edge = r.join(stops, F.col("_mix_s").eqNullSafe(F.col("_mix_g"))).where("_mix_step >= _mix_stop")
    rank = F.struct("_mix_q", "_mix_i", "_mix_z")
    upto = F.sum("_mix_z").over(one.orderBy("_mix_q", "_mix_i", "_mix_z").rangeBetween(Window.unboundedPreceding, 0))
    at = cut(edge.where("_mix_step = _mix_stop").select("_mix_g", rank.alias("rank"), "before", "left", (F.col("before") + upto).alias("upto"))
             .groupBy("_mix_g", "before", "left").agg(F.max(F.when(F.col("upto") <= F.col("left"), F.struct("rank", "upto"))).alias("m"))
             .select("_mix_g", F.col("m.rank").alias("_mix_last"), (F.col("left") - F.coalesce("m.upto", "before")).alias("_mix_rest"),
                     F.lit(True).alias("_mix_short")), "mix-last")
    further = (edge.drop("_mix_g").join(at, F.col("_mix_s").eqNullSafe(F.col("_mix_g"))).where(F.col("_mix_last").isNull() | (rank > F.col("_mix_last")))
               .withColumn("_mix_far", F.abs(F.col("_mix_rest") - F.col("_mix_z"))).where("_mix_far < abs(_mix_rest)")
               .groupBy(F.col("_mix_s").alias("_mix_m")).agg(F.min(F.struct("_mix_far", "_mix_q", "_mix_i", "_mix_z")).alias("_mix_more")))
    ends = cut(stops.select("_mix_g", "_mix_stop").join(at.withColumnRenamed("_mix_g", "_mix_a"), F.col("_mix_g").eqNullSafe(F.col("_mix_a")))
               .join(further, F.col("_mix_g").eqNullSafe(F.col("_mix_m")), "left")
               .select(F.col("_mix_g").alias("_mix_e"), "_mix_stop", "_mix_last", F.struct("_mix_more._mix_q", "_mix_more._mix_i", "_mix_more._mix_z").alias("_mix_more")), "mix-ends")
    x = ranked(d.withColumns(base)).join(ends, F.col("_mix_s").eqNullSafe(F.col("_mix_e")), "left")
    inside = F.col("_mix_stop").isNull() | (F.col("_mix_step") < F.col("_mix_stop")) | F.coalesce((F.col("_mix_step") == F.col("_mix_stop")) & (rank <= F.col("_mix_last")), F.lit(False))
    extra = F.col("_mix_q").isNotNull() & (inside | rank.eqNullSafe(F.col("_mix_more")))
    x = x.withColumn("copies", (F.col("_mix_sure") + extra.cast("long")).cast("long")).withColumn("taken", F.col("copies") * F.col("_mix_z"))
    return x.drop(*base, "_mix_sure", "_mix_p", "_mix_u", "_mix_q", "_mix_step", "_mix_e", "_mix_stop", "_mix_last", "_mix_more", "_mix_rate")
