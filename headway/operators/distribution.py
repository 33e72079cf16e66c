"""Exact distribution statistics at any size.

All of them start from counts of values, which partial aggregation makes before the shuffle; a value
that fills a third of the table is one row per input task. Positions in the sorted order then come from
range-partitioned running counts, so no group, not even the whole table as one group, is ever gathered
or sorted in one task.

Quantiles need few of the values. A sketch brackets each wanted position, one more pass counts the values
inside the brackets and the rows between them, and running counts over these find the values and prove
that the positions lie inside. If one does not, the brackets get wider, in the end as wide as the column.
Columns of few distinct values are counted outright. Where the groups are too many to send their brackets to
all tasks, only the largest groups get brackets; the others, each a small share of the rows by then, meet by
group in one shuffle and are counted in place.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from headway.functions.columns import all_present, one_decimal_text
from headway.session import durable, shuffle_tasks

WAIT = "time_remaining_minutes"
PERCENTILES = (10, 25, 50, 75, 90, 95, 99)  # fixed values
PERCENTILE_HEADINGS = {"percentile": "Percentile", "wait_text": "Wait Time (min)"}  # fixed values
HISTOGRAM_BINS = 50  # fixed value
WHISKER = 1.5
RANK_BLOCK = 65_536  # ranks that one row unfolds to
ACCURACY = 5_000  # the sketch is off by one part of so many; smaller groups are taken whole
BROADCAST_BYTES = 8 << 20
ROW_BYTES = 512  # of a group's numbers, besides its keys
FEW_VALUES = BROADCAST_BYTES // ROW_BYTES // 4  # distinct values that are counted without a look at them first


def value_counts(df: DataFrame, value: str = WAIT, by: Iterable[str] = ()) -> DataFrame:
    """``n`` rows per distinct value, within ``by`` groups; null keys and null values left out."""
    keys = [*by, value]
    return df.filter(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _ranged(counts: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Counts cut into ranges of about equal length, numbered by ``slice``.

    Written once, since its readers need the same cuts.
    """
    ranged = counts.repartitionByRange(*by, value)
    return durable(ranged.withColumn("slice", F.spark_partition_id()))


def _running(
    ranged: DataFrame, value: str, by: Sequence[str], qs: Sequence[float] | None = None, half: bool = False
) -> DataFrame:
    """Running counts; with ``qs`` only of the slices that hold a group's ends or one of these positions."""
    # One row per (group, slice): a sum over slices handles no more rows than there are slices.
    slices = ranged.groupBy(*by, "slice").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *by,
        "slice",
        (F.coalesce(F.sum("held").over(earlier), F.lit(0).cast("bigint"))).alias("before"),
        "held",
        F.sum("held").over(Window.partitionBy(*by)).alias("total"),
    )
    if qs is not None:
        ends = offsets.withColumns({"upto": F.col("before") + F.col("held"), "n": F.col("held")})
        offsets = ends.filter(_holds(qs, half)).drop("upto", "n")
    inside = Window.partitionBy(*by, "slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(offsets, [*by, "slice"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .drop("slice", "before", "held")
    )


def _running_in_place(counts: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """The same where every group is small enough for one task."""
    group = Window.partitionBy(*by)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(group)})


def running_counts(df: DataFrame, value: str = WAIT, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with ``n``, ``upto`` (rows at or below the value) and ``total`` per group.

    Each range of values sums on its own and adds what the ranges before it hold.
    """
    counts = _running(_ranged(value_counts(df, value, by), value, by), value, by)
    return counts.select(*by, value, "n", "upto", "total")


def _position(q: float, half: bool = False, total: str = "total") -> str:
    """SQL of the place of a quantile among ``total`` rows in order, from 0.

    With ``half`` every row is the middle of its share of the distribution, and the ends are those of the rows.
    """
    if half:
        return f"greatest(least({float(q)!r}D * {total} - 0.5D, {total} - 1.0D), 0.0D)"
    return f"({float(q)!r}D * ({total} - 1))"


def _holds(qs: Sequence[float], half: bool = False) -> str:
    """SQL: whether the ``n`` rows up to rank ``upto`` hold an end, or a position on either side of ``qs``."""
    places = [_position(q, half) for q in qs]
    sides = [f"upto > floor({place}) AND upto - n <= ceil({place})" for place in places]
    return " OR ".join(["upto = n", "upto = total", *sides])


def _quantile(value: str, q: float, half: bool = False) -> Column:
    """Aggregate over running counts: the linearly interpolated quantile."""
    low = f"min(CASE WHEN upto > floor({_position(q, half)}) THEN `{value}` END)"
    high = f"min(CASE WHEN upto > ceil({_position(q, half)}) THEN `{value}` END)"
    share = _position(q, half, "max(total)")
    return F.expr(f"{low} + ({high} - {low}) * ({share} - floor({share}))")


def _brackets(df: DataFrame, value: str, by: Sequence[str], qs: Sequence[float], margin: float) -> DataFrame:
    """Per group an array of (lo, hi) brackets: the ends of the column, and a sketched one for each of ``qs``.

    A group of fewer than ``ACCURACY`` rows, where a rank is more than the sketch tells apart, is one bracket.
    """
    v = F.col(value)
    shares = [max(q - margin, 0.0) for q in qs] + [min(q + margin, 1.0) for q in qs]
    found = df.groupBy(*by).agg(
        F.min(v).alias("_least"),
        F.max(v).alias("_greatest"),
        F.count(v).alias("_rows"),
        F.percentile_approx(value, shares, ACCURACY).alias("_at"),
    )
    least, greatest, at = F.col("_least"), F.col("_greatest"), F.col("_at")
    whole = F.col("_rows") < ACCURACY
    columns = [least.alias("_lo0"), F.when(whole, greatest).otherwise(least).alias("_hi0")]
    for i, q in enumerate(qs):
        lo = least if q <= margin else F.when(whole, least).otherwise(at[i])
        hi = greatest if q >= 1 - margin else F.when(whole, greatest).otherwise(at[len(qs) + i])
        columns += [lo.alias(f"_lo{i + 1}"), hi.alias(f"_hi{i + 1}")]
    columns += [greatest.alias(f"_lo{len(qs) + 1}"), greatest.alias(f"_hi{len(qs) + 1}"), F.col("_rows")]
    return found.select(*by, *columns)


def _narrowed(df: DataFrame, value: str, by: Sequence[str], brackets: DataFrame, wide: int) -> DataFrame:
    """Counts of the values in the brackets; ``own`` rows have the value, the rest of ``n`` lie in the gap after it."""
    names = [f"_{end}{i}" for i in range(wide) for end in ("lo", "hi")]
    if by:
        # The caller has checked the size of this side.
        rows, edge = df.join(F.broadcast(brackets), list(by)), ""
    else:
        rows, edge = df.withColumn("_edges", brackets.select(F.struct(*names)).scalar()), "_edges."
    inside = " OR ".join(f"`{value}` BETWEEN {edge}_lo{i} AND {edge}_hi{i}" for i in range(wide))
    gap = ", ".join(f"CASE WHEN `{value}` > {edge}_hi{i} THEN {edge}_hi{i} END" for i in range(wide))
    placed = rows.select(
        *by, F.expr(f"CASE WHEN {inside} THEN `{value}` ELSE greatest({gap}) END AS `{value}`"), F.expr(f"{inside} AS own")
    )
    return placed.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("own"))


def _found(running: DataFrame, value: str, by: Sequence[str], qs: Sequence[float], half: bool) -> DataFrame:
    """The quantiles of running counts, and whether one lies among values that were not looked at."""
    sides = [f"{side}({_position(q, half)})" for q in qs for side in ("floor", "ceil")]
    missed = " OR ".join(f"upto - n + own <= {x} AND {x} < upto" for x in sides)
    return running.filter(_holds(qs, half)).groupBy(*by).agg(
        *[_quantile(value, q, half).alias(f"p{i}") for i, q in enumerate(qs)],
        F.min(value).alias("least"),
        F.max(value).alias("greatest"),
        F.max("total").alias("total"),
        F.max(F.expr(missed)).alias("missed"),
    )


def _group_bytes(by: Sequence[str]) -> Column:
    return sum((F.octet_length(F.col(c).cast("string")) for c in by), F.lit(ROW_BYTES))


def _largest(brackets: DataFrame, by: Sequence[str], rows: int, size: int) -> DataFrame:
    """The largest groups, as many as can be sent to all tasks.

    Groups of ``least`` rows or more are at most ``rows / least``, so those left out are a small share of all rows.
    """
    groups = brackets.count()
    least = max(-(-rows * (size // groups) // max(BROADCAST_BYTES, 1)), ACCURACY)
    while True:
        large = brackets.filter(F.col("_rows") >= least)
        if (large.agg(F.sum(_group_bytes(by))).first()[0] or 0) <= BROADCAST_BYTES:
            return large
        least *= 2  # their keys are longer than the average


def _quantiles(
    df: DataFrame, value: str, by: Sequence[str], qs: Sequence[float], half: bool = False
) -> tuple[DataFrame, bool]:
    """Per group ``p0``, ``p1`` ... for ``qs``, ``least``, ``greatest`` and ``total``; whether the groups are few.

    Few groups are those whose numbers fit ``BROADCAST_BYTES``.
    """
    by = list(by)
    df = df.filter(all_present([*by, value])).select(*by, value)
    rows, distinct = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*by, value))).first()
    if distinct <= FEW_VALUES:
        counts = value_counts(df, value, by).withColumn("own", F.col("n"))
        return _found(_running_in_place(counts, value, by), value, by, qs, half).drop("missed"), True
    margin, rest = 3 / ACCURACY, None
    while True:
        brackets = _brackets(df, value, by, qs, margin)
        if by:
            seen = Observation()
            brackets = durable(brackets.observe(seen, F.sum(_group_bytes(by)).alias("bytes")))
            size = seen.get["bytes"] or 0
            if size > BROADCAST_BYTES:
                brackets = durable(_largest(brackets, by, rows, size))
                others = df.join(F.broadcast(brackets.select(*by)), by, "left_anti")
                # Values that repeat shrink before they move; others move once.
                if 2 * distinct > rows:
                    others = others.repartition(*by)
                counts = value_counts(others, value, by).withColumn("own", F.col("n"))
                rest = durable(_found(_running_in_place(counts, value, by), value, by, qs, half).drop("missed"))
                df = df.join(F.broadcast(brackets.select(*by)), by, "left_semi")
        counts = _narrowed(df, value, by, brackets, len(qs) + 2)
        found = _found(_running(_ranged(counts, value, by), value, by, qs, half), value, by, qs, half)
        seen = Observation()
        found = durable(found.observe(seen, F.coalesce(F.max("missed"), F.lit(False)).alias("missed")))
        if not seen.get["missed"]:
            found = found.drop("missed")
            return (found, True) if rest is None else (found.unionAll(rest), False)
        margin *= 16


def percentiles(
    df: DataFrame,
    ps: Sequence[int] = PERCENTILES,
    value: str = WAIT,
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Percentiles as rows ``(percentile, wait_minutes, wait_text)``, within ``by`` groups.

    Exact with linear interpolation, worked out when called; with ``accuracy`` Spark's sketch is used
    instead, in one lazy pass.
    """
    if accuracy:
        sketch = F.percentile_approx(value, [p / 100 for p in ps], accuracy)
        rows = df.filter(all_present([*by, value])).groupBy(*by).agg(sketch.alias("found"))
        values = [F.try_element_at("found", F.lit(i + 1)) for i in range(len(ps))]
    else:
        qs = [p / 100 for p in ps]
        rows, _ = _quantiles(df, value, by, qs)
        values = [F.col(f"p{i}") for i in range(len(ps))]
    entries = F.array(
        *[
            F.struct(F.lit(f"{p}th").alias("percentile"), v.cast("double").alias("wait_minutes"))
            for p, v in zip(ps, values)
        ]
    )
    return rows.select(*by, F.inline(entries)).withColumn(
        "wait_text", one_decimal_text(F.col("wait_minutes"))
    )


def cdf_steps(df: DataFrame, value: str = WAIT) -> DataFrame:
    """The empirical distribution function at each distinct value.

    Rows without a value have no rank but count in the denominator.
    """
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return running_counts(df, value).select(
        value, "n", F.col("upto").alias("cumulative"), (F.col("upto") / rows).alias("probability")
    )


def cdf(df: DataFrame, value: str = WAIT) -> DataFrame:
    """``(value, probability)`` per row: rank in sorted order, ties in any order, over all rows.

    Equal values are told apart only by their ranks, so the ranks are unfolded from the running
    counts and the rows themselves are never sorted. The ranks of one value unfold in blocks, spread
    over tasks, so a value with very many rows is neither one array nor one task.
    """
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    step = F.lit(RANK_BLOCK).cast("bigint")
    # Blocks of blocks first: neither level makes a long array of a value with very many rows.
    wide = step * step
    areas = running_counts(df, value).select(
        value, "upto", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"), wide)).alias("area")
    )
    end = F.least(F.col("area") + wide - 1, F.col("upto"))
    blocks = areas.select(value, "upto", F.explode(F.sequence("area", end, step)).alias("first"))
    # A block is a few bytes that unfold to many rows, so the number of tasks is stated: adaptive
    # execution would merge by bytes.
    last = F.least(F.col("first") + step - 1, F.col("upto"))
    ranked = blocks.repartition(shuffle_tasks(df.sparkSession), value, "first").select(
        value, F.explode(F.sequence("first", last)).alias("rank")
    )
    unranked = df.filter(F.col(value).isNull()).select(value, F.lit(None).cast("bigint").alias("rank"))
    return ranked.unionByName(unranked).select(value, (F.col("rank") / rows).alias("probability"))


def _nice_step(lo: Column, hi: Column, bins: int) -> Column:
    """(digit, power) of the least step of 1, 2 or 5 times a power of ten that cuts lo to hi in at most ``bins`` bins."""
    rough = (hi - lo) / F.lit(bins)
    start = F.floor(F.log10(rough)).cast("int")
    steps = F.array(
        *[
            F.struct(F.lit(float(digit)).alias("digit"), (start + more).alias("power"))
            for digit, more in ((5, -1), (1, 0), (2, 0), (5, 0), (1, 1), (2, 1))
        ]
    )
    fits = F.filter(steps, lambda step: _nice_bin(hi, step) - _nice_bin(lo, step) < bins)
    one = F.struct(F.lit(1.0).alias("digit"), F.lit(0).alias("power"))
    return F.when(rough > 0, F.try_element_at(fits, F.lit(1))).otherwise(one)


def _nice_bin(v: Column, step: Column) -> Column:
    """The number of the step that ``v`` lies in; powers of ten are whole numbers, so that edges are not missed."""
    power = step.getField("power")
    whole = F.when(power < 0, v * F.pow(F.lit(10.0), -power)).otherwise(v / F.pow(F.lit(10.0), power))
    return F.floor(whole / step.getField("digit")).cast("bigint")


def _nice_edge(number: Column, step: Column) -> Column:
    power, units = step.getField("power"), number * step.getField("digit")
    return F.when(power < 0, units / F.pow(F.lit(10.0), -power)).otherwise(units * F.pow(F.lit(10.0), power))


def histogram(df: DataFrame, bins: int = HISTOGRAM_BINS, value: str = WAIT, nice: bool = False) -> DataFrame:
    """Rows per bin of equal width between the least and greatest value; the last bin is closed.

    With ``nice`` bins are as charts draw them: their width is 1, 2 or 5 times a power of ten, the least that
    gives at most ``bins`` (two or more), they begin at multiples of it, are numbered from the first and all open
    at the end. Empty bins do not appear.
    """
    if nice and bins < 2:
        raise ValueError("values on both sides of a multiple need two bins")
    v = F.col(value).cast("double")
    known = df.filter(F.col(value).isNotNull())
    ends = known.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")))
    if nice:
        step = _nice_step(F.col("ends.lo"), F.col("ends.hi"), bins)
        ends = ends.toDF("ends").withColumn("step", step)
        chosen = ends.select(F.struct("step", _nice_bin(F.col("ends.lo"), F.col("step")).alias("first"))).scalar()
        step = chosen.getField("step")
        counts = known.groupBy(_nice_bin(v, step).alias("number")).agg(F.count(F.lit(1)).alias("n"))
        return counts.select(
            (F.col("number") - chosen.getField("first")).alias("bin"),
            _nice_edge(F.col("number"), step).alias("bin_start"),
            _nice_edge(F.col("number") + 1, step).alias("bin_end"),
            "n",
        )
    ends = ends.scalar()
    lo = ends.getField("lo")
    width = (ends.getField("hi") - lo) / F.lit(bins)
    number = F.when(width > 0, F.least(F.floor((v - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = known.groupBy(number.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
    )


def box_stats(df: DataFrame, by: Sequence[str] = (), value: str = WAIT, chart: bool = False) -> DataFrame:
    """Box-plot summary per group: ends, quartiles, and whiskers within 1.5 quartile ranges.

    With ``chart`` as charts draw them: quartiles where every row is the middle of its share (place q * n - 1/2
    from 0, interpolated), and whiskers that never end inside the box.
    """
    by = list(by)
    rows, few = _quantiles(df, value, by, [0.25, 0.5, 0.75], half=chart)
    boxes = rows.select(
        *by,
        F.col("least").cast("double").alias("least"),
        F.col("p0").alias("q1"),
        F.col("p1").alias("median"),
        F.col("p2").alias("q3"),
        F.col("greatest").cast("double").alias("greatest"),
        F.col("total").alias("n"),
    )
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    fences = boxes.select(*by, (F.col("q1") - reach).alias("fence_lo"), (F.col("q3") + reach).alias("fence_hi"))
    ends = [F.min(value).cast("double").alias("whisker_low"), F.max(value).cast("double").alias("whisker_high")]
    fields = ["least", "whisker_low", "q1", "median", "q3", "whisker_high", "greatest", "n"]
    outside = {
        "whisker_low": F.least("whisker_low", "q1"),
        "whisker_high": F.greatest("whisker_high", "q3"),
    }

    def drawn(boxes: DataFrame) -> DataFrame:
        return boxes.withColumns(outside) if chart else boxes

    if not by:
        fence = fences.select(F.struct("fence_lo", "fence_hi")).scalar()
        inside = df.filter(F.col(value).between(fence.getField("fence_lo"), fence.getField("fence_hi")))
        whisker = inside.agg(F.struct(*ends)).scalar()
        names = ("whisker_low", "whisker_high")
        return drawn(boxes.withColumns({name: whisker.getField(name) for name in names})).select(*fields)
    # The fences have the size that the brackets had; where that was too much, distinct values are joined.
    met = df.select(*by, value).join(F.broadcast(fences), by) if few else value_counts(df, value, by).join(fences, by)
    whiskers = met.filter(F.col(value).between(F.col("fence_lo"), F.col("fence_hi"))).groupBy(*by).agg(*ends)
    # No row may lie between the fences where two are far apart; then the box has no whiskers.
    return drawn(boxes.join(whiskers, by, "left")).select(*by, *fields)
