"""Exact percentiles of groups of any size, and the rate statistics built on them.

The built-in ``percentile`` keeps every distinct value of a group in one task. A city may hold a
third of all rows, so groups are never gathered here:

1. equal values are counted once, at the finest key; everything later works on these counts;
2. they are added up per (group, cell), where cells are fine, order-keeping slices of the value
   axis; partial aggregation shrinks a hot group to its few thousand occupied cells before the shuffle;
3. running counts over the cells tell which cells hold the wanted ranks;
4. where a rank is a cell's first or last value, or the cell holds one distinct value, the cell's
   minimum or maximum is the answer; the counts of the cells left over are ranked value by value.

The number of cells of a group is bounded by the value axis, not by the data. A rate belongs to a
group for each level, period and distribution; for step 4, counts first meet the cells that any
group of their key left over, once per level, and only those that do are spread over groups again.

Cells save nothing where a key has few rows, as then nearly every value has a cell of its own. Rates are
therefore counted per key first. Rows of keys up to ``GATHERED`` rows are shuffled once, by key, and ranked
value by value where they then are; only larger keys go the way above.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deedmill.config import DEFAULTS, NON_BHK_LABELS, Settings
from deedmill.functions.values import round2
from deedmill.operators.levels import BEDROOM, GRAINS, LEVELS, PERIOD_KEY, PROPERTY, SEGMENT_KEY, Level, by_key, chosen, masks
from deedmill.operators.levels import parts as parts_of

# Any number gives the same results: few make counts small, many leave fewer values to be looked into.
CELLS_PER_OCTAVE = 32
# Rows of a key that are ranked in one task at most.
GATHERED = 300_000

# Given a frame and a name, the frame, perhaps staged.
Keep = Callable[[DataFrame, str], DataFrame]


def _cell(v: Column) -> Column:
    """Slice number of a value: logarithmic away from zero and never decreasing in the value."""
    steps = F.floor(F.log2(F.abs(v) + 1) * CELLS_PER_OCTAVE)
    return F.when(v < 0, -steps).otherwise(steps).cast("int")


def exact_percentiles(
    rows: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], mean: str | None = None
) -> DataFrame:
    """Linearly interpolated percentiles per group, plus count ``n`` and optionally the mean.

    ``probabilities`` names the output columns. Null values are left out. Keys may be null.
    """
    rows = rows.filter(F.col(value).isNotNull())
    counted = rows.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.select(F.xxhash64(*keys).alias("_hash"), "*", _cell(F.col("_v")).alias("_cell"))
    # Sorting by a hash first settles nearly every comparison without looking at the keys.
    keys = ["_hash", *keys]

    def reread(left_over: DataFrame) -> DataFrame:
        side = left_over.toDF(*[f"_k_{c}" if c in keys or c == "_cell" else c for c in left_over.columns])
        return counted.join(side, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*keys, "_cell"]]))

    return percentiles_of_counts(counted, keys, probabilities, mean, reread).drop("_hash")


def percentiles_of_counts(
    entries: DataFrame,
    keys: list[str],
    probabilities: dict[str, float],
    mean: str | None,
    reread: Callable[[DataFrame], DataFrame],
    keep: Keep = lambda df, name: df,
) -> DataFrame:
    """Percentiles of values ``_v`` that occur ``_n`` times, in cells ``_cell``, in groups of ``keys``.

    ``reread`` gets (keys, _cell and what has to be carried along) for the cells that must be looked
    into, and returns their values and counts with it. ``keep`` may stage the cells with wanted ranks,
    a few per group, which several steps read.
    """
    cells = entries.groupBy(*keys, "_cell").agg(
        F.sum("_n").alias("_n"),
        F.sum(F.col("_v") * F.col("_n")).alias("_sum"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    group = W.partitionBy(*keys)
    running = group.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    # The running count first: its sort order then serves the totals as well.
    ranked = cells.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    ranked = ranked.withColumns({"_total": F.sum("_n").over(group), "_sum": F.sum("_sum").over(group)})

    bounds = [_rank(p, upper) for p in probabilities.values() for upper in (False, True)]
    wanted = F.array_distinct(F.array(*bounds))
    first, end = F.col("_before"), F.col("_before") + F.col("_n")
    hits = ranked.withColumn("_ranks", F.filter(wanted, lambda r: (r >= first) & (r < end))).filter(F.size("_ranks") > 0)
    # Array of (rank, value); the value is null where the cell must be looked into.
    one = F.col("_min") == F.col("_max")
    known = F.transform(
        "_ranks",
        lambda r: F.struct(r.alias("rank"), F.when(one | (r == first), F.col("_min")).when(r == end - 1, F.col("_max")).alias("v")),
    )
    hits = keep(hits.select(*keys, "_cell", "_total", "_sum", "_before", known.alias("_known")), "hits")
    settled = hits.select(*keys, "_total", "_sum", F.explode("_known").alias("_k")).filter("_k.v IS NOT NULL")
    settled = settled.select(*keys, "_total", "_sum", F.col("_k.rank").alias("_rank"), F.col("_k.v").alias("_v"))
    opened = F.transform(F.filter("_known", lambda k: k["v"].isNull()), lambda k: k["rank"])
    left_over = hits.withColumn("_open", opened).filter(F.size("_open") > 0)
    left_over = left_over.select(*keys, "_cell", "_total", "_sum", "_before", "_open")
    carried = ["_total", "_sum", "_before", "_open"]
    values = reread(left_over).groupBy(*keys, "_cell", "_v").agg(F.sum("_n").alias("_n"), *[F.first(c).alias(c) for c in carried])
    within = W.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    found = (
        values.withColumn("_end", F.col("_before") + F.sum("_n").over(within))
        .withColumn("_rank", F.explode("_open"))
        .filter((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
        .select(*keys, "_total", "_sum", "_rank", "_v")
    )

    def at(p: float, upper: bool) -> Column:
        return F.max(F.when(F.col("_rank") == _rank(p, upper), F.col("_v")))

    ends = [at(p, upper).alias(f"_{name}_{upper}") for name, p in probabilities.items() for upper in (False, True)]
    picked = settled.unionByName(found).groupBy(*keys).agg(F.max("_total").alias("_total"), F.max("_sum").alias("_sum"), *ends)

    return _interpolated(picked, keys, probabilities, mean, F.col("_sum") / F.col("_total"))


def _interpolated(picked: DataFrame, keys: list[str], probabilities: dict[str, float], mean: str | None, average: Column) -> DataFrame:
    """Percentiles between the values of the ranks below and above."""

    def between(name: str, p: float) -> Column:
        low, high = F.col(f"_{name}_False"), F.col(f"_{name}_True")
        position = F.lit(p) * (F.col("_total") - 1)
        return low + (high - low) * (position - F.floor(position))

    out = [between(name, p).alias(name) for name, p in probabilities.items()]
    if mean:
        out.append(average.alias(mean))
    return picked.select(*keys, F.col("_total").alias("n"), *out)


def _rank(p: float, upper: bool) -> Column:
    position = F.lit(p) * (F.col("_total") - 1)
    return (F.ceil(position) if upper else F.floor(position)).cast("bigint")


def percentiles_in_place(entries: DataFrame, keys: list[str], probabilities: dict[str, float], mean: str | None) -> DataFrame:
    """Percentiles of values ``_v`` in groups of ``keys`` whose rows each are in one partition already.

    A group's values are one array, so groups must be small.
    """
    listed = entries.groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_vs"), F.avg("_v").alias("_mean"))
    listed = listed.withColumn("_total", F.size("_vs").cast("bigint"))
    ends = {f"_{name}_{upper}": F.get("_vs", _rank(p, upper).cast("int")) for name, p in probabilities.items() for upper in (False, True)}
    return _interpolated(listed.withColumns(ends), keys, probabilities, mean, F.col("_mean"))


def floor_bucket(settings: Settings = DEFAULTS) -> Column:
    """Lower end of the floor bucket; null for missing and negative floors."""
    floor, step = F.col("floor_no"), settings.floor_step
    return F.when(floor >= 0, (F.floor(floor / step) * step).cast("int"))


# Distribution -> (segment kind, value column, split by floor bucket)
DISTRIBUTIONS = {
    "rate_nca_pt": (PROPERTY, "rate_on_net_ca", False),
    "rate_sa_pt": (PROPERTY, "rate_on_sa", False),
    "rate_nca_bhk": (BEDROOM, "rate_on_net_ca", False),
    "floor_pt": (PROPERTY, "rate_on_net_ca", True),
}
DIST_KEY = [*PERIOD_KEY, "dist", "kind", "segment", "floor_from"]


def rates(df: DataFrame, levels: Iterable[Level] = LEVELS, names: Iterable[str] = tuple(DISTRIBUTIONS), settings: Settings = DEFAULTS) -> DataFrame:
    """The rates of rows that count for any of the levels, with quarter, segments and floor bucket.

    ``_key_<i>`` is the row's key at the level of that place, null where it does not count. Rows need a positive price
    and area, hence a positive rate.
    """
    levels, names = list(levels), list(names)
    kinds = list(dict.fromkeys(DISTRIBUTIONS[n][0] for n in names))
    columns = list(dict.fromkeys(DISTRIBUTIONS[n][1] for n in names))
    by_floor = any(DISTRIBUTIONS[n][2] for n in names)
    targets = [F.when(x.rows(), x.key_id()).alias(f"_key_{i}") for i, x in enumerate(levels)]
    rows = df.filter((F.col("property_category") == "Sale") & masks()["valid_rate"]).select(
        "city", "year", "quarter", *kinds, *targets,
        (floor_bucket(settings) if by_floor else F.lit(None).cast("int")).alias("_floor"), *columns,
    )
    return rows.filter(F.coalesce(*[F.col(f"_key_{i}") for i in range(len(levels))]).isNotNull())


PROBABILITIES = {"p50": 0.5, "p75": 0.75, "p80": 0.8, "p90": 0.9}


def percentile_name(p: float) -> str:
    return f"p{p * 100:.10g}".replace(".", "_")


def rate_percentiles(
    df: DataFrame,
    levels: Iterable[Level] = LEVELS,
    names: Iterable[str] = tuple(DISTRIBUTIONS),
    settings: Settings = DEFAULTS,
    probabilities: dict[str, float] = PROBABILITIES,
    grains: Iterable[str] = GRAINS,
    keep: Keep = lambda df, name: df,
    parts: int | None = None,
) -> DataFrame:
    """Unrounded mean and percentiles of all asked-for rate distributions in one pass.

    The levels' prevailing percentiles are among them. Level, grain and distribution travel as
    small numbers, places in the lists passed in. ``keep`` may stage the counted rates and the
    cells with wanted ranks, which are read more than once. Rates of small keys are in as many ``parts``.
    """
    small, large = split_rate_percentiles(df, levels, names, settings, probabilities, grains, keep, parts)
    return small if large is None else small.unionByName(large)


def split_rate_percentiles(
    df: DataFrame,
    levels: Iterable[Level],
    names: Iterable[str],
    settings: Settings,
    probabilities: dict[str, float],
    grains: Iterable[str],
    keep: Keep,
    parts: int | None,
) -> tuple[DataFrame, DataFrame | None]:
    """`rate_percentiles` of small keys, each in one of so many parts, and of large ones, if there are any."""
    levels, names, grains = list(levels), list(names), list(grains)
    probabilities = probabilities | {percentile_name(x.prevailing_percentile): x.prevailing_percentile for x in levels}
    columns = list(dict.fromkeys(DISTRIBUTIONS[n][1] for n in names))
    counted = keep(rates(df, levels, names, settings), "rates")
    parts = parts_of(counted, levels) if parts is None else parts
    targets = [F.struct(F.lit(i).alias("_level"), F.col(f"_key_{i}").alias("key_id")) for i in range(len(levels))]
    per_level = counted.withColumn("_target", F.explode(F.array(*targets))).filter("_target.key_id IS NOT NULL")
    fine = ["city", "year", "quarter", "_floor", *[c for c in (PROPERTY, BEDROOM) if c in counted.columns]]
    per_level = per_level.select(*fine, "_target.*", *columns)
    # At most one key for each GATHERED rows.
    sizes = per_level.groupBy("_level", "key_id").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > GATHERED)
    large = keep(sizes.select(F.col("_level").alias("_large_level"), F.col("key_id").alias("_large_key")), "large")
    mine = (F.col("_level") == F.col("_large_level")) & (F.col("key_id") == F.col("_large_key"))
    small = per_level if (none_large := large.isEmpty()) else per_level.join(F.broadcast(large), mine, "left_anti")

    none = F.lit(None).cast("int")
    period = {"Overall": F.lit("Overall"), "YoY": F.col("year").cast("string"), "QoQ": F.col("quarter")}
    place = ["city", "_level", "key_id"]
    inner = ["_tag", "segment", "floor_from", "period"]

    def spread(rows: DataFrame) -> DataFrame:
        """An entry for each group that a row belongs to. Rows are spread by a number, as texts would be copied for each."""
        tags, grouped = [], []
        for d, name in enumerate(names):
            kind, value, by_floor = DISTRIBUTIONS[name]
            fits = F.col(kind).isNotNull() & F.col(value).isNotNull()
            if kind == BEDROOM:
                fits = fits & ~F.col(kind).isin(NON_BHK_LABELS)
            if by_floor:
                fits = fits & F.col("_floor").isNotNull()
            for grain in grains:
                tags.append(F.when(fits & period[grain].isNotNull(), F.lit(len(tags))))
                grouped.append((F.col(kind), F.col("_floor") if by_floor else none, period[grain], F.col(value)))
        entries = rows.withColumn("_tag", F.explode(F.array(*tags))).filter("_tag IS NOT NULL")
        made = zip(("segment", "floor_from", "period", "_v"), zip(*grouped, strict=True), strict=True)
        entries = entries.select(*place, "_tag", *[chosen(F.col("_tag"), list(options)).alias(c) for c, options in made])
        # Sorting by a hash first settles nearly every comparison without looking at the other keys.
        return entries.select(F.xxhash64(*place, *inner).alias("_hash"), *entries.columns)

    keys = ["_hash", *place, *inner]
    halves = [percentiles_in_place(spread(by_key(small, parts)), keys, probabilities, "mean")]
    if not none_large:
        halves.append(_large_percentiles(per_level.join(F.broadcast(large), mine, "left_semi"), spread, columns, keys, probabilities, keep))

    def named(options: list[str], column: str) -> Column:
        return F.element_at(F.lit(options), F.col(column) + 1)

    columns_of = {
        "level": named([x.name for x in levels], "_level"),
        "grain": named([g for _ in names for g in grains], "_tag"),
        "dist": named([n for n in names for _ in grains], "_tag"),
        "kind": named([DISTRIBUTIONS[n][0] for n in names for _ in grains], "_tag"),
    }
    out = [half.withColumns(columns_of).select(*DIST_KEY, "n", *probabilities, "mean") for half in halves]
    return out[0], out[1] if len(out) > 1 else None


def _large_percentiles(
    rows: DataFrame, spread: Callable[..., DataFrame], columns: list[str], keys: list[str], probabilities: dict[str, float], keep: Keep
) -> DataFrame:
    """Percentiles of large keys by cells."""
    entry = ["_cell", "_n"]

    def celled(entries: DataFrame) -> DataFrame:
        return entries.withColumns({"_cell": _cell(F.col("_v")), "_n": F.lit(1)}).select(*keys, "_v", *entry)

    def reread(left_over: DataFrame) -> DataFrame:
        # First the rows with a rate in a cell that any group of their key wants, then the groups.
        some = left_over.groupBy("_level", "key_id").agg(F.collect_set("_cell").alias("_some")).toDF("_s_level", "_s_key", "_some")
        wanted = reduce(or_, [F.coalesce(F.array_contains("_some", _cell(F.col(c))), F.lit(False)) for c in columns])
        near = rows.join(some, (F.col("_level") == F.col("_s_level")) & (F.col("key_id") == F.col("_s_key")) & wanted, "left_semi")
        side = left_over.toDF(*[f"_k_{c}" if c in keys or c == "_cell" else c for c in left_over.columns])
        same = (F.col("_hash") == F.col("_k__hash")) & (F.col("_cell") == F.col("_k__cell"))
        return celled(spread(near)).join(side, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys[1:]], same))

    return percentiles_of_counts(celled(spread(rows)), keys, probabilities, "mean", reread, keep)


def rate_stats(percentiles: DataFrame, name: str) -> DataFrame:
    """Mean, median, p75 and p90 per segment. The mean is a plain one."""
    suffix = "rate_sa" if name == "rate_sa_pt" else "rate_nca"
    return percentiles.filter(F.col("dist") == name).select(
        *SEGMENT_KEY,
        round2(F.col("mean")).alias(f"wt_avg_{suffix}"),
        *[round2(F.col(p)).alias(f"{p}_{suffix}") for p in ("p50", "p75", "p90")],
    )


def floor_label(settings: Settings = DEFAULTS) -> Column:
    low = F.col("floor_from")
    return F.concat(low.cast("string"), F.lit("-"), (low + settings.floor_step).cast("string"))


def floor_wise_p90(percentiles: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """90th percentile of the rate per floor bucket."""
    return percentiles.filter(F.col("dist") == "floor_pt").select(
        *SEGMENT_KEY, floor_label(settings).alias("bucket"), round2(F.col("p90")).alias("value")
    )


def with_prevailing(percentiles: DataFrame, levels: Iterable[Level] = LEVELS) -> DataFrame:
    """Adds the band around the level's prevailing percentile, as text "low-high"."""
    text = None
    for level in levels:
        column = percentile_name(level.prevailing_percentile)
        low, high = (
            (F.col(column) * factor).cast("bigint").cast("string")
            for factor in (1 - level.prevailing_band, 1 + level.prevailing_band)
        )
        band = F.concat(low, F.lit("-"), high)
        mine = F.col("level") == level.name
        text = F.when(mine, band) if text is None else text.when(mine, band)
    return percentiles.withColumn("most_prevailing_rate_range", text)


def prevailing_rates(percentiles: DataFrame, levels: Iterable[Level] = LEVELS) -> DataFrame:
    rates = percentiles.filter(F.col("dist") == "rate_nca_pt")
    return with_prevailing(rates, levels).select(*SEGMENT_KEY, "most_prevailing_rate_range")


def chart_p90(percentiles: DataFrame) -> DataFrame:
    """90th percentile as drawn in charts: two decimals, but a lone value stays as it is."""
    return percentiles.filter(F.col("dist") == "rate_nca_pt").select(
        *SEGMENT_KEY, F.when(F.col("n") == 1, F.col("p90")).otherwise(round2(F.col("p90"))).alias("p90_rate")
    )
