"""Distributions over area, price, rate and buyer age.

``range_cells`` makes one pass over the transactions and counts, for every block asked for, the
cell or bucket each row falls in. Everything later works on those counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deedmill.config import DEFAULTS, Settings
from deedmill.functions import bins, exact
from deedmill.functions.values import round2
from deedmill.operators.levels import (
    BEDROOM,
    GRAINS,
    LEVEL_KEY,
    LEVELS,
    PROPERTY,
    SEGMENT_KEY,
    Level,
    by_grain,
    by_group,
    by_key,
    by_level,
    by_segment,
    masks,
    period_columns,
)
from deedmill.operators.levels import parts as parts_of
from deedmill.operators.prepare import with_city_params

BLOCKS = ("area", "price", "rate", "age")
# Rows of a key that are put into buckets one by one at most. More rows share enough cells to be counted before their shuffle.
GATHERED = 20_000
# Block -> amount whose mean centres its bins
CENTRING = {"area": "carpet", "price": "price", "rate": "rate"}


def _centring(blocks: Iterable[str]) -> list[str]:
    """The sums that means are taken of."""
    amounts = [CENTRING[b] for b in blocks if b in CENTRING]
    if "area" in blocks:
        return ["n", "n_priced", *[name for amount in [*amounts, "carpet_priced"] for name in exact.names(amount)]]
    return ["n", *[name for amount in amounts for name in exact.names(amount)]]


def _sums(blocks: Iterable[str]) -> list[str]:
    """The sums that the blocks need."""
    counts, amounts = ["n"], ["price", "carpet"]
    if "area" in blocks:
        counts, amounts = [*counts, "n_priced"], [*amounts, "price_priced", "carpet_priced"]
    if "rate" in blocks:
        amounts.append("rate")
    return [*counts, *[name for amount in amounts for name in exact.names(amount)]]


def _cells(block: str, settings: Settings, centred: bool, fixed: bool) -> Column:
    """Array of (block, cell, bucket) entries of one row; null entries are no members.

    Levels with bins around the mean go on with the cell, the others with the number of the fixed bucket.
    """
    price, carpet, rate = F.col("agreement_price"), F.col("carpet_sqft"), F.col("rate_on_net_ca")
    named, none = masks(), F.lit(None).cast("bigint")
    if block == "age":
        number = lambda a: bins.age_bucket(a, settings).cast("bigint")
        return F.transform("age", lambda a: F.struct(F.lit("age").alias("block"), number(a).alias("cell"), number(a).alias("bucket")))
    if block == "area":
        member = named["valid_area"] & named["valid_carpet"]
        cell = bins.plain_cell(carpet, bins.area_cell(settings))
        bucket = partial(bins.fixed_area, carpet, F.col("min_area"), F.col("max_area"), settings.area_step)
    elif block == "price":
        member = named["valid_price"]
        cell = bins.price_cell(price, settings.price_step)
        bucket = partial(bins.fixed_price, price, F.col("min_price"), F.col("max_price"), settings.price_step)
    elif block == "rate":
        member = named["valid_rate"] & (rate > 0)
        cell = bins.plain_cell(rate, settings.rate_step)
        bucket = partial(bins.fixed_rate, rate, F.col("min_rate"), F.col("max_rate"), settings.rate_step)
    else:
        raise ValueError(f"unknown block '{block}'")
    cell = cell.cast("bigint") if centred else none
    number = bucket().cast("bigint") if fixed else none
    entry = F.struct(F.lit(block).alias("block"), cell.alias("cell"), number.alias("bucket"))
    return F.array(F.when(member & F.coalesce(cell, number).isNotNull(), entry))


def range_cells(
    df: DataFrame,
    blocks: Iterable[str] = BLOCKS,
    levels: Iterable[Level] = LEVELS,
    kinds: Iterable[str] = (PROPERTY, BEDROOM),
    settings: Settings = DEFAULTS,
    grains: Iterable[str] = GRAINS,
) -> DataFrame:
    """Additive counts per key, period, segment, block and cell.

    Levels with bins around the mean get cells, the others final bucket numbers.
    """
    levels = list(levels)
    return _counted(by_level(df, levels), list(blocks), levels, list(kinds), settings, list(grains))


def _members(rows: DataFrame, blocks: list[str], levels: list[Level], settings: Settings) -> DataFrame:
    """A row for each block and cell of rows that have their level and key."""
    centred = [level.name for level in levels if level.mean_bins]
    fixed = len(centred) < len(levels)
    entries = [_cells(b, settings, bool(centred), fixed) for b in blocks]
    if fixed and blocks != ["age"]:
        rows = with_city_params(rows, settings)
    one = len(blocks) == 1 and blocks != ["age"]
    entry = F.get(entries[0], F.lit(0)) if one else F.explode(F.concat(*entries))
    cell = F.when(F.col("level").isin(centred), F.col("_e.cell")).otherwise(F.col("_e.bucket"))
    rows = rows.withColumn("_e", entry).filter(F.col("_e").isNotNull())
    return rows.withColumns({"block": F.col("_e.block"), "cell": cell}).filter("cell IS NOT NULL").drop("_e", "age")


def _amounts(blocks: list[str]) -> dict[str, Column]:
    price, carpet, priced = F.col("agreement_price"), F.col("carpet_sqft"), masks()["valid_price"]
    made = {
        "price": price,
        "price_priced": F.when(priced, price),
        "carpet": carpet,
        "carpet_priced": F.when(priced, carpet),
        "rate": F.col("rate_on_net_ca"),
    }
    sums = _sums(blocks)
    return {amount: value for amount, value in made.items() if exact.names(amount)[0] in sums}


def _counted(rows: DataFrame, blocks: list[str], levels: list[Level], kinds: list[str], settings: Settings, grains: list[str]) -> DataFrame:
    """`range_cells` of rows that have their level and key."""
    sums = _sums(blocks)
    made = {"n": F.count(F.lit(1)).alias("n"), "n_priced": F.count_if(masks()["valid_price"]).alias("n_priced")}
    chosen = [column for name, column in made.items() if name in sums]
    chosen += [column for amount, value in _amounts(blocks).items() for column in exact.sums(amount, value)]
    fine = (
        _members(rows, blocks, levels, settings)
        .groupBy(*LEVEL_KEY, *period_columns(grains), *kinds, "block", "cell")
        .agg(*chosen)
    )
    return (
        by_grain(by_segment(fine, kinds), grains)
        .groupBy(*SEGMENT_KEY, "block", "cell")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def _uncounted(rows: DataFrame, blocks: list[str], levels: list[Level], kinds: list[str], settings: Settings, grains: list[str]) -> DataFrame:
    """`range_cells` of rows that have their level and key, one for each row instead of one for each cell."""
    sums = _sums(blocks)
    made = {"n": F.lit(1).cast("bigint"), "n_priced": masks()["valid_price"].cast("bigint")}
    chosen = [column.alias(name) for name, column in made.items() if name in sums]
    chosen += [column for amount, value in _amounts(blocks).items() for column in exact.halves(amount, value)]
    place = [*LEVEL_KEY, *period_columns(grains), *kinds, "block", "cell"]
    members = _members(rows, blocks, levels, settings).select(*place, *chosen)
    return by_group(members, kinds, grains).select(*SEGMENT_KEY, "block", "cell", *sums)


def large_keys(df: DataFrame, levels: Iterable[Level] = LEVELS) -> DataFrame:
    """Level and key of those with more than ``GATHERED`` rows, at most one for each so many rows."""
    rows = by_level(df, levels).groupBy("level", "key_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GATHERED)
    return rows.select(F.col("level").alias("_large_level"), F.col("key_id").alias("_large_key"))


def _mine() -> Column:
    return (F.col("level") == F.col("_large_level")) & (F.col("key_id") == F.col("_large_key"))


def without_large(rows: DataFrame, large: DataFrame | None) -> DataFrame:
    """Rows by level whose key is not in ``large``."""
    return rows if large is None else rows.join(F.broadcast(large), _mine(), "left_anti")


def only_large(rows: DataFrame, large: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(large), _mine(), "left_semi")


def range_tables(
    df: DataFrame,
    blocks: Iterable[str] = BLOCKS,
    levels: Iterable[Level] = LEVELS,
    kinds: Iterable[str] = (PROPERTY, BEDROOM),
    settings: Settings = DEFAULTS,
    grains: Iterable[str] = GRAINS,
    large: DataFrame | None = None,
) -> DataFrame:
    """`range_table` of the rows' `range_cells`.

    Where keys have few rows, nearly every row has cells of its own, and to count them before a shuffle saves nothing.
    Rows of keys that are not in ``large`` are therefore shuffled once, by key, and put into buckets where
    they then are. Cells of large keys are counted before they are shuffled.
    """
    blocks, levels, kinds, grains = list(blocks), list(levels), list(kinds), list(grains)
    large = large_keys(df, levels) if large is None else large
    some = None if large.isEmpty() else large
    tables = [small_range_tables(df, blocks, levels, kinds, settings, grains, some, parts_of(df, levels))]
    if some is not None:
        tables.append(large_range_tables(df, blocks, levels, kinds, settings, grains, some))
    return reduce(DataFrame.unionByName, tables)


def _range_rows(df: DataFrame, blocks: list[str], levels: list[Level], kinds: list[str], grains: list[str]) -> DataFrame:
    needed = ["city", *period_columns(grains), *kinds, "net_carpet_area_sqmt", "carpet_sqft", "agreement_price", "rate_on_net_ca"]
    return by_level(df, levels).select("level", "key_id", *needed, *(["age"] if "age" in blocks else []))


def small_range_tables(
    df: DataFrame, blocks: list[str], levels: list[Level], kinds: list[str], settings: Settings, grains: list[str], large: DataFrame | None, parts: int
) -> DataFrame:
    """`range_tables` of the keys that are not in ``large``, each in one of so many parts."""
    rows = by_key(without_large(_range_rows(df, blocks, levels, kinds, grains), large), parts)
    return range_table(_uncounted(rows, blocks, levels, kinds, settings, grains), levels, settings, blocks)


def large_range_tables(
    df: DataFrame, blocks: list[str], levels: list[Level], kinds: list[str], settings: Settings, grains: list[str], large: DataFrame
) -> DataFrame:
    """`range_tables` of the keys in ``large``."""
    rows = only_large(_range_rows(df, blocks, levels, kinds, grains), large)
    return range_table(_counted(rows, blocks, levels, kinds, settings, grains), levels, settings, blocks)


def range_table(
    cells: DataFrame, levels: Iterable[Level] = LEVELS, settings: Settings = DEFAULTS, blocks: Iterable[str] = BLOCKS
) -> DataFrame:
    """Units, price and carpet per labelled bucket, for all blocks in the cells.

    ``priced`` rows count only documents with a positive price (area block only). A mean that
    centres bins is taken over exactly the rows counted, so those have their own buckets. The
    window that sums a segment holds its cells, whose number the value axis bounds; the grouping
    after it reuses its partitioning.
    """
    blocks, levels = list(blocks), list(levels)
    moving = set(blocks) - {"age"}
    centred = [level.name for level in levels if level.mean_bins] if moving else []
    fixed = len(centred) < len(levels) or "age" in blocks
    rows = cells.filter(F.col("block").isin(blocks))
    if moving and len(centred) < len(levels):
        rows = with_city_params(rows, settings)
    if centred:
        # Sorting by a hash first settles nearly every comparison without looking at the keys.
        rows = rows.withColumn("_hash", F.xxhash64(*SEGMENT_KEY))
        group = W.partitionBy("_hash", *SEGMENT_KEY, "block")
        rows = rows.withColumns({f"sum_{c}": F.sum(c).over(group) for c in _centring(blocks)})

    def entry(priced: bool) -> Column:
        suffix = "_priced" if priced else ""
        values = {"n": F.col(f"n{suffix}")}
        for c in ("price", "carpet"):
            values |= {to: F.col(name) for to, name in zip(exact.names(c), exact.names(c + suffix), strict=True)}
        if centred:
            n = f"sum_n{suffix}"
            means = {b: exact.centre(f"sum_{CENTRING[b]}{suffix if b == 'area' else ''}", n) for b in blocks if b in CENTRING}
            values["mean"] = _per_block(blocks, means)
        return F.struct(F.lit(priced).alias("priced"), *[v.alias(c) for c, v in values.items()])

    entries = entry(False)
    if "area" in blocks:
        entries = F.explode(F.array(entries, F.when((F.col("block") == "area") & (F.col("n_priced") > 0), entry(True))))
    bounds = [c for c in rows.columns if c.startswith(("min_", "max_"))]
    rows = (
        rows.select(*SEGMENT_KEY, "block", "cell", *bounds, entries.alias("e"))
        .filter(F.col("e").isNotNull())
        .select(*SEGMENT_KEY, "block", "cell", *bounds, "e.*")
    )
    rows = _with_numbers(rows, blocks, centred, fixed, settings)
    table = rows.groupBy(*SEGMENT_KEY, "block", "priced", "_number", "_low", "_high").agg(
        F.sum("n").alias("unit_sold"), *exact.merged("price"), *exact.merged("carpet")
    )
    table = table.withColumn("_step", _per_block(blocks, {b: F.lit(getattr(settings, f"{b}_step")) for b in blocks}))
    table = table.withColumn("_start", F.col("_low") + F.col("_number") * F.col("_step"))
    numbers = ["_number", "_low", "_high", "_start", "_step"]
    none = F.lit(0).cast("decimal(38,9)")
    table = table.withColumns({"total_sales": F.coalesce(exact.total("price"), none), "ca_consumed_sqft": F.coalesce(exact.total("carpet"), none)})
    # Texts are made from the few rows that are left, and apart from the numbers' long expressions.
    parts = [F.col(c) for c in numbers]
    plain, money = bins.label(*parts), bins.price_range_label(*parts)
    if "price" not in blocks:
        bucket = plain
    elif blocks == ["price"]:
        bucket = money
    else:
        bucket = F.when(F.col("block") == "price", money).otherwise(plain)
    return table.select(*SEGMENT_KEY, "block", "priced", bucket.alias("bucket"), "unit_sold", "total_sales", "ca_consumed_sqft")


def _per_block(blocks: list[str], of: dict[str, Column]) -> Column:
    out = None
    for block in blocks:
        if block in of:
            test = F.col("block") == block
            out = F.when(test, of[block]) if out is None else out.when(test, of[block])
    return out


def _with_numbers(rows: DataFrame, blocks: list[str], centred: list[str], fixed: bool, settings: Settings) -> DataFrame:
    """Adds the bucket's number and ends. Centre, number and first edge are columns of their own, so that each is
    computed once per row."""
    steps = {b: getattr(settings, f"{b}_step") for b in blocks}
    cell, mean, centre = F.col("cell"), F.col("mean"), F.col("_centre")
    low, high, number = {}, {}, {}
    if fixed:
        for b in blocks:
            low[b] = F.lit(settings.age_min) if b == "age" else F.col(f"min_{b}") if f"min_{b}" in rows.columns else None
            high[b] = F.lit(settings.age_max) if b == "age" else F.col(f"max_{b}") if f"max_{b}" in rows.columns else None
        low = {b: c.cast("bigint") for b, c in low.items() if c is not None}
        high = {b: c.cast("bigint") for b, c in high.items() if c is not None}
        number = {b: cell for b in low}
    if centred:
        moving = [b for b in blocks if b != "age"]
        centres = {
            "area": bins.area_centre(mean),
            "rate": bins.step_centre(mean, settings.rate_step),
            "price": bins.step_centre(mean, settings.price_step),
        }
        rows = rows.withColumn("_centre", _per_block(moving, centres))
        mine = F.col("level").isin(centred)
        edges = {b: bins.centred_edges(b, centre, steps[b]) for b in moving}
        numbers = {
            b: bins.mean_price_bucket(cell, *edges[b], steps[b])
            if b == "price"
            else bins.mean_bucket(cell, bins.area_cell(settings) if b == "area" else steps[b], *edges[b], steps[b])
            for b in moving
        }
        for b in moving:
            low[b] = F.when(mine, edges[b][0]).otherwise(low[b]) if b in low else edges[b][0]
            high[b] = F.when(mine, edges[b][1]).otherwise(high[b]) if b in high else edges[b][1]
            number[b] = F.when(mine, numbers[b]).otherwise(number[b]) if b in number else numbers[b]
    return rows.withColumns(
        {"_low": _per_block(blocks, low), "_high": _per_block(blocks, high), "_number": _per_block(blocks, number)}
    )


def kept(c: Column) -> Column:
    """Rounded amount; a zero counts as absent."""
    return F.nullif(round2(c), F.lit(0.0))


def money(total: str) -> Column:
    """An exact total with two decimals."""
    return F.bround(total, 2).cast("double")


def kept_total(total: str) -> Column:
    return F.nullif(money(total), F.lit(0.0))


# Area metric -> rows with a positive price only?
AREA_METRICS = {"count": False, "carpet": False, "sales": True, "avg_sales": True}


def area_metric(table: DataFrame, metric: str) -> DataFrame:
    """One ``value`` per area bucket: "count", "carpet", "sales" or "avg_sales"."""
    if metric not in AREA_METRICS:
        raise ValueError(f"unknown area metric '{metric}', choose one of {sorted(AREA_METRICS)}")
    rows = table.filter((F.col("block") == "area") & (F.col("priced") == AREA_METRICS[metric]))
    return rows.select(*SEGMENT_KEY, "bucket", area_value(metric).alias("value")).filter(F.col("value").isNotNull())


def area_value(metric: str) -> Column:
    return {
        "count": F.col("unit_sold").cast("double"),
        "carpet": kept_total("ca_consumed_sqft"),
        "sales": kept_total("total_sales"),
        "avg_sales": kept(F.col("total_sales").cast("double") / F.col("unit_sold")),
    }[metric]


def price_ranges(table: DataFrame) -> DataFrame:
    """Units, sales and carpet per price bucket; zero amounts stay."""
    amounts = [money(c).alias(c) for c in ("total_sales", "ca_consumed_sqft")]
    return table.filter(F.col("block") == "price").select(*SEGMENT_KEY, "bucket", "unit_sold", *amounts)


def rate_ranges(table: DataFrame) -> DataFrame:
    """Units, sales and carpet per rate bucket; zero amounts are null."""
    amounts = [kept_total(c).alias(c) for c in ("total_sales", "ca_consumed_sqft")]
    return table.filter(F.col("block") == "rate").select(*SEGMENT_KEY, "bucket", "unit_sold", *amounts)


def age_ranges(table: DataFrame) -> DataFrame:
    """Buyers, sales and carpet per age bucket; a document counts once for each of its buyers."""
    return table.filter(F.col("block") == "age").select(
        *SEGMENT_KEY,
        "bucket",
        "unit_sold",
        kept_total("total_sales").alias("total_agreement_price"),
        kept_total("ca_consumed_sqft").alias("ca_consumed_sqft"),
    )
