"""Reports: all metrics of a level, long or wide.

The long form has one scalar per row and a fixed schema, and is what scales. The wide form, one
row per key and period with a column per segment and metric, is laid out from the long one's cells.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial, reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from deedmill.config import BEDROOM_METRICS, DEFAULTS, NON_BHK_LABELS, Settings
from deedmill.operators.buyers import counted_pincodes, pincodes_in_place
from deedmill.operators.levels import BEDROOM, GRAINS, LEVELS, PERIOD_KEY, PROPERTY, Level, by_key, by_level, chosen, parts
from deedmill.functions.values import round2
from deedmill.operators.keys import number_keys, with_key_columns
from deedmill.operators.percentiles import DISTRIBUTIONS, PROBABILITIES, Keep, floor_label, split_rate_percentiles, with_prevailing
from deedmill.operators.ranges import (
    area_value,
    kept,
    kept_total,
    large_keys,
    large_range_tables,
    money,
    only_large,
    small_range_tables,
    without_large,
)
from deedmill.operators.totals import base_totals, counted_totals, development_agreements, label_counts, totals_in_place
from deedmill.plans.jobs import side_by_side
from deedmill.sources.sinks import save_report
from deedmill.sources.staging import Stages

COLUMNS = ["document_no", "city", "city_id", "loc_id", "proj_id", "manual_processed", "property_category",
           "transaction_type", "property_type", "property_type_raw", "project_type", "bhk_br", "index",
           "project_name", "location", "location_id", "location_lat", "location_lng", "project_lat", "project_lng",
           "net_carpet_area_sqmt", "carpet_sqft", "agreement_price", "rate_on_net_ca", "rate_on_sa", "floor_no",
           "age", "buyer_pincode", "transaction_date", "year", "quarter"]

COUNT, AMOUNT, TEXT = "count", "amount", "text"
PINCODES = "pincode_stats"

# Metrics of a segment: name -> (type of the value, is a distribution over buckets?)
SEGMENT_METRICS = {
    "sold_igr": (COUNT, False),
    "total_agreement_price": (AMOUNT, False),
    "avg_agreement_price": (AMOUNT, False),
    "ca_consumed_sqft_igr": (AMOUNT, False),
    "wt_avg_rate_nca": (AMOUNT, False),
    "p50_rate_nca": (AMOUNT, False),
    "p75_rate_nca": (AMOUNT, False),
    "p90_rate_nca": (AMOUNT, False),
    "total_unit_sold_in_area_range": (COUNT, True),
    "total_agreement_price_in_area_range": (AMOUNT, True),
    "avg_agreement_price_in_area_range": (AMOUNT, True),
    "total_ca_consumed_in_area_range_sqft": (AMOUNT, True),
    "agreement_price_range_unit_sold": (COUNT, True),
    "agreement_price_range_total_sales": (AMOUNT, True),
    "agreement_price_range_ca_consumed_sqft": (AMOUNT, True),
    "rate_range_unit_sold": (COUNT, True),
    "rate_range_total_sales": (AMOUNT, True),
    "rate_range_ca_consumed_sqft": (AMOUNT, True),
    "age_range_unit_sold": (COUNT, True),
    "age_range_total_agreement_price": (AMOUNT, True),
    "age_range_ca_consumed_sqft": (AMOUNT, True),
}
PROPERTY_METRICS = SEGMENT_METRICS | {
    "wt_avg_rate_sa": (AMOUNT, False),
    "p50_rate_sa": (AMOUNT, False),
    "p75_rate_sa": (AMOUNT, False),
    "p90_rate_sa": (AMOUNT, False),
    "floor_wise_90p_rate": (AMOUNT, True),
    "most_prevailing_rate_range": (TEXT, False),
    "total_unit_sold_in_rate_range": (COUNT, True),
}
BEDROOM_ONLY = {"avg_carpet_area_in_sqft": (AMOUNT, False)}
BEDROOM_SEGMENT_METRICS = SEGMENT_METRICS | BEDROOM_ONLY


def _unpivot(df: DataFrame, entries: list[tuple[Column, str, Column]], bucket: Column | None = None) -> DataFrame:
    """One row per (condition, metric, value) whose condition holds and whose value is not null."""
    values = {f"_value_{i}": value.cast("double") for i, (_, _, value) in enumerate(entries)}
    numbers = [F.when(when & F.col(name).isNotNull(), F.lit(i)) for i, ((when, _, _), name) in enumerate(zip(entries, values, strict=True))]
    nothing, number = F.lit(None).cast("string"), F.col("_e")
    return (
        df.withColumns(values)
        .withColumn("_e", F.explode(F.array(*numbers)))
        .filter(number.isNotNull())
        .select(
            *PERIOD_KEY, "kind", "segment", chosen(number, [F.lit(metric) for _, metric, _ in entries]).alias("metric"),
            (nothing if bucket is None else bucket).alias("bucket"), chosen(number, [F.col(name) for name in values]).alias("value"),
            nothing.alias("text"),
        )
    )


def _totals_part(totals: DataFrame) -> DataFrame:
    always = F.lit(True)
    names = ["sold_igr", "total_agreement_price", "avg_agreement_price", "ca_consumed_sqft_igr", "avg_carpet_area_in_sqft"]
    return _unpivot(totals, [(always, n, F.nullif(F.col(n).cast("double"), F.lit(0.0))) for n in names])


def _rates_part(percentiles: DataFrame, levels: list[Level], settings: Settings) -> DataFrame:
    rates = with_prevailing(percentiles, levels)
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    entries = [("floor_pt", "floor_wise_90p_rate", round2(F.col("p90")), text)]
    for dist, suffix in (("rate_nca_pt", "rate_nca"), ("rate_nca_bhk", "rate_nca"), ("rate_sa_pt", "rate_sa")):
        for metric, column in {"wt_avg": "mean", "p50": "p50", "p75": "p75", "p90": "p90"}.items():
            entries.append((dist, f"{metric}_{suffix}", kept(F.col(column)), text))
    entries.append(("rate_nca_pt", "most_prevailing_rate_range", number, F.col("most_prevailing_rate_range")))
    rates = rates.withColumns({f"_value_{i}": value for i, (_, _, value, _) in enumerate(entries)})
    numbers = [
        F.when((F.col("dist") == dist) & (F.col(f"_value_{i}").isNotNull() | words.isNotNull()), F.lit(i))
        for i, (dist, _, _, words) in enumerate(entries)
    ]
    number = F.col("_e")
    return (
        rates.withColumn("_e", F.explode(F.array(*numbers)))
        .filter(number.isNotNull())
        .select(
            *PERIOD_KEY, "kind", "segment", chosen(number, [F.lit(metric) for _, metric, _, _ in entries]).alias("metric"),
            floor_label(settings).alias("bucket"), chosen(number, [F.col(f"_value_{i}") for i in range(len(entries))]).alias("value"),
            chosen(number, [words for _, _, _, words in entries]).alias("text"),
        )
    )


def _ranges_part(tables: Callable[[str], DataFrame]) -> list[DataFrame]:
    """Each block has its own short plan over the rows, as cells of small keys are about as many as rows and wider."""
    always, priced = F.lit(True), F.col("priced")
    n, sales, carpet = F.col("unit_sold"), "total_sales", "ca_consumed_sqft"
    entries = {
        "area": [
            (~priced, "total_unit_sold_in_area_range", area_value("count")),
            (~priced, "total_ca_consumed_in_area_range_sqft", area_value("carpet")),
            (priced, "total_agreement_price_in_area_range", area_value("sales")),
            (priced, "avg_agreement_price_in_area_range", area_value("avg_sales")),
        ],
        "price": [
            (always, "agreement_price_range_unit_sold", n),
            (always, "agreement_price_range_total_sales", money(sales)),
            (always, "agreement_price_range_ca_consumed_sqft", money(carpet)),
        ],
        "rate": [
            (always, "rate_range_unit_sold", n),
            (always, "rate_range_total_sales", kept_total(sales)),
            (always, "rate_range_ca_consumed_sqft", kept_total(carpet)),
            (F.col("kind") == PROPERTY, "total_unit_sold_in_rate_range", n),
        ],
        "age": [
            (always, "age_range_unit_sold", n),
            (always, "age_range_total_agreement_price", kept_total(sales)),
            (always, "age_range_ca_consumed_sqft", kept_total(carpet)),
        ],
    }
    return [_unpivot(tables(b), e, F.col("bucket")) for b, e in entries.items()]


def _labels_part(df: DataFrame, levels: list[Level], grains: list[str]) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return label_counts(df, levels, grains=grains).filter(F.col("n") > 0).select(
        *PERIOD_KEY, F.lit("label").alias("kind"), "segment", "metric", nothing.alias("bucket"),
        F.col("n").cast("double").alias("value"), nothing.alias("text"),
    )


def _listed(level: Level | Iterable[Level]) -> list[Level]:
    return [level] if isinstance(level, Level) else list(level)


TOTALS_COLUMNS = ["city", "document_no", "year", "quarter", PROPERTY, BEDROOM, "agreement_price", "net_carpet_area_sqmt", "carpet_sqft"]
PINCODE_COLUMNS = ["city", "year", "quarter", "buyer_pincode", "agreement_price", "net_carpet_area_sqmt", "carpet_sqft"]


@dataclass(frozen=True)
class Dealt:
    """Rows of the levels, to be shuffled by key once for each family of metrics, into so many parts.

    ``large`` has the keys with so many rows that they are counted before they are shuffled; none if there are none.
    """

    df: DataFrame
    levels: list[Level]
    settings: Settings
    grains: list[str]
    keep: Keep
    large: DataFrame | None
    parts: int

    @staticmethod
    def of(df: DataFrame, levels: list[Level], settings: Settings, grains: list[str], keep: Keep) -> Dealt:
        large = keep(large_keys(df, levels), "large-keys")
        return Dealt(df, levels, settings, grains, keep, None if large.isEmpty() else large, parts(df, levels))

    def small_rows(self, columns: list[str]) -> DataFrame:
        rows = by_level(self.df, self.levels).select("level", "key_id", *columns)
        return by_key(without_large(rows, self.large), self.parts)

    def large_rows(self, columns: list[str]) -> DataFrame:
        return only_large(by_level(self.df, self.levels).select("level", "key_id", *columns), self.large)

    def long_parts(self) -> tuple[list[DataFrame], list[DataFrame]]:
        """Long rows of small keys, all dealt out alike, and the others."""
        levels, settings, grains = self.levels, self.settings, self.grains
        kinds = (PROPERTY, BEDROOM)
        # Rates are as quickly read from the rows once more as from a copy.
        keep = lambda df, name: df if name == "rates" else self.keep(df, name)
        small_rates, large_rates = split_rate_percentiles(
            self.df, levels, tuple(DISTRIBUTIONS), settings, PROBABILITIES, grains, keep, self.parts
        )
        small = [
            _totals_part(totals_in_place(self.small_rows(TOTALS_COLUMNS), levels, kinds, grains)),
            _rates_part(small_rates, levels, settings),
            *_ranges_part(lambda block: small_range_tables(self.df, [block], levels, kinds, settings, grains, self.large, self.parts)),
        ]
        others = []
        if self.large is not None:
            others.append(_totals_part(counted_totals(self.large_rows(TOTALS_COLUMNS), levels, kinds, grains)))
            others += _ranges_part(lambda block: large_range_tables(self.df, [block], levels, kinds, settings, grains, self.large))
        if large_rates is not None:
            others.append(_rates_part(large_rates, levels, settings))
        if labelled := [x for x in levels if not x.manual_only]:
            others.append(_labels_part(self.df, labelled, grains))
        return small, others

    def pincode_parts(self) -> tuple[list[DataFrame], list[DataFrame]]:
        small = [pincodes_in_place(self.small_rows(PINCODE_COLUMNS), self.grains)]
        return small, [] if self.large is None else [counted_pincodes(self.large_rows(PINCODE_COLUMNS), self.grains)]


def long_report(
    df: DataFrame, level: Level | Iterable[Level], settings: Settings = DEFAULTS, grains: Iterable[str] = GRAINS, keep: Keep = lambda df, name: df
) -> DataFrame:
    """Every segment metric of one level or of several at once, one scalar per row.

    ``keep`` may stage what is read more than once: the few large keys.
    """
    small, others = Dealt.of(df, _listed(level), settings, list(grains), keep).long_parts()
    return reduce(DataFrame.unionByName, small + others)


def segment_labels(cells: DataFrame) -> dict[str, list[str]]:
    """Labels that become column names: those that the cells of a report have."""
    names = cells.select(F.explode(F.array_distinct(F.col("_cells.name"))).alias("name")).distinct()
    first, last = F.substring_index("name", "|", 1), F.substring_index("name", "|", -1)
    middle = F.substring(F.col("name"), F.length(first) + 2, F.length("name") - F.length(first) - F.length(last) - 2)
    found = names.filter(F.col("name") != PINCODES).select(F.when(first == "label", last).otherwise(first).alias("kind"), middle.alias("segment"))
    out: dict[str, list[str]] = {}
    for kind, label in found.distinct().orderBy("kind", "segment").collect():
        out.setdefault(kind, []).append(label)
    return out


def wide_columns(labels: dict[str, list[str]]) -> dict[tuple[str, str, str], tuple[str, str, bool]]:
    """(kind, segment, metric) -> (column name, value type, distribution?) of a wide report.

    Names are lower case. A name that is taken gets a suffix: ``_bhk`` for a bedroom label that is
    also a property type, a number for labels that differ only in case.
    """
    out: dict[tuple[str, str, str], tuple[str, str, bool]] = {}
    taken: set[str] = set()

    def add(kind: str, segment: str, metric: str, spec: tuple[str, bool]) -> None:
        name = f"{segment}_{metric}".lower()
        if name in taken and kind == BEDROOM:
            name += "_bhk"
        base, i = name, 2
        while name in taken:
            name, i = f"{base}_{i}", i + 1
        taken.add(name)
        out[kind, segment, metric] = (name, *spec)

    for segment in labels.get(PROPERTY, []):
        for metric, spec in PROPERTY_METRICS.items():
            add(PROPERTY, segment, metric, spec)
    for segment in labels.get(BEDROOM, []):
        metrics = BEDROOM_ONLY if segment in NON_BHK_LABELS else BEDROOM_SEGMENT_METRICS
        for metric, spec in metrics.items():
            add(BEDROOM, segment, metric, spec)
    for metric in ("transactions_sale", "transactions"):
        for segment in labels.get(metric, []):
            add("label", segment, metric, (COUNT, False))
    return out


def _number_text(value: Column, kind: str) -> Column:
    return value.cast("bigint" if kind == COUNT else "decimal(38,2)").cast("string")


def report_cells(
    df: DataFrame, level: Level | Iterable[Level], settings: Settings = DEFAULTS, grains: Iterable[str] = GRAINS, keep: Keep = lambda df, name: df
) -> DataFrame:
    """Rows of the wide reports of one level or of several: key, totals ``_base`` and all cells, of column key ``name``, ``bucket``
    and text ``cell``.

    Small keys are dealt out alike by all that counts them, so their cells meet without a further shuffle; what is counted
    before its shuffle is little, and dealt out like them. The buckets of a row are few; pincodes, the largest set, are bounded
    by the postal system.
    """
    levels, grains = _listed(level), list(grains)
    dealt = Dealt.of(df, levels, settings, grains, keep)
    counts = sorted({m for m, (kind, _) in (PROPERTY_METRICS | BEDROOM_SEGMENT_METRICS).items() if kind == COUNT})
    number = F.when(F.col("metric").isin(counts), _number_text(F.col("value"), COUNT)).otherwise(_number_text(F.col("value"), AMOUNT))
    single = F.col("bucket").isNull()
    base = report_base(df, levels, grains)
    totals = F.struct(*[c for c in base.columns if c not in PERIOD_KEY]).alias("_base")
    base = base.select(*PERIOD_KEY, *[F.lit(None).cast("string").alias(c) for c in ("name", "bucket", "cell")], totals)
    nothing = F.lit(None).cast(base.schema["_base"].dataType).alias("_base")

    def long_cells(rows: DataFrame) -> DataFrame:
        text = F.when(single, F.coalesce("text", F.col("value").cast("string"))).otherwise(number)
        return rows.select(*PERIOD_KEY, _cell_key("kind", "segment", "metric"), "bucket", text.alias("cell"), nothing)

    def pincode_cells(rows: DataFrame) -> DataFrame:
        return rows.select(
            *PERIOD_KEY, F.lit(PINCODES).alias("name"), F.col("pincode").cast("string").alias("bucket"), _pincode_text().alias("cell"), nothing
        )

    (small, others), (small_pins, other_pins) = dealt.long_parts(), dealt.pincode_parts()
    apart = [*[long_cells(x) for x in others], *[pincode_cells(x) for x in other_pins], base]
    entries = [*[long_cells(x) for x in small], *[pincode_cells(x) for x in small_pins], *[by_key(x, dealt.parts) for x in apart]]
    cell = F.when(F.col("name").isNotNull(), F.struct("name", "bucket", "cell"))
    # Sorting by a hash first settles nearly every comparison without looking at the keys.
    grouped = reduce(DataFrame.unionByName, entries).groupBy(F.xxhash64(*PERIOD_KEY).alias("_hash"), *PERIOD_KEY)
    grouped = grouped.agg(F.first("_base", ignorenulls=True).alias("_base"), F.collect_list(cell).alias("_cells"))
    # Totals decide the rows.
    return grouped.filter(F.col("_base").isNotNull()).drop("_hash")


def report_base(df: DataFrame, level: Level | Iterable[Level], grains: Iterable[str] = GRAINS) -> DataFrame:
    """Totals and descriptive columns of the wide reports; they decide their rows."""
    levels, grains = _listed(level), list(grains)
    base = base_totals(df, levels, grains)
    if labelled := [x for x in levels if not x.manual_only]:
        base = base.join(development_agreements(df, labelled, grains), PERIOD_KEY, "left")
    return base


@dataclass(frozen=True)
class Shape:
    """The columns of a level's wide report."""

    level: Level
    grains: tuple[str, ...]
    names: dict[tuple[str, str, str], tuple[str, str, bool]]

    @staticmethod
    def of(level: Level, grains: Iterable[str], labels: dict[str, list[str]]) -> Shape:
        names = wide_columns(labels)
        if not level.manual_only:  # labels without bedrooms have a mean carpet at project level only
            names = {k: v for k, v in names.items() if not (k[0] == BEDROOM and k[1] in NON_BHK_LABELS)}
        return Shape(level, tuple(grains), names)

    def cells(self) -> dict[str, tuple[str, pa.DataType]]:
        """Cell key -> (column name, type)."""
        types = {TEXT: pa.string(), COUNT: pa.int64(), AMOUNT: pa.float64()}
        found = {"|".join(k): (name, pa.string() if nested else types[kind]) for k, (name, kind, nested) in self.names.items()}
        return found | {PINCODES: (PINCODES, pa.string())}

    def nested(self) -> set[str]:
        """Columns that hold a distribution."""
        return {name for name, _, nested in self.names.values() if nested} | {PINCODES}

    def base(self) -> dict[str, Column]:
        """Columns that come from the totals; zeros are blank."""
        fields = {"Type": F.col("grain"), "Period": F.col("grain")}
        fields |= {c: F.col(c) for c in self.level.columns} if self.level.composite else {self.level.key: F.col("key_id")}
        for grain, name, kind in (("YoY", "year", "int"), ("QoQ", "quarter", "string")):
            if grain in self.grains:
                fields[name] = F.when(F.col("grain") == grain, F.col("period")).cast(kind)
        fields["city"] = F.col("city")
        fields |= {c: F.col(c) for c, _ in self.level.attributes if c not in fields}
        fields |= {c: F.nullif(F.col(c), F.lit(0.0)) for c in ("total_sales", "total_ca_consumed_sqft_igr")}
        fields |= {"total_transactions": F.nullif("total_transactions", F.lit(0)), "max_floor": F.nullif("max_floor", F.lit(0.0))}
        fields |= {c: F.col(c) for c in ("recent_transaction_date", "project_type")}
        if not self.level.manual_only:
            fields["no_of_da_registered"] = F.col("no_of_da_registered")
        return {name: column.alias(name) for name, column in fields.items()}


def widen(cells: DataFrame, shape: Shape, numbered: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per key and period of a level, its grains one after the other, in order of city, key and period.

    Rows are put in order while they hold no more than their cells; a row builder then lays the cells out, so that
    no plan holds an expression for each of the report's many columns.
    """
    level = shape.level
    rows = cells.filter((F.col("level") == level.name) & F.col("grain").isin(list(shape.grains)))
    rows = rows.select(*PERIOD_KEY, "_base.*", "_cells")
    fixed = shape.base()
    if level.composite:
        rows = with_key_columns(rows.drop(*level.columns), level, numbered or {})
    turn = F.array_position(F.lit(list(shape.grains)), F.col("Type"))
    periods = [c for grain in shape.grains for c in PERIOD_COLUMN[grain]]
    rows = rows.select(*fixed.values(), "_cells").orderBy(turn, "city", *level.columns, *periods)

    found, plain, nested = shape.cells(), list(fixed), shape.nested()
    order = bedroom_order([*plain, *[name for name, _ in found.values()]])
    types = dict(found.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, LAID):
                part = batch.slice(start, LAID)
                columns = {name: part.column(name) for name in plain}
                columns |= laid_out(part.column("_cells"), found, nested)
                yield pa.record_batch([columns[name] for name in order], order)

    made = {name: T.StructField(name, from_arrow_type(kind)) for name, kind in types.items()}
    schema = T.StructType([made.get(name) or rows.schema[name] for name in order])
    return rows.mapInArrow(run, schema)


# Rows that are laid out at once.
LAID = 4096


def laid_out(cells: pa.ListArray, found: dict[str, tuple[str, pa.DataType]], nested: set[str]) -> dict[str, pa.Array]:
    """The columns of rows whose cells are given as lists of name, bucket and cell. ``found`` has column and type of each name.

    A distribution is one JSON object, its buckets in text order. Cells of other names are left out.
    """
    n = len(cells)
    row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(cells), 0).to_numpy(zero_copy_only=False))
    flat = cells.flatten()
    name, bucket, text = (pc.struct_field(flat, c) for c in ("name", "bucket", "cell"))
    place = pc.fill_null(pc.index_in(name, value_set=pa.array(list(found), pa.string())), -1).to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(bucket.combine_chunks() if isinstance(bucket, pa.ChunkedArray) else bucket)
    rank = np.empty(len(coded.dictionary) + 1, np.int64)
    rank[:-1][pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(coded.dictionary))
    rank[-1] = -1
    turn = rank[pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)]
    order = np.lexsort((turn, row, place))
    bounds = np.searchsorted(place[order], np.arange(len(found) + 1))
    items = pc.binary_join_element_wise('"', bucket, '": ', text, "")
    out = {}
    for i, (column, kind) in enumerate(found.values()):
        mine = order[bounds[i] : bounds[i + 1]]
        if not len(mine):
            out[column] = pa.nulls(n, kind)
        elif column in nested:
            held = np.bincount(row[mine], minlength=n)
            offsets = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), items.take(pa.array(mine))), ", ")
            whole = pc.binary_join_element_wise("{", joined, "}", "")
            out[column] = pc.if_else(pa.array(held > 0), whole, pa.scalar(None, pa.string()))
        else:
            at = np.full(n, -1)
            at[row[mine]] = mine
            one = text.take(pa.array(at, mask=at < 0))
            out[column] = one if kind == pa.string() else _number(one, kind)
    return out


def _number(text: pa.Array, kind: pa.DataType) -> pa.Array:
    number = text.cast(pa.float64())
    return number.cast(kind)


def report_rows(df: DataFrame, levels: Iterable[Level]) -> DataFrame:
    """The columns that reports need, of rows that have a key of one of the levels."""
    keyed = reduce(or_, [F.col(x.number).isNotNull() for x in levels])
    named = {*COLUMNS, *[x.number for x in levels], *[c for x in levels for _, c in x.attributes]}
    return df.filter(keyed).select(*[c for c in df.columns if c in named])


def wide_report(df: DataFrame, level: Level, grain: str, settings: Settings = DEFAULTS) -> DataFrame:
    """The report of one level and grain.

    Prepared rows are computed once and staged, and so are the cells, in the shared checkpoint folder.
    The report is lazy, so its staged files stay.
    """
    stages = Stages(df.sparkSession)
    df, numbered = number_keys(df, [level], stages.stage)
    rows = stages.stage(report_rows(df, [level]), "rows")
    cells = stages.stage(report_cells(rows, level, settings, [grain], stages.stage), "cells")
    return widen(cells, Shape.of(level, [grain], segment_labels(cells)), numbered)


PERIOD_COLUMN = {"Overall": [], "YoY": ["year"], "QoQ": ["quarter"]}


class ReportsFailed(ExceptionGroup):
    """Reports that failed, each under its level's name in a note; ``written`` has the paths of the others."""

    def __new__(cls, written: dict[str, str], failed: dict[str, Exception]) -> ReportsFailed:
        for name, error in failed.items():
            error.add_note(f"report of level '{name}'")
        self = super().__new__(cls, f"reports failed: {', '.join(sorted(failed))}", list(failed.values()))
        self.written, self.failed = written, failed
        return self


def run_reports(
    df: DataFrame,
    path: str,
    levels: Iterable[Level] = LEVELS,
    grains: Iterable[str] = GRAINS,
    settings: Settings = DEFAULTS,
    fmt: str = "parquet",
) -> dict[str, str]:
    """All reports of prepared transactions, one file set per level, grains stacked by column name.

    Prepared rows are computed once and staged. One pass over them counts the cells of all levels and grains, which
    are staged too; each level's report is then laid out from its cells, side by side with the others. Staged files
    are removed at the end.

    A failing level does not keep the others from being written: if the common pass fails, levels go on one by
    one. All failures are raised together at the end, as ``ReportsFailed``.
    """
    levels, grains = list(levels), list(grains)
    spark, stages = df.sparkSession, Stages(df.sparkSession)
    path = path.rstrip("/")

    def write(level: Level, cells: DataFrame) -> str:
        shape = Shape.of(level, grains, segment_labels(cells.filter(F.col("level") == level.name)))
        save_report(widen(cells, shape, numbered), f"{path}/{level.name}", fmt)
        return f"{path}/{level.name}"

    def counted(rows: DataFrame, some: list[Level], name: str) -> DataFrame:
        keep = lambda frame, part: stages.stage(frame, f"{name}-{part}")
        return keep(report_cells(rows, some, settings, grains, keep), "cells")

    try:
        df, numbered = number_keys(df, levels, stages.stage)
        rows = stages.stage(report_rows(df, levels), "rows")
        try:
            cells = counted(rows, levels, "all")
            jobs = {x.name: partial(write, x, cells) for x in levels}
        except Exception:
            if len(levels) == 1:
                raise
            jobs = {x.name: lambda x=x: write(x, counted(rows, [x], x.name)) for x in levels}
        written, failed = side_by_side(spark, jobs)
        if failed:
            raise ReportsFailed(written, failed)
        return written
    finally:
        stages.discard()


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cell_key(*parts: str) -> Column:
    return F.concat_ws("|", *parts).alias("name")


def _pincode_text() -> Column:
    amounts = ["pct_of_total_transactions", "total_agreement_price", "avg_agreement_price"]
    texts = [F.col("no_of_transactions").cast("string"), *[_number_text(F.col(c), AMOUNT) for c in amounts]]
    return F.concat(F.lit("["), F.concat_ws(", ", *texts), F.lit("]"))


_BEDROOM = re.compile(r"^([<>]?)(\d+(?:\.\d+)?)br_")


def bedroom_order(columns: list[str]) -> list[str]:
    """Column names with those of bedroom labels moved last, by bedrooms, then by metric."""

    def place(name: str) -> tuple[float, str, int]:
        sign, number = _BEDROOM.match(name).groups()
        half = {"<": -0.5, ">": 0.5}.get(sign, 0.0)
        matching = [m for m in BEDROOM_METRICS if name.endswith(m)]
        rank = BEDROOM_METRICS.index(max(matching, key=len)) if matching else len(BEDROOM_METRICS)
        return float(number) + half, sign + number, rank

    bedroom = [c for c in columns if _BEDROOM.match(c)]
    return [c for c in columns if not _BEDROOM.match(c)] + sorted(bedroom, key=place)


def blank_zeros(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Zeros of the named columns as nulls."""
    return df.withColumns({c: F.nullif(F.col(_q(c)), F.lit(0).cast(df.schema[c].dataType)) for c in columns})


def stack(reports: Iterable[DataFrame]) -> DataFrame:
    """Reports one under the other by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)
