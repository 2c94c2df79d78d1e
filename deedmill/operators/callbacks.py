"""User-written statistics per segment, in two forms.

Mergeable: a pair of functions, of which ``partial`` turns some rows of a group into a small frame, and
``merge`` turns several such frames, concatenated, into one of the same shape. Merging must not depend
on how rows were split. A group with a third of the data is spread over tasks.

Whole: one function over all rows of a group in a given order, which it gets batch by batch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain, groupby
from operator import and_

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Step = Callable[[pd.DataFrame], pd.DataFrame]

# Partial states of a group that are merged at once, and finished groups that are handed on at once.
MERGE_AT, HELD = 32, 20_000
# Rows of a group that one task folds; a larger group is dealt out in shares of about as many.
SHARE_ROWS = 200_000
# Result rows of whole groups that are handed on at once.
ROWS_OUT = 1000


def per_group(
    df: DataFrame, keys: list[str], columns: list[str], partial: Step, merge: Step, state: str, salt: int = 8
) -> DataFrame:
    """Merged state per group. ``state`` is the schema of the state columns, without the keys.

    Rows are counted per group first. A group goes to one task, and one of more than ``SHARE_ROWS`` rows to at
    least ``salt``, so that ``partial`` is called about once a group however many groups there are. A task gets its
    rows sorted and holds one state per group at a time, merged as batches come. The shares of large groups, few
    as they are, are then merged across tasks.
    """
    by_name = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    key_schema = ", ".join(f"`{k}` {by_name[k]}" for k in keys)
    state_names = StructType.fromDDL(state).names

    def one(states: list[pd.DataFrame]) -> pd.DataFrame:
        return merge(pd.concat(states, ignore_index=True) if len(states) > 1 else states[0].reset_index(drop=True))[state_names]

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Final states of whole groups, and one state of each share. Rows of a group follow each other."""
        done: list[tuple[tuple, pd.DataFrame]] = []
        current, states = None, []

        def handed_on() -> pd.DataFrame:
            sizes = [len(out) for _, out in done]
            made = pd.concat([out for _, out in done], ignore_index=True)
            for i, name in enumerate(names):
                made[name] = [key[i] for (key, _), n in zip(done, sizes, strict=True) for _ in range(n)]
            done.clear()
            return made[[*names, *state_names]]

        for frame in frames:
            for key, rows in frame.groupby(names, dropna=False, sort=False):
                # Missing keys are not equal to themselves, None is.
                key = tuple(None if pd.isna(k) else k for k in key)
                if key != current:
                    if states:
                        done.append((current, one(states)))
                    current, states = key, []
                states.append(partial(rows)[state_names])
                if len(states) >= MERGE_AT:
                    states = [one(states)]
            if len(done) >= HELD:
                yield handed_on()
        if states:
            done.append((current, one(states)))
        if done:
            yield handed_on()

    def across(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole groups as they are, and the states of shares merged."""
        current, states = None, []

        def merged() -> pd.DataFrame:
            out = one(states)
            for name, value in zip(keys, current, strict=True):
                out[name] = [value] * len(out)
            return out[[*keys, *state_names]]

        for frame in frames:
            yield frame.loc[frame["_share"] < 0, [*keys, *state_names]]
            for key, rows in frame[frame["_share"] >= 0].groupby(keys, dropna=False, sort=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                if key != current:
                    if states:
                        yield merged()
                    current, states = key, []
                states.append(rows[state_names])
                if len(states) >= MERGE_AT:
                    states = [one(states)]
        if states:
            yield merged()

    names, values = [*keys, "_share"], [c for c in columns if c not in keys]
    fractions = [k for k in keys if by_name[k] in ("float", "double")]
    df = df.select(*keys, *values).withColumns({k: F.when(~F.isnan(k), F.col(k)) for k in fractions})
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > SHARE_ROWS)
    shares = F.greatest(F.lit(salt), F.ceil(F.col("_n") / SHARE_ROWS)).cast("int").alias("_shares")
    # At most one large group for each SHARE_ROWS rows.
    large = F.broadcast(counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], shares))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    # A group that is whole has the share -1.
    share = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_shares")), F.lit(-1)).cast("int").alias("_share")
    dealt = df.join(large, same, "left").select(*keys, *values, share).repartition(*names).sortWithinPartitions(*names)
    parts = dealt.mapInPandas(fold, f"{key_schema}, `_share` int, {state}")
    return parts.repartition(*keys).sortWithinPartitions(*names).mapInPandas(across, f"{key_schema}, {state}")


Whole = Callable[[tuple, Iterator[pa.RecordBatch]], Iterable[tuple]]


def per_whole_group(df: DataFrame, keys: list[str], columns: list[str], function: Whole, result: str, order: list[str] | None = None) -> DataFrame:
    """What a function makes of each whole group, for statistics that cannot be merged.

    ``function`` gets the group's key and an iterator of Arrow batches with ``columns``, all of the group's rows in
    the order of ``order``; it may stop early, and yields rows of the schema ``result``. A group is one sorted run of a
    task and is never held: memory is bounded by an Arrow batch, whatever share of the rows the group has. The task
    takes as long as the function needs for its group; where states can be merged, ``per_group`` spreads the work.
    """
    order = order or []
    by_name = {f.name: f for f in df.schema.fields}
    values = StructType.fromDDL(result)
    schema = StructType([*(by_name[k] for k in keys), *values])
    arrow, places = to_arrow_schema(schema), range(len(keys))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in places), strict=True))
            held, start = batch.select(columns), 0
            for key, run in groupby(rows, _comparable):
                n = sum(1 for _ in run)
                yield key, held.slice(start, n)
                start += n

    def out(rows: list[tuple]) -> pa.RecordBatch:
        made = zip(*rows, strict=True) if rows else [[] for _ in arrow]
        return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for _, group in groupby(slices(batches), lambda x: x[0]):
            key, first = next(group)
            key = tuple(k if true else math.nan for k, true in key)
            for row in function(key, chain([first], (batch for _, batch in group))):
                made.append((*key, *row))
                if len(made) >= ROWS_OUT:
                    yield out(made)
                    made = []
        yield out(made)

    needed = list(dict.fromkeys([*keys, *columns, *order]))
    rows = df.select(*needed).repartition(*keys).sortWithinPartitions(*keys, *order)
    return rows.mapInArrow(run, schema)


def _comparable(key: tuple) -> tuple:
    """Keys that Spark puts into one group as equal tuples: a number that is none (NaN) is equal to itself there."""
    return tuple((k, True) if k == k else (None, False) for k in key)
