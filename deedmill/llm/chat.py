"""Rotation of perspectives: a dialogue as each of its speakers sees it.

For every participant the whole dialogue is rendered with that speaker as the assistant and the others as named
users; a mask marks the text that the assistant is to be trained on. Long dialogues are cut into windows of turns,
so that no row, and no group that makes a row, grows with the dialogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Characters that the turns beginning in one window span at most, the last turn's own length aside.
WINDOW = 8192
#: Turns whose lengths are summed first; their sums then place them in the dialogue.
TURNS_IN_BUCKET = 256
SYSTEM, UNNAMED = "system", "unknown"


def rendered(turns: DataFrame) -> DataFrame:
    """conv_id, speaker, turn, piece, head, role, start: each turn as each speaker sees it and where it starts.

    `turns` has conv_id, turn, role and text; other columns are ignored. A null role is the speaker `unknown`, a
    null text is empty, and turns without number come first. Turns of equal number follow by role and text;
    repeated turns stay. The role `system` is not a participant: a dialogue of system turns alone has no
    perspective. A null conv_id is a dialogue of its own. No rows give no rows.
    """
    said = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(UNNAMED)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    speakers = said.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("conv"), F.col("role").alias("speaker")).distinct()
    seen = said.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    own, system = F.col("role") == F.col("speaker"), F.col("role") == SYSTEM
    tag = F.when(own, "assistant").when(system, SYSTEM).otherwise(F.concat(F.lit("user name="), F.col("role")))
    head = F.concat(F.lit("<|"), tag, F.lit("|>\n"))
    seen = seen.withColumn("head", F.length(head)).withColumn("piece", F.concat(head, "text", F.lit("<|end|>\n")))
    seen = seen.withColumn("size", F.length("piece").cast("long")).withColumn("bucket", F.floor(F.col("turn") / TURNS_IN_BUCKET))
    key = ["conv_id", "speaker", "bucket"]
    sums = seen.groupBy(*key).agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("conv_id", "speaker").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"{k}_") for k in key], F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    before = Window.partitionBy(*key).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in key]
    placed = seen.join(sums, same[0] & same[1] & same[2])
    return placed.select("conv_id", "speaker", "turn", "role", "text", "piece", "head", (F.col("offset") + F.col("inside")).alias("start"))


def rotate(turns: DataFrame, window: int = WINDOW) -> DataFrame:
    """conv_id, speaker, part, n_turns, n_chars, n_trained, text and mask, a row for each window of each perspective.

    `part` counts windows from 0 by the position at which a turn starts; a window in which none starts has no row.
    `mask` lists the character ranges, end exclusive, that the assistant is trained on: its own texts and their
    end marks, as start:end, comma-joined.
    """
    seen = rendered(turns).withColumn("part", F.floor(F.col("start") / window))
    turn = F.struct("start", "turn", "role", "text", "piece", "head")
    parts = seen.groupBy("conv_id", "speaker", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    first = F.col("turns")[0]["start"]
    own = F.filter("turns", lambda t: t["role"] == F.col("speaker"))
    begin = lambda t: t["start"] - first + t["head"]
    # A turn ends with its end mark and a line break, which is not trained on.
    end = lambda t: t["start"] - first + F.length(t["piece"]) - 1
    text = F.array_join(F.transform("turns", lambda t: t["piece"]), "")
    mask = F.array_join(F.transform(own, lambda t: F.concat(begin(t).cast("string"), F.lit(":"), end(t).cast("string"))), ",")
    trained = F.aggregate(own, F.lit(0).cast("long"), lambda n, t: n + end(t) - begin(t))
    return parts.select(
        "conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), F.length(text).cast("long").alias("n_chars"),
        trained.alias("n_trained"), text.alias("text"), mask.alias("mask"),
    )


SQL = f"""
WITH said AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '{UNNAMED}') AS role, coalesce(text, '') AS text FROM conversations),
speakers AS (SELECT DISTINCT conv_id AS conv, role AS speaker FROM said WHERE role <> '{SYSTEM}'),
seen AS (
  SELECT conv_id, speaker, turn, role, text,
         '<|' || CASE WHEN role = speaker THEN 'assistant' WHEN role = '{SYSTEM}' THEN '{SYSTEM}' ELSE 'user name=' || role END || '|>' || chr(10) AS head
  FROM said JOIN speakers ON conv_id IS NOT DISTINCT FROM conv),
pieces AS (SELECT *, head || text || '<|end|>' || chr(10) AS piece FROM seen),
placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, speaker ORDER BY turn, role, text
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM pieces),
parts AS (SELECT *, start // {WINDOW} AS part, min(start) OVER (PARTITION BY conv_id, speaker, start // {WINDOW}) AS first FROM placed)
SELECT conv_id, speaker, CAST(part AS BIGINT) AS part, count(*) AS n_turns, CAST(sum(length(piece)) AS BIGINT) AS n_chars,
       CAST(coalesce(sum(length(piece) - 1 - length(head)) FILTER (role = speaker), 0) AS BIGINT) AS n_trained,
       string_agg(piece, '' ORDER BY start, turn, role, text) AS text,
       coalesce(string_agg(CAST(start - first + length(head) AS BIGINT) || ':' || CAST(start - first + length(piece) - 1 AS BIGINT), ','
                ORDER BY start, turn, role, text) FILTER (role = speaker), '') AS mask
FROM parts GROUP BY conv_id, speaker, part
"""
