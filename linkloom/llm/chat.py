"""Chat formatting: logged snapshots of one conversation collapse before rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import materialize

#: Turns rendered into one string; a longer conversation gives several pieces.
TURNS_PER_PIECE = 512
#: Stands for a null conv_id while rows are joined.
NO_CONVERSATION = -(2**63)
SUMS = ["s0", "s1", "s2", "s3"]


def _halves(*cols: Column) -> list[Column]:
    """Four 32-bit parts of two 64-bit hashes: sums of them cannot overflow."""
    return [
        part.alias(name)
        for name, part in zip(
            SUMS,
            [
                part
                for salt in (11, 23)
                for h in [F.xxhash64(F.lit(salt), *cols)]
                for part in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))
            ],
        )
    ]


def _carried(rows: DataFrame, values: list[str]) -> DataFrame:
    """(part, conv, <value>_before): what earlier partitions hold of a conversation.

    Rows are range-partitioned, so at most one conversation goes on from one partition to the
    next: the table has one row per partition at most.
    """
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part", "conv").agg(*[F.sum(v).alias(v) for v in values])
    sums = [F.sum(v).over(earlier).alias(f"{v}_before") for v in values]
    return totals.select("part", "conv", *sums).filter(F.col(f"{values[0]}_before").isNotNull())


def turn_prefixes(convs: DataFrame) -> DataFrame:
    """Turns in order with the rolling hash of all turns so far: conv, pos, s0..s3, role, text.

    The rolling hash is four running sums of hashes of (position, role, text).  Running sums start
    in each range partition and get what earlier partitions hold, so no task needs a whole
    conversation.
    """
    order = ["conv", "turn", "role", "text_hash", "uid"]
    rows = convs.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_CONVERSATION)).alias("conv"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumns({"text_hash": F.xxhash64("text"), "uid": F.monotonically_increasing_id()})
    rows = materialize(rows, "chat-turns")
    rows = materialize(
        rows.repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("one", F.lit(1).cast("long")),
        "chat-ranges",
    )
    inside = Window.partitionBy("part", "conv").orderBy(*order[1:])
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("long")
    placed = materialize(
        rows.join(F.broadcast(_carried(rows, ["one"])), ["part", "conv"], "left")
        .withColumn("pos", F.row_number().over(inside) + F.coalesce("one_before", zero))
        .select("part", "conv", "pos", "role", "text", *_halves(F.col("pos"), F.col("role"), F.col("text"))),
        "chat-places",
    )
    so_far = Window.partitionBy("part", "conv").orderBy("pos")
    return placed.join(F.broadcast(_carried(placed, SUMS)), ["part", "conv"], "left").select(
        *["conv", "pos", "role", "text"],
        *[(F.sum(s).over(so_far) + F.coalesce(f"{s}_before", zero)).alias(s) for s in SUMS],
    )


def chat_examples(convs: DataFrame) -> DataFrame:
    """Rendered maximal conversations: conv_id, piece, n_turns, text.

    A conversation whose turns (role and text, in order) begin a longer one is a snapshot of it
    and goes; of equal conversations the smallest conv_id stays.  Turns are matched by two 64-bit
    hashes.  Each turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``; ``<|`` inside a turn becomes
    ``< |``, so that text cannot open or close a turn.  A piece holds TURNS_PER_PIECE turns at most;
    pieces count from 0, and their texts joined are the whole conversation.

    Turns are ordered by turn (nulls first), then role, then hash of the text; repeated turns all
    count.  Null roles and texts are empty.  Rows without a conv_id are one conversation, returned
    with conv_id null.  Other columns are not read.  No rows in, no rows out.
    """
    turns = materialize(turn_prefixes(convs), "chat-prefixes")
    key = ["pos", *SUMS]
    light = turns.select("conv", *key)
    ends = light.groupBy("conv").agg(
        F.max("pos").alias("pos"), F.max_by(F.struct(*SUMS), "pos").alias("sums")
    )
    ends = ends.select("conv", "pos", "sums.*")
    longer = light.join(ends.select("conv", "pos"), ["conv", "pos"], "left_anti").select(*key).distinct()
    maximal = ends.groupBy(*key).agg(F.min("conv").alias("conv")).join(longer, key, "left_anti")
    rendered = F.concat(
        F.lit("<|im_start|>"),
        *[F.replace("role", F.lit("<|"), F.lit("< |")), F.lit("\n")],
        *[F.replace("text", F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>\n")],
    )
    return (
        turns.join(maximal.select("conv"), "conv", "left_semi")
        .select("conv", "pos", rendered.alias("turn_text"))
        .groupBy("conv", F.expr(f"cast((pos - 1) div {TURNS_PER_PIECE} as int)").alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "turn_text"))).alias("turns"))
        .select(
            F.when(F.col("conv") != NO_CONVERSATION, F.col("conv")).alias("conv_id"),
            "piece",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.col("turns.turn_text"), "").alias("text"),
        )
    )
