"""Problem 1: per-key results when a few keys hold most records.

Eager aggregation through joins: every input is reduced by its own join key first, the
compact states are joined, and counts and sums of the joined relation follow algebraically
(the join of groups with a and b rows has a*b rows, a sum over one side is multiplied by the
other side's count). No row of a hot key is ever shuffled for its key's sake: the only row-level
exchange is on the record identity, which is spread evenly, with map-side combining.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .registry import key_hash, slide_key, spelling_hashes


def record_states(facts: DataFrame, record: str = "record_id", slide: str = "slide_id") -> DataFrame:
    """``(key_hash, n_records)``: distinct records under each slide spelling.

    Redeliveries of a record count once, under one spelling (a null spelling only if no delivery
    has another). Rows with a null record are no records. An empty table gives no states.
    """
    per_record = (
        facts.select(F.col(record).alias("__record"), key_hash(slide_key(F.col(slide))).alias("key_hash"))
        .where("__record IS NOT NULL")
        .groupBy("__record")
        .agg(F.min("key_hash").alias("key_hash"))
    )
    return per_record.groupBy("key_hash").agg(F.count(F.lit(1)).alias("n_records"))


def roll_up(states: DataFrame, registry: DataFrame, sums: list[str]) -> DataFrame:
    """Joins compact states with the registry of spellings and adds them up per slide."""
    return (
        states.join(registry, "key_hash")
        .groupBy("slide_id")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def slide_record_counts(facts: DataFrame, slides: DataFrame) -> DataFrame:
    """``(slide_id, n_records, total_records)``; the total includes records that name no slide."""
    states = cut(record_states(facts))  # one row a spelling, read for the slides and for the total
    counts = roll_up(states, spelling_hashes(slides), ["n_records"])
    return facts.sparkSession.sql(
        "SELECT slide_id, n_records, (SELECT coalesce(sum(n_records), 0) FROM {states}) AS total_records FROM {counts}",
        states=states,
        counts=counts,
    )


def slides_with_share(facts: DataFrame, slides: DataFrame, percent: int = 5) -> DataFrame:
    """``(slide_id)`` of the slides that hold at least ``percent`` of all distinct records."""
    return slide_record_counts(facts, slides).where(F.col("n_records") * 100 >= F.col("total_records") * percent).select("slide_id")


def box_states(boxes: DataFrame, slide: str = "slide_id") -> DataFrame:
    """``(key_hash, n_boxes, area)``: boxes and their summed area under each slide spelling.

    A box has an area if it has four numbers that span one; other boxes count with area 0.
    """
    b = F.col("bbox")
    spans = (F.size(b) == 4) & (b[2] > b[0]) & (b[3] > b[1])
    area = F.coalesce(F.when(spans, (b[2] - b[0]).cast("long") * (b[3] - b[1])), F.lit(0).cast("long"))
    return (
        boxes.select(key_hash(slide_key(F.col(slide))).alias("key_hash"), area.alias("area"))
        .groupBy("key_hash")
        .agg(F.count(F.lit(1)).alias("n_boxes"), F.sum("area").alias("area"))
    )


def slide_join_totals(facts: DataFrame, boxes: DataFrame, slides: DataFrame) -> DataFrame:
    """Totals of the join records x boxes on the slide, without running that join.

    ``n_pairs = n_records * n_boxes`` and ``pair_area = n_records * area`` are what counting and
    summing the joined rows would give; the join itself sees one state per slide and side.
    """
    registry = spelling_hashes(slides)
    left = roll_up(record_states(facts), registry, ["n_records"])
    right = roll_up(box_states(boxes), registry, ["n_boxes", "area"])
    return left.join(right, "slide_id").select(
        "slide_id",
        "n_records",
        "n_boxes",
        (F.col("n_records") * F.col("n_boxes")).alias("n_pairs"),
        (F.col("n_records") * F.col("area")).alias("pair_area"),
    )
