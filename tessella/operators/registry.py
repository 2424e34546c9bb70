"""Resolving the spellings of a slide against the slide registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slide_key(name: Column) -> Column:
    """Comparison form of a slide spelling: no outer blanks, no closing slash, case folded.

    ``ß`` folds to ``ss`` so that upper-cased names still meet. Null and blank give null.
    """
    bare = F.trim(F.regexp_replace(F.trim(name), r"[\s/]+$", ""))
    return F.nullif(F.replace(F.lower(bare), F.lit("ß"), F.lit("ss")), F.lit(""))


def spellings(slides: DataFrame, id_col: str = "slide_id", name_cols: tuple[str, ...] = ("slide_id", "slide_name", "alt_slide_id")) -> DataFrame:
    """``(slide_key, slide_id)``, one row for each spelling a slide goes by.

    A key claimed by two slides goes to the smaller ``slide_id``; null names are ignored.
    """
    names = F.explode(F.array_distinct(F.array(*[slide_key(F.col(c)) for c in name_cols])))
    return (
        slides.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("slide_id"), names.alias("slide_key"))
        .where("slide_key IS NOT NULL")
        .groupBy("slide_key")
        .agg(F.min("slide_id").alias("slide_id"))
    )


def spelling_hashes(slides: DataFrame) -> DataFrame:
    """``(key_hash, slide_id)``: the spellings under their 64-bit hash, which sorts and aggregates cheaply."""
    return spellings(slides).select(key_hash(F.col("slide_key")).alias("key_hash"), "slide_id")


def key_hash(key: Column) -> Column:
    return F.when(key.isNotNull(), F.xxhash64(key))
