"""Names, ids, paths and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TILE_NAME = r"^(.*?)__MAG_(\d+)d(\d+)__X_(\d+)__Y_(\d+)__IDX_(\d+)$"


def slide_id(name: Column, keep_percent: bool = False) -> Column:
    """File-system-safe id: up to 20 cleaned characters and 8 hex digits of the name's MD5."""
    full = name if keep_percent else F.replace(name, F.lit("%"), F.lit("_pct_"))
    short = F.trim(F.substring(F.regexp_replace(full, r"[^\p{L}\p{N} _-]", ""), 1, 20))
    return F.replace(F.concat(short, F.lit("_"), F.substring(F.md5(full), 1, 8)), F.lit(" "), F.lit("_"))


def split_list(text: Column) -> Column:
    """Distinct, trimmed, non-empty items of a comma-separated list."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""))


def filter_names(items: Column) -> Column:
    """All spellings under which the items of a slide filter may match: as given, and both generated ids."""
    return F.array_union(items, F.array_union(F.transform(items, lambda x: slide_id(x)), F.transform(items, lambda x: slide_id(x, keep_percent=True))))


def magnifications(text: Column) -> Column:
    """Distinct magnifications of a list, largest first; not positive ones raise an error."""
    values = F.transform(F.split(F.translate(text, "\"'", ""), ","), lambda x: F.trim(x).cast("double"))
    wrong = F.exists(values, lambda x: x.isNull() | (x <= 0))
    return F.when(wrong, F.raise_error(F.lit("magnifications must be positive"))).otherwise(F.sort_array(F.array_distinct(values), asc=False))


def magnification_tag(mag: Column) -> Column:
    """``1.0`` becomes ``1d00``; hundredths are truncated as doubles (0.29 gives ``0d28``)."""
    whole = mag.cast("int")
    return F.concat(whole.cast("string"), F.lit("d"), F.lpad(((mag - whole) * 100).cast("int").cast("string"), 2, "0"))


def tile_name(slide: Column, mag: Column, x: Column, y: Column, idx: Column) -> Column:
    return F.concat(
        slide, F.lit("__MAG_"), magnification_tag(mag), F.lit("__X_"), x.cast("string"), F.lit("__Y_"), y.cast("string"), F.lit("__IDX_"), F.lpad(idx.cast("string"), 6, "0"), F.lit(".png")
    )


def parse_tile_name(name: Column, thousandths: bool = False) -> Column:
    """Struct ``slide_id, magnification, x, y, idx`` of a tile file name, null if it is none.

    The fraction counts by its digits; ``thousandths`` divides it by 1000 whatever its length.
    """
    base = F.regexp_replace(F.regexp_extract(name, r"([^/\\]*)$", 1), r"(?i)\.png$", "")
    part = lambda i: F.regexp_extract(base, TILE_NAME, i)
    digits = F.lit(1000.0) if thousandths else F.pow(F.lit(10.0), F.length(part(3)))
    parsed = F.struct(
        part(1).alias("slide_id"),
        (F.try_to_number(part(2), F.lit("999999")).cast("double") + part(3).cast("double") / digits).alias("magnification"),
        part(4).cast("int").alias("x"),
        part(5).cast("int").alias("y"),
        part(6).cast("int").alias("idx"),
    )
    return F.when(base.rlike(TILE_NAME), parsed)


def tile_of_box_file(path: Column) -> Column:
    """Struct ``tile_path, tile_name, slide_id`` for the path of a box file; null if its base name has no ``_bboxes``.

    Either slash separates folders, and whatever follows the first ``_bboxes`` of the base name says nothing.
    """
    tile = F.nullif(F.regexp_extract(path, r"^(?:.*[/\\])?([^/\\]*?)_bboxes[^/\\]*$", 1), F.lit(""))
    folder = F.regexp_extract(path, r"^(.*[/\\])?[^/\\]*$", 1)
    parts = F.struct(F.concat(folder, tile, F.lit(".png")).alias("tile_path"), tile.alias("tile_name"), F.try_element_at(F.split(path, r"[/\\]"), F.lit(-2)).alias("slide_id"))
    return F.when(tile.isNotNull(), parts)


def tail_after(path: Column, marker: str) -> Column:
    """What follows the path component that starts with ``marker``; the last two components if there is none."""
    cut = F.regexp_extract(path, rf"(?:^|/){marker}[^/]*/(.+)$", 1)
    return F.when(cut != "", cut).otherwise(F.regexp_extract(path, r"([^/]+/[^/]+)$", 1))


def clean_label(text: Column) -> Column:
    """A model's label without punctuation; ``Undetermined`` if nothing is left."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.trim(text), r"[^\p{L}\p{N}_\s-]", "")), F.lit("")), F.lit("Undetermined"))


def error_label(message: Column) -> Column:
    """The class of a cell whose model call failed; crops add those of tiles that are missing or cannot be read."""
    return F.when(F.lower(message).contains("rate"), "Error - Rate Limited").otherwise("Error - Exception")


def colour(value: Column) -> Column:
    """``[b, g, r]`` derived from a value's SHA-256; grey for null and ``N/A``."""
    digest = F.sha2(value.cast("string"), 256)
    channel = lambda i: (F.lit(50) + F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int") % 206).cast("int")
    grey = F.array(*[F.lit(128)] * 3)
    return F.when(value.isNull() | (value.cast("string") == "N/A"), grey).otherwise(F.array(channel(0), channel(1), channel(2)))


def cell_text(cls: Column | None, cluster: Column | None, conf: Column | None) -> Column:
    """``c:class, cl:cluster, p:confidence`` of the parts asked for; an unknown confidence is ``?``."""
    parts = []
    if cls is not None:
        parts.append(F.concat(F.lit("c:"), F.coalesce(cls, F.lit("N/A"))))
    if cluster is not None:
        parts.append(F.concat(F.lit("cl:"), F.coalesce(cluster.cast("string"), F.lit("N/A"))))
    if conf is not None:
        parts.append(F.concat(F.lit("p:"), F.when(conf.isNull(), "?").otherwise(F.format_string("%.2f", F.bround(conf, 2)))))
    return F.concat_ws(", ", *parts)


def safe_file_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N}._-]", "_")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def image_name(slide: Column, tile: Column) -> Column:
    full = F.concat(slide, F.lit("__"), tile)
    return F.when(F.endswith(full, F.lit(".png")), full).otherwise(F.concat(full, F.lit(".png")))


def parameter_text(value: object) -> str:
    """A parameter in a run's name: ``auto`` for none, ``T``/``F``, ``pt`` for the decimal point, ``-`` for commas."""
    if value is None:
        return "auto"
    if isinstance(value, bool):
        return "T" if value else "F"
    return str(value).replace(".", "pt").replace(",", "-")


IMAGE_MARKERS = ("prepped_tiles", "prepped_tiles_path", "INPUT_prepped_tiles_path", "prepped")


def image_candidates(path: Column, markers: tuple[str, ...] = IMAGE_MARKERS) -> Column:
    """Relative paths under which a tile's image may lie, most specific first: after a marker folder, slide and file, file."""
    clean = F.replace(path, F.lit("\\"), F.lit("/"))
    after = [F.nullif(F.regexp_extract(clean, rf"/{m}/(.+)$", 1), F.lit("")) for m in markers]
    return F.array_distinct(F.array_compact(F.array(*after, F.nullif(F.regexp_extract(clean, r"([^/]+/[^/]+)$", 1), F.lit("")), base_name(clean))))


def tile_uri(path: Column, base: Column, marker: str = "INPUT_prepped_tiles_path") -> Column:
    """A tile's address under its slide's base; null without one."""
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), tail_after(path, marker))


def run_stamp(at: Column | None = None) -> Column:
    """A time as ``yyyyMMdd_HHmmss``."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyyMMdd_HHmmss")
