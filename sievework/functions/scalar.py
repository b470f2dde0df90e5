"""Scalar column functions: names, hashes, capture times, polygon text, JPEG bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTS = "array<struct<x:double,y:double>>"


def parse_capture_time(name: Column) -> Column:
    """The time in names such as 20260729_103953(0).jpg; null for other names and impossible dates."""
    digits = F.regexp_extract(name, r"^(\d{8})_(\d{6})", 1), F.regexp_extract(name, r"^(\d{8})_(\d{6})", 2)
    return F.try_to_timestamp(F.nullif(F.concat(*digits), F.lit("")), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def impossible_capture_time(name: Column) -> Column:
    """Whether a name has the form of a capture time but no such time exists."""
    return name.rlike(r"^\d{8}_\d{6}") & parse_capture_time(name).isNull()


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two integers."""
    return F.bit_count(a.bitwiseXOR(b))


def hex_to_long(h: Column) -> Column:
    return F.conv(h, 16, 10).cast("long")


def long_to_hex(n: Column) -> Column:
    return F.lower(F.lpad(F.hex(n), 16, "0"))


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def parse_points(text: Column) -> Column:
    """'x,y;x,y' as points. An empty text or a part that is no point raises (ANSI casts)."""
    return F.transform(F.split(text, ";"), lambda p: F.struct(F.split(p, ",")[0].cast("double").alias("x"), F.split(p, ",")[1].cast("double").alias("y")))


def try_parse_points(text: Column) -> Column:
    """As parse_points, but null where the text is no list of points."""
    part = lambda p, i: F.try_element_at(F.split(p, ","), F.lit(i)).try_cast("double")
    points = F.transform(F.split(text, ";"), lambda p: F.struct(part(p, 1).alias("x"), part(p, 2).alias("y")))
    return F.when(F.forall(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull()), points)


def drop_consecutive_points(text: Column) -> Column:
    """Point tokens without those equal to the one before; empty tokens go. Equality is of text."""
    tokens = F.filter(F.transform(F.split(text, ";"), lambda t: F.trim(t)), lambda t: t != "")
    return F.array_join(F.filter(tokens, lambda t, i: (i == 0) | (t != F.get(tokens, i - 1))), ";")


def polygon_line(points: Column, width: Column, height: Column, label: int = 0) -> Column:
    """Class and normalised coordinates with 8 decimals, clipped to [0, 1]; under 3 points raises."""
    share = lambda v, size: F.format_number(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v / size)), 8)
    body = F.array_join(F.transform(points, lambda p: F.concat_ws(" ", share(p["x"], width), share(p["y"], height))), " ")
    few = F.raise_error(F.lit("a segmentation polygon has at least three points")).cast("string")
    return F.when(F.size(points) < 3, few).otherwise(F.concat(F.lit(f"{label} "), body))


def with_jpeg_end(content: Column) -> Column:
    """JPEG bytes that end with the marker FFD9, added once where it is missing."""
    end = F.unhex(F.lit("FFD9"))
    return F.when(F.substring(content, -2, 2) == end, content).otherwise(F.concat(content, end))


def stable_id(image_id: Column, instance: Column) -> Column:
    return F.format_string("image-%04d-instance-%03d", image_id, instance)


def attribute_flag(value: Column) -> Column:
    """'1' is true; absent counts as '0'."""
    return F.coalesce(value, F.lit("0")) == "1"


def attribute_int(value: Column) -> Column:
    return F.coalesce(value.cast("int"), F.lit(0))


def text_or(value: Column, default: str) -> Column:
    """Trimmed text, or the default where it is absent or blank."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.[^./]*$", 0))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"[^/]*$", 0), r"(?<=.)\.[^.]*$", "")


def signal_text(signal: Column, names: dict[str, str]) -> Column:
    """'CODE' or 'CODE:related' in words; an unknown code stands for itself."""
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    code, related = F.split_part(signal, F.lit(":"), F.lit(1)), F.split_part(signal, F.lit(":"), F.lit(2))
    words = F.coalesce(known[code], code)
    return F.when(related != "", F.concat(words, F.lit(" ("), related, F.lit(")"))).otherwise(words)


def golden_hue(index: Column) -> Column:
    """Hue in [0, 180) of an instance's colour: steps of the golden ratio."""
    return F.floor(F.pmod(index * F.lit(0.618033988749895), F.lit(1.0)) * 180).cast("int")


def golden_bgr(index: Column) -> Column:
    """(b, g, r) of an instance's colour: golden-ratio hues at the fixed saturation 0.82 and full value."""
    sector = F.pmod(index * F.lit(0.61803398875), F.lit(1.0)) * 6

    def channel(offset: int) -> Column:
        at = F.pmod(sector + offset, F.lit(6.0))
        return F.floor((1 - 0.82 * F.greatest(F.lit(0.0), F.least(at, 4 - at, F.lit(1.0)))) * 255).cast("int")

    return F.struct(channel(1).alias("b"), channel(3).alias("g"), channel(5).alias("r"))


def split_name(split: Column) -> Column:
    """train, validation, test as train, val, test; another name raises."""
    names = {"train": "train", "validation": "val", "test": "test"}  # fixed values
    out = None
    for k, v in names.items():
        out = F.when(split == k, v) if out is None else out.when(split == k, v)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown split: "), F.coalesce(split, F.lit("null")))).cast("string"))


def half_even(value: Column, places: int) -> Column:
    """Rounded, a half to the even neighbour."""
    return F.bround(value, places)


def column_subset(df: DataFrame, columns: list[str]) -> DataFrame:
    """Some columns as text, '' for null and for those that are not there."""
    return df.select(*((F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in columns))
