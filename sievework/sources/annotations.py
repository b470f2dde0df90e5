"""Annotation exports in XML: polygons of images, labels and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.functions.ranks import numbered
from sievework.functions.scalar import POINTS, attribute_flag, attribute_int, drop_consecutive_points, parse_points, text_or

_ATTRIBUTE = "array<struct<_name:string,_VALUE:string>>"
_POLYGON = f"array<struct<_label:string,_source:string,_occluded:string,_points:string,_z_order:string,attribute:{_ATTRIBUTE}>>"
_LABELS = "struct<label:array<struct<name:string,type:string,color:string>>>"
_SCOPE = f"struct<id:string,name:string,size:string,mode:string,labels:{_LABELS}>"
IMAGE_SCHEMA = f"_id int, _name string, _width int, _height int, polygon {_POLYGON}"


def _xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, name, width, height, polygons) of each image; polygons keep the order of the file.

    polygons: raw_points, label, source, occluded, z_order, attributes.
    """
    images = _xml(spark, path, "image", IMAGE_SCHEMA)
    polygon = F.transform(
        F.coalesce("polygon", F.array().cast(_POLYGON)),
        lambda p: F.struct(
            p["_points"].alias("raw_points"),
            p["_label"].alias("label"),
            text_or(p["_source"], "unknown").alias("source"),
            attribute_flag(p["_occluded"]).alias("occluded"),
            attribute_int(p["_z_order"]).alias("z_order"),
            F.map_from_entries(F.transform(F.coalesce(p["attribute"], F.array().cast(_ATTRIBUTE)), lambda a: F.struct(a["_name"], F.coalesce(a["_VALUE"], F.lit(""))))).alias("attributes"),
        ),
    )
    return images.select(F.col("_id").alias("image_id"), F.col("_name").alias("name"), F.col("_width").alias("width"), F.col("_height").alias("height"), polygon.alias("polygons"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row: version, id, name, size, mode, labels, dumped. A job's scope is preferred to a task's.

    A file whose root isn't `annotations` gives no row; see require_export.
    """
    meta = f"version string, meta struct<job:{_SCOPE},task:{_SCOPE},dumped:string>"
    rows = _xml(spark, path, "annotations", meta)
    scope = F.coalesce("meta.job", "meta.task")
    return rows.select("version", scope["id"].alias("id"), scope["name"].alias("name"), scope["size"].alias("size"), scope["mode"].alias("mode"), scope["labels"]["label"].alias("labels"), F.col("meta.dumped").alias("dumped"))


def require_export(spark: SparkSession, path: str) -> None:
    """Raises where there is no annotation export (a path that doesn't exist raises in the reader)."""
    if read_metadata(spark, path).isEmpty():
        raise ValueError(f"not an annotation export: {path}")


def instances(images: DataFrame) -> DataFrame:
    """One row for each polygon, with a 1-based instance_index and its points."""
    rows = images.select("image_id", "name", "width", "height", F.posexplode("polygons").alias("at", "p"))
    return rows.select("image_id", "name", "width", "height", (F.col("at") + 1).alias("instance_index"), "p.*").withColumn("points", parse_points(F.col("raw_points")).cast(POINTS))


def normalise(images: DataFrame) -> DataFrame:
    """The images with consecutive equal vertices dropped; a polygon left with under three points raises."""

    def clean(p):
        text = drop_consecutive_points(p["raw_points"])
        few = (text != p["raw_points"]) & (F.size(F.split(text, ";")) < 3)
        return p.withField("raw_points", F.when(few, F.raise_error(F.lit("fewer than three points left")).cast("string")).otherwise(text))

    return images.withColumn("polygons", F.transform("polygons", clean))


def corrections(images: DataFrame) -> DataFrame:
    """(image_id, name, instance_index, removed) of polygons that normalise shortens."""
    rows = images.select("image_id", "name", F.posexplode("polygons").alias("at", "p"))
    size = lambda t: F.size(F.filter(F.split(t, ";"), lambda x: F.trim(x) != ""))
    removed = size(F.col("p.raw_points")) - size(drop_consecutive_points(F.col("p.raw_points")))
    return rows.select("image_id", "name", (F.col("at") + 1).alias("instance_index"), removed.alias("removed")).where("removed > 0")


def merge(exports: list[DataFrame]) -> DataFrame:
    """All images, numbered anew from 0 by name. A name found twice raises."""
    rows = exports[0]
    for e in exports[1:]:
        rows = rows.unionByName(e)
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("name")))
    name = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("image in several exports: "), F.col("name"))).cast("string")).otherwise(F.col("name"))
    rows = rows.withColumn("name", name).drop("_n", "image_id")
    ids = numbered(rows.select("name"), ["name"], "image_id")
    return rows.join(ids, "name").select("image_id", "name", "width", "height", "polygons")
