"""Files: round trips through the sinks and scans, over whole tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.scalar import text_or, with_jpeg_end
from sievework.functions.scratch import Scratch
from sievework.operators import features, review, selection
from sievework.plans.registry import query, table
from sievework.plans.review import LINES, POLY, SIGNALS, polygons, with_signals, _images
from sievework.sources import annotations, files, sinks


def _folder(spark: SparkSession, label: str) -> str:
    """A fresh folder of the shared directory, as a path that Python opens too."""
    import os

    path = re.sub(r"^file:/*", "/", Scratch(spark, label).base)
    os.makedirs(path)
    return path


def _supplier_files(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, DataFrame]:
    """A file for each supplier, of two kinds, written and read back; (folder, what was written)."""
    folder = _folder(spark, label)
    name = F.format_string("s%06d.%s", "s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, "TXT").otherwise("dat"))
    rows = table(spark, sf_dir, "supplier").select(F.lit("all").alias("subfolder"), name.alias("filename"), F.concat_ws("|", "s_name", "s_nationkey").cast("binary").alias("content"))
    return f"{folder}/all", Scratch(spark, label).save(sinks.write_files(rows, folder), "written")


SUPPLIER_FILES = """WITH f AS (SELECT printf('s%06d.%s', s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'TXT' ELSE 'dat' END) AS filename, s_name || '|' || s_nationkey AS body FROM supplier)"""


@query(f"{SUPPLIER_FILES} SELECT filename, sha256(body) AS sha256, true AS ok FROM f")
def written_files(spark, sf_dir):
    return _supplier_files(spark, sf_dir, "written")[1]


@query(f"{SUPPLIER_FILES} SELECT filename, strlen(body)::BIGINT AS bytes, sha256(body) AS sha256 FROM f WHERE lower(filename) LIKE '%.txt' ORDER BY filename")
def directory_scan(spark, sf_dir):
    folder, _ = _supplier_files(spark, sf_dir, "scan")
    return files.scan_files(spark, folder, [".txt"]).orderBy("path").select("filename", "bytes", "sha256")


@query(f"{SUPPLIER_FILES} SELECT filename, strlen(body)::BIGINT AS bytes FROM f WHERE filename LIKE 's%7.dat'")
def glob_listing(spark, sf_dir):
    folder, _ = _supplier_files(spark, sf_dir, "glob")
    return files.list_files(spark, folder, "s*7.dat")


@query(f"{SUPPLIER_FILES} SELECT filename AS name, strlen(body)::BIGINT AS bytes, true AS intact FROM f")
def archive_listing(spark, sf_dir):
    folder, written = _supplier_files(spark, sf_dir, "zip")
    sinks.write_zip([f"{folder}/{r[0]}" for r in written.select("filename").toLocalIterator()], target := f"{folder}.zip")
    return files.list_archives(spark, target).select("name", "bytes", "intact")


@query(f"{SUPPLIER_FILES} SELECT filename, sha256(body) AS sha256 FROM f")
def verified_copies(spark, sf_dir):
    import os

    folder, written = _supplier_files(spark, sf_dir, "copy")
    os.makedirs(target := f"{folder}-copy")
    rows = [(r[0], sinks.copy_verified(f"{folder}/{r[0]}", f"{target}/{r[0]}")) for r in written.select("filename").toLocalIterator()]
    return spark.createDataFrame(rows, "filename string, sha256 string")


@query("SELECT n_nationkey AS id, n_name AS name, 'images/val' AS val FROM nation")
def dataset_descriptor(spark, sf_dir):
    path = f"{_folder(spark, 'yaml')}/data.yaml"
    sinks.write_dataset_yaml(path, "/data", dict(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").toLocalIterator()))
    config = files.read_config(path)
    return spark.createDataFrame([(k, v, config["val"]) for k, v in config["names"].items()], "id int, name string, val string")


@query("SELECT count(*)::BIGINT AS n, sum(n_chars)::BIGINT AS chars, list_sort(list_distinct(list(lang)))::VARCHAR AS langs FROM documents")
def json_document(spark, sf_dir):
    path = f"{_folder(spark, 'json')}/summary.json"
    docs = table(spark, sf_dir, "documents")
    sinks.write_json_document(docs.agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.array_sort(F.collect_set("lang")).alias("langs")), path)
    back = spark.read.schema("n long, chars long, langs array<string>").json(path, multiLine=True)
    return back.withColumn("langs", F.concat(F.lit("["), F.array_join("langs", ", "), F.lit("]")))


@query("SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations")
def csv_file(spark, sf_dir):
    path = f"{_folder(spark, 'csv')}/turns.csv"
    columns = ["conv_id", "turn", "role", "text"]
    sinks.write_csv_file(table(spark, sf_dir, "conversations"), path, columns, ["conv_id", "turn"])
    return files.read_csv(spark, path, columns)


@query("SELECT '# nations' || chr(10) || chr(10) || string_agg('- ' || n_name || ': ' || n_regionkey, chr(10) ORDER BY n_nationkey) || chr(10) || chr(10) || 'one line each' || chr(10) AS text FROM nation")
def readme_file(spark, sf_dir):
    path = f"{_folder(spark, 'readme')}/README.md"
    facts = dict(table(spark, sf_dir, "nation").orderBy("n_nationkey").select("n_name", "n_regionkey").toLocalIterator())
    sinks.write_readme(path, "nations", facts, ["one line each"])
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")


@query("SELECT html AS escaped, page_id FROM (SELECT page_id, replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS html FROM pages)")
def review_cells(spark, sf_dir):
    """The cells of a review page, as they are in its HTML."""
    rows = [r.asDict() for r in table(spark, sf_dir, "pages").select("page_id", "url").toLocalIterator()]
    cells = re.findall(r"<tr><td>([^<]*)</td><td>([^<]*)</td><td>", sinks.review_page(rows, "pages"))
    return spark.createDataFrame([(url, int(i)) for i, url in cells], "escaped string, page_id long")


@query(f"{POLY} SELECT (row_number() OVER (ORDER BY name) - 1)::INT AS image_id, name, n FROM (SELECT printf('%06d.jpg', (vec_id // 10 * 7919) % 1000003) AS name, count(*)::BIGINT AS n FROM p GROUP BY vec_id // 10)")
def merged_exports(spark, sf_dir):
    """Two exports, merged and numbered anew by name."""
    images = _images(spark, sf_dir).withColumn("name", F.format_string("%06d.jpg", (F.col("image_id").cast("long") * 7919) % 1000003))
    parts = []
    for k in (0, 1):
        sinks.write_export(images.where(F.col("image_id") % 2 == k), path := f"{Scratch(spark, 'merge').base}/export")
        parts.append(annotations.read_export(spark, path))
    return annotations.merge(parts).select(F.col("image_id").cast("int").alias("image_id"), "name", F.size("polygons").cast("long").alias("n"))


@query("SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN '  ' WHEN doc_id % 3 = 1 THEN ' ' || source || ' ' END), ''), 'unknown') AS origin FROM documents")
def optional_texts(spark, sf_dir):
    given = F.when(F.col("doc_id") % 3 == 0, "  ").when(F.col("doc_id") % 3 == 1, F.concat(F.lit(" "), "source", F.lit(" ")))
    return table(spark, sf_dir, "documents").select("doc_id", text_or(given, "unknown").alias("origin"))


@query("SELECT s_suppkey, hex(encode(s_name)) || 'FFD9' AS content FROM supplier")
def jpeg_ends(spark, sf_dir):
    """Half of the suppliers' bytes end with the marker already."""
    name = F.col("s_name").cast("binary")
    content = F.when(F.col("s_suppkey") % 2 == 0, F.concat(name, F.unhex(F.lit("FFD9")))).otherwise(name)
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.hex(with_jpeg_end(content)).alias("content"))


@query(
    f"""{SIGNALS} SELECT vec_id, array_to_string(list_sort(list_distinct(list_concat(list_concat(s, CASE WHEN vec_id % 2 = 0 THEN ['{review.OVERLAP}:2', '{review.CONCAVE}'] ELSE [] END),
    CASE WHEN vec_id % 5 = 0 THEN ['{review.MISSING}'] ELSE [] END))), '|') AS signals FROM q"""
)
def merged_signals(spark, sf_dir):
    paired = F.when(F.col("vec_id") % 2 == 0, F.array(F.lit(f"{review.OVERLAP}:2"), F.lit(review.CONCAVE)))
    rows = with_signals(spark, sf_dir)
    return rows.select("vec_id", F.array_join(review.merge_signals(F.col("signals"), paired, F.col("vec_id") % 5 != 0), "|").alias("signals"))


@query(
    """WITH d AS (SELECT doc_id, i AS box, ((doc_id * 31 + i * 17) % 100) / 100.0::DOUBLE AS confidence FROM documents, unnest(range(1 + n_chars % 7)) AS t(i))
    SELECT doc_id, box, confidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, box) AS n FROM d WHERE confidence >= 0.2) WHERE n <= 3"""
)
def batched_predictions(spark, sf_dir):
    """A stand-in for a model over chunks of rows: every row gives some boxes, the key stays with them."""

    def model(rows):
        out = rows.loc[rows.index.repeat(1 + rows["n_chars"] % 7), ["doc_id"]]
        out["box"] = out.groupby(level=0).cumcount()
        return out.assign(confidence=(out["doc_id"] * 31 + out["box"] * 17) % 100 / 100)

    boxes = features.predictions(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), model, "doc_id", "doc_id long, box long, confidence double", 16)
    return selection.capped_detections(boxes, "doc_id", "box", 0.2, 3)


@query(f"{LINES} SELECT 'train/' || label || '.txt' AS filename, sha256(string_agg(line, chr(10) ORDER BY vec_id) || chr(10)) AS sha256 FROM l GROUP BY label")
def label_folder(spark, sf_dir):
    """The label files of a split, on disk."""
    from sievework.functions.scalar import polygon_line

    folder = _folder(spark, "labels")
    line = polygon_line(F.col("points"), F.lit(1000), F.lit(1000))
    lines = polygons(spark, sf_dir).select(F.lit("train").alias("split"), F.col("label").cast("string").alias("stem"), F.col("vec_id").alias("instance_index"), line.alias("line"))
    content = sinks.label_files(lines).select(F.col("split").alias("subfolder"), "filename", F.col("value").cast("binary").alias("content"))
    Scratch(spark, "labels").save(sinks.write_files(content, folder), "written")
    return files.scan_files(spark, f"{folder}/train", [".txt"]).select(F.concat(F.lit("train/"), "filename").alias("filename"), "sha256")
