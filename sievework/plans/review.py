"""Polygons: geometry, review queues, export and import."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import geometry as g
from sievework.functions.scalar import drop_consecutive_points, golden_bgr, golden_hue, polygon_line, signal_text, stable_id
from sievework.functions.scratch import Scratch
from sievework.operators import features, render, review
from sievework.plans.registry import query, table
from sievework.sources import annotations, sinks

#: DuckDB: polygons of the first 3 + vec_id % 6 pairs of an embedding, on a 1000 x 1000 frame.
POLY = """WITH p AS (SELECT vec_id, label, 3 + vec_id % 6 AS n, list_transform(range(3 + vec_id % 6), lambda i: (embedding[2 * i + 1]::DOUBLE * 4 + 1) * 500) AS x,
list_transform(range(3 + vec_id % 6), lambda i: (embedding[2 * i + 2]::DOUBLE * 4 + 1) * 500) AS y FROM embeddings)"""
EDGES = """, e AS (SELECT vec_id, n, i, x[i + 1] AS px, y[i + 1] AS py, x[(i + 1) % n + 1] AS qx, y[(i + 1) % n + 1] AS qy FROM p, unnest(range(n)) AS t(i))"""


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: (F.col("embedding")[i].cast("double") * 4 + 1) * 500
    points = F.array(*(F.struct(at(2 * i).alias("x"), at(2 * i + 1).alias("y")) for i in range(8)))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.slice(points, F.lit(1), (3 + F.col("vec_id") % 6).cast("int")).alias("points"))


@query(f"{POLY}{EDGES} SELECT vec_id, round(abs(sum(px * qy - qx * py) / 2), 3) AS area, any_value(n)::INT AS n_points FROM e GROUP BY vec_id")
def polygon_area(spark, sf_dir):
    return polygons(spark, sf_dir).select("vec_id", F.round(g.area(F.col("points")), 3).alias("area"), F.size("points").alias("n_points"))


#: DuckDB: the sign of a turn a, b, c.
TURN = "CASE WHEN abs(({1}x - {0}x) * ({2}y - {0}y) - ({1}y - {0}y) * ({2}x - {0}x)) <= 1e-9 THEN 0 ELSE sign(({1}x - {0}x) * ({2}y - {0}y) - ({1}y - {0}y) * ({2}x - {0}x)) END"
SHAPES = f"""{POLY}{EDGES}, c AS (SELECT e.vec_id, {TURN.format("e.p", "e.q", "f.q")} AS turn FROM e JOIN e f ON e.vec_id = f.vec_id AND f.i = (e.i + 1) % e.n),
concave AS (SELECT vec_id, max(turn) > 0 AND min(turn) < 0 AS concave FROM c GROUP BY vec_id),
x AS (SELECT a.vec_id, {TURN.format("a.p", "a.q", "b.p")} AS o1, {TURN.format("a.p", "a.q", "b.q")} AS o2, {TURN.format("b.p", "b.q", "a.p")} AS o3, {TURN.format("b.p", "b.q", "a.q")} AS o4
      FROM e a JOIN e b ON a.vec_id = b.vec_id AND b.i > a.i + 1 AND NOT (a.i = 0 AND b.i = a.n - 1)),
cross_ AS (SELECT vec_id, bool_or(o1 <> o2 AND o3 <> o4) AS crossing FROM x GROUP BY vec_id),
near AS (SELECT a.vec_id, bool_or(sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2) <= 1e-6) AS twice FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.vec_id),
box AS (SELECT vec_id, any_value(n) AS n, abs(sum(px * qy - qx * py) / 2) AS area, bool_or(px <= 2 OR py <= 2 OR px >= 997 OR py >= 997) AS frame, bool_or(px < -1e-6 OR py < -1e-6 OR px > 1000 + 1e-6 OR py > 1000 + 1e-6) AS outside FROM e GROUP BY vec_id),
shape AS (SELECT p.vec_id, p.label, box.n, box.area, box.n >= 4 AND concave AS concave, box.n >= 4 AND coalesce(crossing, false) AS crossing, twice, frame, outside
      FROM p JOIN box USING (vec_id) JOIN concave USING (vec_id) LEFT JOIN cross_ USING (vec_id) JOIN near USING (vec_id))"""


@query(f"{SHAPES} SELECT vec_id, concave, crossing, twice, frame, outside FROM shape")
def polygon_shapes(spark, sf_dir):
    p, size = F.col("points"), F.lit(1000)
    return polygons(spark, sf_dir).select(
        "vec_id", g.is_concave(p).alias("concave"), g.is_self_intersecting(p).alias("crossing"), g.has_duplicate_vertices(p).alias("twice"),
        g.touches_frame(p, size, size, 2.0).alias("frame"), g.has_out_of_bounds_vertex(p, size, size).alias("outside"),
    )


SIGNALS = f"""{SHAPES}, q AS (SELECT vec_id, list_filter(['{review.UNVERIFIED}', CASE WHEN n = 3 THEN '{review.TRIANGULAR}' WHEN n > 4 THEN '{review.MULTISIDED}' END, CASE WHEN concave THEN '{review.CONCAVE}' END,
CASE WHEN frame THEN '{review.FRAME}' END, CASE WHEN twice THEN '{review.DUPLICATE_VERTEX}' END, CASE WHEN crossing THEN '{review.SELF_INTERSECTION}' END, CASE WHEN outside THEN '{review.OUT_OF_BOUNDS}' END,
CASE WHEN area / 1000000 < 0.002 THEN '{review.SMALL}' END, CASE WHEN label <> 3 THEN '{review.CLASS}' END], lambda s: s IS NOT NULL) AS s FROM shape)"""


def with_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = review.signals(F.col("points"), F.lit(1000), F.lit(1000), F.col("label").cast("string"), "3", 2.0, 0.002)
    return polygons(spark, sf_dir).withColumn("signals", found)


def _ladder(i: int) -> str:
    """SQL of one part of the guidance that a polygon's signals reach."""
    rungs = {
        "structure": [review.SELF_INTERSECTION, review.DUPLICATE_VERTEX, review.OUT_OF_BOUNDS],
        "small": [review.SMALL],
        "shape": [review.TRIANGULAR, review.MULTISIDED, review.CONCAVE, review.FRAME],
    }
    text = lambda rung: "'" + review.GUIDANCE[rung][i].replace("'", "''") + "'"
    return "CASE " + " ".join(f"WHEN list_has_any(s, {names}) THEN {text(rung)}" for rung, names in rungs.items()) + f" ELSE {text('other')} END"


@query(
    f"""{SIGNALS} SELECT printf('image-%04d-instance-%03d', vec_id // 10, vec_id % 10 + 1) AS stable_id, array_to_string(s, '|') AS signals,
    {", ".join(f"{_ladder(i)} AS {name}" for i, name in enumerate(["priority", "issue", "decision"]))} FROM q"""
)
def review_priority(spark, sf_dir):
    rows = with_signals(spark, sf_dir)
    name = stable_id(F.floor(F.col("vec_id") / 10), F.col("vec_id") % 10 + 1)
    return rows.select(name.alias("stable_id"), F.array_join("signals", "|").alias("signals"), review.guidance(F.col("signals")).alias("g")).select("stable_id", "signals", "g.*")


@query(f"{SIGNALS} SELECT u.s AS signal, count(*)::BIGINT AS n FROM q, unnest(q.s) AS u(s) GROUP BY 1")
def signal_counts(spark, sf_dir):
    return review.signal_counts(with_signals(spark, sf_dir), "signals", "vec_id")


@query("SELECT (3 + vec_id % 6)::INT AS n_points, count(*)::BIGINT AS n FROM embeddings GROUP BY 1 ORDER BY 1")
def vertex_histogram(spark, sf_dir):
    return polygons(spark, sf_dir).groupBy(F.size("points").alias("n_points")).agg(F.count(F.lit(1)).alias("n")).orderBy("n_points")


@query(
    """SELECT doc_id, l.doc_id IS NOT NULL AS source_exists, n_chars // 500 AS instances, CASE WHEN l.doc_id IS NULL THEN 'RESTORE_SOURCE' WHEN n_chars // 500 = 0 THEN 'CONFIRM_EMPTY' ELSE 'REVIEW_INSTANCES' END AS decision
    FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def image_queue(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("e"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("n_chars") / 500).alias("instances")).join(labels, "doc_id", "left")
    exists = F.coalesce("e", F.lit(False))
    return rows.select("doc_id", exists.alias("source_exists"), "instances", review.image_decision(exists, F.col("instances")).alias("decision"))


LINES = f"""{POLY}, l AS (SELECT vec_id, label, '0 ' || array_to_string(list_transform(range(n), lambda i: printf('%.8f', least(1, greatest(0, x[i + 1] / 1000))) || ' ' || printf('%.8f', least(1, greatest(0, y[i + 1] / 1000)))), ' ') AS line FROM p)"""


@query(f"{LINES} SELECT vec_id, line FROM l")
def polygon_lines(spark, sf_dir):
    return polygons(spark, sf_dir).select("vec_id", polygon_line(F.col("points"), F.lit(1000), F.lit(1000)).alias("line"))


@query(f"{LINES} SELECT 'train' AS split, label || '.txt' AS filename, string_agg(line, chr(10) ORDER BY vec_id) || chr(10) AS value FROM l GROUP BY label")
def label_files(spark, sf_dir):
    lines = polygons(spark, sf_dir).select(F.lit("train").alias("split"), F.col("label").cast("string").alias("stem"), F.col("vec_id").alias("instance_index"), polygon_line(F.col("points"), F.lit(1000), F.lit(1000)).alias("line"))
    return sinks.label_files(lines)


@query(
    """WITH t AS (SELECT conv_id, string_split(array_to_string(list(role ORDER BY turn), ';'), ';') AS s FROM conversations GROUP BY conv_id)
    SELECT conv_id, array_to_string(list_transform(list_filter(range(len(s)), lambda i: i = 0 OR s[i + 1] <> s[i]), lambda i: s[i + 1]), ';') AS kept FROM t"""
)
def consecutive_tokens(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda t: t["role"]), ";").alias("s"))
    return rows.select("conv_id", drop_consecutive_points(F.col("s")).alias("kept"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.array_join(F.transform("points", lambda p: F.concat_ws(",", F.round(p["x"], 2).cast("string"), F.round(p["y"], 2).cast("string"))), ";")
    polygon = F.struct(F.col("vec_id"), text.alias("raw_points"), F.lit("face").alias("label"), F.lit("manual").alias("source"), (F.col("vec_id") % 2 == 0).alias("occluded"), F.lit(0).alias("z_order"), F.create_map(F.lit("id"), F.col("vec_id").cast("string")).alias("attributes"))
    rows = polygons(spark, sf_dir).groupBy(F.floor(F.col("vec_id") / 10).cast("int").alias("image_id")).agg(F.array_sort(F.collect_list(polygon), lambda a, b: (a["vec_id"] - b["vec_id"]).cast("int")).alias("p"))
    kept = F.transform("p", lambda p: p.dropFields("vec_id"))
    return rows.select("image_id", F.format_string("%06d.jpg", "image_id").alias("name"), F.lit(1000).alias("width"), F.lit(1000).alias("height"), kept.alias("polygons"))


@query(
    f"""{POLY} SELECT (vec_id // 10)::INT AS image_id, printf('%06d.jpg', vec_id // 10) AS name, (vec_id % 10 + 1)::INT AS instance_index, 'face' AS label, vec_id % 2 = 0 AS occluded, vec_id::VARCHAR AS attribute, n::INT AS n_points FROM p"""
)
def xml_instances(spark, sf_dir):
    scratch = Scratch(spark, "xml")
    sinks.write_export(_images(spark, sf_dir), path := f"{scratch.base}/export")
    rows = annotations.instances(annotations.normalise(annotations.read_export(spark, path)))
    return rows.select("image_id", "name", "instance_index", "label", "occluded", F.col("attributes")["id"].alias("attribute"), F.size("points").alias("n_points"))


def small_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-ins for decoded images: 8 x 8 grey ones, made of embeddings."""
    byte = F.transform("embedding", lambda v: F.lpad(F.hex(F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), v.cast("double") * 400 + 128)))), 2, "0"))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("filename"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), F.unhex(F.array_join(byte, "")).alias("data"))


#: DuckDB: the pixels of polygons on a raster of 250 x 250, interior and outline.
RASTER = f"""{POLY}, v AS (SELECT vec_id, i, round_even(x[i + 1]::FLOAT * 0.25::FLOAT, 0)::DOUBLE AS px, round_even(y[i + 1]::FLOAT * 0.25::FLOAT, 0)::DOUBLE AS py,
    round_even(x[(i + 1) % n + 1]::FLOAT * 0.25::FLOAT, 0)::DOUBLE AS qx, round_even(y[(i + 1) % n + 1]::FLOAT * 0.25::FLOAT, 0)::DOUBLE AS qy FROM p, unnest(range(n)) AS t(i)),
cuts AS (SELECT vec_id, r, px + (r - py) * (qx - px) / (qy - py) AS cx FROM v, unnest(range(greatest(0, least(py, qy))::BIGINT, least(250, greatest(py, qy))::BIGINT)) AS t(r) WHERE py <> qy),
spans AS (SELECT vec_id, r, cx AS lo, lead(cx) OVER w AS hi, row_number() OVER w AS k FROM cuts WINDOW w AS (PARTITION BY vec_id, r ORDER BY cx)),
inner_ AS (SELECT vec_id, r, c FROM spans, unnest(range(greatest(0, ceil(lo))::BIGINT, least(250, greatest(0, floor(hi) + 1))::BIGINT)) AS t(c) WHERE k % 2 = 1),
steps AS (SELECT *, greatest(abs(qx - px), abs(qy - py))::BIGINT AS d FROM v),
edge AS (SELECT vec_id, CASE WHEN k = d THEN qy ELSE round_even(k * ((qy - py) / greatest(1, d)) + py, 0) END::BIGINT AS r, CASE WHEN k = d THEN qx ELSE round_even(k * ((qx - px) / greatest(1, d)) + px, 0) END::BIGINT AS c FROM steps, unnest(range(d + 1)) AS t(k)),
pixels AS (SELECT vec_id, r, c FROM inner_ UNION SELECT vec_id, r, c FROM edge WHERE r BETWEEN 0 AND 249 AND c BETWEEN 0 AND 249)"""


@query(
    f"""{RASTER}, size AS (SELECT vec_id, count(*) AS n FROM pixels GROUP BY vec_id),
    shared AS (SELECT a.vec_id AS a, b.vec_id AS b, count(*) AS n FROM pixels a JOIN pixels b ON a.vec_id // 10 = b.vec_id // 10 AND a.r = b.r AND a.c = b.c AND a.vec_id <> b.vec_id GROUP BY ALL),
    k AS (SELECT a, b, CASE WHEN shared.n / (x.n + y.n - shared.n)::DOUBLE >= 0.6 THEN '{review.DUPLICATE}' WHEN shared.n / least(x.n, y.n)::DOUBLE >= 0.2 THEN '{review.OVERLAP}' END AS kind FROM shared JOIN size x ON x.vec_id = a JOIN size y ON y.vec_id = b)
    SELECT a // 10 AS image_id, (a % 10 + 1)::INT AS instance_index, string_agg(kind || ':' || (b % 10 + 1), '|' ORDER BY b) AS signals FROM k WHERE kind IS NOT NULL GROUP BY a"""
)
def raster_overlap(spark, sf_dir):
    """Pixel masks of an image's polygons."""
    rows = polygons(spark, sf_dir).select(F.floor(F.col("vec_id") / 10).alias("image_id"), (F.col("vec_id") % 10 + 1).cast("int").alias("instance_index"), F.lit(1000).alias("width"), F.lit(1000).alias("height"), "points")
    return review.overlap_signals(rows, overlap=0.2, duplicate=0.6).withColumn("signals", F.array_join("signals", "|"))


@query(
    """WITH g AS (SELECT vec_id, list_transform(embedding, lambda v: floor(least(255, greatest(0, v::DOUBLE * 400 + 128)))) AS g FROM embeddings),
    a AS (SELECT vec_id, g, g[i + 1] AS v, i // 8 AS y, i % 8 AS x FROM g, unnest(range(64)) AS t(i)),
    s AS (SELECT vec_id, avg(v) AS mean, stddev_pop(v) AS std, avg((v <= 15)::INT) AS dark, avg((v >= 240)::INT) AS bright,
      var_pop(g[abs(y - 1) * 8 + x + 1] + g[(7 - abs(6 - y)) * 8 + x + 1] + g[y * 8 + abs(x - 1) + 1] + g[y * 8 + (7 - abs(6 - x)) + 1] - 4 * v) AS blur FROM a GROUP BY vec_id),
    w AS (SELECT u, i, sum(cos(pi() * u * (2 * (4 * i + k) + 1) / 64)) * sqrt(CASE WHEN u = 0 THEN 1 ELSE 2 END / 32.0::DOUBLE) AS w FROM unnest(range(8)) AS a(u), unnest(range(8)) AS b(i), unnest(range(4)) AS c(k) GROUP BY u, i),
    d AS (SELECT vec_id, p.u * 8 + q.u - 1 AS bit, sum(v * p.w * q.w) AS d FROM a JOIN w p ON p.i = y JOIN w q ON q.i = x WHERE p.u + q.u > 0 GROUP BY vec_id, p.u, q.u),
    m AS (SELECT vec_id, median(d) AS m FROM d GROUP BY vec_id),
    h AS (SELECT vec_id, sum(CASE WHEN d > m THEN 1::BIGINT << bit::INT ELSE 0 END)::BIGINT AS phash FROM d JOIN m USING (vec_id) GROUP BY vec_id)
    SELECT vec_id::VARCHAR AS filename, 8 AS width, 8 AS height, 1 AS channels, true AS readable, 1.0::DOUBLE AS aspect_ratio, round(mean, 6) AS brightness_mean, round(std, 6) AS contrast_std,
    round(blur, 6) AS blur_laplacian_variance, round(dark, 6) AS dark_fraction, round(bright, 6) AS bright_fraction, phash FROM s JOIN h USING (vec_id)"""
)
def pixel_features(spark, sf_dir):
    """Pixel statistics of 8 x 8 grey images made of embeddings."""
    rows = small_images(spark, sf_dir)
    out = rows.mapInPandas(features.inspect, features._SCHEMA)
    return out.select(*((F.round(c, 6).alias(c) if kind == "double" else F.col(c)) for c, kind in out.dtypes))


@query(
    f"""{SIGNALS} SELECT vec_id, array_to_string(list_transform(s, lambda t: CASE WHEN t = '{review.CONCAVE}' THEN 'concave' ELSE t END), ', ') AS words, floor((vec_id * 0.618033988749895) % 1 * 180)::INT AS hue FROM q"""
)
def overlay_legend(spark, sf_dir):
    rows = with_signals(spark, sf_dir)
    return rows.select("vec_id", F.array_join(F.transform("signals", lambda s: signal_text(s, {review.CONCAVE: "concave"})), ", ").alias("words"), golden_hue(F.col("vec_id")).alias("hue"))


@query(
    """WITH h AS (SELECT vec_id, (vec_id * 0.61803398875::DOUBLE) % 1 * 6 AS s FROM embeddings), f AS (SELECT vec_id, floor(s)::INT AS i, s - floor(s) AS f FROM h),
    v AS (SELECT vec_id, i, 0.18::DOUBLE AS p, 1 - 0.82::DOUBLE * f AS q, 1 - 0.82::DOUBLE * (1 - f) AS t, 1::DOUBLE AS v FROM f)
    SELECT vec_id, floor([p, p, t, v, v, q][i + 1] * 255)::INT AS b, floor([t, v, v, q, p, p][i + 1] * 255)::INT AS g, floor([v, q, p, p, t, v][i + 1] * 255)::INT AS r FROM v"""
)
def instance_colours(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", golden_bgr(F.col("vec_id")).alias("c")).select("vec_id", "c.*")


@query("SELECT vec_id::VARCHAR AS filename, 6 AS width, 6 AS height FROM embeddings")
def overlay_sizes(spark, sf_dir):
    """Polygons drawn over 8 x 8 stand-ins, at most 6 pixels a side."""
    points = F.transform("points", lambda p: F.struct((p["x"] / 125).alias("x"), (p["y"] / 125).alias("y")))
    shapes = polygons(spark, sf_dir).select(F.col("vec_id").cast("string").alias("filename"), F.lit(1).alias("instance_index"), points.alias("points"))
    return render.overlays(small_images(spark, sf_dir), shapes, 6).select("filename", render.png_size(F.col("content")).alias("s")).select("filename", "s.*")


@query("SELECT p AS page, (p - 1) * 12 + 1 AS first, count(*)::BIGINT AS n, 108 AS width, (30 * ceil(count(*) / 3.0))::INT AS height FROM (SELECT (row_number() OVER (ORDER BY vec_id::VARCHAR) - 1) // 12 + 1 AS p FROM embeddings) GROUP BY p")
def contact_sheets(spark, sf_dir):
    sheets = render.contact_sheets(small_images(spark, sf_dir), ["filename"], cell=(36, 30), border=1, head=12)
    return sheets.select("page", "first", "n", render.png_size(F.col("content")).alias("s")).select("page", "first", "n", "s.*")
