"""Selection: ranks, scores, reasons, representatives and greedy batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.ranks import medians
from sievework.operators import review, selection
from sievework.plans.audit import SIGNATURES, signatures
from sievework.plans.registry import query, table


@query("SELECT event_id, value, (row_number() OVER (ORDER BY value, event_id) - 1)::DOUBLE / greatest(1, count(*) OVER () - 1) AS rank FROM events")
def rank_percentiles(spark, sf_dir):
    return selection.rank_percentiles(table(spark, sf_dir, "events").select("event_id", "value"), {"rank": F.col("value")}, "event_id")


@query("SELECT o_orderkey, o_custkey, row_number() OVER w AS number, (row_number() OVER w - 1) // 12 + 1 AS page FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def sequence_numbers(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return review.pages(rows, ["o_orderdate", "o_orderkey"], 12, ["o_custkey"]).select("o_orderkey", "o_custkey", F.col("number").cast("long").alias("number"), F.col("page").cast("long").alias("page"))


@query("SELECT source, arg_max(doc_id, (n_chars, doc_id)) AS doc_id, max(n_chars) AS n_chars FROM documents GROUP BY source")
def top1_per_group(spark, sf_dir):
    best = table(spark, sf_dir, "documents").groupBy("source").agg(F.max_by(F.struct("doc_id", "n_chars"), F.struct("n_chars", "doc_id")).alias("x"))
    return best.select("source", "x.doc_id", "x.n_chars")


REPRESENTATIVE = """m AS (SELECT median(n_chars)::DOUBLE AS a, median(ln(1 + n_chars))::DOUBLE AS b FROM documents),
r AS (SELECT source, doc_id, abs(n_chars - a) / 30.0 + abs(ln(1 + n_chars) - b) AS score FROM documents, m)"""


@query(f"WITH {REPRESENTATIVE} SELECT source, arg_min(doc_id, (score, doc_id)) AS doc_id, round(min(score), 6) AS score, count(*)::BIGINT AS size FROM r GROUP BY source")
def min_by_representative(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    middle = medians(docs, {"a": F.col("n_chars"), "b": F.log1p("n_chars")})
    rows = docs.join(F.broadcast(middle), F.lit(True))
    score = F.abs(F.col("n_chars") - F.col("a")) / 30 + F.abs(F.log1p("n_chars") - F.col("b"))
    return selection.central_representatives(rows, "source", "doc_id", score).withColumn("score", F.round("score", 6))


@query(
    f"""{SIGNATURES}, f AS (SELECT label, min(vec_id) AS first, count(*) AS size FROM s GROUP BY label),
    p AS (SELECT s.label, s.vec_id, f.size, row_number() OVER (PARTITION BY s.label ORDER BY bit_count(xor(s.sig, t.sig)) DESC, s.vec_id DESC) AS n
          FROM s JOIN f ON s.label = f.label AND s.vec_id <> f.first JOIN s t ON t.vec_id = f.first)
    SELECT label, vec_id, size::BIGINT AS size FROM p WHERE n = 1 ORDER BY size DESC, label LIMIT 6"""
)
def second_pick(spark, sf_dir):
    s = signatures(spark, sf_dir)
    firsts = s.groupBy("label").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("size"))
    return selection.second_picks(s, firsts, "label", "vec_id", "sig", F.lit(0.0), 6).select("label", "vec_id", "size")


@query("SELECT doc_id, round(n_chars / 1000.0 - 0.0025 * greatest(0, n_chars // 50 - 40), 6) AS adjusted FROM documents ORDER BY n_chars / 1000.0 - 0.0025 * greatest(0, n_chars // 50 - 40) DESC, doc_id LIMIT 60")
def adjusted_score_order(spark, sf_dir):
    adjusted = selection.adjusted_score(F.col("n_chars") / 1000, F.floor(F.col("n_chars") / 50), 40, 0.0025)
    rows = table(spark, sf_dir, "documents").select("doc_id", adjusted.alias("a"))
    return rows.orderBy(F.desc("a"), "doc_id").limit(60).select("doc_id", F.round("a", 6).alias("adjusted"))


OOD = {"l_quantity": False, "l_extendedprice": True, "l_discount": False, "l_tax": False}


def _ood_sql() -> str:
    value = {c: f"ln(1 + {c})" if log else c for c, log in OOD.items()}
    medians = ", ".join(f"median({v}) AS m_{c}" for c, v in value.items())
    spread = ", ".join(f"greatest(median(abs({v} - m_{c})) * 1.4826, 1e-6) AS s_{c}" for c, v in value.items())
    parts = " + ".join(f"least(6.0, abs({v} - m_{c}) / s_{c})" for c, v in value.items())
    return f"""WITH a AS (SELECT * FROM lineitem WHERE l_returnflag = 'A'), m AS (SELECT {medians} FROM a), d AS (SELECT {spread} FROM a, m)
    SELECT l_orderkey, l_linenumber, round(({parts}) / {len(OOD)}, 6) AS ood_score FROM lineitem, m, d WHERE l_returnflag = 'R'"""


@query(_ood_sql())
def robust_ood(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *OOD)
    scored = selection.ood_score(rows.where("l_returnflag = 'R'"), rows.where("l_returnflag = 'A'"), OOD)
    return scored.select("l_orderkey", "l_linenumber", F.round("ood_score", 6).alias("ood_score"))


RANKS = list(selection.WEIGHTS)


def _score_sql() -> str:
    ranks = ", ".join(f"(row_number() OVER (ORDER BY embedding[{i + 2}], vec_id) - 1)::DOUBLE / greatest(1, count(*) OVER () - 1) AS {r}" for i, r in enumerate(RANKS))
    total = " + ".join(f"{w} * {r}" for r, w in selection.WEIGHTS.items())
    reasons = ", ".join(f"CASE WHEN {r} >= 0.75 THEN '{t}' END" for r, t in selection.REASONS.items())
    return f"""WITH r AS (SELECT vec_id, floor(abs(embedding[1]) * 100)::BIGINT % 8 AS n, {ranks} FROM embeddings)
    SELECT vec_id, round({total} + CASE WHEN n = 0 THEN 0.08 ELSE 0 END, 9) AS selection_score,
    coalesce(nullif(array_to_string(list_filter([CASE WHEN n = 0 THEN '{selection.ZERO_REASON}' END, {reasons}], lambda x: x IS NOT NULL)[1:3], ';'), ''), '{selection.DEFAULT_REASON}') AS selection_reason FROM r"""


def scored_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    rows = e.select("vec_id", "label", dedup_sig().alias("sig"), (F.floor(F.abs(F.col("embedding")[0].cast("double")) * 100) % 8).alias("n"), *(F.col("embedding")[i + 1].alias(f"_{r}") for i, r in enumerate(RANKS)))
    rows = selection.rank_percentiles(rows, {r: F.col(f"_{r}") for r in RANKS}, "vec_id")
    return rows.select("vec_id", "label", "sig", "n", selection.selection_score(F.col("n")).alias("selection_score"), selection.selection_reason(F.col("n")).alias("selection_reason"))


def dedup_sig():
    from sievework.operators.dedup import median_bits

    return median_bits(F.col("embedding"))


@query(_score_sql().replace("floor(abs(embedding[1]) * 100)", "floor(abs(embedding[1]::DOUBLE) * 100)"))
def composite_score(spark, sf_dir):
    return scored_candidates(spark, sf_dir).select("vec_id", F.round("selection_score", 9).alias("selection_score"), "selection_reason")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored_candidates(spark, sf_dir)
    return rows.select(F.col("vec_id").alias("id"), F.col("label").alias("group"), F.col("selection_score").alias("score"), "sig", (F.col("n") == 0).alias("zero"))


def _greedy_sql(score: str) -> tuple[str, str]:
    """SQL of the records (id, g, score, sig, zero), and of the list of lists that holds a greedy choice's state."""
    scored = _score_sql().replace("floor(abs(embedding[1]) * 100)", "floor(abs(embedding[1]::DOUBLE) * 100)")
    total = " + ".join(f"{w} * {r}" for r, w in selection.WEIGHTS.items())
    ranked = scored[: scored.index("SELECT vec_id, round(")].replace("WITH r AS (SELECT vec_id, ", "r AS (SELECT vec_id, label, ")
    records = f"{SIGNATURES.replace('WITH v', 'WITH RECURSIVE v')}, {ranked}, x AS (SELECT vec_id AS id, r.label AS g, {total} + CASE WHEN n = 0 THEN 0.08 ELSE 0 END AS score, sig, n = 0 AS zero FROM r JOIN s USING (vec_id))"
    return records.replace(" AS score, sig", f" AS raw, sig") + f", y AS (SELECT *, {score} AS score FROM x)", "list_filter(c, lambda h: bit_count(xor(h.sig, y.sig)) <= 6)"


def _diverse_sql(k: int, per_group: int, most_zero: int) -> str:
    records, near = _greedy_sql("raw")
    return f"""{records}, best AS (SELECT arg_max(id, (score, id)) AS id FROM y GROUP BY g),
    o AS (SELECT *, row_number() OVER (ORDER BY phase, score DESC, g, id) AS place FROM (SELECT y.*, 1 AS phase FROM y SEMI JOIN best USING (id) UNION ALL SELECT y.*, 2 FROM y)),
    t(place, c) AS (SELECT 0::BIGINT, []::STRUCT(id BIGINT, g INT, score DOUBLE, sig BIGINT, zero BOOLEAN)[]
      UNION ALL SELECT y.place, CASE WHEN len(c) < {k} AND len(list_filter(c, lambda h: h.id = y.id)) = 0 AND len(list_filter(c, lambda h: h.g = y.g)) < {per_group}
        AND NOT (y.zero AND len(list_filter(c, lambda h: h.zero)) >= {most_zero}) AND len({near}) = 0
        THEN list_append(c, struct_pack(id := y.id, g := y.g::INT, score := y.score::DOUBLE, sig := y.sig, zero := y.zero)) ELSE c END FROM t JOIN o y ON y.place = t.place + 1),
    last AS (SELECT c FROM t ORDER BY place DESC LIMIT 1)
    SELECT i::INT AS batch_order, c[i].id AS id, c[i].g AS "group", round(c[i].score, 9) AS score FROM last, unnest(range(1, len(c) + 1)) AS u(i)"""


def _scenes_sql() -> str:
    records, near = _greedy_sql("raw - 0.0025 * greatest(0, id % 100 - 40)")
    return f"""{records}, o AS (SELECT *, row_number() OVER (ORDER BY top DESC, g, score DESC, id) AS place FROM (SELECT *, max(score) OVER (PARTITION BY g) AS top FROM y)),
    t(place, c) AS (SELECT 0::BIGINT, []::STRUCT(id BIGINT, g INT, score DOUBLE, sig BIGINT)[]
      UNION ALL SELECT y.place, CASE WHEN len(list_filter(c, lambda h: h.g = y.g)) = 0 AND len({near}) = 0
        THEN list_append(c, struct_pack(id := y.id, g := y.g::INT, score := y.score::DOUBLE, sig := y.sig)) ELSE c END FROM t JOIN o y ON y.place = t.place + 1),
    last AS (SELECT c FROM t ORDER BY place DESC LIMIT 1)
    SELECT i::INT AS batch_order, c[i].id AS id, c[i].g AS "group", round(c[i].score, 9) AS score FROM last, unnest(range(1, len(c) + 1)) AS u(i)"""


def _batch(spark: SparkSession, chosen: list) -> DataFrame:
    return spark.createDataFrame([(i, r["id"], r["group"], round(float(r["score"]), 9)) for i, r in enumerate(chosen, 1)], "batch_order int, id long, group int, score double")


@query(_diverse_sql(60, 4, 6))
def greedy_diverse(spark, sf_dir):
    """Sequential: each choice depends on those before."""
    return _batch(spark, selection.select_diverse(_records(spark, sf_dir), 60, 4, 6, 6))


@query(_scenes_sql())
def scene_representatives(spark, sf_dir):
    """Sequential: each choice depends on those before."""
    rows = _records(spark, sf_dir)
    adjusted = selection.adjusted_score(F.col("score"), F.col("id") % 100, 40, 0.0025)
    return _batch(spark, selection.scene_representatives(rows.withColumn("score", adjusted), 6))


BOXES = "l_orderkey, l_linenumber, l_discount * 10 AS confidence, l_discount AS x1, l_tax AS y1, l_discount + l_quantity / 100 AS x2, l_tax + l_quantity / 200 AS y2"


@query(
    f"""WITH b AS (SELECT {BOXES} FROM lineitem), s AS (SELECT l_orderkey, count(*) AS a, count(*) FILTER (WHERE confidence >= 0.5) AS b, avg(confidence) FILTER (WHERE confidence >= 0.5) AS c,
    median(confidence) FILTER (WHERE confidence >= 0.5) AS d, avg((confidence < 0.5)::INT) AS e, avg(((x2 - x1) * (y2 - y1) < 0.003)::INT) FILTER (WHERE confidence >= 0.5) AS f,
    min((x2 - x1) * (y2 - y1)) FILTER (WHERE confidence >= 0.5) AS g FROM b GROUP BY l_orderkey)
    SELECT o_orderkey, coalesce(a, 0)::BIGINT AS detection_count_low, coalesce(b, 0)::BIGINT AS detection_count_standard, round(coalesce(c, 0.0), 6) AS confidence_mean, round(coalesce(d, 0.0), 6) AS confidence_median,
    round(coalesce(e, 1.0), 6) AS low_confidence_fraction, round(coalesce(f, 1.0), 6) AS small_face_fraction, round(coalesce(g, 0.0), 6) AS minimum_box_area_fraction FROM orders LEFT JOIN s ON o_orderkey = l_orderkey"""
)
def detection_aggregates(spark, sf_dir):
    boxes = table(spark, sf_dir, "lineitem").selectExpr(*BOXES.split(", ")).withColumnRenamed("l_orderkey", "o_orderkey")
    out = selection.detection_stats(boxes, table(spark, sf_dir, "orders"), "o_orderkey", 0.5)
    return out.select(*(F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in out.dtypes))


@query(
    f"""WITH b AS (SELECT {BOXES} FROM lineitem), p AS (SELECT a.l_orderkey, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i,
    (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS u FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber),
    f AS (SELECT l_orderkey, avg((i / (u - i) >= 0.05)::INT) AS f FROM p GROUP BY l_orderkey)
    SELECT DISTINCT l_orderkey, round(coalesce(f, 0.0), 9) AS crowding_iou_fraction FROM b LEFT JOIN f USING (l_orderkey)"""
)
def box_iou_fraction(spark, sf_dir):
    boxes = table(spark, sf_dir, "lineitem").selectExpr(*BOXES.split(", "))
    out = selection.overlap_fraction(boxes, "l_orderkey", "l_linenumber")
    return out.withColumn("crowding_iou_fraction", F.round("crowding_iou_fraction", 9))
