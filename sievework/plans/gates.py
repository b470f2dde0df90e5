"""Links of scenes, uncertainty, tallies and the gates of a selection and a package."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions.scalar import column_subset, half_even, sha256
from sievework.operators import dedup, grouping, selection, validation
from sievework.plans.audit import SIGNATURES, signatures
from sievework.plans.curate import detection_aggregates
from sievework.plans.registry import ORACLES, query, table


@query("SELECT g.first AS a, d.doc_id AS b FROM documents d JOIN (SELECT text, min(doc_id) AS first FROM documents GROUP BY text HAVING count(*) > 1) g USING (text) WHERE d.doc_id <> g.first")
def exact_dup_star(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", sha256(F.col("text")).alias("sha256"))
    return grouping.star_edges(docs, "doc_id", "sha256")


@query(
    f"""{SIGNATURES}, x AS (SELECT embedding::VARCHAR AS e, vec_id FROM embeddings), g AS (SELECT e, min(vec_id) AS first FROM x GROUP BY e HAVING count(*) > 1),
    c AS (SELECT event_id AS b, lag(event_id) OVER w AS a, ts AS t, lag(ts) OVER w AS p FROM events WINDOW w AS (ORDER BY ts, event_id))
    SELECT g.first AS a, x.vec_id AS b, 'exact' AS kind FROM x JOIN g USING (e) WHERE x.vec_id <> g.first
    UNION ALL SELECT l.vec_id, r.vec_id, 'near' FROM s l JOIN s r ON l.vec_id < r.vec_id AND bit_count(xor(l.sig, r.sig)) <= 6
    UNION ALL SELECT a, b, 'time' FROM c WHERE a IS NOT NULL AND t - p <= INTERVAL 3 SECOND"""
)
def scene_edges(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.xxhash64("embedding").alias("content"))
    near = dedup.near_pairs(signatures(spark, sf_dir), "vec_id", F.col("sig"), 6)
    chain = grouping.chain_edges(table(spark, sf_dir, "events"), "event_id", "ts", 3)
    return grouping.scene_edges(grouping.star_edges(vectors, "vec_id", "content"), near, chain)


@query(f"SELECT o_orderkey, round(1 - confidence_mean + low_confidence_fraction, 6) AS uncertainty FROM ({ORACLES['detection_aggregates']})")
def uncertainty(spark, sf_dir):
    stats = detection_aggregates(spark, sf_dir)
    return stats.select("o_orderkey", F.round(selection.uncertainty(F.col("confidence_mean"), F.col("low_confidence_fraction")), 6).alias("uncertainty"))


@query(
    """SELECT l_orderkey, l_linenumber, l_discount FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber) AS n
    FROM lineitem WHERE l_discount >= 0.03) WHERE n <= 3"""
)
def capped_detections(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("confidence"))
    return selection.capped_detections(rows, "l_orderkey", "l_linenumber", 0.03, 3).withColumnRenamed("confidence", "l_discount")


@query("SELECT source, count(*)::BIGINT AS size, coalesce(bool_or(l.toxic = 1), false) AS any_accepted FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY source")
def scene_flags(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return validation.group_flags(rows, "source", F.col("toxic") == 1)


@query("SELECT m AS lang, count(lang)::BIGINT AS n FROM (SELECT unnest(['en', 'de', 'fr', 'es', 'none']) AS m) LEFT JOIN documents ON lang = m GROUP BY m")
def method_tallies(spark, sf_dir):
    return validation.tallies(table(spark, sf_dir, "documents"), "lang", ["en", "de", "fr", "es", "none"])


@query("SELECT doc_id, round_even(n_chars / 8.0::DOUBLE, 2)::DOUBLE AS rounded FROM documents")
def rounded_half_even(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", half_even(F.col("n_chars") / F.lit(8.0), 2).alias("rounded"))


@query("SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, coalesce(toxic::VARCHAR, '') AS toxic, '' AS reviewer FROM labels")
def column_subsets(spark, sf_dir):
    return column_subset(table(spark, sf_dir, "labels"), ["doc_id", "toxic", "reviewer"])


@query(
    """WITH sel AS (SELECT doc_id AS name FROM documents WHERE doc_id % 10 = 0), inv AS (SELECT doc_id AS name, CASE WHEN l.doc_id IS NULL THEN 'UNLABELED' ELSE 'OWNER_ACCEPTED' END AS status
    FROM documents LEFT JOIN labels l USING (doc_id) WHERE doc_id % 20 <> 0), bad AS (SELECT sel.name, status FROM sel LEFT JOIN inv USING (name))
    SELECT 'not_unlabeled' AS gate, name::VARCHAR AS name FROM bad WHERE coalesce(status <> 'UNLABELED', true)
    UNION ALL SELECT 'holdout_in_cache', doc_id::VARCHAR FROM documents WHERE source IN ('src1', 'src2')
    UNION ALL SELECT 'not_the_number', count(*)::VARCHAR FROM sel HAVING count(*) <> 60"""
)
def selection_gates(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    selected = docs.where("doc_id % 10 = 0").select(F.col("doc_id").alias("name"))
    status = F.when(F.col("toxic_id").isNull(), "UNLABELED").otherwise("OWNER_ACCEPTED")
    inventory = docs.where("doc_id % 20 <> 0").select("doc_id").join(labels.select("doc_id", F.col("doc_id").alias("toxic_id")), "doc_id", "left").select(F.col("doc_id").alias("name"), status.alias("status"))
    cache = docs.select(F.col("doc_id").alias("name"), F.col("source").alias("group"))
    return validation.selection_violations(selected, inventory, cache, cache.where("`group` IN ('src1', 'src2')").select("group"), 60)


@query(
    """WITH e AS (SELECT page_id, sha256(html) AS h FROM pages WHERE page_id % 5 <> 0), a AS (SELECT page_id, sha256(CASE WHEN page_id % 7 = 0 THEN html || ' ' ELSE html END) AS h FROM pages WHERE page_id % 3 <> 0),
    b AS (SELECT e.page_id AS l, a.page_id AS r, e.h AS x, a.h AS y FROM e FULL JOIN a ON e.page_id = a.page_id),
    c AS (SELECT count(l)::BIGINT AS n_expected, count(r)::BIGINT AS n_found, (count(*) FILTER (WHERE r IS NULL))::BIGINT AS n_missing, (count(*) FILTER (WHERE l IS NULL))::BIGINT AS n_unexpected, (count(*) FILTER (WHERE x <> y))::BIGINT AS n_changed FROM b)
    SELECT *, n_missing + n_unexpected + n_changed = 0 AS ok FROM c"""
)
def package_report(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    changed = F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html"))
    expected = pages.where("page_id % 5 <> 0").select("page_id", sha256(F.col("html")).alias("h"))
    return validation.package_report(expected, pages.where("page_id % 3 <> 0").select("page_id", sha256(changed).alias("h")), "page_id", "h")
