"""Inventory, duplicates, groups, splits and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.functions.scalar import hex_to_long, impossible_capture_time, iso_text, long_to_hex, parse_capture_time, sha256, split_name, stem, suffix
from sievework.functions.scratch import Scratch
from sievework.operators import dedup, grouping, splits, validation
from sievework.plans.registry import query, table

RATIOS, SEED = {"train": 0.7, "validation": 0.15, "test": 0.15}, 20260731
SPLIT = "CASE WHEN CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) % 10 < 7 THEN 'train' WHEN CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) % 10 < 9 THEN 'validation' ELSE 'test' END"
#: DuckDB: 63-bit signatures of embeddings[1..63] against their median.
SIGNATURES = """WITH v AS (SELECT vec_id, label, embedding[2:64] AS v FROM embeddings),
m AS (SELECT *, list_aggregate(v, 'median') AS med FROM v),
s AS (SELECT vec_id, label, list_sum(list_transform(range(63), lambda i: CASE WHEN v[i + 1] > med THEN 1::BIGINT << i::INT ELSE 0 END))::BIGINT AS sig FROM m)"""


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", dedup.median_bits(F.col("embedding")).alias("sig"))


@query("SELECT sha256(text) AS sha256, count(*)::BIGINT AS size, min(doc_id) AS first FROM documents GROUP BY text HAVING count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", sha256(F.col("text")).alias("sha256"))
    return dedup.exact_groups(docs, "doc_id", "sha256")


@query("SELECT sha256(d.text) AS sha256, d.doc_id, g.first FROM documents d JOIN (SELECT text, min(doc_id) AS first FROM documents GROUP BY text HAVING count(*) > 1) g USING (text)")
def exact_dup_members(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", sha256(F.col("text")).alias("sha256"))
    return dedup.members(docs, "doc_id", "sha256")


@query("SELECT count(*)::BIGINT AS n_groups, coalesce(sum(n), 0)::BIGINT AS n_items FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)")
def exact_dup_total(spark, sf_dir):
    return exact_dup_groups(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_groups"), F.coalesce(F.sum("size"), F.lit(0)).alias("n_items"))


@query("SELECT lang || 'x' || CAST(n_chars // 1000 AS VARCHAR) AS dims, count(*)::BIGINT AS n FROM documents GROUP BY 1 ORDER BY n DESC, dims")
def dims_histogram(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(F.concat_ws("x", "lang", F.floor(F.col("n_chars") / 1000)).alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims")


@query(
    f"""WITH d AS (SELECT d.*, l.doc_id IS NOT NULL AS annotated, l.toxic, {SPLIT} AS split FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT count(*)::BIGINT AS n_items, count(DISTINCT source)::BIGINT AS n_groups, (count(*) FILTER (WHERE annotated))::BIGINT AS n_annotated,
    (count(*) FILTER (WHERE NOT annotated))::BIGINT AS n_unlabeled, (count(*) FILTER (WHERE toxic = 1))::BIGINT AS n_toxic, sum(n_chars)::BIGINT AS total_chars,
    (count(*) FILTER (WHERE split = 'train'))::BIGINT AS n_train, (count(*) FILTER (WHERE split = 'test'))::BIGINT AS n_test, min(n_chars) AS min_chars, max(n_chars) AS max_chars FROM d"""
)
def inventory_summary(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", F.lit(True).alias("annotated"))
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.expr(SPLIT).alias("split")).join(labels, "doc_id", "left")
    annotated = F.coalesce("annotated", F.lit(False))
    return d.agg(
        F.count(F.lit(1)).alias("n_items"), F.count_distinct("source").alias("n_groups"), F.count_if(annotated).alias("n_annotated"), F.count_if(~annotated).alias("n_unlabeled"),
        F.count_if(F.col("toxic") == 1).alias("n_toxic"), F.sum("n_chars").alias("total_chars"), F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"), F.min("n_chars").alias("min_chars"), F.max("n_chars").alias("max_chars"),
    )


@query(
    """SELECT d.doc_id, coalesce(l.n, 0)::BIGINT AS n_labels, CASE WHEN l.n > 0 THEN 'OWNER_ACCEPTED' ELSE 'UNLABELED' END AS status,
    CASE WHEN l.n > 0 THEN 'train' WHEN n_chars > 100 THEN 'unlabeled_pool' ELSE 'excluded_unreadable' END AS split
    FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY doc_id) l USING (doc_id)"""
)
def annotated_left_join(spark, sf_dir):
    counts = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(counts, "doc_id", "left")
    accepted = F.coalesce(F.col("n") > 0, F.lit(False))
    split = splits.default_split(F.when(accepted, "train"), F.col("n_chars") > 100)
    return d.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_labels"), F.when(accepted, "OWNER_ACCEPTED").otherwise("UNLABELED").alias("status"), split.alias("split"))


@query("SELECT DISTINCT c.conv_id AS doc_id FROM conversations c WHERE c.conv_id NOT IN (SELECT doc_id FROM labels)")
def missing_locally(spark, sf_dir):
    return validation.missing_in(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id")), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def present_semi(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


@query(f"SELECT doc_id, source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE ({SPLIT}) <> 'train')")
def holdout_anti(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.join(docs.where(F.expr(SPLIT) != "train").select("source").distinct(), "source", "left_anti").select("doc_id", "source")


@query(f"SELECT {SPLIT} AS split, count(*)::BIGINT AS n_items, count(DISTINCT source)::BIGINT AS n_groups, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY 1")
def split_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(F.expr(SPLIT).alias("split")).agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("source").alias("n_groups"), F.sum("n_chars").alias("n_chars"))


@query(f"WITH s AS (SELECT DISTINCT lang AS g, {SPLIT} AS split FROM documents) SELECT a.split AS left, b.split AS right, a.g AS group FROM s a JOIN s b ON a.g = b.g AND a.split < b.split".replace("AS group", 'AS "group"').replace("AS left", 'AS "left"').replace("AS right", 'AS "right"'))
def split_leakage(spark, sf_dir):
    return splits.leaking_groups(table(spark, sf_dir, "documents").select("lang", F.expr(SPLIT).alias("split")), "lang", "split")


@query("SELECT page_id, sha256(html) AS expected, sha256(CASE WHEN page_id % 7 = 0 THEN html || ' ' ELSE html END) AS actual FROM pages WHERE page_id % 7 = 0")
def hash_mismatch(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    changed = F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html"))
    return validation.hash_mismatches(pages.select("page_id", sha256(F.col("html")).alias("h")), pages.select("page_id", sha256(changed).alias("h")), "page_id", "h")


@query(
    """WITH a AS (SELECT DISTINCT doc_id AS name FROM labels), b AS (SELECT DISTINCT conv_id AS name FROM conversations)
    SELECT coalesce(a.name, b.name) AS name, a.name IS NOT NULL AS in_left, b.name IS NOT NULL AS in_right FROM a FULL JOIN b ON a.name = b.name WHERE a.name IS NULL OR b.name IS NULL"""
)
def name_set_equality(spark, sf_dir):
    return validation.unequal_names(table(spark, sf_dir, "labels"), table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id")), "doc_id")


@query(
    """SELECT 'common' AS part, item_id AS id FROM (SELECT item_id FROM benchmark INTERSECT SELECT doc_id FROM documents)
    UNION ALL SELECT 'labels_only', doc_id FROM (SELECT doc_id FROM labels EXCEPT SELECT item_id FROM benchmark)"""
)
def disjoint_subset_checks(spark, sf_dir):
    ids = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"))
    common = ids.intersect(table(spark, sf_dir, "documents").select("doc_id"))
    only = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")).subtract(ids)
    return common.select(F.lit("common").alias("part"), "id").unionByName(only.select(F.lit("labels_only").alias("part"), "id"))


@query(
    """WITH u AS (SELECT doc_id AS name, 'base' AS origin FROM documents UNION ALL SELECT item_id, 'new' FROM benchmark)
    SELECT name, origin, count(*) OVER (PARTITION BY name) AS n FROM u"""
)
def union_manifest(spark, sf_dir):
    base = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.lit("base").alias("origin"))
    both = base.unionByName(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("name"), F.lit("new").alias("origin")))
    repeated = validation.repeated_names(both, "name")
    return both.join(repeated, "name", "left").select("name", "origin", F.coalesce("n", F.lit(1)).alias("n"))


ISLANDS = """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
i AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e),
g AS (SELECT user_id, min(ts) AS island_start, max(ts) AS island_end, count(*)::BIGINT AS n FROM i GROUP BY user_id, k)"""


@query(f"{ISLANDS} SELECT * FROM g")
def gap_islands(spark, sf_dir):
    return grouping.gap_islands(table(spark, sf_dir, "events"), ["user_id"], "ts", "1 hour")


@query(f"{ISLANDS} SELECT n AS size, count(*)::BIGINT AS n_islands FROM g GROUP BY n")
def session_chain_sizes(spark, sf_dir):
    return gap_islands(spark, sf_dir).groupBy(F.col("n").alias("size")).agg(F.count(F.lit(1)).alias("n_islands"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR p <> event_type")
def consecutive_dedup(spark, sf_dir):
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = table(spark, sf_dir, "events").withColumn("p", before)
    return rows.where("p IS NULL OR p <> event_type").select("event_id", "user_id", "event_type")


PAIRS = """SELECT a.vec_id AS "left", b.vec_id AS "right", bit_count(xor(a.sig, b.sig))::INT AS distance FROM s a JOIN s b ON a.vec_id < b.vec_id AND bit_count(xor(a.sig, b.sig)) <= {}"""


@query(f"{SIGNATURES} {PAIRS.format(20)}")
def near_dup_pairs(spark, sf_dir):
    return dedup.near_pairs(signatures(spark, sf_dir), "vec_id", F.col("sig"), 20)


@query(f"{SIGNATURES} {PAIRS.format(16)}")
def near_dup_pairs_banded(spark, sf_dir):
    return dedup.near_pairs(signatures(spark, sf_dir), "vec_id", F.col("sig"), 16, banded=True)


@query(f"{SIGNATURES} {PAIRS.format(20)} AND a.label = b.label AND sha256(a.sig::VARCHAR) <> sha256(b.sig::VARCHAR)")
def near_dup_pairs_same_label(spark, sf_dir):
    rows = signatures(spark, sf_dir).withColumn("sha", sha256(F.col("sig").cast("string")))
    return dedup.near_pairs(rows, "vec_id", F.col("sig"), 20, keys=["label"], different="sha")


@query(f"{SIGNATURES} SELECT a.vec_id AS id, min(bit_count(xor(a.sig, b.sig)))::INT AS min_distance FROM s a JOIN s b ON a.label <> 0 AND b.label = 0 GROUP BY a.vec_id HAVING min(bit_count(xor(a.sig, b.sig))) > 6")
def min_hamming_to_accepted(spark, sf_dir):
    s = signatures(spark, sf_dir)
    return dedup.min_distance(s.where("label <> 0"), s.where("label = 0"), "vec_id", "sig").where("min_distance > 6")


@query(
    f"""{SIGNATURES.replace("WITH v", "WITH RECURSIVE v")},
    e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM s a JOIN s b ON a.vec_id <> b.vec_id AND bit_count(xor(a.sig, b.sig)) <= 18),
    r(node, reached) AS (SELECT vec_id, vec_id FROM s UNION SELECT r.node, e.y FROM r JOIN e ON r.reached = e.x),
    c AS (SELECT node, min(reached) AS component FROM r GROUP BY node)
    SELECT node AS vec_id, component, printf('scene-%04d', dense_rank() OVER (ORDER BY component)) AS "group" FROM c"""
)
def scene_components(spark, sf_dir):
    s = signatures(spark, sf_dir)
    return grouping.scene_groups(s, "vec_id", dedup.near_links(s, "vec_id", F.col("sig"), 18))


@query(
    """WITH e AS (SELECT event_id AS b, lag(event_id) OVER w AS a, ts - lag(ts) OVER w AS d FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT a, b FROM e WHERE d <= INTERVAL 600 SECOND"""
)
def time_chain_edges(spark, sf_dir):
    return grouping.chain_edges(table(spark, sf_dir, "events"), "event_id", "ts", 600, ["user_id"])


@query()
def split_assignment(spark, sf_dir):
    """Depends on a seeded Mersenne Twister, which SQL hasn't."""
    return splits.split_groups(table(spark, sf_dir, "documents"), "source", RATIOS, SEED)


@query('SELECT source AS "group", 1::BIGINT AS n_splits, count(*)::BIGINT AS n FROM documents GROUP BY source')
def whole_groups(spark, sf_dir):
    """What the split must keep: every group whole, in one split."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("group"))
    sides = splits.split_groups(docs, "group", RATIOS, SEED)
    side = docs.join(sides.select("group", "split").distinct(), "group")
    return side.groupBy("group").agg(F.count_distinct("split").alias("n_splits"), F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH b AS (SELECT doc_id AS name, source AS g, {SPLIT} AS split FROM documents WHERE doc_id % 2 = 0), n AS (SELECT doc_id AS name, source AS g FROM documents WHERE doc_id % 2 = 1)
    SELECT name, g AS "group", split FROM b UNION ALL SELECT name, g, 'train' FROM n"""
)
def incremental_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.col("source").alias("group"), F.expr(SPLIT).alias("split"))
    return splits.extend_manifest(docs.where("name % 2 = 0"), docs.where("name % 2 = 1"))


@query(
    f"""WITH b AS (SELECT doc_id AS name, source AS g, {SPLIT} AS split FROM documents WHERE doc_id % 2 = 0), n AS (SELECT doc_id AS name, source AS g FROM documents WHERE doc_id % 3 = 0),
    u AS (SELECT name, g, split FROM b UNION ALL SELECT name, g, 'train' FROM n), e AS (SELECT DISTINCT name FROM u), s AS (SELECT DISTINCT g, split FROM u)
    SELECT 'already_in_base' AS gate, CAST(name AS VARCHAR) AS name FROM (SELECT name FROM n INTERSECT SELECT name FROM b)
    UNION ALL SELECT 'not_annotated', CAST(name AS VARCHAR) FROM e WHERE name NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'group_in_holdout', g FROM (SELECT DISTINCT g FROM n INTERSECT SELECT g FROM b WHERE split <> 'train')
    UNION ALL SELECT 'group_in_two_splits', x.g FROM s x JOIN s y ON x.g = y.g AND x.split < y.split
    UNION ALL SELECT 'content_changed', CAST(name AS VARCHAR) FROM e WHERE name % 50 = 0"""
)
def manifest_gates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.col("source").alias("group"), F.expr(SPLIT).alias("split"), "text")
    inventory = docs.select("name", sha256(F.col("text")).alias("sha256"))
    actual = docs.select("name", sha256(F.when(F.col("name") % 50 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("sha256"))
    annotated = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("name"))
    return splits.manifest_violations(docs.where("name % 2 = 0"), docs.where("name % 3 = 0").select("name", "group"), inventory, annotated, actual)


@query(
    """WITH n AS (SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') || '(0).JPG' AS name FROM events)
    SELECT event_id, name, strftime(strptime(name[1:15], '%Y%m%d_%H%M%S'), '%Y-%m-%dT%H:%M:%S') AS iso, false AS impossible, name[1:-5] AS stem, '.jpg' AS suffix FROM n"""
)
def timestamp_parse(spark, sf_dir):
    names = table(spark, sf_dir, "events").select("event_id", F.concat(F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("(0).JPG")).alias("name"))
    n = F.col("name")
    return names.select("event_id", "name", iso_text(parse_capture_time(n)).alias("iso"), impossible_capture_time(n).alias("impossible"), stem(n).alias("stem"), suffix(n).alias("suffix"))


@query(f"{SIGNATURES} SELECT vec_id, printf('%016x', sig) AS phash_hex, sig FROM s")
def hash_hex(spark, sf_dir):
    rows = signatures(spark, sf_dir).select("vec_id", long_to_hex(F.col("sig")).alias("phash_hex"))
    return rows.withColumn("sig", hex_to_long(F.col("phash_hex")))


@query(f"SELECT doc_id, CASE WHEN ({SPLIT}) = 'validation' THEN 'val' ELSE ({SPLIT}) END AS split FROM documents")
def split_translation(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", split_name(F.expr(SPLIT)).alias("split"))


@query("SELECT doc_id, n_chars, n FROM (SELECT doc_id, n_chars, 0::BIGINT AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))")
def one_to_one_check(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return docs.join(validation.not_one_to_one(docs, table(spark, sf_dir, "labels"), "doc_id"), "doc_id")


@query("""SELECT a."left", b."right" FROM (SELECT sum(n_chars)::BIGINT AS "left" FROM documents) a JOIN (SELECT sum(n_chars)::BIGINT AS "right" FROM documents WHERE n_chars > 50) b ON a."left" <> b."right" """)
def conservation_check(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("n_chars")
    return validation.unequal_sums(docs, docs.where("n_chars > 50"), F.col("n_chars"))


@query("SELECT lang AS label, true AS found, false AS allowed FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY lang UNION ALL SELECT 'xx', false, true")
def label_set_check(spark, sf_dir):
    return validation.unexpected_labels(table(spark, sf_dir, "documents"), "lang", {"en", "fr", "xx"})


def csv_round_trip(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Write as CSV to the shared folder and read back as text."""
    from sievework.sources.files import read_csv
    from sievework.sources.sinks import write_csv

    scratch = Scratch(df.sparkSession, name)
    write_csv(df, path := f"{scratch.base}/csv", columns)
    return read_csv(df.sparkSession, path, columns)


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations")
def csv_scan(spark, sf_dir):
    return csv_round_trip(table(spark, sf_dir, "conversations"), ["conv_id", "turn", "role", "text"], "csv")
