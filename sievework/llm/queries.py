"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import chat_format, decontaminate, line_dedup, near_dedup, packing, pii, quality, suffix_dedup, topk, toxicity
from sievework.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "n_shared", (F.col("n_shared") > 0).alias("repeats"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    usable = ~toxicity.held_out(F.col("doc_id"))
    out = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), usable=usable)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(pii.SECRET),
        count(pii.TERM),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("sanitised").cast("binary"), 256).alias("sanitised_sha256"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    usable = ~toxicity.held_out(F.col("doc_id"))
    out = quality.score_quality(docs, table(spark, sf_dir, "labels"), usable)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2n and 2n + 1 are the chosen and the rejected one of pair n."""
    side = F.when(F.col("conv_id").bitwiseAND(1) == 0, "chosen").otherwise("rejected")
    out = chat_format.format_preferences(table(spark, sf_dir, "conversations"), F.shiftright("conv_id", 1), side)
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return out.select("pair_id", "complete", "n_common", "prompt", "chosen", spans("chosen_mask"), "rejected", spans("rejected_mask"))


OP3_SQL = r"""
WITH t AS (SELECT conv_id >> 1 AS pair_id, CASE WHEN conv_id & 1 = 0 THEN 'chosen' ELSE 'rejected' END AS side, turn,
                  coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
d AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side, turn ORDER BY role, text) AS n FROM t),
u AS (SELECT pair_id, side, role, text, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn) - 1 AS i FROM d WHERE n = 1),
p AS (SELECT pair_id, count(DISTINCT side) = 2 AS complete FROM u GROUP BY pair_id),
m AS (SELECT pair_id, i, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same FROM u GROUP BY pair_id, i),
k AS (SELECT pair_id, coalesce(min(i) FILTER (WHERE NOT same), max(i) + 1) AS n_common FROM m GROUP BY pair_id),
r AS (SELECT u.*, k.n_common, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS s FROM u JOIN k USING (pair_id)),
o AS (SELECT *, coalesce(sum(length(s)) OVER (PARTITION BY pair_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lead_in
      FROM r WHERE i >= n_common),
c AS (SELECT pair_id, side, string_agg(s, '' ORDER BY i) AS body,
             string_agg((lead_in + length(role) + 5)::BIGINT || ':' || (lead_in + length(s))::BIGINT, ',' ORDER BY i) FILTER (WHERE role = 'assistant') AS mask
      FROM o GROUP BY pair_id, side),
h AS (SELECT pair_id, string_agg(s, '' ORDER BY i) AS prompt FROM r WHERE i < n_common AND side = 'chosen' GROUP BY pair_id),
has AS (SELECT DISTINCT pair_id, side FROM u)
SELECT p.pair_id, p.complete, k.n_common::BIGINT AS n_common, coalesce(h.prompt, '') AS prompt,
       CASE WHEN hc.side IS NOT NULL THEN coalesce(cc.body, '') END AS chosen, CASE WHEN hc.side IS NOT NULL THEN coalesce(cc.mask, '') END AS chosen_mask,
       CASE WHEN hr.side IS NOT NULL THEN coalesce(cr.body, '') END AS rejected, CASE WHEN hr.side IS NOT NULL THEN coalesce(cr.mask, '') END AS rejected_mask
FROM p JOIN k USING (pair_id) LEFT JOIN h USING (pair_id)
LEFT JOIN has hc ON hc.pair_id = p.pair_id AND hc.side = 'chosen' LEFT JOIN has hr ON hr.pair_id = p.pair_id AND hr.side = 'rejected'
LEFT JOIN c cc ON cc.pair_id = p.pair_id AND cc.side = 'chosen' LEFT JOIN c cr ON cr.pair_id = p.pair_id AND cr.side = 'rejected'
"""

OP10_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP5_SQL = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM t),
k AS (SELECT doc_id, pos, line,
        translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.last AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_chat_format": op3_chat_format,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_bm25_packing": op6_bm25_packing,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_pii": op9_pii,
    "op10_topk": op10_topk,
}
ORACLES: dict[str, str] = {"op3_chat_format": OP3_SQL, "op5_line_dedup": OP5_SQL, "op10_topk": OP10_SQL}
