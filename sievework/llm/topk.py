"""Exact top-k by inner product with a three-phase uniform threshold (after TPUT).

A vector's components lie in SLICES lists, one for each slice of the dimensions; a score is the
sum of the partial scores of the lists.

1. Each lane of candidates gives each query the k best entries of each list, by partial score
   alone. The k best of each list over all lanes, at most SLICES * k rows a query, have their
   scores resolved; the k-th best of those, t, can't exceed the k-th best score there is.
2. The cutoff t / SLICES goes to every lane. A candidate below it in all lists scores below t,
   so only entries that reach it in some list are collected.
3. The scores of those, and of no others, are resolved exactly, and the k best of each lane are
   merged.

Every row crosses Spark alone, with its vector packed. A task holds one lane, whose bytes are
bounded, and its queries stream past it in blocks, as matrix products of tiles; so no table, file
or batch has cells that grow, and what a query keeps of a lane has a fixed size. Scores are sums
of integers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import quoted

SCALE, SLICES = 1024, 4
#: Of a matrix product.
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: Packed vectors of a lane; fewer rows than LANE_ROWS aren't dealt out further.
LANE_BYTES, LANE_ROWS = 64 << 20, 1024
#: Sums up to here are exact in floating point.
EXACT = float(1 << 53)
#: Below here they are in single precision too; what norms lose in it is left out.
EXACT_SINGLE = 0.9 * (1 << 24)
LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors as bytes of floor(SCALE * x), in single precision where that holds all of them."""
    for batch in batches:
        for dim, rows in batch.groupby("dim"):
            m = np.floor(np.array(rows["vector"].tolist(), np.float64) * SCALE)
            with np.errstate(over="ignore"):
                single = m.astype(np.float32)
            held = (single == m).all(axis=1)
            yield rows.assign(dim=int(dim), vector=[(s if h else v).tobytes() for s, v, h in zip(single, m, held, strict=True)])


def _stack(cells: list[bytes], dim: int) -> np.ndarray:
    raw = b"".join(cells)
    if len(raw) == 4 * dim * len(cells):
        return np.frombuffer(raw, np.float32).reshape(-1, dim)
    return np.stack([np.frombuffer(c, np.float32 if len(c) == 4 * dim else np.float64).astype(np.float64) for c in cells])


def _matrix(raw, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if memoryview(raw).nbytes == 4 * n * dim else np.float64).reshape(n, dim)


def _exact(q: np.ndarray, c: np.ndarray) -> bool:
    return float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < EXACT


def _single(q: np.ndarray, c: np.ndarray) -> bool:
    """No sum of products of components can exceed the product of the norms."""
    if q.dtype != np.float32 or c.dtype != np.float32:
        return False
    with np.errstate(over="ignore"):
        q2, c2 = (float(np.einsum("ij,ij->i", m, m).max(initial=0)) for m in (q, c))
    return (q2 * c2) ** 0.5 < EXACT_SINGLE


def _integers(m: np.ndarray) -> np.ndarray:
    out = np.empty(m.shape, object)
    out.ravel()[:] = [int(x) for x in m.ravel()]
    return out


def _partials(q: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """Partial scores of every query and candidate, by slice."""
    if not _single(q, c):
        q, c = q.astype(np.float64, copy=False), c.astype(np.float64, copy=False)
        if not _exact(q, c):
            q, c = _integers(q), _integers(c)
    cuts = np.linspace(0, q.shape[1], min(SLICES, q.shape[1]) + 1).astype(int)
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_CLAMP = lambda x: int(min(max(int(x), -LONG), LONG))


def _meetings(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Each block of queries with its lane, from rows sorted by dimension, candidates before queries. Candidates come by id."""
    group, chunks, lane = None, [], None
    for batch in batches:
        dims, sides = batch["dim"].to_numpy(), batch["side"].to_numpy()
        edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(sides) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, len(batch)], strict=True):
            if a == b:
                continue
            dim, rows = int(dims[a]), batch.iloc[a:b]
            if dim != group:
                group, chunks, lane = dim, [], None
            if sides[a] == 0:
                chunks.append((rows["id"].to_numpy(np.int64), rows["key"].to_numpy(np.int64), _stack(rows["vector"].tolist(), dim)))
                continue
            if lane is None and chunks:
                lane = _lane(chunks, dim)
            for at in range(0, len(rows) if lane else 0, size):
                part = rows.iloc[at : at + size]
                asked = {"q_ids": part["id"].to_numpy(np.int64), "q_key": part["key"].to_numpy(np.int64), "q_vectors": _stack(part["vector"].tolist(), dim), "q_cutoff": part["cutoff"].to_numpy(np.float64)}
                yield pd.DataFrame([{"dim": dim} | {c: memoryview(np.ascontiguousarray(v)) for c, v in (asked | lane).items()}])


def _lane(chunks: list[tuple], dim: int) -> dict[str, np.ndarray]:
    """The candidates of a lane by id; chunks are emptied as they are copied."""
    ids, keys = (np.concatenate([c[n] for c in chunks]) for n in (0, 1))
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    vectors, at = np.empty((len(ids), dim), np.result_type(*{c[2].dtype for c in chunks})), len(ids)
    while chunks:
        m = chunks.pop()[2]
        at -= len(m)
        vectors[place[at : at + len(m)]] = m
    return {"ids": ids[order], "key": keys[order], "vectors": vectors}


def _operands(row):
    """Of a query block that meets a lane: query keys, ids and vectors, candidate rows, ids and vectors."""
    qid, cid = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.ids, np.int64)
    return np.frombuffer(row.q_key, np.int64), qid, _matrix(row.q_vectors, len(qid), row.dim), np.frombuffer(row.key, np.int64), cid, _matrix(row.vectors, len(cid), row.dim)


def _tiles(q: np.ndarray, qid: np.ndarray, c: np.ndarray, cid: np.ndarray, size: int):
    """(place, lists, own): partial scores tile by tile, and where in a tile a query meets its own id."""
    size = size if _exact(q, c) else max(1, size // 16)  # integers take more memory
    lo, hi = np.searchsorted(cid, qid, "left"), np.searchsorted(cid, qid, "right")
    for at in range(0, len(c), size):
        parts = _partials(q, c[at : at + size])
        a, b = (np.clip(x - at, 0, parts[0].shape[1]) for x in (lo, hi))
        own = [(i, slice(a[i], b[i])) for i in np.flatnonzero(b > a)]
        yield at, parts, own


def _firsts(group: np.ndarray, k: int) -> np.ndarray:
    """Which of some rows sorted by group are among its first k."""
    new = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if len(group) else 0))
    return np.arange(len(group)) - np.repeat(new, np.diff(new, append=len(group))) < k


_ENTRY = np.dtype([("partial", np.float64), ("row", np.int64)])


def _lists(k: int, tile: int):
    """Phase 1: a lane's k best entries of each list for each query, as SLICES * k entries of _ENTRY; row -1 is none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                keys, qid, q, rows, cid, c = _operands(row)
                heads = np.empty((SLICES, len(qid), k), _ENTRY)
                heads["partial"], heads["row"] = -np.inf, -1
                for at, parts, own in _tiles(q, qid, c, cid, tile):
                    for head, part in zip(heads, parts, strict=False):
                        part = part.astype(np.float64) if part.dtype == object else part
                        for i, places in own:
                            part[i, places] = -np.inf
                        if at == 0 and part.shape[1] > k:
                            places = np.argpartition(part, part.shape[1] - k, axis=1)[:, -k:]
                            head["partial"] = np.take_along_axis(part, places, 1)
                            head["row"] = np.where(np.isneginf(head["partial"]), -1, rows[places])
                            continue
                        i, j = np.nonzero(part > head["partial"].min(axis=1).astype(part.dtype)[:, None])
                        some = np.unique(i)
                        group = np.concatenate([np.repeat(some, k), i])
                        both = np.empty(len(group), _ENTRY)
                        both["partial"], both["row"] = np.concatenate([head["partial"][some].ravel(), part[i, j]]), np.concatenate([head["row"][some].ravel(), rows[at + j]])
                        order = np.lexsort((-both["partial"], group))
                        head[some] = both[order][_firsts(group[order], k)].reshape(len(some), k)
                yield pd.DataFrame({"key": keys, "heads": [h.tobytes() for h in heads.transpose(1, 0, 2)]})

    return run


def _merged(k: int):
    """The rows in the k best entries of each list over all lanes, once each; heads come sorted by key."""

    def best(keys: np.ndarray, heads: np.ndarray) -> pd.DataFrame:
        out = []
        for n in range(SLICES):
            entries, group = heads[:, n].ravel(), np.repeat(keys, k)
            entries, group = entries[there := entries["row"] >= 0], group[there]
            order = np.lexsort((-entries["partial"], group))
            order = order[_firsts(group[order], k)]
            out.append(pd.DataFrame({"key": group[order], "row": entries["row"][order]}))
        return pd.concat(out).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, heads = np.empty(0, np.int64), np.empty((0, SLICES, k), _ENTRY)
        for batch in batches:
            if not len(batch):
                continue
            keys = np.concatenate([keys, batch["key"].to_numpy(np.int64)])
            heads = np.concatenate([heads, np.frombuffer(b"".join(batch["heads"]), _ENTRY).reshape(-1, SLICES, k)])
            done = int(np.searchsorted(keys, keys[-1]))  # more rows of the last key may follow
            yield best(keys[:done], heads[:done])
            keys, heads = keys[done:], heads[done:]
        yield best(keys, heads)

    return run


def _resolved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The scores of entries whose vectors have been joined to them."""
    for batch in batches:
        for dim, rows in batch.groupby("dim"):
            q, c = (_stack(rows[v].tolist(), int(dim)).astype(np.float64) for v in ("q", "c"))
            if _exact(q, c):
                scores = np.einsum("ij,ij->i", q, c)
            else:
                scores = [float(a @ b) for a, b in zip(_integers(q), _integers(c), strict=True)]
            yield pd.DataFrame({"key": rows["key"], "score": scores})


def _collected(k: int, tile: int = CANDIDATE_BLOCK):
    """Phases 2 and 3: of the entries that reach the cutoff in some list, those whose resolved scores do, the k best of a lane."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                keys, qid, q, _, cid, c = _operands(row)
                cutoff = np.frombuffer(row.q_cutoff, np.float64)
                # a lower cutoff is still safe, so one rounded down stands for t / SLICES, and for t
                least = np.nextafter(cutoff, -np.inf)
                who, scores, ids = (np.empty(0, np.int64) for _ in range(3))
                full, last = np.zeros(len(qid), bool), np.zeros(len(qid), np.int64)
                for at, parts, own in _tiles(q, qid, c, cid, tile):
                    uniform = np.nextafter(cutoff / len(parts), -np.inf)[:, None]
                    if parts[0].dtype == np.float32:
                        uniform = np.nextafter(uniform.astype(np.float32), np.float32(-np.inf))
                    reached = (parts[0] >= uniform).astype(bool)
                    for p in parts[1:]:
                        reached |= (p >= uniform).astype(bool)
                    for i, places in own:
                        reached[i, places] = False
                    places = np.flatnonzero(reached)
                    total = resolve([p.ravel() for p in parts], places)
                    i, j = np.divmod(places, parts[0].shape[1])
                    enough = (total >= least[i]).astype(bool)
                    i, j, total = i[enough], j[enough], total[enough]
                    total = np.array([_CLAMP(x) for x in total], np.int64) if total.dtype == object else total.astype(np.int64)
                    # candidates come by id, so a later one of the last score kept is no better
                    better = ~full[i] | (total > last[i])
                    who, scores, ids = np.concatenate([who, i[better]]), np.concatenate([scores, total[better]]), np.concatenate([ids, cid[at + j[better]]])
                    order = np.lexsort((ids, -scores, who))
                    order = order[_firsts(who[order], k)]
                    who, scores, ids = who[order], scores[order], ids[order]
                    filled, first, n = np.unique(who, return_index=True, return_counts=True)
                    full[filled[n == k]], last[filled[n == k]] = True, scores[first[n == k] + k - 1]
                yield pd.DataFrame({"key": keys[who], "query_id": qid[who], "vec_id": ids, "score": scores})

    return run


def resolve(lists: list[np.ndarray], places: np.ndarray) -> np.ndarray:
    """The scores at some places: the sums of all lists' partial scores there."""
    return sum((p[places] for p in lists[1:]), lists[0][places])


_FOUND = "key long, query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products.

    Components count as floor(1024 * x), x as double. Candidates are all rows but those with the
    query's own id; with fewer than k, all are returned. Ties go to the smaller id. Rows with a
    null id, and vectors that are null, empty or hold null or non-finite components, take no
    part; vectors of another length than the query's are no candidates. Vectors of any length count
    whole. Rows that repeat an id are rows of their own. Scores beyond the range of long stop at its
    ends. Other columns are left out. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    key_col, vector = F.col(quoted(id_col)), F.col(quoted(vector_col))
    rows = vectors.where(key_col.isNotNull() & usable(vector))
    rows = rows.select(key_col.cast("long").alias("id"), F.size(vector).alias("dim"), F.transform(vector, lambda x: x.cast("double")).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    kinds = "id long, dim int, vector binary, is_query boolean, key long"
    rows = scratch.save(rows.withColumn("key", F.monotonically_increasing_id()).mapInPandas(_packed, kinds), "vectors")
    queries = rows.where("is_query")
    # every query goes to all lanes, a candidate to one
    n, held = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("vector")), F.lit(0))).first()
    lanes = max(1, -(-held // LANE_BYTES), min(-(-n // min(LANE_ROWS, CANDIDATE_BLOCK)), 4 * spark.sparkContext.defaultParallelism))

    def met(asked: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
        row = ["dim", "key", "id", "vector"]
        candidates = rows.select(F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int").alias("lane"), F.lit(0).alias("side"), *row, F.lit(None).cast("double").alias("cutoff"))
        asked = asked.select(every.alias("lane"), F.lit(1).alias("side"), *row, "cutoff")
        return candidates.union(asked).repartitionById(lanes, "lane").sortWithinPartitions("dim", "side")

    block, tile = QUERY_BLOCK, CANDIDATE_BLOCK
    heads = met(queries.withColumn("cutoff", F.lit(None).cast("double"))).mapInPandas(lambda batches: _lists(k, tile)(_meetings(batches, block)), "key long, heads binary")
    entries = heads.repartition("key").sortWithinPartitions("key").mapInPandas(_merged(k), "key long, row long")
    entries = entries.join(rows.select(F.col("key").alias("row"), F.col("vector").alias("c")), "row").join(queries.select("key", "dim", F.col("vector").alias("q")), "key")
    scores = entries.select("key", "dim", "q", "c").mapInPandas(_resolved, "key long, score double")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score")))
    bound = scores.withColumn("place", place).where(F.col("place") == k).select("key", F.col("score").alias("cutoff"))
    bound = scratch.save(bound, "cutoffs")
    known = queries.join(bound, "key", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(float("-inf"))))
    found = met(known).mapInPandas(lambda batches: _collected(k, tile)(_meetings(batches, block)), _FOUND)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
