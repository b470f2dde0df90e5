"""Lexical retrieval packing: windows of tokens filled with BM25 neighbours of a seed document.

Token ids are written once, with the document frequencies that each task counts; these, the number
of documents and their mean length are summed over all of them. Documents are then put in the order
of their KEY_TERMS heaviest terms in the whole corpus, in range partitions, so that lexical
neighbours and copies come to lie together wherever they stood in the input; ties go by the row, so
that a hot term is spread. Along that order a partition is packed in shards of bounded size. A shard
has an inverted index over its documents' token ids with the corpus's BM25 weights; a query is all
terms of a seed. Documents become seeds in this order; a seed's full windows come first, and its
last, partly filled window takes unused documents of the shard in the order of their BM25 score for
the seed, cut where the window ends. What is left of a cut document is used later. A window that a
shard leaves open goes on with the next shard's documents; at a partition's end the open window is
cut into powers of two, so that nothing is padded.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import quoted

WINDOW = 1024
#: A shard ends at this many tokens or documents: what a task holds at once.
SHARD_TOKENS, SHARD_DOCS = 400_000, 1000
#: BM25's usual constants, and terms whose weights are multiplied at once.
K1, B, TERM_BLOCK = 1.2, 0.75, 4096
#: As many of a document's heaviest terms decide where it is put; one row in SAMPLED tells the bounds of the ranges.
KEY_TERMS, SAMPLED = 4, 64
END = 0

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of texts, as the tokenizers library gives them, added tokens in a text included.

    The ranks of tiktoken give the same ids, faster. The library itself takes files whose added
    tokens ask for more than their plain string, and texts that tiktoken's pattern engine refuses
    (very long runs of white space).
    """

    def __init__(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, added = spec["model"]["vocab"], {t["content"]: t for t in spec.get("added_tokens") or []}
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in vocab.items() if token not in added and all(c in byte_of for c in token)}
        self.path, self.slow, self.fast = path, None, None
        #: The largest id there is.
        self.last = max([*vocab.values(), *(t["id"] for t in added.values())])
        if not any(t[k] for t in added.values() for k in ("lstrip", "rstrip", "single_word", "normalized")):
            self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={c: t["id"] for c, t in added.items()})

    def __call__(self, text: str) -> np.ndarray:
        try:
            if self.fast is not None:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32, copy=False)
        except BaseException as e:  # a panic of the Rust library isn't an Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


#: Fixed value: the pattern of byte-level BPE that cuts a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Corpus:
    """The number of documents, their mean length and each term's document frequency."""

    n: int
    mean: float
    df: np.ndarray

    def idf(self, terms: np.ndarray) -> np.ndarray:
        df = self.df[terms]
        return np.log1p((self.n - df + 0.5) / (df + 0.5)).astype(np.float32)

    def key(self, ids: np.ndarray) -> list[int]:
        """A document's heaviest terms that another document has too, -1 where there are fewer."""
        term, tf = np.unique(ids, return_counts=True)
        shared = self.df[term] > 1
        term, tf = term[shared], tf[shared]
        weight = self.idf(term) * tf / (tf + K1 * (1 - B + B * len(ids) / self.mean))
        best = term[np.lexsort((term, -weight))[:KEY_TERMS]].tolist()
        return best + [-1] * (KEY_TERMS - len(best))


def _corpus(docs: list[np.ndarray]) -> Corpus:
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]))
    return Corpus(len(docs), float(np.mean([len(d) for d in docs])), df)


class Index:
    """BM25 weights of a shard's documents by term; without a corpus, the shard is one."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        corpus = corpus or _corpus(docs)
        lengths = np.array([len(d) for d in docs])
        flat = np.concatenate(docs).astype(np.int64)
        doc_of = np.repeat(np.arange(len(docs)), lengths)
        by_term = np.sort((flat << 32) | doc_of)
        first = np.flatnonzero(np.concatenate([[True], by_term[1:] != by_term[:-1]]))
        tf = np.diff(np.concatenate([first, [len(by_term)]])).astype(np.float32)
        pair = by_term[first]
        term, doc = pair >> 32, (pair & 0xFFFFFFFF).astype(np.int32)
        begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        df = np.diff(np.concatenate([begin, [len(term)]]))
        idf = corpus.idf(term[begin])
        norm = (K1 * (1 - B + B * lengths / corpus.mean)).astype(np.float32)
        weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[doc])
        self.doc, self.weight, self.begin, self.end, self.n = doc, weight, begin, begin + df, len(docs)
        self.scores: np.ndarray | None = None

    def _score(self) -> np.ndarray:
        """The BM25 score of each document for all terms of each one, a block of posting lists at a time."""
        out = np.zeros((self.n, self.n), np.float32)
        shared = np.flatnonzero(self.end - self.begin > 1)
        for at in range(0, len(shared), TERM_BLOCK):
            terms = shared[at : at + TERM_BLOCK]
            size = self.end[terms] - self.begin[terms]
            row = np.repeat(np.arange(len(terms)), size)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.begin[terms], size)
            has, weight = np.zeros((2, self.n, len(terms)), np.float32)
            has[self.doc[place], row] = 1
            weight[self.doc[place], row] = self.weight[place]
            out += has @ weight.T
        return out

    def neighbours(self, seed: int, left: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first, ties in order."""
        if self.scores is None:
            self.scores = self._score()
        found = np.flatnonzero((self.scores[seed] > 0) & (left > 0))
        return found[np.argsort(-self.scores[seed, found], kind="stable")]


class Packer:
    """Packs one partition; shards are handed in one by one."""

    def __init__(self, partition: int, window: int, corpus: Corpus | None = None):
        self.window, self.next_id, self.room, self.corpus = window, partition << 33, 0, corpus
        self.rows: list[tuple] = []
        self.open: list[tuple] = []

    def _put(self, doc, ids: np.ndarray, start: int, length: int) -> None:
        """A piece into the open window, which has room for it."""
        if not self.room:
            self.room, self.open = self.window, []
        self.open.append((doc, start, length, ids))
        self.room -= length
        if not self.room:
            self._close(self.open)

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, length, ids in pieces:
            self.rows.append((doc, start, length, ids[start : start + length].tobytes(), len(ids), self.next_id, at))
            at += length
        self.next_id += 1

    def shard(self, ids: list, docs: list[np.ndarray]) -> Iterator[list[tuple]]:
        index = Index(docs, self.corpus)
        size = np.array([len(d) for d in docs])
        left = size.copy()

        def take(i: int, most: int) -> None:
            length = int(min(left[i], most))
            self._put(ids[i], docs[i], int(size[i] - left[i]), length)
            left[i] -= length

        for seed in range(len(docs)):
            while left[seed]:
                take(seed, self.room or self.window)
                if self.room and not left[seed]:
                    for i in index.neighbours(seed, left):
                        take(i, self.room)
                        if not self.room:
                            break
            if len(self.rows) >= 2000:
                yield self._take_rows()
        yield self._take_rows()

    def _take_rows(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def finish(self) -> list[tuple]:
        """The open window, cut into powers of two."""
        pieces = self.open if self.room else []
        rest = sum(p[2] for p in pieces)
        while rest:
            target, part = 1 << (rest.bit_length() - 1), []
            rest -= target
            while target:
                doc, start, length, ids = pieces[0]
                cut = min(length, target)
                part.append((doc, start, cut, ids))
                pieces[0] = (doc, start + cut, length - cut, ids)
                if cut == length:
                    pieces = pieces[1:]
                target -= cut
            self._close(part)
        return self._take_rows()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


_TOKENS = "row long, doc_id long, ids binary, df binary"
_KEYS = [f"k{i}" for i in range(KEY_TERMS)]


def _encoded(path: str):
    """Rows (doc_id, text) as (row, doc_id, ids): a number of its own for each row, and the ids with END.

    A task's last row has its document frequencies by term, after its documents and its tokens.
    """
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("df", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row, kind, df, total = None, TaskContext.get().partitionId() << 33, None, None, 0
        for batch in batches:
            if encode is None:
                encode = Encoder(path)
                kind, df = _id_type(encode.last), np.zeros(encode.last + 1, np.int64)
            ids = [np.append(encode(t), np.uint32(END)) if t else np.array([END], np.uint32) for t in batch.column(1).to_pylist()]
            for x in ids:
                df[np.unique(x)] += 1
                total += len(x)
            yield pa.RecordBatch.from_arrays([pa.array(range(row, row + len(ids)), pa.int64()), batch.column(0), pa.array([x.astype(kind).tobytes() for x in ids], pa.binary()), pa.nulls(len(ids), pa.binary())], schema=schema)
            row += len(ids)
        if df is not None:
            n = row - (TaskContext.get().partitionId() << 33)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([np.concatenate([[n, total], df]).tobytes()], pa.binary())], schema=schema)

    return run


def _id_type(last: int) -> str:
    return "<u2" if last < 1 << 16 else "<u4"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of counts, as rows; terms -2 and -1 have documents and tokens."""
    total = None
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            part = np.frombuffer(raw, np.int64)
            total = part.copy() if total is None else total + part
    if total is not None:
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term - 2, pa.int64()), pa.array(total[term], pa.int64())], names=["term", "n"])


def corpus_of(counts: DataFrame) -> Corpus | None:
    """What BM25 needs to know of all documents, from rows (df); its size is the vocabulary's."""
    counts = counts.mapInArrow(_counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    known = {r["term"]: r["n"] for r in counts.toLocalIterator()}
    if not (n := known.pop(-2, 0)):
        return None
    mean = known.pop(-1) / n
    df = np.zeros(max(known) + 1, np.int64)
    df[list(known)] = list(known.values())
    return Corpus(n, mean, df)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row for each piece of a document, with its token ids (little-endian unsigned 32-bit).

    A document's ids are those of its whole text and a final END; a null or empty text has just
    END. Texts of any length are cut freely; each id lies in exactly one piece. A sequence holds at
    most `window` ids; its pieces lie gapless from offset 0. All sequences have `window` ids but
    those at the end of a partition, which have a power of two. Null ids are kept, equal rows are
    packed each on its own; neighbours of equal score are taken in order. Other columns are left
    out. An empty table gives an empty table.
    """
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    kind = _id_type(Encoder(path).last)
    scratch = Scratch(spark, "packing")
    tokens = scratch.save(docs.select(F.col(quoted(id_col)).cast("long"), F.col(quoted(text_col))).mapInArrow(_encoded(path), _TOKENS), "tokens")
    corpus = corpus_of(tokens.where("row IS NULL").select("df"))
    tokens = tokens.where("row IS NOT NULL").select("row", "doc_id", "ids")
    shipped = spark.sparkContext.broadcast(corpus)
    fields, keys_type = "row long, doc_id long, ids binary", ", ".join(f"{k} long" for k in _KEYS)

    def keys_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.array([shipped.value.key(np.frombuffer(raw, kind)) for raw in batch.column(batch.schema.names.index("ids")).to_pylist()], np.int64).reshape(-1, KEY_TERMS)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, keys_of(batch).T)], names=["row", *_KEYS])

    # the ranges' bounds: a sample's keys, sorted by Spark, the first one of each range
    order = [*_KEYS, "row"]
    sample = tokens.where(F.pmod(F.xxhash64("row"), F.lit(SAMPLED)) == 0).select("row", "ids").mapInArrow(sampled, f"row long, {keys_type}")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = sample.repartitionByRange(ranges, *order).groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*order)).alias("x"))
    bounds = sorted(tuple(r["x"]) for r in first.collect())[1:]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = keys_of(batch)
            part = [bisect_right(bounds, (*k, row)) for k, row in zip(keys.tolist(), batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, keys.T), pa.array(part, pa.int32())], names=[*batch.schema.names, *_KEYS, "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), window, shipped.value)
        ids, held, total = [], [], 0
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                held.append(np.frombuffer(raw, kind).astype("<u4"))
                total += len(held[-1])
                if total >= SHARD_TOKENS or len(held) >= SHARD_DOCS:
                    for rows in packer.shard(ids, held):
                        if rows:
                            yield _batch(rows, schema)
                    ids, held, total = [], [], 0
        if held:
            for rows in packer.shard(ids, held):
                if rows:
                    yield _batch(rows, schema)
        if rows := packer.finish():
            yield _batch(rows, schema)

    dealt = tokens.mapInArrow(keyed, f"{fields}, {keys_type}, part int").repartitionById(len(bounds) + 1, F.col("part"))
    return dealt.sortWithinPartitions(*order).select("doc_id", "ids").mapInArrow(run, SCHEMA)
