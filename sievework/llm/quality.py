"""Document quality by co-training of a text view and a metadata view.

The text view measures the words (repetition, symbols, case, word lengths); the metadata view has
what is known without reading them (language, source, size and layout). Each starts from the
labelled rows. In each round each view labels the unlabelled rows that it is surest of, and those
join the other view's training rows. Each view is then calibrated (Platt scaling) on labelled
rows kept aside, and a regression on the two calibrated log odds scores every document.

All unlabelled rows take part: in each round both views score all of them, the surest TAKE at
either end are found from counts by log odds, and the views are refitted from sums of gradients
and Hessians. What a row was labelled follows from the views of the rounds so far, so that
nothing is kept for it. Bound: at most SAMPLE labelled rows of each class are used to fit, taken
by a hash of the id; their measures go to the driver. All rows are scored, on whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import fresh, kept, span_hashes, word_spans
from sievework.llm.logistic import Logistic, fit
from sievework.llm.toxicity import held_out, labelled_sample

SAMPLE = 6000
ROUNDS, TAKE = 5, 0.02
#: Log odds are counted in bins of 1 / PER_UNIT from -EDGE to EDGE; a label needs a probability beyond 0.9. Pseudo-labels have a weight of their own.
EDGE, PER_UNIT, SURE, PSEUDO = 30, 100, float(np.log(9)), 0.5
BINS = 2 * EDGE * PER_UNIT
LANG_SLOTS, SOURCE_SLOTS = 8, 16

_is = lambda chars: np.isin(np.arange(256), list(chars)).astype(np.uint8)
_CLASSES = np.stack([_is(rb"|%&$#*~^=<>\_{}[]@"), _is(range(48, 58)), _is(range(65, 91)), _is(rb".,;:!?"), _is(b"\n"), _is(range(128, 256)), _is(b" ")])


def text_measures(text: str | None) -> np.ndarray:
    """Shares of character classes, word lengths and kinds of repetition; zeros for a blank text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    a = np.frombuffer(raw, np.uint8)
    if not len(a):
        return np.zeros(TEXT_SIZE)
    share = _CLASSES @ np.bincount(a, minlength=256) / len(a)
    lo, hi = word_spans(a)
    n = len(lo)
    if not n:
        return np.concatenate([[1.0], share, np.zeros(TEXT_SIZE - 1 - len(share))])
    h = span_hashes(np.frombuffer(raw.lower(), np.uint8), lo, hi)
    _, counts = np.unique(h, return_counts=True)
    length = hi - lo
    with np.errstate(over="ignore"):
        pairs = len(np.unique(h[:-1] * np.uint64(3) + h[1:])) if n > 1 else 1
    shapes = [len(counts) / n, len(counts) / n**0.75, counts.max() / n, float((h[1:] == h[:-1]).mean()) if n > 1 else 0.0, pairs / max(1, n - 1)]
    lengths = [length.mean(), length.std(), float((length > 20).mean()), float((length == 1).mean())]
    p = counts / n
    return np.concatenate([[1.0], share, shapes, lengths, [-(p * np.log(p)).sum() / max(1.0, np.log(n)), np.log1p(n)]])


TEXT_SIZE = 1 + len(_CLASSES) + 5 + 4 + 2
META_SIZE = 3 + LANG_SLOTS + SOURCE_SLOTS


def meta_measures(lang: str | None, source: str | None, n_chars: float | None, n_lines: float | None) -> np.ndarray:
    """Size and layout, and the language's and source's slots (none for null)."""
    out = np.zeros(META_SIZE)
    chars, lines = (0.0 if x is None or x != x else max(0.0, float(x)) for x in (n_chars, n_lines))
    out[:3] = np.log1p(chars), np.log1p(lines), np.log1p(chars / (lines + 1))
    if isinstance(lang, str):
        out[3 + zlib.crc32(lang.encode()) % LANG_SLOTS] = 1
    if isinstance(source, str):
        out[3 + LANG_SLOTS + zlib.crc32(source.encode()) % SOURCE_SLOTS] = 1
    return out


def _measure_column(text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    """Both views' measures, one after the other."""

    def measure(texts: pd.Series, langs: pd.Series, sources: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([np.concatenate([text_measures(t), meta_measures(g, s, n, t.count("\n") if t else 0)]) for t, g, s, n in zip(texts, langs, sources, sizes, strict=True)])

    measure.__annotations__ = dict.fromkeys(("texts", "langs", "sources", "sizes", "return"), pd.Series)
    return F.pandas_udf(measure, "array<double>")(text, lang, source, n_chars)


def _as_bytes(measures: Column) -> Column:
    def pack(x: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(row, float).tobytes() for row in x], dtype=object)

    pack.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return F.pandas_udf(pack, "binary")(measures).alias("x")


@dataclass
class CoTrained:
    """Two views, their calibrations and what combines them."""

    views: tuple[Logistic, Logistic]
    calibrations: tuple[Logistic, Logistic]
    combined: Logistic

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Columns: the text view's, the metadata view's and the combined probability."""
        parts = _split(x)
        odds = np.column_stack([c.logit(v.logit(p)[:, None]) for v, c, p in zip(self.views, self.calibrations, parts, strict=True)])
        return np.column_stack([1 / (1 + np.exp(-np.clip(odds, -30, 30))), self.combined(np.clip(odds, -30, 30))])


def _split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.asarray(x, float).reshape(-1, TEXT_SIZE + META_SIZE)
    return x[:, :TEXT_SIZE], x[:, TEXT_SIZE:]


class Pool:
    """All unlabelled rows: measures as bytes, in a table."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def total(self, measure: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
        """The sum of an array over all rows, None without rows; tasks send one array each."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for batch in batches:
                if batch.num_rows:
                    part = measure(np.frombuffer(b"".join(batch.column(0).to_pylist()), float).reshape(-1, TEXT_SIZE + META_SIZE))
                    out = part if out is None else out + part
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([out.astype(float).tobytes()], pa.binary())], names=["part"])

        parts = [np.frombuffer(r["part"], float) for r in self.rows.mapInArrow(run, "part binary").collect()]
        return sum(parts[1:], parts[0]) if parts else None


#: One round's choice by a view: the view, and the last bin of label 0 and the first one of label 1.
Choice = tuple[Logistic, int, int]


def _bins(view: Logistic, x: np.ndarray) -> np.ndarray:
    return np.minimum(((np.clip(view.logit(x), -EDGE, EDGE) + EDGE) * PER_UNIT).astype(int), BINS - 1)


def _choice(view: Logistic, counts: np.ndarray) -> Choice:
    """The surest rows: at least TAKE of all at either end, equal ones together, if they are sure enough."""
    n = int(TAKE * counts.sum())
    if not n:
        return view, -1, BINS
    low = int(np.searchsorted(np.cumsum(counts), n))
    high = BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), n))
    return view, min(low, int((EDGE - SURE) * PER_UNIT) - 1), max(high, int((EDGE + SURE) * PER_UNIT) + 1)


def _pseudo(choices: list[Choice], x: np.ndarray) -> np.ndarray:
    """The labels that a view's choices gave to rows, the first one each; -1 for none."""
    out = np.full(len(x), -1.0)
    for view, low, high in choices:
        at = _bins(view, x)
        out = np.where(out >= 0, out, np.where(at <= low, 0.0, np.where(at >= high, 1.0, -1.0)))
    return out


def _newton(z: np.ndarray, y: np.ndarray, w: np.ndarray | float, b: np.ndarray) -> np.ndarray:
    """A loss's Hessian and gradient at b, in one array."""
    p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
    h = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z
    return np.concatenate([h.ravel(), z.T @ (w * (p - y))])


def _refit(views: list[Logistic], rows: list[np.ndarray], y: np.ndarray, w: np.ndarray, pool: Pool, choices: list[list[Choice]], scaling: list[tuple]) -> list[Logistic]:
    """Both views on labelled rows and on the rows that the other view labelled, by Newton steps from where they were."""
    widen = lambda v, x: np.column_stack([(x - scaling[v][0]) / scaling[v][1], np.ones(len(x))])
    b = []
    for v, (mean, scale) in zip(views, scaling, strict=True):
        b.append(np.append(v.weights * scale / v.scale, v.bias + (v.weights / v.scale) @ (mean - v.mean)))
    own = [widen(v, rows[v]) for v in range(2)]
    for _ in range(30):

        def measure(x: np.ndarray) -> np.ndarray:
            parts, out = _split(x), []
            for v in range(2):
                label = _pseudo(choices[1 - v], parts[1 - v])
                out.append(_newton(widen(v, parts[v][label >= 0]), label[label >= 0], PSEUDO, b[v]))
            return np.concatenate(out)

        sums, most, at = pool.total(measure), 0.0, 0
        for v in range(2):
            k = len(b[v])
            both = _newton(own[v], y, w, b[v]) + sums[at : at + k * k + k]
            at += k * k + k
            penalty = np.diag([1.0] * (k - 1) + [1e-6])
            step = np.linalg.solve(both[: k * k].reshape(k, k) + penalty, both[k * k :] + penalty @ b[v])
            b[v] = b[v] - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
            most = max(most, np.abs(step).max())
        if most < 1e-5:
            break
    return [Logistic(*scaling[v], b[v][:-1], float(b[v][-1])) for v in range(2)]


def co_train(x: np.ndarray, y: np.ndarray, w: np.ndarray, aside: np.ndarray, pool: Pool) -> CoTrained:
    """Rows x with labels y and weights w, of which `aside` calibrate; pool has the unlabelled rows."""
    own, known = _split(x[~aside]), y[~aside].astype(float)
    views = [fit(own[v], known, w[~aside]) for v in range(2)]
    moments = pool.total(lambda m: np.concatenate([[len(m)], m.sum(0), (m * m).sum(0)])) if len(np.unique(known)) > 1 else None
    if moments is not None:
        k = x.shape[1]
        n = moments[0] + len(known)
        mean = (moments[1 : k + 1] + x[~aside].sum(0)) / n
        scale = np.sqrt(np.maximum((moments[k + 1 :] + (x[~aside] ** 2).sum(0)) / n - mean**2, 0))
        scale = np.where(scale > 1e-6, scale, 1.0)
        scaling = [(m[0], c[0]) for m, c in zip(_split(mean), _split(scale), strict=True)]
        choices: list[list[Choice]] = [[], []]
        for _ in range(ROUNDS):
            counts = pool.total(lambda m, views=views: np.concatenate([np.bincount(_bins(v, part), minlength=BINS) for v, part in zip(views, _split(m), strict=True)]))
            for v in range(2):
                choices[v].append(_choice(views[v], counts[v * BINS : (v + 1) * BINS]))
            views = _refit(views, own, known, w[~aside], pool, choices, scaling)
    held, known = (aside, y[aside]) if len(np.unique(y[aside])) > 1 else (~aside, y[~aside])
    parts = _split(x[held])
    odds = [views[v].logit(parts[v])[:, None] for v in range(2)]
    calibrations = [fit(o, known.astype(float), w[held]) for o in odds]
    both = np.clip(np.column_stack([c.logit(o) for c, o in zip(calibrations, odds, strict=True)]), -30, 30)
    return CoTrained(tuple(views), tuple(calibrations), fit(both, known.astype(float), w[held]))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> CoTrained:
    scratch = Scratch(docs.sparkSession, "quality")
    usable = F.lit(True) if usable is None else usable
    measures = _measure_column(F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars"))
    wide = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    known = labelled_sample(wide, labels, "doc_id", "text", "quality", usable, SAMPLE).select("id", "label", "fold", "weight")
    known = scratch.save(known, "known")
    every = scratch.save(wide.where("doc_id IS NOT NULL").select("doc_id", _as_bytes(measures)), "measures")
    seen = labels.select("doc_id").where("doc_id IS NOT NULL").distinct()
    pool = scratch.save(every.join(seen, "doc_id", "left_anti").select("x"), "pool")
    rows = every.join(F.broadcast(known.withColumnRenamed("id", "doc_id").distinct()), "doc_id").select("label", "fold", "weight", "x").toPandas()
    scratch.drop("known")
    scratch.drop("measures")
    x = np.frombuffer(b"".join(rows["x"]), float).reshape(-1, TEXT_SIZE + META_SIZE)
    model = co_train(x, rows["label"].to_numpy(int), rows["weight"].to_numpy(float), (rows["fold"] == 0).to_numpy(), Pool(pool))
    scratch.drop("pool")
    return model


def score_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> DataFrame:
    """The documents with `text_score`, `meta_score` and `score` (0 to 1, higher is better).

    docs has doc_id, text, lang, source and n_chars. Null and empty texts have zero measures,
    null metadata has no slot; texts of any length are measured whole. Labels other than 0 and 1 and
    rows with null ids are not learned from. Without labels of both classes the scores are the
    labels' share, kept off 0 and 1. Equal rows get equal scores, and are equal votes where they are
    unlabelled; an empty table gives an empty table. Other columns stay as they are, but those of
    the added names, which are replaced.
    """
    model = train(docs, labels, usable)
    names = ["text_score", "meta_score", "score"]

    def score(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model(np.array(x.tolist(), float)) if len(x) else np.zeros((0, 3)), columns=names)

    score.__annotations__ = {"x": pd.Series, "return": pd.DataFrame}
    measures = _measure_column(F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars").cast("double"))
    scores = fresh(docs, "scores")
    out = docs.select(*kept(docs, *names), F.pandas_udf(score, ", ".join(f"{n} double" for n in names))(measures).alias(scores))
    return out.select(*kept(docs, *names), *(F.col(scores)[n].alias(n) for n in names))


__all__ = ["co_train", "held_out", "meta_measures", "score_quality", "text_measures", "train"]
