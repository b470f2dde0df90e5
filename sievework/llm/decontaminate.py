"""Benchmark decontamination by canonical templates.

A text becomes a sequence of template tokens: words lower-cased (A-Z and À-Þ) and freed of punctuation
at their ends, with numbers, names and units replaced by typed placeholders. A benchmark item
leaks into a document when at least CONTAINMENT of the item's distinct windows of WINDOW template
tokens occur in it and its slots are filled consistently at some place: the same value of the item
stands for the same value of the document. Windows of fewer than MIN_LITERALS words besides
placeholders are compared by their exact words; an item leaks by its windows without these, or by
all of them. Items of fewer than WINDOW tokens are one window of their own length. So a copied
question is found as well as one that was given other numbers or names.

What is a name shows by its capital, which a copy in capitals, in lower case or at another place of
a sentence hasn't got or has got anew. So every text is also compared with names as plain words.

The benchmark's windows are the build side of a hash join. They are shipped in blocks of at most
BLOCK_WINDOWS windows, and documents stream through a probe without a shuffle. With several blocks
there is a pass for each, and its result is written before the next block is shipped, so that a
worker holds one block for a benchmark of any size.
"""

from __future__ import annotations

import copy
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import fresh, kept, mix64, quoted, span_hashes, word_hashes, word_spans

WINDOW, CONTAINMENT, CONSISTENCY = 5, 0.75, 0.75
#: A window with fewer words besides placeholders is compared by its exact words.
MIN_LITERALS = 2
BLOCK_WINDOWS = 2_000_000
#: Units that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l s sec secs second seconds min mins minute minutes h hr hrs hour hours "
    "day days week weeks month months year years % percent ° c f k usd eur gbp $ € £ dollars euros pounds cents mph km/h m/s "
    "meters metres miles inches feet grams kilograms liters litres"
).split()
PUNCTUATION = rb".,;:!?\"'()[]{}<>*_"

_NUMBER, _NAME, _UNIT = mix64(np.array([101, 102, 103], np.uint64))
_UNIT_HASHES = np.sort(np.concatenate([word_hashes(u.encode()) for u in UNITS]))
_is = lambda chars: np.isin(np.arange(256), list(chars))
_PUNCT, _STOP, _UPPER, _NUMERIC = _is(PUNCTUATION), _is(b".!?"), _is(range(65, 91)), _is(b"0123456789.,-+/:%$")
_UPPER_LATIN = _is({*range(0x80, 0x9F)} - {0x97})
_AMOUNT = re.compile(rb"[.,+/:%$-]*[0-9][0-9.,+/:%$-]*")
_ODD = mix64(np.arange(7, 7 + WINDOW, dtype=np.uint64)) | np.uint64(1)


class Template:
    """A text's template tokens: hashes, which of them are placeholders, and hashes of the words as they stand."""

    def __init__(self, text: str | None):
        raw = (text or "").encode("utf-8", "surrogatepass")
        a, lower = np.frombuffer(raw, np.uint8), np.frombuffer(raw.lower(), np.uint8)
        second = np.flatnonzero(a[:-1] == 0xC3) + 1
        if (second := second[_UPPER_LATIN[a[second]]]).size:
            lower = lower.copy()
            lower[second] += 0x20
        lo, hi = word_spans(a)
        if len(lo):
            starts = np.ones(len(lo), bool)  # a sentence starts with the word
            starts[1:] = _STOP[a[hi[:-1] - 1]] | (a[hi[:-1]] == 10)
            lo, hi = lo + 0, hi + 0
            for ends, step in ((hi, -1), (lo, 1)):
                at = np.flatnonzero(_PUNCT[a[ends - (step < 0)]])
                while len(at):
                    ends[at] += step
                    at = at[lo[at] < hi[at]]
                    at = at[_PUNCT[a[ends[at] - (step < 0)]]]
            if not (full := lo < hi).all():
                lo, hi, starts = lo[full], hi[full], starts[full]
        self.words = span_hashes(lower, lo, hi) if len(lo) else np.empty(0, np.uint64)
        self.tokens, self.slot = self.words, np.zeros(len(lo), bool)
        #: The same text with names as plain words.
        self.plain = self
        if not len(lo):
            return
        first = a[lo]
        number = np.zeros(len(lo), bool)
        for i in np.flatnonzero(_NUMERIC[first]):
            number[i] = _AMOUNT.fullmatch(raw, lo[i], hi[i]) is not None
        name = _UPPER[first] & ~starts
        if (latin := np.flatnonzero((first == 0xC3) & ~starts & (hi - lo > 1))).size:
            name[latin] = _UPPER_LATIN[a[lo[latin] + 1]]
        slot = number | name
        if number.any():
            after = np.flatnonzero(number[:-1] & ~number[1:]) + 1
            unit = after[np.isin(self.words[after], _UNIT_HASHES)]
        else:
            unit = np.empty(0, np.int64)
        slot[unit] = True
        if name.any():
            self.plain = copy.copy(self)
            self.plain.slot, self.plain.tokens = number.copy(), np.where(number, _NUMBER, self.words)
            self.plain.slot[unit], self.plain.tokens[unit] = True, _UNIT
        if slot.any():
            self.slot = slot
            self.tokens = np.where(number, _NUMBER, np.where(name, _NAME, self.words))
            self.tokens[unit] = _UNIT

    def windows(self, size: int | None = None) -> np.ndarray:
        """A hash for each window of `size` tokens in order; without a size, short texts have one window.

        Odd hashes are those of templates, even ones of the exact words, where a template has too few words.
        """
        n = len(self.tokens)
        size = min(WINDOW, n) if size is None else size
        if not n or size > n:
            return np.empty(0, np.uint64)
        at = np.arange(n - size + 1)
        held = np.concatenate([[0], np.cumsum(~self.slot)])
        poor = at[held[size:] - held[: n - size + 1] < min(MIN_LITERALS, size)]
        h = _chained(self.tokens, at, size) | np.uint64(1)
        if len(poor):
            h[poor] = np.maximum(_chained(self.words, poor, size) & ~np.uint64(1), np.uint64(2))
        return h


def _chained(tokens: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` tokens from each place."""
    with np.errstate(over="ignore"):
        h = tokens[at] * _ODD[0]
        for i in range(1, size):
            h = mix64(h) + tokens[at + i] * _ODD[i]
        return mix64(h ^ np.uint64(size))


class Block:
    """Benchmark items, to be matched with names as slots and with names as words."""

    def __init__(self, items: list[tuple[int, str]]):
        templates = [(item, Template(text)) for item, text in items]
        self.parts = [Part(templates), Part([(item, t.plain) for item, t in templates])]

    def match(self, text: str | None) -> list[tuple[int, float, float]]:
        """(item, containment, consistency) of the items that leak into a text, best first."""
        if not text:
            return []
        t, best = Template(text), {}
        for part, own in zip(self.parts, (t, t.plain), strict=True):
            for item, *found in part.match(own):
                best[item] = max(best.get(item, found), found)
        return sorted(((item, *found) for item, found in best.items()), key=lambda x: (-x[1], -x[2], x[0]))


class Part:
    """Items' templates, and their windows sorted by hash."""

    def __init__(self, items: list[tuple[int, Template]]):
        self.items, pairs, sizes = {}, [], set()
        for item, t in items:
            w = t.windows()
            known = np.unique(w)
            if len(known):
                # by rule: the windows of templates alone, or all of them
                self.items[item] = (t, w, (int((known & np.uint64(1)).sum()), len(known)))
                pairs += [(int(h), item) for h in known]
                sizes.add(min(WINDOW, len(t.tokens)))
        pairs.sort()
        self.sizes = sorted(sizes)
        self.hash = np.array([p[0] for p in pairs], np.uint64)
        self.item = np.array([p[1] for p in pairs], np.int64)

    def match(self, t: Template) -> Iterator[tuple[int, float, float]]:
        for size in self.sizes:
            yield from self._match(t, t.windows(size))

    def _match(self, t: Template, w: np.ndarray) -> Iterator[tuple[int, float, float]]:
        known = self.hash[np.minimum(np.searchsorted(self.hash, w), len(self.hash) - 1)] == w
        if not known.any():
            return
        hits = np.unique(w[known])
        lo, hi = np.searchsorted(self.hash, hits), np.searchsorted(self.hash, hits, "right")
        count: dict[int, list[int]] = defaultdict(lambda: [0, 0])
        for h, x, y in zip(hits.tolist(), lo, hi, strict=True):
            for item in self.item[x:y].tolist():
                count[item][0] += h & 1
                count[item][1] += 1
        for item, found in count.items():
            sizes, best = self.items[item][2], None
            for rule, (n, size) in enumerate(zip(found, sizes, strict=True)):
                if size and n >= CONTAINMENT * size and (not rule or sizes[0] < size) and (agreed := self._consistency(item, t, w, rule)) >= CONSISTENCY:
                    best = max(best or (0, 0), (n / size, agreed))
            if best:
                yield item, *best

    def _consistency(self, item: int, t: Template, w: np.ndarray, rule: int) -> float:
        """The share of the item's slot fillings that are the usual ones for their value, where the document fills them best.

        Windows that a document holds more than once are tried at their first places, and for each
        aligned run (document position minus item position) at the places nearest to it. A run
        that holds enough windows by itself is judged without those that lie elsewhere.
        """
        own, theirs, sizes = self.items[item]
        size = sizes[rule]
        order = np.argsort(w, kind="stable")
        lo, hi = np.searchsorted(w[order], theirs), np.searchsorted(w[order], theirs, "right")
        at = np.flatnonzero((hi > lo) & ((theirs & np.uint64(1) > 0) | (rule > 0)))
        lo, n = lo[at], (hi - lo)[at]
        if (best := self._agreed(own, t, at, order[lo])) == 1 or (n == 1).all() and np.ptp(order[lo] - at) < len(own.tokens):
            return best
        end = np.cumsum(n)
        begin = end - n
        place = order[np.repeat(lo - begin, n) + np.arange(end[-1])]
        # one ascending list of all windows' places, each window in a range of its own
        step = np.int64(2 * (len(w) + len(theirs)) + 1)
        base = np.arange(len(at)) * step
        listed = np.repeat(base, n) + place
        for run in np.unique(place - np.repeat(at, n)).tolist():
            aim = at + run
            right = np.clip(np.searchsorted(listed, base + np.clip(aim, 0, len(w))), begin, end - 1)
            left = np.maximum(right - 1, begin)
            near = np.where(np.abs(place[left] - aim) <= np.abs(place[right] - aim), place[left], place[right])
            best = max(best, self._agreed(own, t, at, near))
            close = np.abs(near - aim) < len(own.tokens)
            if best < 1 and not close.all() and len(np.unique(theirs[at[close]])) >= CONTAINMENT * size:
                best = max(best, self._agreed(own, t, at[close], near[close]))
            if best == 1:
                break
        return best

    @staticmethod
    def _agreed(own: Template, t: Template, at: np.ndarray, place: np.ndarray) -> float:
        """The share of usual fillings where the item's windows at `at` stand at `place` in the document."""
        step = np.arange(min(WINDOW, len(own.tokens)))
        mine, theirs = (at[:, None] + step).ravel(), (place[:, None] + step).ravel()
        slot = own.slot[mine]
        if not slot.any():
            return 1.0
        value, filling = np.unique(own.words[mine[slot]], return_inverse=True)[1], np.unique(t.words[theirs[slot]], return_inverse=True)[1]
        pair, n = np.unique(value * (filling.max() + 1) + filling, return_counts=True)
        usual = np.zeros(value.max() + 1, np.int64)
        np.maximum.at(usual, pair // (filling.max() + 1), n)
        return float(usual.sum() / n.sum())


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark in blocks that are bounded by their windows."""
    held, size = [], 0
    item, text = F.col(quoted(id_col)), F.col(quoted(text_col))
    for row in benchmark.where(item.isNotNull() & text.isNotNull()).select(item, text).toLocalIterator():
        n = len(re.findall(r"\S+", row[1]))
        if held and size + n > BLOCK_WINDOWS:
            yield Block(held)
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    if held:
        yield Block(held)


_FOUND = "containment double, consistency double, rank long, n_items long"


def _probe(shipped: Broadcast):
    """A column function from texts to their best match in one block."""

    def probe(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            hits = shipped.value.match(text)
            rows.append((hits[0][1], hits[0][2], -hits[0][0], len(hits)) if hits else (None, None, None, 0))
        return pd.DataFrame(rows, columns=["containment", "consistency", "rank", "n_items"]).astype({"containment": float, "consistency": float, "rank": "Int64"})

    probe.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(probe, _FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents with `leaked_item` (the best match, or null), its `containment` and
    `consistency`, `n_items` (items that leak) and `contaminated`.

    Null and empty texts, and items without words, match nothing. Texts of any length are matched
    whole. Equal rows get equal results; of items that match equally well the smaller one counts.
    Other columns stay as they are, but those of the added names, which are replaced. An empty
    table of documents or of benchmark items gives rows without a match.
    """
    added = ("leaked_item", "containment", "consistency", "n_items", "contaminated")
    columns, text = kept(docs, *added), F.col(quoted(text_col))
    best, n, found = (fresh(docs, x) for x in ("leak_best", "leak_items", "leak_found"))
    none = F.lit(None).cast(f"struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>")
    out = docs.select(*kept(docs), none.alias(best), F.lit(0).cast("long").alias(n))
    scratch, ahead = Scratch(docs.sparkSession, "leaks"), None
    for k, block in enumerate(_blocks(benchmark, item_id, item_text)):
        if ahead is not None:  # of several blocks one is held at a time
            out = scratch.save(out, f"block{k}")
            ahead.unpersist()
            if k > 1:
                scratch.drop(f"block{k - 1}")
        ahead = docs.sparkSession.sparkContext.broadcast(block)
        met = out.select("*", _probe(ahead)(text).alias(found))
        better = F.array_max(F.array(F.col(best), F.col(found)))
        out = met.select(*kept(docs), better.alias(best), (F.col(n) + F.col(found)["n_items"]).alias(n))
    hit = F.col(best)
    return out.select(*columns, (-hit["rank"]).alias("leaked_item"), hit["containment"].alias("containment"), hit["consistency"].alias("consistency"), F.col(n).alias("n_items"), (F.col(n) > 0).alias("contaminated"))
