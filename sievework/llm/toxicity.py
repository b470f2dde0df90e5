"""Toxicity scores from a learned lexicon, matched by a Levenshtein automaton on its trie.

The lexicon is learned from labelled rows: words, and stems (proper beginnings of words), that are
found in toxic documents far more often than chance. A document's words run through the product of the
lexicon's trie and a Levenshtein automaton of one error, made deterministic as states come up, so
misspelled terms are caught in one pass over a word whatever the lexicon's size. Each hit is
weighed by its context window: inside quotation marks or after a word of reporting it counts
less, next to an address in the second person more. A logistic regression on those sums gives the
score. It is fitted on labelled rows that its lexicon was not learned from; the lexicon that is used
is then learned from all of them.

Bound: at most SAMPLE labelled rows of each class are used to fit, taken by a hash of the id; the
lexicon has the terms that pass the tests on those. All rows are scored, on their whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch
from sievework.llm.common import kept, quoted
from sievework.llm.logistic import Logistic, fit

SAMPLE, NOTHING_KNOWN = 6000, 0.01
#: A term is learned if its likelihood-ratio statistic is at least this, and so much of its weight lies on toxic rows.
EVIDENCE, PRECISION = 20.0, 0.95
STEMS = (3, 4, 5, 6, 7, 8)
#: Documents whose terms are counted at once, and words whose matches are remembered, in a worker.
COUNTED, REMEMBERED = 500, 150_000
#: Words, and stems, shorter than this must be spelled right.
FUZZY_FROM, FUZZY_STEM_FROM = 5, 6
#: Characters before and after a hit that are its context.
REACH = 60
#: Quotation marks, words of reporting, address in the second person.
QUOTES = "\"“”„«»‹›‘’"
REPORTING = frozenset("said says wrote writes called calls quote quoted quotes word term phrase insult slur reported sagte schrieb nannte wort dit écrit appelé mot dijo escribió llamó palabra".split())
ADDRESS = frozenset("you your you're youre u ur du dich dein ihr tu toi ton vous te tú eres usted".split())
QUOTED_WEIGHT, REPORTED_WEIGHT = 0.35, 0.6

_WORD = re.compile(r"\w+")


class Automaton:
    """The words within one edit of a lexicon's words, and those that go on from within one edit of its stems."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        for terms, ends in ((words, self.word), (stems, self.stem)):
            for term in terms:
                node = 0
                for c in term:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        self.word.append(None)
                        self.stem.append(None)
                    node = self.children[node][c]
                ends[node] = term
        self.alphabet = {c for x in self.children for c in x}
        self.states: list[frozenset[tuple[int, int]]] = []
        self.number: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.begun: list[tuple[str, int] | None] = []
        self.ended: list[tuple[str, int] | None] = []
        self.start = self._state(frozenset({(0, 0)}))

    def _state(self, s: frozenset[tuple[int, int]]) -> int:
        if s not in self.number:
            self.number[s] = len(self.states)
            self.states.append(s)
            self.next.append({})
            fits = lambda term, e, least=FUZZY_FROM: not e or len(term) >= least
            stems = [(e, self.stem[n]) for n, e in s if self.stem[n] and fits(self.stem[n], e, FUZZY_STEM_FROM)]
            words = [(e, self.word[n]) for n, e in s if self.word[n] and fits(self.word[n], e)]
            words += [(1, self.word[k]) for n, e in s if not e for k in self.children[n].values() if self.word[k] and fits(self.word[k], 1)]
            self.begun.append(min(stems)[::-1] if stems else None)
            self.ended.append(min(words)[::-1] if words else None)
        return self.number[s]

    def _step(self, state: int, c: str) -> int:
        out = set()
        for n, e in self.states[state]:
            kids = self.children[n]
            if c in kids:
                out.add((kids[c], e))
            if not e:
                out.add((n, 1))  # one more character
                for k in kids.values():
                    out.add((k, 1))  # another character
                    if c in self.children[k]:
                        out.add((self.children[k][c], 1))  # a character left out
        best = {}
        for n, e in out:
            best[n] = min(e, best.get(n, e))
        return self._state(frozenset(best.items()))

    def match(self, word: str) -> tuple[str, str, int] | None:
        """('word' or 'stem', term, errors) of the best match: fewest errors, then whole words."""
        state, stem = self.start, None
        for c in word:
            if (b := self.begun[state]) and (stem is None or b[1] < stem[1]):
                stem = b  # as another character follows
            if c not in self.alphabet:
                c = ""
            following = self.next[state]
            if c not in following:
                following[c] = self._step(state, c)
            state = following[c]
            if not self.states[state]:
                break
        ended = self.ended[state]
        if ended and (stem is None or ended[1] <= stem[1]):
            return ("word", *ended)
        return ("stem", *stem) if stem else None


FEATURES = ["words", "stems", "misspelled_words", "misspelled_stems", "quoted", "strongest", "density"]


@dataclass
class Lexicon:
    """Learned terms with their log odds: words as they are, stems as '^stem'."""

    odds: dict[str, float]

    def matcher(self) -> Callable[[str], list[float]]:
        """Features of a text: context-weighted hits by kind, quoted hits, the strongest term, hits a word."""
        automaton = Automaton([t for t in self.odds if t[0] != "^"], [t[1:] for t in self.odds if t[0] == "^"])
        known: dict[str, tuple | None] = {}

        def features(text: str | None) -> list[float]:
            lower = (text or "").lower()
            words = _WORD.findall(lower)
            hit = False
            for w in set(words):
                if w not in known:
                    if len(known) > REMEMBERED:
                        known.clear()
                    known[w] = automaton.match(w)
                if known[w] is not None:
                    hit = True
            if not hit:
                return [0.0] * len(FEATURES)
            sums, quoted, strongest, total = [0.0] * 4, 0.0, 0.0, 0.0
            for m in _WORD.finditer(lower):
                w = m[0]
                if w not in known:
                    known[w] = automaton.match(w)
                if (found := known[w]) is None:
                    continue
                kind, term, errors = found
                weight = context_weight(lower, m.start(), m.end())
                sums[2 * (errors > 0) + (kind == "stem")] += weight
                quoted += weight < 1
                total += weight
                odds = self.odds[term if kind == "word" else f"^{term}"]
                strongest = max(strongest, odds * weight * (0.5 if errors else 1))
            return [*np.log1p(sums), float(np.log1p(quoted)), strongest, total / len(words)]

        return features


def context_weight(text: str, start: int, end: int) -> float:
    """How much a hit counts as abuse: 1, and less where the window shows a quotation."""
    before, after = text[max(0, start - REACH) : start], text[end : end + REACH]
    weight = 1.0
    if sum(before.count(q) for q in QUOTES) % 2 and any(q in after for q in QUOTES):
        weight *= QUOTED_WEIGHT
    near = _WORD.findall(before)[-6:]
    if not REPORTING.isdisjoint(near):
        weight *= REPORTED_WEIGHT
    if not ADDRESS.isdisjoint(near):
        weight = min(1.0, weight * 1.2)
    return weight


def terms_of(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    words = {w for w in words if not w.isdigit()}
    return words | {f"^{w[:k]}" for w in words for k in STEMS if len(w) > k}


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), COUNTED):
            part = batch.iloc[at : at + COUNTED]
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(part["text"], part["label"], strict=True):
                counts[int(toxic)].update(terms_of(text))
            terms = list(counts[0].keys() | counts[1].keys())
            yield pd.DataFrame({"term": terms, "n1": [counts[1][t] for t in terms], "n0": [counts[0][t] for t in terms]})


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from; false for a null id, which no label has."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column, most: int) -> DataFrame:
    """(id, text, label, fold, weight) of at most `most` rows of each class, by a hash of the id.

    weight is the class's number of labelled rows by those taken, so that weighted shares are
    those of all labelled rows. The ids that are taken are bounded by `most`, and are broadcast.
    """
    key, label = F.col(quoted(id_col)), F.col(quoted(label_col))
    clean = labels.where(key.isNotNull() & label.isin(0, 1) & usable).select(key.alias("id"), label.cast("int").alias("label"))
    clean = clean.groupBy("id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    taken = None
    for label, n in sorted(sizes.items()):
        part = clean.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(most).withColumn("weight", F.lit(max(1.0, n / most)))
        taken = part if taken is None else taken.unionByName(part)
    if taken is None:
        taken = clean.withColumn("weight", F.lit(1.0))
    texts = docs.select(key.alias("id"), F.col(quoted(text_col)).alias("text"))
    return texts.join(F.broadcast(taken), "id").withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(3)))


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms that toxic rows hold far more often than others do, from rows (text, label)."""
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Lexicon({})
    counts = sample.select("text", "label").mapInPandas(_count_terms, "term string, n1 long, n0 long")
    counts = counts.groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where("n1 >= 3")
    p1, p0 = (F.col("n1") + 0.5) / (n1 + 1), (F.col("n0") + 0.5) / (n0 + 1)
    base, total = n1 / (n1 + n0), F.col("n1") + F.col("n0")
    log = lambda n, e: F.when(n > 0, n * F.log(n / (total * e))).otherwise(0.0)
    counts = counts.withColumn("odds", F.log(p1 / p0)).withColumn("g2", 2 * (log(F.col("n1"), base) + log(F.col("n0"), 1 - base)))
    best = counts.where((F.col("g2") >= EVIDENCE) & (p1 / (p1 + p0) >= PRECISION))
    return Lexicon({r["term"]: float(r["odds"]) for r in best.select("term", "odds").collect()})


class Scorer:
    """A lexicon and the regression on its features."""

    def __init__(self, lexicon: Lexicon, model: Logistic):
        self.lexicon, self.model = lexicon, model

    def column(self, text: Column) -> Column:
        scorer, held = self, {}

        def score(texts: pd.Series) -> pd.Series:
            if "f" not in held:
                held["f"] = scorer.lexicon.matcher()
            x = np.array([held["f"](t) for t in texts], float).reshape(-1, len(FEATURES))
            return pd.Series(scorer.model(x))

        score.__annotations__ = {"texts": pd.Series, "return": pd.Series}
        return F.pandas_udf(score, "double")(text)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", usable: Column | None = None) -> Scorer:
    """Fit a scorer on labelled rows for which `usable` holds (all, if it is None).

    Without rows of both classes the score is the share of toxic labels, kept off 0 and 1; without
    any row it is NOTHING_KNOWN, so that nothing is rejected.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    usable = F.lit(True) if usable is None else usable
    sample = scratch.save(labelled_sample(docs, labels, id_col, text_col, label_col, usable, SAMPLE), "sample")
    lexicon = learn_lexicon(sample.where("fold <> 0"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = lexicon.matcher()
        for batch in batches:
            x = [f(t) for t in batch["text"]]
            yield pd.DataFrame({"x": x, "label": batch["label"], "weight": batch["weight"]})

    rows = sample.where("fold = 0").select("text", "label", "weight").mapInPandas(features, "x array<double>, label int, weight double").toPandas()
    # the regression is fitted on rows that its lexicon hasn't seen; then every row may add to the lexicon
    lexicon = learn_lexicon(sample)
    scratch.drop("sample")
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    if not len(x):
        k = len(FEATURES)
        return Scorer(lexicon, Logistic(np.zeros(k), np.ones(k), np.zeros(k), float(np.log(NOTHING_KNOWN / (1 - NOTHING_KNOWN)))))
    return Scorer(lexicon, fit(x, rows["label"].to_numpy(float), rows["weight"].to_numpy(float)))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, usable: Column | None = None) -> DataFrame:
    """The documents with `score` (0 to 1) and `predicted` (1 if score >= threshold) added.

    Null and empty texts have no hits and get the score of such texts; texts of any length are
    scored whole. Labels other than 0 and 1 and rows with null ids are not learned from; an id
    labelled both ways counts as toxic. Equal rows get equal scores; of terms that match a word
    equally well the smaller one counts. An empty table gives an empty table. Other columns stay as
    they are, but those of the added names, which are replaced.
    """
    scorer = train(docs, labels, id_col, text_col, usable=usable)
    out = docs.select(*kept(docs, "score", "predicted"), scorer.column(F.col(quoted(text_col))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
