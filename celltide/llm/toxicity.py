"""Toxicity: learned terms found with misspellings, weighed by their context.

Terms are learned from labelled documents: words whose document frequency in toxic ones exceeds that in others beyond
chance.  They form a trie, and its product with the Levenshtein automaton (one edit) is a deterministic automaton, built
state by state as texts need it; it finds each word that is a term or one edit away from one.  A hit counts by its
term's weight in one of four contexts: stated or inside quotation marks, exact or misspelled; and once more if the words
around it address someone.  A logistic model over these sums gives the score.

Words are runs of letters and digits, in lower case.  Two words parted by one sign (``m*ron``) are also looked up with it, as
a word whose sign costs the one edit, where neither of them is a hit by itself.  Labels, language, source and ``doc_id``
enter no score.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.llm.common import staged_at, workers_import
from celltide.llm.vocab import _ALNUM, _CLASS, _PUNCT, StretchEncoder, hold_memory
from celltide.storage import delete_path

#: Bound on the labelled rows that the model is fitted on (those with the smallest hash of ``doc_id``).
SAMPLE = 20_000
#: Bytes of a lexicon that may be sent to every task; a larger one is an error, never cut.
LEXICON_BYTES = 64 << 20
FOLDS = 5
#: A term needs this many toxic documents, this log-likelihood ratio (G2) and this log odds ratio.
LEAST_TOXIC, LEAST_G2, LEAST_LOG_ODDS = 3, 20.0, 2.0
#: Words shorter than the first are no terms, and terms shorter than the second are found only as they are written.
LEAST_LETTERS, LEAST_MISSPELLED = 3, 5
CONTEXT = 8  # words on each side
NOT_WORD = r"[^\p{L}\p{N}]+"
WORD = re.compile(r"[^\W_]+")
OPENING, CLOSING = "\"“«„‘", "\"”»“’"
#: Words that address a reader, in the four languages of the corpus.
ADDRESS = frozenset("you your yours yourself tu toi ton vous votre du dich dir dein ihr euch usted ustedes tus ti te vos".split())


class Automaton:
    """The trie of the terms times the Levenshtein automaton of ``edits`` edits, made deterministic as it is used.

    A state is the set of (trie node, edits spent); each step takes a letter as a match, a substitution or an insertion,
    and then any number of deletions.
    """

    def __init__(self, terms: Iterable[str], edits: int = 1, least_misspelled: int = LEAST_MISSPELLED):
        self.edits, self.least = edits, least_misspelled
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for term in terms:
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][letter]
            self.term[node] = term
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        stack, spent = list(pairs), {}
        while stack:
            node, e = stack.pop()
            if spent.get(node, self.edits + 1) <= e:
                continue
            spent[node] = e
            if e < self.edits:
                stack += ((child, e + 1) for child in self.children[node].values())
        key = frozenset(spent.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            ends = [(e, self.term[n]) for n, e in key if self.term[n] is not None and (not e or len(self.term[n]) >= self.least)]
            best = min(ends, default=None)
            self.accepts.append(best and (best[1], best[0]))
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        reached = set()
        for node, e in self.states[state]:
            if letter in self.children[node]:
                reached.add((self.children[node][letter], e))
            if e < self.edits:
                reached.add((node, e + 1))
                reached.update((child, e + 1) for child in self.children[node].values())
        self.steps[state][letter] = out = self._state(reached) if reached else -1
        return out

    def find(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the closest term, ties to the first by name; None if there is none in reach."""
        if len(self.states) > 200_000:  # made anew from the trie as needed
            self.numbers, self.states, self.steps, self.accepts = {}, [], [], []
            self.start = self._state({(0, 0)})
        state = self.start
        for letter in word:
            known = self.steps[state]
            state = known[letter] if letter in known else self._step(state, letter)
            if state < 0:
                return None
        return self.accepts[state]


@dataclass(frozen=True)
class Model:
    """``terms``: (term, weight) by term; ``weights``: of the features, the constant last."""

    terms: tuple[tuple[str, float], ...]
    weights: tuple[float, ...]
    least_misspelled: int = LEAST_MISSPELLED


FEATURES = 6


class Scanner:
    """Features of texts for a set of terms."""

    def __init__(self, terms: tuple[tuple[str, float], ...], least_misspelled: int = LEAST_MISSPELLED, most: int = 300_000):
        self.weight = dict(terms)
        self.automaton = Automaton(self.weight, least_misspelled=least_misspelled)
        self.cut = StretchEncoder(list, words_only=True).cut
        self.known: dict[bytes, bool] = {}
        self.most = most

    def forget(self) -> None:
        self.known = {}

    def _has_hit(self, stretches: list[bytes]) -> np.ndarray:
        hold_memory(self)
        if len(self.known) > self.most:
            self.forget()
        known, find = self.known, self.automaton.find
        for s in stretches:
            if s not in known:
                text = s.decode("utf-8").lower()
                known[s] = any(find(w) for w in WORD.findall(text)) or any(find(w) for *_, w in _masked(text))
        return np.fromiter(map(known.__getitem__, stretches), bool, len(stretches))

    def features(self, values: pa.LargeBinaryArray) -> np.ndarray:
        """A row for each text of a null-free array."""
        out = np.zeros((len(values), FEATURES))
        out[:, -1] = 1
        if not self.weight or not len(values) or not values.buffers()[2] or not (at := self.cut(values))[0].size:
            return out
        data, places, bounds = at
        stretches = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = stretches.dictionary_encode()
        hit = places[:-1][self._has_hit(coded.dictionary.to_pylist())[coded.indices.to_numpy()]]
        begin, end = _across(data, places, bounds)
        if len(begin):
            joined = [data[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())]
            hit = np.concatenate((hit, begin[self._has_hit(joined)]))
        for d in np.unique(np.searchsorted(bounds, hit, "right") - 1):
            out[d] = self._weigh(values[int(d)].as_py().decode("utf-8"))
        return out

    def _weigh(self, text: str) -> list[float]:
        words = [(m.group().lower(), m.start()) for m in WORD.finditer(text)]
        found = [self.automaton.find(word) for word, _ in words]
        for i, _, masked in _masked(text):
            if found[i] is None and found[i + 1] is None:
                found[i] = self.automaton.find(masked.lower())
        spans = _quoted(text)
        opened = [a for a, _ in spans]
        sums = np.zeros(FEATURES - 1)
        for i, (hit, (_, at)) in enumerate(zip(found, words)):
            if hit is None:
                continue
            term, edits = hit
            weight = self.weight[term]
            span = bisect_right(opened, at) - 1
            sums[2 * (edits > 0) + (span >= 0 and at < spans[span][1])] += weight
            if any(w in ADDRESS for w, _ in words[max(0, i - CONTEXT):i + CONTEXT + 1]):
                sums[4] += weight
        return [*np.log1p(sums), 1.0]


def _masked(text: str) -> list[tuple[int, int, str]]:
    """(number of the first word, its start, both words with the sign) for words that one sign parts."""
    out, end, start = [], -1, 0
    for i, m in enumerate(WORD.finditer(text)):
        if m.start() == end + 1 and i and not text[end].isspace():
            out.append((i - 1, start, text[start:m.end()]))
        start, end = m.span()
    return out


def _across(data: np.ndarray, places: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the stretches around each ASCII sign that may part two words; stretches are cut at such signs."""
    kind = _CLASS[data]
    letter = ((kind & _ALNUM) != 0) | (data >= 0x80)
    k = np.arange(1, len(places) - 1)
    at, size = places[k], places[k + 1] - places[k]
    inner = ((kind[at] & _PUNCT) != 0) & letter[at - 1] & ~np.isin(at, bounds)
    k, at, size = k[inner], at[inner], size[inner]
    after = places[np.minimum(k + 1, len(places) - 1)]
    alone = (size == 1) & (after < len(data)) & letter[np.minimum(after, len(data) - 1)] & ~np.isin(after, bounds)
    longer = (size > 1) & (data[np.minimum(at + 1, len(data) - 1)] >= 0x80)
    end = np.where(alone, places[np.minimum(k + 2, len(places) - 1)], after)
    some = alone | longer
    return places[k - 1][some], end[some]


def _quoted(text: str) -> list[tuple[int, int]]:
    """Spans of a line between an opening quotation mark and the next closing one."""
    opening, closing = ([m.start() for m in re.finditer(f"[{marks}]", text)] for marks in (OPENING, CLOSING))
    lines = [m.start() for m in re.finditer("\n", text)]
    out, until = [], -1
    for at in opening:
        if at <= until:
            continue
        close, line = bisect_right(closing, at), bisect_right(lines, at)
        if close < len(closing) and (line == len(lines) or closing[close] < lines[line]):
            until = closing[close]
            out.append((at, until))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 100) -> np.ndarray:
    """Weights of a logistic model by damped Newton steps with a ridge penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


@lru_cache(maxsize=2)
def _scanner(terms: tuple[tuple[str, float], ...], least_misspelled: int) -> Scanner:
    return Scanner(terms, least_misspelled)


def _features(text: pa.Array, terms: tuple[tuple[str, float], ...], least_misspelled: int) -> np.ndarray:
    scanner = _scanner(terms, least_misspelled)
    values = text.cast(pa.large_binary()).fill_null(b"")
    lengths = np.concatenate(([0], np.cumsum(np.asarray(pa.compute.binary_length(values)))))
    cuts = np.unique(np.searchsorted(lengths, np.arange(0, lengths[-1] + 1, 4 << 20)))
    cuts = np.unique(np.concatenate(([0], cuts, [len(values)])))
    parts = [scanner.features(values.slice(int(a), int(b - a))) for a, b in zip(cuts[:-1], cuts[1:])]
    return np.concatenate(parts) if parts else np.zeros((0, FEATURES))


def held_out(doc_id: Column) -> Column:
    """Rows that take no part in learning; a row without a ``doc_id`` is one."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, least_letters: int = LEAST_LETTERS, least_misspelled: int = LEAST_MISSPELLED) -> Model:
    """Terms and weights from the rows of ``docs`` (``doc_id``, ``text``) that ``labels`` (``doc_id``, ``toxic``) marks.

    Rows held out, and rows without text or label, take no part; a ``doc_id`` with several labels counts as toxic.
    Of texts that share the smallest hash of their three-word windows (copies and most near copies) that of the smallest
    ``doc_id`` is used (of rows that share it, the smallest text), so a model depends on the rows alone and not on how they are
    dealt.  Every word of ``least_letters`` letters or more that passes the tests is a term; shorter ones are mostly function
    words and parts of numbers.  Terms of fewer than ``least_misspelled`` letters have other words within one edit and are
    found only as written.  Without a toxic and a clean row, there are no terms and every score is that of the constant.
    """
    workers_import(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    marked = labels.select(doc_id.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    sample = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    words = F.split(F.trim(F.regexp_replace(F.lower("text"), NOT_WORD, " ")), " ")
    windows = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    rows = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null") \
        .join(F.broadcast(sample), "doc_id").withColumn("words", words).withColumn("sketch", F.array_min(windows))  # at most SAMPLE rows
    first = F.min_by(F.struct("doc_id", "toxic", "text", F.array_distinct("words").alias("words")), F.struct("doc_id", "text")).alias("row")
    rows, rows_at = staged_at(rows.groupBy("sketch").agg(first).select("row.*"), "toxicity-sample")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        delete_path(docs.sparkSession, rows_at)
        return Model((), (*[0.0] * (FEATURES - 1), float(np.log((n_toxic + 0.5) / (n_clean + 0.5)))), least_misspelled)
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    share, expected = n_toxic / (n_toxic + n_clean), lambda k: (t + c) * k
    term = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    terms = rows.select("toxic", F.explode("words").alias("word")).filter(F.length("word") >= least_letters) \
        .groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).filter(F.col("t") >= LEAST_TOXIC) \
        .withColumn("g2", 2 * (term(t, expected(share)) + term(c, expected(1 - share)))) \
        .withColumn("weight", F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))) \
        .filter((F.col("g2") >= LEAST_G2) & (F.col("weight") >= LEAST_LOG_ODDS)).select("word", "weight").persist()
    size = terms.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0  # 64: of a word's place in the trie
    if size > LEXICON_BYTES:
        raise ValueError(f"{size} bytes of terms: raise LEXICON_BYTES, or ask for stronger terms")
    lexicon = tuple(sorted((r["word"], float(r["weight"])) for r in terms.collect()))
    terms.unpersist()
    # at most SAMPLE rows of six numbers, in one order: sums of floating-point numbers depend on it
    known = rows.select("doc_id", "toxic", _feature_column(lexicon, least_misspelled)(F.col("text")).alias("x")).toPandas()
    known = known.iloc[np.lexsort((*np.stack(known["x"].to_numpy()).T, known["toxic"], known["doc_id"]))]
    delete_path(docs.sparkSession, rows_at)
    weights = fit_logistic(np.stack(known["x"].to_numpy()).astype(float), known["toxic"].to_numpy(float))
    return Model(lexicon, tuple(map(float, weights)), least_misspelled)


def _feature_column(lexicon: tuple[tuple[str, float], ...], least_misspelled: int):
    @F.arrow_udf("array<double>")
    def features(text: pa.Array) -> pa.Array:
        x = _features(text, lexicon, least_misspelled)
        return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))

    return features


def score(model: Model, text: Column) -> Column:
    """Probability that a text is toxic; null text counts as empty."""

    @F.arrow_udf("double")
    def scored(values: pa.Array) -> pa.Array:
        z = _features(values, model.terms, model.least_misspelled) @ np.array(model.weights)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return scored(F.coalesce(text.cast("string"), F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; learns from the rows of ``labels`` that are not held out.

    Repeated rows give a row each.  An empty table gives an empty result.  Other columns are ignored.
    """
    model = learn(docs, labels)
    doc_id = F.col("doc_id").cast("long")
    scored = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns."""
    return docs.filter(score(learn(docs, labels), F.col("text")) < 0.5)
