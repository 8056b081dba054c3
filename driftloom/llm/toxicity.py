"""Toxic documents: a learned lexicon, matched with spelling errors, and weighed by its context."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .near_text import Minima, shingle_sets
from .scratch import cut, in_arrow
from .words import sliced

LABELLED_ROWS = 20_000  # of each label, at most
LEXICON = 4_000
MIN_DOCUMENTS = 3
MIN_WEIGHT = 3.0
STEMS = (4, 5, 6)
WINDOW = 8
CACHE_WORDS = 1_000_000
CACHE_LETTERS = 64  # longer tokens are looked up each time
CACHE_STEPS = 2_000_000
FEATURES = 7
_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"\s+")
_QUOTES = "\"'“”„‟«»‘’‹›"
_REPORTING = frozenset("said says say wrote writes quote quoted quoting called calls word words term terms slur slurs".split())


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _stems(words: set[str]) -> set[str]:
    return {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


class Lexicon:
    """Terms (a trailing * stands for any ending) as a trie, intersected with Levenshtein automata.

    A state is the set of trie nodes that the letters read so far can lead
    to, each with the fewest edits spent. States and steps are made when first met
    and kept, so a word costs one look-up per letter, and most words die
    after a few letters. Terms of five letters allow one edit, of ten two;
    shorter ones and stems none. A term that begins with a stem of the lexicon allows its
    edits only with ``under_stems``, which scoring sets: a stem finds other endings, not another beginning.
    """

    def __init__(self, terms: dict[str, float], under_stems: bool = False):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.limit = [0]  # most edits of any term below
        covered = set() if under_stems else {t[:-1] for t in terms if t.endswith("*")}
        for term in terms:
            word, node = term.rstrip("*"), 0
            loose = 0 if term.endswith("*") or any(word[:n] in covered for n in STEMS) else self.edits(word)
            self.limit[0] = max(self.limit[0], loose)
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.limit.append(0)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], loose)
            if term.endswith("*"):
                self.stem[node] = term
            else:
                self.term[node] = term
        self._reset()

    @staticmethod
    def edits(word: str) -> int:
        return 2 if len(word) >= 10 else 1 if len(word) >= 5 else 0

    def _reset(self) -> None:
        self.states: list[dict[int, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.steps: dict[tuple[int, str], int] = {}
        self.dead = self._number({})
        self.first = self._number(self._closed({0: 0}))

    def _number(self, state: dict[int, int]) -> int:
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
        return self.numbers[key]

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """With letters left out: a child costs one edit without reading anything."""
        todo = list(state)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                spent = state[node] + 1
                if spent <= self.limit[child] and spent < state.get(child, 9):
                    state[child] = spent
                    todo.append(child)
        return state

    def _step(self, number: int, c: str) -> int:
        after: dict[int, int] = {}

        def put(node: int, spent: int) -> None:
            if spent <= self.limit[node] and spent < after.get(node, 9) or not spent:
                after[node] = spent

        for node, spent in self.states[number].items():
            if c in self.children[node]:
                put(self.children[node][c], spent)
            put(node, spent + 1)  # a letter too many
            for child in self.children[node].values():
                put(child, spent + 1)
        return self._number(self._closed(after))

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the best term: fewest edits, then largest weight, then first by name."""
        number, found = self.first, []
        if len(self.steps) > CACHE_STEPS:
            self._reset()
            number = self.first
        for c in word:
            key = (number, c)
            if (number := self.steps.get(key, -1)) < 0:
                number = self.steps[key] = self._step(*key)
            if number == self.dead:
                break
            for node, spent in self.states[number].items():
                if not spent and self.stem[node]:
                    found.append((0, -self.terms[self.stem[node]], self.stem[node]))
        else:
            for node, spent in self.states[number].items():
                if self.term[node] and spent <= (self.edits(self.term[node]) if spent else 0):
                    found.append((spent, -self.terms[self.term[node]], self.term[node]))
        if not found:
            return None
        spent, _, term = min(found)
        return term, spent


class Scorer:
    """Features of a text: what its hits weigh, and what surrounds them."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known: dict[str, tuple[int, tuple]] = {}

    def _look_up(self, token: str) -> tuple[int, tuple]:
        """How many words a token has, and (place, weight, edits) of those with a match."""
        words, found = words_of(token), []
        for i, word in enumerate(words):
            got = self.lexicon.match(word)
            if got is not None:
                found.append((i, self.lexicon.terms[got[0]], got[1]))
        out = len(words), tuple(found)
        if len(token) <= CACHE_LETTERS:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[token] = out
        return out

    def hits(self, tokens: list[str]) -> tuple[int, list[tuple[int, float, int]]]:
        """The number of words, and (position, weight, edits) of every word with a match."""
        known, out, at = self.known, [], 0
        for token in tokens:
            n, found = known.get(token) or self._look_up(token)
            if found:
                out += [(at + i, weight, edits) for i, weight, edits in found]
            at += n
        return at, out

    @staticmethod
    def surroundings(text: str) -> tuple[list[str], list[bool], list[bool]]:
        """The words, and whether a quotation mark stands before and after each; an apostrophe within a word is none."""
        low = text.lower()
        spots = [m.span() for m in _WORD.finditer(low)]
        opens, closes = [False] * len(spots), [False] * len(spots)
        ends = [0, *(b for _, b in spots)]
        starts = [*(a for a, _ in spots), len(low)]
        for i, (a, b) in enumerate(zip(ends, starts)):  # what stands before word i and after word i - 1
            gap = low[a:b]
            if gap.isspace() or 0 < i < len(spots) and gap in ("'", "’"):
                continue
            parts = [any(c in _QUOTES for c in p) for p in _GAP.split(gap)]
            if i < len(spots):
                opens[i] = any(parts[1:]) or parts[0] and (len(parts) == 1 or not i)
            if i:
                closes[i - 1] = any(parts[:-1]) or parts[-1] and (len(parts) == 1 or i == len(spots))
        return [low[a:b] for a, b in spots], opens, closes

    @staticmethod
    def quoted(around: tuple[list[str], list[bool], list[bool]], at: int) -> bool:
        """Quotation marks open before and close after the hit, or a reporting word leads up to it, in the window."""
        words, opens, closes = around
        if any(opens[max(0, at - WINDOW) : at + 1]) and any(closes[at : at + WINDOW + 1]):
            return True
        return any(w in _REPORTING for w in words[max(0, at - 3) : at])

    def features(self, text: str) -> list[float]:
        n_words, hits = self.hits(text.split())
        if not hits:
            return [0.0] * FEATURES
        around = self.surroundings(text)
        plain = spelled = quoted = strongest = 0.0
        for at, weight, edits in hits:
            if self.quoted(around, at):
                quoted += weight
            elif edits:
                spelled += weight / (1 + edits)
            else:
                plain += weight
                strongest = max(strongest, weight)
        places = np.array([h[0] for h in hits])
        crowd = int((np.searchsorted(places, places + WINDOW, side="right") - np.arange(len(places))).max())
        exact = sum(1 for h in hits if not h[2])
        return [
            math.log1p(plain), math.log1p(spelled), math.log1p(quoted), strongest,
            math.log1p(100 * exact / n_words), math.log1p(100 * (len(hits) - exact) / n_words), math.log1p(crowd),
        ]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with two MinHash minima, by which copies and near copies of one text mostly fall together."""
    minima = Minima(2)
    for batch in batches:
        keys = []
        for _, texts in sliced(batch.column(0), lower=True):
            keys += [minima.of(s).tolist() if len(s) else [0, 0] for s in shingle_sets(texts)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32())], ["text", "toxic", "k1", "k2"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of either label hold each word and each stem."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(words_of(text or ""))
            for term in words | _stems(words):
                counts.setdefault(term, [0, 0])[toxic] += 1
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1))], ["term", "clean", "toxic"])


def _feature_rows(terms: dict[str, float]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Lexicon(terms, under_stems=True))
        for batch in batches:
            made = [scorer.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(made, pa.list_(pa.float64()))], ["toxic", "features"])

    return rows


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights and, last, intercept of a logistic regression with a small L2 penalty, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", labelled_rows: int = LABELLED_ROWS
) -> tuple[dict[str, float], np.ndarray]:
    """(terms with weights, regression weights) from labelled rows.

    The model is fitted on a sample: of each label, the ``labelled_rows`` ids that come
    first in hash order. Copies and near copies among them count once. A word or stem
    belongs to the lexicon if ``MIN_DOCUMENTS`` toxic texts hold it, its log odds are
    ``MIN_WEIGHT`` at least, and its likelihood ratio is beyond what chance gives the most
    extreme of so many terms. Without toxic or without clean rows the
    model is empty and every score is 0.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(labelled_rows) for k in (0, 1)]
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked[0].union(picked[1])), "id")
    sketched = in_arrow(sample.select("text", "toxic"), _sketched, "text string, toxic int, k1 int, k2 int")
    single = cut(sketched.groupBy("k1", "k2").agg(F.max(F.struct("toxic", "text")).alias("row")).select("row.text", "row.toxic"), "labelled")
    sizes = {r[0]: r[1] for r in single.groupBy("toxic").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return {}, np.zeros(FEATURES + 1)
    counts = in_arrow(single, _term_counts, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = cut(counts, "terms")
    chance = 2 * math.log(max(counts.count(), 2))
    both = F.col("toxic") + F.col("clean")
    term = lambda seen, total: F.when(seen > 0, seen * F.log(seen / (both * total / (n_clean + n_toxic)))).otherwise(0.0)
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    scored = counts.select("term", "toxic", weight.alias("weight"), (2 * (term(F.col("toxic"), n_toxic) + term(F.col("clean"), n_clean))).alias("g2"))
    best = scored.where((F.col("toxic") >= MIN_DOCUMENTS) & (F.col("weight") >= MIN_WEIGHT) & (F.col("g2") >= chance))
    terms = {r.term: r.weight for r in best.orderBy(F.desc("g2"), "term").limit(LEXICON).collect()}
    rows = in_arrow(single, _feature_rows(terms), "toxic int, features array<double>").toPandas()
    x = np.array(rows.features.tolist(), float).reshape(len(rows), FEATURES)
    order = np.lexsort((*x.T, rows.toxic))  # sums must not depend on the order in which tasks end
    return terms, fit_logistic(x[order], rows.toxic.to_numpy(float)[order])


def _scored(terms: dict[str, float], weights: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Lexicon(terms, under_stems=True))
        for batch in batches:
            x = np.array([scorer.features(t or "") for t in batch.column(1).to_pylist()], float).reshape(-1, FEATURES)
            p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))) if terms else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["id", "score"])

    return score


def held_out(id_: F.Column) -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", labelled_rows: int = LABELLED_ROWS
) -> DataFrame:
    """id, held_out, score (0 to 1) and predicted (1 from 0.5 on) of each row.

    Only labels of rows that are not held out (crc32 of the id as text divisible by 5) are learned from. Every whole text is then
    scored in one scan without a shuffle: words are matched with the lexicon, spelling errors
    allowed; hits in quotation or report are kept apart from the rest; density and the most
    crowded window of hits count as well.

    Null text counts as empty; a text without hits, empty ones included, has
    the score of no evidence. Rows with a null id are scored and not held out. Labels other than 0 and 1
    are ignored; of several labels of an id the largest counts. Repeated rows are each
    scored; an empty table gives an empty result; further columns are ignored.
    """
    learned = labels.where(~held_out(F.col(id_col)))
    terms, weights = learn(docs, learned, id_col, text_col, label_col, labelled_rows)
    kind = dict(docs.dtypes)[id_col]
    out = in_arrow(docs.select(id_col, text_col), _scored(terms, weights), f"id {kind}, score double")
    return out.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
