"""Toxicity by a learned lexicon whose trie is intersected with Levenshtein automata, and by the context of its hits.

Terms (whole words and word beginnings) that label 1 makes likelier go into a trie. Words run through the trie's Levenshtein
automaton, made deterministic as far as words need it, so misspelled terms are found in one step a letter. A term that
stands in quotation, without unquoted terms in its context window, counts less than one addressed to a reader. A logistic
model of the hits, fitted on folds that its terms were not learned from, gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.textbytes import freed
from foliospark.session import spread, table, written

WORD = re.compile(r"[^\W\d_]+")
QUOTED = re.compile(r"“[^“”]+”|«[^«»]+»|„[^„“”]+[“”]|\"[^\"\n]+\"|^[ \t]*>.*$", re.MULTILINE)
BEGINNINGS = range(4, 9)
SAMPLE = 20_000  # labelled documents that the model is fitted on, at most (about: a keyed share of the labels is taken)
LEAST_DOCUMENTS = 3  # toxic sample documents that a term stands in: fewer can't reach the least precision
COUNTED = 100_000  # terms that a task counts, about, before it hands their counts on; results don't depend on it
WORDS_KEPT, STATES_KEPT = 100_000, 20_000  # of an automaton, before it starts anew; results don't depend on them
Z, LEAST_PRECISION = 3.0, 0.35  # a term's toxic share, at the lower Wilson bound
STRONG = 0.45  # bound from which a term's misspellings are looked for
WINDOW, QUOTE_FACTOR = 8, 0.4
FEATURES = 4


def lower_bound(hits: int, n: int, z: float = Z) -> float:
    """Lower Wilson bound of a share."""
    if not n:
        return 0.0
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def features_of(text: str) -> set[str]:
    """The terms of a text: whole words (with a final '$') and word beginnings."""
    out = set()
    for w in set(WORD.findall(text.lower())):
        out.add(w + "$")
        out.update(w[:k] for k in BEGINNINGS if len(w) >= k)
    return out


class Automaton:
    """The trie of terms intersected with Levenshtein automata. A term ending in '$' matches whole words, any other beginnings."""

    def __init__(self, terms: dict[str, tuple[float, float, int]]):
        """terms: term -> (weight when exact, weight when misspelled, edits allowed)."""
        self.next: list[dict[str, int]] = [{}]
        self.most = [0]
        self.ends: dict[int, list[tuple[str, bool, float, float, int]]] = {}
        for term, (exact, fuzzy, edits) in sorted(terms.items()):
            node, whole = 0, term.endswith("$")
            self.most[0] = max(self.most[0], edits)
            for c in term.rstrip("$"):
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.most.append(0)
                node = self.next[node][c]
                self.most[node] = max(self.most[node], edits)
            self.ends.setdefault(node, []).append((term, whole, exact, fuzzy, edits))
        self._restart()

    def _restart(self) -> None:
        """Without states and words seen so far."""
        self.states: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.begin_hits: list[tuple] = []
        self.end_hits: list[tuple] = []
        self.start = self._state({0: 0})
        self.words: dict[str, tuple] = {}

    def _state(self, edits: dict[int, int]) -> int:
        todo = list(edits)
        while todo:  # letters of the term that the word lacks
            node = todo.pop()
            e = edits[node] + 1
            for child in self.next[node].values():
                if e <= self.most[child] and e < edits.get(child, 99):
                    edits[child] = e
                    todo.append(child)
        key = frozenset(edits.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            begin, end = [], []
            for node, e in key:
                for term, whole, exact, fuzzy, most in self.ends.get(node, ()):
                    if e <= most:
                        (end if whole else begin).append((exact if e == 0 else fuzzy, e, term))
            self.begin_hits.append(max(begin, default=()))
            self.end_hits.append(max(end, default=()))
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        out: dict[int, int] = {}
        for node, e in self.sets[state]:
            child = self.next[node].get(c)
            if child is not None and e < out.get(child, 99):
                out[child] = e
            if e + 1 <= self.most[node]:
                out[node] = min(e + 1, out.get(node, 99))
                for other in self.next[node].values():
                    if e + 1 <= self.most[other] and e + 1 < out.get(other, 99):
                        out[other] = e + 1
        to = self._state(out) if out else -1
        self.steps[state][c] = to
        return to

    def find(self, word: str) -> tuple:
        """(weight, edits, term) of the best hit of a word, or ()."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) > WORDS_KEPT or len(self.sets) > STATES_KEPT:
                self._restart()
            state, found = self.start, ()
            for c in word:
                to = self.steps[state].get(c)
                state = self._step(state, c) if to is None else to
                if state < 0:
                    break
                if self.begin_hits[state] > found:
                    found = self.begin_hits[state]
            else:
                found = max(found, self.end_hits[state])
            self.words[word] = found
        return found


def text_features(text: str, automaton: Automaton) -> list[float]:
    """Strongest hit, sum of the distinct terms' weights, number of hits and their density; quoted hits alone in their window count less."""
    words = WORD.findall(text.lower())
    if not any(automaton.find(w) for w in set(words)):
        return [0.0] * FEATURES
    quotes = [m.span() for m in QUOTED.finditer(text)]
    hits = []
    for i, m in enumerate(WORD.finditer(text)):
        found = automaton.find(m.group().lower())
        if found:
            hits.append((i, found, any(a <= m.start() < b for a, b in quotes)))
    open_ = [i for i, _, quoted in hits if not quoted]
    best: dict[str, float] = {}
    for i, (weight, _, term), quoted in hits:
        if quoted and not any(abs(i - j) <= WINDOW for j in open_):
            weight *= QUOTE_FACTOR
        best[term] = max(best.get(term, 0.0), weight)
    if not best:  # only where lower-casing moves word bounds
        return [0.0] * FEATURES
    return [max(best.values()), math.log1p(sum(best.values())), math.log1p(len(hits)), math.log1p(100 * len(hits) / len(words))]


def learn_terms(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, tuple[float, int, int]]:
    """term -> (bound, toxic documents, clean documents) of the terms worth keeping.

    Of a beginning and an extension that stand in nearly the same documents, the extension stays; else a beginning that is as
    precise replaces its extensions, and one that is precise only by its better extensions goes.
    """
    if not toxic or not clean:
        return {}
    least = max(LEAST_PRECISION, 2 * toxic / (toxic + clean))
    kept = {t: (lower_bound(a, a + b), a, b) for t, (a, b) in counts.items()}
    kept = {t: x for t, x in kept.items() if x[0] >= least}

    def beginnings(t: str) -> list[str]:
        return [t[:k] for k in BEGINNINGS if k < len(t) and t[:k] in kept]

    narrow = {s for t, (bound, a, _) in kept.items() for s in beginnings(t) if 1.15 * a >= kept[s][1] and bound >= kept[s][0] - 0.02}
    kept = {t: x for t, x in kept.items() if t not in narrow}
    kept = {t: x for t, x in kept.items() if not any(kept[s][0] >= x[0] - 0.02 for s in beginnings(t))}
    under: dict[str, list[str]] = defaultdict(list)
    for t in sorted(kept):
        for s in beginnings(t):
            if not under[s] or not t.startswith(under[s][-1]):
                under[s].append(t)
    out = {}
    for t, (bound, a, b) in kept.items():
        rest_a, rest_b = (max(0, n - sum(kept[s][i] for s in under.get(t, ()))) for i, n in ((1, a), (2, b)))
        if t not in under or lower_bound(rest_a, rest_a + rest_b) >= least:
            out[t] = (bound, a, b)
    return out


def weighted_terms(terms: dict[str, tuple[float, int, int]], base: float) -> dict[str, tuple[float, float, int]]:
    """The terms with their weights and edits: one from 5 letters on, two from 9, for strong terms."""
    logit = lambda p: math.log(p / (1 - p))
    out = {}
    for t, (bound, _, _) in terms.items():
        weight = logit(min(bound, 0.999)) - logit(min(max(base, 1e-4), 0.5))
        n = len(t.rstrip("$"))
        edits = 0 if bound < STRONG or n < 5 else 1 if n < 9 else 2
        out[t] = (max(weight, 0.1), 0.7 * max(weight, 0.1), edits)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, coefficients with the intercept last) by Newton steps; a constant model where there is one class only."""
    mean, scale = x.mean(axis=0) if len(x) else np.zeros(FEATURES), np.ones(FEATURES)
    if len(x):
        scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    beta = np.zeros(FEATURES + 1)
    p0 = (y.sum() + 0.5) / (len(y) + 1)
    beta[-1] = math.log(p0 / (1 - p0))
    if len(np.unique(y)) < 2:
        return mean, scale, beta
    penalty = np.diag([ridge] * FEATURES + [1e-6])
    gain = lambda v: float((y * (z @ v) - np.logaddexp(0, z @ v)).sum() - v @ penalty @ v / 2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -35, 35)))
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty @ beta)
        while gain(beta + step) < gain(beta) and np.abs(step).max() > 1e-9:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


def _texts(batch: pa.RecordBatch) -> Iterable[str]:
    return (x.as_py() or "" for x in batch.column("text"))


class Model:
    """Terms with weights and the logistic part; small, so it goes to the tasks with their code."""

    def __init__(self, terms: dict[str, tuple[float, float, int]], logistic: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        self.terms, self.logistic = terms, logistic

    def scores(self, x: np.ndarray) -> np.ndarray:
        mean, scale, beta = self.logistic
        return 1 / (1 + np.exp(-np.clip((x - mean) / scale @ beta[:-1] + beta[-1], -35, 35)))


def _counted(sample: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """(term, fold, n): in how many sample documents of each fold a term stands; of all terms or the wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds: dict[int, Counter] = {0: Counter(), 2: Counter()}

        def counted() -> Iterator[pa.RecordBatch]:
            for fold, c in folds.items():
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array([fold] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())], ["term", "fold", "n"])
                c.clear()

        for batch in batches:
            for text, fold in zip(_texts(batch), batch.column("fold").to_pylist(), strict=True):
                found = features_of(text)
                folds[fold].update(found & wanted if wanted is not None else found)
                if sum(map(len, folds.values())) > COUNTED:
                    yield from counted()
        yield from counted()

    return sample.select("text", "fold").mapInArrow(freed(run), "term string, fold int, n long").groupBy("term", "fold").agg(F.sum("n").alias("n"))


def _by_fold(rows: list) -> dict[str, dict[int, int]]:
    out: dict[str, dict[int, int]] = defaultdict(dict)
    for r in rows:
        out[r["term"]][r["fold"]] = r["n"]
    return out


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE) -> Model:
    """The model of `toxic` labels of documents whose crc32(doc_id as text) modulo 3 isn't 1.

    About `sample_rows` labelled documents at most, a keyed share of them, are used; exact copies count once, as toxic if one of them is, in the least of their folds. Without labels of both kinds the
    model has no terms and gives everything the labels' share.
    """
    fold = (F.crc32(F.col("doc_id").cast("string")) % 3).cast("int")
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("fold", fold).filter("fold <> 1")
    n = known.count()
    share = min(1.0, sample_rows / max(1, n))
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * share))
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(known), "doc_id")  # about sample_rows at most
    sample = written(rows.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("fold").alias("fold")), "toxic-sample")
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    if not any(t for _, t in sizes) or all(t for _, t in sizes):
        return Model({}, fit_logistic(np.zeros((sum(sizes.values()), FEATURES)), np.array([t for (_, t), k in sizes.items() for _ in range(k)], float)))
    toxic = _counted(sample.filter("toxic = 1"), None)
    frequent = toxic.groupBy("term").agg(F.sum("n").alias("all")).filter(F.col("all") >= LEAST_DOCUMENTS).select("term")
    toxic_counts = _by_fold(toxic.join(frequent, "term").collect())  # terms of a bounded sample
    clean_counts = _by_fold(_counted(sample.filter("toxic = 0"), frozenset(toxic_counts)).collect())

    def terms(folds: tuple[int, ...]) -> dict[str, tuple[float, float, int]]:
        total = lambda c, t: sum(c.get(t, {}).get(f, 0) for f in folds)
        a, b = (sum(sizes.get((f, t), 0) for f in folds) for t in (1, 0))
        learnt = learn_terms({t: (total(toxic_counts, t), total(clean_counts, t)) for t in toxic_counts}, a, b)
        return weighted_terms(learnt, a / max(1, a + b))

    halves = {0: terms((2,)), 2: terms((0,))}  # a fold's features come from the other fold's terms
    whole = terms((0, 2))
    stats = fuzzy_counts(sample, whole)
    guarded = guard(whole, stats, sum(k for (_, t), k in sizes.items() if not t))
    halves = {f: {t: (w, min(z, guarded[t][1]), min(e, guarded[t][2])) if t in guarded else (w, z, 0) for t, (w, z, e) in h.items()} for f, h in halves.items()}
    found = sample_features(sample, halves)
    logistic = fit_logistic(np.array([r["x"] for r in found], float).reshape(-1, FEATURES), np.array([r["toxic"] for r in found], float))
    return Model(guarded, logistic)


def fuzzy_counts(sample: DataFrame, terms: dict[str, tuple[float, float, int]]) -> dict[str, tuple[int, int]]:
    """term -> in how many (toxic, clean) sample documents only misspellings of it stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, out = Automaton(terms), Counter()
        for batch in batches:
            for text, toxic in zip(_texts(batch), batch.column("toxic").to_pylist(), strict=True):
                found = [automaton.find(w) for w in set(WORD.findall(text.lower()))]
                exact = {x[2] for x in found if x and x[1] == 0}
                out.update((t, toxic) for t in {x[2] for x in found if x and x[1] > 0} - exact)
        keys = list(out)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([out[k] for k in keys], pa.int64())], ["term", "toxic", "n"])

    rows = sample.select("text", "toxic").mapInArrow(freed(run), "term string, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n")).collect()
    out: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for r in rows:
        out[r["term"]][1 - r["toxic"]] = r["n"]
    return {t: tuple(x) for t, x in out.items()}


def guard(terms: dict[str, tuple[float, float, int]], stats: dict[str, tuple[int, int]], clean: int) -> dict[str, tuple[float, float, int]]:
    """The terms, without edits where misspellings of them are ordinary words of clean documents."""
    out = {}
    for t, (exact, fuzzy, edits) in terms.items():
        a, b = stats.get(t, (0, 0))
        ordinary = b > max(1, 0.0005 * clean) or b > a + 2
        out[t] = (exact, fuzzy, 0 if ordinary else edits)
    return out


def sample_features(sample: DataFrame, halves: dict[int, dict]) -> list:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = {f: Automaton(t) for f, t in halves.items()}
        for batch in batches:
            x = [text_features(text, automata[f]) for text, f in zip(_texts(batch), batch.column("fold").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    return sample.select("text", "fold", "toxic").mapInArrow(freed(run), "toxic int, x array<double>").collect()  # about SAMPLE short rows


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """docs with the column `score` (0 to 1) of each whole text; a null or empty text has the score of a text without terms. All columns stay."""

    schema = docs.withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.terms)
        for batch in batches:
            x = np.array([text_features(t, automaton) for t in _texts(batch)], float).reshape(-1, FEATURES)
            columns = [c for c in batch.schema.names if c != "score"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(model.scores(x))], [*columns, "score"])

    return docs.drop("score").mapInArrow(freed(run), type(schema)([f for f in schema.fields if f.name != "score"] + [schema["score"]]))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    scored = toxicity_scores(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
