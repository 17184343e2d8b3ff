"""Toxicity by a weighted finite-state pattern grammar.

Six small transducers read the symbols of a clause. Insult and threat pick one
word of their kind, in every way there is, and pass it on as a hit; negation and
reported speech weaken a hit that stands after their words; target weighs a
clause by whether somebody is aimed at, without which a threat counts nothing;
the clause itself weighs less if it is nothing but the hit. They are composed
into one automaton. A clause's evidence is the sum over the automaton's accepted
paths, found with the forward algorithm, a text's the sum over its clauses, and
a logistic curve turns evidence into a score.

Insult words and insult stems (the beginning of a word, any ending) and their
weights are learned from a bounded sample of labelled rows, as is the curve.
Threat, target, negation and reporting words are fixed lists. Words are runs of
letters, in the fit as in the text; ``CLAUSE_MARKS`` end a clause.

Clean rows of a large share of one language do not make that language toxic:
weights are log-odds of documents that contain a word, by label.

Defined results: null or empty texts, and texts without evidence, get the
curve's value at no evidence; with no labels at all every score is 0. An id, or
a text, that is labelled both ways is toxic. Repeated rows each return a row,
an empty table returns none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import joinable, read
from lattica.llm.langid import held_out, letters

#: Labelled documents that lexicon and curve are fitted on, about, of each label.
SAMPLE_DOCS = 6000
#: A lexicon entry has these log-odds at least, and this much evidence (a likelihood ratio, as in a G test).
LEAST_DOCS = 4
LEAST_ODDS = 2.2
LEAST_RATIO = 24.0
STEM_CHARS = range(4, 8)
SLICE_CHARS = 8_000_000
THRESHOLD = 0.3

# Fixed word lists of the grammar.
THREAT = "kill hurt destroy burn shoot stab beat tuer détruire frapper töten schlagen vernichten matar golpear destruir".split()
TARGET = "you your yours yourself they them u du dich dir ihr euch vous tu toi vos tú usted ustedes te".split()
NEGATION = "not no never nobody neither nor without nicht nie kein keine jamais pas non sans ni nunca sin".split()
REPORTED = "said says reported according quoted alleged called claims sagte laut berichtet selon disait déclaré dijo según".split()

WORD_, INSULT_, THREAT_, TARGET_, NEGATION_, REPORTED_, INSULT_HIT, THREAT_HIT = range(8)
WORDS = range(6)
#: Weights of the grammar.
NEGATED, SAID, AIMED, UNAIMED, THREAT_WEIGHT, BARE = 0.4, 0.5, 1.25, 0.8, 1.5, 0.25
CLAUSE_MARKS = ".,;:!?"


@dataclass(frozen=True)
class Transducer:
    """Weighted and, it may be, ambiguous: ``arcs`` are (state, symbol read, symbol written, weight, next state), ``ends`` the weights of accepting states; it starts in state 0."""

    arcs: tuple[tuple[int, int, int, float, int], ...]
    ends: dict[int, float]

    def then(self, other: Transducer) -> Transducer:
        """Composition: ``other`` reads what this one writes."""
        reads: dict[tuple[int, int], list] = {}
        for state, read, wrote, weight, goes in other.arcs:
            reads.setdefault((state, read), []).append((wrote, weight, goes))
        own: dict[int, list] = {}
        for arc in self.arcs:
            own.setdefault(arc[0], []).append(arc[1:])
        number, todo, arcs = {(0, 0): 0}, [(0, 0)], []
        while todo:
            a, b = todo.pop()
            for read, between, w1, a2 in own.get(a, ()):
                for wrote, w2, b2 in reads.get((b, between), ()):
                    if (a2, b2) not in number:
                        number[a2, b2] = len(number)
                        todo.append((a2, b2))
                    arcs.append((number[a, b], read, wrote, w1 * w2, number[a2, b2]))
        return Transducer(tuple(arcs), {n: self.ends[a] * other.ends[b] for (a, b), n in number.items() if a in self.ends and b in other.ends})


def _pick(word: int, hit: int) -> Transducer:
    """Writes one of the words, or none, as a hit; a clause holds one hit of all kinds at most."""
    arcs = [(s, x, x, 1.0, s) for s in (0, 1) for x in WORDS] + [(0, word, hit, 1.0, 1)]
    return Transducer((*arcs, *((0, h, h, 1.0, 1) for h in (INSULT_HIT, THREAT_HIT) if h != hit)), {0: 1.0, 1: 1.0})


def _weaken(word: int, weight: float) -> Transducer:
    """Weakens a hit that stands after one of the words."""
    arcs = [(s, x, x, 1.0, 1 if x == word else s) for s in (0, 1) for x in WORDS]
    return Transducer((*arcs, *((s, h, h, weight if s else 1.0, s) for s in (0, 1) for h in (INSULT_HIT, THREAT_HIT))), {0: 1.0, 1: 1.0})


def _target() -> Transducer:
    """States: no hit 0, 1 (aimed); insult 2, 3; threat 4, 5. Without a hit, or with an unaimed threat, a clause isn't accepted."""
    arcs = [(s, x, x, 1.0, s | 1 if x == TARGET_ else s) for s in range(6) for x in WORDS]
    hits = [(s, h, h, 1.0, s + step) for s in (0, 1) for h, step in ((INSULT_HIT, 2), (THREAT_HIT, 4))]
    return Transducer((*arcs, *hits), {2: UNAIMED, 3: AIMED, 5: 1.0})


def _clause() -> Transducer:
    """Weighs a clause without any other word as bare."""
    arcs = [(s, x, x, 1.0, s if x in (INSULT_, THREAT_) else 1) for s in (0, 1) for x in WORDS]
    return Transducer((*arcs, *((s, h, h, 1.0, s) for s in (0, 1) for h in (INSULT_HIT, THREAT_HIT))), {0: BARE, 1: 1.0})


def composed() -> Transducer:
    """Insult, threat, negation, reported speech, target and clause as one transducer."""
    return _pick(INSULT_, INSULT_HIT).then(_pick(THREAT_, THREAT_HIT)).then(_weaken(NEGATION_, NEGATED)).then(_weaken(REPORTED_, SAID)).then(_target()).then(_clause())


class Automaton:
    """A transducer as matrices: by symbol, the weights of steps that pass it on and of those that make it the hit."""

    def __init__(self, t: Transducer):
        states = 1 + max(max(a[0], a[4]) for a in t.arcs)
        self.passed, self.hit = np.zeros((len(WORDS), states, states)), np.zeros((len(WORDS), states, states))
        for state, read, wrote, weight, goes in t.arcs:
            if read in WORDS:
                (self.hit if wrote in (INSULT_HIT, THREAT_HIT) else self.passed)[read, state, goes] += weight
        self.ends = np.zeros(states)
        self.ends[list(t.ends)] = list(t.ends.values())

    def evidence(self, symbols: list[int], weights: list[float]) -> float:
        """Sum over the accepted paths of one clause; a hit counts its word's weight."""
        now = np.zeros(len(self.ends))
        now[0] = 1.0
        for symbol, weight in zip(symbols, weights):
            now = now @ (self.passed[symbol] + weight * self.hit[symbol])
        return float(now @ self.ends)


class Grammar:
    """Symbols and weights of distinct words, and the evidence of texts."""

    def __init__(self, insults: dict[str, float], stems: dict[str, float]):
        self.insults, self.stems = insults, stems
        self.fixed = {w: s for s, words in ((TARGET_, TARGET), (NEGATION_, NEGATION), (REPORTED_, REPORTED), (THREAT_, THREAT)) for w in words}
        self.lengths = sorted({len(s) for s in stems}, reverse=True)
        self.automaton = Automaton(composed())

    def symbol(self, word: str) -> tuple[int, float]:
        if word in self.insults:
            return INSULT_, self.insults[word]
        if word in self.fixed:
            return self.fixed[word], THREAT_WEIGHT if self.fixed[word] == THREAT_ else 0.0
        for n in self.lengths:
            if len(word) >= n and word[:n] in self.stems:
                return INSULT_, self.stems[word[:n]]
        return WORD_, 0.0

    def evidence(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Evidence and number of words of each text of a (large) string array without nulls."""
        marked = pc.replace_substring_regex(pc.utf8_lower(text), f"[{CLAUSE_MARKS}]+", " . ")
        lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.replace_substring_regex(marked, r"[^\p{L}\p{M}.]+", " ")))
        offsets = np.asarray(lists.offsets)
        offsets = offsets - offsets[0]
        coded = pc.dictionary_encode(lists.flatten())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary.to_pylist() or [""]
        found = [self.symbol(w) for w in words]
        symbols, weights = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found])
        end = np.array([w in (".", "") for w in words])
        counts = np.concatenate([[0], np.cumsum(~end[codes])]) if len(codes) else np.zeros(1, np.int64)
        out = np.zeros(len(text))
        hits = np.flatnonzero(np.isin(symbols, (INSULT_, THREAT_))[codes]) if len(codes) else np.zeros(0, np.int64)
        for i in np.unique(np.searchsorted(offsets, hits, "right") - 1):
            out[i] = self._text(codes[offsets[i] : offsets[i + 1]], symbols, weights, end)
        return out, (counts[offsets[1:]] - counts[offsets[:-1]]).astype(np.int64)

    def _text(self, codes: np.ndarray, symbols: np.ndarray, weights: np.ndarray, end: np.ndarray) -> float:
        """Sum over the clauses that hold a hit; their ordinary words count as one, as the grammar doesn't tell how many there are."""
        clause, own = np.cumsum(end[codes]), symbols[codes]
        plain = np.bincount(clause, (own == WORD_) & ~end[codes], minlength=int(clause[-1]) + 1)
        special = np.flatnonzero(own != WORD_)
        bounds = np.searchsorted(clause[special], (hit := np.unique(clause[np.isin(own, (INSULT_, THREAT_))])))
        ends = np.searchsorted(clause[special], hit, "right")
        total = 0.0
        for c, a, b in zip(hit, bounds, ends):
            at = special[a:b]
            line, weight = own[at].tolist(), weights[codes[at]].tolist()
            total += self.automaton.evidence([WORD_, *line] if plain[c] else line, [0.0, *weight] if plain[c] else weight)
        return total


def _beginnings(n: int) -> Column:
    return F.transform(F.filter(F.col("w"), lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[Grammar, np.ndarray | None]:
    """Lexicon and curve from labelled rows; ``docs(doc_id, text)``, ``labels(doc_id, toxic)``."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return Grammar({}, {}), None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limit = F.lit(int((1 << 30) * min(1.0, sample_docs / sizes[0])))
    limit = F.when(F.col("toxic") == 1, int((1 << 30) * min(1.0, sample_docs / sizes[1]))).otherwise(limit)
    chosen = joinable(known.filter(draw < limit))  # sample_docs of each label, about
    sample = docs.filter("text is not null").join(chosen, "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic")).select("toxic", "text")
    words = F.array_distinct(F.split(F.trim(letters(F.col("text"))), " "))
    stems = F.array_distinct(F.flatten(F.array(*[_beginnings(n) for n in STEM_CHARS])))
    entries = sample.select("toxic", words.alias("w")).select("toxic", F.explode(F.concat("w", stems)).alias("entry")).filter("length(entry) > 2")
    sample = sample.persist()
    drawn = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = drawn.get(1, 0), drawn.get(0, 0)
    counted = entries.groupBy("entry").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter(F.col("t") >= LEAST_DOCS)
    odds = F.log((F.col("t") + 0.5) / (n1 + 1)) - F.log((F.col("c") + 0.5) / (n0 + 1))
    share = n1 / max(1, n1 + n0)
    seen = F.col("t") + F.col("c")
    ratio = 2 * (F.col("t") * F.log(F.col("t") / (seen * share)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (seen * (1 - share)))).otherwise(0.0))
    kept = counted.withColumn("odds", odds).withColumn("ratio", ratio).filter((F.col("odds") > LEAST_ODDS) & (F.col("ratio") > LEAST_RATIO))
    found = {r["entry"]: (r["odds"], r["ratio"], r["t"]) for r in kept.toLocalIterator()}
    insults = {e: o for e, (o, _, _) in found.items() if not e.endswith("*")}
    grammar = Grammar(insults, _stems(found))
    seen = sample.select("toxic", "text").mapInArrow(_evidences(grammar), "toxic int, evidence double, words long").toPandas().sort_values(["toxic", "evidence", "words"])
    sample.unpersist()
    return grammar, _curve(_features(seen["evidence"].to_numpy(), seen["words"].to_numpy()), seen["toxic"].to_numpy(float))


def _stems(found: dict[str, tuple[float, float, int]]) -> dict[str, float]:
    """Stems that gather clearly more documents than any word below them; of nested ones the strongest."""
    words = [e for e in found if not e.endswith("*")]
    out: dict[str, tuple[float, float]] = {}
    for entry, (odds, ratio, docs) in found.items():
        stem = entry[:-1]
        if entry.endswith("*") and docs >= 1.5 * max((found[w][2] for w in words if w.startswith(stem)), default=0):
            out[stem] = odds, ratio
    nested = lambda a, b: a != b and (a.startswith(b) or b.startswith(a))
    return {s: o for s, (o, r) in out.items() if not any(nested(s, x) and (out[x][1], x) > (r, s) for x in out)}


def _features(evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.log1p(evidence), np.log1p(words), np.ones(len(evidence))], 1)


def _logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _curve(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps with a small ridge."""
    w, ridge = np.zeros(x.shape[1]), 0.05
    for _ in range(30):
        p = _logistic(x, w)
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (label - p) - ridge * w)
    return w


def _slices(text: pa.Array) -> Iterator[pa.Array]:
    text = text.cast(pa.large_string()).fill_null("")
    sizes, start = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False)), 0
    while start < len(text):
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + SLICE_CHARS, "right")))
        yield text.slice(start, end - start)
        start = end


def _scored(grammar: Grammar, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [grammar.evidence(t) for t in _slices(text)] or [(np.zeros(0), np.zeros(0, np.int64))]
    return tuple(map(np.concatenate, zip(*parts)))


def _evidences(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence, words = _scored(grammar, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(evidence), pa.array(words)], ["toxic", "evidence", "words"])

    return run


def score(docs: DataFrame, grammar: Grammar, curve: np.ndarray | None) -> DataFrame:
    """``(doc_id, held_out, evidence, score, predicted)`` of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence, words = _scored(grammar, batch.column(2))
            p = np.zeros(len(evidence)) if curve is None else _logistic(_features(evidence, words), curve)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(evidence), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "evidence", "score", "predicted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, evidence double, score double, predicted int")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    grammar, curve = fit(docs.select("doc_id", "text"), labels.filter(~held_out(F.col("doc_id"), 4, 2)))
    return score(docs, grammar, curve).select("doc_id", "held_out", "score", "predicted", "evidence")
