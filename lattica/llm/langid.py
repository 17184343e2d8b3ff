"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's likelihood is the sum over all its segmentations into pieces, found
with the forward algorithm; a text's is the product over its words. The piece
probabilities are fitted with expected counts (forward-backward), all
segmentations again, on a bounded sample of labelled rows.

Words are maximal runs of letters, lower-cased, with the vocabulary's word
mark in front. Texts are scored whole: a batch's words are encoded as a
dictionary, each distinct word is scored once, and scores are summed by text.
Pieces may be as long as the vocabulary has them and words of any length are
one word, also in the fit: the sums of long ones are scaled as they grow.

Defined results: ``und`` with score 0 for null texts and texts without a
letter, and for every text where no labelled row was seen; languages that
score alike go by name. Repeated rows each return a row, an empty table
returns none, other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import Words, read, release_worker, room

#: Labelled documents of each language that the model is fitted on, about.
SAMPLE_DOCS = 400
EM_ROUNDS = 3
#: Words that a task remembers the scores of.
CACHE_WORDS = 150_000
#: Bytes of text whose words are laid out at once.
SLICE_BYTES = 1_000_000
#: Up to so many characters, mark included, a word's likelihood can't leave the range of a double; longer ones are scaled on the way.
PLAIN_CHARS = 28
MARK = "▁"
#: Likelihood of a character that is no piece.
UNKNOWN = 1e-9
CHAR_BITS = 21


def vocabulary(path: str) -> list[str]:
    """The letter-only pieces of a sentencepiece vocabulary, lower-cased, in order of id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if p.lstrip(MARK).isalpha()} | {MARK})


def public_vocabulary() -> list[str]:
    import public_tokenizers

    return vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


class Lattice:
    """Finds the pieces of words in a trie; words go in as arrays of code points, grouped by length."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.child: dict[int, int] = {}
        at = []
        for piece in pieces:
            node = 0
            for c in piece:
                node = self.child.setdefault(node << CHAR_BITS | ord(c), len(self.child) + 1)
            at.append(node)
        self.piece = np.full(len(self.child) + 1, self.size, np.int64)
        self.piece[at] = np.arange(self.size)
        keys = np.fromiter(self.child.keys(), np.int64, len(self.child))
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], np.fromiter(self.child.values(), np.int64, len(self.child))[order]

    def spans(self, points: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """By start and then by end: the rows that have a piece there, and which; a single character that is none has the id ``size``."""
        points = points.astype(np.int64)
        for start in range(points.shape[1]):
            rows, node = np.arange(len(points)), np.zeros(len(points), np.int64)
            for end in range(start + 1, points.shape[1] + 1):
                key = node << CHAR_BITS | points[rows, end - 1]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                known = self.keys[place] == key
                if end == start + 1:
                    yield start, end, rows, np.where(known, self.piece[self.nodes[place]], self.size)
                rows, node = rows[known], self.nodes[place[known]]
                if not len(rows):
                    break
                if end > start + 1:
                    ids = self.piece[node]
                    if (found := ids < self.size).any():
                        yield start, end, rows[found], ids[found]

    def walk(self, word: str, start: int) -> Iterator[tuple[int, int]]:
        """End and id of each piece of ``word`` at ``start``, as ``spans``."""
        node = self.child.get(ord(word[start]), 0)
        yield start + 1, int(self.piece[node]) if node else self.size
        end = start + 1
        while node and end < len(word):
            node = self.child.get(node << CHAR_BITS | ord(word[end]), 0)
            end += 1
            if node and self.piece[node] < self.size:
                yield end, int(self.piece[node])


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points of the words of each length."""
    marked = [MARK + w for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, np.frombuffer("".join(marked[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), n)


def _forward(spans, n: int, rows: int, probs: np.ndarray) -> list[np.ndarray]:
    """Sums over segmentations of each prefix; ``probs`` is (pieces + 1, languages), the last row for unknown characters."""
    alpha = [np.ones((rows, probs.shape[1]))] + [np.zeros((rows, probs.shape[1])) for _ in range(n)]
    for start, end, at, ids in spans:
        alpha[end][at] += alpha[start][at] * probs[ids]
    return alpha


def _long_score(word: str, lattice: Lattice, probs: np.ndarray) -> np.ndarray:
    """As the forward pass, for one word of any length; sums are scaled before they leave a double's range."""
    ahead, now, log = {}, np.ones(probs.shape[1]), np.zeros(probs.shape[1])
    for start in range(len(word)):
        for end, piece in lattice.walk(word, start):
            more = now * probs[piece]
            ahead[end] = ahead[end] + more if end in ahead else more
        now = ahead.pop(start + 1)
        if now.min() < 1e-100:
            log += np.log(now)
            ahead = {k: v / now for k, v in ahead.items()}
            now = np.ones(len(now))
    return log + np.log(now)


def word_scores(words: list[str], lattice: Lattice, probs: np.ndarray, chunk: int = 20_000) -> np.ndarray:
    """Log-likelihood of each word in each language."""
    out = np.zeros((len(words), probs.shape[1]))
    for at, points in _by_length(words):
        if points.shape[1] > PLAIN_CHARS:
            for i in at:
                out[i] = _long_score(MARK + words[i], lattice, probs)
            continue
        for k in range(0, len(at), chunk):
            part = points[k : k + chunk]
            out[at[k : k + chunk]] = np.log(_forward(lattice.spans(part), part.shape[1], len(part), probs)[-1])
    return out


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _long_counts(word: str, lattice: Lattice, log_p: np.ndarray) -> Iterator[tuple[int, float]]:
    """Expected uses of pieces in one word of any length, by forward and backward sums of logarithms."""
    spans = [(start, end, piece, float(log_p[piece])) for start in range(len(word)) for end, piece in lattice.walk(word, start)]
    into: list[list[float]] = [[] for _ in range(len(word) + 1)]
    alpha, beta = [0.0] * (len(word) + 1), [0.0] * (len(word) + 1)
    for start, end, _, p in spans:
        if into[start]:
            alpha[start], into[start] = _log_sum(into[start]), []
        into[end].append(alpha[start] + p)
    total = alpha[-1] = _log_sum(into[-1])
    out: list[list[float]] = [[] for _ in range(len(word) + 1)]
    for start, end, _, p in reversed(spans):
        if out[end]:
            beta[end], out[end] = _log_sum(out[end]), []
        out[start].append(p + beta[end])
    for start, end, piece, p in spans:
        yield piece, math.exp(alpha[start] + p + beta[end] - total)


def fit(counts: dict[str, dict[str, int]], pieces: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages in order and their piece probabilities, from word counts by language."""
    lattice, langs = Lattice(pieces), sorted(counts)
    probs = np.zeros((lattice.size + 1, len(langs)))
    for column, lang in enumerate(langs):
        words = [w for w in counts[lang] if len(w) < PLAIN_CHARS]
        long = [(MARK + w, n) for w, n in counts[lang].items() if len(w) >= PLAIN_CHARS]
        weight = np.array([counts[lang][w] for w in words], float)
        laid = [(at, points.shape[1], list(lattice.spans(points))) for at, points in _by_length(words)]
        p = np.full((lattice.size + 1, 1), 1 / lattice.size)
        p[-1] = UNKNOWN
        for _ in range(EM_ROUNDS):
            expected = np.full(lattice.size + 1, 0.1)
            for at, n, spans in laid:
                alpha = _forward(spans, n, len(at), p)
                beta = [np.zeros((len(at), 1)) for _ in range(n)] + [np.ones((len(at), 1))]
                for start, end, rows, ids in reversed(spans):
                    beta[start][rows] += p[ids] * beta[end][rows]
                for start, end, rows, ids in spans:
                    share = (alpha[start][rows] * p[ids] * beta[end][rows] / alpha[-1][rows])[:, 0] * weight[at[rows]]
                    np.add.at(expected, ids, share)
            for word, n in long:
                for piece, share in _long_counts(word, lattice, np.log(p[:, 0])):
                    expected[piece] += n * share
            p = (expected / expected[:-1].sum())[:, None]
            p[-1] = UNKNOWN
        probs[:, column] = p[:, 0]
    return langs, probs


def letters(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")


def word_counts(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, dict[str, int]]:
    """Word counts by language, of a sample of whole documents: about ``sample_docs`` of each language, by the hash of their id."""
    rows = docs.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen |= (F.col("lang") == lang) & (draw < int((1 << 30) * min(1.0, sample_docs / n)))
    words = rows.filter(chosen).select("lang", F.explode(F.split(letters(F.col("text")), " ")).alias("w")).filter("w <> ''")
    out: dict[str, dict[str, int]] = {}
    for r in words.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        out.setdefault(r["lang"], {})[r["w"]] = r["n"]
    return out


class Scorer:
    """Scores arrays of texts and remembers words."""

    def __init__(self, langs: list[str], probs: np.ndarray, pieces: list[str]):
        self.langs, self.probs, self.lattice = langs, probs.astype(float), Lattice(pieces)
        self.words, self.scores = Words(CACHE_WORDS), np.zeros((1 << 12, len(langs)))

    def _word_scores(self, words: list[str]) -> np.ndarray:
        if (kept := self.words.forget()) is not None:
            self.scores = self.scores[kept]
        if fresh := self.words.new(words):
            at = self.words.add(fresh)
            self.scores = room(self.scores, len(self.words))
            self.scores[at : len(self.words)] = word_scores(fresh, self.lattice, self.probs)
        return self.scores[self.words.find(words)]

    def _totals(self, text: pa.Array) -> np.ndarray:
        plain = pc.utf8_lower(text.cast(pa.large_string()).fill_null(""))
        lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.replace_substring_regex(plain, r"[^\p{L}\p{M}]+", " ")))
        offsets = np.asarray(lists.offsets)
        coded = pc.dictionary_encode(lists.flatten())
        scores = self._word_scores(coded.dictionary.to_pylist())
        sums = np.concatenate([np.zeros((1, len(self.langs))), np.cumsum(scores[coded.indices.to_numpy(zero_copy_only=False)], 0)])
        return sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]]

    def score(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The language of each text and its share of the likelihood."""
        if not self.langs:
            return np.full(len(text), "und", object), np.zeros(len(text))
        parts, start = [np.zeros((0, len(self.langs)))], 0
        sizes = np.cumsum(pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False))
        while start < len(text):
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, "right")))
            parts.append(self._totals(text.slice(start, end - start)))
            start = end
        total = np.concatenate(parts)
        share = 1 / np.exp(np.minimum(total - total.max(1, keepdims=True), 0)).sum(1)
        none = ~np.asarray(pc.match_substring_regex(text.fill_null(""), r"\p{L}")).astype(bool)
        names = np.array(self.langs, object)[total.argmax(1)]
        names[none] = "und"
        return names, np.where(none, 0.0, share)


def _scored(batches: Iterator[pa.RecordBatch], model: tuple, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch with the language of its texts and its share; the words of a task are remembered until it ends."""
    release_worker()
    scorer = Scorer(*model)
    for batch in batches:
        yield batch, *scorer.score(batch.column(column))
        pa.default_memory_pool().release_unused()
    del scorer
    release_worker()


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def _model(docs: DataFrame, pieces: list[str]) -> tuple[list[str], np.ndarray, list[str]]:
    return *fit(word_counts(docs.filter(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", "text", "lang")), pieces), pieces


def identify(docs: DataFrame, pieces: list[str] | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs``; learns from the rows that aren't held out."""
    model = _model(docs, pieces or public_vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, share in _scored(batches, model, 2):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(share)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, least: float = 0.5, pieces: list[str] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score of ``least``."""
    model, at = _model(docs, pieces or public_vocabulary()), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, names, share in _scored(batches, model, at):
            yield batch.filter(pa.array((names != "und") & (share >= least)))

    return docs.mapInArrow(run, docs.schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
