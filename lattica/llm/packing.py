"""Vector bin packing of tokenised examples into training sequences.

A sequence has limits in three dimensions at once: tokens, segments and
loss-bearing tokens. Pieces are placed by the dot-product heuristic: of the
pieces that fit the open sequence in every dimension, the one whose demand has
the largest dot product with what is left of it goes in; when none fits, the
next sequence opens.

A document is cut where a sequence would be full of tokens or of loss-bearing
tokens: into whole sequences and one remainder. Instruction data have a prompt,
whose tokens bear no loss, so the three limits bind apart from each other. Pieces are dealt by hash into groups of ``GROUP_PIECES``, and each
group is packed in a task of its own, so memory is bounded at every size and
only the last sequences of a group are left open. The same input gives the
same sequences, whichever executor packs a group.

Texts are tokenised whole. As no token crosses white space, a batch's words
are encoded as a dictionary, and each distinct word meets the tokenizer once.

Defined results: null and empty texts are the end token alone; repeated rows
are packed each for itself; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import Words, blocks_for, cut, held_by_worker, read, room

TOKENS = 4096
END_ID = 2
#: Segments that one sequence may hold.
SEGMENTS = 256
#: Of a sequence: tokens, segments, loss-bearing tokens.
LIMITS = (TOKENS, SEGMENTS, TOKENS)
GROUP_PIECES = 4096
#: Words whose ids a worker remembers, and bytes of text that are laid out at once: as much as an executor of 3 GB holds beside
#: nothing else, and where other stages have filled its memory before.
MEMORY, LITTLE_MEMORY = (800_000, 4_000_000), (120_000, 1_000_000)
#: Rows that are taken at once.
BATCH_ROWS = 2000
MARKS = ".,;:!?"
BLANK = b" \t\n\r\x0b\x0c"


class WordIds:
    """Ids of texts, word by word, from a tokenizer file.

    ASCII capitals are lowered first, as the tokenizer would, and a word's final
    punctuation is looked up apart from it: both are what makes words differ most.
    """

    def __init__(self, path: str, most: int = MEMORY[0]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words = Words(most)
        self.starts, self.sizes, self.used = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0
        self.pool = np.zeros(1 << 14, np.uint32)

    def _gather(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, end to end, and where each one's end."""
        sizes = self.sizes[words]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.pool[np.repeat(self.starts[words] - ends[:-1], sizes) + np.arange(ends[-1])], ends

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) == len(plain):  # a word of letters ends with its only word end
            sizes = np.diff(last, prepend=-1)
        else:
            rest, ids, sizes, plain = words, ids[:0], last[:0], []
        found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        sizes = np.concatenate([sizes, np.fromiter(map(len, found), np.int64, len(found))])
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))])
        at, upto = self.words.add(chain(plain, rest)), self.used + len(ids)
        self.starts, self.sizes, self.pool = room(self.starts, len(self.words)), room(self.sizes, len(self.words)), room(self.pool, upto)
        self.starts[at : len(self.words)], self.sizes[at : len(self.words)] = self.used + np.cumsum(sizes) - sizes, sizes
        self.pool[self.used : upto], self.used = ids, upto

    def _units(self, words: pa.Array) -> np.ndarray:
        """Of each distinct word, where it and its final punctuation are known; these stand apart after a letter or digit below U+0250."""
        cores = pc.utf8_rtrim(words, MARKS)
        split = pc.and_(pc.not_equal(cores, words), pc.match_substring_regex(cores, "[a-z0-9\u00df-\u00f6\u00f8-\u012f]$"))
        tails = pc.if_else(split, pc.extract_regex(words, f"(?P<t>[{MARKS}]*)$").field("t"), "")
        coded = [pc.dictionary_encode(c) for c in (pc.if_else(split, cores, words), tails)]
        distinct = [c.dictionary.to_pylist() for c in coded]
        if fresh := self.words.new(chain(*distinct)):
            self._learn(fresh)
        places = [self.words.find(d) for d in distinct]
        return np.stack([p[c.indices.to_numpy(zero_copy_only=False)] for p, c in zip(places, coded)], 1)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        if (kept := self.words.forget()) is not None:
            self.pool, ends = self._gather(kept)
            self.starts, self.sizes, self.used = ends[:-1], np.diff(ends), len(self.pool)
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # what may be a special token is left as it is
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        offsets = np.asarray(lists.offsets).astype(np.int64)
        offsets -= offsets[0]
        coded = pc.dictionary_encode(lists.flatten())
        units = self._units(coded.dictionary)
        flat, ends = self._gather(units[coded.indices.to_numpy(zero_copy_only=False)].ravel())
        return np.split(flat, ends[2 * offsets[1:-1]])


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about a slice, cut at white space."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and text[end] not in BLANK:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _documents(texts: list[bytes | None], encoder: WordIds, slice_bytes: int = MEMORY[1]) -> Iterator[np.ndarray]:
    """The ids of each text with the end id, in order."""
    waiting: list[tuple[bytes, bool]] = []
    size, held = 0, []

    def flush() -> Iterator[np.ndarray]:
        if not waiting:
            return
        for ids, (_, last) in zip(encoder.ids(pa.array([w[0] for w in waiting], pa.large_binary()).cast(pa.large_string())), waiting):
            held.append(ids)
            if last:
                yield np.concatenate([*held, np.array([END_ID], np.uint32)])
                held.clear()

    for text in texts:
        parts = list(_parts(text or b"", slice_bytes))
        for k, part in enumerate(parts):
            waiting.append((part, k == len(parts) - 1))
            size += len(part)
            if size >= slice_bytes:
                yield from flush()
                waiting.clear()
                size = 0
    yield from flush()


FOUND = "doc_id long, start long, length long, loss long, ids_crc32 long, doc_tokens long"


def _cutter(path: str, limits: tuple[int, int, int], memory: tuple[int, int] = MEMORY):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held_by_worker(("words", path, memory), lambda: WordIds(path, memory[0]))
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            rows: list[tuple] = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            if asked := batch.num_columns > 2:
                texts = list(chain.from_iterable(zip(batch.column(2).cast(pa.binary()).to_pylist(), texts)))
            found = _documents(texts, encoder, memory[1])
            for doc_id in batch.column(0).to_pylist():
                prompt = next(found)[:-1] if asked else ()
                ids, own = next(found), len(prompt)
                ids = np.concatenate([prompt, ids]) if own else ids
                raw, start = ids.astype("<u4").tobytes(), 0
                while start < len(ids):
                    end = min(start + limits[0], len(ids), max(start, own) + limits[2])
                    rows.append((doc_id, start, end - start, max(0, end - max(start, own)), zlib.crc32(raw[4 * start : 4 * end]), len(ids)))
                    start = end
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [c.split()[0] for c in FOUND.split(", ")])
            pa.default_memory_pool().release_unused()

    return run


def pieces(docs: DataFrame, path: str, limits: tuple[int, int, int] = LIMITS, prompt: str | None = None, memory: tuple[int, int] = MEMORY) -> DataFrame:
    """``(doc_id, start, length, loss, ids_crc32, doc_tokens)``: every document's ids, cut where a sequence would be full; the ids of the column ``prompt`` stand in front and bear no loss."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.col(prompt).cast("string").alias("prompt")] if prompt else []))
    return rows.mapInArrow(_cutter(path, limits, memory), FOUND)


def place(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and position of each row of ``demand`` (items, dimensions) under ``limits``; ties go to the first row."""
    share = demand / limits
    if len(share) and share.max() > 1:
        raise ValueError("an item is larger than a sequence")
    bins, order = np.zeros(len(share), np.int64), np.zeros(len(share), np.int64)
    # Items that are placed get a demand that never fits; they are left out when half are placed.
    todo, open_ = np.arange(len(share)), share.T.copy()
    current, left, filled, placed = 0, np.ones(share.shape[1]), 0, 0
    while len(todo):
        score = left @ open_
        score[(open_ > left[:, None] + 1e-12).any(0)] = -1.0
        k = int(score.argmax())
        if score[k] < 0:
            current, left, filled = current + 1, np.ones(share.shape[1]), 0
            continue
        item = todo[k]
        bins[item], order[item] = current, filled
        left, filled, placed = left - share[item], filled + 1, placed + 1
        open_[:, k] = 2.0
        if 2 * placed >= len(todo):
            keep = open_[0] < 2.0
            todo, open_, placed = todo[keep], open_[:, keep].copy(), 0
    return bins, order


def _packer(limits: tuple[int, ...]):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "descending" if c == "length" else "ascending") for c in ("length", "doc_id", "start", "ids_crc32")])
        length, loss = table["length"].to_numpy(), table["loss"].to_numpy()
        bins, order = place(np.stack([length, np.ones(len(length)), loss], 1).astype(float), np.array(limits, float))
        by = np.lexsort((order, bins))
        ends = np.cumsum(length[by])
        first = np.r_[True, bins[by][1:] != bins[by][:-1]] if len(by) else np.zeros(0, bool)
        base = np.maximum.accumulate(np.where(first, ends - length[by], 0)) if len(by) else ends
        offset = np.zeros(len(by), np.int64)
        offset[by] = ends - length[by] - base
        sequence = table["grp"].to_numpy().astype(np.int64) * (1 << 32) + bins
        return table.drop_columns(["grp"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(items: DataFrame, limits: tuple[int, int, int] = LIMITS) -> DataFrame:
    """``items(doc_id, start, length, loss, ids_crc32, doc_tokens)``, a written table, with ``sequence_id`` and ``offset``; limits are tokens, segments, loss-bearing tokens."""
    groups = blocks_for(items.count(), GROUP_PIECES)
    # Equal rows, too, are dealt over all groups.
    dealt = items.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(_packer(limits), f"{FOUND}, sequence_id long, offset long")


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, path: str | None = None, limits: tuple[int, int, int] = LIMITS, prompt: str | None = None, memory: tuple[int, int] = MEMORY) -> DataFrame:
    """Tokenise, cut and pack ``docs(doc_id, text)``. In plain documents every token bears loss; in instruction data those of ``text``, not of the column ``prompt``."""
    return pack(cut(pieces(docs, path or public_tokenizer(), limits, prompt, memory), "pieces"), limits)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
