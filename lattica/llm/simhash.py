"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Fingerprints are eight bytes. Two that differ in at most three bits share at
least five of their eight positional bytes, so at least three within one half
of four positions: eight posting-list families, each keyed by three positional
bytes, hold every linked pair in at least one list. Within a list the shared
positional bytes of a pair are tallied, pairs that reach the guaranteed five
are kept, and the kept ones are verified bit by bit.

Lists above ``LIST_ROWS`` are keyed anew by two more of their other positions
(five shared bytes always lie in one such list); a list that stays above it is
dealt into blocks, and each pair of blocks is compared in a task of its own.
A task emits a spanning forest of its links, never all pairs of a group.

At a stated likeness of word shingles (``near_copies``) more bits differ: 15 %
at 0.8, and of eight bytes hardly one stays whole. So the same method takes
longer fingerprints there, 48 bytes of SimHash over the distinct shingles:
posting lists are keyed by a byte and its position, within a list pairs must
share a second byte, shared bytes are tallied, kept pairs verified bit by bit
and then on their whole sets of shingle hashes.

Defined results: null, empty or blank texts have fingerprint zero and link
like any other; texts of one or two words hash the whole word sequence;
repeated rows each return a row; an empty table returns no rows; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import components, cut, drop_cut, joinable, read, release_worker

POSITIONS = 8
MAX_BITS = 3
SHARED = POSITIONS - MAX_BITS
SEED = 42
LIST_ROWS = 4096
#: Bytes of a text that are cut into words at once.
TEXT_BLOCK = 1 << 20
BLANK = b" \t\n\r\x0b\x0c"

HALVES = (range(0, 4), range(4, 8))
#: Three of the four positions of a half: five shared bytes leave three in one half.
FAMILIES = [c for half in HALVES for c in combinations(half, 3)]


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    at = 0
    while len(data) - at > TEXT_BLOCK:
        end = at + TEXT_BLOCK
        while end < len(data) and data[end] not in BLANK:
            end += 1
        yield data[at:end].split()
        at = end
    yield (data[at:] if at else data).split()


def fingerprint(text: bytes | None) -> int:
    """The unsigned fingerprint of one UTF-8 text."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for block in _word_blocks((text or b"").lower()):
        words = tail + block
        tail = words[-2:]
        if len(words) > 2:
            hashed = np.array(list(map(xxhash.xxh64_intdigest, map(b" ".join, zip(words, words[1:], words[2:])), repeat(SEED))), np.uint64)
            ones += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(hashed)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` of every row; fp is the fingerprint as a signed long."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long")


def _forest(same: np.ndarray, fps: np.ndarray, side: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Links that span each run of equal ``same`` (sorted): tally, count filter, verify, union."""
    n, parent = len(fps), np.arange(len(fps))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right = [], []
    live = np.arange(n)
    step = 1
    while True:
        live = live[live + step < n]
        live = live[same[live] == same[live + step]]
        if not len(live):
            return left, right
        apart = fps[live] ^ fps[live + step]
        shared = (apart.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(1)
        kept = shared >= SHARED
        if side is not None:
            kept &= side[live] != side[live + step]
        near = live[kept][np.bitwise_count(apart[kept]) <= MAX_BITS]
        for i in near[parent[near] != parent[near + step]]:
            a, b = find(int(i)), find(int(i) + step)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(int(i))
                right.append(int(i) + step)
        step += 1


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows ``(k1, k2, fp)`` sorted by list; a list may go on in the next batch."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray) -> pa.RecordBatch:
        change = np.r_[False, (rows[1:, :2] != rows[:-1, :2]).any(1)]
        i, j = _forest(np.cumsum(change), np.ascontiguousarray(rows[:, 2]).view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(rows[i, 2]), pa.array(rows[j, 2])], ["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)], 1)
        if not len(rows):
            continue
        last = (rows[:, :2] == rows[-1, :2]).all(1)
        start = len(rows) - int(last[::-1].argmin() if not last.all() else len(rows))
        if start:
            yield links(np.concatenate([*held, rows[:start]]))
            held = []
        held.append(rows[start:])
    if held:
        yield links(np.concatenate(held))


def _key(positions: tuple[int, ...]) -> F.Column:
    """The bytes at ``positions`` side by side, with the family's number above them."""
    out = F.lit(0).cast("long")
    for p in positions:
        out = F.shiftleft(out, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long")))
    return out


def _lists(fps: DataFrame, families: list[tuple[int, ...]]) -> DataFrame:
    each = F.array(*[F.struct(F.lit(i).cast("long").alias("k1"), _key(c).alias("k2")) for i, c in enumerate(families)])
    return fps.select("fp", F.inline(each)).select("k1", "k2", "fp")


def links(fps: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """``(a, b)``: links between different fingerprints that connect all that are linked; ``fps(fp)`` is distinct."""
    index = _lists(fps, FAMILIES)
    sized = index.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    some = index.join(sized.filter(F.col("n").between(2, list_rows)), ["k1", "k2"], "left_semi")
    large = cut(index.join(sized.filter(F.col("n") > list_rows), ["k1", "k2"], "left_semi"), "lists")
    out = _run(some)
    if large.isEmpty():
        return out
    wider = [tuple(sorted({*c, *more})) for c in FAMILIES for more in combinations(sorted(set(range(POSITIONS)) - {*c}), 2)]
    index = _lists(large.select("fp").distinct(), sorted(set(wider)))
    sized = index.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    some = index.join(sized.filter(F.col("n").between(2, list_rows)), ["k1", "k2"], "left_semi")
    out = out.union(_run(some))
    # A list that is still large is dealt into blocks; each pair of blocks meets under a key of its own.
    blocks = F.ceil(F.col("n") / F.lit(list_rows // 2)).cast("long")
    own = F.pmod(F.xxhash64("fp"), blocks)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.least(o, own) * blocks + F.greatest(o, own))
    dealt = index.join(sized.filter(F.col("n") > list_rows), ["k1", "k2"]).select(F.col("k1"), F.explode(pairs).alias("p"), "k2", "fp")
    return out.union(_run(dealt.select((F.col("k1") + 64 * (F.col("p") + 1)).alias("k1"), "k2", "fp")))


def _run(lists: DataFrame) -> DataFrame:
    return lists.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "fp").mapInArrow(_tally, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row of ``docs(doc_id, text)``."""
    marked = cut(fingerprints(docs), "simhash")
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(first.select("fp")))
    known = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = known.join(lowest, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")


#: Long fingerprints: each byte of the first part keys a posting list, the ``NEXT`` bytes after it part the list.
HUBS, NEXT = 32, 16
PRINT_BYTES = HUBS + NEXT
WORDS = PRINT_BYTES // 8
PRINT = [f"w{k}" for k in range(WORDS)]
#: Shared positional bytes of pairs that are verified.
NEAR_SHARED = 3
#: Rows and pairs of posting lists that are compared at once.
INDEX_ROWS, PAIRS = 1 << 16, 1 << 19
#: Posting lists of prints are dealt into blocks beyond so many times ``list_rows``.
INDEX_LISTS = 16
#: Shingle hashes that a block of candidates has about.
LIST_HASHES = 1 << 20
#: Sets that are handed on at once, and about how many hashes of sets are compared with one set at once.
SET_ROWS, SET_HASHES = 256, 1 << 18


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """Distinct hashes of a text's word shingles, sorted; of the whole word sequence if it is shorter."""
    found, tail = [], []
    for block in _word_blocks((text or b"").lower()):
        words = tail + block
        tail = words[1 - width :] if width > 1 else []
        if len(words) >= width:
            found.append(np.unique(np.array(list(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[k:] for k in range(width)))), repeat(SEED))), np.uint64)))
    if not found and tail:
        found = [np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def long_print(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a set of shingle hashes: a bit is 1 if set in over half of them; words after the first take the hashes mixed anew."""
    ones = np.zeros(8 * PRINT_BYTES, np.int64)
    steps = np.arange(1, WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), 255):
        part = hashes[at : at + 255, None]
        words = np.concatenate([part, _mix(part + steps)], axis=1)
        ones += np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def _print_arrays(prints: list[np.ndarray]) -> list[pa.Array]:
    words = np.array(prints, np.uint64).reshape(-1, WORDS).view(np.int64)
    return [pa.array(np.ascontiguousarray(words[:, k])) for k in range(WORDS)]


def _long_prints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, sizes, prints = [], [], []
            for t in batch.column(2).cast(pa.binary()):
                hashes = shingle_hashes(t.as_py(), width)
                marks.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                sizes.append(len(hashes))
                prints.append(long_print(hashes))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(marks, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), *_print_arrays(prints)], ["rid", "doc_id", "fp", "n", *PRINT])
        release_worker()

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SET_ROWS):
                part = batch.slice(at, SET_ROWS)
                sets = [shingle_hashes(t.as_py(), width).tobytes() for t in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sets, pa.binary())], [*part.schema.names[:-1], "hashes"])
        release_worker()

    return run


def _most_bits(similarity: float) -> float:
    """Bits in which pairs of that likeness differ at most (five deviations; sets of few shingles differ in a quarter more)."""
    p = 1.25 * np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return 8 * PRINT_BYTES * p + 5 * np.sqrt(8 * PRINT_BYTES * p * (1 - p))


def _kept(apart: np.ndarray, most: float) -> np.ndarray:
    """Which pairs of prints, given what differs, share enough bytes, and then enough bits."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    whole = PRINT_BYTES - np.bitwise_count((((apart & low) + low) | apart) & ~low).sum(1, dtype=np.int64)
    kept = whole >= NEAR_SHARED
    kept[kept] = np.bitwise_count(apart[kept]).sum(1, dtype=np.int64) <= most
    return kept


def _index_forest(rows: np.ndarray, similarity: float) -> tuple[list[int], list[int]]:
    """Candidate links that span what is linked within each list of ``rows (k, p, fp, n, print)``, sorted by list."""
    m, most = len(rows), _most_bits(similarity)
    lists = np.cumsum(np.r_[False, (rows[1:, :2] != rows[:-1, :2]).any(1)]) << 8
    sizes, prints = rows[:, 3], np.ascontiguousarray(rows[:, 4:]).view(np.uint64)
    bytes_, hub = prints.view(np.uint8), rows[:, 0] >> 8
    parent = np.arange(m)
    left, right = [], []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def flat() -> None:
        while (parent != parent[parent]).any():
            parent[:] = parent[parent]

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        flat()
        todo = parent[i] != parent[j]
        i, j = i[todo], j[todo]
        todo = np.minimum(sizes[i], sizes[j]) / np.maximum(sizes[i], sizes[j]) >= similarity
        i, j = i[todo], j[todo]
        near = _kept(prints[i] ^ prints[j], most)
        for a, b in zip(i[near].tolist(), j[near].tolist()):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                left.append(a)
                right.append(b)

    for step in range(1, NEXT + 1):
        key = lists + bytes_[np.arange(m), hub + step]
        order = np.argsort(key, kind="stable")
        beside = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        compare(order[beside], order[beside + 1])
        # The rest of each run: rows of one group lie together, and each row meets those after its group.
        flat()
        order = np.lexsort((parent, key))
        run, group = key[order], parent[order]
        ends = np.flatnonzero(np.r_[run[1:] != run[:-1], True]) + 1
        parts = np.flatnonzero(np.r_[(run[1:] != run[:-1]) | (group[1:] != group[:-1]), True]) + 1
        at = np.arange(m)
        first, end = parts[np.searchsorted(parts, at, "right")], ends[np.searchsorted(ends, at, "right")]
        before = np.r_[0, np.cumsum(end - first)]
        start = 0
        while before[start] < before[-1]:
            stop = max(start + 1, int(np.searchsorted(before, before[start] + PAIRS, "right")) - 1)
            count = (end - first)[start:stop]
            i = np.repeat(at[start:stop], count)
            j = np.arange(len(i)) + np.repeat(first[start:stop] - (before[start:stop] - before[start]), count)
            compare(order[i], order[j])
            start = stop
    return left, right


def _index_tally(similarity: float):
    """Over rows ``(k, p, fp, n, print)`` sorted by list: candidate pairs; a list may go on in the next batch."""

    def links(rows: np.ndarray) -> pa.RecordBatch:
        i, j = _index_forest(rows, similarity)
        return pa.RecordBatch.from_arrays([pa.array(rows[i, 2], pa.int64()), pa.array(rows[j, 2], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1).astype(np.int64, copy=False))
            n += batch.num_rows
            if n < INDEX_ROWS:
                continue
            rows = np.concatenate(held)
            other = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))
            start = int(other[-1]) + 1 if len(other) else 0
            if start:
                yield links(rows[:start])
            held, n = [rows[start:].copy()], len(rows) - start
            del rows
        if n:
            yield links(np.concatenate(held))
        del held
        release_worker()

    return run


def _near_forest(same: np.ndarray, fp: np.ndarray, sizes: np.ndarray, prints: np.ndarray, hashes: np.ndarray, similarity: float) -> tuple[list[int], list[int]]:
    """As ``_forest``, for long prints: what a row shares with those after it in its run is tallied, kept pairs are verified on their whole sets."""
    most = _most_bits(similarity)
    starts = np.r_[0, np.cumsum(sizes)]
    known, ids = np.unique(hashes, return_inverse=True)
    own, label = np.zeros(len(known), bool), np.arange(len(fp))
    ends = np.searchsorted(same, same, "right")
    left, right = [], []
    for i in np.flatnonzero(ends > np.arange(len(fp)) + 1).tolist():
        j = np.arange(i + 1, ends[i])
        j = j[label[j] != label[i]]
        j = j[np.minimum(sizes[j], sizes[i]) / np.maximum(sizes[j], sizes[i]) >= similarity]
        j = j[_kept(prints[j] ^ prints[i], most)]
        mine = ids[starts[i] : starts[i + 1]]
        own[mine] = True
        for part in np.split(j, np.flatnonzero(np.diff(np.cumsum(sizes[j]) // SET_HASHES)) + 1) if len(j) else ():
            before = np.r_[0, np.cumsum(sizes[part])]
            there = np.repeat(starts[part] - before[:-1], sizes[part]) + np.arange(before[-1])
            common = np.add.reduceat(own[ids[there]], before[:-1], dtype=np.int64)
            for k in part[common / (sizes[i] + sizes[part] - common) >= similarity].tolist():
                if label[k] != label[i]:
                    label[label == label[k]] = label[i]
                    left.append(i)
                    right.append(k)
        own[mine] = False
    return left, right


def _near_tally(similarity: float):
    """Over rows ``(k1, k2, fp, n, print, hashes)`` sorted by candidates' group and block; one may go on in the next batch."""

    def links(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        k1, k2, fp = (rows.column(k).to_numpy() for k in range(3))
        prints = np.stack([rows.column(w).to_numpy() for w in PRINT], 1).view(np.uint64)
        same = np.cumsum(np.r_[False, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        hashes = np.frombuffer(b"".join(rows.column("hashes").to_pylist()), np.uint64)
        i, j = _near_forest(same, fp, rows.column(3).to_numpy(), prints, hashes, similarity)
        return pa.RecordBatch.from_arrays([pa.array(fp[i], pa.int64()), pa.array(fp[j], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            other = np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))
            start = int(other[-1]) + 1 if len(other) else 0
            if held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (int(k1[0]), int(k2[0])):
                yield links(held)
                held = []
            if start:
                yield links([*held, batch.slice(0, start)])
                held = []
            held.append(batch.slice(start))
        if held:
            yield links(held)
        del held
        release_worker()

    return run


def _dealt(blocks: F.Column, alone: F.Column) -> F.Column:
    """Numbers of the pairs of blocks in which a row meets others; -1 for the whole of a group that stays in one."""
    own = F.pmod(F.xxhash64("fp"), blocks)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.least(o, own) * blocks + F.greatest(o, own))
    return F.when(alone, F.array(F.lit(-1).cast("long"))).otherwise(pairs)


def candidates(prints: DataFrame, similarity: float = 0.8, list_rows: int = LIST_ROWS) -> DataFrame:
    """``(a, b)``: links that connect all of ``prints(fp, n, w0, ...)`` that the index finds alike; ``fp`` is distinct."""
    byte = lambda k: F.shiftrightunsigned(F.col(PRINT[k // 8]), 8 * (k % 8)).bitwiseAND(F.lit(255).cast("long"))
    # A set that any other text's must differ from too much needs no list.
    index = prints.filter(F.col("n") / (F.col("n") + 1) >= similarity).select(F.explode(F.array(*[byte(k) + 256 * k for k in range(HUBS)])).alias("k"), "fp", "n", *PRINT)
    sized = index.groupBy("k").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")  # at most 256 for each hub
    most = INDEX_LISTS * list_rows
    blocks = F.ceil(F.col("m") / F.lit(max(1, most // 2))).cast("long")
    dealt = index.join(F.broadcast(sized), "k").select("k", F.explode(_dealt(blocks, F.col("m") <= most)).alias("p"), "fp", "n", *PRINT)
    return dealt.repartition("k", "p").sortWithinPartitions("k", "p").mapInArrow(_index_tally(similarity), "a long, b long")


def near_groups(rows: DataFrame, width: int = 5, similarity: float = 0.8, list_rows: int = LIST_ROWS) -> DataFrame:
    """``(rid, doc_id, root)`` of every row of ``rows(rid, doc_id, text)``, written with ids of their own: groups of texts alike in their shingles."""
    rows = rows.select("rid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = ", ".join(f"{w} long" for w in PRINT)
    marked = cut(rows.mapInArrow(_long_prints(width), f"rid long, doc_id long, fp long, n long, {words}"), "prints")
    first = cut(marked.groupBy("fp").agg(F.min("rid").alias("rid"), *(F.first(c).alias(c) for c in ("n", *PRINT))), "reps")
    # Groups of candidates; whole sets are made again for their texts alone.
    found = components(candidates(first.select("fp", "n", *PRINT), similarity, list_rows)).select(F.col("node").alias("fp"), F.col("root").alias("k1"))
    listed = cut(first.join(found, "fp").select("k1", "fp", "n", *PRINT, "rid"), "listed")
    sized = listed.groupBy("k1").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"))
    sets = rows.select("rid", "text").join(joinable(listed, 1_000_000), "rid").select("k1", "fp", "n", *PRINT, "text").mapInArrow(_sets(width), f"k1 long, fp long, n long, {words}, hashes binary")
    blocks = F.greatest(F.ceil(F.col("m") / F.lit(list_rows // 2)), F.ceil(F.col("w") / F.lit(LIST_HASHES))).cast("long")
    alone = (F.col("m") <= list_rows) & (F.col("w") <= 2 * LIST_HASHES)
    joined = sets.join(joinable(sized, 1_000_000), "k1").select("k1", F.explode(_dealt(blocks, alone)).alias("k2"), "fp", "n", *PRINT, "hashes")
    edges = joined.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "fp").mapInArrow(_near_tally(similarity), "a long, b long")
    roots = components(edges)
    drop_cut(first, listed)
    return marked.select("rid", "doc_id", "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("rid", "doc_id", F.coalesce("root", "fp").alias("root"))


def near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8, list_rows: int = LIST_ROWS) -> DataFrame:
    """``(doc_id, component_id)`` of every row: groups of texts alike in their shingles of ``width`` words."""
    rows = cut(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), "rows")
    groups = near_groups(rows, width, similarity, list_rows)
    lowest = groups.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return groups.join(lowest, "root").select("doc_id", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
