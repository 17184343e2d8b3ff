"""The corpus pipeline: stages act, keep clean documents and the columns of ``documents``."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from conftest import DATA

import corpus_pipeline
from lattica.llm import langid, packing


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = out.count()
        rows = stage(spark, out, DATA).toPandas()
        out = spark.createDataFrame(rows, docs.schema)
        assert out.columns == docs.columns and 0 < len(rows) <= before, name
    packed = corpus_pipeline.STAGES[-1][1](spark, out, DATA).toPandas()
    assert set(packed.doc_id) == set(rows.doc_id)


def test_near_and_leaking_documents_go(spark):
    draw = np.random.default_rng(0)
    clean = [" ".join(f"w{x}" for x in draw.integers(0, 5000, 120)) for _ in range(10)]
    near = clean[0].replace(clean[0].split()[50], "other", 1)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*clean, near, near])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect()}
    assert kept == set(range(10))
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first()["text"]
    leak = docs.union(spark.createDataFrame([(99, f"{clean[1]} {item} {clean[2]}", "en", "s", 1)], docs.schema))
    assert {r["doc_id"] for r in corpus_pipeline.benchmark(spark, leak, DATA).collect()} == set(range(12))


def test_near_copies_come_through_simhash(spark, monkeypatch):
    """What the SimHash index doesn't name as candidates isn't removed: no other way stands in for it."""
    draw = np.random.default_rng(2)
    text = " ".join(f"w{x}" for x in draw.integers(0, 5000, 120))
    rows = [(0, text, "en", "s", 1), (1, text.replace(text.split()[60], "other", 1), "en", "s", 1), (2, f" {text}", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = lambda: {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect()}
    assert kept() == {0}
    monkeypatch.setattr(corpus_pipeline.simhash, "candidates", lambda prints, *a: spark.createDataFrame([], "a long, b long"))
    assert kept() == {0, 1}


def test_batches_of_text_are_small(spark, monkeypatch):
    """The stages that hand texts to Python do so a few MB at a time, long rows whole; a smaller bound of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(20)
    texts = spark.range(0, 2000, 1, 1).selectExpr("repeat('a word ', 1000) as text").union(spark.range(0, 2, 1, 1).selectExpr("repeat('a word ', 1000000)"))
    monkeypatch.setattr(langid, "accepted", lambda docs: docs)
    stages = dict(corpus_pipeline.STAGES)
    try:
        for stage in ("language_id", "simhash_near_dedup", "packing"):
            spark.conf.unset(name)
            assert stages[stage](spark, docs, DATA).count() > 0
            found = texts.mapInArrow(sizes, "n long, size long").toPandas()
            assert found.n.sum() == 2002, stage
            # A batch ends with the row that fills it, so two have a row of 7 MB as well.
            assert (found["size"] < 4 << 20).sum() >= 6 and found["size"].max() < 10_000_000, stage
        spark.conf.set(name, "1m")
        assert stages["language_id"](spark, docs, DATA).count() == 20
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)


def test_null_and_repeated_ids(spark):
    draw = np.random.default_rng(1)
    prose = lambda n=120: " ".join(f"w{x}" for x in draw.integers(0, 5000, n))
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first()["text"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    kept = lambda stage, rows: sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in stage(spark, frame(rows), DATA).collect()))
    key = lambda rows: sorted((i is None, i or 0, t) for i, t in rows)
    a, b, c, d, e = (prose() for _ in range(5))
    rows = [(None, a), (None, b), (7, c), (7, d), (3, e), (7, e), (None, e)]
    assert kept(corpus_pipeline.near_dedup, rows) == key(rows[:5])
    rows = [(None, f"{a} {item}"), (None, b), (7, f"{c} {item}"), (7, d)]
    assert kept(corpus_pipeline.benchmark, rows) == key([rows[1], rows[3]])
    line = "these six words stand in both"
    got = kept(corpus_pipeline.line_dedup, [(None, f"{line}\n{a}"), (None, f"{line}\n{b}"), (7, f"{line}\n{c}")])
    assert sum(line in t for _, _, t in got) == 1 and len(got) == 3


def test_whole_run_brute_force(spark, tmp_path):
    """``run`` against the same five rules written plainly: every document against every other, one after another."""
    import regex
    from test_llm import brute_leaks, brute_lines, components_of
    from tokenizers import Tokenizer

    asked = "A train with 320 seats leaves the harbour at 7 and reaches a town after 13 hours, so how many seats stay empty if 250 people ride and 40 leave halfway?"
    again = regex.sub(r"\d+", lambda m: {"320": "411", "7": "9", "13": "17", "250": "377", "40": "22"}[m[0]], asked)
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()} | {10**6: asked}
    draw = np.random.default_rng(3)
    known = sorted({w for _, t, lang in rows if lang == "en" for w in (t or "").split() if w.isalpha()})
    prose = lambda n: " ".join(draw.choice(known, n))
    long = prose(120)
    planted = [long, " ".join(["other", *long.split()[1:]]), f"{prose(60)} {again} {prose(60)}", f"{prose(40)} {items[min(items)]} {prose(40)}", f"\n{long}\n", None, "", "12 34", prose(9000)]
    rows += [(10_000 + k, t, None) for k, t in enumerate(planted)] + [rows[0], (None, prose(50), "en"), (None, None, None)]
    where = str(tmp_path)
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")

    # Language: every word's segmentations, summed one character after another.
    langs, probs, pieces = langid._model(docs, langid.public_vocabulary())
    number, most, seen = {p: k for k, p in enumerate(pieces)}, max(map(len, pieces)), {}

    def word(w):
        sums = [np.ones(len(langs))]
        for end in range(1, len(w) + 1):
            ways = [sums[s] * probs[number.get(w[s:end], -1)] for s in range(max(0, end - most), end) if w[s:end] in number or s == end - 1]
            sums.append(np.sum(ways, 0))
        return np.log(sums[-1])

    def spoken(text):
        found = regex.findall(r"[\p{L}\p{M}]+", (text or "").lower())
        for w in set(found) - seen.keys():
            seen[w] = word(langid.MARK + w)
        total = sum((seen[w] for w in found), np.zeros(len(langs)))
        return bool(regex.search(r"\p{L}", text or "")) and 1 / np.exp(total - total.max()).sum() >= 0.5

    kept = [(i, t) for i, t, _ in rows if spoken(t)]
    left = [len(rows), len(kept)]

    # Lines, of documents in the order of their ids.
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (h >> 63 << 64)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, signed(r[1])))
    whole, kept = kept, []
    spans = brute_lines([(k, t) for k, (_, t) in enumerate(whole)])
    for k, (i, text) in enumerate(whole):
        own, out, at = sorted(s[1:3] for s in spans if s[0] == k), "", 0
        for start, end in own:
            out, at = out + text[at:start], end + 1
        if not own or (out + text[at:]).strip():
            kept.append((i, out + text[at:]))
    left.append(len(kept))

    # Near copies, each pair.
    def shingles(text):
        w = text.encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}

    sets = [shingles(t) for _, t in kept]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    roots = components_of(range(len(kept)), links)
    kept = [r for k, r in enumerate(kept) if roots[k] == k]
    left.append(len(kept))

    # Benchmark items, each against each document.
    hit = {k for k, _ in brute_leaks({k: t for k, (_, t) in enumerate(kept)}, items)}
    kept = [r for k, r in enumerate(kept) if k not in hit]
    left.append(len(kept))
    assert all(a > b for a, b in zip(left, left[1:])), left
    assert not {10_001, 10_002, 10_003, 10_004, 10_005, 10_006, 10_007} & {i for i, _ in kept} and 10_008 in {i for i, _ in kept}

    # Sequences: the pieces are those of the tokenizer, and lie in them without gap or overlap.
    tok, wanted = Tokenizer.from_file(packing.public_tokenizer()), []
    for i, text in kept:
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, packing.END_ID], "<u4")
        wanted += [(i, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes()), len(ids)) for at in range(0, len(ids), 4096)]
    got = corpus_pipeline.run(spark, where).collect()
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got), key=str) == sorted(wanted, key=str)
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= packing.TOKENS
