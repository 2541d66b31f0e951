"""Operators on texts against brute force, with nulls, empty and very long texts, ties, repeats, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from seatplan.llm import bpe, common, compression, context_mixing, jaccard, perplexity, token_counts, toxicity, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
PROSE = "The quick brown fox jumps over a lazy dog while seven wise owls watch from an old oak near the river bend"
TEXTS = [
    (1, PROSE),
    (2, PROSE),
    (3, PROSE.replace("seven", "eight")),
    (4, PROSE + " and then they all went home to sleep"),
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (8, "two words"),
    (9, "Two  WORDS"),
    (10, "Ünïcödé wörds ßind hier — ö x\n\nline\nline \nline"),
    (11, ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 900).strip()),
    (12, "a" * 70_000),
    (13, "x y z " * 3),
    (None, PROSE),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if (k or 0) % 2 else None, "row", 1) for k, t in TEXTS] + [(1, PROSE, "en", "row", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _key string, n int")


def _shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _components(texts):
    """All pairs."""
    keys = [(k, _shingles(t)) for k, t in texts if k is not None]
    parent = {k: k for k, _ in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(keys):
        for b, y in keys[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {k: find(k) for k, _ in keys}


def test_jaccard_against_all_pairs(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()}
    want = _components(TEXTS)
    assert {k: v[1] for k, v in got.items() if k is not None} == want
    assert {k: v[0] for k, v in got.items()} == {k: len(_shingles(t)) for k, t in TEXTS}
    assert got[None][1] is None
    assert jaccard.join(docs).count() == len(TEXTS) + 1


def test_jaccard_of_many_near_copies(spark):
    import random

    rnd, rows = random.Random(3), []
    base = [f"w{i}" for i in range(120)]
    for k in range(150):
        words = list(base)
        for _ in range(rnd.choice((0, 1, 2, 3, 4, 6))):
            words[rnd.randrange(120)] = f"v{rnd.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    got = {r[0]: r[1] for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect()}
    assert got == _components(rows)


def test_one_of_each_keeps_null_keys(docs):
    kept = sorted((r["doc_id"] or -1) for r in jaccard.one_of_each(docs).collect())
    groups = _components(TEXTS)
    assert kept == sorted([k for k, g in groups.items() if k == g] + [-1])
    assert jaccard.one_of_each(docs).columns == docs.columns


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert jaccard.join(none).count() == 0
    assert perplexity.assess(none).count() == 0
    assert context_mixing.score(none, context_mixing.fit(none)).count() == 0
    weights, settings = toxicity.fit(docs, labels, F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, weights, settings).collect()} == {0.5}
    assert {r["score"] for r in compression.score(docs, compression.fit(docs, labels, F.lit(True))).collect()} == {0.5}


def _base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(docs):
    rows = perplexity.assess(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    text = dict(TEXTS)
    for r in rows:
        assert tuple(r[c] for c in perplexity.COLUMNS) == _base(text[r["doc_id"]]), r["doc_id"]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_perplexity_model_adds_up(docs):
    import numpy as np

    model = perplexity.fit(docs, perplexity.Settings())
    for context in (b"the", b" qu", b"zzz"):
        keys = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], dtype=np.uint64)
        assert math.isclose((10 ** model.log10(keys)).sum(), 1, rel_tol=1e-6)


def test_perplexity_band_rejects_noise_only(spark):
    import random

    rnd = random.Random(1)
    vocabulary = ["".join(rnd.choice(("ba", "lo", "mi", "ter", "con", "dis")) for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    rows = [(k, " ".join(rnd.choices(vocabulary, k=120)), "en") for k in range(200)]
    rows.append((999, " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(7)) for _ in range(120)), "en"))
    kept = {r["doc_id"]: r["kept"] for r in perplexity.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not kept[999] and sum(kept.values()) >= 198


def test_perplexity_band_is_not_closed_by_copies(spark):
    import random

    rnd = random.Random(1)
    vocabulary = ["".join(rnd.choice(("ba", "lo", "mi", "ter", "con", "dis")) for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    rows = [(k, " ".join(rnd.choices(vocabulary, k=120)), "en") for k in range(200)]
    rows.append((999, " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(7)) for _ in range(120)), "en"))
    rows += [(1_000 + k, rows[0][1], "en") for k in range(800)]
    kept = {r["doc_id"]: r["kept"] for r in perplexity.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not kept[999] and sum(kept[k] for k in range(200)) >= 198 and all(kept[k] for k in range(1_000, 1_800))


def test_context_mixing_base_and_probability(docs):
    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 10 == 0
    trained = context_mixing.fit(docs.filter(~held))
    rows = context_mixing.score(docs, trained).collect()
    tokens = {k: [*WORD.findall((t or "").translate(LOWER)), "\n"] for k, t in TEXTS}
    known = Counter(w for k, w in [(k, w) for k, ws in tokens.items() for w in ws] if (k or 0) % 10)
    known.update(tokens[1])  # repeated row
    n, v = sum(known.values()), len(known)
    assert (trained.n, trained.v) == (n, v)
    for r in rows:
        words = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (len(words), sum(known[w] > 0 for w in words))
        assert math.isclose(r["base_score"], sum(math.log10((known[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel_tol=1e-9)
        assert r["score"] < 0


def test_context_mixing_code_is_complete(docs):
    """One-byte words and longer ones share at most all probability."""
    import numpy as np

    model = context_mixing.fit(docs).model
    words = [bytes([a]) for a in range(33, 256)] + [bytes([a, b]) for a in range(97, 123) for b in range(33, 127)]
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    assert (10 ** model.log10(data, offsets, np.full(len(words), 10, dtype=np.uint8))).sum() <= 1 + 1e-9


def test_context_mixing_learns_from_all_tokens(spark):
    """Of more tokens than were drawn once, all are in the map, and no other weights make them likelier."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice(("ba", "lo", "mi", "ter", "con", "dis")) for _ in range(rnd.randint(1, 6))) for _ in range(5_000)]
    docs = spark.createDataFrame([(k, " ".join(rnd.choices(vocabulary, k=1_000))) for k in range(250)], "doc_id long, text string")
    s, model = context_mixing.Settings(), context_mixing.fit(docs).model
    counted = pa.Table.from_batches(context_mixing.count(docs, s).toArrow().to_batches()).combine_chunks().to_batches()[0]
    assert pa.compute.sum(counted["n"]).as_py() == 250 * 1_001
    edges = context_mixing.first_slots(s.bits)
    both, found = np.zeros(2 * edges[-1], dtype=np.float32), context_mixing.bits_of(*context_mixing._columns(counted), model.code, s.bits, model.begun)
    n = found.spread(counted["n"].to_numpy().astype(float))
    for k, slot in enumerate(found.slots):
        np.add.at(both, 2 * (slot + edges[k]) + found.bit, n if k < context_mixing.PREDICTORS - 1 else n * found.begun)
    known = context_mixing.without_own(model.code, model.begun, both[::2], both[1::2], s.bits)
    total = np.zeros(context_mixing._EDGES[-1])
    context_mixing.learned(known, model.weights, None, counted, total)
    slopes, likely, cell, _ = np.split(total, context_mixing._EDGES[:-1])
    assert math.isclose(cell.sum(), n.sum())
    cell = cell.reshape(model.costs.shape)
    many = cell.sum(axis=-1) > 1_000
    assert many.any() and np.allclose(10 ** model.costs[..., 1][many], (cell[..., 1] / np.maximum(cell.sum(axis=-1), 1))[many], atol=0.01)
    better = context_mixing.stepped(model.weights, np.tile(np.array(s.start), (context_mixing.GATES, 1)), slopes)
    again = np.zeros_like(total)
    context_mixing.learned(known, better, None, counted, again)
    assert again[context_mixing._EDGES[0] : context_mixing._EDGES[1]].sum() <= likely.sum() * (1 - 1e-3)
    assert 0 < model.trust < 1


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return bpe.Tokenizer(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


@pytest.mark.parametrize("chunks", [bpe.Chunks(), bpe.Chunks(64, 16), bpe.Chunks(1000, 40)])
def test_bpe_round_trip(docs, tokenizer, chunks):
    code, text = bpe.encoding(tokenizer), dict(TEXTS)
    rows = bpe.digests(bpe.encode(docs, tokenizer, chunks)).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        raw = text[r["doc_id"]] or ""
        ids = code.encode_ordinary(raw)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(raw.encode()).hexdigest()


def _encoded_right(rows, text, code):
    for r in rows:
        raw = text[r["doc_id"]]
        ids = code.encode_ordinary(raw)
        assert (r["n_tokens"], r["ids"], r["decoded"]) == (len(ids), ",".join(map(str, ids)), bytearray(raw.encode())), r["doc_id"]


def test_bpe_borders_of_random_texts(spark, tokenizer):
    """Contractions, runs of spaces and long pre-tokens at every place of a cut, with and without common starts."""
    rng, parts = random.Random(5), ["'ll", "'re", "'", " ", "  ", "\n", "a", "é", "1", "22", "!", "?!", "語", " word", "x" * 30, " " * 40]
    text = {k: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 160))) for k in range(300)}
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    for chunks in (bpe.Chunks(64, 16), bpe.Chunks(48, 24), bpe.Chunks(20, 5)):
        rows = bpe.encode(docs, tokenizer, chunks).collect()
        assert len(rows) == len(text)
        _encoded_right(rows, text, bpe.encoding(tokenizer))


def test_bpe_long_text_with_pretokens_beyond_the_overlap(spark, tokenizer):
    """A long text in which some borders have no common start, is still cut into many pieces."""
    around = (PROSE + ". ") * 3_000
    text = {1: around + "z" * 5_000 + around + " " * 70_000 + around + "=" * 40_000 + " end", 2: around * 2, 3: " " * 200_000}
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    _encoded_right(bpe.encode(docs, tokenizer).collect(), text, bpe.encoding(tokenizer))
    cut = bpe.pieces(docs.select(F.col("doc_id").alias("_row"), F.col("text").alias("_text")), tokenizer, bpe.Chunks())
    sizes = {r["_row"]: (r["n"], r["most"]) for r in cut.groupBy("_row").agg(F.count("*").alias("n"), F.max(F.length("_piece")).alias("most")).collect()}
    assert sizes[1][0] > 20 and sizes[1][1] < 150_000 and sizes[2][0] > 10 and sizes[3] == (1, 200_000)


@pytest.mark.parametrize("block_ids", [3, 7, 1 << 20])
def test_token_counts_across_blocks(docs, tokenizer, block_ids):
    code, text = bpe.encoding(tokenizer), dict(TEXTS)
    blocks = common.written(token_counts.flat_blocks(docs.filter("doc_id is null or doc_id < 11").coalesce(2), tokenizer, 50_256, block_ids), "test-tokens")
    rows = token_counts.named(token_counts.scan(blocks, 50_256), blocks).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in rows) == sorted(
        (k or -1, len(code.encode_ordinary(text[k] or ""))) for k in [k for k, _ in TEXTS if k is None or k < 11] + [1]
    )
    ends = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["file"], r["doc_index"])):
        assert r["first_token"] == ends[r["file"]]
        ends[r["file"]] += r["n_tokens"] + 1


def test_flat_files_from_elsewhere(spark, tmp_path):
    import numpy as np

    np.array([5, 6, 0, 0, 7, 8, 9], dtype="<u2").tofile(tmp_path / "a.bin")
    np.array([0], dtype="<u2").tofile(tmp_path / "b.bin")
    (tmp_path / "c.bin").write_bytes(b"")
    got = token_counts.scan(token_counts.read_flat(spark, str(tmp_path), block_bytes=4), 0).collect()
    assert sorted((r["file"][-5], r["doc_index"], r["first_token"], r["n_tokens"], r["ended"]) for r in got) == [
        ("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 3, False), ("b", 0, 0, 0, True),
    ]


@pytest.fixture(scope="module")
def marked(spark):
    import random

    rnd, rows, labels = random.Random(5), [], []
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(400)]
    for k in range(600):
        text = rnd.choices(words, k=rnd.randint(20, 60))
        toxic, bad = k % 5 == 0, k % 4 == 0
        if toxic:
            text[rnd.randrange(len(text))] = rnd.choice(("Nastyword,", "vileterm"))
        rows.append((k, " ".join(w.upper() + "!!$$" if bad else w for w in text)))
        labels.append((k, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def _f1(rows, truth, predicted):
    both = sum(truth(r) and predicted(r) for r in rows)
    return 2 * both / (sum(map(truth, rows)) + sum(map(predicted, rows)))


def test_toxicity_on_held_out_rows(marked):
    docs, labels = marked
    weights, settings = toxicity.fit(docs, labels, common.fold("doc_id", 3) != 1)
    rows = [r for r in toxicity.score(docs, weights, settings).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert _f1(rows, lambda r: r["doc_id"] % 5 == 0, lambda r: r["score"] >= 0.7) > 0.9


def test_compression_on_held_out_rows(marked):
    docs, labels = marked
    model = compression.fit(docs, labels, common.fold("doc_id", 5) != 0)
    rows = [r for r in compression.score(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert _f1(rows, lambda r: r["doc_id"] % 4 == 0, lambda r: r["score"] < 0.3) > 0.9


def test_compression_hears_of_the_ends_of_texts(spark):
    import random

    rnd = random.Random(6)
    start, good, bad = (["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 7))) for _ in range(60)] for letters in ("abcdefgh", "ijklmnop", "qrstuvwx"))
    rows = [(k, " ".join(rnd.choices(start, k=210) + rnd.choices(bad if k % 2 else good, k=120))) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(len(" ".join(t.split()[:210])) > 1024 for _, t in rows)
    labels = spark.createDataFrame([(k, 1 - k % 2) for k, _ in rows], "doc_id long, quality int")
    model = compression.fit(docs, labels, common.fold("doc_id", 5) != 0, compression.Settings(dictionary=1 << 11))
    held = [r for r in compression.score(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert _f1(held, lambda r: r["doc_id"] % 2, lambda r: r["score"] < 0.5) > 0.9


def test_scores_of_odd_texts(docs, marked):
    weights, settings = toxicity.fit(*marked, F.lit(True))
    rows = toxicity.score(docs, weights, settings).collect() + compression.score(docs, compression.fit(*marked, F.lit(True))).collect()
    assert len(rows) == 2 * (len(TEXTS) + 1) and all(0 <= r["score"] <= 1 for r in rows)


def test_counting_holds_little_beside_the_texts():
    """Executors pay for each task's working set: 4-grams are made and counted without copies of copies, and so are n-grams."""
    texts = [("%d " % (i * 7919)) * 200 for i in range(1_000)]
    block = next(words.blocks(pa.array(texts), 1 << 23))
    codes = np.arange(len(texts), dtype=np.uint64)
    tracemalloc.start()
    keys, size = perplexity.keys_of(block, codes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size.sum() == len(keys) and peak < 19 * len(keys)
    wanted = np.unique(keys, return_counts=True)
    assert all((a == b).all() for a, b in zip(words.tallied(keys), wanted, strict=True))


def test_packed_runs_hold_every_hash():
    ranges, shift = 64, jaccard.KEPT_BITS - 6
    held = np.random.default_rng(1).integers(0, 1 << jaccard.KEPT_BITS, 200_000, dtype=np.uint64)
    held[::3] = held[0]
    wanted = np.unique(held, return_counts=True)
    tracemalloc.start()
    run = jaccard.packed_run(held, ranges, shift)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * held.nbytes
    found = [np.cumsum(jaccard._unpack(x, np.uint64), dtype=np.uint64) for x in run["grams"].to_pylist()]
    assert (np.concatenate(found) == wanted[0]).all()
    assert (np.concatenate([jaccard._unpack(x, np.uint32) for x in run["counts"].to_pylist()]) == wanted[1]).all()
    assert all((x >> np.uint64(shift) == r).all() for r, x in zip(run["range"].to_pylist(), found, strict=True))


def test_frequent_entries_are_predicted_once_for_all_tasks(spark):
    docs = spark.createDataFrame([(i, f"{PROSE} {i} w{i % 7}") for i in range(60)], "doc_id long, text string")
    found = {}
    for shared in (0, 40, 1 << 21):
        trained = context_mixing.fit(docs, context_mixing.Settings(shared=shared))
        keys, costs = trained.frequent
        assert len(keys) == len(set(keys)) <= shared
        assert len(keys) == len(costs) > (-1 if not shared else 20)
        found[shared] = {r.doc_id: r.score for r in context_mixing.score(docs, trained, context_mixing.Settings(shared=shared)).collect()}
    assert found[0] == pytest.approx(found[40], rel=1e-9) and found[0] == pytest.approx(found[1 << 21], rel=1e-9)

    class Asked:
        def log10(self, data, offsets, before):
            return np.full(len(before), -float(len(data)))

    known = np.arange(1, 6, dtype=np.uint64) << np.uint64(58)
    memory = context_mixing.Costs(Asked(), 10, words.Lookup(known), np.arange(5.0))
    keys = np.append(known[[3, 1]], np.uint64(7))
    data, offsets, before = np.frombuffer(b"abcde", dtype=np.uint8), np.array([0, 1, 3, 5]), np.zeros(3, dtype=np.uint8)
    assert list(memory(keys, data, offsets, before)) == [3, 1, -2] == list(memory(keys, data, offsets, before))
    assert list(memory.keys) == [7]


def test_packed_runs_leave_in_small_batches():
    held = np.random.default_rng(2).integers(0, 1 << jaccard.KEPT_BITS, 3 * jaccard.SENT, dtype=np.uint64)
    wanted = np.sort(held)
    runs = list(jaccard.packed_runs(held, 64, jaccard.KEPT_BITS - 6))
    assert max(x.nbytes for x in runs) < 8 * 1.2 * jaccard.SENT and len(runs) > 2
    found = [np.cumsum(jaccard._unpack(x, np.uint64), dtype=np.uint64) for run in runs for x in run["grams"].to_pylist()]
    assert (np.concatenate(found) == np.unique(wanted)).all()
    assert list(jaccard.packed_runs(held[:1], 64, jaccard.KEPT_BITS - 6))[0].num_rows == 1


def test_counts_of_blocks_are_added_up_before_they_leave():
    """A task works on small blocks, and yet sends each 4-gram about once."""
    texts = [("%d and so on " % (i * 7919)) * 20 for i in range(9_000)]
    codes, parts = np.zeros(len(texts), dtype=np.uint64), []
    for block in words.blocks(pa.array(texts)):
        parts.append(words.tallied(perplexity.keys_of(block, codes)[0]))
    assert len(parts) > 1
    sent = list(perplexity.merged(parts))
    wanted = words.tallied(np.concatenate([perplexity.keys_of(b, codes)[0] for b in words.blocks(pa.array(texts), 1 << 30)]))
    assert (np.concatenate([x["key"].to_numpy() for x in sent]) == wanted[0].astype(np.int64)).all()
    assert (np.concatenate([x["n"].to_numpy() for x in sent]) == wanted[1]).all()
    assert list(perplexity.merged([])) == []


def test_only_entries_without_shared_costs_are_put_in_order(monkeypatch):
    block = next(words.blocks(pa.array(["one two one three", "two  four", None, "five"])))
    data, starts, ends, before, h, entry, n = context_mixing.listed(block)
    assert n.tolist() == [5, 3, 1, 2]
    names = [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    wanted = b"one two one three END two four END END five END".split()
    assert [names[i] for i in entry] == [b"\n" if x == b"END" else x for x in wanted]
    packed, offsets, *_, again, _ = context_mixing.entries(block)
    assert [bytes(packed[offsets[i] : offsets[i + 1]]) for i in again] == [names[i] for i in entry]

    class Length:
        def log10(self, data, offsets, before):
            return -np.diff(offsets).astype(float)

    keys = context_mixing.named(h, before)
    shared = np.sort(keys)[::2]
    sorted_ = []
    monkeypatch.setattr(context_mixing, "in_order", lambda data, starts, ends, before, f=context_mixing.in_order: sorted_.append(len(starts)) or f(data, starts, ends, before))
    costs = context_mixing.Costs(Length(), 10, words.Lookup(shared), np.full(len(shared), 7.0))
    got = costs.of(keys, data, starts, ends, before)
    assert got.tolist() == [7.0 if k in set(shared.tolist()) else float(a - b) for k, a, b in zip(keys.tolist(), starts, ends, strict=True)]
    assert sorted_ == [len(keys) - len(shared)]


def test_bit_counts_travel_packed(spark):
    """A task sends a few parts, not a row for each slot; the sums are those of all entries."""
    docs = spark.createDataFrame([(i, f"word{i % 7} and word{i % 5} again") for i in range(200)], "doc_id long, text string")
    s = context_mixing.Settings(bits=(10, 11, 12, 13, 19))
    counted = context_mixing.count(docs, s)
    model = context_mixing.fit(docs, s).model
    rows = context_mixing.bit_counts(counted, spark.sparkContext.broadcast((model.code, model.begun)), s).collect()
    one = pa.Table.from_batches(counted.toArrow().to_batches()).combine_chunks().to_batches()[0]
    edges = context_mixing.first_slots(s.bits)
    wanted, found = np.zeros(2 * edges[-1]), context_mixing.bits_of(*context_mixing._columns(one), model.code, s.bits, model.begun)
    weight = found.spread(one.column("n").to_numpy().astype(float))
    for k, slot in enumerate(found.slots):
        np.add.at(wanted, 2 * (slot + edges[k]) + found.bit, weight if k < context_mixing.PREDICTORS - 1 else weight * found.begun)
    got = np.zeros(len(wanted))
    for r in rows:
        sums = words.unpacked(bytes(r["counts"]), np.float32)
        got[r["part"] * context_mixing.PART :][: len(sums)] = sums
    assert len(rows) <= -(-len(wanted) // context_mixing.PART) and (got == wanted).all()


def test_word_so_far_is_known_of_every_word(spark):
    """Words that no four bytes tell, more than there were frequent ones once: the rarest, too, are known once they are told from the others."""
    rnd = random.Random(6)
    vocabulary = sorted({"".join(rnd.choice("ab") for _ in range(24)) for _ in range(69_000)})
    rnd.shuffle(vocabulary)
    rare = vocabulary[:2_000]
    tokens = vocabulary[2_000:] * 3 + rare * 2
    rnd.shuffle(tokens)
    docs = spark.createDataFrame([(k, " ".join(tokens[k * 1_000 : (k + 1) * 1_000])) for k in range(len(tokens) // 1_000 + 1)], "doc_id long, text string")
    trained = context_mixing.fit(docs)
    keys, costs = trained.frequent
    h = words.hashes(np.frombuffer("".join(rare).encode(), dtype=np.uint8), np.arange(len(rare)) * 24, np.arange(1, len(rare) + 1) * 24)
    place = np.concatenate([words.Lookup(keys)(context_mixing.named(h, np.full(len(h), ord(x), dtype=np.uint8))) for x in "ab"])
    assert (place >= 0).sum() > len(rare)
    assert costs[place[place >= 0]].mean() > -6.2 > -24 * math.log10(2) + 0.8
    new = sorted({"".join(rnd.choice("ab") for _ in range(24)) for _ in range(200)} - set(vocabulary))
    found = context_mixing.score(spark.createDataFrame([(k, x) for k, x in enumerate(new)], "doc_id long, text string"), trained).collect()
    assert sum(r["n_known"] for r in found) == len(new) and sum(r["score"] for r in found) / len(new) < -7


def test_bits_behind_the_word_so_far_are_counted():
    given = [(b"there", 3), (b"then", 2), (b"the", 7), (b"thaw", 1), (b"other", 4), (b"\n", 9), (b"there", 5)]
    code = context_mixing.Code(np.bincount(np.frombuffer(b"".join(w * n for w, n in given), dtype=np.uint8), minlength=256))
    data, offsets = np.frombuffer(b"".join(w for w, _ in given), dtype=np.uint8), np.cumsum([0, *(len(w) for w, _ in given)])
    before, n = np.array([10, 32, 101, 101, 101, 101, 101], dtype=np.uint8), np.array([n for _, n in given])
    wanted, paths = defaultdict(lambda: [0, 0]), []
    for word, k in given:
        whole = word if word == b"\n" else word + b" "
        path = [(whole[:i], code.nodes[j], code.bits[j]) for i, x in enumerate(whole) for j in range(code.first[x], code.first[x] + code.length[x])]
        paths.append([x[:2] for x in path])
        for prefix, node, bit in path:
            wanted[prefix, node][bit] += k
    found = context_mixing.bits_of(data, offsets, before, code, context_mixing.Settings().bits, words.Lookup(np.zeros(0, dtype=np.uint64)))
    assert len(found.inner.bits) == len(found.bit) and not found.begun.any()
    for bit in (0, 1):
        assert found.sums(found.behind(n)[found.inner.at, bit]).tolist() == [sum(wanted[x][bit] for x in path) for path in paths]


def test_chunks_tell_what_one_table_would(spark, monkeypatch):
    """Words that begin alike lie in several chunks, and new ones between them; all are predicted as if one chunk held everything."""
    monkeypatch.setattr(context_mixing, "CHUNK", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        rnd = random.Random(7)
        vocabulary = ["".join(rnd.choice(("the", "re", "in", "ö", "x")) for _ in range(rnd.randint(1, 6))) for _ in range(600)] + ["the" * 40, "the" * 41]
        docs = spark.createDataFrame([(k, " ".join(rnd.choices(vocabulary, k=80))) for k in range(40)], "doc_id long, text string")
        trained = context_mixing.fit(docs, context_mixing.Settings(shared=0))
        assert len(trained.borders.numbers) > 10 and len(trained.model.begun.keys) > 10
        rows = [pa.ipc.open_stream(bytes(r["entries"])).read_next_batch() for r in trained.chunks.collect()]
        assert max(x.num_rows for x in rows) <= 80
        assert sum(len(set(x["word"].to_pylist())) for x in rows) == trained.v == len(set().union(*(x["word"].to_pylist() for x in rows)))
        learned = pa.Table.from_batches(rows).combine_chunks()
        new = sorted({"".join(rnd.choice(("the", "re", "in", "ö", "y")) for _ in range(rnd.randint(1, 7))).encode() for _ in range(500)} - set(learned["word"].to_pylist()))
        new += [w + b"!" for w in learned["word"].to_pylist()[:50]] + [w[:-1] + bytes([w[-1] + 1]) for r in rows for w in (min(r.column("word").to_pylist()), max(r.column("word").to_pylist()))]
        new = sorted(set(new) - set(learned["word"].to_pylist()))
        met = [(w, before, 0) for w in new for before in (10, 101)] + [(w, 200, 0) for w in sorted(set(learned["word"].to_pylist()))[::3]]
        every = [*zip(learned["word"].to_pylist(), learned["before"].to_pylist(), learned["n"].to_pylist(), strict=True), *met]
        data, offsets = np.frombuffer(b"".join(w for w, *_ in every), dtype=np.uint8), np.cumsum([0, *(len(w) for w, *_ in every)])
        before, n = (np.array([x[k] for x in every]) for k in (1, 2))
        # the slots' counts move into the one chunk
        alone = context_mixing.Model(**{**vars(trained.model), "begun": words.Lookup(np.zeros(0, dtype=np.uint64))})
        wanted = alone.log10(data, offsets, before.astype(np.uint8), n)
        keys = context_mixing.named(words.hashes(data, offsets[:-1], offsets[1:]), before.astype(np.uint8)).view(np.int64)
        count = Counter()
        for w, _, k in every:
            count[w] += k
        got = {r["key"]: (r["cost"], r["c"]) for r in trained.costs.collect()}
        unmet = spark.createDataFrame([(int(k), b, w) for k, (w, b, _) in zip(keys[-len(met) :], met, strict=True)], "key long, before int, word binary")
        got |= {r["key"]: (r["cost"], r["c"]) for r in context_mixing.unmet_costs(unmet, trained).collect()}
        assert len(got) == len(every) == len(set(keys.tolist()))
        for key, cost, (word, *_) in zip(keys.tolist(), wanted, every, strict=True):
            assert got[key] == (pytest.approx(cost, rel=1e-9), count[word]), word
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
