"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from seatplan.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
LAST = 1 << 62


def plain(docs, items, k):
    counted = [(key, Counter(TERM.findall((t or "").translate(LOWER)))) for key, t in docs]
    counted = [(key, c, sum(c.values())) for key, c in counted if c]
    n, length = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for key, c, own in counted:
            m = 50 + (50 * own * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, LAST if key is None else key))
        out += [(item, r, None if key == LAST else key, -s) for r, (s, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, settings, parts=3):
    d = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, item_id int, rank string").repartition(parts)
    i = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, score int")
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.rank(d, i, settings).collect()), key=str)


def words_of(rng, n):
    return " ".join(rng.choice(["Alpha", "beta", "gamma-delta", "x1", "ÉTÉ", "été", "zug", "0", "日本"]) + (str(min(int(rng.expovariate(0.08)), 60)) if rng.random() < 0.7 else "") for _ in range(n))


@pytest.mark.parametrize("seed", range(3))
def test_equals_scoring_all(spark, seed):
    rng = random.Random(seed)
    docs = [(k, words_of(rng, rng.choice([0, 1, 5, 40, 200]))) for k in range(300)]
    docs += [(1000 + k, docs[3][1] + " alpha7 beta9") for k in range(150)]  # a hot text: ties beyond k
    docs += [(5, docs[4][1]), (None, docs[3][1] + " alpha7 beta9"), (None, docs[9][1]), (2000, None), (2001, " .,\n"), (2002, "beta9 " * 30_000)]
    items = [(k, words_of(rng, rng.choice([1, 3, 25]))) for k in range(40)]
    items += [(100, docs[3][1]), (101, None), (102, ""), (103, "nowhere"), (7, items[7][1] + " alpha7")]
    items += [(104, items[5][1]), (105, "beta9")]
    expected = plain(docs, items, 20)
    assert ranked(spark, docs, items, lexical.Settings(k=20)) == expected
    # small nodes, matrices and blocks change nothing
    assert ranked(spark, docs, items, lexical.Settings(k=20, block_terms=150, leaf=3, fan=2, cells=400), 5) == expected


def test_bounds_prune(monkeypatch):
    """Documents that cannot reach an item's kth score are not scored."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    docs = [(k, words_of(rng, 60) + (f" rare{k % 7}" * 3)) for k in range(4000)]
    items = [(k, f"rare{k} alpha beta") for k in range(7)]
    vocabulary = sorted({t for _, x in items for t in TERM.findall(x)})
    counted = [Counter(t for t in TERM.findall(x.translate(LOWER))) for _, x in docs]
    place = {t: i for i, t in enumerate(vocabulary)}
    rows = [{"id": k, "n": sum(c.values()), "terms": sorted(place[t] for t in c if t in place), "counts": [c[t] for t in sorted(c) if t in place]} for (k, _), c in zip(docs, counted, strict=True)]
    df = [sum(t in c for c in counted) for t in vocabulary]
    weights = np.array([math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * x + 1))) for x in df])
    terms = [np.array(sorted(place[t] for t in TERM.findall(x))) for _, x in items]
    block = lexical.Items(np.arange(7), np.cumsum([len(t) for t in terms]), np.concatenate(terms), weights)
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
    scored, inner = [], lexical.Best.add
    monkeypatch.setattr(lexical.Best, "add", lambda self, item, score, key: scored.append(len(item)) or inner(self, item, score, key))

    class Frame:
        def mapInArrow(self, run, _schema):
            batches = pa.Table.from_pylist(rows, schema=schema).to_batches(max_chunksize=1000)
            return pa.Table.from_batches(list(run(iter(batches)))).to_pylist()

    out = lexical.search(Frame(), block, len(docs), sum(r["n"] for r in rows), lexical.Settings(k=5))
    assert sum(scored) < 0.25 * len(docs) * len(items)
    expected = [(i, d, s) for i, _, d, s in plain(docs, items, 5)]
    assert sorted((r["item"], r["id"], r["score"]) for r in out) == sorted(expected)


def test_empty(spark):
    settings = lexical.Settings()
    assert ranked(spark, [], [(1, "a")], settings) == [] == ranked(spark, [(1, "a")], [], settings) == ranked(spark, [(1, " ")], [(1, "a")], settings)


def test_sql_agrees(spark, tmp_path):
    rng = random.Random(8)
    docs = [(k, words_of(rng, rng.choice([0, 5, 60]))) for k in range(120)] + [(500, None)]
    items = [(k, words_of(rng, 8)) for k in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        wanted = sorted(db.execute(f"SELECT item_id, rank, doc_id, score FROM ({queries.OP13_SQL})").fetchall(), key=str)
    got = queries.op13_lexical(spark, str(tmp_path)).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == wanted
