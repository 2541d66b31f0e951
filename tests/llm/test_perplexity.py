"""The Spark-counted model against one written out with dictionaries; rare 4-grams; bands; odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seatplan.llm import perplexity

WHITE = re.compile(rb"[\x20\x09-\x0d]+")


def flat(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return WHITE.sub(b" ", data).lstrip(b" ")


def grams(text):
    data = b"   " + flat(text)
    return [data[i : i + 4] for i in range(len(data) - 3)]


def plain(texts):
    """Perplexities of one language's texts by its own Kneser-Ney model."""
    counts = {4: Counter(g for t in texts for g in grams(t))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    steps, total, free = {}, {}, {}
    for k, c in counts.items():
        n = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        steps[k] = [min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.1), j) if n[j - 1] else 0.5 * j for j in (1, 2, 3)]
        total[k], free[k] = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[k][g[:-1]] += v
            free[k][g[:-1]] += steps[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / 256
        v, context = counts[k][g], g[:-1]
        if context not in total[k]:
            return p(g[1:])
        return (v - (steps[k][min(v, 3) - 1] if v else 0)) / total[k][context] + free[k][context] / total[k][context] * p(g[1:])

    return [-sum(math.log10(p(g)) for g in grams(t)) / len(grams(t)) if flat(t) else None for t in texts], p


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = {"en": ["The", "cat", "ran", "home", "over"], "de": ["Die", "Katze", "lief", "über", "Straße"], None: ["x", "y9", "日本"], "": ["q", "zz"]}
    out = [(k, " ".join(rng.choices(words[lang], k=rng.randint(0, 90))), lang) for k, lang in enumerate(["en", "de", None, ""] * 20)]
    return [*out, (900, None, "en"), (901, "", None), (902, " \n ", "en"), (903, "Solo  text\n\nhere " * 20, "xx"), (3, out[3][1], "")]


@pytest.mark.parametrize("head", [1 << 21, 25])
def test_equals_dictionaries(spark, rows, head):
    """With a small head, most 4-grams come by the join."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = defaultdict(list)
    for r in perplexity.assess(docs, perplexity.Settings(grams=head)).collect():
        got[r["lang"]].append((r["doc_id"], r["log_ppl"]))
    assert set(got) == {"en", "de", None, "", "xx"}
    for lang, found in got.items():
        mine = [(k, t) for k, t, x in rows if x == lang]
        wanted = sorted(zip([k for k, _ in mine], plain([t for _, t in mine])[0], strict=True), key=str)
        for (k, a), (j, b) in zip(sorted(found, key=str), wanted, strict=True):
            assert k == j and (a == b if b is None else math.isclose(a, b, rel_tol=1e-9)), (lang, k)


def test_lookup_of_unseen_grams(spark, rows):
    import numpy as np

    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, (_, p) = perplexity.fit(docs, perplexity.Settings()), plain([t for _, t, x in rows if x == "de"])
    tried = [b"katz", b"zzzz", b" die", b"e\x00ab", b"ief "]
    got = model.log10(np.array([int.from_bytes(g, "big") for g in tried], dtype=np.uint64), "de")
    assert np.allclose(got, [math.log10(p(g)) for g in tried])


def test_many_different_grams_count_all(spark):
    rng = random.Random(1)
    texts = [bytes(rng.randint(33, 126) for _ in range(20_000)).decode() for _ in range(12)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    want = plain(texts)[0]
    got = {r["doc_id"]: r["log_ppl"] for r in perplexity.assess(docs, perplexity.Settings(grams=1000)).collect()}
    assert all(math.isclose(got[k], w, rel_tol=1e-9) for k, w in enumerate(want))


def test_rows_pass_as_they_are(spark, rows):
    names = ["n_words", "log_ppl", "low", "high", "kept", "base_failed", "_same", "_lang", "_m", "_doc", "_row", "_more", "key", "n"]
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(200)]
    good = [(k, " ".join(rng.choices(words, k=100)), "en") for k in range(40)]
    docs = spark.createDataFrame([*good, *[r for r in rows if r[1] is None or len(r[1].split()) < 50]], "doc_id long, text string, lang string")
    docs = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    kept = perplexity.passing(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert {r["doc_id"] for r in found} == set(range(40)) and all(r[c] == f"own {c}" for r in found for c in names)
    assert perplexity.passing(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="kept"):
        perplexity.assess(docs, keep=("doc_id", "kept"))


def test_bands_join_without_moving_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    plan = perplexity.passing(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
