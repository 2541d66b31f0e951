"""Exact numbers of links against all pairs, in groups of near copies that pivots join."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seatplan.llm import jaccard


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or (frozenset({tuple(words)}) if words else frozenset())


def plain(rows):
    """Number of links and component of every row, by all pairs of different sets."""
    sets = Counter(shingles(t) for k, t in rows if k is not None)
    sets.pop(frozenset(), None)
    keys = list(sets)
    near = {x: [y for y in keys if y is not x and 100 * len(x & y) >= 80 * len(x | y)] for x in keys}
    links = {x: sets[x] - 1 + sum(sets[y] for y in near[x]) for x in keys}
    least, component = {}, {}
    for k, t in rows:
        if k is not None and (x := shingles(t)):
            least[x] = min(k, least.get(x, k))
    for x in keys:
        if x not in component:
            seen, todo = {x}, [x]
            while todo:
                for y in near[todo.pop()]:
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
            low = min(least[y] for y in seen)
            component |= dict.fromkeys(seen, low)
    return sorted((str(k), len(x := shingles(t)), 0 if k is None or not x else links[x], k if k is None or not x else component[x]) for k, t in rows)


def family(rng, n, words, edits):
    base = [f"w{rng.randint(0, 9999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(own))
            choice = rng.random()
            if choice < 0.5:
                own[at] = f"e{rng.randint(0, 30)}"
            elif choice < 0.75:
                del own[at]
            else:
                own.insert(at, f"e{rng.randint(0, 30)}")
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("stars", [1, 2])
def test_equals_all_pairs(spark, stars):
    rng = random.Random(stars)
    texts = []
    for n, words, edits in ((3, 40, 1), (150, 120, 5), (60, 60, 3), (40, 200, 14), (25, 30, 4), (30, 12, 2)):
        texts += family(rng, n, words, edits)
    half = family(rng, 1, 150, 0)[0].split()
    texts += [" ".join(half[:k]) for k in range(90, 150, 3)]  # a chain whose ends do not link
    texts += [" ".join(half + ["z"] * 0 + [f"y{k % 3}" for _ in range(8)]) for k in range(9)] + texts[:40] + [texts[5]] * 60
    rows = list(enumerate(texts)) + [(None, texts[0]), (90_000, None), (90_001, ""), (90_002, "one two"), (90_003, "ONE  two"), (4, texts[9])]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, n_links int, w int").repartition(5)
    got = jaccard.join(docs, jaccard.Settings(stars=stars, salt_rows=50, block_differences=1 << (18 if stars == 1 else 9)))
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["n_links"], r["component_id"]) for r in got.collect()) == plain(rows)


def test_one_of_each_carries_rows(spark):
    rng = random.Random(5)
    texts = family(rng, 20, 200, 1)
    rows = [(k + 1, t) for k, t in enumerate(texts)] + [(1, "quite another text of the same key but no copy of it"), (1, texts[0]), (None, texts[0]), (50, None), (50, None)]
    names = ["_kept", "_key", "_same", "_doc", "class_id", "n", "row", "component_id"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:11]) for r in kept.collect()) == sorted([("1", texts[0][:11]), ("1", "quite anoth"), ("None", texts[0][:11]), ("50", "")])
    assert jaccard.one_of_each(docs.limit(0)).collect() == []


def test_no_plan_holds_all_steps(spark, capsys):
    """The driver pays for a plan's size, however few its rows: what is returned reads written steps and joins them, no more."""
    rows = [(i, " ".join(str(w if w != i else -i) for w in range(40))) for i in range(60)]
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") < 10 and "MapInArrow" not in plan and "InArrow" not in plan
