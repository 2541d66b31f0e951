"""URL rules, templates and revisits against cases written by hand."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from seatplan.llm import decontaminate, queries, revisits, url_rules


def test_explicit_rules_and_odd_urls(spark):
    urls = [
        (1, "https://Blog.Example.ORG/es/1?x#y", "example.org/es/", "block"),
        (2, "http://example.org/en/17", "example.org/en/1", "block"),
        (3, "http://example.org/fr/", "org/", "allow"),
        (4, "http://example.org", None, "allow"),
        (5, "http://notexample.org/es/", "org/", "allow"),
        (6, "http://a.com/de/x", "com/de/", "block"),
        (7, None, None, "allow"),
        (8, "", None, "allow"),
        (9, "relative/path", None, "allow"),
        (9, "relative/path", None, "allow"),
        (None, "http://a.com/fr/?q", "com/fr/", "allow"),
    ]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u, _, _ in urls], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(queries.URL_RULES, "verdict string, host string, path string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = sorted(((r["page_id"] or 0, r["rule"], r["verdict"]) for r in url_rules.judge(pages, rules, labels).collect()), key=str)
    assert got == sorted(((k or 0, rule, v) for k, _, rule, v in urls), key=str)
    assert url_rules.judge(pages.limit(0), rules, labels).count() == 0


def test_mined_combinations(spark):
    rows = [(k, f"http://h{k % 9}.net/{'casino' if k % 2 else 'news'}/{'win' if k % 3 else 'lose'}") for k in range(240)]
    labels = [(k, int(not (k % 2 and k % 3))) for k in range(0, 240, 2)] + [(k, int(not k % 3)) for k in range(1, 240, 4)]
    rules = spark.createDataFrame(queries.URL_RULES, "verdict string, host string, path string")
    judged = url_rules.judge(
        spark.createDataFrame(rows, "page_id long, url string"), rules, spark.createDataFrame([*labels, (None, 0), (1, None)], "doc_id long, quality int"),
        url_rules.Settings(confidence=0.9),
    )
    for r in judged.collect():
        assert (r["verdict"] == "block") == bool(r["page_id"] % 2 and r["page_id"] % 3), r


def test_a_small_bad_host_among_many_labelled_urls(spark):
    pages = spark.range(20_000).selectExpr("id as page_id", "if(id < 12, concat('http://casino.net/', id), concat('http://h', id % 50, '.net/', id)) as url")
    labels = pages.selectExpr("page_id as doc_id", "if(page_id < 12 or page_id % 100 = 99, 0, 1) as quality")
    judged = url_rules.judge(pages, spark.createDataFrame([], "verdict string, host string, path string"), labels)
    assert sorted(r["page_id"] for r in judged.filter("verdict = 'block'").collect()) == list(range(12))


def test_templates_and_slots(spark):
    items = spark.createDataFrame(
        [
            (9, "So Anna had 5 apples and gave Tom 2 kg of them to Anna in the big park."),
            (8, "nothing to see"), (7, ""), (6, None), (None, "some words that would fit but have no key at all"),
        ],
        "item_id long, text string",
    )
    docs = [
        (1, "It was so. So Anna had 5 apples and gave Tom 2 kg of them to Anna in the big park. The end."),
        (2, "We know that so Carl had 7 apples and gave Sue three miles of them to Carl in the big park."),
        (3, "We know that so Carl had 7 apples and gave Sue three miles of them to Dora in the big park."),
        (4, "there is nothing to see here"), (5, None), (6, ""), (2, "another text under the same key"),
        (7, "An honest text about Anna and 5 apples in a big park of the town."),
        (8, "word " * 30_000),
    ]
    frame = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, item_id int")
    got = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in decontaminate.find(frame, items).collect()}
    assert set(got) == {(1, 9), (2, 9), (4, 8)}
    assert got[1, 9] == 0 and got[2, 9] > 0
    assert sorted(r["doc_id"] for r in decontaminate.clean(frame, items).collect()) == [3, 5, 6, 7, 8]
    assert decontaminate.find(frame.limit(0), items).count() == decontaminate.find(frame, items.limit(0)).count() == 0


def test_numbers_in_words_and_names_at_the_start(spark):
    asked = [
        (1, "A box holds thirteen red balls and the other box by the door holds seventy blue balls. How many more are blue?"),
        (2, "Anna bought 4 pens. Ben bought 9 pens. They put all of the pens into one small box on the table."),
        (3, "En la tienda hay quince manzanas verdes y veinte peras maduras. ¿Cuántas frutas hay en toda la tienda?"),
        (4, "Im Garten stehen fünfundzwanzig alte bäume und zwölf kleine, davon sind neun krank. Wie viele sind noch gesund?"),
        (5, "Dans le panier il y a soixante-dix pommes rouges et treize poires jaunes qui sont toutes bien mûres."),
    ]
    given = [
        (1, "A box holds fourteen red balls and the other box by the door holds twenty-five blue balls. How many more are blue?"),
        (2, "Carl bought 3 pens. Dora bought 8 pens. They put all of the pens into one small box on the table."),
        (3, "En la tienda hay doce manzanas verdes y treinta peras maduras. ¿Cuántas frutas hay en toda la tienda?"),
        (4, "Im Garten stehen achtzig alte bäume und elf kleine, davon sind vier krank. Wie viele sind noch gesund?"),
        (5, "Dans le panier il y a vingt-et-une pommes rouges et onze poires jaunes qui sont toutes bien mûres."),
        (6, "Thirteen red balls lay by the door of the old house. Anna and Ben came by and took seventy of them home for tea."),
        (7, "En la plaza hay veinte perros y quince gatos que duermen al sol durante toda la tarde sin hacer nada más."),
    ]
    schema = "k long, text string"
    docs, items = (spark.createDataFrame(rows, schema).withColumnRenamed("k", k) for rows, k in ((given, "doc_id"), (asked, "item_id")))
    got = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in decontaminate.find(docs, items).collect()}
    assert set(got) == {(k, k) for k in (1, 2, 3, 4, 5)} and all(got.values())
    words = [r[0] for r in spark.createDataFrame(asked, schema).orderBy("k").select(decontaminate.template(F.col("text"))).collect()]
    assert words[1][:4] == ["<name>", "bought", "<num>", "pens"] and words[3][3] == "<num>" and words[4][6] == "<num>"


def test_repeated_windows_and_several_variants(spark):
    items = spark.createDataFrame(
        [
            (1, "Adam has 5 red apples in his big basket. Bela has 7 red apples in his big basket."),
            (2, "On a cold day the old farmer sold 12 brown eggs and then gave 3 of them to the poor baker in town."),
            (3, "Sort 12 7 5 99 3 18 into 2 rows 4 8"),
            (4, "What is 5 plus 7?"), (5, "42"),
        ],
        "item_id long, text string",
    )
    asked = "On a cold day the old farmer sold {} brown eggs and then gave {} of them to the poor baker in town."
    docs = [
        (1, "We read: Adam has 5 red apples in his big basket. Bela has 7 red apples in his big basket. So it was."),
        (2, asked.format(12, 3) + " Then we heard this. " + asked.format(40, 9)),
        (3, asked.format(20, 4) + " And once again. " + asked.format(31, 6) + " And the last. " + asked.format(50, 8)),
        (4, "Please sort 12 7 5 99 3 18 into 2 rows 4 8 now"),
        (5, "Please sort 13 7 5 99 3 18 into 2 rows 4 9 now"),
        (6, "They asked: what is 5 plus 7?"), (7, "They asked: what is 42 plus 7?"),
    ]
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 2), (3, 2), (4, 3), (6, 4)}
    assert all(r["n_changed"] == 0 for r in found if r["doc_id"] in (1, 2, 4, 6))
    assert [r["n_changed"] for r in found if r["doc_id"] == 3] == [2]


def test_revisits(spark):
    t0 = datetime(2024, 1, 1)
    at = lambda minutes: t0 + timedelta(minutes=minutes)
    rows = [
        (1, "http://www.a.org/x/?b=2&a=1&utm_source=z#f", at(0), "response", {"etag": '"1"', "server": "s", "content-length": "9"}, "d1"),
        (2, "https://a.org/x?a=1&b=2", at(500), "revisit", {"etag": 'W/"1"', "date": "now", "content-length": "0", "connection": "x"}, "d1"),
        (3, "http://a.org/x?a=1&b=2", at(600), "response", {"etag": '"2"', "last-modified": "m"}, "d2"),
        (4, "http://a.org/x?a=1&b=2", at(600), "revisit", {"etag": '"1"'}, "d1"),
        (5, "http://a.org/x?a=1&b=2", at(9000), "revisit", {"last-modified": "m"}, None),
        (6, "http://b.org/", at(5), "revisit", None, "d"),
        (7, "http://b.org/", at(6), "response", None, "d"),
        (8, "http://B.org:80", at(7), "revisit", None, "d"),
        (9, None, at(7), "revisit", {}, None),
        (10, "http://b.org", None, "revisit", {}, None),
    ]
    frame = spark.createDataFrame(rows, "record_id long, url string, at timestamp, kind string, headers map<string,string>, digest string")
    got = {r["record_id"]: (r["source_id"], r["status"], r["headers"]) for r in revisits.resolve(frame).collect()}
    assert got[2] == (1, "resolved", {"etag": 'W/"1"', "server": "s", "content-length": "9", "date": "now"})
    assert got[4][:2] == (3, "mismatch") and got[4][2] is None
    assert got[5][:2] == (3, "resolved")
    assert got[6][:2] == (None, "orphan") and got[8][:2] == (7, "resolved")
    assert got[9][1] == got[10][1] == "orphan"
    again = frame.unionByName(frame.filter("kind = 'revisit'"))
    assert revisits.resolve(again).count() == 14
    assert revisits.resolve(frame.filter(F.lit(False))).count() == 0
