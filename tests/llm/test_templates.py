"""Template deduction held against classes by plain counting, and against pages whose markup tells nothing."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallgrass.llm import html_template
from tallgrass.llm.url_filter import host_of


def keyed(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return table.select(F.xxhash64(host_of(F.col("url"))).alias("host"), F.xxhash64("html").alias("page_key"), "html")


def test_classes_are_those_of_counted_occurrences(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        n = rng.randint(1, 4)
        items = "".join(f"<li><div>{rng.choice(['buy', 'sell'])}</div></li>" for _ in range(n))
        extra = "<section><p>sometimes</p></section>" * (rng.random() < 0.7)
        rows.append((i, f"http://h{i % 3}.org/{i}", f"<body><ul>{items}</ul>{extra}<div><p>fixed</p><p>text {i}</p></div></body>"))
    got = defaultdict(lambda: defaultdict(set))
    pages = keyed(spark, rows + rows[:7])
    hosts = {r.html: r.host for r in pages.collect()}
    for r in html_template.token_classes(pages).collect():
        got[r.host][r["class"]].add(r.token)
    for host in range(3):
        texts = [h for i, _, h in rows if i % 3 == host]
        counts = [Counter(html_template._token(p, t) for p, a, t, _ in html_template.events_of(h) if t is None or not a) for h in texts]
        classes = defaultdict(set)
        for token in set().union(*counts):
            vector = tuple(c[token] for c in counts)
            if sum(v > 0 for v in vector) >= html_template.TEMPLATE_SHARE * len(texts):
                classes[vector].add(token)
        assert len(classes) >= 2
        assert {frozenset(c) for c in classes.values()} == {frozenset(c) for c in got[hosts[texts[0]]].values()}


def test_order_and_nesting_of_classes():
    classes = {1: 10, 2: 10, 3: 20, 4: 20, 5: 30}
    check = html_template.class_orders
    # 20 lies twice in a slot of 10; 30 between its sequences
    assert check([1, 3, 4, 5, 3, 4, 2], classes)[1] == set()
    # 10 and 20 cross: the lesser identifier of two of one size goes
    assert check([1, 3, 2, 4], classes)[1] == {10}
    assert check([1, 3, 5, 4, 2, 6], classes)[1] == set()
    # the larger class stays
    assert check([1, 3, 2, 4, 7], {**classes, 7: 10})[1] == {20}
    # not one sequence repeated
    assert 10 in check([1, 2, 2, 1], classes)[1]
    # orders of two pages differ
    assert check([1, 2], classes)[0] != check([2, 1], classes)[0]
    assert check([], classes) == ({}, set())


#: No element or name of these pages tells what it holds.
BARE = (
    "<html><body><div class=q1><div><a href=/a>Start {0}</a></div><div><a href=/b>Topics {1}</a></div></div><div class=q2><p>All of our offers</p>"
    "<p>{2}</p></div><div class=q3><p>{3}</p><p>{4}</p></div><div class=q4><p>Made with care</p></div></body></html>"
)


def bare(i):
    rng = random.Random(i)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    main = [" ".join(word() for _ in range(40)), " ".join(word() for _ in range(50))]
    return BARE.format(word(), word(), word(), *main), "\n".join(main)


def test_templates_decide_where_markup_tells_nothing(spark):
    made = {i: bare(i) for i in range(12)}
    rows = [(i, f"http://bare.org/{i}", page) for i, (page, _) in made.items()]
    # most rows of the second host are copies of one page: its own text is no template
    rows += [(100 + k, "http://copies.org/", made[0][0]) for k in range(40)] + [(200 + i, f"http://copies.org/{i}", p) for i, (p, _) in made.items()]
    # too few pages
    rows += [(300, "http://few.org/", made[0][0])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_template.extract_main_text(table).collect()}
    assert {i: got[i].text for i in made} == {i: t for i, (_, t) in made.items()}
    assert {i: got[200 + i].text for i in made} == {i: t for i, (_, t) in made.items()}
    assert all(got[100 + k].text == made[0][1] for k in range(40))
    assert all(r.by_template == (i < 300) for i, r in got.items())
    assert "Made with care" in got[300].text

    again = html_template.extract_main_text(table.union(table)).collect()
    assert sorted((r.page_id, r.text) for r in again) == sorted((r.page_id, r.text) for r in got.values() for _ in range(2))


def test_numbers_in_names_and_deep_or_long_pages(spark):
    rows = [(i, "http://n.org/", f"<body><div id=post-{1000 + i}><p>Story {i} of many words</p></div><div id=x>Same</div></body>") for i in range(9)]
    rows.append((50, "http://deep.org/", "<div>" * 20_000 + "deep" + "</div>" * 20_000))
    rows.append((51, "http://long.org/", "<article>" + "<p>word &amp; word" * 200_000))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.extract_main_text(table).collect()}
    assert all(got[i] == f"Story {i} of many words" for i in range(9))
    assert got[50] == "deep" and got[51] == "\n".join(["word & word"] * 200_000)
