"""Template deduction against a brute-force version, and the main part."""

from __future__ import annotations

import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ratelake.llm import html_template as ht


def _host_template(pages: list[str]) -> set[str]:
    """The tokens of valid, nested classes of one host, by whole vectors."""
    lists = [list(ht.tokens(p)) for p in sorted(set(pages))]
    if len(lists) < ht.MIN_PAGES:
        return set()
    counts = [Counter(t) for t in lists]
    by_vector = defaultdict(list)
    for token in set().union(*counts):
        vector = tuple(c[token] for c in counts)
        if sum(map(bool, vector)) >= ht.MIN_SHARE * len(lists):
            by_vector[vector].append(token)
    members = {v: set(t) for v, t in by_vector.items() if len(t) >= ht.MIN_TOKENS}
    out = set()
    for vector, own in members.items():
        orders, places, valid = set(), set(), True
        for page in lists:
            at = [i for i, t in enumerate(page) if t in own]
            if not at:
                continue
            n = len({page[i] for i in at})
            cycles = [tuple(page[i] for i in at[k : k + n]) for k in range(0, len(at), n)]
            valid &= len(set(cycles)) == 1
            orders.add(cycles[0])
            starts = [i for i in at if page[i] == page[at[0]]]
            here = set()
            for i in starts:
                place = []
                for v, other in members.items():
                    before = [t for t in page[:i] if t in other]
                    if other is not own and before and len(before) == len(set(before)):
                        place.append((v, before[-1]))
                here.add(frozenset(place))
            valid &= len(here) == 1
            places |= here
        if valid and len(orders) == 1 and len(places) == 1:
            out |= own
    return out


def _templates(spark, data):
    df = spark.createDataFrame(data, "host long, html string").withColumn("page", F.xxhash64("html"))
    return {r.host: set(r.template) for r in ht.templates(df).collect()}


def _random_pages(rnd, n):
    words = "red green blue stone river cloud".split()
    parts = ["<nav><a>Home</a><a>News</a></nav>", "<div id=x><b>Read</b> also</div>", "<p>Subscribe to us</p>", "<ul><li>One<li>Two</ul>"]
    if rnd.random() < 0.3:
        parts.append("<div><i>Last</i><u>one</u></div>")
    pages = []
    mixed, moved = rnd.random() < 0.2, rnd.random() < 0.3
    for _ in range(n):
        own = list(parts)
        if mixed and rnd.random() < 0.3:
            rnd.shuffle(own)
        body = "".join(f"<p>{' '.join(rnd.choices(words, k=rnd.randint(1, 12)))}</p>" for _ in range(rnd.randint(1, 4)))
        own.insert(rnd.randint(0, 2) if moved else 2, f"<div>{body}</div>")
        pages.append("".join(own))
    return pages


def test_templates_equal_brute_force(spark):
    rnd = random.Random(5)
    hosts = {h: _random_pages(rnd, rnd.randint(5, 40)) for h in range(25)}
    hosts[90] = [f"<div><b>x</b><i>y</i></div><p>{i}</p><div><b>x</b><i>y</i></div>" for i in range(12)]
    hosts[91] = ["<p>copy</p><p>of</p><p>one</p>"] * 40
    want = {h: {ht._code(t) for t in _host_template(p)} for h, p in hosts.items()}
    want = {h: t for h, t in want.items() if t}
    rows = [(h, p) for h, pages in hosts.items() for p in pages]
    assert 10 < len(want) < len(hosts)
    for order in (rows, rows[::-1]):
        assert _templates(spark, order) == want


def test_templates_of_the_table_equal_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    host = F.xxhash64(F.regexp_extract("url", "//([^/:?#]+)", 1))
    rows = [tuple(r) for r in pages.select(host, "html").collect() if r[1] is not None]
    rows += [(1, f"{html}<p>{i}") for i, (_, html) in enumerate(rows[:1] * 9)]
    by = defaultdict(list)
    for h, p in rows:
        by[h].append(p)
    want = {h: {ht._code(t) for t in _host_template(p)} for h, p in by.items()}
    assert _templates(spark, rows) == {h: t for h, t in want.items() if t}


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_a_class_out_of_order_is_no_template(spark, partitions):
    # b comes before i on half of the pages: one vector, no common order
    data = [(1, f"<div>{''.join(('<b>p</b>', '<i>q</i>')[:: 1 if k % 2 else -1])}</div><p>{k}</p>") for k in range(60)]
    df = spark.createDataFrame(data, "host long, html string").repartition(partitions).withColumn("page", F.xxhash64("html"))
    assert ht.templates(df).count() == 0


def test_the_template_alone_finds_notices(spark):
    """Pages without any telling element, class or role."""
    page = "<body><div><p>Read our rules before you write</p></div><div><h2>Ingredients</h2><p>{0}</p><p>{1}</p><p>Thank you for your visit</p></div></body>"
    data = [(i, f"http://plain.example/{i}", page.format(f"flour {i}", f"milk {i * i}")) for i in range(20)]
    out = ht.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"Ingredients\n\nflour {i}\n\nmilk {i * i}" for i in range(20)}


def test_main_part():
    text = lambda html: ht.main_text(html, frozenset())
    assert text("<main><h1>Title</h1><p>Intro</p><article><p>Body</p></article></main>") == "Title\n\nIntro\n\nBody"
    assert text("<body><div>A story of some length</div><article>Teaser</article></body>") == "A story of some length\n\nTeaser"
    assert text("<body><div><a href=a>Many links</a> <a href=b>to other pages</a></div><article>Short story</article></body>") == "Short story"
    assert text("<article><p>E is <math><mi>E</mi><annotation>x</annotation></math> here</p><fieldset>F</fieldset><label>L</label></article>") == "E is E here\n\nF\n\nL"
    assert text("<article><form><fieldset><label>Name</label></fieldset></form>Story</article>") == "Story"
    assert text("<article><header><h1><a href=x>Title</a></h1><p>By us</p></header><p>Body</article>") == "Title\n\nBody"
    assert text("<body><p>Story</p><section class=comments><article>" + "long comment " * 90 + "</article></section></body>") == "Story"
    assert text("<body><p>Short</p><div class=social><article>" + "long story " * 9 + "</article></div></body>") == ("long story " * 9).strip()


def test_deep_nesting_costs_the_same_per_tag():
    start = time.time()
    n = 16000
    assert ht.main_text("<article>" + "<b>x" * n, frozenset()) == "x" * n
    assert ht.main_text("<article>" + "<b>x" * n + "<p>y</p><hr>" * n, frozenset()).count("y") == n
    assert ht.main_text("<div>x" * n, frozenset()).count("x") == n
    assert time.time() - start < 5


def test_clashing_columns_and_long_pages(spark):
    long = "<article><p>" + "many words " * 200_000 + "</p></article>"
    data = [(1, "http://a.example/", long, 5, "h", "t"), (2, None, None, 6, "h", "t")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, page int, host string, template string")
    out = {r.page_id: r.text for r in ht.extract(df.withColumn("text", F.lit("x")).withColumn("class", F.lit(1))).collect()}
    assert out == {1: ("many words " * 200_000).strip(), 2: ""}
