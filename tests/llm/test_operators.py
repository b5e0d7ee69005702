"""Operators against brute-force versions on small fixtures, and the edge
cases of their docstrings: nulls, empty and long texts, ties, repeated rows,
empty tables, columns with clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ratelake.llm import (
    chosen_path,
    fair_mix,
    html_template,
    kd_shards,
    latent_leaks,
    license_index,
    line_winnow,
    quality_llr,
    suffix_lpf,
    toxic_chain,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, n_words int, shard int, kept string, target int, uid int, tkey int"


def _texts():
    rnd = random.Random(5)
    pool = "the of and alpha été zebra quick brown ab x license mit cc by reserved rights all general public stupid".split()
    say = lambda n: " ".join(rnd.choice(pool) + str(rnd.randint(0, 40)) * rnd.randint(0, 1) for _ in range(n))
    passages = ["\n".join(say(rnd.randint(3, 12)) for _ in range(5)) for _ in range(4)]
    rows = []
    for i in range(160):
        t = say(rnd.randint(0, 90))
        if rnd.random() < 0.5:
            t += "\n" + rnd.choice(passages)[rnd.randint(0, 9) :] + "\n\n" + say(rnd.randint(0, 40))
        rows.append((i, t))
    near = rows[20][1] + " " + say(120)
    rows += [(200, near), (201, near + " tail"), (202, near), (203, near), (204, None), (205, ""), (205, ""), (206, " \n\t\n "), (None, near)]
    rows += [(2, rows[5][1]), (10, rows[10][1]), (207, "word " * 40_000), (208, "All rights reserved all rights reserved!"), (209, "licenſe # MIT License *** |")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(i, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None, 1, 2, 3, "x", 4, 5, 6) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def labels(spark, rows):
    data = [(i, k % 11 != 0, int(k % 4 == 0)) for k, (i, _) in enumerate(rows) if k % 2 == 0]
    return spark.createDataFrame([(i, int(q), x) for i, q, x in data] + [(3, None, None)], "doc_id long, quality int, toxic int")


def _key(r):
    return tuple((v is None, str(v)) for v in r)


def test_suffix_dedup(docs, rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49) if d is not None else ():
            w = b[i : i + 50]
            first[w] = min(d, first.get(w, d))
    want = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49) if d is not None else ():
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix_lpf.drop_repeats(docs).collect()]
    assert sorted(got, key=_key) == sorted(want, key=_key)
    ranges = lambda hot: suffix_lpf.repeated_ranges(docs, hot)
    cover = lambda df: {(r.doc_id, r.tkey, p) for r in df.collect() for p in range(r.lo, r.hi)}
    assert cover(ranges(2)) == cover(ranges(10**9))  # crowded groups, window by window


def _windows(lines):
    for i in range(len(lines)):
        for n in (1, 2, 3):
            w = tuple(lines[i : i + n])
            if len(w) == n and (n == 3 or sum(len(WORD.findall(x)) for x in w) >= 50):
                yield i, w


def _line_dedup(rows):
    runs, first = [], {}
    for d, t in rows:
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        for i, w in _windows(lines) if d is not None else ():
            first[w] = min((d, i), first.get(w, (d, i)))
        runs.append(lines)
    want = []
    for (d, t), lines in zip(rows, runs, strict=True):
        gone = set()
        for i, w in _windows(lines) if d is not None else ():
            if (d, i) > first[w]:
                gone |= set(range(i, i + len(w)))
        left, n = [], -1
        for x in (t or "").split("\n"):
            n += bool(WORD.search(x))
            if not WORD.search(x) or n not in gone:
                left.append(x)
        want.append((d, len(lines), len(gone), sum(g - 1 not in gone for g in gone), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return want


def test_line_dedup(docs, rows):
    got = [tuple(r) for r in line_winnow.drop_repeated_lines(docs).collect()]
    assert sorted(got, key=_key) == sorted(_line_dedup(rows), key=_key)


def test_line_dedup_of_short_runs(spark):
    rnd = random.Random(5)
    lines = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdefghij", (1, 2, 20, 24, 25, 26, 30, 49, 50, 90), strict=True)]
    rows = [(i, "\n".join(rnd.choice([*lines, ""]) for _ in range(rnd.randint(0, 7)))) for i in range(300)]
    rows += [(400, lines[9]), (401, lines[8] + "\r"), (402, lines[8] + "\r"), (403, lines[7]), (404, lines[7]), (405, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in line_winnow.drop_repeated_lines(docs).collect()), key=_key)
    assert got == sorted(_line_dedup(rows), key=_key)
    removed = {r[0]: r[2] for r in got}
    assert [removed[i] for i in range(400, 406)] == [1, 0, 1, 0, 0, 0]


def test_only_selected_lines_are_fingerprints(spark, docs, rows):
    prints = line_winnow.fingerprints(docs).collect()
    n_windows = sum(sum(1 for _ in _windows([x for x in (t or "").split("\n") if WORD.search(x)])) for d, t in rows if d is not None)
    assert len({(r.id, r.tkey, r.place) for r in prints}) <= len(prints) < n_windows
    assert sum(len(r.starts) for r in prints) == n_windows  # every window has selected one line
    for r in prints:
        for i, n in zip(r.starts, r.sizes, strict=True):
            own = [h % 2**64 for h in r.around[i - r.lo : i - r.lo + n]]
            assert own.index(min(own)) == r.place - i and min(own) == r.print % 2**64


def test_jaccard_join(docs, rows):
    def shingles(t):
        w = WORD.findall(t or "")
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None

    sets = [shingles(t) for _, t in rows]
    classes = Counter(s for s in sets if s is not None)
    link = lambda a, b: a != b and len(a & b) * 5 >= 4 * len(a | b)
    near = {a: [b for b in classes if link(a, b)] for a in classes}
    ids = {s: min(i for (i, _), u in zip(rows, sets, strict=True) if u == s and i is not None) for s in classes}
    root = {}
    for s in classes:
        seen, todo = {s}, [s]
        while todo:
            more = [b for b in near[todo.pop()] if b not in seen]
            seen |= set(more)
            todo += more
        root[s] = min(ids[u] for u in seen)
    want = []
    for (i, _), s in zip(rows, sets, strict=True):
        if s is None:
            want.append((i, i, 0, 0, i, 1))
        else:
            want.append((i, root[s], sum(classes[b] for b in near[s]) + classes[s] - 1, len(near[s]), ids[s], classes[s]))
    out = chosen_path.jaccard_join(docs).select("doc_id", "class_id", "n_links", "n_link_texts", "copy_id", "n_copies").collect()
    assert sorted(map(tuple, out), key=_key) == sorted(want, key=_key)


def test_quality_measures_and_verdict(docs, rows, labels):
    want = []
    for d, t in rows:
        t = t or ""
        w = WORD.findall(t)
        c = Counter(zip(w, w[1:], w[2:]))
        again = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want.append((d, len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed))
    out = quality_llr.judged(docs, quality_llr.trusted_sample(labels)).collect()
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out]
    assert sorted(got, key=_key) == sorted(want, key=_key)
    assert all(r.kept == (not r.base_failed and r.llr >= quality_llr.MIN_SCORE) for r in out)
    none = quality_llr.judged(docs, labels.limit(0)).collect()
    assert all(abs(r.llr) < 1e-9 and r.kept != r.base_failed for r in none)


def test_likelihood_ratio_separates_labelled_junk(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    trained, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    out = quality_llr.judged(docs, quality_llr.trusted_sample(trained)).join(held, "doc_id").where("not base_failed").collect()
    assert all(r.kept for r in out if r.quality == 1)
    junk = [r.kept for r in out if r.quality == 0]
    assert sum(junk) <= 0.3 * len(junk)  # under two hundred trusted documents here


def test_mix(spark, docs, rows):
    sized = docs.select("doc_id", "source", fair_mix.n_words().alias("size"))
    mix = fair_mix.queue(sized)
    out = mix.queued.withColumn("taken", mix.queued["size"] * fair_mix.copies(mix)).collect()
    assert sorted(r.size for r in out) == sorted(len(WORD.findall(t or "")) for _, t in rows)
    total = sum(r.size for r in out)
    largest = max(r.size for r in out)
    by = {}
    for r in out:
        e = by.setdefault(r.source, [r.source_size, r.target, 0, 0])
        e[2] += r.size
        e[3] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    assert all(size == own and goal <= 3 * size and abs(taken - goal) <= 2 * largest for size, goal, own, taken in by.values())
    assert total - largest < sum(e[3] for e in by.values()) <= total
    assert fair_mix.mixed(mix).count() == sum(r.taken // r.size for r in out if r.size)
    assert fair_mix.targets([("a", 0), ("b", 0)]) == [("a", 0, 0.0), ("b", 0, 0.0)]
    capped = fair_mix.targets([("a", 10), ("b", 500), ("c", 490), (None, 0)])
    assert [t[2] for t in capped[:1]] == [30.0] and abs(sum(t[2] for t in capped) - 1000) < 1e-9


def test_shards(docs, rows):
    out = kd_shards.kd_shards(docs, n_shards=8).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(8)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    small = kd_shards.kd_shards(docs.where("doc_id < 150"), n_shards=8).groupBy("shard").agg({"size": "sum"}).collect()
    sizes = [r[1] for r in small]
    assert len(sizes) == 8 and max(sizes) < 1.35 * min(sizes)


def test_shards_split_equal_texts(spark):
    copies = spark.range(400).selectExpr("id AS doc_id", "'same text' AS text", "'s' AS source")
    sizes = [r["count"] for r in kd_shards.kd_shards(copies, n_shards=8).groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 8


def test_license_base_places(docs, rows):
    want = []
    for d, t in rows:
        w = ALNUM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        at = [(i, label) for p, label in license_index.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        want.append((d, len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))))
    out = license_index.scan(docs).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out]
    assert sorted(got, key=_key) == sorted(want, key=_key)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in out)


def test_license_templates(spark):
    data = [(1, "Foo. Licensed under CC BY-NC 4.0."), (2, "Released under the MIT License."), (3, "apache of the license"), (4, "x Licensed under the Apache License, Version 2.0")]
    out = {r.doc_id: r.labels for r in license_index.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert out == {1: "cc-by,cc-by-nc-4.0", 2: "mit", 3: "", 4: "apache-2.0"}


def test_license_files_of_many_notices(spark):
    # every notice has its label, however many rarer licence words the file has
    four = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Redistribution and use in source and binary forms, with or without modification, are permitted. Licensed under CC BY NC 4.0. Licensed under the Apache License Version 2.0"
    every = " x ".join(t for _, t, _ in license_index.TEMPLATES)
    data = [(1, four), (2, every)] + [(3 + i, "licensed under the apache license, version 2 0, or cc by nc 4 0") for i in range(20)]
    out = {r.doc_id: r for r in license_index.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert set(out[1].labels.split(",")) >= {"mit", "bsd", "cc-by-nc-4.0", "apache-2.0"}
    assert set(out[2].labels.split(",")) >= {label for label, _, _ in license_index.TEMPLATES}
    assert abs(out[1].score - 1) < 1e-9 and abs(out[2].score - 1) < 1e-9


def test_leaks(spark):
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(900)] + ["the", "of", "and"] * 60
    say = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [say(rnd.randint(15, 60)) for _ in range(30)]
    docs, planted = [], set()
    for d in range(300):
        w = say(rnd.randint(20, 300))
        if d % 5 == 0:
            i = rnd.randrange(30)
            own = list(items[i])
            if d % 2:
                own[rnd.randrange(len(own))] = "changed"
            at = rnd.randint(0, len(w))
            w[at:at] = own
            planted.add((d, i))
        docs.append((d, " ".join(w).capitalize()))
    docs += [(400, None), (401, ""), (None, " ".join(items[0]))]
    bench = [(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (91, "too short")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in latent_leaks.leaks(table, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got <= planted and len(got) >= 0.9 * len(planted)
    assert latent_leaks.leaks(table, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_leaks_of_short_items(spark):
    bench = [(1, "Who wrote Hamlet? William Shakespeare did."), (2, "who WROTE hamlet - william shakespeare did"), (3, "four"), (4, "?!"), (5, None), (6, " ".join(f"w{i}" for i in range(20)))]
    docs = [(10, "Quiz: who wrote Hamlet? William Shakespeare did. Next"), (11, "who wrote hamlet? did william shakespeare"), (12, "one two three four"), (13, None), (14, "who wrote"), (15, "hamlet william shakespeare did")]
    docs += [(16, "x y " + " ".join(f"w{i}" for i in range(20)))] + [(100 + i, f"other words {i}") for i in range(40)] + [(None, "four")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    out = latent_leaks.leaks(table, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in out) == [(10, 1), (10, 2), (12, 3), (16, 6)]
    only = latent_leaks.leaks(table, spark.createDataFrame(bench[:5], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.lcs_share) for r in only) == [(10, 1, 1.0), (10, 2, 1.0), (12, 3, 1.0)]


def test_toxic_chain_on_held_out_rows(spark):
    rnd = random.Random(4)
    calm, rude = [f"w{i}" for i in range(400)], ["moron", "scum", "trash", "clown"]
    data = []
    for i in range(1200):
        w = [rnd.choice(calm) for _ in range(60)]
        if i % 6 == 0:
            w[:3] = rnd.sample(rude, 3)
        data.append((i, " ".join(w), int(i % 6 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in data if i % 2 == 0 or i % 3 == 0], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxic_chain.classify(docs, labels).collect()}
    held = [(i, x) for i, _, x in data if i % 2 and i % 3]
    assert sum(out[i].toxic == bool(x) for i, x in held) >= 0.98 * len(held)
    assert all(out[i].toxic for i, _, x in data if x) and None in out
    assert not any(r.toxic for r in toxic_chain.classify(docs, labels.limit(0)).collect())


def test_toxic_words_beyond_chance_all_count(monkeypatch):
    rnd = np.random.default_rng(3)
    y = (np.arange(1200) % 3 == 0).astype(float)
    pairs = [(r, 1000 + w) for r in range(1200) for w in rnd.choice(400, 60, replace=False)]
    pairs += [(r, 5000 + w) for r in np.flatnonzero(y) for w in rnd.choice(400, 40, replace=False)]
    row, word = np.array(sorted(set(pairs))).T
    words = toxic_chain._choose(word, row, y)
    assert set(range(5000, 5400)) <= set(words.tolist())
    # both forms of the Newton steps find the same model
    earlier = rnd.normal(size=(1200, 1))
    whole = toxic_chain._fit(word, row, y, earlier)
    monkeypatch.setattr(toxic_chain, "DENSE", 0)
    sparse = toxic_chain._fit(word, row, y, earlier)
    assert (whole.words == sparse.words).all() and np.allclose(whole.weights, sparse.weights, atol=1e-6) and np.allclose(whole.rest, sparse.rest, atol=1e-6)


def test_html(spark):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var a="</p>";</script></head><body>'
        "<header>Site</header><nav><ul><li><a href=/a>Menu</a></ul></nav><!-- c --><div class=ad>Buy</div><aside>Side</aside>"
        '<article><h1>A &amp; %s</h1><p><b>One\n two<br>%s <p>Subscribe now</p><p>Body %s &eacute;</p><div class="reader-comments">Nice</div>'
        "<form><input>Send</form></article><footer>&copy; x</footer></body></html>"
    )
    data = [(i, "http://h.example/p", page % (i, i, i)) for i in range(12)] + [(50, "http://h.example/p", None), (51, None, "just &lt;text&gt;"), (51, None, "")]
    out = html_template.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    got = sorted((r.page_id, r.text) for r in out)
    # a paragraph that stands on nearly all pages of the host belongs to the template
    assert got[:12] == [(i, f"A & {i}\n\nOne two {i}\n\nBody {i} é") for i in range(12)]
    assert [t for i, t in got if i >= 50] == ["", "", "just <text>"]
    assert all(r.n_chars == len(r.text) for r in out)


def test_html_copies_are_no_template(spark):
    page = "<html><body><nav>Menu</nav><article><h1>Title of %s</h1><p>First words of %s<p>More words of %s</article><div>Page %s of all</div></body></html>"
    one = page % ("one", "one", "one", 1)
    whole = lambda x: f"Title of {x}\n\nFirst words of {x}\n\nMore words of {x}"
    data = [(i, f"http://copies.example/{i}", one) for i in range(20)] + [(20 + i, None, one) for i in range(10)]
    # copies beside other pages, and copies that differ outside the article
    data += [(40 + i, f"http://mixed.example/{i}", one) for i in range(20)] + [(60 + i, f"http://mixed.example/o{i}", page % (i, i, i, i)) for i in range(3)]
    data += [(80 + i, f"http://near.example/{i}", page % ("one", "one", "one", i)) for i in range(12)]
    # the same without an article
    data += [(100 + i, f"http://plain.example/{i}", f"<body><p id=p{i}>Only this text<p>and no other</body>") for i in range(12)]
    out = {r.page_id: r.text for r in html_template.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert all(out[i] == whole("one") for i in [*range(30), *range(40, 60)])
    assert all(out[60 + i] == whole(i) for i in range(3))
    assert all(out[80 + i].startswith(whole("one")) for i in range(12))
    assert all(out[100 + i] == "Only this text\n\nand no other" for i in range(12))


def test_html_marks_do_not_exclude_the_article():
    text = lambda html: html_template.main_text(html, frozenset())
    inner = '<article><h1>Title</h1><div class="article-sidebar">Side</div><p>Words</p><div id="comments">Nice</div></article>'
    for page in (
        '<html class="no-sidebar"><body class="has-sidebar">%s</body></html>',
        '<body class="single comments-open">%s</body>',
        '<body id="search">%s</body>',
        '<body><div id="page" class="with-header">%s</div></body>',
        '<body><div class="social">%s</div></body>',
        '<body><div class="menu-open"><main class="search">%s</main></div></body>',
        '<body><div class="sidebar"><article>Teaser</article></div><main>%s</main><section class="comments"><article class="comment">I</article></section></body>',
    ):
        want = "Teaser\n\nTitle\n\nWords" if "<article>Teaser" in page and "<main>" not in page else "Title\n\nWords"
        assert text(page % inner) == want, page
    assert text('<body class="blog"><article class="post social-news">News<p>More</article></body>') == "News\n\nMore"
    assert text('<body><div class="sidebar"><article>Teaser</article></div><p>Real text</body>') == "Real text"
    assert text('<body><div class="side-effects">Effects</div><p class="alert-story">Story</body>') == "Effects\n\nStory"
    marked = ["ad", "Sidebar", "left-sidebar", "sidebar-left", "mainNav", "footer-links", "ad-slot-300x250", "share-buttons", "cookie_banner", "x comments"]
    assert [text(f'<body><div class="{c}">Out</div><p>In</body>') for c in marked] == ["In"] * len(marked)
    assert text('<body><article role="dialog">Out</article><article hidden class="a">Out</article><p>In</body>') == "In"


def test_empty_tables(spark, docs, labels):
    none = docs.limit(0)
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    for out in (
        suffix_lpf.drop_repeats(none),
        line_winnow.drop_repeated_lines(none),
        quality_llr.judged(none, quality_llr.trusted_sample(labels)),
        kd_shards.kd_shards(none, n_shards=8),
        license_index.scan(none),
        latent_leaks.leaks(none, bench),
        toxic_chain.classify(none, labels),
        html_template.extract(spark.createDataFrame([], "page_id long, url string, html string")),
        fair_mix.queue(none.select("doc_id", "source", fair_mix.n_words().alias("size"))).queued,
        chosen_path.jaccard_join(none),
    ):
        assert out.count() == 0


def test_pipeline_stages(spark, docs, rows, tmp_shared):
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows[::2] if i is not None], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_shared}/labels.parquet")
    spark.createDataFrame([(1, rows[30][1] or "x")], "item_id long, text string").write.parquet(f"{tmp_shared}/benchmark.parquet")
    docs.write.parquet(f"{tmp_shared}/documents.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, held, tmp_shared)
        assert out.columns == docs.columns, name
        before = {(r.doc_id, r.text) for r in held.collect()}
        out.write.parquet(f"{tmp_shared}/{name.replace(' ', '-')}")
        held = spark.read.parquet(f"{tmp_shared}/{name.replace(' ', '-')}")
        after = [(r.doc_id, r.text) for r in held.collect()]
        assert set(after) <= before and after, name
        if stage is corpus_pipeline.near_duplicates:
            assert len(after) == len(set(after)) and [i for i, _ in after if i in (200, 201, 202, 203)] == [200]
    assert corpus_pipeline.run(spark, tmp_shared).count() == len(after)
