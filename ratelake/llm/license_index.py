"""Licence scans with a positional index of rare words (built-in functions only).

Templates are short licence notices. Every template word that is not a
function word has postings (template, position). Every occurrence of such a
word in a file votes with its corpus IDF for the places (its position minus the
posting's) where a template could start, so postings meet at equal relative
positions; no word of a file is left out. The best place of a template is
scored by the IDF it has matched, and it counts only where all of the
template's mandatory phrases stand at their places. Besides this, the base
phrases are found wherever their words stand consecutively.

IDF is taken over all documents. The vocabulary, postings and phrases are
constants of this module, so their broadcasts have a fixed size.

Nulls: a null text has no words; null ids keep their row. Rows that repeat id
and text get equal results and count once in the IDF. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.sparkkit import id_column, materialize, no_id

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Base phrases and the labels they give.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label, notice, mandatory phrases of the notice.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc0-1.0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("bsd", "licensed under the bsd 3 clause license", ("bsd 3 clause",)),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "v 2 0")),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "hereby granted")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    ("reserved", "copyright all rights reserved", ("all rights reserved",)),
)
#: function words: no postings, but they count inside mandatory phrases
FUNCTION_WORDS = frozenset("a and any any are by for in into is of or person the this to use with".split())


def _runs(phrase: str, text: str) -> int:
    words, part = text.split(), phrase.split()
    return next(i for i in range(len(words)) if words[i : i + len(part)] == part)


def vocabulary() -> list[str]:
    words = {w for p in BASE for w in p.split()}
    words |= {w for _, t, _ in TEMPLATES for w in t.split() if w not in FUNCTION_WORDS}
    return sorted(words | {w for _, _, ps in TEMPLATES for p in ps for w in p.split()})


def _postings(spark: SparkSession) -> DataFrame:
    """template, tpos, word, posted (has a posting), phrase (is mandatory)."""
    rows = []
    for t, (_, text, phrases) in enumerate(TEMPLATES):
        must = {_runs(p, text) + k for p in phrases for k in range(len(p.split()))}
        rows += [(t, i, w, w not in FUNCTION_WORDS, i in must) for i, w in enumerate(text.split()) if w not in FUNCTION_WORDS or i in must]
    return spark.createDataFrame(rows, "template int, tpos int, word string, posted boolean, phrase boolean")


def _words() -> Column:
    """Words of the text, with an empty string last where it ends with separators."""
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    return F.split(F.regexp_replace(lower, "^" + SEPARATOR, ""), SEPARATOR, -1)


def word_hits(docs: DataFrame) -> DataFrame:
    """``id, tkey, pos, word`` of every licence word, once per text and id."""
    words = docs.sparkSession.createDataFrame([(w,) for w in vocabulary()], "word string")
    found = docs.select(id_column().alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tkey"), _words().alias("words"))
    # the outer form adds no second evaluation of the split; no array is empty
    each = found.select("id", "tkey", F.posexplode_outer("words").alias("at", "word"))
    hits = each.join(F.broadcast(words), "word").select("id", "tkey", F.col("at").cast("long").alias("pos"), "word")
    return hits.distinct()


def base_places(hits: DataFrame) -> DataFrame:
    """``id, tkey, label, pos`` of every place of a base phrase."""
    order = Window.partitionBy("id", "tkey").orderBy("pos")
    longest = max(len(p.split()) for p in BASE)
    ahead = hits
    for k in range(1, longest):
        ahead = ahead.withColumn(f"w{k}", F.when(F.lead("pos", k).over(order) == F.col("pos") + k, F.lead("word", k).over(order)))
    cases = []
    for phrase, label in BASE.items():
        test = F.lit(True)
        for k, w in enumerate(phrase.split()):
            test = test & (F.col("word" if k == 0 else f"w{k}") == w)
        cases.append(F.when(test, F.lit(label)))
    return ahead.select("id", "tkey", "pos", F.explode(F.array_compact(F.array(*cases))).alias("label"))


def template_matches(hits: DataFrame, n_docs: int) -> DataFrame:
    """``id, tkey, label, score`` of templates whose mandatory phrases are all
    in place; the score is the matched share of the template's IDF."""
    spark = hits.sparkSession
    postings = _postings(spark)
    df = hits.groupBy("word").agg(F.count_distinct("id", "tkey").alias("df"))
    idf = df.select("word", F.log((F.lit(n_docs) + 1) / (F.col("df") + F.lit(0.5))).alias("idf"))
    weights = postings.where("posted").join(F.broadcast(idf), "word", "left").fillna(0.0, ["idf"])
    total = weights.groupBy("template").agg(F.sum("idf").alias("total"))
    posted = weights.select("template", "tpos", "word", "idf")
    votes = hits.join(F.broadcast(posted), "word")
    places = votes.groupBy("id", "tkey", "template", (F.col("pos") - F.col("tpos")).alias("start")).agg(F.sum("idf").alias("matched"))
    need = postings.where("phrase").groupBy("template").agg(F.count("*").alias("need"))
    phrase = postings.where("phrase").select("template", "tpos", "word")
    wanted = places.join(F.broadcast(phrase), "template").withColumn("pos", F.col("start") + F.col("tpos"))
    held = wanted.join(hits, ["id", "tkey", "pos", "word"]).groupBy("id", "tkey", "template", "start").agg(F.count("*").alias("held"), F.first("matched").alias("matched"))
    names = spark.createDataFrame([(t, label) for t, (label, _, _) in enumerate(TEMPLATES)], "template int, label string")
    sure = held.join(F.broadcast(need), "template").where("held = need").join(F.broadcast(total), "template").join(F.broadcast(names), "template")
    share = F.when(F.col("total") > 0, F.least(F.lit(1.0), F.col("matched") / F.col("total"))).otherwise(1.0)
    return sure.groupBy("id", "tkey", "label").agg(F.max(share).alias("score"))


def scan(docs: DataFrame, name: str = "licences") -> DataFrame:
    """One row per document: counts, base places, labels and best score."""
    hits = materialize(word_hits(docs), f"{name}-hits")
    # n_words next to the row's key; texts are read a second time, not shuffled
    size = F.size("words") - F.when(F.element_at("words", -1) == "", 1).otherwise(0)
    rows = docs.select(id_column().alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tkey"), _words().alias("words"))
    rows = materialize(rows.select("id", "tkey", size.cast("long").alias("n_words")), f"{name}-rows")
    base = base_places(hits).groupBy("id", "tkey").agg(
        F.count("*").alias("n_base"), F.min("pos").alias("first_word"), F.max("pos").alias("last_word"), F.array_sort(F.collect_set("label")).alias("base_labels")
    )
    more = template_matches(hits, rows.count()).groupBy("id", "tkey").agg(F.collect_set("label").alias("more"), F.max("score").alias("score"))
    none = F.array().cast("array<string>")
    out = rows.join(base, ["id", "tkey"], "left").join(more, ["id", "tkey"], "left")
    own, extra = F.coalesce("base_labels", none), F.coalesce("more", none)
    return out.select(
        F.when(F.col("id") != no_id, F.col("id")).alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(own, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, extra)), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
