"""Ranked lexical search against a plain scorer."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import ROWS, SCHEMA, lower

from tillroll.llm import lexical

ITEMS = [(0, "ba do mi fu ba"), (1, "The END straße"), (2, "日本語 x1 ba ba ba"), (3, "nowhere nothing"), (4, ""), (5, None), (6, "..."),
         (7, "la go und"), (7, "one two"), (8, "ba do"), (8, "ba do"), (None, "one words"), (9, "a c d e " * 20)]
ITEM = "item_id long, text string"


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(text))


def plain(docs, items, places):
    """{item: [(doc_id, score) best first]}"""
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n = sum(k > 0 for _, _, k in bags)
    total = sum(k for _, _, k in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for i, t in {(i, t) for i, t in items if t is not None}:
        asked.setdefault(i, Counter()).update(terms(t))
    out = {}
    for item, words in asked.items():
        scored = []
        for i, bag, k in bags:
            score = 0
            for t, times in words.items():
                if bag[t]:
                    m = 100 - 25 + (25 * k * n) // total
                    score += times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0 and i is not None:
                scored.append((-score, i))
        if scored:
            out[item] = [(i, -s) for s, i in sorted(scored)[:places]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.item_id), r["rank"])):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(r[0], r[1]) for r in ROWS] + [(None, "ba do mi")] + [(900 - k, "ba do mi fu, ba do") for k in range(40)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("places", [1, 3, 20, 100])
def test_equals_a_plain_scorer(spark, docs, places):
    rows, df = docs
    df = df.withColumn("n", F.lit("clash")).withColumn("bag", F.lit(1)).withColumn("item_id", F.lit(2))
    items = spark.createDataFrame(ITEMS, ITEM).withColumn("doc_id", F.lit(1)).withColumn("score", F.lit("x"))
    assert found(lexical.search(df, items, places=places)) == plain(rows, ITEMS, places)


def test_blocks_of_items_and_scores(spark, docs, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 60)
    monkeypatch.setattr(lexical, "SCORES", 40)
    rows, df = docs
    assert found(lexical.search(df, spark.createDataFrame(ITEMS, ITEM))) == plain(rows, ITEMS, 20)


def test_random_ties(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 4)))) for i in range(400)]
    rnd.shuffle(rows)
    items = [(i, " ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 5)))) for i in range(25)]
    got = found(lexical.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(items, ITEM)))
    assert got == plain(rows, items, 20)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEM)
    assert lexical.search(docs[1], none).count() == 0
    assert lexical.search(spark.createDataFrame([], SCHEMA), spark.createDataFrame(ITEMS, ITEM)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " .")], "doc_id long, text string")
    assert lexical.search(blank, spark.createDataFrame(ITEMS, ITEM)).count() == 0


def test_one_row_per_class(spark, docs):
    rows, df = docs
    shared = spark.sparkContext.broadcast(lexical.Items([(i, t) for i, t in ITEMS if t]))
    bags = df.mapInArrow(lexical._bags(shared), lexical._BAG)
    got = lexical.classes(bags, 50, 1000, 20).collect()
    assert max(len(r.members) for r in got) == 20 and len(got) < 30
    assert len({(r.m, bytes(r.bag)) for r in got}) == len(got)
    assert all(r.members == sorted(r.members) for r in got)
    assert [881 - 20 + k for k in range(20)] in [r.members for r in got]  # the smallest of forty copies
    assert np.frombuffer(got[0].bag, "<u4").size % 2 == 0
