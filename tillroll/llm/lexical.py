"""Ranked lexical search that scores each distinct bag of words once.

Documents are cut down to the vocabulary of the query items: a bag is the packed
(term, occurrences) pairs of the item terms in a text. A document's score against any item
depends on its bag and its length class m alone, so documents with equal (bag, m) form
one class: rows are dealt by a hash of both, equal hashes are verified by comparing the
bags themselves, and a class keeps its smallest ids, as many as a ranking has places. No
further member can be ranked, since equal scores go by ascending id. Classes are scored
once, every task keeps the best classes of each item (a class ranks by score, then by its
smallest id), expands their members and the last window merges the tasks' short lists.

Term weights, lengths and scores are 64-bit whole numbers; the number of documents, their
lengths and the document frequencies cover every document.

At scale: a hot class (a third of all documents) sends at most ``places`` rows a task into
the shuffle, as Spark limits window groups before it. Items are taken in blocks of about
``ITEM_BYTES`` of text, dealt by a hash of their id; a block's vocabulary and postings are
what is broadcast, and each block is one pass over the documents whose bags are written
to the shared folder. What the driver sees is a block of items and a frequency for each
of its terms.

Terms are told apart by 64-bit hashes. Defined results: a null or empty text has no terms
and no rank; rows without an id count in all statistics but are not ranked; repeated
rows are documents of their own; the distinct texts of one ``item_id`` are one item whose
terms add up, a null ``item_id`` included; an item without a term that some document holds has
no rows; empty tables give none; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written
from tillroll.llm.kernel import ALNUM_WORDS, text_blocks, words_by_text

ITEM_BYTES = 4 << 20
SCORES = 1 << 21  # scores held at once
_BAG = "doc_id bigint, n bigint, bag binary"
_RANKED = "item_id bigint, doc_id bigint, score bigint"


class Items:
    """The items of a block: vocabulary by hash, and for every term the items that
    hold it with the number of times."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.ids = sorted({i for i, _ in rows}, key=lambda i: (i is None, i))
        place = {i: k for k, i in enumerate(self.ids)}
        batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows], pa.string())], names=["text"])
        hashes, owner = [], []
        for i, j, buf, offsets in text_blocks(batch, "text"):
            words, first = words_by_text(buf, offsets, ALNUM_WORDS, True)
            hashes.append(words)
            owner.append(np.repeat([place[rows[k][0]] for k in range(i, j)], np.diff(first)))
        hashes, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, owner))
        self.vocabulary, term = np.unique(hashes.astype(np.uint64), return_inverse=True)
        pairs, self.times = np.unique(term * len(self.ids) + owner.astype(np.int64), return_counts=True)
        self.item = pairs % max(1, len(self.ids))
        self.first = np.searchsorted(pairs, np.arange(len(self.vocabulary) + 1) * len(self.ids))


def _bags(items):
    """Rows as (doc_id, number of terms, bag); a bag is (term, occurrences) pairs by term."""

    def run(batches):
        vocabulary = items.value.vocabulary
        size = len(vocabulary)
        for batch in batches:
            for i, j, buf, offsets in text_blocks(batch, "text"):
                hashes, first = words_by_text(buf, offsets, ALNUM_WORDS, True)
                at = np.minimum(np.searchsorted(vocabulary, hashes), size - 1)
                known = vocabulary[at] == hashes
                row = np.repeat(np.arange(j - i), np.diff(first))[known]
                entries, times = np.unique(row * size + at[known], return_counts=True)
                packed = np.stack([entries % size, times], axis=1).astype("<u4")
                edges = 8 * np.searchsorted(entries, np.arange(j - i + 1) * size)
                bags = pa.Array.from_buffers(
                    pa.binary(), j - i, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(np.diff(first), pa.int64()), bags],
                    names=["doc_id", "n", "bag"])

    return run


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, occurrences) of the bags of a column."""
    bags = column.to_pylist()
    pairs = np.frombuffer(b"".join(bags), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags]), pairs[:, 0], pairs[:, 1]


def _frequencies(size: int):
    """Documents of a task that hold each term."""

    def run(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                held += np.bincount(_entries(batch.column("bag").slice(at, 1024))[1], minlength=size)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(held[term], pa.int64())], names=["term", "df"])

    return run


def _best(order: tuple, item: np.ndarray, places: int) -> np.ndarray:
    """Rows of the first ``places`` of every item in the given order of sort keys."""
    at = np.lexsort((*order, item))
    own = item[at]
    head = np.searchsorted(own, own)  # where the item's rows begin
    return at[np.arange(len(at)) - head < places]


def _ranked(items, weights, places: int):
    """The best documents of a task for every item, from its classes."""

    def run(batches):
        own = items.value
        n_items = len(own.ids)
        step = max(1, SCORES // n_items)
        item, score, lowest = (np.zeros(0, np.int64) for _ in range(3))
        members: list = []
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                lists = part.column("members").to_pylist()
                m = part.column("m").to_numpy(zero_copy_only=False)
                low = np.array([x[0] for x in lists], np.int64)
                by_id = np.argsort(low, kind="stable")
                turn = np.empty_like(by_id)
                turn[by_id] = np.arange(len(by_id))  # columns in order of the smallest id
                row, term, tf = _entries(part.column("bag"))
                share = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
                order = np.argsort(term, kind="stable")
                row, term, share = turn[row[order]], term[order], share[order]
                cuts = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term)).tolist()
                scores = np.zeros((n_items, len(lists)), np.int64)
                for a, b in zip(cuts, cuts[1:]):
                    t = term[a]
                    holding = slice(own.first[t], own.first[t + 1])
                    worth = own.times[holding] * weights[t]
                    scores[own.item[holding][:, None], row[a:b]] += worth[:, None] * share[a:b]
                if len(lists) <= places:
                    top = np.broadcast_to(np.arange(len(lists)), (n_items, len(lists)))
                elif int(scores.max()) >= (1 << 62) // len(lists):
                    top = np.argsort(-scores, axis=1, kind="stable")[:, :places]
                else:
                    rank = scores * len(lists) - np.arange(len(lists))  # equal scores: the smaller id first
                    top = np.argpartition(rank, len(lists) - places, axis=1)[:, -places:]
                value = np.take_along_axis(scores, top, axis=1).ravel()
                positive = value > 0
                column = by_id[top.ravel()[positive]]
                item = np.concatenate([item, np.repeat(np.arange(n_items), top.shape[1])[positive]])
                score = np.concatenate([score, value[positive]])
                lowest = np.concatenate([lowest, low[column]])
                members += [lists[c] for c in column.tolist()]
                kept = _best((lowest, -score), item, places)
                item, score, lowest = item[kept], score[kept], lowest[kept]
                members = [members[k] for k in kept.tolist()]
        count = np.array([len(x) for x in members], np.int64)
        item, score = np.repeat(item, count), np.repeat(score, count)
        doc = np.array([d for x in members for d in x], np.int64)
        kept = _best((doc, -score), item, places)
        yield pa.RecordBatch.from_arrays(
            [pa.array([own.ids[k] for k in item[kept].tolist()], pa.int64()), pa.array(doc[kept]), pa.array(score[kept])],
            names=["item_id", "doc_id", "score"])

    return run


def classes(bags: DataFrame, n_docs: int, n_terms: int, places: int) -> DataFrame:
    """One row per class of equal (bag, m): ``m``, ``bag`` and ``members``, its smallest ids."""
    own = bags.where("doc_id IS NOT NULL AND length(bag) > 0").selectExpr(
        "doc_id", f"100 - 25 + (25 * n * {n_docs}L) div {n_terms}L AS m", "bag")
    hashed = own.select(F.xxhash64("m", "bag").alias("h"), "*")
    # ordered by hash; equal hashes part where m or the bag differs
    first = hashed.withColumn("at", F.row_number().over(Window.partitionBy("h", "m", "bag").orderBy("doc_id"))).where(f"at <= {places}")
    return first.groupBy("h", "m", "bag").agg(F.sort_array(F.collect_list("doc_id")).alias("members")).select("m", "bag", "members")


def search(docs: DataFrame, items: DataFrame, *, places: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``places`` best documents of every item: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    spark = docs.sparkSession
    docs = docs.selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text")
    asked = items.selectExpr(f"CAST(`{item_id}` AS BIGINT) AS item_id", f"CAST(`{item_text}` AS STRING) AS text").where(
        "text IS NOT NULL").distinct()
    n_bytes = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-n_bytes // ITEM_BYTES)
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    found, size = [], None
    for k in range(blocks):
        block = Items([(r.item_id, r.text) for r in dealt.where(f"block = {k}").collect()])  # some ITEM_BYTES of text
        if not len(block.vocabulary):
            continue
        shared = spark.sparkContext.broadcast(block)
        bags = written(docs.mapInArrow(_bags(shared), _BAG), "lexical-bags")
        size = size or bags.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not size.docs:
            break
        held = np.zeros(len(block.vocabulary), np.int64)
        for r in bags.mapInArrow(_frequencies(len(held)), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
            held[r.term] = r.df
        weights = np.array([math.floor(1000 * math.log((2 * size.docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
        found.append(classes(bags, size.docs, size.terms, places).mapInArrow(_ranked(shared, weights, places), _RANKED))
    if not found:
        return docs.limit(0).selectExpr("doc_id AS item_id", "1 AS rank", "doc_id", "doc_id AS score")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    every = reduce(DataFrame.union, found)
    return every.withColumn("rank", F.row_number().over(best)).where(f"rank <= {places}").select("item_id", "rank", "doc_id", "score")
