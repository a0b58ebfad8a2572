"""Line dedup by an exact set-similarity join.

A line's set is its distinct 5-word shingles (words are runs of other than white
space, A-Z read as a-z; a shorter line is one shingle, its whole word sequence). A
line is removed when an earlier line of the corpus (by doc_id, then line number) has
a set with Jaccard similarity 0.8 or more to its own, judged on the input.

1. Shards learn the corpus-wide frequency of every shingle (``shards``); a set
   that matches another has 0.8 of its shingles elsewhere, so most lines end here.
2. Equal sets become one, at its earliest line.
3. The others join over their prefixes: shingles are ordered by rarity, and of two
   matching sets the ``n - ceil(0.8 n) + 1`` rarest of each share one. Minimum edges per
   shared prefix shingle give candidate groups, so a set travels once, not once a
   shingle. In a group an index over the prefixes finds the earlier sets of each set;
   those that pass the length filter and the positional filter (what may still follow
   the shared shingle in both orders must reach the needed overlap) are verified on
   the whole sets until one matches.
4. A group above ``BLOCK_BYTES`` is cut into blocks and every pair of blocks is read on
   its own, so any size is exact and bounded.

Defined results: a line without a word is never removed and matches nothing; a null
text has no lines; of equal texts those with a larger doc_id lose every line that has
a word; repeated rows with one id are one text; rows with a null doc_id are left
out of the digest and pass unchanged through ``drop_repeated_lines``; an empty table gives an empty result. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import components, written
from tillroll.llm.kernel import SPACE_WORDS, blocks, span_hashes, word_bounds
from tillroll.llm.shards import sharded_texts, text_id, with_frequencies
from tillroll.llm.sigtree import distinct_sets, shingle_hashes, signatures
from tillroll.operators.enrich import SALTS_PER_PARTITION
from tillroll.operators.skew import salted
from tillroll.session import shuffle_partitions

SHINGLE_WORDS = 5
SHARE, WHOLE = 4, 5  # similarity: SHARE / WHOLE
BLOCK_BYTES = 16 << 20


def least_overlap(sizes):
    """Smallest overlap of two sets, given the sum of their sizes, that reaches the similarity."""
    return -(-SHARE * sizes // (SHARE + WHOLE))


def _lines_of(shard) -> SimpleNamespace:
    """Lines with a word and the distinct sets among them, in order of first appearance."""
    keys, owner, text_of, line_of, total = [], [], [], [], 0
    for i, j in blocks(shard.offsets):
        base = shard.offsets[i]
        buf, offsets = shard.buf[base : shard.offsets[j]], shard.offsets[i : j + 1] - base
        starts, ends = word_bounds(buf, offsets, SPACE_WORDS)
        breaks = np.flatnonzero(buf == 10)
        text = np.searchsorted(offsets, starts, side="right") - 1
        line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[:-1])[text]
        new = np.ones(len(starts), bool)
        new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
        first = np.flatnonzero(new)
        k, o = shingle_hashes(span_hashes(buf, starts, ends, True), np.append(first, len(starts)), SHINGLE_WORDS)
        keys.append(k)
        owner.append(o + total)
        text_of.append(text[first] + i)
        line_of.append(line[first])
        total += len(first)
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    sets, bounds = distinct_sets(cat(keys, np.uint64), cat(owner, np.int64), total)
    s1, s2 = signatures(sets, bounds)
    order = np.lexsort((s2, s1))  # equal sets together, the first of them in front
    new = np.ones(total, bool)
    new[1:] = (s1[order][1:] != s1[order][:-1]) | (s2[order][1:] != s2[order][:-1])
    first, which = order[new], np.empty(total, np.int64)
    which[order] = np.cumsum(new) - 1
    size = np.diff(bounds)
    picked = np.zeros(total, bool)
    picked[first] = True
    return SimpleNamespace(
        keys=sets[np.repeat(picked, size)], bounds=np.concatenate([[0], np.cumsum(size[picked])]), picked=np.flatnonzero(picked),
        text=cat(text_of, np.int64), line=cat(line_of, np.int64), s1=s1, s2=s2, first=first[which],
        copies=np.bincount(which, minlength=len(first))[which],
    )


def _candidates(carry: bool):
    def run(shard, lines, frequency: np.ndarray) -> pa.Table:
        """Per text: its lines that may match another, and the distinct sets first seen in it."""
        n = np.diff(lines.bounds)
        shared = np.concatenate([[0], np.cumsum(frequency >= 2)])
        may = WHOLE * (shared[lines.bounds[1:]] - shared[lines.bounds[:-1]]) >= SHARE * n
        may |= lines.copies[lines.picked] > 1
        judged = np.zeros(len(lines.line), bool)
        judged[lines.picked] = may
        judged = judged[lines.first] if len(judged) else judged
        marks: list[list] = [[] for _ in range(shard.n)]
        sets: list[list] = [[] for _ in range(shard.n)]
        for k in np.flatnonzero(judged).tolist():
            marks[lines.text[k]].append({"line": int(lines.line[k]), "s1": int(lines.s1[k]), "s2": int(lines.s2[k])})
        for u in np.flatnonzero(may).tolist():
            k = lines.picked[u]
            a, b = lines.bounds[u], lines.bounds[u + 1]
            size = int(n[u])
            order = np.argsort(frequency[a:b], kind="stable")  # by rarity, then by value
            prefix = size - -(-SHARE * size // WHOLE) + 1
            ordered = lines.keys[a:b][order]
            rare = frequency[a:b][order[:prefix]] >= 2
            sets[lines.text[k]].append({
                "line": int(lines.line[k]), "s1": int(lines.s1[k]), "s2": int(lines.s2[k]), "n": size,
                "keys": ordered.astype("<u8").tobytes(),
                "prefix": ordered[:prefix][rare].view(np.int64).tolist(),
            })
        n_lines = np.bincount(lines.text, minlength=shard.n)
        texts = shard.texts.to_pylist()
        out = {
            "h": pa.array(shard.text_ids, pa.string()), "doc_id": pa.array(shard.doc_ids, pa.int64()),
            "n_lines": pa.array(n_lines, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
            "bare_sha256": pa.array([hashlib.sha256(_bare(t).encode()).hexdigest() for t in texts], pa.string()),
            "text": pa.array([t if carry or m else None for t, m in zip(texts, marks)], pa.string()),
            "lines": pa.array(marks, pa.list_(pa.struct([("line", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64())]))),
            "sets": pa.array(sets, pa.list_(pa.struct([
                ("line", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()),
                ("prefix", pa.list_(pa.int64()))]))),
        }
        return pa.table(out)

    return run


_SETS = "array<struct<line: int, s1: bigint, s2: bigint, n: int, keys: binary, prefix: array<bigint>>>"


def _has_word(line: str) -> bool:
    return bool(line.strip(" \t\n\v\f\r"))


def _bare(text: str) -> str:
    """The text without any line that has a word."""
    return "\n".join(x for x in text.split("\n") if not _has_word(x))


def earlier_matches(keys: list[np.ndarray]) -> np.ndarray:
    """Which sets have an earlier match; the sets come in order of appearance, the
    shingles of each by rarity."""
    out = np.zeros(len(keys), bool)
    index: dict[int, list[tuple[int, int]]] = {}
    for k, own in enumerate(keys):
        n, tried = len(own), set()
        prefix = own[: n - -(-SHARE * n // WHOLE) + 1].tolist()
        for at, token in enumerate(prefix):
            for other, place in index.get(token, ()):
                if other in tried:
                    continue
                tried.add(other)
                m = len(keys[other])
                need = least_overlap(n + m)
                if WHOLE * m < SHARE * n or WHOLE * n < SHARE * m:  # length filter
                    continue
                if min(n - at, m - place) + min(at, place) < need:  # positional filter
                    continue
                if len(np.intersect1d(own, keys[other], assume_unique=True)) >= need:
                    out[k] = True
                    break
            if out[k]:
                break
        for at, token in enumerate(prefix):
            index.setdefault(token, []).append((k, at))
    return out


def _meet(batches):
    """Groups as runs of rows; a run is closed by the next one or the end."""
    names = ["component", "i", "j"]

    def matched(keys, ids):
        hit = earlier_matches(keys) if len(keys) > 1 else [False]
        return [x for x, h in zip(ids, hit) if h]

    current, keys, ids = None, [], []
    for batch in batches:
        found = []
        rows = zip(*(batch.column(c).to_pylist() for c in names), batch.column("s1").to_pylist(), batch.column("s2").to_pylist(),
                   batch.column("keys"))
        for c, i, j, s1, s2, k in rows:
            if (c, i, j) != current:
                found += matched(keys, ids)
                current, keys, ids = (c, i, j), [], []
            keys.append(np.frombuffer(k.as_buffer(), "<u8").copy())
            ids.append((s1, s2))
        yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], pa.int64()) for n in (0, 1)], names=["s1", "s2"])
    found = matched(keys, ids)
    yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], pa.int64()) for n in (0, 1)], names=["s1", "s2"])


def _cut(batches):
    for batch in batches:
        texts, digests = [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            if gone:
                drop = set(gone)
                text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop)
            texts.append(text)
            digests.append(hashlib.sha256(text.encode()).hexdigest() if gone else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("h"), pa.array(texts, pa.string()), pa.array(digests, pa.string()),
             pa.array([len(g or []) for g in batch.column("gone").to_pylist()], pa.int64())],
            names=["h", "kept_text", "cut_sha256", "n_removed"])


def deduplicated_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, carry: bool = True) -> DataFrame:
    """Per distinct text: ``h, doc_id`` (the smallest), ``n_lines, n_removed, kept_text,
    kept_sha256, bare_sha256`` (of the lines without a word). Without ``carry``,
    ``kept_text`` is null where nothing can have been removed."""
    texts, buckets = sharded_texts(docs, doc_id, text)
    found = written(with_frequencies(
        texts, buckets, _lines_of, _candidates(carry),
        "h string, doc_id bigint, n_lines bigint, kept_sha256 string, bare_sha256 string, text string, "
        f"lines array<struct<line: int, s1: bigint, s2: bigint>>, sets {_SETS}",
    ), "line-sets")
    # equal sets: one, at the earliest line
    first = found.selectExpr("doc_id", "inline(sets)").groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "line", "keys", "prefix")).alias("f"))
    sets = written(first.selectExpr("s1", "s2", "f.*"), "line-distinct")
    tokens = sets.selectExpr("explode(prefix) AS t", "s1")
    lowest = tokens.groupBy("t").agg(F.min("s1").alias("m"), F.max("s1").alias("x")).where("m < x")
    edges = tokens.join(lowest.select("t", "m"), "t").where("s1 <> m").selectExpr("s1 AS a", "m AS b")
    groups = components(edges, "line_groups").withColumnRenamed("node", "s1")
    members = written(sets.select("doc_id", "line", "s1", "s2", "keys").join(groups, "s1"), "line-groups")
    size = members.groupBy("component").agg(F.expr("sum(octet_length(keys))").alias("bytes"))
    pairs = (
        members.join(size, "component")
        .selectExpr("*", f"CAST(ceil(bytes / {BLOCK_BYTES}) AS INT) AS blocks")
        .selectExpr("*", "CAST(pmod(xxhash64(s1), blocks) AS INT) AS own")
        .selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr("component", "least(own, other) AS i", "greatest(own, other) AS j", "doc_id", "line", "s1", "s2", "keys")
    )
    matched = (
        pairs.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "doc_id", "line", "s1", "s2")
        .mapInArrow(_meet, "s1 bigint, s2 bigint").distinct()
    )
    verdict = sets.select("s1", "s2", "doc_id", "line").join(
        matched.withColumn("m", F.lit(True)), ["s1", "s2"], "left"
    ).selectExpr("s1", "s2", "doc_id AS first_doc", "line AS first_line", "coalesce(m, false) AS matched")
    # a line that very many texts have is dealt over salts
    parts = shuffle_partitions(docs.sparkSession)
    lines, verdict = salted(found.selectExpr("h", "doc_id", "inline(lines)"), verdict, "s1", parts, SALTS_PER_PARTITION * parts)
    gone = (
        lines.join(verdict, ["s1", "s2", "_salt"])
        .where("matched OR NOT (doc_id = first_doc AND line = first_line)")
        .groupBy("h").agg(F.collect_set("line").alias("gone"))
    )
    affected = found.where("size(lines) > 0")
    cut = affected.select("h", "text").join(gone, "h", "left").mapInArrow(
        _cut, "h string, kept_text string, cut_sha256 string, n_removed bigint")
    changed = affected.select("h", "doc_id", "n_lines", "kept_sha256", "bare_sha256").join(cut, "h").selectExpr(
        "h", "doc_id", "n_lines", "n_removed", "kept_text", "coalesce(cut_sha256, kept_sha256) AS kept_sha256", "bare_sha256")
    same = found.where("size(lines) = 0").selectExpr(
        "h", "doc_id", "n_lines", "0L AS n_removed", "text AS kept_text", "kept_sha256", "bare_sha256")
    return same.unionByName(changed)


def line_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines`` (lines with a word), ``n_removed, kept_sha256`` for every row with an id."""
    rows = docs.where(f"`{doc_id}` IS NOT NULL").selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"{text_id(text)} AS h")
    by_text = deduplicated_texts(docs, doc_id, text, carry=False).withColumnRenamed("doc_id", "smallest").drop("kept_text")
    return rows.join(by_text, "h").selectExpr(
        "doc_id", "n_lines", "IF(doc_id > smallest, n_lines, n_removed) AS n_removed",
        "IF(doc_id > smallest, bare_sha256, kept_sha256) AS kept_sha256",
    )


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated lines; a document that loses its last word goes, one
    that never had a word stays. Copies of a text lose all their lines, so one stays.
    Rows with a null doc_id have no place in the order: they pass unchanged."""
    others = [c for c in docs.columns if c != text]
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than any column's name
    kept = deduplicated_texts(docs, doc_id, text).where("n_lines = 0 OR n_removed < n_lines").selectExpr(
        f"h AS {free}h", f"doc_id AS {free}first", f"n_lines AS {free}n", f"kept_text AS {free}text")
    rows = docs.selectExpr(*[f"`{c}`" for c in others], f"{text_id(text)} AS {free}h")
    judged = rows.join(kept, f"{free}h").where(f"`{doc_id}` = {free}first OR ({free}n = 0 AND `{doc_id}` IS NOT NULL)").selectExpr(
        *[f"{free}text AS `{c}`" if c == text else f"`{c}`" for c in docs.columns])
    return judged.union(docs.where(f"`{doc_id}` IS NULL"))
