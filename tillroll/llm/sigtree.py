"""Exact n-gram Jaccard join with signature trees.

A document's set is its distinct shingles of ``words`` words (words are runs of other
than white space, A-Z read as a-z; a shorter text is one shingle, its whole word
sequence). Two documents link when ``100 * intersection >= share * union``; five words
and 80 unless asked otherwise.

1. Shards learn the corpus-wide frequency of every shingle (``shards``). A set that
   links has at least that share of its shingles in another text, so most texts end here.
2. The sets that stay, one of each equal kind, meet over their rarest shingles: of
   two linked sets one of the ``n - ceil(0.9 n) + 1`` rarest shingles of each is
   shared. Minimum edges per shingle give candidate groups, a superset of the
   linked groups.
3. In a candidate group a signature tree is built: a leaf holds a set's token
   bitmap, a node the OR (and AND) of its children's bitmaps and their size range. A
   dual traversal drops node pairs whose sizes, or whose largest possible overlap
   by the bitmaps, cannot reach the threshold, and pairs that are already in one
   component; what is left is verified on the whole sets. Only links that join two
   components are written, so a group of n copies gives n - 1 links.
4. A group above ``BLOCK_BYTES`` of sets is cut into blocks and every pair of blocks
   is a task of its own: any size is exact and no task holds more than two blocks.

Defined results: null, empty and blank texts have an empty set and are linked with
nothing; repeated rows and equal texts have one component; rows with a null doc_id
are left out; an empty table gives an empty result; extra columns are ignored.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import components, written
from tillroll.llm.kernel import SPACE_WORDS, blocks, combine, mix64, order_of, ranges, words_by_text
from tillroll.llm.shards import hashes_to_bytes, sharded_texts, text_id, with_frequencies

SHINGLE_WORDS = 5
SHARE = 80  # similarity in hundredths
WHOLE = 100
BLOCK_BYTES = 24 << 20
FAN = 16


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, owner) of word runs; a run shorter than ``size`` is one shingle."""
    n = np.diff(first)
    full = np.flatnonzero(n >= size)
    at = ranges(first[:-1][full], n[full] - size + 1)
    parts = [combine([words[at + k] for k in range(size)])] if len(at) else []
    owners = [np.repeat(full, n[full] - size + 1)]
    for short in range(1, size):
        own = np.flatnonzero(n == short)
        if len(own):
            whole = combine([words[first[:-1][own] + k] for k in range(short)])
            parts.append(mix64(whole + np.uint64(short)))
            owners.append(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate(owners)


def distinct_sets(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys sorted by owner and value without repeats, bounds of the owners)."""
    owner_bits, place_bits = max(1, n).bit_length(), max(1, len(keys)).bit_length()
    lead = 64 - owner_bits - place_bits  # bits of a key that fit beside its owner and place
    if lead < 8:
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
    else:
        first = (owner.astype(np.uint64) << np.uint64(lead)) | (keys >> np.uint64(64 - lead))
        order = order_of(first, owner_bits + lead)
        keys, owner, first = keys[order], owner[order], first[order]
        alike = first[1:] == first[:-1]
        if (alike & (keys[1:] < keys[:-1])).any():  # keys that differ further back: sort those runs in full
            at = np.flatnonzero(np.append(alike, False) | np.append(False, alike))
            keys[at] = keys[at][np.lexsort((keys[at], first[at]))]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[new], np.searchsorted(owner[new], np.arange(n + 1))


def signatures(keys: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit fingerprints of each set."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(keys + np.uint64(salt)), dtype=np.uint64)])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out


def _sets_of(size: int):
    def run(shard) -> SimpleNamespace:
        keys, bounds = [], [np.zeros(1, np.int64)]
        for i, j in blocks(shard.offsets):
            base = shard.offsets[i]
            words, first = words_by_text(shard.buf[base : shard.offsets[j]], shard.offsets[i : j + 1] - base, SPACE_WORDS, True)
            k, b = distinct_sets(*shingle_hashes(words, first, size), j - i)
            keys.append(k)
            bounds.append(b[1:] + bounds[-1][-1])
        return SimpleNamespace(keys=np.concatenate(keys) if keys else np.zeros(0, np.uint64), bounds=np.concatenate(bounds))

    return run


def _survivors(share: int):
    def run(shard, sets, frequency: np.ndarray) -> pa.Table:
        n = np.diff(sets.bounds)
        shared = np.concatenate([[0], np.cumsum(frequency >= 2)])
        stays = (n > 0) & (WHOLE * (shared[sets.bounds[1:]] - shared[sets.bounds[:-1]]) >= share * n)
        prefix: list[list[int]] = [[]] * len(n)
        for k in np.flatnonzero(stays).tolist():
            a, b = sets.bounds[k], sets.bounds[k + 1]
            size = int(n[k])
            least = -(-share * size // WHOLE)
            rare = np.argsort(frequency[a:b], kind="stable")[: size - least + 1]  # keys are in order already
            rare = rare[frequency[a:b][rare] >= 2]
            prefix[k] = sets.keys[a:b][rare].view(np.int64).tolist()
        first, second = signatures(sets.keys, sets.bounds)
        return pa.table({
            "h": pa.array(shard.text_ids, pa.string()), "doc_id": pa.array(shard.doc_ids, pa.int64()),
            "n": pa.array(n, pa.int64()), "s1": pa.array(first), "s2": pa.array(second),
            "keys": pa.array(hashes_to_bytes(sets.keys, sets.bounds, stays), pa.binary()),
            "prefix": pa.array(prefix, pa.list_(pa.int64())),
        })

    return run


class SignatureTree:
    """Token bitmaps of sets, with OR, AND and size ranges of nodes of ``FAN`` children."""

    def __init__(self, sets: list[np.ndarray], share: int = SHARE):
        self.share = share
        self.sizes = np.array([len(s) for s in sets])
        bits = 256
        while bits < 4 * self.sizes.max(initial=1) and bits < 1 << 14:
            bits *= 2
        shift = np.uint64(64 - (bits.bit_length() - 1))
        self.bitmaps = np.zeros((len(sets), bits // 64), np.uint64)
        for k, s in enumerate(sets):
            row = np.zeros(bits, np.uint8)
            row[(s >> shift).astype(np.int64)] = 1
            self.bitmaps[k] = np.packbits(row).view(np.uint64)
        self.levels = [(self.bitmaps, self.bitmaps, self.sizes, self.sizes)]
        while len(self.levels[-1][2]) > 1:
            or_, and_, low, high = self.levels[-1]
            cut = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(or_, cut), np.bitwise_and.reduceat(and_, cut),
                                np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Matrix: can some set below node a[i] reach the threshold with one below b[j]?"""
        or_, and_, low, high = self.levels[level]
        low_a, low_b, high_a, high_b = low[a][:, None], low[b][None], high[a][:, None], high[b][None]
        sizes = (WHOLE * high_a >= self.share * low_b) & (WHOLE * high_b >= self.share * low_a)
        # what must lie outside the other side's bitmap cannot overlap
        out_a = np.bitwise_count(and_[a][:, None] & ~or_[b][None]).sum(-1, dtype=np.int64)
        out_b = np.bitwise_count(and_[b][None] & ~or_[a][:, None]).sum(-1, dtype=np.int64)
        most = np.minimum(high_a - out_a, high_b - out_b)
        return sizes & ((self.share + WHOLE) * most >= self.share * (low_a + low_b))


def tree_links(sets: list[np.ndarray], share: int = SHARE) -> list[tuple[int, int]]:
    """Links that span the components of the given sets (places in the list)."""
    order = sorted(range(len(sets)), key=lambda k: (len(sets[k]), sets[k][0]))
    sets = [sets[k] for k in order]
    tree = SignatureTree(sets, share)
    root, links = np.arange(len(sets)), []

    def one_component(level: int, a: int, b: int) -> bool:
        width = FAN**level
        x, y = root[a * width : (a + 1) * width], root[b * width : (b + 1) * width]
        return bool((x == x[0]).all() and (y == x[0]).all())

    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        if level and one_component(level, a, b):
            continue
        if level == 0:
            x, y = root[a], root[b]
            if x != y:
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if (share + WHOLE) * both >= share * (len(sets[a]) + len(sets[b])):
                    root[root == max(x, y)] = min(x, y)
                    links.append((order[a], order[b]))
            continue
        width = len(tree.levels[level - 1][2])
        kids_a = np.arange(a * FAN, min((a + 1) * FAN, width))
        kids_b = np.arange(b * FAN, min((b + 1) * FAN, width))
        can = tree.possible(level - 1, kids_a, kids_b)
        for i, j in np.argwhere(can)[::-1].tolist():
            x, y = int(kids_a[i]), int(kids_b[j])
            if x < y or (x == y and level > 1):
                stack.append((level - 1, x, y))
    return links


def _group_links(share: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_pylist()
        links = tree_links([np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()], share)
        return pa.table({"a": pa.array([ids[i] for i, _ in links], pa.int64()), "b": pa.array([ids[j] for _, j in links], pa.int64())})

    return run


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int = SHINGLE_WORDS,
                       share: int = SHARE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` with an id."""
    texts, buckets = sharded_texts(docs, doc_id, text)
    found = written(with_frequencies(
        texts, buckets, _sets_of(words), _survivors(share),
        "h string, doc_id bigint, n bigint, s1 bigint, s2 bigint, keys binary, prefix array<bigint>",
    ), "jaccard-sets")
    sets = found.where("keys IS NOT NULL")
    equal = sets.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    same = sets.select("s1", "s2", "doc_id").join(equal, ["s1", "s2"]).where("doc_id <> rep").selectExpr("doc_id AS a", "rep AS b")
    kept = sets.join(equal.selectExpr("s1", "s2", "rep AS doc_id"), ["s1", "s2", "doc_id"], "left_semi")

    tokens = kept.selectExpr("explode(prefix) AS t", "doc_id")
    lowest = tokens.groupBy("t").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("x")).where("m < x")
    meet = tokens.join(lowest.select("t", "m"), "t").where("doc_id <> m").selectExpr("doc_id AS a", "m AS b")
    groups = written(components(meet, "jaccard_candidates"), "jaccard-groups")

    members = groups.withColumnRenamed("node", "doc_id").join(kept.select("doc_id", "keys"), "doc_id")
    size = members.groupBy("component").agg(F.expr("sum(octet_length(keys))").alias("bytes"))
    pairs = (
        members.join(size, "component")
        .selectExpr("component", "doc_id", "keys", f"CAST(ceil(bytes / {BLOCK_BYTES}) AS INT) AS blocks")
        .selectExpr("*", "CAST(pmod(xxhash64(doc_id), blocks) AS INT) AS own")
        .selectExpr("component", "doc_id", "keys", "own", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr("component", "least(own, other) AS i", "greatest(own, other) AS j", "doc_id", "keys")
    )
    links = pairs.groupBy("component", "i", "j").applyInArrow(_group_links(share), "a bigint, b bigint")
    linked = components(links.union(same), "jaccard_links")

    texts_of = docs.where(f"`{doc_id}` IS NOT NULL").selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"{text_id(text)} AS h")
    by_text = found.selectExpr("h", "doc_id AS node", "n").join(linked, "node", "left")
    return texts_of.join(by_text, "h").selectExpr(
        "doc_id", "n AS n_shingles", "IF(n = 0, doc_id, coalesce(component, node)) AS component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id; rows that repeat the
    smallest id stay, and so do rows without an id."""
    gone = jaccard_components(docs, doc_id, text, **how).where("component_id <> doc_id").selectExpr(f"doc_id AS `{doc_id}`")
    return docs.join(gone, doc_id, "left_anti")
