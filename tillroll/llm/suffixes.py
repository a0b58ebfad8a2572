"""Exact substring dedup over range-partitioned suffixes.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts in a
text with a smaller doc_id; matches never cross texts and are judged on the input.

Not every suffix is sorted. Of the windows of ``LENGTH`` bytes, neighbours share an
anchor: the position whose ``GRAM``-byte string hashes lowest within the window
(leftmost on ties), which depends on the window's bytes alone, so equal windows have
equal anchors at equal places. Shards learn the corpus-wide frequency of every
anchor string (``shards``); windows whose anchor string stands in one text only have
no match and end here.

The other windows are suffix starts to be sorted. Splitters sampled from the
anchors' leading bytes cut them into ranges; all windows of one anchor string fall
into one range. A range of more than ``RANGE_WINDOWS`` windows (a phrase shorter than
``LENGTH`` with ever new neighbours) is cut into parts by a hash of the window's own
bytes, so equal windows never part, and is sent window by window. A shard sends a
range, or a part of one, one row: its distinct stretches of bytes around anchors, or
distinct windows, with the smallest doc_id of each (a passage that a third of all
texts share is one stretch of each shard). The range
sorts the suffixes by multikey quicksort, compares neighbours over ``LENGTH`` bytes,
finds the smallest doc_id of every run of equal ones, also across the ends of the
rows it was sent, and answers each shard. The shard, read again, marks its bytes.

Equal texts are one text with the smallest id; the others lose every byte (if they
have ``LENGTH`` of them).

Defined results: a null text is empty, a text below ``LENGTH`` bytes loses nothing;
repeated rows with one id are one text; texts with equal ids do not remove from each
other; rows with a null doc_id are left out; an empty table gives an empty result;
extra columns are ignored. Anchor strings are compared by hash, windows by bytes.
"""

from __future__ import annotations

import hashlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written
from tillroll.llm.kernel import blocks, combine, gram_hashes, mix64, ranges, span_hashes, text_buffer
from tillroll.llm.shards import sharded_texts, text_id, with_frequencies
from tillroll.session import shuffle_partitions

LENGTH = 50
GRAM = 24
SPAN = LENGTH - GRAM + 1  # anchor strings in a window
PLACE_BITS = 24  # a block has fewer bytes than 2 ** PLACE_BITS; longer texts are cut with an overlap
SMALL = 4096  # ranges of suffixes below this are sorted at once
SPLITTER_SAMPLE = 200_000
RANGE_WINDOWS = 2 << 20  # windows of a range that are sorted in one task; an ordinary range has below 1 << 20
COUNT_BYTES = 2 << 20  # of text, whose distinct stretches are counted together


def anchors(buf: np.ndarray, offsets: np.ndarray):
    """(anchor, first window, last window, anchor string hash) of all windows of a block,
    one row for each run of windows with one anchor."""
    n = len(buf)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if n < LENGTH:
        return none
    gram = gram_hashes(buf, GRAM)
    place = np.uint64((1 << PLACE_BITS) - 1)
    low = gram & ~place
    low |= np.arange(len(gram), dtype=np.uint64)
    width, best = 1, low
    while 2 * width <= SPAN:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if SPAN > width:
        best = np.minimum(best[: len(best) - (SPAN - width)], best[SPAN - width :])
    chosen = (best & place).astype(np.int32)  # anchor of the window that starts here
    valid = np.ones(len(chosen), bool)
    tail = np.minimum(np.diff(offsets), LENGTH - 1)  # no window starts in the last bytes of a text
    at = ranges(offsets[1:] - tail, tail)
    valid[at[at < len(valid)]] = False
    new = valid.copy()
    new[1:] &= (chosen[1:] != chosen[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return none
    end = valid.copy()
    end[:-1] &= new[1:] | ~valid[1:]
    last = np.flatnonzero(end)
    picked = chosen[first].astype(np.int64)
    return picked, first, last, gram[picked]


def _pieces(shard):
    """(first byte, block bytes, block offsets): runs of texts, long texts cut with an overlap."""
    most = 1 << (PLACE_BITS - 1)
    for i, j in blocks(shard.offsets):
        a, b = int(shard.offsets[i]), int(shard.offsets[j])
        if b - a <= most:
            yield a, shard.buf[a:b], shard.offsets[i : j + 1] - a
            continue
        for s in range(a, max(a + 1, b - LENGTH + 1), most):
            e = min(b, s + most + LENGTH - 1)
            yield s, shard.buf[s:e], np.array([0, e - s])


def _anchors_of(shard) -> SimpleNamespace:
    """All anchors of a shard; ``keys``: every anchor string once for each text."""
    rows = []
    for base, buf, offsets in _pieces(shard):
        a, s, e, g = anchors(buf, offsets)
        rows.append((a + base, s + base, e + base, g))
    at, first, last, gram = (np.concatenate(x) for x in zip(*rows)) if rows else (
        *(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64))
    owner = np.searchsorted(shard.offsets, first, side="right") - 1
    # one key for each (text, string): the texts' numbers are mixed into the hashes
    own = gram + mix64(owner.astype(np.uint64) + np.uint64(1))
    _, one, unit = np.unique(own, return_index=True, return_inverse=True)
    return SimpleNamespace(at=at, first=first, last=last, owner=owner, unit=unit, keys=gram[one])


def _candidates(shard, found, frequency: np.ndarray) -> pa.Table:
    """Per text: its digest, and for texts with a shared anchor the text and anchors."""
    keep = frequency[found.unit] >= 2
    owner = found.owner[keep]
    base = shard.offsets[:-1][owner]
    packed = np.stack([(x[keep] - base).astype(np.int32) for x in (found.at, found.first, found.last)], axis=1)
    cut = np.searchsorted(owner, np.arange(shard.n + 1))
    has = np.diff(cut) > 0
    data = memoryview(shard.buf)
    bounds = list(zip(shard.offsets[:-1].tolist(), shard.offsets[1:].tolist()))
    lead = np.zeros(shard.n, np.int64)
    one = (cut[:-1] + np.diff(cut) // 2)[has]  # one from the middle: heads of texts are alike
    if len(one):
        lead[has] = _leading(shard.buf, found.at[keep][one]).view(np.int64)
    return pa.table({
        "h": pa.array(shard.text_ids, pa.string()), "doc_id": pa.array(shard.doc_ids, pa.int64()),
        "n_bytes": pa.array(np.diff(shard.offsets)),
        "kept_sha256": pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in bounds], pa.string()),
        "text": shard.texts.take(pa.array(np.arange(shard.n), mask=~has)),
        "anchors": pa.array([packed[a:b].tobytes() if b > a else None for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
        "lead": pa.array(lead, mask=~has),
    })


def _leading(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one big-endian integer."""
    bytes_ = buf[at[:, None] + np.arange(8)]
    return np.ascontiguousarray(bytes_).view(">u8").ravel().astype(np.uint64)


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Row order by multikey quicksort: three-way parts by one word, equal rows go on
    with the next word, small parts are sorted at once."""
    order = np.arange(len(words))
    stack = [(0, len(words), 0)]
    while stack:
        low, high, depth = stack.pop()
        part = order[low:high]
        if high - low < 2 or depth == words.shape[1]:
            continue
        if high - low <= SMALL:
            order[low:high] = part[np.lexsort(words[part, depth:].T[::-1])]
            continue
        key = words[part, depth]
        some = np.sort(key[:: max(1, len(key) // 31)])
        pivot = some[len(some) // 2]
        less, equal = key < pivot, key == pivot
        a, b = int(less.sum()), int(equal.sum())
        order[low:high] = np.concatenate([part[less], part[equal], part[~less & ~equal]])
        stack += [(low, low + a, depth), (low + a, low + a + b, depth + 1), (low + a + b, high, depth)]
    return order


def _words(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``LENGTH`` bytes from each start as big-endian 64-bit words, zero padded."""
    width = -(-LENGTH // 8) * 8
    rows = np.zeros((len(starts), width), np.uint8)
    for a in range(0, len(starts), 1 << 16):
        rows[a : a + (1 << 16), :LENGTH] = data[starts[a : a + (1 << 16), None] + np.arange(LENGTH)]
    return rows.view(">u8").astype(np.uint64)


def stretch_keys(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """128 bits that tell byte strings apart, as two columns."""
    back = span_hashes(buf[::-1], len(buf) - ends, len(buf) - starts, False)
    return [span_hashes(buf, starts, ends, False), back]


def _alike(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal rows together, their first rows marked); equal rows keep
    their order."""
    order = np.argsort(combine(columns), kind="stable")
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for c in columns:
            c = c[order]
            new[1:] |= c[1:] != c[:-1]
    return order, new


class _Stretches:
    """The distinct stretches of bytes around a shard's anchors, by range."""

    def __init__(self, table: pa.Table, splitters: np.ndarray, parts: np.ndarray | None = None):
        texts = table.column("text").combine_chunks()
        self.buf, self.offsets = text_buffer(texts)
        packed = [np.frombuffer(x, np.int32).reshape(-1, 3) for x in table.column("anchors").to_pylist()]
        sizes = [len(p) for p in packed]
        self.owner = np.repeat(np.arange(len(packed)), sizes)
        rows = np.concatenate(packed).astype(np.int64) + self.offsets[:-1][self.owner][:, None]
        self.at, self.first, self.last = rows.T
        ids = table.column("doc_id").to_numpy()
        self.ids = ids
        bucket = np.searchsorted(splitters, _leading(self.buf, self.at), side="right")
        if parts is not None:
            bucket = self._cut(bucket, parts)
        # a stretch's identity: its bytes and where its anchor stands; texts come in id
        # order, so a stable sort leaves the smallest id first
        same = stretch_keys(self.buf, self.first, self.last + LENGTH) + [(self.at - self.first).astype(np.uint64), bucket.astype(np.uint64)]
        order, new = _alike(same)
        self.which = np.empty(len(order), np.int64)
        picked = order[new]
        by_range = np.argsort(bucket[picked], kind="stable")
        turn = np.empty(len(picked), np.int64)
        turn[by_range] = np.arange(len(picked))
        self.which[order] = turn[np.cumsum(new) - 1]
        self.sample = picked[by_range]  # for each distinct stretch, one with the smallest id
        self.bucket = bucket[self.sample]

    def _cut(self, bucket: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """Stretches of ranges of several parts become single windows, dealt by their bytes."""
        begin = np.cumsum(parts) - parts
        hot = parts[bucket] > 1
        if hot.any():
            windows = np.where(hot, self.last - self.first + 1, 1)
            start = ranges(self.first, windows)
            bucket, hot = np.repeat(bucket, windows), np.repeat(hot, windows)
            self.last = np.where(hot, start, np.repeat(self.last, windows))
            self.at, self.owner, self.first = np.repeat(self.at, windows), np.repeat(self.owner, windows), start
            which = np.flatnonzero(hot)
            h = span_hashes(self.buf, start[which], start[which] + LENGTH, False)
            part = np.zeros(len(start), np.int64)
            part[which] = (h % parts[bucket[which]].astype(np.uint64)).astype(np.int64)
            return begin[bucket] + part
        return begin[bucket]

    def load(self) -> tuple[np.ndarray, np.ndarray]:
        """(ranges, windows of their distinct stretches)."""
        n = np.bincount(self.bucket, (self.last - self.first + 1)[self.sample]).astype(np.int64)
        at = np.flatnonzero(n)
        return at, n[at]

    def ask(self, shard: int) -> pa.Table:
        buckets, cut = np.unique(self.bucket, return_index=True)
        cut = np.append(cut, len(self.bucket))
        size = (self.last + LENGTH - self.first)[self.sample]
        data = self.buf[ranges(self.first[self.sample], size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[self.owner[self.sample]]
        spans = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
        return pa.table({
            "bucket": pa.array(buckets, pa.int32()), "shard": pa.array([shard] * len(buckets), pa.int32()),
            "data": pa.array([data[ends[a] : ends[b]] for a, b in spans], pa.binary()),
            "sizes": pa.array([size[a:b].astype(np.uint8).tobytes() for a, b in spans], pa.binary()),
            "ids": pa.array([ids[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
        })

    def mark(self, answers: list[bytes]) -> np.ndarray:
        """Bytes to remove: ``answers`` hold the smallest id of every window of every
        distinct stretch, in the order they were sent."""
        earliest = np.frombuffer(b"".join(answers), "<i8")
        windows = (self.last - self.first + 1)
        begin = np.concatenate([[0], np.cumsum(windows[self.sample])])[:-1]
        own = np.repeat(self.ids[self.owner], windows)
        hit = earliest[ranges(begin[self.which], windows)] < own
        starts = ranges(self.first, windows)[hit]
        delta = np.zeros(len(self.buf) + 1, np.int64)
        np.add.at(delta, starts, 1)
        np.add.at(delta, starts + LENGTH, -1)
        return np.cumsum(delta[:-1]) > 0


def _answer(table: pa.Table) -> pa.Table:
    """One range: smallest id for every window of the stretches it was sent."""
    data = np.frombuffer(b"".join(table.column("data").to_pylist()), np.uint8)
    sizes = [np.frombuffer(x, np.uint8).astype(np.int64) for x in table.column("sizes").to_pylist()]
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in table.column("ids").to_pylist()])
    size = np.concatenate(sizes)
    begin = np.cumsum(size) - size
    # a stretch that many shards sent is sorted once, with its smallest id
    order, new = _alike([*stretch_keys(data, begin, begin + size), size.astype(np.uint64)])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    picked = order[new]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    windows = size[picked] - LENGTH + 1
    words = _words(data, ranges(begin[picked], windows))
    order = multikey_order(words)
    ordered = words[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    smallest = np.minimum.reduceat(np.repeat(least, windows)[order], np.flatnonzero(new))
    each = np.empty(len(order), "<i8")
    each[order] = smallest[np.cumsum(new) - 1]
    out = each[ranges((np.cumsum(windows) - windows)[which], windows[which])]
    cut = np.concatenate([[0], np.cumsum([int((s - LENGTH + 1).sum()) for s in sizes])])
    return pa.table({
        "shard": table.column("shard"), "bucket": table.column("bucket"),
        "earliest": pa.array([out[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
    })


def _parts(candidates: DataFrame, splitters: np.ndarray) -> np.ndarray:
    """Into how many parts each range is cut, by its number of windows."""

    def count(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = pc.cast(pc.fill_null(pc.binary_length(batch.column("text")), 0), pa.int64()).to_numpy()
            for i, j in blocks(np.concatenate([[0], np.cumsum(sizes)]), COUNT_BYTES):
                at, n = _Stretches(table.slice(i, j - i), splitters).load()
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["bucket", "n"])

    counted = candidates.select("doc_id", "text", "anchors").mapInArrow(count, "bucket bigint, n bigint")
    big = counted.groupBy("bucket").agg(F.sum("n").alias("n")).where(f"n > {RANGE_WINDOWS}").toArrow()
    parts = np.ones(len(splitters) + 1, np.int64)
    parts[big.column("bucket").to_numpy()] = -(-big.column("n").to_numpy() // RANGE_WINDOWS)
    return parts


def _in_order(table: pa.Table) -> pa.Table:
    """A fixed row order, the same on both readings of a shard."""
    return table.sort_by([("doc_id", "ascending"), ("h", "ascending")])


def duplicate_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per distinct text: ``h, doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``
    (flat start and end bytes of the removed runs)."""
    texts, buckets = sharded_texts(docs, doc_id, text)
    found = written(with_frequencies(
        texts, buckets, _anchors_of, _candidates,
        "h string, doc_id bigint, n_bytes bigint, kept_sha256 string, text string, anchors binary, lead bigint",
    ), "suffix-anchors")
    same = found.where("anchors IS NULL").selectExpr(
        "h", "doc_id", "n_bytes", "0L AS n_removed", "0L AS n_spans", "kept_sha256", "CAST(array() AS ARRAY<BIGINT>) AS spans")
    size = found.agg(F.expr("sum(octet_length(text))").alias("b"), F.expr("count(lead)").alias("n")).head()
    n_ranges = max(int((size["b"] or 0) // (1 << 20)) + 1, 2 * shuffle_partitions(docs.sparkSession))
    # a bounded sample of leading bytes: one anchor of a text, SPLITTER_SAMPLE texts
    share = min(1.0, SPLITTER_SAMPLE / max(1, size["n"]))
    sample = found.where("lead IS NOT NULL").where(
        f"pmod(xxhash64(h), 1000000) < {int(share * 1_000_000)}").select("lead").limit(2 * SPLITTER_SAMPLE).toArrow()
    lead = np.sort(sample.column("lead").to_numpy().astype(np.int64).view(np.uint64))
    splitters = np.unique(lead[np.linspace(0, len(lead) - 1, n_ranges + 1).astype(int)[1:-1]]) if len(lead) else lead
    shards = max(int((size["b"] or 0) // (2 << 20)) + 1, 2 * shuffle_partitions(docs.sparkSession))
    parts = _parts(found.where("anchors IS NOT NULL"), splitters)
    rest = found.where("anchors IS NOT NULL").selectExpr(
        "h", "doc_id", "text", "anchors", f"CAST(pmod(xxhash64(h), {shards}) AS INT) AS shard").repartition("shard")

    def ask(table: pa.Table) -> pa.Table:
        return _Stretches(_in_order(table), splitters, parts).ask(table.column("shard")[0].as_py())

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _in_order(left)
        own = _Stretches(left, splitters, parts)
        gone = own.mark(right.sort_by("bucket").column("earliest").to_pylist())
        removed, n_spans, digest, spans = [], [], [], []
        for a, b in zip(own.offsets[:-1].tolist(), own.offsets[1:].tolist()):
            g = np.concatenate([[False], gone[a:b], [False]])
            edge = np.flatnonzero(g[1:] != g[:-1])
            removed.append(int(gone[a:b].sum()))
            n_spans.append(len(edge) // 2)
            spans.append(edge.tolist())
            digest.append(hashlib.sha256(own.buf[a:b][~gone[a:b]].tobytes()).hexdigest())
        return pa.table({
            "h": left.column("h"), "doc_id": left.column("doc_id"), "n_bytes": pa.array(np.diff(own.offsets)),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()), "spans": pa.array(spans, pa.list_(pa.int64())),
        })

    asked = rest.groupBy("shard").applyInArrow(ask, "bucket int, shard int, data binary, sizes binary, ids binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer, "shard int, bucket int, earliest binary")
    marked = rest.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        finish, "h string, doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>")
    return same.unionByName(marked)


NOTHING = hashlib.sha256(b"").hexdigest()


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row with an id."""
    rows = docs.where(f"`{doc_id}` IS NOT NULL").selectExpr(f"CAST(`{doc_id}` AS BIGINT) AS doc_id", f"{text_id(text)} AS h")
    by_text = duplicate_spans(docs, doc_id, text).withColumnRenamed("doc_id", "smallest").drop("spans")
    copy = f"doc_id > smallest AND n_bytes >= {LENGTH}"
    return rows.join(by_text, "h").selectExpr(
        "doc_id", "n_bytes", f"IF({copy}, n_bytes, n_removed) AS n_removed", f"IF({copy}, 1L, n_spans) AS n_spans",
        f"IF({copy}, '{NOTHING}', kept_sha256) AS kept_sha256",
    )
