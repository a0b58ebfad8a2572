"""Corpus-wide document frequencies of keys, without a row per key.

The distinct texts of a corpus are dealt to shards by a hash of the text (copies
inside a task collapse before the shuffle, so a text that a third of all rows share
sends one row from each task). A shard turns its texts into 64-bit keys (shingles,
window hashes) and sends each key bucket one row: its distinct keys as packed
32-bit integers and, per key, how many of its units (texts or lines) hold it. A
bucket adds up the shards' counts and answers every shard with one row of counts.
The shard, read a second time through the same exchange, then knows the corpus-wide
frequency of each of its keys.

A key that stands in a third of all texts is one entry of each shard's row, never a
row per text. A key is cut to ``32 + log2(buckets)`` bits; buckets grow with the
corpus, so the rate at which two keys fall together stays below about 2e-4 at every
size. Frequencies are therefore upper bounds: they only ever let through too much,
and whatever passes is verified by its 64-bit keys or its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.kernel import order_of, pack_ascending, ranges, text_buffer, unpack_ascending
from tillroll.session import shuffle_partitions

SHARD_BYTES = 2 << 20
MOST = 255  # counts are kept in a byte and stop there


def text_id(text: str = "text") -> str:
    """SQL: the identity of a text; a null counts as empty."""
    return f"md5(CAST(coalesce(`{text}`, '') AS BINARY))"


def sharded_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """(rows of compressed texts by shard, with at least the smallest doc_id of every
    distinct text; number of key buckets)."""
    spark = docs.sparkSession
    size = docs.agg(F.expr(f"sum(octet_length(`{text}`))").alias("b")).head()["b"] or 0
    shards = max(int(size // SHARD_BYTES) + 1, 2 * shuffle_partitions(spark))
    buckets = 256
    while buckets < size // SHARD_BYTES:
        buckets *= 2

    def first_copies(batches):
        codec = pa.Codec("zstd", 1)
        smallest: dict[bytes, int] = {}
        for batch in batches:
            keep = []
            for k, (d, t) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
                h = hashlib.blake2b(t.as_buffer(), digest_size=16).digest()
                if d < smallest.get(h, d + 1):
                    smallest[h] = d
                    keep.append(k)
            kept = batch.take(pa.array(keep, pa.int64())).sort_by("shard")
            if not kept.num_rows:
                continue
            shard, cut = np.unique(kept.column("shard").to_numpy(), return_index=True)
            cut = np.append(cut, kept.num_rows)
            buf, offsets = text_buffer(kept.column("text"))
            ids, sizes = kept.column("doc_id").to_numpy(), np.diff(offsets)
            parts = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array(shard, pa.int32()),
                pa.array([ids[a:b].astype("<i8").tobytes() for a, b in parts], pa.binary()),
                pa.array([sizes[a:b].astype("<i8").tobytes() for a, b in parts], pa.binary()),
                pa.array([codec.compress(buf[offsets[a] : offsets[b]].tobytes(), asbytes=True) for a, b in parts], pa.binary()),
            ], names=["shard", "doc_ids", "sizes", "texts"])

    rows = docs.where(f"`{doc_id}` IS NOT NULL").selectExpr(
        f"CAST(pmod(xxhash64(coalesce(`{text}`, '')), {shards}) AS INT) AS shard", f"CAST(`{doc_id}` AS BIGINT) AS doc_id",
        f"coalesce(`{text}`, '') AS text",
    ).mapInArrow(first_copies, "shard int, doc_ids binary, sizes binary, texts binary")
    return rows.repartition("shard"), buckets


class Shard:
    """The distinct texts of one shard with their smallest ids, in id order."""

    def __init__(self, table: pa.Table):
        codec = pa.Codec("zstd")
        ids = np.frombuffer(b"".join(table.column("doc_ids").to_pylist()), "<i8")
        sizes = [np.frombuffer(x, "<i8") for x in table.column("sizes").to_pylist()]
        data = b"".join(
            codec.decompress(x, int(n.sum()), asbytes=True) if n.sum() else b""
            for x, n in zip(table.column("texts").to_pylist(), sizes)
        )
        size = np.concatenate(sizes)
        ends = np.cumsum(size)
        begins = ends - size
        seen, keep, self.text_ids = set(), [], []
        for k in np.argsort(ids, kind="stable").tolist():
            h = hashlib.md5(data[begins[k] : ends[k]]).hexdigest()
            if h not in seen:
                seen.add(h)
                keep.append(k)
                self.text_ids.append(h)
        self.n = len(keep)
        self.doc_ids = ids[keep]
        self.offsets = np.concatenate([[0], np.cumsum(size[keep])])
        self.buf = np.frombuffer(data, np.uint8)[ranges(begins[keep], size[keep])]

    @property
    def texts(self) -> pa.Array:
        """The texts as a string column."""
        return pa.Array.from_buffers(pa.large_string(), self.n, [
            None, pa.py_buffer(self.offsets.astype(np.int64).tobytes()), pa.py_buffer(self.buf.tobytes())]).cast(pa.string())


def _slots(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Keys cut to bucket bits + 32, as integers."""
    return (keys >> np.uint64(32 - (buckets.bit_length() - 1))).astype(np.uint64)


def frequency_replies(texts: DataFrame, buckets: int, keys_of: Callable) -> DataFrame:
    """``shard, bucket, counts``: corpus-wide frequencies of every shard's keys.

    ``keys_of(Shard)`` returns an object with ``keys``: the 64-bit keys, each as often as
    units of the shard hold it.
    """

    def send(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        slots, _, counts = _sorted(keys_of(Shard(table)).keys, buckets)
        at = np.searchsorted(slots >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
        filled = np.flatnonzero(np.diff(at))
        low = slots.astype(np.uint32)
        n = np.minimum(counts, MOST).astype(np.uint8)
        return pa.table({
            "bucket": pa.array(filled, pa.int32()),
            "shard": pa.array(np.full(len(filled), shard), pa.int32()),
            "keys": pa.array([pack_ascending(low[at[b] : at[b + 1]]) for b in filled], pa.binary()),
            "n": pa.array([n[at[b] : at[b + 1]].tobytes() for b in filled], pa.binary()),
        })

    def add(table: pa.Table) -> pa.Table:
        keys = [unpack_ascending(x) for x in table.column("keys").to_pylist()]
        n = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("n").to_pylist()])
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.minimum(np.bincount(inverse, n), MOST).astype(np.uint8)[inverse]
        cuts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        return pa.table({
            "shard": table.column("shard"), "bucket": table.column("bucket"),
            "counts": pa.array([total[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
        })

    sent = texts.groupBy("shard").applyInArrow(send, "bucket int, shard int, keys binary, n binary")
    return sent.groupBy("bucket").applyInArrow(add, "shard int, bucket int, counts binary")


def _sorted(keys: np.ndarray, buckets: int):
    slots = _slots(keys, buckets)
    order = order_of(slots, 32 + buckets.bit_length() - 1)
    slots = slots[order]
    new = np.ones(len(slots), bool)
    new[1:] = slots[1:] != slots[:-1]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return slots[new], inverse, np.diff(np.append(np.flatnonzero(new), len(slots)))


def with_frequencies(texts: DataFrame, buckets: int, keys_of: Callable, then: Callable, schema: str) -> DataFrame:
    """Run ``then(shard, what keys_of returned, frequency of each key)`` on every shard;
    it returns a table of ``schema``."""
    replies = frequency_replies(texts, buckets, keys_of)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = Shard(left)
        found = keys_of(shard)
        counts = right.sort_by("bucket").column("counts").to_pylist()
        total = np.frombuffer(b"".join(counts), np.uint8)
        _, inverse, _ = _sorted(found.keys, buckets)
        return then(shard, found, total[inverse] if len(inverse) else np.zeros(0, np.uint8))

    return texts.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(finish, schema)


def hashes_to_bytes(keys: np.ndarray, bounds: np.ndarray, pick: np.ndarray) -> list[bytes | None]:
    """The keys of the picked units as packed 64-bit integers; None for the others."""
    raw = keys.astype("<u8").tobytes()
    return [raw[8 * a : 8 * b] if p else None for a, b, p in zip(bounds[:-1].tolist(), bounds[1:].tolist(), pick.tolist())]

