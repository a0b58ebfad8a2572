"""Benchmark decontamination with one FM-index per shard of training text.

A shard is an Arrow batch of texts. Its words become symbols of the benchmark's
vocabulary; a word outside it ends a run, and only runs long enough to hold a
test phrase are indexed (no other word can be part of a hit). Over the indexed
runs stand a suffix array, its Burrows-Wheeler transform in a wavelet matrix with
rank tables, and suffix positions sampled every ``SAMPLE`` symbols and at run
starts. All phrases are searched backwards at once; found rows walk to a sampled
position; hits merge into spans.

A phrase is ``window`` consecutive words of an item; an item with fewer words,
but not none, is one phrase. Words are ``[0-9a-z]`` and non-ASCII characters after
A-Z became a-z, and are compared by 64-bit hashes.

The benchmark is read in blocks of about ``BLOCK_BYTES`` of item text, each searched in
a pass of its own (narrow, no shuffle). Between two passes the rows are written to the
shared folder, so driver and tasks hold one block at a time, however large the
benchmark; a benchmark of one block, the usual case, is one lazy pass.

Defined results: a null or empty text has no words and no hit; repeated rows are
judged one by one; an empty benchmark hits nothing; an item with a null id is
listed as ``null``; ties do not arise. Extra columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import written
from tillroll.llm.kernel import ALNUM_WORDS, ranges, span_hashes, text_blocks, text_buffer, word_bounds

SAMPLE = 16
BLOCK_BYTES = 4 << 20
END, BREAK, FIRST = 0, 1, 2  # symbols: end of the shard, break between runs, vocabulary


class Phrases:
    """The distinct phrases of one benchmark block, by length, with their items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        column = pa.array([t or "" for _, t in items], pa.large_string())
        buf, offsets = text_buffer(column)
        starts, ends = word_bounds(buf, offsets, ALNUM_WORDS)
        hashes = span_hashes(buf, starts, ends, True)
        first = np.searchsorted(starts, offsets)
        self.ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        self.vocabulary, symbols = np.unique(hashes, return_inverse=True)
        found: dict[bytes, set[int]] = {}
        symbols = symbols.astype(np.int32) + FIRST
        for k, (item, _) in enumerate(items):
            s = symbols[first[k] : first[k + 1]]
            size = min(window, len(s))
            for p in range(len(s) - size + 1 if size else 0):
                found.setdefault(s[p : p + size].tobytes(), set()).add(number[item])
        self.groups = []
        for size in sorted({len(b) // 4 for b in found}):
            keys = [b for b in found if len(b) == 4 * size]
            owners = [sorted(found[b]) for b in keys]
            self.groups.append((
                size,
                np.frombuffer(b"".join(keys), np.int32).reshape(-1, size),
                np.concatenate([[0], np.cumsum([len(o) for o in owners])]),
                np.array([x for o in owners for x in o], np.int64),
            ))
        self.shortest = self.groups[0][0] if self.groups else 0
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words; BREAK where a word is outside the vocabulary."""
        out = np.full(len(hashes), BREAK, np.int32)
        maybe = np.flatnonzero(self.filter[(hashes >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == hashes[maybe]
        out[maybe[same]] = at[same] + FIRST
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; every break is a symbol of its own."""
    n = len(text)
    breaks = text <= BREAK
    rank = text.astype(np.int64) + n
    rank[breaks] = np.cumsum(breaks)[breaks]
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, step = new, step * 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class FMIndex:
    """Backward search and locate over one shard's runs."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        before = text[order - 1]
        self.levels = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        current = before
        for level in reversed(range(self.levels)):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        self.smaller = np.searchsorted(np.sort(text), np.arange(symbols + 1))
        run_start = before <= BREAK
        kept = run_start | (order % SAMPLE == 0)
        self.kept = kept
        self.kept_rank = np.cumsum(kept) - 1
        self.position = order[kept]
        self.n = len(text)

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place of the transform."""
        low = np.zeros(len(symbol), np.int64)
        high = at
        for k in range(self.levels):
            ones, bit = self.ones[k], (symbol >> (self.levels - 1 - k)) & 1 == 1
            low = np.where(bit, self.zeros[k] + ones[low], low - ones[low])
            high = np.where(bit, self.zeros[k] + ones[high], high - ones[high])
        return high - low

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of the patterns (one per row of the matrix)."""
        m = len(patterns)
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        live = np.arange(m)
        for k in reversed(range(patterns.shape[1])):
            c = patterns[live, k]
            low[live] = self.smaller[c] + self._rank(c, low[live])
            high[live] = self.smaller[c] + self._rank(c, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking to sampled positions."""
        out, steps = np.empty(len(rows), np.int64), 0
        open_, at = np.arange(len(rows)), rows
        while len(open_):
            done = self.kept[at]
            out[open_[done]] = self.position[self.kept_rank[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            low, symbol = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for k in range(self.levels):
                ones = self.ones[k]
                bit = ones[at + 1] - ones[at] == 1
                symbol = symbol * 2 + bit
                low = np.where(bit, self.zeros[k] + ones[low], low - ones[low])
                at = np.where(bit, self.zeros[k] + ones[at], at - ones[at])
            at = self.smaller[symbol] + at - low
            steps += 1
        return out


def find(hashes: np.ndarray, first: np.ndarray, phrases: Phrases):
    """(hit word mask, texts, items): which words lie in hits, and the distinct
    (text, item number) pairs, of texts given as word hashes with bounds."""
    hit = np.zeros(len(hashes), bool)
    none = np.zeros(0, np.int64)
    if not phrases.groups or len(hashes) < phrases.shortest:
        return hit, none, none
    symbols = phrases.symbols(hashes)
    inside = symbols >= FIRST
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begin = first[:-1][np.diff(first) > 0]
    starts[begin] = inside[begin]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    stop = first[1:][np.diff(first) > 0] - 1
    ends[stop] = inside[stop]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long_ = ends - starts >= phrases.shortest
    starts, sizes = starts[long_], (ends - starts)[long_]
    if not len(starts):
        return hit, none, none
    words = ranges(starts, sizes)
    # runs, each followed by a break, then the end symbol
    place = np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)
    text = np.full(len(words) + len(sizes) + 1, BREAK, np.int32)
    text[place] = symbols[words]
    text[-1] = END
    origin = np.full(len(text), -1, np.int64)
    origin[place] = words
    index = FMIndex(text, len(phrases.vocabulary) + FIRST)
    delta = np.zeros(len(hashes) + 1, np.int64)
    texts, items = [], []
    for size, patterns, owner_at, owners in phrases.groups:
        low, high = index.search(patterns)
        found = np.flatnonzero(high > low)
        if not len(found):
            continue
        counts = (high - low)[found]
        where = origin[index.locate(ranges(low[found], counts))]
        np.add.at(delta, where, 1)
        np.add.at(delta, where + size, -1)
        pair = np.unique(np.stack([np.searchsorted(first, where, side="right") - 1, np.repeat(found, counts)]), axis=1)
        n = owner_at[pair[1] + 1] - owner_at[pair[1]]
        texts.append(np.repeat(pair[0], n))
        items.append(owners[ranges(owner_at[pair[1]], n)])
    hit = np.cumsum(delta[:-1]) > 0
    if not texts:
        return hit, none, none
    pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(items)]), axis=1)
    return hit, pairs[0], pairs[1]


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    """Union of byte spans, flattened; spans touch only across a break."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _scan(phrases: Phrases, text: str, own: list[str]):
    """The pass of one benchmark block: adds what it finds to __spans and __items."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            spans = batch.column("__spans").to_pylist()
            items = batch.column("__items").to_pylist()
            n_hit = batch.column("__n_hit").to_numpy(zero_copy_only=False).copy()
            n_words = np.zeros(batch.num_rows, np.int64)
            hashes, bounds, begins, finishes = [], [np.zeros(1, np.int64)], [], []
            total = 0
            for i, j, buf, offsets in text_blocks(batch, text):
                starts, ends = word_bounds(buf, offsets, ALNUM_WORDS)
                first = np.searchsorted(starts, offsets)
                n_words[i:j] = np.diff(first)
                hashes.append(span_hashes(buf, starts, ends, True))
                bounds.append(first[1:] + total)
                total += len(starts)
                base = np.repeat(offsets[:-1], np.diff(first))
                begins.append((starts - base).astype(np.int32))
                finishes.append((ends - base).astype(np.int32))
            first = np.concatenate(bounds)
            hit, owner, item = find(np.concatenate(hashes), first, phrases)
            if len(owner):
                begin, finish = np.concatenate(begins), np.concatenate(finishes)
                for d in np.unique(owner):
                    a, b = first[d], first[d + 1]
                    h = np.concatenate([[False], hit[a:b], [False]])
                    edge = np.flatnonzero(h[1:] != h[:-1])
                    new = [(int(begin[a + s]), int(finish[a + e - 1])) for s, e in zip(edge[::2], edge[1::2])]
                    spans[d] = _merge([*zip(spans[d][::2], spans[d][1::2]), *new])
                    edges = np.searchsorted(begin[a:b], spans[d])
                    n_hit[d] = int((edges[1::2] - edges[::2]).sum())
                for d, k in zip(owner, item):
                    items[d].append(phrases.ids[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own]
                + [pa.array(n_words), pa.array(n_hit), pa.array(spans, pa.list_(pa.int64())),
                   pa.array(items, pa.list_(pa.string()))],
                names=[*own, "__n_words", "__n_hit", "__spans", "__items"],
            )

    return run


def _phrase_blocks(benchmark: DataFrame, item_id: str, text: str, window: int):
    """One Phrases per block of benchmark text, the blocks fixed by item hash."""
    items = benchmark.selectExpr(f"coalesce(CAST(`{item_id}` AS STRING), 'null') AS i", f"coalesce(`{text}`, '') AS t")
    size = items.agg(F.expr("sum(octet_length(t))").alias("b")).head()["b"] or 0
    n = int(size // BLOCK_BYTES) + 1
    for k in range(n):
        block = items if n == 1 else items.where(f"pmod(xxhash64(i, t), {n}) = {k}")
        yield Phrases([(r["i"], r["t"]) for r in block.distinct().collect()], window)


def scan_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
              item_text: str = "text", window: int = 10) -> DataFrame:
    """``docs`` plus ``__n_words``, ``__n_hit``, ``__spans`` (flat list of start and end
    bytes of the merged hits) and ``__items`` (ids of the items with a hit), row by row."""
    added = ("__n_words", "__n_hit", "__spans", "__items")
    own = [c for c in docs.columns if c not in added]
    out = docs.selectExpr(*[f"`{c}`" for c in own], "0L AS __n_words", "0L AS __n_hit",
                          "CAST(array() AS ARRAY<BIGINT>) AS __spans", "CAST(array() AS ARRAY<STRING>) AS __items")
    schema = T.StructType(
        [T.StructField(c, docs.schema[c].dataType, True) for c in own]
        + [T.StructField("__n_words", T.LongType()), T.StructField("__n_hit", T.LongType()),
           T.StructField("__spans", T.ArrayType(T.LongType())), T.StructField("__items", T.ArrayType(T.StringType()))]
    )
    for k, phrases in enumerate(_phrase_blocks(benchmark, item_id, item_text, window)):
        if k:  # one block of phrases at a time, in the driver and in every task
            out = written(out, "phrase-hits")
        out = out.mapInArrow(_scan(phrases, text, own), schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **how) -> DataFrame:
    """Per row of ``docs``: its other columns, ``n_words``, ``n_hit`` (words inside any
    hit), ``item_ids`` (sorted) and ``spans`` (flat start and end bytes)."""
    found = scan_hits(docs, benchmark, text=text, **how)
    own = [c for c in docs.columns if c not in ("n_words", "n_hit", "item_ids", "spans")]
    return found.selectExpr(*[f"`{c}`" for c in own], "__n_words AS n_words", "__n_hit AS n_hit",
                            "array_sort(array_distinct(__items)) AS item_ids", "__spans AS spans")


def remove_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **how) -> DataFrame:
    """``docs`` with every merged hit span cut from ``text``; what stands on both
    sides of a cut is parted by a line break. Texts without a hit keep every byte."""
    found = scan_hits(docs, benchmark, text=text, **how)
    blob = f"CAST(`{text}` AS BINARY)"
    # pieces between the spans: [0, s0), [e0, s1), ... [en, end)
    cut = (
        "array_join(transform(sequence(0, size(__spans) DIV 2), i -> CAST(substring("
        f"{blob}, CAST(IF(i = 0, 0, __spans[2 * i - 1]) AS INT) + 1, "
        f"CAST(IF(2 * i < size(__spans), get(__spans, 2 * i), octet_length(`{text}`)) "
        "- IF(i = 0, 0, __spans[2 * i - 1]) AS INT)) AS STRING)), '\\n')"
    )
    return found.selectExpr(*[
        f"IF(size(__spans) = 0, `{c}`, {cut}) AS `{c}`" if c == text else f"`{c}`" for c in docs.columns
    ])
