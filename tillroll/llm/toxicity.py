"""Toxicity scores of deobfuscated text.

A noisy channel writes letters as look-alikes (``1d10t``), stretches them
(``idiooot``) or spaces them out (``i d i o t``, ``i.d.i.o.t``, ``id iot``). A token
that shows such signs becomes a lattice of characters: each look-alike may stand for
its letters or for itself, a run of three or more equal letters or look-alikes for one
or two. A run of pieces of up to ``PIECE`` characters becomes one lattice with its
separators: each is dropped or is a word edge, and one unlike most of its run is
rather an edge. The best path under a character trigram model of the whole corpus
(Viterbi over the last two characters) is the restored token. A trigram model often
cannot tell ``a moron`` from ``a mor on``: the words of a run are those of all its
readings within ``MARGIN`` of the best. Ordinary prose is full of short words side by
side (``of it is``): a run is a sign of the channel only if one of its pieces is no
ordinary word, that is a word of up to ``PIECE`` characters that makes up at least
``ORDINARY`` of all words of the corpus (``ORDINARY_LETTER`` for one character).

The score then comes from indicators: restored words, and their first 4 to 8
characters. Candidates stand in ``LEAST_TEXTS`` toxic training texts and lean to the
label; the ``CANDIDATES`` that tell most about it enter a logistic regression with an
L2 penalty, whose input is how many different words of the text show the indicator
(``MOST_WORDS`` count at most). The score is its probability. Label, language, source
and id are never inputs.

Training reads at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash
of their id, each text once; the character model counts every document.

Defined results: a null or empty text has no indicator; repeated rows score alike;
without labelled rows, or with none that is toxic, every score is 0
(below 1e-200). Extra columns pass through, but for those named like the added
ones.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.kernel import LOWER, text_blocks, word_bounds

TRAIN_ROWS = 20_000
HELD_OUT = "coalesce(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) = 2, false)"
THRESHOLD = 0.3
PRIOR_ROWS = 10.0
LEAST_TEXTS = 4
CANDIDATES = 4_000
MOST_WORDS = 4
PENALTY = 2.0
STEPS = 400
CACHE_TOKENS = 600_000

# fixed values: what each look-alike may stand for
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
SUBSTITUTED, KEPT, STRETCHED = -1.0, -9.0, -0.5  # channel costs
DROPPED, DROPPED_ODD = -0.5, -4.0  # a separator that is like most of its run, and another one
SPLIT = -2.0  # a word edge between two single characters, at a separator like most of its run
PIECE = 3
ORDINARY, ORDINARY_LETTER = 1e-5, 1e-3
READINGS, MARGIN = 8, 5.0  # of a run: paths kept for each state, and how far they may be behind the best

NEVER = -500.0  # intercept of a model that saw no toxic text: probability 0

N_CLASSES = 28  # 0: word edge, 1-26: a-z, 27: any other character of a word
_CLASS = np.zeros(256, np.int64)
_CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x41:0x5B] = np.arange(1, 27)
_CLASS[0x30:0x3A] = 27
_CLASS[0x80:] = 27

_EDGE = " \t\r\n\v\f.,;:?\"'`*#%&()[]{}<>=~^/\\-_"
_SIGN = r"(?:[^\W_]|[" + re.escape("".join(x for x in LEET if not x.isalnum())) + "])"
_GAP = r"[\s.\-_*]{1,3}"
_SPACED = re.compile(rf"(?<!{_SIGN}){_SIGN}{{1,{PIECE}}}(?:{_GAP}{_SIGN}{{1,{PIECE}}}(?!{_SIGN}))+")
_INNER = np.ones(256, bool)  # bytes of a token without its edge characters
_INNER[[*_EDGE.encode(), *range(0x20)]] = False
_TOKEN = re.compile(r"\S+")
_GAPS = re.compile(f"({_GAP})")
_RUN = re.compile(r"([^\W\d_])\1\1+")
_LOOKALIKE = re.compile("[" + re.escape("".join(LEET)) + "]")
_LETTER = re.compile(r"[a-z]")


def corpus_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(code, word, n)`` in one pass over all texts: trigrams of character classes
    (``code`` from 0, at most 28 cubed rows), all words (``code`` -1), and each word of up to
    ``PIECE`` characters (``word``)."""

    def run(batches):
        for batch in batches:
            total, n_words = np.zeros(N_CLASSES**3, np.int64), 0
            words, times = [], []
            for _, _, buf, offsets in text_blocks(batch, text):
                c = np.concatenate([[0, 0], _CLASS[buf], [0]])
                code = (c[:-2] * N_CLASSES + c[1:-1]) * N_CLASSES + c[2:]
                total += np.bincount(code, minlength=N_CLASSES**3)
                starts, ends = word_bounds(buf, offsets, _INNER)
                n_words += len(starts)
                character = np.append(0, np.cumsum((buf & 0xC0) != 0x80))
                short = character[ends] - character[starts] <= PIECE
                at, size = starts[short], (ends - starts)[short]
                spelled = np.zeros((len(at), 4 * PIECE), np.uint8)
                for k in range(4 * PIECE):
                    held = size > k
                    spelled[held, k] = LOWER[buf[at[held] + k]]
                found, n = np.unique(spelled.view(f"S{4 * PIECE}").ravel(), return_counts=True)
                words += found.tolist()
                times += n.tolist()
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*at.tolist(), -1, *[None] * len(words)], pa.int64()),
                 pa.array([*[None] * (len(at) + 1), *(w.decode() for w in words)], pa.string()),
                 pa.array([*total[at].tolist(), n_words, *times], pa.int64())], names=["code", "word", "n"])

    counted = docs.select(text).mapInArrow(run, "code bigint, word string, n bigint")
    return counted.groupBy("code", "word").agg(F.sum("n").alias("n"))


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(code, n)``: trigrams of character classes over all texts."""
    return corpus_counts(docs, text).where("code >= 0").select("code", "n")


def ordinary_words(counted: DataFrame) -> frozenset[str]:
    """The ordinary short words among :func:`corpus_counts`; at most ``1 / ORDINARY``."""
    every = counted.where("code = -1").agg(F.sum("n").alias("n")).head()["n"] or 0
    share = F.when(F.char_length("word") == 1, ORDINARY_LETTER).otherwise(ORDINARY)
    return frozenset(r.word for r in counted.where(F.col("word").isNotNull() & (F.col("n") >= share * F.lit(every))).collect())


def short_words(docs: DataFrame, text: str = "text") -> frozenset[str]:
    """The ordinary short words of a corpus."""
    return ordinary_words(corpus_counts(docs, text))


def character_model(counts: list[tuple[int, int]]) -> list:
    """Interpolated trigram log probabilities ``[a][b][c]`` from class trigram counts."""
    n = np.zeros(N_CLASSES**3)
    for code, k in counts:
        n[code] = k
    n = n.reshape(N_CLASSES, N_CLASSES, N_CLASSES)
    uni = (n.sum((0, 1)) + 1) / (n.sum() + N_CLASSES)
    two = n.sum(0)
    bi = (two + 5 * uni) / (two.sum(1, keepdims=True) + 5)
    return np.log((n + 5 * bi) / (n.sum(2, keepdims=True) + 5)).tolist()


def _class(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 27


def _signs(token: str) -> list[list[tuple[str, float]]]:
    """The readings of each sign of a lower-case token, with their channel costs."""
    lattice: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        ch, j = token[i], i
        while j < len(token) and token[j] == ch:
            j += 1
        if j - i >= 3 and ch.isalpha():
            lattice.append([(ch, STRETCHED), (ch + ch, STRETCHED)])
        elif j - i >= 3 and ch in LEET:
            lattice.append([(x * n, SUBSTITUTED + STRETCHED) for x in LEET[ch] for n in (1, 2)] + [(token[i:j], KEPT)])
        else:
            j = i + 1
            if ch in LEET:
                lattice.append([(x, SUBSTITUTED) for x in LEET[ch]] + [(ch, KEPT)])
            else:
                lattice.append([(ch, 0.0)])
        i = j
    return lattice


def _best(lattice: list[list[tuple[str, float]]], model: list, most: int = 1) -> list[str]:
    """The best paths, best first: ``most`` for each end of a path, those within
    ``MARGIN`` of the best; a space is a word edge."""
    paths: dict[tuple[int, int], list[tuple[float, tuple]]] = {(0, 0): [(0.0, ())]}
    for options in [*lattice, [(" ", 0.0)]]:
        new: dict[tuple[int, int], list[tuple[float, tuple]]] = {}
        for (a, b), ends in paths.items():
            for written, cost in options:
                x, y, gain = a, b, cost
                for ch in written:
                    c = 0 if ch == " " else _class(ch)
                    gain += model[x][y][c]
                    x, y = y, c
                new.setdefault((x, y), []).extend((score + gain, (so_far, written)) for score, so_far in ends)
        paths = {at: sorted(ends, key=lambda p: -p[0])[:most] if len(ends) > 1 else ends for at, ends in new.items()}
    found = sorted((p for ends in paths.values() for p in ends), key=lambda p: -p[0])
    out = []
    for score, path in found if most > 1 else found[:1]:
        if score < found[0][0] - MARGIN:
            break
        written = []
        while path:
            path, last = path
            written.append(last)
        out.append("".join(reversed(written)).rstrip(" "))
    return out


def restore(token: str, model: list) -> str:
    """The best reading of one lower-case token under the character model."""
    return _best(_signs(token), model)[0]


def restore_run(run: str, model: list, most: int = 1) -> list[str]:
    """The best readings of a run of spaced pieces: words with a space between them."""
    parts = _GAPS.split(run)
    usual = Counter(parts[1::2]).most_common(1)[0][0] if len(parts) > 1 else ""
    lattice = []
    for k, part in enumerate(parts):
        if k % 2 == 0:
            lattice += _signs(part)
        elif part == usual:
            lattice.append([("", DROPPED), (" ", SPLIT if len(parts[k - 1]) == len(parts[k + 1]) == 1 else 0.0)])
        else:
            lattice.append([("", DROPPED_ODD), (" ", 0.0)])
    return _best(lattice, model, most)


def suspicious(token: str) -> bool:
    """Signs of the channel: a look-alike among letters, or a stretched letter."""
    return bool((_LOOKALIKE.search(token) and _LETTER.search(token)) or _RUN.search(token))


def spaced(run: str, ordinary: frozenset[str] = frozenset()) -> bool:
    """Whether a run of short pieces is a sign of the channel: some piece is no
    ordinary word, and it holds a letter."""
    return not ordinary.issuperset(_GAPS.split(run)[::2]) and bool(_LETTER.search(run))


def _core(token: str) -> str:
    """A token without the characters at its ends that part no pieces or stand between them."""
    return token.strip(",;:?\"'.-_*")


def runs_of(low: str, tokens: set[str], ordinary: frozenset[str]) -> set[str]:
    """The runs of spaced pieces of a lower-case text that are a sign of the channel.

    Most tokens are an ordinary short word or a longer one, which is no piece. Runs are
    looked for around the others only, up to the next longer words on both sides,
    which no run crosses.
    """
    odd, longer = set(), set()
    for token in tokens:
        core = _core(token)
        if core.isalpha() and len(core) > PIECE:
            longer.add(token)
        elif core and core not in ordinary:
            odd.add(token)
    if not odd:
        return set()
    spots = [m.span() for m in _TOKEN.finditer(low)]
    words = [low[a:b] for a, b in spots]
    found, done = set(), -1
    for k, word in enumerate(words):
        if k <= done or word not in odd:
            continue
        first = last = k
        while first and words[first - 1] not in longer:
            first -= 1
        while last + 1 < len(words) and words[last + 1] not in longer:
            last += 1
        done = last
        found.update(m.group(0) for m in _SPACED.finditer(low[spots[first][0] : spots[last][1]]))
    return {run for run in found if spaced(run, ordinary)}


def words_of(text: str, ordinary: frozenset[str] = frozenset()) -> list[str]:
    """The different lower-case tokens of a text without their edges, then its runs of
    spaced pieces as they stand."""
    low = text.lower()
    tokens = set(low.split())
    return [*{t.strip(_EDGE) for t in tokens}, *runs_of(low, tokens, ordinary)]


def restored_word(token: str, model: list) -> str:
    word = token.strip(_EDGE)
    if suspicious(word):
        word = restore(word, model)
    return word.strip(_EDGE + "!|+$@")


def restored_words(token: str, model: list) -> list[str]:
    """The words of a token, or of a run of spaced pieces, that indicators are made of."""
    if not _GAPS.search(token):
        return [restored_word(token, model)]
    pieces = {x.strip(_EDGE) for x in token.split()}
    if len(pieces) < 2 and not _SPACED.fullmatch(token):
        return [restored_word(token, model)]
    # a piece that stands alone is a token of its own
    words = (x.strip(_EDGE + "!|+$@") for reading in restore_run(token, model, READINGS) for x in reading.split(" "))
    return [w for w in dict.fromkeys(words) if w not in pieces]


def indicators_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}~" for k in (4, 5, 6, 7, 8) if len(word) > k)] if len(word) > 2 else []


def deobfuscate(text: str, model: list, ordinary: frozenset[str] = frozenset()) -> str:
    """The whole text with every suspicious token replaced by its best reading."""
    text = _SPACED.sub(lambda m: restore_run(m.group(0), model)[0] if spaced(m.group(0), ordinary) else m.group(0), text.lower())
    return re.sub(r"\S+", lambda m: restored_word(m.group(0), model) if suspicious(m.group(0).strip(_EDGE)) else m.group(0), text)


class Reader:
    """What the words of a text are, with the tokens that this worker has read before (at
    most ``CACHE_TOKENS``; they stay behind when a reader travels)."""

    def __init__(self, model: list, ordinary: frozenset[str]):
        self.model, self.ordinary, self.known = model, ordinary, {}

    def __reduce__(self):
        return type(self), (self.model, self.ordinary)

    def look(self, token: str) -> tuple:
        if token.isalpha() and not _RUN.search(token):
            return (token,) if len(token) > 2 else ()
        return tuple(w for w in restored_words(token, self.model) if len(w) > 2)

    def read(self, text: str | None) -> list[tuple]:
        """What :meth:`look` says of every token of a text."""
        known, out = self.known, []
        if len(known) > CACHE_TOKENS:
            known.clear()
        for token in words_of(text or "", self.ordinary):
            got = known.get(token)
            if got is None:
                got = known[token] = self.look(token)
            if got:
                out.append(got)
        return out

    def words(self, text: str | None) -> set[str]:
        return {w for words in self.read(text) for w in words}


class Scorer(Reader):
    """A reader that keeps only the words with indicators of the regression."""

    def __init__(self, model: list, ordinary: frozenset[str], weights: dict[str, float], intercept: float):
        super().__init__(model, ordinary)
        self.weights, self.intercept, self.copies = weights, intercept, {}
        self.begin = {x[:3] for x in weights}  # every indicator of a word begins as the word does

    def __reduce__(self):
        return Scorer, (self.model, self.ordinary, self.weights, self.intercept)

    def look(self, token: str) -> tuple:
        shown = ((w, tuple(x for x in indicators_of(w) if x in self.weights)) for w in super().look(token) if w[:3] in self.begin)
        return tuple(x for x in shown if x[1])

    def score(self, text: str | None) -> float:
        """The score of a text; a copy of one that the worker has read is not read again."""
        digest = hashlib.blake2b((text or "").encode(), digest_size=16).digest()
        got = self.copies.get(digest)
        if got is None:
            if len(self.copies) > CACHE_TOKENS:
                self.copies.clear()
            got = self.copies[digest] = self._score(text)
        return got

    def _score(self, text: str | None) -> float:
        found: dict[str, int] = {}
        for word, shown in dict.fromkeys(x for words in self.read(text) for x in words):
            for x in shown:
                found[x] = found.get(x, 0) + 1
        total = self.intercept + sum(self.weights[x] * math.log1p(min(n, MOST_WORDS)) for x, n in found.items())
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def _count_indicators(reader):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                toxic, all_ = Counter(), Counter()
                part = batch.slice(at, 256)
                for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    found = {x for w in reader.value.words(text) for x in indicators_of(w)}
                    all_.update(found)
                    if label:
                        toxic.update(found)
                keys = list(all_)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                     pa.array([all_[k] for k in keys], pa.int64())], names=["indicator", "toxic", "n"])

    return run


def _find(reader, number: dict[str, int]):
    def run(batches):
        for batch in batches:
            # how many different words of the text show each wanted indicator
            found = [Counter(x for w in reader.value.words(t.as_py()) for x in indicators_of(w) if x in number) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("toxic"),
                pa.array([[number[x] for x in f] for f in found], pa.list_(pa.int32())),
                pa.array([[min(n, MOST_WORDS) for n in f.values()] for f in found], pa.list_(pa.int32())),
            ], names=["toxic", "found", "times"])

    return run


def regression(rows: list[tuple[int, list[int], list[int]]], size: int) -> tuple[np.ndarray, float]:
    """(weights, intercept) of an L2-penalised logistic regression by accelerated
    gradient steps; rows are (label, input numbers, input values)."""
    label = np.array([r[0] > 0 for r in rows], float)
    owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    column = np.array([k for r in rows for k in r[1]], np.int64)
    value = np.log1p([v for r in rows for v in r[2]]) if len(column) else np.zeros(0)
    norms = np.bincount(owner, value**2, minlength=len(rows)) + 1
    step = 1.0 / (0.25 * norms.mean() * np.bincount(column, minlength=size).max(initial=1) + PENALTY)
    w, b = np.zeros(size), float(np.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5)))
    w_at, b_at, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        miss = 1 / (1 + np.exp(-(np.bincount(owner, value * w_at[column], minlength=len(rows)) + b_at))) - label
        w_new = w_at - step * (np.bincount(column, value * miss[owner], minlength=size) + PENALTY * w_at)
        b_new = b_at - miss.sum() / (0.25 * len(rows) + 1) * 0.5
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        if ((w_at - w_new) @ (w_new - w)) > 0:  # overshot: start the acceleration anew
            t_new = 1.0
        w_at = w_new + (t - 1) / t_new * (w_new - w)
        b_at = b_new
        w, b, t = w_new, b_new, t_new
    return w, b


def fit(docs: DataFrame, labels: DataFrame) -> tuple[list, frozenset[str], dict[str, float], float]:
    """(character model, ordinary short words, indicator weights, intercept).

    ``docs(doc_id, text)``; ``labels(doc_id, toxic)``. Held-out rows are never read.
    """
    counted = corpus_counts(docs).persist()  # executors' memory or disk, recomputed if lost
    try:
        model = character_model([tuple(r) for r in counted.where("code >= 0").select("code", "n").collect()])
        ordinary = ordinary_words(counted)
    finally:
        counted.unpersist()
    reader = docs.sparkSession.sparkContext.broadcast(Reader(model, ordinary))  # at most 1 / ORDINARY words
    rows = (
        labels.where(f"toxic IS NOT NULL AND NOT {HELD_OUT}").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    )
    # at most TRAIN_ROWS ids: a bounded broadcast
    train = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").groupBy(
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")
    ).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    train = train.persist()
    try:
        totals = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).head()
        share = totals["t"] / totals["n"] if totals["n"] else 0.0
        if not totals["t"]:
            return model, ordinary, {}, NEVER
        counted = (
            train.mapInArrow(_count_indicators(reader), "indicator string, toxic bigint, n bigint")
            .groupBy("indicator").agg(F.sum("toxic").alias("t"), F.sum("n").alias("n"))
        )
        weight = (F.col("t") + PRIOR_ROWS * share) / (F.col("n") + PRIOR_ROWS)
        # the CANDIDATES whose presence tells most about the label (a fixed bound)
        n, t = F.col("n"), F.col("t")
        gain = t * F.log((t + PRIOR_ROWS * share) / (n + PRIOR_ROWS) / share)
        names = [
            r["indicator"] for r in counted.where(t >= LEAST_TEXTS).select("indicator", gain.alias("g"))
            .where("g > 0").orderBy(F.desc("g"), "indicator").limit(CANDIDATES).collect()
        ]
        found = train.mapInArrow(_find(reader, {x: k for k, x in enumerate(names)}), "toxic int, found array<int>, times array<int>")
        rows = [(r["toxic"], r["found"], r["times"]) for r in found.collect()]  # at most TRAIN_ROWS
        w, intercept = regression(rows, len(names))
        return model, ordinary, {x: float(v) for x, v in zip(names, w) if abs(v) > 1e-3}, intercept
    finally:
        train.unpersist()


def _score(scorer, own: list[str]):
    def run(batches):
        for batch in batches:
            scores = [scorer.value.score(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), pa.array(scores, pa.float64())], names=[*own, "score"])

    return run


def score(docs: DataFrame, fitted: tuple[list, frozenset[str], dict[str, float], float], text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus ``score`` (0 to 1) and ``predicted``."""
    own = [c for c in docs.columns if c not in (text, "score", "predicted")]
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType, True) for c in own] + [T.StructField("score", T.DoubleType())])
    source = docs.select(*own, F.col(text).alias("text") if "text" not in own else F.col(text))
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(*fitted))  # bounded: see fit
    return source.mapInArrow(_score(scorer, own), schema).withColumn("predicted", F.expr(f"IF(score >= {THRESHOLD}D, 1, 0)"))
