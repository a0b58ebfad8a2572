"""Every registered query without SQL over the smallest tables, and the operators behind
them on rows with null ids, a very long text and clashing columns, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import ROWS, brute_components, brute_substrings, lower, words_of

from tillroll.llm import crossent, linejoin, queries, sigtree, suffixes, tokenio, toxicity, unigram

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def line_digest(rows):
    """Lines with an earlier match, through an inverted index of shingles."""
    index, sets, out = defaultdict(list), [], {}
    for i, text in sorted({(i, t or "") for i, t in rows}):
        keep, n, gone = [], 0, 0
        for line in text.split("\n"):
            w = words_of(lower(line))
            if not w:
                keep.append(line)
                continue
            n += 1
            s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
            shared = Counter(q for g in s for q in index[g])
            hit = any(5 * k >= 4 * (len(s) + len(sets[q]) - k) for q, k in shared.items())
            for g in s:
                index[g].append(len(sets))
            sets.append(s)
            gone += hit
            if not hit:
                keep.append(line)
        out[i] = (n, gone, hashlib.sha256("\n".join(keep).encode()).hexdigest())
    return out


def losses(rows, wanted):
    """{doc_id: (words, target loss without the own text, background loss)} of distinct ids."""
    texts = {i: lower(t).split() if t else [] for i, t in rows}
    count = lambda w: (Counter(w), Counter([None, *w][: len(w)]), Counter(zip([None, *w], w)))
    target, everything = [Counter(), Counter(), Counter()], [Counter(), Counter(), Counter()]
    for i, w in texts.items():
        for k, c in enumerate(count(w)):
            everything[k].update(c)
            if i in wanted:
                target[k].update(c)
    size = len(everything[0]) + 2

    def loss(model, less, w):
        words, contexts, pairs = model
        a, b, c = less
        total = words.total() - a.total()
        each = [-np.log((pairs[x, y] - c[x, y] + 4 * (words[y] - a[y] + 0.1) / (total + 0.1 * size)) / (contexts[x] - b[x] + 4))
                for x, y in zip([None, *w], w)]
        return sum(each) / max(1, len(w))

    none = (Counter(), Counter(), Counter())
    return {i: (len(w), loss(target, count(w) if i in wanted else none, w), loss(everything, none, w)) for i, w in texts.items()}


def ids_digest(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out, at = [], 0
    for i, text in sorted(((i, x or "") for i, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


# ---------------------------------------------------------------- the registered queries
def test_op2(spark, whole):
    got = queries.op2_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in whole)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op3(spark, whole):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in queries.op3_line_dedup(spark, SF).collect()}
    assert got == line_digest(whole)


def test_op4(spark, whole):
    wanted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    got = {r.doc_id: (r.n_words, r.target_loss, r.background_loss, r.score) for r in queries.op4_cross_entropy(spark, SF).collect()}
    want = losses(whole, wanted)
    assert set(got) == set(want)
    for i, (n, a, b) in want.items():
        assert got[i][0] == n and np.allclose(got[i][1:], (a, b, b - a), rtol=1e-9)


def test_op6(spark, whole):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op6_substring_dedup(spark, SF).collect()}
    assert got == brute_substrings(whole)


def test_op7(spark, whole):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op7_jaccard_join(spark, SF).collect()}
    assert got == brute_components(whole, 3, 90)


def test_op8(spark, whole):
    got = queries.op8_token_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == ids_digest(whole)


def test_op10(spark, whole):
    coded = unigram.encode_and_decode(spark.createDataFrame(whole, "doc_id long, text string"), P.path("piece_bpe_32k.model")).collect()
    assert {r.doc_id: r.decoded for r in coded} == {i: t or "" for i, t in whole}
    assert queries.op10_sentencepiece(spark, SF).count() == len(whole)


# ---------------------------------------------------------------- awkward rows
def awkward():
    rnd = random.Random(21)
    long = " ".join(rnd.choice(["ba", "do", "mi", "fu", "ñe"]) + str(rnd.randrange(4000)) for _ in range(60_000))
    rows = [(r[0], r[1]) for r in ROWS]
    return [*rows, (400, long), (401, long[:200_000] + " tail\n" + long[1000:3000]), (402, "\n".join([long[:9000]] * 3))]


CLASHES = ("h", "shard", "keys", "n", "n_bytes", "line", "lines", "sets", "s1", "prefix", "component", "ids", "bucket", "score_",
           "__h", "__first", "__n", "__text", "start", "part", "counts", "gone")


@pytest.fixture(scope="module")
def rough(spark):
    rows = [*awkward(), (None, "no id at all"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for k, c in enumerate(CLASHES):
        frame = frame.withColumn(c, F.lit(k) if k % 2 else F.lit(None).cast("string"))
    return frame


def test_lines_of_rough_rows(rough):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in linejoin.line_digest(rough).collect()}
    assert got == line_digest(awkward())
    kept = linejoin.drop_repeated_lines(rough)
    assert kept.columns == rough.columns
    assert {r.doc_id for r in kept.collect()} >= {400, None}


def test_substrings_of_rough_rows(rough):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.dedup_substrings(rough).collect()}
    assert got == brute_substrings(awkward())


def test_components_of_rough_rows(rough):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in sigtree.jaccard_components(rough, words=3, share=90).collect()}
    assert got == brute_components(awkward(), 3, 90)
    kept = sigtree.keep_one(rough)
    assert kept.columns == rough.columns and None in {r.doc_id for r in kept.collect()}


def test_token_ids_of_rough_rows(spark, rough):
    got = tokenio.read_tokens(spark, tokenio.write_tokens(rough, P.path("byte_bpe_50k.json"))).collect()
    want = ids_digest([*awkward(), (None, "no id at all"), (None, None)])
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_losses_of_rough_rows(spark, rough):
    rows = {i: t for i, t in awkward()}
    frame = rough.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    marks = spark.createDataFrame([(0,), (5,), (401,), (None,), (12345,)], "doc_id long")
    got = crossent.score(frame, crossent.fit(frame, marks), leave_out=True).collect()
    want = losses(list(rows.items()), {0, 5, 401})
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        assert r.n_words == want[r.doc_id][0] and np.allclose((r.target_loss, r.background_loss), want[r.doc_id][1:], rtol=1e-9)


def test_toxicity_of_rough_rows(spark, rough):
    marks = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(5, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score(rough, toxicity.fit(rough, marks)).collect()
    assert len(got) == len(awkward()) + 2 and all(0 <= r.score <= 1 for r in got)
    same = defaultdict(set)
    texts = dict(awkward())
    for r in got:
        same[texts.get(r.doc_id) or ""].add(r.score) if r.doc_id is not None else None
    assert all(len(x) == 1 for x in same.values())  # ties and repeated rows score alike
