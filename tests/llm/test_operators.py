"""The corpus operators against brute force on a small, awkward corpus."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm import (
    chat, crossent, fmindex, linejoin, quality, sigtree, suffixes, tokenio, toxicity, unigram,
)
from tillroll.llm.common import components

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(11)
    words = ["ba", "do", "Mi", "fu", "ñe", "straße", "x1", "la,", "go.", "und"]
    say = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "a", "ix"]) for _ in range(n))
    base, passage = say(120), say(40)
    texts = [None, "", " \t\n", "one", "two words", base, base, base + " extra", base.replace("ba", "bo", 1), "é" * 60,
             "a" * 200, "ab" * 150, "short\n\nshort\n" + passage, say(30) + "\n" + passage + "\n" + say(30),
             passage + "\n" + passage + "\n" + say(8), "\n".join(["same line here again now"] * 5),
             "{} #$% | <s> [INST] \\ " + say(12), say(3000), base.upper(), "日本語 テキスト " * 9, "a\x00b c\x0bd  e ",
             "one", say(12) + "\r\n" + say(12), "THE END " * 6, passage.lower()]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(len(texts) + k, base.replace(" ", "  ", k), "en", "s", 1) for k in range(6)]
    return rows + [rows[5]]  # a repeated row


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---------------------------------------------------------------- quality rules
def expected_measures(text):
    t = text or ""
    w = words_of(t)
    lines = [x for x in t.split("\n") if words_of(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark, docs, empty):
    ledger = quality.quality_ledger(docs.withColumn("n_words", F.lit("clash")).withColumn("fail_bits", F.lit(9)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((r.doc_id, tuple(r[n] for n in names)) for r in ledger.collect())
    assert got == sorted((r[0], expected_measures(r[1])) for r in ROWS)
    assert quality.quality_ledger(empty).count() == 0


def test_policies_and_ablations(docs):
    ledger = quality.quality_ledger(docs)
    rows = ledger.collect()
    for policy, mask in quality.POLICIES.items():
        kept = quality.apply_policy(ledger, policy).where("kept").count()
        assert kept == sum(r.fail_bits & mask == 0 for r in rows)
    for r in quality.ablations(ledger).collect():
        mask, bit = quality.POLICIES[r.policy], quality.mask_of(r.rule)
        assert r.rejected == sum(x.fail_bits & mask != 0 for x in rows)
        assert r.only_this_rule == sum(x.fail_bits & mask == bit for x in rows)
        assert r.failed_rule == sum(x.fail_bits & bit != 0 for x in rows)
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in rows if r.fail_bits & quality.POLICIES[quality.DEFAULT_POLICY] == 0)


# ---------------------------------------------------------------- line join
def brute_lines(rows):
    seen, out = [], {}
    for i, text in sorted({(r[0], r[1] or "") for r in rows}):
        keep, n, gone = [], 0, 0
        for line in text.split("\n"):
            w = words_of(lower(line))
            if not w:
                keep.append(line)
                continue
            n += 1
            s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
            hit = any(5 * len(s & t) >= 4 * len(s | t) for t in seen)
            seen.append(s)
            if hit:
                gone += 1
            else:
                keep.append(line)
        out[i] = (n, gone, hashlib.sha256("\n".join(keep).encode()).hexdigest())
    return out


def test_line_join(docs, empty, spark):
    got = linejoin.line_digest(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in got} == brute_lines(ROWS)
    assert linejoin.line_digest(empty).count() == 0
    kept = linejoin.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    texts = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in kept.collect()}
    for i, (n, gone, digest) in brute_lines(ROWS).items():
        assert (i in texts) == (n == 0 or gone < n)
        assert texts.get(i, digest) == digest


def test_line_join_blocks(docs, monkeypatch):
    monkeypatch.setattr(linejoin, "BLOCK_BYTES", 200)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in linejoin.line_digest(docs).collect()}
    assert got == brute_lines(ROWS)


# ---------------------------------------------------------------- cross entropy
def test_cross_entropy(spark):
    rnd = random.Random(5)
    good = [" ".join(rnd.choice(["sun", "moon", "star", "sky"]) for _ in range(40)) for _ in range(60)]
    bad = [" ".join(rnd.choice(["zip", "zap", "zop", "sky"]) for _ in range(40)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(500, None), (501, ""), (502, "sun moon star sky sun moon"), (502, "zip zap zop zip zap")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = spark.createDataFrame([(i,) for i in range(0, 60)], "doc_id long")
    vocab = crossent.vocabulary(frame)
    got = crossent.score(frame, crossent.fit(frame, wanted, vocab), vocab).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id < 500}
    assert min(by_id[i].score for i in range(60)) > 0 > max(by_id[i].score for i in range(60, 120))
    for r in got:
        if r.doc_id in (500, 501):
            assert (r.n_words, r.target_loss, r.background_loss, r.score) == (0, 0.0, 0.0, 0.0)
    odd = sorted((r.n_words, r.score > 0) for r in got if r.doc_id == 502)
    assert odd == [(5, False), (6, True)]
    # the models are the counts of a plain pass over the words
    target, background = crossent.fit(frame, wanted, vocab)
    counts = Counter(w for _, t in rows for w in (t or "").split())
    assert sorted(background[2 : 2 + len(vocab)]) == sorted(counts.values())
    nothing = crossent.fit(frame, wanted.where("doc_id < 0"), vocab)
    assert nothing[0].sum() == 0 and crossent.score(frame, nothing, vocab).count() == len(rows)
    none = frame.where("doc_id < 0")
    v = crossent.vocabulary(none)
    assert crossent.score(none, crossent.fit(none, wanted, v), v).count() == 0


def test_cross_entropy_counts_every_word_and_pair(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(f"w{rnd.randrange(300)} r{900 * i + k}" for k in range(900))) for i in range(90)]  # 81,300 words
    rows += [(90, None), (None, rows[0][1]), (3, "w1 w2 W1"), (3, "w1 w2 W1")]
    wanted = {i for i in range(0, 90, 3)}
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i,) for i in wanted] * 2 + [(None,), (777,)], "doc_id long")
    models = []
    for pick in (lambda i: i in wanted, lambda i: True):
        words, contexts, pairs = Counter(), Counter(), Counter()
        for i, t in rows:
            if pick(i):
                w = lower(t).split()
                words.update(w)
                contexts.update([None, *w][: len(w)])
                pairs.update(zip([None, *w], w))
        models.append((words, contexts, pairs))
    size = len(models[1][0]) + 2

    def loss(model, text):
        words, contexts, pairs = model
        w, total = lower(text).split(), words.total()
        uni = [(words[x] + 0.1) / (total + 0.1 * size) for x in w]
        each = [-np.log((pairs[a, b] + 4 * u) / (contexts[a] + 4)) for a, b, u in zip([None, *w], w, uni)]
        return sum(each) / max(1, len(w))

    def check(got, texts):
        key = lambda r: (r[0] is None, r[0], r[1], r[2])
        expected = sorted(((i, len((t or "").split()), *(loss(m, t) for m in models)) for i, t in texts), key=key)
        got = sorted(((r.doc_id, r.n_words, r.target_loss, r.background_loss) for r in got), key=key)
        assert [r[:2] for r in got] == [r[:2] for r in expected]
        assert np.allclose([r[2:] for r in got], [r[2:] for r in expected], rtol=1e-9)

    vocab = crossent.vocabulary(frame)
    fitted = crossent.fit(frame, marks, vocab)
    check(crossent.score(frame, fitted, vocab).collect(), rows)
    assert len(vocab) == size - 2
    others = [(1, "w1 never seen w2"), (2, rows[5][1])]  # rows that the models do not count
    check(crossent.score(spark.createDataFrame(others, "doc_id long, text string"), fitted, vocab).collect(), others)
    # leaving one out: a wanted row is scored by a target model without that row
    def left_out(i, t):
        if i not in wanted:
            return loss(models[0], t)
        w = lower(t).split()
        less = [Counter(w), Counter([None, *w][: len(w)]), Counter(zip([None, *w], w))]
        return loss([m - x for m, x in zip(models[0], less)], t)

    got = {(r.doc_id, r.n_words): (r.target_loss, r.background_loss) for r in crossent.score(frame, fitted, vocab, leave_out=True).collect()}
    assert len(got) == len({(i, len((t or "").split())) for i, t in rows})
    for i, t in rows:
        assert np.allclose(got[i, len((t or "").split())], (left_out(i, t), loss(models[1], t)), rtol=1e-9)
    apart = spark.createDataFrame(others, "doc_id long, text string")
    check(crossent.score(apart, fitted, vocab, leave_out=True).collect(), others)


# ---------------------------------------------------------------- decontamination
def brute_hits(rows, items):
    norm = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))
    windows = {}
    for item, text in items:
        w = norm(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for r in rows:
        w, hit, own = norm(r[1]), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    own |= found
                    hit |= set(range(k, k + n))
        out.append((r[0], len(w), len(hit), sorted(own)))
    return sorted(out)


@pytest.mark.parametrize("block", [4 << 20, 60])
def test_decontamination(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(fmindex, "BLOCK_BYTES", block)
    texts = [r[1] or "" for r in ROWS]
    items = [(1, " ".join(texts[5].split()[10:24])), (2, "one"), (3, ""), (4, None), (5, texts[13][-60:]), (6, "THE end the END!"),
             (7, texts[17][300:400]), (7, "two words"), (8, "one"), (9, "not there at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in
                 fmindex.contamination(docs.withColumn("__spans", F.lit(1)), bench).collect())
    assert got == brute_hits(ROWS, items)
    assert fmindex.contamination(empty, bench).count() == 0
    assert fmindex.contamination(docs, bench.where("item_id < 0")).where("n_hit > 0").count() == 0
    cut = fmindex.remove_hits(docs, bench)
    assert cut.columns == docs.columns
    clean = {r[0] for r in got if r[2] == 0}
    assert all(r.text == dict((x[0], x[1]) for x in ROWS)[r.doc_id] for r in cut.collect() if r.doc_id in clean)
    assert fmindex.contamination(cut, bench).where("n_hit > 0").count() == 0


def test_fm_index_search_and_locate():
    rnd = np.random.default_rng(3)
    text = np.append(rnd.integers(1, 5, 400), 0).astype(np.int32)
    index = fmindex.FMIndex(text, 6)
    for size in (1, 2, 3):
        patterns = np.array([[2 + (k // 3**j) % 3 for j in range(size)] for k in range(3**size)], np.int32)
        low, high = index.search(patterns)
        for p, a, b in zip(patterns, low, high):
            where = [i for i in range(len(text) - size) if (text[i : i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b))) == where


# ---------------------------------------------------------------- substrings
def brute_substrings(rows):
    texts = sorted({(r[0], (r[1] or "").encode()) for r in rows})
    first = {}
    for i, b in texts:
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    out = {}
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def test_substrings(docs, empty):
    got = suffixes.dedup_substrings(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_substrings(ROWS)
    assert suffixes.dedup_substrings(empty).count() == 0


def test_substrings_of_a_hot_anchor_are_parted(spark, docs, monkeypatch):
    rnd = random.Random(3)
    some = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    phrase = "licensed under the same terms as is"
    rows = [(i, some(40) + phrase + some(40)) for i in range(400)]
    rows += [(400 + i, some(9) + rows[i][1][20:100] + some(9)) for i in range(0, 400, 8)]
    answer = suffixes._answer

    def bounded(table):
        windows = sum(int((np.frombuffer(x, np.uint8).astype(int) - 49).sum()) for x in table.column("sizes").to_pylist())
        assert windows <= 1500, windows  # one part; the phrase has some 16 windows in each of 450 texts
        return answer(table)

    monkeypatch.setattr(suffixes, "_answer", bounded)
    monkeypatch.setattr(suffixes, "RANGE_WINDOWS", 600, raising=False)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffixes.dedup_substrings(frame).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_substrings(rows)
    monkeypatch.setattr(suffixes, "_answer", answer)
    monkeypatch.setattr(suffixes, "RANGE_WINDOWS", 3)
    got = suffixes.dedup_substrings(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_substrings(ROWS)


def test_multikey_order():
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 4, (20_000, 7)).astype(np.uint64)
    ordered = words[suffixes.multikey_order(words)]
    assert [tuple(x) for x in ordered.tolist()] == sorted(map(tuple, words.tolist()))


# ---------------------------------------------------------------- Jaccard join
def brute_components(rows, words, share):
    sets = {}
    for i, text in {(r[0], r[1] or "") for r in rows}:
        w = words_of(lower(text))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]) and low[j] < low[i]:
                    low[i], changed = low[j], True
    return {i: (len(sets[i]), low[i]) for i in sets}


@pytest.mark.parametrize("words,share", [(3, 90), (5, 80)])
def test_jaccard_components(docs, empty, monkeypatch, words, share):
    expected = brute_components(ROWS, words, share)
    for block in (24 << 20, 3000):
        monkeypatch.setattr(sigtree, "BLOCK_BYTES", block)
        got = sigtree.jaccard_components(docs, words=words, share=share).collect()
        assert len(got) == len(ROWS)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert sigtree.jaccard_components(empty).count() == 0
    kept = sigtree.keep_one(docs, words=words, share=share)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in expected.items() if i == c}


def test_tree_links_span_the_components():
    rnd = np.random.default_rng(9)
    sets = []
    for _ in range(12):
        base = np.unique(rnd.integers(0, 2**63, 200).astype(np.uint64) * np.uint64(2))
        for _ in range(9):
            own = base.copy()
            own[rnd.integers(0, len(own), rnd.integers(0, 22))] = rnd.integers(0, 2**63, 1).astype(np.uint64)
            sets.append(np.unique(own))
    low = list(range(len(sets)))

    def find(x):
        return x if low[x] == x else find(low[x])

    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 190 * both >= 90 * (len(sets[a]) + len(sets[b])):
                x, y = find(a), find(b)
                low[max(x, y)] = min(x, y)
    expected = [find(k) for k in range(len(sets))]
    links = sigtree.tree_links(sets, 90)
    low = list(range(len(sets)))
    for a, b in links:
        assert find(a) != find(b)
        x, y = find(a), find(b)
        low[max(x, y)] = min(x, y)
    assert [find(k) for k in range(len(sets))] == expected


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7)]
    low = {}

    def find(x):
        low.setdefault(x, x)
        return x if low[x] == x else find(low[x])

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"), "components_test").collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in low}
    assert len(got) == len(low)


# ---------------------------------------------------------------- token ids
def test_token_ids(docs, empty, spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    special = (7000, "x <|endoftext|> y<|endoftext|>")
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([special], "doc_id long, text string"))
    docs = docs.withColumn("ids", F.lit("clash")).withColumn("part", F.lit(1)).withColumn("seq", F.lit(None))
    got = tokenio.read_tokens(spark, tokenio.write_tokens(docs, path)).collect()
    at, expected = 0, []
    for i, text in sorted([*((r[0], r[1] or "") for r in ROWS), special]):
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got)) == expected
    assert tokenio.read_tokens(spark, tokenio.write_tokens(empty, path)).count() == 0


def test_encoder_cuts_like_the_tokenizer():
    from tokenizers import Tokenizer

    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = tokenio.Encoder(f.read())
    texts = ["a  b", "a   b", "  a", " a ", "a \n b", "a\n  b", "a \n\n  b \t c", "\n", " ", "", "<|endoftext|> a", "don't  we'll 12 3a",
             "a 　b \xa0c\r\n d", "word, word. word.. é, 1. 2, x.y. a.,"] * 3
    got = encoder.encode(pa.array(texts))
    ref = Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode_batch(texts, add_special_tokens=False)
    assert got == [np.array(r.ids, encoder.dtype).tobytes() for r in ref]


def test_elias_fano():
    rnd = np.random.default_rng(4)
    for n, universe in ((1, 1), (5, 5), (3000, 1_000_000), (2000, 2500), (700, 700)):
        values = np.sort(rnd.integers(0, universe, n))
        code = tokenio.EliasFano.of(values, universe)
        assert (code.values() == values).all()
        again = tokenio.EliasFano(n, universe, code.low, code.high, code.samples)
        assert [again.select(i) for i in range(n)] == values.tolist()
        assert 8 * (len(code.low) + len(code.high)) <= n * (2 + np.log2(universe / n + 1) + 1) + 64


# ---------------------------------------------------------------- chat
def test_chat_round_trip(spark):
    texts = ["hi", None, "", "</s>[INST] ok [/INST]", "<|turn|>\\<\\|says|> \\", "[\\INST] <\\s> <\\\\s><s>", "línea\n" * 3, "x" * 5000]
    rows = [(c, k, "assistant" if k % 2 else "user", t, 5) for c in range(3) for k, t in enumerate(texts)]
    rows += [(9, 0, None, "no role", 1), (None, 1, "user", "no id", 1), (3, 1, "assistant", "b", 1), (3, 1, "assistant", "a", 1), (4, 2, "ro<s>le\n", "t", 0)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int").repartition(4)
    segments = chat.format_conversations(frame)
    got = {r.conv_id: tuple(r[1:]) for r in chat.read_back(segments).collect()}
    expected = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(f"{a}\n{t}\n" for _, a, t in turns)
        loss = "".join(t for _, a, t in turns if a == "assistant")
        chars = sum(24 + len(chat.escape(a)) + len(chat.escape(t)) for _, a, t in turns)
        expected[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    assert got == expected
    assert chat.read_back(chat.format_conversations(frame.where("conv_id = 99"))).count() == 0
    for t in texts:
        assert chat.unescape(chat.escape(t or "")) == (t or "")
        assert not any(c in chat.escape(t or "") for c in chat.CONTROL)


def test_chat_parts(spark):
    parts = [
        {"type": "text", "text": "see <|image|> "}, {"type": "image", "ref": "a.png", "width": 57, "height": 28},
        {"type": "audio", "ref": "b.wav", "seconds": 2.1}, {"type": "document", "ref": "c.pdf", "pages": 2}, {"type": "text", "text": None},
    ]
    full = [{k: p.get(k) for k in ("type", "text", "ref", "width", "height", "seconds", "pages")} for p in parts]
    frame = spark.createDataFrame([(1, 0, "user", full), (1, 1, "assistant", [])], f"conv_id long, turn long, role string, text {chat.PARTS_TYPE}")
    first, second = chat.format_conversations(frame).orderBy("turn").collect()
    assert first.segment == "<|turn|>user<|says|>see <\\|image|> <|image|><|audio|><|document|><|done|>"
    assert [(a.position, a.type, a.ref, a.tokens) for a in first.attachments] == [
        (0, "image", "a.png", 3), (1, "audio", "b.wav", 53), (2, "document", "c.pdf", 1024)]
    assert first.expanded_tokens == 1080 and second.segment == "<|turn|>assistant<|says|><|done|>"
    assert chat.whole_conversations(chat.format_conversations(frame)).first().formatted == first.segment + second.segment


def test_chat_parts_of_any_kind_and_size():
    nan, inf = float("nan"), float("inf")
    for value in (None, 0, -3, nan, inf, -inf, 1e300):
        part = {"type": "audio", "ref": "x", "seconds": value}
        assert chat.format_turn("user", [part])[3] == [{"position": 0, "type": "audio", "ref": "x", "tokens": 1}]
        for kind, least in (("image", 1), ("document", 512)):
            part = {"type": kind, "ref": "x", "width": value, "height": value, "pages": value}
            assert chat.format_turn("user", [part])[3][0]["tokens"] == least
    segment, start, end, found = chat.format_turn("user", [
        {"type": "video", "text": "a <|done|>", "ref": "v.mp4"}, {"type": "note", "text": None}, None, {"type": None, "text": "b"}])
    assert segment[start:end] == "a <\\|done|>b" and found == [{"position": 0, "type": "video", "ref": "v.mp4", "tokens": 0}]


# ---------------------------------------------------------------- pieces
@pytest.fixture(scope="module")
def pieces():
    return unigram.Pieces.load(P.path("piece_bpe_32k.model"))


def brute_ids(rows, pieces, text):
    if not text:
        return []
    table = {p.replace(unigram.MARK, " "): i for i, (p, _, t) in enumerate(rows) if t == unigram.NORMAL}
    longest = max(map(len, table))
    chars = " " + text
    best = [(0.0, 0, [])] + [None] * len(chars)
    for end in range(1, len(chars) + 1):
        for start in range(max(0, end - longest), end):
            part = chars[start:end]
            if part in table:
                step, ids = pieces.scores[table[part]], [table[part]]
            elif end - start == 1:
                step, ids = pieces.unknown_score, [int(pieces.byte_ids[b]) for b in part.encode()]
            else:
                continue
            value = best[start][0] + step
            if best[end] is None or value > best[end][0]:
                best[end] = (value, start, best[start][2] + ids)
    return best[-1][2]


def test_pieces_are_the_best_path(spark, docs, empty, pieces):
    path = P.path("piece_bpe_32k.model")
    rows, _ = unigram.read_model(path)
    coded = unigram.encode(docs.withColumn("ids", F.lit(0)), path)
    out = unigram.decode(coded, path).collect()
    assert len(out) == len(ROWS)
    for r in out:
        assert r.decoded == (r.text or "")
        assert r.n_ids == len(r.ids)
        if len(r.text or "") < 900:
            assert r.ids == brute_ids(rows, pieces, r.text or ""), r.text
    digest = unigram.encode_digest(docs, path).collect()
    assert all(r.round_trip for r in digest)
    by_id = {r.doc_id: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in out}
    assert all(by_id[r.doc_id] == r.ids_crc32 for r in digest)
    assert unigram.encode_digest(empty, path).count() == 0


def test_marker_characters_and_trie(pieces):
    import pyarrow as pa

    from tillroll.llm.kernel import text_buffer

    texts = ["▁", "a▁b ▁", "  two  spaces ", "\t\n", "x" * 300 + "▁", "🙂 ok"]
    ids, bounds = pieces.encode_block(*text_buffer(pa.array(texts)))
    data, offsets = pieces.decode_block(ids, bounds)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])] == texts
    entries = {b"a": 1, b"ab": 2, b"abc": 3, b"b": 4, b"\xff\x00": 5}
    trie = unigram.DoubleArrayTrie(entries)

    def look(word):
        state = 0
        for b in word:
            nxt = int(trie.base[state]) + b
            if trie.check[nxt] != state:
                return -1
            state = nxt
        return int(trie.value[state])

    assert {w: look(w) for w in entries} == entries and look(b"abd") == look(b"c") == look(b"\xff") == -1


def test_decontamination_by_blocks_of_phrases(docs, spark, monkeypatch):
    """Many blocks, one pass each, find what one block finds; no two share a stage."""
    items = spark.createDataFrame([(i, " ".join(words_of(r[1])[k : k + 14])) for i, (r, k) in enumerate(
        (r, k) for r in ROWS if r[1] for k in (0, 7, 30))] + [(90, None), (None, "one")], "item_id long, text string")
    pick = ["doc_id", "n_words", "n_hit", "item_ids", "spans"]
    whole = sorted(map(tuple, fmindex.contamination(docs, items).select(*pick).collect()), key=repr)
    monkeypatch.setattr(fmindex, "BLOCK_BYTES", 700)
    parted = fmindex.contamination(docs, items)
    assert sorted(map(tuple, parted.select(*pick).collect()), key=repr) == whole
    assert parted._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


# ---------------------------------------------------------------- toxicity
def test_deobfuscation_and_held_out_accuracy(spark):
    rnd = random.Random(8)
    plain = ["river", "stone", "green", "walk", "table", "cloud", "seven", "paper"]
    rude = ["grobian", "lumpen"]
    forms = [lambda w: w, lambda w: w.replace("o", "0").replace("i", "1").replace("e", "3"), lambda w: w[0] + w[1] * 4 + w[2:],
             lambda w: " ".join(w), lambda w: ".".join(w), str.upper]
    rows, labels = [], []
    for i in range(1600):
        words = [rnd.choice(plain) + rnd.choice(["", "s", "er"]) for _ in range(25)]
        toxic = int(i % 4 == 0)
        if toxic:
            words[rnd.randrange(25)] = forms[i % 6 if zlib.crc32(str(i).encode()) % 4 == 2 else i % 2 * 0](rnd.choice(rude))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(5000, None), (5001, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    fitted = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(frame, fitted).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum(got[i].predicted == labels[i][1] for i in held) / len(held)
    assert right >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5000].score == got[5001].score
    model = fitted[0]
    assert toxicity.restore("gr0b1an", model) == "grobian" and toxicity.restore("luuuumpen", model) == "lumpen"
    assert "lumpen" in toxicity.deobfuscate("a L.U.M.P.E.N b", model)
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert max(r.score for r in toxicity.score(frame, toxicity.fit(frame, no_labels)).collect()) < 1e-200
    nothing = frame.where("doc_id < 0")
    assert toxicity.score(nothing, toxicity.fit(nothing, no_labels)).count() == 0


def test_spaced_runs_are_read_with_their_separators():
    n = Counter()
    said = ("what a moron you are an idiot i am a good person and he is at my house a stupid idea a class of things "
            "the other one took a long walk on that road a hole in a wall ass hole asshole ") * 50
    at = [0, 0, *toxicity._CLASS[np.frombuffer(said.encode(), np.uint8)].tolist(), 0]
    n.update((a * 28 + b) * 28 + c for a, b, c in zip(at, at[1:], at[2:]))
    model = toxicity.character_model(list(n.items()))

    def words(text):
        return {w for t in toxicity.words_of(text) for w in toxicity.restored_words(t, model)}

    for text, word in (("what a m o r o n", "moron"), ("a i d i o t", "idiot"), ("y o u i d i o t", "idiot"), ("@ s s", "ass"),
                       ("a $ $ h 0 l e", "asshole"), ("i  d  i  o  t", "idiot"), ("i\nd\ni\no\nt", "idiot"), ("id iot", "idiot"),
                       ("id111ot", "idiot"), ("I i d i o t", "idiot"), ("1 d 1 0 t", "idiot")):
        assert word in words(text), text
    assert words("1 2 3 4") == {"1", "2", "3", "4"}
    assert toxicity.deobfuscate("you are an i d i o t", model).endswith("idiot")


def test_line_join_keeps_rows_without_an_id(spark):
    rows = [(1, "one clean line"), (None, "another clean line"), (None, "one clean line"), (None, None), (2, None), (3, "one clean line")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text or None) for r in linejoin.drop_repeated_lines(frame).collect()]
    assert sorted(got, key=repr) == sorted(rows[:-1], key=repr)


def test_ordinary_runs_are_left_alone(spark):
    prose = "of it is by an or to the a of y la in on at " * 200 + "an idiot idx " + "word other thing " * 900
    rows = [(1, prose), (2, None), (3, ""), (4, "Öl ôté"), (5, "|- x"), (5, "|- x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    ordinary = toxicity.short_words(frame)
    assert {"of", "it", "is", "by", "an", "or", "to", "the", "a", "y", "la", "in", "on", "at"} <= ordinary
    assert "idx" in ordinary and not {"word", "x", "iot", ""} & ordinary
    for text in ("of it is by", "a la on at the", "1 2 3"):
        assert not [t for t in toxicity.words_of(text, ordinary) if " " in t]
    for text in ("an id iot", "a s s", "i d i o t", "of @ s s", "th e"):
        assert text in toxicity.words_of(text, ordinary)
    assert toxicity.short_words(frame.limit(0)) == frozenset()


def test_viterbi_equals_every_path():
    """The best reading of short lattices against all readings scored one by one."""
    import itertools

    rnd = random.Random(9)
    n = Counter({rnd.randrange(28**3): rnd.randrange(1, 50) for _ in range(4000)})
    model = toxicity.character_model(list(n.items()))

    def cost(path):
        a = b = 0
        total = sum(c for _, c in path)
        for ch in "".join(w for w, _ in path) + " ":
            c = 0 if ch == " " else toxicity._class(ch)
            total, a, b = total + model[a][b][c], b, c
        return total

    for token in ["1d10t", "a$$", "hooo0ray", "6668", "b1@5", "x", "l|!1", "sss000"]:
        lattice = toxicity._signs(token)
        every = sorted(((cost(p), "".join(w for w, _ in p)) for p in itertools.product(*lattice)), reverse=True)
        assert toxicity._best(lattice, model)[0] == every[0][1]
        near = toxicity._best(lattice, model, 10**6)
        assert set(near) == {w for c, w in every if c >= every[0][0] - toxicity.MARGIN}


def test_runs_are_those_of_the_whole_text():
    """Looking around odd tokens finds every run that a scan of the whole text finds."""
    rnd = random.Random(12)
    ordinary = frozenset({"of", "it", "a", "the", "an"})
    parts = ["of", "it", "a", "the", "an", "idiot", "longer", "i", "d", "@", "$s", "id", "iot", "1", "x.y", "i.d.i", "(of", "of)", "é", "a-b-c",
             "word,of", "of,", "..", "-", "_a_", "*", "b's", "thé", "a\u0301", "12345", "wo_rd"]
    gaps = [" ", " ", "  ", "\n", " . ", "\t", ", ", "    "]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) + rnd.choice(gaps) for _ in range(rnd.randint(0, 14)))
        low = text.lower()
        for known in (ordinary, frozenset()):
            whole = {m.group(0) for m in toxicity._SPACED.finditer(low)}
            assert toxicity.runs_of(low, set(low.split()), known) == {r for r in whole if toxicity.spaced(r, known)}, text
