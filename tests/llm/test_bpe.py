"""Byte-level BPE against the tokenizers library, used as it comes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import ROWS, SCHEMA

from tillroll.llm import bpe, queries

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def awkward():
    rnd = random.Random(3)
    out = ["it's we've 's ''s 'sub I'LL i'll x's's  's\n's \t's", "a  b   c \n d\n\ne  ", "x <|endoftext|> y<|endoftext|><|endoftext|>",
           "<|endof", "text|>", "   ", "  <|endoftext|>  ", " ", "a" * 5000, "ab" * 3000, "١٢٣ 123abc ½ ² 日本語　x y",
           "\x00\x1f\x1c\x85 \xa0 x  y  z", "é 🎉🎉 \U0001f1e6‍", "ꟋaᲉ 1\U00010d40"]
    letters = "ab'stremvld  \n\t1²é日!. 🎉́<|endoftext|>"
    out += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(800)]
    wide = [(0, 0x2FF), (0x300, 0xD7FF), (0xE000, 0x10FFFF)]
    return out + ["".join(chr(rnd.randint(*rnd.choice(wide))) for _ in range(30)) for _ in range(400)]


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_equals_the_library(spark, library):
    rows = [(r[0], r[1]) for r in ROWS] + [(None, "no id")] + [(1000 + i, t) for i, t in enumerate(awkward())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(1)).withColumn("decoded", F.lit(None))
    got = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode_and_decode(docs, PATH).collect())
    assert got == sorted((str(i), len(e) // 4, e, d) for i, t in rows for e, d in [expected(library, t)])
    encoded = bpe.encode(docs, PATH)
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids)) for r in encoded.collect()) == [g[:3] for g in got]
    assert sorted((str(r.doc_id), r.text) for r in bpe.decode(encoded, PATH).collect()) == sorted((g[0], g[3]) for g in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.encode_and_decode(empty, PATH).count() == 0


def test_small_groups_and_forgotten_words(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_BYTES", 500)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    texts = awkward()
    codec, pa = bpe.Codec(vocabulary), bpe.pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    holder = type("Held", (), {"value": codec})
    rows = [r for b in bpe._encode(holder, True)([batch.slice(i, 40) for i in range(0, len(texts), 40)]) for r in b.to_pylist()]
    assert [(r["ids"], r["decoded"]) for r in rows] == [expected(library, t) for t in texts]


def test_decoding_of_any_ids(spark, library):
    ids = [[50256, 50255, 126, 126, 220], [160], [], [9, 50300 + 7, 12]]  # parts of characters, an unknown id
    rows = [(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(ids)] + [(9, None), (10, np.array([5], "<u4").tobytes() + b"x")]
    got = {r.doc_id: r.text for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), PATH).collect()}
    known = lambda x: library.decode([i for i in x if i <= 50256], skip_special_tokens=False)
    assert got == {**{i: known(x) for i, x in enumerate(ids)}, 9: "", 10: known([5])}


def test_other_tokenizer_files_are_refused():
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.Vocabulary(f.read())


def test_merge_without_marks_is_plain_bpe(vocabulary):
    """The sweep by ranks against merging word by word, smallest rank first."""
    rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(zip(*(x.tolist() for x in (vocabulary.left, vocabulary.right, vocabulary.new))))}
    rnd = random.Random(8)
    words = [bytes(rnd.choice(b"aaabetionrsh \xc3\xa9") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    ids, counts = vocabulary.merge(np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words[:-1])]))
    at = 0
    for word, n in zip(words, counts.tolist()):
        s = vocabulary.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        while found := [(rank[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in rank]:
            i = min(found)[1]
            s[i : i + 2] = [rank[s[i], s[i + 1]][1]]
        assert ids[at : at + n].tolist() == s
        at += n


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((r.doc_id, len(e) // 4, sha(e), sha(d.encode())) for r in rows for e, d in [expected(library, r.text)])
    got = queries.op13_bpe(spark, sf)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want
