"""The registered corpus queries and the pipeline over the smallest tables."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from test_operators import brute_components, expected_measures, lower, words_of

import __spark_entry__ as contract
import corpus_pipeline
from tillroll.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(expected, key=repr)


def test_all_operators_are_registered():
    names = {n.split("_")[0] for n in contract.queries() if n.startswith("op")}
    assert names == {f"op{k}" for k in range(1, 14)} and "pipeline" in contract.queries()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        now = docs.collect()
        ids = [r.doc_id for r in now]
        assert set(ids) <= seen and len(ids) == len(set(ids)), name
        seen = set(ids)
        docs = spark.createDataFrame(now, docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    texts = {r.doc_id: r.text for r in now}
    assert {r.doc_id: r.decoded for r in last} == texts


# ---------------------------------------------------------------- the pipeline by brute force
def passes(text):
    t = text or ""
    n, chars, symbols, dup, repeated = expected_measures(t)
    w = words_of(t)
    lines = [x for x in t.split("\n") if words_of(x)]
    upper, letters = (len(re.findall(p, t)) for p in ("[A-Z]", "[A-Za-z]"))
    echo = sum(a == b for a, b in zip(w, w[1:]))
    return not (n < 10 or 100 * repeated > 20 * n or 100 * symbols > 30 * n or chars < 2 * n or chars > 20 * n
                or 100 * dup > 50 * len(lines) or (2 * upper > letters > 0) or 100 * echo > 30 * n)


def without_lines(rows):
    seen, out = defaultdict(list), []
    sets = []
    for i, text in sorted(rows):
        keep, n, gone = [], 0, 0
        for line in text.split("\n"):
            w = words_of(lower(line))
            s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
            if not w:
                keep.append(line)
                continue
            n += 1
            shared = Counter(q for g in s for q in seen[g])
            hit = any(5 * k >= 4 * (len(s) + len(sets[q]) - k) for q, k in shared.items())
            for g in s:
                seen[g].append(len(sets))
            sets.append(s)
            gone += hit
            if not hit:
                keep.append(line)
        if n == 0 or gone < n:
            out.append((i, "\n".join(keep)))
    return out


def without_hits(rows, items):
    norm = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    phrases = defaultdict(set)
    for _, text in items:
        w = norm.findall(lower(text))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            phrases[n].add(tuple(w[k : k + n]))
    out = []
    for i, text in rows:
        found = list(norm.finditer(lower(text)))
        w = [m.group() for m in found]
        hit = [False] * len(w)
        for n, own in phrases.items():
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in own:
                    hit[k : k + n] = [True] * n
        pieces, at, k = [], 0, 0
        while k < len(w):
            if hit[k]:
                e = k
                while e + 1 < len(w) and hit[e + 1]:
                    e += 1
                pieces.append(text[at : found[k].start()])
                at, k = found[e].end(), e
            k += 1
        out.append((i, "\n".join([*pieces, text[at:]])))
    return out


def test_pipeline_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = without_lines([(i, t) for i, t in docs if passes(t)])
    low = brute_components(rows, 5, 80)
    rows = without_hits([(i, t) for i, t in rows if low[i][1] == i], items)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.decoded for r in got} == dict(rows)
    assert len(got) == len(rows) and all(r.n_ids == len(r.ids) for r in got)
