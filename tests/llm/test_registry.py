"""Queries against their SQL, and every operator on odd and on empty tables."""

import os

import corpus_pipeline
import duckdb
import pytest

from tidemark.llm import exact, forest, licenses, mixing, pieces, private, quality, rules, tokens, urls
from tidemark.llm.registry import ORACLES, QUERIES
from tidemark.session import new_dir

from .conftest import PIECES, WORDS


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, db, name):
    frame = QUERIES[name](spark, sf)
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    assert want and got == want


def test_names():
    assert [n for n in QUERIES if n.startswith("op")] == [f"op{n}_{QUERIES_TAIL[n]}" for n in range(1, 14)]
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "mixing", "pieces"]


QUERIES_TAIL = {int(n[2:].split("_")[0]): n.split("_", 1)[1] for n in QUERIES if n.startswith("op")}


def encoded(docs):
    spark = docs.sparkSession
    path = new_dir(spark, "tokens")
    tokens.write_ids(docs, path, WORDS)
    return tokens.read_ids(spark, path)


#: Those with a row for every row of the input.
PER_ROW = {
    "near": forest.near_groups,
    "exact": exact.groups,
    "tokens": encoded,
    "pieces": lambda docs: pieces.encode(docs, PIECES),
    "private": private.find,
    "rules": rules.verdicts,
    "mixing": mixing.plan,
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_odd_rows(odd, name):
    assert PER_ROW[name](odd).count() == odd.count()


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_no_rows(empty, name):
    assert PER_ROW[name](empty).count() == 0


def test_classifier_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    settings = quality.Settings(bits=10)
    found = quality.score(odd, quality.fit(odd, labels, settings), settings)
    assert found.count() == odd.count()
    assert found.where("score between 0 and 1").count() == odd.count()
    nothing = quality.fit(empty, labels.limit(0), settings)
    assert not nothing.any()
    assert quality.score(empty, nothing, settings).count() == 0


def test_licenses_on_odd_rows(odd, empty):
    assert licenses.scan(odd).count() == 0
    assert licenses.scan(empty).count() == 0


def test_urls_on_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "http://a.org/x"), (2, ""), (3, "no scheme"), (4, "x://"), (5, "http://ORG/" + "y" * 50_000), (6, "a://b://c.org/"), (7, "http://..org//?#"), (8, "http://org?x")]
    pages = spark.createDataFrame([(*r, None) for r in rows], "page_id long, url string, html string")
    got = {(r.page_id, r.host[:10], r.path[:5], r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert got == {
        (1, "", "", None, "allow"), (None, "a.org", "/x", "org/", "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"),
        (5, "org", "/yyyy", "org/", "allow"), (6, "b:", "//c.o", None, "allow"), (7, "..org", "//", "org/", "allow"), (8, "org", "", None, "allow"),
    }
    assert urls.judge(pages).count() == len(rows)
    assert urls.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, sf, odd, empty, stage):
    name, run = corpus_pipeline.STAGES[stage]
    for docs in (odd, empty):
        out = run(spark, docs, sf)
        n = out.count()
        assert n == 0 if docs is empty else True
        if stage < 4:
            assert out.columns == docs.columns
            if stage < 3:
                assert n <= docs.count()
        elif docs is odd:
            assert n == docs.count()


def test_stages_drop_what_they_should(spark, sf, odd):
    exact_rows = corpus_pipeline.exact_dedup(spark, odd, sf).select("doc_id", "text").collect()
    same = [r for r in exact_rows if r.text and "same" in r.text]
    assert len(same) == 1 and same[0].doc_id == 9
    near = corpus_pipeline.near_dedup(spark, odd, sf).select("doc_id").collect()
    assert 10 not in {r.doc_id for r in near}


def test_pipeline_against_plain_python(spark, sf, texts, documents):
    """The same stages one document at a time, but for the outlier verdicts and the mix."""
    kept = {r.doc_id for r in rules.verdicts(documents).where("kept").collect()}
    by_text: dict[str, int] = {}
    for i in sorted(kept):
        key = __import__("re").sub(r"[\x20\x09-\x0D]+", " ", texts[i])
        by_text.setdefault(key, i)
    firsts = set(by_text.values())

    def shingles(text):
        w = text.encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = {i: shingles(texts[i]) for i in firsts}
    root = {i: i for i in firsts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(firsts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    left = {i for i in ids if find(i) == i}
    plan = mixing.plan(documents.where(documents.doc_id.isin(*left))).where("copies > 0").collect()
    want = sorted(r.doc_id for r in plan for _ in range(r.copies))
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == want
    import hashlib

    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)
