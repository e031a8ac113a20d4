"""URL rules against a loop, all queries, and the pipeline against its parts."""

import random
import zlib

import check_queries
import numpy as np
import pytest

import corpus_pipeline
from turnstile.llm import queries, url_rules

SF = "/root/testdata/sf0.001"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
    path = rest[end:]
    stop = min([k for k in map(path.find, "?#") if k >= 0], default=len(path))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, path[:stop]


def judged(url, rules):
    host, path = split(url)
    best = None
    for verdict, h, p in rules:
        h = h and h.lower()
        if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h) + len(p), len(h), verdict == "block")
            if best is None or key > best[0]:
                best = (key, h + p, verdict)
    return (host, path, *(best[1:] if best else (None, "allow")))


@pytest.mark.parametrize("rows_per_range", [7, 10_000])
def test_url_rules(spark, rows_per_range):
    rng = random.Random(rows_per_range)
    hosts = ["com", "b.com", "a.b.com", "xb.com", "b.org", "org", "c-b.com", "a.a.b.com", "é.org", "B.COM", "b.com:80"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/X", "/é/1"]
    urls = [None, "", "no scheme", "://", "://.", "http:///p", "a://b.com?x://c.com/", "x://com/#", "http://a\nb.com/x\n/y?z", "://b.com/x://org/"]
    urls += [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q', '#f'])}" for _ in range(300)]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(40)]
    rules += [("allow", "b.com", "/x"), ("block", "b.com", "/x"), ("block", None, "/"), ("block", "", ""), ("block", "com", None)]
    pages = spark.createDataFrame([(i if i % 50 else None, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    found = url_rules.judge_urls(pages, url_rules.rules_table(spark, rules), rows_per_range=rows_per_range)
    want = [(i if i % 50 else None, *judged(u, rules)) for i, u in enumerate(urls)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_url_rules_without_rows(spark):
    none = url_rules.rules_table(spark, [("allow", "x", "y")]).limit(0)
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [tuple(r) for r in url_rules.judge_urls(pages, none).collect()] == [(1, "a.b", "/c", None, "allow")]
    assert url_rules.judge_urls(pages.limit(0), none).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_against_sql(spark, name):
    assert check_queries.compare(spark, check_queries.connect(SF), name, SF) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_decide_by_row(docs_of, spark, monkeypatch):
    from turnstile.llm import features, pu_quality

    item = "one two three four five six seven eight"
    monkeypatch.setattr(corpus_pipeline, "read", lambda *_: spark.createDataFrame([(1, item)], "item_id long, text string"))
    left = lambda stage, rows: sorted(((r.doc_id, r.text) for r in stage(spark, docs_of(rows), "").collect()), key=str)
    # One row of a group, though copies have the id of the kept row or none, and rows of other groups share ids.
    rows = [(3, "a b c"), (1, "A b C"), (1, "a b c"), (None, "a b c"), (None, "a b c"), (3, "x y z w"), (None, "k l m"), (None, "k l m")]
    assert [r for r in left(corpus_pipeline.near_duplicates, rows) if r[0] != 1] == [(3, "x y z w"), (None, "k l m")]
    assert len(left(corpus_pipeline.near_duplicates, rows)) == 3
    # A leak without an id goes, a clean row that shares the id of a leak stays.
    rows = [(1, item), (1, "clean"), (None, "so " + item), (None, "clean too"), (2, None)]
    assert left(corpus_pipeline.no_benchmark, rows) == [(1, "clean"), (2, None), (None, "clean too")]
    # The same for texts that the classifier rejects.
    weights = np.zeros(features.SIZE, np.float32)
    weights[features.sparse_row(b"bad")[0][0]] = -1  # the word itself
    monkeypatch.setattr(pu_quality, "train", lambda *_, **__: (weights, 0.0, 0.5))
    rows = [(1, "bad"), (1, "quiet"), (None, "bad"), (None, "quiet"), (2, None)]
    assert left(corpus_pipeline.good_quality, rows) == [(1, "quiet"), (2, None), (None, "quiet")]


def test_pipeline(spark, tables):
    from turnstile.llm import decontamination, pii, pu_quality, simhash
    from turnstile.llm.common import stash

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "pu_quality", "simhash_dedup", "decontamination", "personal_data", "packing",
    ]
    docs = tables("documents")
    scores = pu_quality.score_quality(docs, tables("labels")).collect()
    good = {r.doc_id for r in scores if r.predicted == 1}
    kept = stash(corpus_pipeline.good_quality(spark, docs, SF))
    assert {r.doc_id for r in kept.collect()} == good and 0 < len(good) <= len(scores)
    groups = {r.doc_id: r.component_id for r in simhash.simhash_groups(kept).collect()}
    single = stash(corpus_pipeline.near_duplicates(spark, kept, SF))
    assert {r.doc_id for r in single.collect()} == set(groups.values())
    leaks = {r.doc_id for r in decontamination.find_leaks(single, tables("benchmark")).collect()}
    clean = stash(corpus_pipeline.no_benchmark(spark, single, SF))
    assert {r.doc_id for r in clean.collect()} == set(groups.values()) - leaks
    private = stash(corpus_pipeline.no_personal_data(spark, clean, SF))
    assert private.columns == docs.columns and private.dtypes == docs.dtypes
    found = {r.doc_id: r.spans for r in pii.find_personal_data(clean).collect()}
    before, after = ({r.doc_id: r for r in d.collect()} for d in (clean, private))
    for i, r in after.items():
        assert (r.text == before[i].text) == (not found[i]) and r.n_chars == len(r.text)
    pieces = corpus_pipeline.packed(spark, private, SF).collect()
    assert {r.doc_id for r in pieces} == set(after)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(np.frombuffer(r.ids, "<u4")) == r.length for r in pieces)
    assert sorted((r.doc_id, r.piece) for r in corpus_pipeline.run(spark, SF).collect()) == sorted((r.doc_id, r.piece) for r in pieces)


def test_user_row_columns_survive_the_filters(spark):
    from turnstile.llm import decontamination, simhash

    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, words, "mine", 7), (2, words, "yours", 8), (3, "lambda mu nu xi omicron pi rho sigma tau upsilon", "theirs", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, __row int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]
    items = spark.createDataFrame([(5, "lambda mu nu xi omicron pi rho sigma tau upsilon")], "item_id long, text string")
    clean = decontamination.without_leaks(docs, items)
    assert sorted(tuple(r) for r in clean.collect()) == rows[:2]
