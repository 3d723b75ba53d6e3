"""Ranked search, nearest neighbours and hard negatives against brute force,
and on odd tables."""

from __future__ import annotations

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.llm import lexical, negatives, neighbours
from remitlens.llm.queries import SQL

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
NAN, INF = float("nan"), float("inf")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, top=20):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs, words = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // max(words, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if b[t])
            scores += [(-s, i is None, i)] if s > 0 else []
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def hits(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ranked_search_matches_all_scores(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
    want = ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert hits(lexical.ranked_documents(docs, items)) == want
    # items in several blocks and groups, documents in several matrices
    monkeypatch.setattr(lexical, "CELLS", 1 << 12)
    assert hits(lexical.ranked_documents(docs.repartition(5), items, block_bytes=4000)) == want


def test_dual_search_scores_few_leaves():
    """Items of one topic meet only the leaves of that topic."""
    rng = np.random.default_rng(0)
    item = np.repeat(np.arange(64), 4)
    term = (item // 8) * 20 + np.tile(np.arange(4), 64)
    weight = np.full(160, 1000, np.int64)
    group = lexical.item_groups(item, term, np.ones(256, np.int64), weight, 64)[0]
    dense = np.zeros((1024, group.term_count), np.float32)
    for d in range(1024):
        dense[d, rng.choice(np.flatnonzero(group.column >= 0)[:4], 2, False) * 0 + rng.integers(0, 4, 2) + 4 * (d // 128)] = 500
    best = lexical.Best(np.zeros(64, np.int64), 20)
    pairs = lexical.dual_search(np.arange(1024), dense, group, best)
    assert pairs <= 8 * 8 and (best.kth > 0).all()


def test_ranked_search_on_odd_rows(spark):
    long = "Alpha " * 200_000 + "beta"
    rows = [
        (1, "alpha beta"), (1, "alpha beta"), (2, "ALPHA beta!"), (3, None), (4, ""), (5, "-- ;"), (None, "alpha beta gamma"),
        (None, "delta"), (6, "é ÉX b\x00c"), (7, long),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("item", "part", "rank", "score", "id", "term")})
    asked = [(10, "alpha alpha Beta"), (10, "alpha alpha Beta"), (11, None), (12, ""), (13, "é bc b c"), (None, "gamma delta"), (14, "nowhere")]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumns({c: F.lit("x") for c in ("item", "doc_id", "rank")})
    assert hits(lexical.ranked_documents(docs, items)) == ranked(rows, asked)
    assert hits(lexical.ranked_documents(docs, items, top=2)) == ranked(rows, asked, 2)
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        empty = lexical.ranked_documents(a, b)
        assert empty.columns == ["item_id", "rank", "doc_id", "score"] and not empty.collect()


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({c: F.lit("x") for c in ("node", "row", "query", "unit", "cell", "code", "anchor", "vector", "score", "rank", "place")})


def clustered(n, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(20, 16))[rng.integers(0, 20, n)] + rng.normal(size=(n, 16))
    if copies:
        x[:copies] = x[0] + rng.normal(size=(copies, 16)) * 0.01
    return [(i, x[i].astype(np.float32).tolist(), int(rng.integers(0, 10))) for i in range(n)]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def nearest(rows, top=20):
    """(query row, its best rows) by exact products, filled up with 0."""
    ok = [r for r in rows if usable(r[1]) and any(r[1])]
    product = lambda a, b: sum(float(np.float32(x)) * float(np.float32(y)) for x, y in zip(a, b, strict=False))
    out = {}
    for k, r in enumerate(ok):
        if r[0] is not None and r[0] % 20 == 0:
            s = [(-product(r[1], o[1]), o[0] is None, o[0] or 0) for j, o in enumerate(ok) if j != k]
            out.setdefault(r[0], []).extend((i + 1, None if null else v, -x) for i, (x, null, v) in enumerate(sorted(s)[:top]))
    return out


@pytest.mark.parametrize("copies", [0, 700])
def test_nearest_neighbours_recall(spark, copies):
    rows = clustered(2000, copies=copies)
    got = neighbours.nearest_neighbours(vectors(spark, rows)).collect()
    want, found = nearest(rows), collections.defaultdict(set)
    for r in got:
        found[r.query_id].add(r.vec_id)
    for q, best in want.items():
        assert sorted(r["rank"] for r in got if r.query_id == q) == list(range(1, 21)), q
    scores = {(q, v): s for q, best in want.items() for _, v, s in best}
    assert all(math.isclose(r.score, scores[r.query_id, r.vec_id], rel_tol=1e-12) for r in got if (r.query_id, r.vec_id) in scores)
    recall = sum(len({v for _, v, _ in best} & found[q]) for q, best in want.items()) / (20 * len(want))
    assert recall >= 0.95, recall
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("remitlens_")]


def test_nearest_neighbours_on_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1), (20, [0.5, 0.5, 0.5], 1), (40, [0.0, 0.0], 1), (60, None, 1), (80, [], 1), (100, [NAN, 1.0], 1), (120, [INF, 1.0], 1),
        (140, [None, 1.0], 1), (1, [1.0, 0.0], None), (1, [1.0, 0.0], 2), (None, [2.0, -3.0], 1), (2, [-1.0, 5.0], 1), (3, [1e-3, 1e-3], 1),
    ]
    got = neighbours.nearest_neighbours(vectors(spark, rows)).collect()
    found = collections.defaultdict(list)
    for r in got:
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = nearest(rows)
    assert set(found) == set(want) == {0, 20}
    for q in want:
        assert sorted(found[q]) == pytest.approx(sorted(want[q])) if all(v is not None for _, v, _ in want[q]) else str(sorted(found[q])) == str(sorted(want[q]))
    one = neighbours.nearest_neighbours(vectors(spark, rows[:1]))
    assert one.columns == ["query_id", "rank", "vec_id", "score"] and not one.collect()
    assert not neighbours.nearest_neighbours(vectors(spark, rows).limit(0)).collect()


def mined(rows):
    ok = []
    for i, v, label in rows:
        if label is not None and usable(v):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            whole = [max(min(math.floor(256 * float(np.float32(x))), 1 << 24), -(1 << 24)) for x in v]
            ok.append((i, whole, label))
    out = []
    for k, (i, v, label) in enumerate(ok):
        if i is None or i % 100:
            continue
        by = sorted((-sum(a * b for a, b in zip(v, o[1], strict=False)), o[0] is None, o[0] or 0, j) for j, o in enumerate(ok) if j != k)
        for s, null, p, j in [x for x in by if ok[x[3]][2] == label][:5]:
            fit = [x for x in by if ok[x[3]][2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, None if null else p, r + 1, None if x[1] else x[2], -s, -x[0]) for r, x in enumerate(fit)]
    return sorted(out, key=str)


@pytest.mark.parametrize("copies", [0, 900])
def test_hard_negatives_match_all_scores(spark, copies):
    rows = clustered(1500, seed=1, copies=copies)
    df = vectors(spark, rows)
    assert hits(negatives.hard_negatives(df, relabel=negatives.shifted_label())) == mined(rows)
    if not copies:
        assert hits(negatives.hard_negatives(df, relabel=negatives.shifted_label(), chunk=7, block=3)) == mined(rows)


def test_hard_negatives_on_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (100, [0.5, 0.5, 0.5], 1), (200, [0.0, 0.0], 1), (300, None, 1), (400, [], 1), (500, [NAN, 1.0], 1), (600, [INF, 1.0], 1),
        (700, [None, 1.0], 1), (1, [1.0, 0.0], None), (2, [1.0, 0.25], 2), (2, [1.0, 0.25], 2), (None, [1.0, 0.25], 2), (None, [1.0, 0.25], 1), (3, [-1.0, 5.0], 1),
        (4, [1e30, 1.0], 3), (7, [1.0, 0.5], 0), (7, [1.0, 0.5], 9),
    ]
    got = negatives.hard_negatives(vectors(spark, rows), relabel=negatives.shifted_label())
    assert hits(got) == mined(rows) and got.count() > 10
    empty = negatives.hard_negatives(vectors(spark, rows).limit(0))
    assert empty.columns == got.columns and not empty.collect()


def test_walk_goes_down_and_stops_when_certified():
    rng = np.random.default_rng(3)
    one, two = rng.normal(size=negatives.CODES), rng.normal(size=negatives.CODES)
    seen = list(negatives.walk(one, two))
    assert len({c for _, c in seen}) == negatives.CODES**2 and [b for b, _ in seen] == sorted((b for b, _ in seen), reverse=True)
    rows = rng.integers(-50, 50, (500, 8))
    books = tuple(negatives.codebook(rows[:, h]) for h in negatives._halves(8))
    radii = tuple(np.zeros(len(b)) for b in books)
    everything = set(range(negatives.CODES**2))
    first = negatives.next_cells(rows[0], books, radii, everything, 0, 10, lambda b: False)
    then = negatives.next_cells(rows[0], books, radii, everything, 10, 10, lambda b: False)
    assert len(first) == len(then) == 10 and not set(first) & set(then)
    assert negatives.next_cells(rows[0], books, radii, everything, 0, 10, lambda b: True) == []


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_hard_negatives"])
def test_sql_agrees(spark, name):
    import duckdb

    from remitlens.llm.queries import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = queries()[name](spark, SMALL)
    rel = con.sql(SQL[name])
    assert rel.columns == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())
