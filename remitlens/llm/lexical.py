"""Ranked lexical search: a dual tree over test items and documents.

Documents are indexed once, by the terms that some item holds. A task reads the
index batch by batch, puts documents that share their rarest terms side by side
and builds a tree over them; each node holds, for each term, the largest impact
of its documents. The items have a tree of their own, with the largest weights.
The product of two nodes bounds every score of the items of one against the
documents of the other; a pair whose bound is below the weakest kth score of the
items is pruned with all that lies below it. Scores are integers, and bounds are
computed in whole numbers, so pruning loses nothing, ties included.

The weakest kth scores start from a first, cheap descent over all batches, so
tasks prune by what the whole corpus holds and not only by what they have seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm import text as T
from remitlens.llm.scratch import cut

#: Hits of an item.
TOP = 20
#: Bytes of item text that one pass over the documents serves.
BLOCK_BYTES = 512 << 10
#: Cells (items or documents by terms) of a matrix that a task holds.
CELLS = 1 << 21
#: Documents of an index row, and of a leaf; items of a leaf; children of a node.
BATCH_DOCS = 2048
LEAF_DOCS = 16
LEAF_ITEMS = 8
FAN = 8
#: Groups of tasks whose hits are merged first.
PARTS = 256
_NO_ID = np.iinfo(np.int64).max
_U64 = np.uint64


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first eight bytes mixed with the length, first term of each text)
    of all terms of a column."""
    data, offsets = T.flat(column)
    return _terms(data, offsets)


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = T.lower_table()[data]
    starts, ends, first = T.words(low, offsets, T.alnum_words())
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    head = np.zeros(len(starts), _U64)
    for i in range(8):
        inside = starts + i < ends
        head |= np.where(inside, padded[np.minimum(starts + i, len(low))], 0).astype(_U64) << _U64(8 * i)
    return T.word_hashes(low, starts, ends), T.mix(head ^ (ends - starts).astype(_U64)), first


def _index(shared):
    """Rows of the index: ids, whether there is an id, terms in the text, and
    for each document the numbers and counts of the items' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, checks = shared.value
        held: list[tuple[np.ndarray, ...]] = []
        n_held = 0

        def row() -> pa.RecordBatch:
            ids, null, n, size, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            cells = (ids, null, n, size, term.astype(np.int32), tf.astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in cells], names=["ids", "null", "n", "size", "term", "tf"])

        for batch in batches:
            null = np.asarray(batch.column(0).is_null())
            ids = np.asarray(batch.column(0).fill_null(_NO_ID))
            for a, b, data, offsets in T.pieces(batch.column(1)):
                hashes, heads, first = _terms(data, offsets)
                at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
                hit = np.flatnonzero((names[at] == hashes) & (checks[at] == heads))
                doc = np.searchsorted(first, hit, "right") - 1
                cell, tf = np.unique(doc.astype(np.int64) * len(names) + at[hit], return_counts=True)
                size = np.bincount(cell // len(names), minlength=b - a)
                held.append((ids[a:b], null[a:b], np.diff(first).astype(np.int64), size.astype(np.int64), cell % len(names), tf))
                n_held += b - a
                if n_held >= BATCH_DOCS:
                    yield row()
                    held, n_held = [], 0
        if held:
            yield row()

    return run


_INDEX = "ids binary, null binary, n binary, size binary, term binary, tf binary"


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    kinds = (np.int64, np.bool_, np.int64, np.int64, np.int32, np.int32)
    for i in range(batch.num_rows):
        yield tuple(np.frombuffer(batch.column(c)[i].as_py(), k) for c, k in enumerate(kinds))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's document counts by term; -1 has its terms, -2 its documents
    with terms."""
    total: dict[int, int] = {}
    for batch in batches:
        for _, _, n, _, term, _ in _batches(batch):
            found, count = np.unique(term, return_counts=True)
            for t, c in [*zip(found.tolist(), count.tolist(), strict=True), (-1, int(n.sum())), (-2, int((n > 0).sum()))]:
                total[t] = total.get(t, 0) + c
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], names=["term", "count"])


def levels(leaves: np.ndarray, fan: int = FAN) -> list[np.ndarray]:
    """Coordinate maxima of a tree's nodes, from the leaves to one root."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append(np.maximum.reduceat(out[-1], np.arange(0, len(out[-1]), fan), axis=0))
    return out


def _by_rarest(owner: np.ndarray, weight: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
    """Owners in the order of their two terms of the largest weights."""
    order = np.lexsort((term, -weight, owner))
    o, t = owner[order], term[order].astype(np.int64)
    first = np.searchsorted(o, np.arange(n))
    last = np.searchsorted(o, np.arange(n), "right")
    padded = np.append(t, [-1, -1])
    one = np.where(last > first, padded[np.minimum(first, len(t))], -1)
    two = np.where(last > first + 1, padded[np.minimum(first + 1, len(t))], -1)
    return np.lexsort((two, one))


class Items:
    """Some items with their tree: their numbers, terms and weights."""

    def __init__(self, numbers: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int):
        self.numbers = numbers
        self.column = np.full(n_terms, -1, np.int64)
        self.column[terms] = np.arange(len(terms))
        self.term_count = len(terms)
        self.weights = weights
        self.tree = levels(np.maximum.reduceat(weights, np.arange(0, len(weights), LEAF_ITEMS), axis=0))

    def weakest(self, kth: np.ndarray) -> list[np.ndarray]:
        """The least kth score below each node."""
        out = [np.minimum.reduceat(kth[self.numbers], np.arange(0, len(self.numbers), LEAF_ITEMS))]
        while len(out[-1]) > 1:
            out.append(np.minimum.reduceat(out[-1], np.arange(0, len(out[-1]), FAN)))
        return out


def item_groups(item: np.ndarray, term: np.ndarray, count: np.ndarray, weight: np.ndarray, n_items: int) -> list[Items]:
    """The items in groups whose matrices have CELLS cells at most (or one item)."""
    order = _by_rarest(item, weight[term], term, n_items)
    place = np.empty(n_items, np.int64)
    place[order] = np.arange(n_items)
    cells = np.lexsort((term, place[item]))
    item, term, count = place[item][cells], term[cells], count[cells]
    first = np.searchsorted(item, np.arange(n_items + 1))
    groups, a = [], 0
    while a < n_items:
        b, held = a, np.zeros(0, term.dtype)
        while b < n_items:
            more = np.union1d(held, term[first[b] : first[b + 1]])
            if b > a and len(more) * (b + 1 - a) > CELLS:
                break
            held, b = more, b + 1
        if len(held):
            cut_ = slice(first[a], first[b])
            # whole numbers: doubles hold them up to 2**53, else 64-bit integers
            per_item = np.bincount(item[cut_] - a, weights=(count[cut_] * weight[term[cut_]]).astype(np.float64), minlength=b - a)
            kind = np.float64 if per_item.max() * 1e6 < 2**53 else np.int64
            dense = np.zeros((b - a, len(held)), kind)
            dense[item[cut_] - a, np.searchsorted(held, term[cut_])] = count[cut_] * weight[term[cut_]]
            groups.append(Items(order[a:b], held, dense, len(weight)))
        a = b
    return groups


class Best:
    """The best hits of each item so far."""

    def __init__(self, kth: np.ndarray, top: int):
        self.top, self.start, self.kth = top, kth, kth.copy()
        self.scores = np.zeros((len(kth), top), np.int64)
        self.hits: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: items by documents."""
        i, d = np.nonzero((scores >= self.kth[items][:, None]) & (scores > 0))
        if not len(i):
            return
        some = np.unique(i)
        both = np.concatenate([self.scores[items[some]], scores[some]], axis=1)
        self.scores[items[some]] = -np.sort(-both, axis=1)[:, : self.top]
        self.kth[items[some]] = np.maximum(self.start[items[some]], self.scores[items[some], -1])
        self.hits.append((items[i], scores[i, d], ids[d]))
        self.held += len(i)
        if self.held > 1 << 20:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, ...]:
        """Only the best hits of each item, ties by the smaller id."""
        if not self.hits:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        item, score, doc = (np.concatenate(x) for x in zip(*self.hits, strict=True))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        keep = np.arange(len(item)) - np.searchsorted(item, item) < self.top
        self.hits, self.held = [(item[keep], score[keep], doc[keep])], int(keep.sum())
        return self.hits[0]


def _documents(row: tuple[np.ndarray, ...], group: Items, weight: np.ndarray, docs: int, tokens: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, impacts by term) of the documents of an index row, in parts of
    bounded size; a document without the group's terms is left out."""
    ids, null, n, size, term, tf = row
    ids = np.where(null, _NO_ID, ids)
    owner = np.repeat(np.arange(len(ids)), size)
    own = group.column[term] >= 0
    owner, term, tf = owner[own], term[own], tf[own].astype(np.int64)
    if not len(owner):
        return
    length = 100 - 25 + (25 * n * docs) // max(tokens, 1)
    impact = (1_000_000_000 * tf) // (1000 * tf + 12 * length[owner])
    order = _by_rarest(owner, weight[term], term, len(ids))
    order = order[np.bincount(owner, minlength=len(ids))[order] > 0]
    place = np.full(len(ids), -1, np.int64)
    place[order] = np.arange(len(order))
    at = place[owner]
    step = max(LEAF_DOCS, 4 * CELLS // group.term_count // LEAF_DOCS * LEAF_DOCS)
    for a in range(0, len(order), step):
        b = min(a + step, len(order))
        inside = (at >= a) & (at < b)
        dense = np.zeros((b - a, group.term_count), np.float32)
        dense[at[inside] - a, group.column[term[inside]]] = impact[inside]  # below 10**6: exact
        yield ids[order[a:b]], dense


def _leaves(dense: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(dense, np.arange(0, len(dense), LEAF_DOCS), axis=0)


def first_descent(ids: np.ndarray, dense: np.ndarray, group: Items, best: Best) -> None:
    """Scores each item against the leaf of its best bound."""
    leaves = _leaves(dense)
    kind = group.weights.dtype
    chosen = (group.weights @ leaves.T.astype(kind)).argmax(axis=1)
    for leaf in np.unique(chosen):
        own = slice(leaf * LEAF_DOCS, (leaf + 1) * LEAF_DOCS)
        items = np.flatnonzero(chosen == leaf)
        cols = np.flatnonzero(leaves[leaf])
        best.add(group.numbers[items], (group.weights[np.ix_(items, cols)] @ dense[own][:, cols].T.astype(kind)).astype(np.int64), ids[own])


def dual_search(ids: np.ndarray, dense: np.ndarray, group: Items, best: Best) -> int:
    """Visits all pairs of nodes that may hold a hit; returns how many pairs of
    leaves were scored."""
    tree = levels(_leaves(dense))
    kind = group.weights.dtype
    scored = 0

    def visit(level: int, node: int, item_level: int, items: np.ndarray) -> None:
        nonlocal scored
        top = tree[level][node]
        cols = np.flatnonzero(top)
        bound = group.tree[item_level][np.ix_(items, cols)] @ top[cols].astype(kind)
        alive = items[(bound >= group.weakest(best.kth)[item_level][items]) & (bound > 0)]
        if not len(alive):
            return
        if item_level:
            below = (alive[:, None] * FAN + np.arange(FAN)).reshape(-1)
            below = below[below < len(group.tree[item_level - 1])]
            return visit(level, node, item_level - 1, below)
        if level:
            children = np.arange(node * FAN, min((node + 1) * FAN, len(tree[level - 1])))
            best_first = (group.tree[0][np.ix_(alive, cols)] @ tree[level - 1][np.ix_(children, cols)].T.astype(kind)).max(axis=0)
            for child in children[np.argsort(-best_first, kind="stable")]:
                visit(level - 1, int(child), 0, alive)
            return None
        scored += len(alive)
        members = (alive[:, None] * LEAF_ITEMS + np.arange(LEAF_ITEMS)).reshape(-1)
        members = members[members < len(group.numbers)]
        own = slice(node * LEAF_DOCS, (node + 1) * LEAF_DOCS)
        scores = group.weights[np.ix_(members, cols)] @ dense[own][:, cols].T.astype(kind)
        best.add(group.numbers[members], scores.astype(np.int64), ids[own])
        return None

    visit(len(tree) - 1, 0, len(group.tree) - 1, np.arange(len(group.tree[-1])))
    return scored


_HITS = "item int, part int, doc_id long, score long"


def _search(shared, first: bool):
    """A task's best hits of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, term, count, weight, n_items, docs, tokens, kth, top = shared.value
        groups = item_groups(item, term, count, weight, n_items)
        best = Best(kth, top)
        for batch in batches:
            for row in _batches(batch):
                for group in groups:
                    for ids, dense in _documents(row, group, weight, docs, tokens):
                        (first_descent if first else dual_search)(ids, dense, group, best)
        item, score, doc = best.shrink()
        part = np.full(len(item), TaskContext.get().partitionId() % PARTS, np.int32)
        for a in range(0, len(item), 10_000):
            b = slice(a, a + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item[b], pa.int32()), pa.array(part[b]), pa.array(doc[b], pa.int64(), mask=doc[b] == _NO_ID), pa.array(score[b], pa.int64())],
                names=["item", "part", "doc_id", "score"],
            )

    return run


def _merged(hits: DataFrame, top: int) -> DataFrame:
    """The best hits of each item over all tasks, merged in two rounds, so
    that no task merges the hits of all others."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for keys in (["item", "part"], ["item"]):
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return hits


def _search_block(docs: DataFrame, items: list[tuple], top: int) -> DataFrame | None:
    """(item, rank, doc_id, score) of one block of items, numbered from 0."""
    spark = docs.sparkSession
    hashes, heads, first = terms_of(pa.array([t for _, t in items], pa.large_string()))
    if not len(hashes):
        return None
    names, at, number = np.unique(hashes, return_index=True, return_inverse=True)
    owner = np.repeat(np.arange(len(items)), np.diff(first))
    cell, count = np.unique(owner.astype(np.int64) * len(names) + number, return_counts=True)
    item, term = cell // len(names), cell % len(names)
    index = cut(docs.mapInArrow(_index(spark.sparkContext.broadcast((names, heads[at]))), _INDEX))
    # one row for each term of the block, and two
    totals = {r[0]: r[1] for r in index.mapInArrow(_count, "term int, count long").groupBy("term").agg(F.sum("count")).collect()}
    n_docs, n_tokens = totals.get(-2, 0), totals.get(-1, 0)
    if not n_docs:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * totals.get(t, 0) + 1))) for t in range(len(names))], np.int64)

    def search(kth: np.ndarray, is_first: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast((item, term, count, weight, len(items), n_docs, n_tokens, kth, top))
        return _merged(index.mapInArrow(_search(shared, is_first), _HITS), top)

    kth = np.zeros(len(items), np.int64)
    for r in search(kth, True).where(F.col("rank") == top).select("item", "score").collect():  # one row an item
        kth[r[0]] = r[1]
    return search(kth, False)


def ranked_documents(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score.

    Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
    with A-Z lower-cased. A document scores the sum, over the item's terms with
    their repeats, of ``w * ((10**9 * tf) div (1000 * tf + 12 * m))``; ``w`` and
    ``m`` as given by the corpus counts. Only scores above 0 are hits; equal
    ones rank by ascending doc_id, a null one last.

    Null and empty texts have no terms: such documents are no hits and such
    items have no rows. Every row is a document or an item of its own, also
    when ids repeat (documents that agree in id and score may swap ranks). An
    empty table gives no rows. Other columns are not read.

    One pass over the documents serves ``block_bytes`` of item text; a larger
    benchmark is searched block by block.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    volume = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    blocks = max(1, -(-volume // block_bytes))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        hits = _search_block(texts, [(r[0], r[1]) for r in own], top) if own else None
        if hits is None:
            continue
        ids = spark.createDataFrame([(i, r[0]) for i, r in enumerate(own)], f"item int, item_id {kind}")
        found = hits.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # a block's ids: bounded
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
