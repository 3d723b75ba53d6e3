"""Hard negatives by an inverted multi-index.

A vector is cut into two halves, and each half has a codebook; a pair of codes
is a cell. With a codebook's largest residual (its radius), a half of the anchor
bounds its half score with every member of a code, and the sum of two such
bounds bounds the scores of a cell. A heap walks the cells of an anchor by
descending bound (the multi-sequence algorithm) and stops once the bound of the
next cell shows that no later row can change the answer.

Cells are stored in chunks of bounded size. In each round, every anchor names
the next cells of its walk; anchors of one chunk meet it in blocks, and only the
best rows of a chunk come back. All scores are whole numbers and exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.scratch import cut
from remitlens.llm.vectors import stored_by, usable

#: Codes of a codebook; rows that train the codebooks, at most.
CODES = 16
SAMPLE = 4096
#: Rows of a chunk, anchors of a block, about.
CHUNK = 1024
BLOCK = 256
#: Cells of an anchor's first round; each later round takes four times as many.
FIRST_CELLS = 16
#: Whole components are kept within this, so scores fit in 64 bits.
LIMIT = 1 << 24
_NO_ID = np.iinfo(np.int64).max


def codebook(rows: np.ndarray, codes: int = CODES, rounds: int = 8) -> np.ndarray:
    """Centres of the rows, by k-means from spread-out rows."""
    centres = np.unique(rows, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(codes, len(centres))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        own = nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        count = np.bincount(own, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


def _halves(width: int) -> tuple[slice, slice]:
    return slice(0, (width + 1) // 2), slice((width + 1) // 2, width)


def _coded(column: pa.Array, width: int) -> np.ndarray:
    """Whole components as rows; shorter vectors are filled up with 0."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _assign(shared, width: int):
    """Adds the cell, the two residuals and the packed components of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            rows = _coded(batch.column(3).combine_chunks() if isinstance(batch.column(3), pa.ChunkedArray) else batch.column(3), width)
            codes, away = [], []
            for half, centres in zip(_halves(width), books, strict=True):
                own = nearest(rows[:, half], centres)
                codes.append(own)
                away.append(np.sqrt(((rows[:, half] - centres[own]) ** 2).sum(axis=1)))
            packed = [r.tobytes() for r in rows.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(codes[0] * CODES + codes[1], pa.int32()), pa.array(away[0]), pa.array(away[1]), pa.array(packed, pa.binary())],
                names=["row", "vec_id", "label", "cell", "away_1", "away_2", "code"],
            )

    return run


def walk(bounds_1: np.ndarray, bounds_2: np.ndarray) -> Iterator[tuple[float, int]]:
    """(bound, cell) of all pairs of codes, by descending summed bound."""
    one, two = np.argsort(-bounds_1, kind="stable"), np.argsort(-bounds_2, kind="stable")
    heap = [(-(bounds_1[one[0]] + bounds_2[two[0]]), 0, 0)]
    while heap:
        least, i, j = heapq.heappop(heap)
        yield -least, int(one[i]) * CODES + int(two[j])
        # each pair is pushed once: along the second half, or at its start
        if j + 1 < len(two):
            heapq.heappush(heap, (-(bounds_1[one[i]] + bounds_2[two[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (-(bounds_1[one[i + 1]] + bounds_2[two[0]]), i + 1, 0))


def next_cells(code: np.ndarray, books, radii, filled: set[int], cursor: int, step: int, certified) -> list[int]:
    """The next ``step`` filled cells of an anchor's walk after ``cursor``
    filled ones, up to the first whose bound is ``certified``."""
    bounds = []
    for half, centres, away in zip(_halves(len(code)), books, radii, strict=True):
        own = code[half].astype(np.float64)
        reach = np.sqrt((own**2).sum()) * away
        raw = centres @ own + reach
        # room for rounding: a bound is never too small
        bounds.append(raw + 1e-6 * (1 + np.abs(centres) @ np.abs(own) + reach))
    out, seen = [], 0
    for bound, cell in walk(*bounds):
        if len(out) == step or certified(bound):
            break
        if cell in filled:
            seen += 1
            if seen > cursor:
                out.append(cell)
    return out


def _next(shared, cursor: int, step: int, windows: bool):
    """The cells that each anchor visits in this round. ``known`` holds, for
    the positives, the least of the found scores if enough are found; for the
    negatives, of each open window its positive's score and row and the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, radii, filled = shared.value
        for batch in batches:
            cells = []
            for code, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                least = [k["least"] for k in known or ()]
                if windows:
                    lows = [0.8 * k["score"] if k["score"] >= 0 else np.inf for k in known or ()]
                    # no later row is in any window, or none ranks among its rows
                    certified = lambda b, least=least, lows=lows: all(b < lo or x is not None and b < x for lo, x in zip(lows, least, strict=True))
                else:
                    certified = lambda b, least=least: bool(least) and least[0] is not None and b < least[0]
                cells.append(next_cells(np.frombuffer(code, np.int32), books, radii, filled, cursor, step, certified))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.list_(pa.int32()))], names=["anchor", "cells"])

    return run


def _rank(owner: np.ndarray, scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the best ``top`` of each owner, ties by the smaller id."""
    order = np.lexsort((ids, -scores, owner))
    o = owner[order]
    return order[np.arange(len(o)) - np.searchsorted(o, o) < top]


def _score(width: int, top: int, windows: bool):
    """Best rows of a chunk for the anchors of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchors, members = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                a = np.frombuffer(b"".join(x["code"] for x in anchors), np.int32).reshape(-1, width)
                m = np.frombuffer(b"".join(x["code"] for x in members), np.int32).reshape(-1, width)
                # doubles hold whole numbers up to 2**53
                small = float(np.abs(a).max(initial=0)) * float(np.abs(m).max(initial=0)) * width < 2**53
                scores = (a.astype(np.float64) @ m.astype(np.float64).T).astype(np.int64) if small else a.astype(np.int64) @ m.astype(np.int64).T
                ids = np.array([_NO_ID if x["vec_id"] is None else x["vec_id"] for x in members], np.int64)
                rows = np.array([x["row"] for x in members], np.int64)
                labels = np.array([x["label"] for x in members], np.int64)
                same = np.array([x["label"] for x in anchors], np.int64)[:, None] == labels[None, :]
                names = np.array([x["anchor"] for x in anchors], np.int64)
                out = []
                if not windows:
                    floor = np.array([(x["known"] or [{}])[0].get("least") if x["known"] else None for x in anchors], dtype=object)
                    floor = np.array([np.iinfo(np.int64).min if f is None else f for f in floor], np.int64)
                    who, what = np.nonzero(same & (names[:, None] != rows[None, :]) & (scores >= floor[:, None]))
                    got = scores[who, what]
                    keep = _rank(who, got, ids[what], top)
                    out.append((names[who[keep]], np.full(len(keep), -1), got[keep], what[keep]))
                else:
                    for x, s, own in zip(anchors, scores, same, strict=True):
                        for k in x["known"] or ():
                            p, least = k["score"], k["least"]
                            # whole numbers: 80 p <= 100 n <= 100 p
                            ok = np.flatnonzero(~own & (s <= p) & (5 * s >= 4 * p) & (s >= (least if least is not None else np.iinfo(np.int64).min)))
                            ok = ok[_rank(np.zeros(len(ok), np.int64), s[ok], ids[ok], top)]
                            out.append((np.full(len(ok), x["anchor"]), np.full(len(ok), k["row"]), s[ok], ok))
                who, window, got, what = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who, pa.int64()), pa.array(window, pa.int64()), pa.array(got, pa.int64()), pa.array(ids[what], pa.int64(), mask=ids[what] == _NO_ID), pa.array(rows[what], pa.int64())],
                    names=["anchor", "window", "score", "vec_id", "row"],
                )

    return run


_FOUND = "anchor long, window long, score long, vec_id long, row long"
_KNOWN = "array<struct<score: long, row: long, least: long>>"


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


class MultiIndex:
    """Codebooks, radii and stored chunks of the rows (row, vec_id, label, code)."""

    def __init__(self, rows: DataFrame, width: int, chunk: int):
        spark = rows.sparkSession
        self.width, self.spark = width, spark
        # a bounded sample of rows: those of the smallest hashes
        sample = rows.select("whole").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).toArrow().column(0).combine_chunks()
        trained = _coded(sample, width)
        self.books = tuple(codebook(trained[:, half]) for half in _halves(width))
        shared = spark.sparkContext.broadcast(self.books)
        self.rows = cut(
            rows.select("row", "vec_id", "label", "whole").mapInArrow(
                _assign(shared, width), "row long, vec_id long, label long, cell int, away_1 double, away_2 double, code binary"
            )
        )
        # one row a cell: bounded by the codebooks
        cells = self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away_1").alias("a"), F.max("away_2").alias("b")).collect()
        radii = np.zeros((2, CODES))
        for r in cells:
            radii[0, r["cell"] // CODES] = max(radii[0, r["cell"] // CODES], r["a"])
            radii[1, r["cell"] % CODES] = max(radii[1, r["cell"] % CODES], r["b"])
        self.radii = tuple(x[: len(b)] for x, b in zip(radii, self.books, strict=True))
        self.filled = {r["cell"] for r in cells}
        #: (cell, chunks): a frame of known size, as large as the codebooks' pairs
        self.directory = spark.createDataFrame([(r["cell"], -(-r["n"] // chunk)) for r in cells], "cell int, chunks long")

    def chunks(self) -> DataFrame:
        """The rows of each chunk: those of a cell, dealt out by hash."""
        number = F.pmod(F.xxhash64("row"), F.col("chunks"))
        return (
            self.rows.join(F.broadcast(self.directory), "cell")
            .select(F.struct("cell", number.alias("number")).alias("at"), F.struct("row", "vec_id", "label", "code").alias("member"))
            .groupBy(F.xxhash64("at").alias("chunk"), "at")
            .agg(F.collect_list("member").alias("members"))
        )

    def search(self, chunks: DataFrame, anchors: DataFrame, top: int, windows: bool, blocks: int) -> DataFrame:
        """The best rows of each anchor (and window) over all cells that can
        hold one. ``anchors``: anchor, code, label, known (the windows)."""
        plan = self.spark.sparkContext.broadcast((self.books, self.radii, self.filled))
        found, known, cursor, step = None, anchors, 0, FIRST_CELLS
        while cursor < len(self.filled):
            cells = known.select("anchor", "code", "known").mapInArrow(_next(plan, cursor, step, windows), "anchor long, cells array<int>")
            visits = (
                cells.where(F.size("cells") > 0)
                .join(known, "anchor")
                .select(F.explode("cells").alias("cell"), F.struct("anchor", "code", "label", "known").alias("one"))
                .join(F.broadcast(self.directory), "cell")
                .select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("number"), "cell", "one")
                .select(F.struct("cell", "number").alias("at"), F.pmod(F.xxhash64("one.anchor"), F.lit(blocks)).alias("block"), "one")
                .groupBy("at", "block")
                .agg(F.collect_list("one").alias("ones"))
            )
            met = visits.withColumn("chunk", F.xxhash64("at")).join(chunks, ["chunk", "at"]).select("ones", "members")
            new = met.mapInArrow(_score(self.width, top, windows), _FOUND)
            found = cut(_best(new if found is None else new.unionByName(found.drop("rank")), top))
            cursor, step = cursor + step, step * 4
            least = F.when(F.count(F.lit(1)) >= top, F.min("score")).alias("least")
            if windows:
                per = found.groupBy("anchor", "window").agg(least).select(F.col("anchor").alias("a"), F.col("window").alias("w"), "least")
                opened = anchors.select("anchor", F.explode("known").alias("k"))
                state = opened.join(per, (F.col("anchor") == F.col("a")) & (F.col("k.row") == F.col("w")), "left").groupBy("anchor").agg(
                    F.collect_list(F.struct(F.col("k.score").alias("score"), F.col("k.row").alias("row"), "least")).alias("known")
                )
            else:
                state = found.groupBy("anchor").agg(least).select(
                    "anchor", F.array(F.struct(F.lit(None).cast("long").alias("score"), F.lit(None).cast("long").alias("row"), "least")).alias("known")
                )
            known = cut(anchors.drop("known").join(state, "anchor", "left").withColumn("known", F.col("known").cast(_KNOWN)))
        return found


def hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor=None, relabel=None,
    positives: int = 5, negatives: int = 5, chunk: int = CHUNK, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label, a null or empty vector or a component that is null
    or not finite take no part. A component x counts as ``floor(256 * x)`` (kept
    within 2**24 either way, so that scores fit in 64 bits); a shorter vector
    counts as filled up with 0. ``anchor`` is a condition (id divisible by 100
    unless given), ``relabel`` the label to use. Positives are the first rows
    of an anchor's label, itself left out, by score, ties by smaller id (a null
    id last). For each positive, the first rows of other labels whose score n
    and the positive's p satisfy ``80 p <= 100 n <= 100 p``; a negative p thus
    has none. Rows whose ids repeat are rows of their own. A table without
    anchors, positives or rows in a window gives no rows.
    """
    anchor = (F.col(id_col) % 100 == 0) if anchor is None else anchor
    whole = F.transform(vector_col, lambda x: F.floor(F.greatest(F.least(x.cast("double") * 256, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))
    taken = rows.where(F.col(label_col).isNotNull() & usable(vector_col)).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("vec_id"),
        (F.col(label_col) if relabel is None else relabel).cast("long").alias("label"),
        whole.alias("whole"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    )
    taken = cut(taken)
    empty = rows.sparkSession.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    width, wanted = taken.agg(F.max(F.size("whole")), F.count_if("is_anchor")).first()
    if not wanted:
        return empty
    index = MultiIndex(taken, width, chunk)
    with stored_by(index.chunks(), "chunk") as chunks:
        named = taken.where("is_anchor").select(F.col("row").alias("anchor"))
        anchors = cut(
            index.rows.join(named, F.col("row") == F.col("anchor"))
            .select("anchor", F.col("vec_id").alias("anchor_id"), "label", "code", F.lit(None).cast(_KNOWN).alias("known"))
        )
        blocks = -(-wanted // block)
        near = index.search(chunks, anchors, positives, False, blocks)
        windows = near.groupBy("anchor").agg(
            F.collect_list(F.struct("score", "row", F.lit(None).cast("long").alias("least"))).alias("known")
        )
        asked = cut(anchors.drop("known").join(windows, "anchor"))
        far = index.search(chunks, asked, negatives, True, blocks)
    positive = near.select(F.col("anchor").alias("a"), F.col("row").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        far.join(positive, (F.col("anchor") == F.col("a")) & (F.col("window") == F.col("w")))
        .join(anchors.select(F.col("anchor").alias("a2"), "anchor_id"), F.col("anchor") == F.col("a2"))
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def shifted_label(id_col: str = "vec_id", label_col: str = "label"):
    """The label, moved on by one of ten where the id is divisible by 7."""
    return F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
