"""Approximate nearest neighbours: NN-descent and greedy graph search.

Vectors are scaled by the largest norm and get one more coordinate that makes
all of them unit vectors, so the largest inner product of a query is the
smallest angle. The graph starts from blocks of rows that lie near the same
pivots. In each round of NN-descent, every node introduces its neighbours to
each other, forward and reverse ones, where at least one of a pair is new; each
keeps its best ``degree``. Rounds end when few edges are new.

The graph is stored bucketed by node. A row holds the node's vector and, of each
neighbour, the difference to it in 8 bits, so close copies stay apart. A query
keeps a beam of the best nodes seen. In each round its best nodes that are not
yet expanded are joined with the graph, and what they lead to is merged into the
beam, until the whole beam is expanded. The last step ranks the best of the beam by
exact products of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.scratch import cut, partitions
from remitlens.llm.vectors import stored_by, usable

TOP = 20
#: Neighbours of a node; reverse neighbours that the stored graph adds.
DEGREE = 32
REVERSE = 24
#: Neighbours of a node that meet in a round, and partners kept of each.
MEET = 40
PARTNERS = 6
#: Rounds of NN-descent at most; share of new edges at which they end.
ROUNDS = 5
NEW_SHARE = 0.05
#: Passes of starting blocks, rows of a block, pivots (a bounded sample of rows).
PASSES = 3
BLOCK = 64
PIVOTS = 256
#: Entry nodes (a bounded sample), beam, entries a query starts from, expansions of a round.
ENTRIES = 1024
BEAM = 288
START = 64
EXPAND = 64
#: Rows of the beam that are ranked exactly.
EXACT = 96
_LEAST = -2.0


def _matrix(column: pa.Array, kind=np.float32) -> np.ndarray:
    """Equal-length binaries as rows."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1) if values else np.zeros((0, 0), kind)


def _unit(width: int, largest: float, norm: float):
    """Adds the unit vector (float32, one coordinate more) of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = np.diff(np.asarray(column.offsets))
            flat = np.asarray(column.flatten(), dtype=np.float64) / largest
            rows = np.zeros((len(column), width + 1))
            rows[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat / norm
            rows[:, width] = np.sqrt(np.maximum(0, 1 - (rows**2).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows.astype(np.float32)], pa.binary())], names=["node", "unit"])

    return run


def coded(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scales, 8-bit components) of each row."""
    scale = np.maximum(np.abs(rows).max(axis=1), np.float32(1e-30)) / np.float32(127)
    return scale.astype(np.float32), np.rint(rows / scale[:, None]).astype(np.int8)


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row's 8-bit code with its scale, and its vector in half precision."""
    for batch in batches:
        rows = _matrix(batch.column(1))
        if not len(rows):
            continue
        scale, code = coded(rows)
        codes = [s.tobytes() + c.tobytes() for s, c in zip(scale, code, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["node", "code"])


def _decoded(codes: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    return raw[:, 4:].copy().view(np.int8).astype(np.float32) * raw[:, :4].copy().view(np.float32)


def _near_pivot(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            sims = _matrix(batch.column(1)) @ pivots.T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(2)), pa.array(sims.argmax(axis=1), pa.int32()), pa.array(sims.max(axis=1), pa.float32())],
                names=["node", "unit", "pivot", "near"],
            )

    return run


_EDGES = "node long, nbr long, sim float, fresh boolean"


def _edge_batch(node: np.ndarray, nbr: np.ndarray, sim: np.ndarray, fresh) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(node, pa.int64()), pa.array(nbr, pa.int64()), pa.array(sim, pa.float32(), mask=np.isnan(sim)), pa.array(np.broadcast_to(fresh, len(node)))],
        names=["node", "nbr", "sim", "fresh"],
    )


def _best_of(nodes: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's best k columns, as edges; entries at or below _LEAST are none."""
    k = min(k, sims.shape[1])
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.broadcast_to(np.arange(k), sims.shape)
    got = np.take_along_axis(sims, best, axis=1)
    ok = got > _LEAST
    return np.repeat(nodes, ok.sum(axis=1)), nodes[best][ok], got[ok]


def _block_edges(degree: int):
    """Edges among each BLOCK consecutive rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []

        def solve(rows):
            nodes = np.array([r[0] for r in rows], np.int64)
            units = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(len(rows), -1)
            sims = units @ units.T
            np.fill_diagonal(sims, _LEAST)
            return _edge_batch(*_best_of(nodes, sims, degree), True)

        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            while len(held) >= BLOCK:
                yield solve(held[:BLOCK])
                held = held[BLOCK:]
        if len(held) > 1:
            yield solve(held)

    return run


def _introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by centre: (center, member, fresh, own, worst, code). Gives
    the members' best partners, and the new edges that are now old."""

    def solve(center: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        met = [(center, r[1]) if r[3] else (r[1], center) for r in rows if r[2]]
        by_member: dict[int, tuple] = {}
        for r in rows:
            if r[1] not in by_member or r[2]:
                by_member[r[1]] = r
        rows = list(by_member.values())
        fresh = np.array([r[2] for r in rows])
        if not fresh.any():
            return
        old = np.array(met, np.int64).reshape(-1, 2)
        node, nbr, sim = old[:, 0], old[:, 1], np.full(len(old), np.nan, np.float32)
        flags = np.zeros(len(old), bool)
        if len(rows) > 1:
            nodes = np.array([r[1] for r in rows], np.int64)
            units = _decoded([r[5] for r in rows])
            sims = units @ units.T
            np.fill_diagonal(sims, _LEAST)
            sims[~(fresh[:, None] | fresh[None, :])] = _LEAST
            sims[sims <= np.array([r[4] for r in rows], np.float32)[:, None]] = _LEAST
            a, b, s = _best_of(nodes, sims, PARTNERS)
            node, nbr, sim = np.concatenate([node, a]), np.concatenate([nbr, b]), np.concatenate([sim, s])
            flags = np.concatenate([flags, np.ones(len(a), bool)])
        yield _edge_batch(node, nbr, sim, flags)

    last, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if row[0] != last and held:
                yield from solve(last, held)
                held = []
            last = row[0]
            held.append(row)
    if held:
        yield from solve(last, held)


def _top_edges(edges: DataFrame, degree: int) -> DataFrame:
    """The best edges of each node; an edge that was old stays old. Equal ones
    in the order of a hash, so that equal vectors share their links out."""
    one = edges.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh")).where("sim is not null")
    order = Window.partitionBy("node").orderBy(F.col("sim").desc(), F.xxhash64("node", "nbr"))
    return one.withColumn("place", F.row_number().over(order)).where(F.col("place") <= degree).drop("place")


def neighbour_graph(units: DataFrame, degree: int = DEGREE) -> DataFrame:
    """Edges (node, nbr, sim, fresh) from every row of ``units`` (node, unit) to
    about its nearest ones, by NN-descent."""
    spark = units.sparkSession
    codes = cut(units.mapInArrow(_code, "node long, code binary"))
    edges = None
    for turn in range(PASSES):
        pivots = units.orderBy(F.xxhash64("node", F.lit(turn)), "node").limit(PIVOTS).select("unit").toArrow().column(0)
        near = units.mapInArrow(_near_pivot(spark.sparkContext.broadcast(_matrix(pivots))), "node long, unit binary, pivot int, near float")
        dealt = near.repartitionByRange(partitions(units), "pivot", "near", "node").sortWithinPartitions("pivot", "near", "node")
        own = dealt.select("node", "unit").mapInArrow(_block_edges(degree), _EDGES)
        edges = own if edges is None else edges.unionByName(own)
    graph = cut(_top_edges(edges, degree))
    for turn in range(ROUNDS):
        worst = graph.groupBy("node").agg(F.when(F.count(F.lit(1)) >= degree, F.min("sim")).alias("worst"))
        members = codes.join(worst, "node", "left").select(F.col("node").alias("member"), F.coalesce("worst", F.lit(_LEAST)).cast("float").alias("worst"), "code")
        both = graph.select(F.col("node").alias("center"), F.col("nbr").alias("member"), "fresh", F.lit(True).alias("own")).unionByName(
            graph.select(F.col("nbr").alias("center"), F.col("node").alias("member"), "fresh", F.lit(False).alias("own"))
        )
        order = Window.partitionBy("center").orderBy(F.col("fresh").desc(), F.xxhash64("center", "member", F.lit(turn)))
        some = both.withColumn("place", F.row_number().over(order)).where(F.col("place") <= MEET).drop("place")
        met = some.join(members, "member").select("center", "member", "fresh", "own", "worst", "code")
        new = met.repartition(partitions(units), "center").sortWithinPartitions("center").mapInArrow(_introduce, _EDGES)
        graph = cut(_top_edges(graph.unionByName(new), degree))
        size, fresh = graph.agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if fresh <= NEW_SHARE * size:
            break
    return graph


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stored row of a node: its vector, its neighbours' ids, and their
    differences to it in 8 bits."""
    for batch in batches:
        ids, scales, codes = [], [], []
        for unit, nbrs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            own = np.frombuffer(unit, np.float32)
            rows = np.frombuffer(b"".join(n["unit"] for n in nbrs), np.float32).reshape(len(nbrs), -1)
            scale, code = coded(rows - own)
            ids.append(np.array([n["nbr"] for n in nbrs], np.int64).tobytes())
            scales.append(scale.tobytes())
            codes.append(code.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(x, pa.binary()) for x in (ids, scales, codes))], names=["node", "unit", "ids", "scales", "codes"]
        )


def search_rows(units: DataFrame, graph: DataFrame) -> DataFrame:
    """The rows of the stored graph, reverse edges added: of each node a bounded
    number, first those to nodes that few others link to, so that a node at the
    edge of a crowd can be reached."""
    linked = graph.groupBy("nbr").agg(F.count(F.lit(1)).alias("links"))
    back = (
        graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))
        .join(linked, "nbr", "left")
        .select("node", "nbr", F.coalesce("links", F.lit(0)).alias("links"))
    )
    order = Window.partitionBy("node").orderBy("links", F.xxhash64("nbr", "node"))
    back = back.withColumn("place", F.row_number().over(order)).where(F.col("place") <= REVERSE).select("node", "nbr")
    links = graph.select("node", "nbr").unionByName(back).distinct()
    met = links.join(units.select(F.col("node").alias("nbr"), "unit"), "nbr")
    held = met.groupBy("node").agg(F.collect_list(F.struct("nbr", "unit")).alias("nbrs"))
    rows = units.join(held, "node").select("node", "unit", "nbrs")
    return rows.mapInArrow(_pack, "node long, unit binary, ids binary, scales binary, codes binary")


def _enter(shared, start: int):
    """The best entry nodes of each query; near ties in an order of the query's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, units = shared.value
        k = min(start, len(nodes))
        for batch in batches:
            queries = np.asarray(batch.column(0))
            sims = _matrix(batch.column(1)) @ units.T
            for query, own in zip(queries.tolist(), sims, strict=True):
                jitter = np.random.default_rng(query).random(len(own), np.float32) * np.float32(0.01)
                best = np.argsort(-(own + jitter), kind="stable")[:k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, query)), pa.array(nodes[best]), pa.array(own[best], pa.float32()), pa.array(np.zeros(k, bool))],
                    names=["query", "node", "sim", "done"],
                )

    return run


_BEAM = "query long, node long, sim float, done boolean"


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of expanded nodes that are nearer than the beam's last."""
    for batch in batches:
        queries, nodes, lasts = (np.asarray(batch.column(i)) for i in range(3))
        out = []
        rows = zip(queries.tolist(), nodes.tolist(), lasts.tolist(), *(batch.column(i).to_pylist() for i in range(3, 8)), strict=True)
        for query, _, last, vector, unit, ids, scales, codes in rows:
            q = np.frombuffer(vector, np.float32)
            scale = np.frombuffer(scales, np.float32)
            code = np.frombuffer(codes, np.int8).reshape(len(scale), -1)
            sims = np.frombuffer(unit, np.float32) @ q + scale * (code.astype(np.float32) @ q)
            good = sims > last
            out.append((np.full(good.sum(), query), np.frombuffer(ids, np.int64)[good], sims[good]))
        if out:
            query, node, sim = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(node, pa.int64()), pa.array(sim, pa.float32()), pa.array(np.zeros(len(node), bool))],
                names=["query", "node", "sim", "done"],
            )


def greedy_search(stored: DataFrame, units: DataFrame, queries: DataFrame, beam: int) -> DataFrame:
    """(query, node, sim): the beam of each query (query, vector) once all of
    its nodes are expanded."""
    spark = units.sparkSession
    some = units.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).toArrow()
    shared = spark.sparkContext.broadcast((np.asarray(some.column(0)), _matrix(some.column(1))))
    state = cut(queries.mapInArrow(_enter(shared, START), _BEAM))
    best = Window.partitionBy("query").orderBy(F.col("sim").desc(), "node")
    while True:
        ranked = state.withColumns(
            {
                "place": F.row_number().over(best),
                "waiting": F.sum(F.when(F.col("done"), 0).otherwise(1)).over(best),
                "worst": F.when(F.count(F.lit(1)).over(Window.partitionBy("query")) >= beam, F.min("sim").over(Window.partitionBy("query"))),
            }
        )
        ranked = ranked.withColumn("next", ~F.col("done") & (F.col("waiting") <= EXPAND))
        ranked = cut(ranked.select("query", "node", "sim", (F.col("done") | F.col("next")).alias("done"), "next", F.coalesce("worst", F.lit(_LEAST)).cast("float").alias("worst")))
        going = ranked.where("next").select("query", "node", "worst")
        if going.isEmpty():
            return state.select("query", "node", "sim")
        asked = going.join(queries, "query")
        met = asked.join(stored, "node").select("query", "node", "worst", "vector", "unit", "ids", "scales", "codes")
        new = met.mapInArrow(_expand, _BEAM)
        merged = ranked.select("query", "node", "sim", "done").unionByName(new).groupBy("query", "node").agg(F.max("sim").alias("sim"), F.max("done").alias("done"))
        state = merged.withColumn("place", F.row_number().over(best)).where(F.col("place") <= beam).drop("place")


def nearest_neighbours(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query=None, top: int = TOP, degree: int = DEGREE, beam: int = BEAM
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` rows found of the largest
    inner product with each query, itself left out.

    ``query`` is a condition (id divisible by 20 unless given). Scores are inner
    products of the original vectors in double precision, summed in order; ties
    by smaller id, a null id last. Rows whose vector is null, empty, zero or
    holds a null or non-finite component take no part, neither as queries nor
    as candidates; a shorter vector counts as filled up with 0. Rows whose ids
    repeat are rows of their own. With fewer candidates than ``top``, all are
    returned; an empty table gives no rows.

    All rows are indexed. Pivots and entries are bounded samples; where the
    search starts depends on them, what it can reach does not. The graph is
    made for vectors whose norms lie within about a factor of ten.
    """
    spark = rows.sparkSession
    query = (F.col(id_col) % 20 == 0) if query is None else query
    largest = F.array_max(F.transform(vector_col, lambda x: F.abs(x.cast("double"))))
    taken = cut(
        rows.where(usable(vector_col) & (largest > 0)).select(
            F.monotonically_increasing_id().alias("node"),
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).alias("vector"),
            F.coalesce(query, F.lit(False)).alias("is_query"),
            largest.alias("largest"),
        )
    )
    width, scale, wanted = taken.agg(F.max(F.size("vector")), F.max("largest"), F.count_if("is_query")).first()
    if not wanted:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x.cast("double") / F.lit(scale)) * (x.cast("double") / F.lit(scale)))
    norm = float(np.sqrt(taken.agg(F.max(squares)).first()[0]))
    units = cut(taken.select("node", "vector").mapInArrow(_unit(width, scale, norm), "node long, unit binary"))
    graph = neighbour_graph(units, degree)
    vectors = cut(units.join(taken.where("is_query").select(F.col("node").alias("query")), F.col("node") == F.col("query")).select("query", F.col("unit").alias("vector")))
    # a query's own extra coordinate is 0: the order by angle is that by inner product
    vectors = vectors.select("query", F.concat(F.expr(f"substring(vector, 1, {4 * width})"), F.lit(b"\0\0\0\0")).alias("vector"))
    with stored_by(search_rows(units, graph), "node") as stored:
        found = cut(greedy_search(stored, units, vectors, max(beam, 2 * top)).where("query <> node"))
    close = Window.partitionBy("query").orderBy(F.col("sim").desc(), "node")
    found = found.withColumn("place", F.row_number().over(close)).where(F.col("place") <= max(EXACT, 2 * top)).drop("place")
    product = F.aggregate(F.zip_with("q", "vector", lambda a, b: F.coalesce(a.cast("double") * b.cast("double"), F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    own = taken.where("is_query").select(F.col("node").alias("query"), F.col("vec_id").alias("query_id"), F.col("vector").alias("q"))
    scored = found.join(taken.select("node", "vec_id", "vector"), "node").join(own, "query").select("query", "query_id", "vec_id", product.alias("score"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
