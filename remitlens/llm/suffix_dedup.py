"""Repeated passages: suffix sorting of candidate regions.

A passage is a string of ``LENGTH`` bytes. Its anchor is the smallest hash of
its ``GRAM``-byte strings, so equal passages have equal anchors. The starts of a
text fall into runs of one anchor; a run with the bytes of its passages is a
region. Only regions whose anchor occurs elsewhere, or twice within, can hold a
repeated passage. Regions of one anchor meet in one task, which sorts their
suffixes in two stages and compares neighbours. Equal regions are carried once,
with their number. Regions of a very frequent anchor are spread over tasks;
the passages of such tasks are then compared across tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm import text as T
from remitlens.llm.scratch import cut, key_filter, partitions
from remitlens.llm.suffix_sort import common_prefixes, sort_suffixes

LENGTH = 400
GRAM = 32
#: Starts of a region at most (periodic texts have long runs).
LONGEST_RUN = 1024
#: Different regions of one anchor that one task sorts together.
REGIONS = 256
#: Bytes that are sorted at once, about.
SORT_BYTES = 1 << 18
_U64 = np.uint64


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def regions(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All regions of a piece's texts: text number, first start (in the text),
    number of starts, anchor, hash of the bytes, whether the anchor's string
    occurs twice within the run."""
    names = ("text", "start", "n", "anchor", "bytes", "twice")
    n = len(data)
    if n < LENGTH:
        return {x: np.zeros(0, np.int64) for x in names}
    sums = T.rolling(data)
    at = np.arange(n - GRAM + 1)
    grams = T.span_hash(sums, at, at + GRAM)
    least = sliding_least(grams, LENGTH - GRAM + 1)
    room = np.diff(offsets)
    valid = np.zeros(n + 1, np.int32)
    fits = room >= LENGTH
    np.add.at(valid, offsets[:-1][fits], 1)
    np.add.at(valid, offsets[1:][fits] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[: len(least)]) > 0)
    if not len(starts):
        return {x: np.zeros(0, np.int64) for x in names}
    value = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)
    text = np.searchsorted(offsets, starts[new], "right") - 1
    begin = np.flatnonzero(new)
    # a text that ends LENGTH bytes before the next one's first start
    length = np.diff(np.append(begin, len(starts)))
    leaves = np.concatenate([[0], np.cumsum(grams[starts] == value)])
    twice = leaves[begin + length - 1] > leaves[begin]
    parts = -(-length // LONGEST_RUN)
    which = np.repeat(np.arange(len(begin)), parts)
    piece = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = starts[begin][which] + piece * LONGEST_RUN
    count = np.minimum(length[which] - piece * LONGEST_RUN, LONGEST_RUN)
    return {
        "text": text[which],
        "start": first - offsets[text[which]],
        "n": count,
        "anchor": value[begin][which].view(np.int64),
        "bytes": T.span_hash(sums, first, first + count + LENGTH - 1).view(np.int64),
        "twice": (twice | (parts > 1))[which],
    }


def _find_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = np.asarray(batch.column(0))
        for first, _, data, offsets in T.pieces(batch.column(1)):
            r = regions(data, offsets)
            columns = [pa.array(key[first + r["text"]], pa.int64()), pa.array(r["start"], pa.int32()), pa.array(r["n"], pa.int32())]
            columns += [pa.array(r["anchor"], pa.int64()), pa.array(r["bytes"], pa.int64()), pa.array(r["twice"].astype(bool), pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n", "anchor", "bytes", "twice"])


def _cut_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted regions, from (text, list of regions)."""
    for batch in batches:
        data, offsets = T.flat(batch.column(0))
        rows = []
        for at, wanted in zip(offsets.tolist(), batch.column(1).to_pylist(), strict=False):
            for w in wanted:
                a = at + w["start"]
                rows.append((w["chunk"], w["anchor"], w["bytes"], w["copies"], w["n"], w["spread"], data[a : a + w["n"] + LENGTH - 1].tobytes()))
        for a in range(0, len(rows), 10_000):
            part = rows[a : a + 10_000]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in part], t) for i, t in enumerate(kinds)],
                names=["chunk", "anchor", "bytes", "copies", "n", "spread", "data"],
            )


def repeated(strings: list[bytes], wanted: np.ndarray, copies: np.ndarray) -> list[np.ndarray]:
    """For each string, which of its first ``wanted`` passages occur again in
    any of the strings; all do in a string that has copies."""
    ends = np.cumsum([len(x) for x in strings])
    starts = np.concatenate([[0], ends[:-1]])
    data = np.frombuffer(b"".join(strings), np.uint8)
    order = sort_suffixes(data, starts, ends, wanted, LENGTH)
    same = common_prefixes(data, order, LENGTH) >= LENGTH
    same[:-1] |= same[1:]
    hit = np.zeros(len(data), bool)
    hit[order[same]] = True
    return [hit[a : a + n] | (c > 1) for a, n, c in zip(starts.tolist(), wanted.tolist(), copies.tolist(), strict=True)]


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
_SPANS_TYPE = "spans array<struct<first: int, end: int>>"


def _spans_of(flags: np.ndarray) -> list[dict]:
    """Bytes covered by the flagged passages of a region."""
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return [{"first": a, "end": b + LENGTH - 1} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]


def _sort_regions(buckets: int):
    """Spans of repeated passages by region. Of spread regions, one of each
    different passage here is packed by bucket of its two hashes: five
    numbers, hashes, region and start. Rows come by chunk."""

    def solve(group: dict[tuple, tuple]) -> pa.RecordBatch:
        rows = list(group.values())
        flags = repeated([r[6] for r in rows], np.array([r[4] for r in rows]), np.array([r[3] for r in rows]))
        out = [(r[1], r[2], _spans_of(f), None, None) for r, f in zip(rows, flags, strict=True) if f.any()]
        spread = []
        for r in rows:
            if r[5]:
                at = np.arange(r[4])
                data = np.frombuffer(r[6], np.uint8)
                one, two = (T.span_hash(T.rolling(x), at, at + LENGTH).view(np.int64) for x in (data, data ^ 0x5A))
                spread.append(np.stack([one, two, np.full(len(at), r[1]), np.full(len(at), r[2]), at], axis=1))
        if spread:
            table = np.concatenate(spread)
            table = table[np.unique(table[:, :2], axis=0, return_index=True)[1]]
            bucket = table[:, 0] % buckets
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out += [(None, None, None, k, table[order[a:b]].tobytes()) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
        kinds = (pa.int64(), pa.int64(), _SPANS, pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["anchor", "bytes", "spans", "bucket", "passages"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[tuple, tuple] = {}
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if row[0] != last and size >= SORT_BYTES:
                    yield solve(group)
                    group, size = {}, 0
                last = row[0]
                if (row[1], row[2]) not in group:
                    group[row[1], row[2]] = row
                    size += len(row[6])
        if group:
            yield solve(group)

    return run


def _across_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of passages that several tasks had."""
    cells = [np.frombuffer(x, np.int64).reshape(-1, 5) for batch in batches for x in batch.column(0).to_pylist()]
    if not cells:
        return
    table = np.concatenate(cells)
    table = table[np.lexsort((table[:, 4], table[:, 3], table[:, 2], table[:, 1], table[:, 0]))]
    same = np.zeros(len(table) + 1, bool)
    same[1:-1] = (table[1:, :2] == table[:-1, :2]).all(axis=1)
    found = table[same[1:] | same[:-1]]
    if not len(found):
        return
    # by region, neighbouring starts as one span
    found = found[np.lexsort((found[:, 4], found[:, 3], found[:, 2]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, 2:4] != found[:-1, 2:4]).any(axis=1) | (found[1:, 4] > found[:-1, 4] + LENGTH)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(found)) - 1
    spans = [[{"first": a, "end": b + LENGTH}] for a, b in zip(found[first, 4].tolist(), found[last, 4].tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(found[first, 2], pa.int64()), pa.array(found[first, 3], pa.int64()), pa.array(spans, _SPANS)], names=["anchor", "bytes", "spans"]
    )


def _removed(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["first"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _finish(own: int):
    """Adds n_bytes, n_removed, n_spans, kept (bytes) to the first ``own``
    columns; the last two are text and spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.flat(batch.column(own))
            raw, rows = data.tobytes(), []
            for a, b, spans in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column(own + 1).to_pylist(), strict=True):
                runs = _removed(spans)
                edges = [0, *(x for r in runs for x in r), b - a]
                kept = b"".join(raw[a + x : a + y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                rows.append((b - a, b - a - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(own)), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))],
                names=[*batch.schema.names[:own], "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def repeated_spans(docs: DataFrame, regions_per_task: int = REGIONS) -> DataFrame:
    """(key, spans): the byte spans of repeated passages of each document that
    has some; ``docs`` has key (one for equal rows) and text."""
    found = cut(docs.mapInArrow(_find_regions, "key long, start int, n int, anchor long, bytes long, twice boolean"))
    anchors = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("total"), F.max("twice").alias("any"))
    anchors = cut(anchors.where("total > 1 or any").select(F.col("anchor").alias("a")))
    shared = cut(found.join(anchors, F.col("anchor") == F.col("a"), "left_semi").drop("twice"))
    distinct = cut(shared.groupBy("anchor", "bytes").agg(F.min(F.struct("key", "start", "n")).alias("r"), F.count(F.lit(1)).alias("copies")))
    many = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > regions_per_task)
    tasks = cut(many.select(F.col("anchor").alias("a"), F.ceil(F.col("m") / regions_per_task).alias("tasks")))
    spread = F.col("tasks").isNotNull()
    reps = distinct.join(tasks, F.col("anchor") == F.col("a"), "left").select(
        F.col("r.key").alias("rep"),
        F.struct(
            F.col("r.start").alias("start"),
            F.col("r.n").alias("n"),
            "anchor",
            "bytes",
            "copies",
            spread.alias("spread"),
            F.when(spread, F.xxhash64("anchor", F.pmod("bytes", "tasks"))).otherwise(F.col("anchor")).alias("chunk"),
        ).alias("region"),
    )
    wanted = cut(reps.groupBy("rep").agg(F.collect_list("region").alias("wanted")))
    may = key_filter(wanted, "rep")
    texts = docs.where(may("key")).join(wanted, F.col("key") == F.col("rep")).select("text", "wanted")
    pieces = texts.mapInArrow(_cut_regions, "chunk long, anchor long, bytes long, copies long, n int, spread boolean, data binary")
    sorted_pieces = pieces.repartition(partitions(docs), "chunk").sortWithinPartitions("chunk")
    solved = cut(sorted_pieces.mapInArrow(_sort_regions(partitions(docs)), f"anchor long, bytes long, {_SPANS_TYPE}, bucket long, passages binary"))
    apart = solved.where("bucket is not null").repartition(partitions(docs), "bucket").select("passages")
    more = apart.mapInArrow(_across_tasks, f"anchor long, bytes long, {_SPANS_TYPE}")
    spans = cut(solved.where("spans is not null").select("anchor", "bytes", "spans").unionByName(more))
    spans = spans.select(F.col("anchor").alias("a"), F.col("bytes").alias("b"), F.explode("spans").alias("s"))
    # equal regions share their spans
    hits = shared.join(spans, (F.col("anchor") == F.col("a")) & (F.col("bytes") == F.col("b"))).select(
        "key", F.struct((F.col("start") + F.col("s.first")).alias("first"), (F.col("start") + F.col("s.end")).alias("end")).alias("s")
    )
    return cut(hits.groupBy("key").agg(F.collect_set("s").alias("spans")))


def remove_repeats(docs: DataFrame, regions_per_task: int = REGIONS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte inside a 400-byte string that also starts anywhere else, in the
    same or another document, goes; strings are judged on the input. Null text
    counts as empty; repeated rows are repeats of each other. Other columns
    are ignored. An empty table gives no rows.
    """
    rows = docs.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    spans = repeated_spans(rows.select("key", "text"), regions_per_task)
    kind = rows.schema["doc_id"].dataType.simpleString()
    may = key_filter(spans, "key")
    empty = F.lit(None).cast("array<struct<first: int, end: int>>").alias("spans")
    clean = rows.where(~may("key")).select("doc_id", "text", empty)
    touched = rows.where(may("key")).join(spans, "key", "left").select("doc_id", "text", "spans")
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return clean.mapInArrow(_finish(1), schema).unionByName(touched.mapInArrow(_finish(1), schema))
