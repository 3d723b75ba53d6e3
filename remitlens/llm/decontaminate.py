"""Benchmark passages in documents, through an FM-index of each shard of texts.

A shard is a piece of a task's documents. Only words that could lie in an
occurrence are indexed: those in a chain of neighbours that some test phrase
has as neighbours too, at least as long as the shortest phrase. All phrases are
searched backwards at once, located, and their spans merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm import text as T
from remitlens.llm.scratch import Shipped
from remitlens.llm.fm_index import FMIndex

#: Words of a phrase.
WINDOW = 10
#: Bytes of benchmark text that tasks hold at once; more is searched in blocks.
BLOCK_BYTES = 16 << 20
#: Bytes of documents in a shard.
SHARD_BYTES = 2 << 20
_U64 = np.uint64


@dataclass
class Phrases:
    """Test phrases over a vocabulary of word hashes (symbols from 1)."""

    words: np.ndarray
    table: np.ndarray
    lengths: np.ndarray
    #: items[first[p] : first[p + 1]] have phrase p
    first: np.ndarray
    items: np.ndarray
    item_ids: list[str | None]
    #: neighbours in a phrase as left * (len(words) + 1) + right, sorted
    pairs: np.ndarray
    #: symbols that are a phrase
    singles: np.ndarray
    shortest: int


def phrases_of(items: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases | None:
    """Every window of ``window`` words of the items; a shorter item is one."""
    column = pa.array([t for _, t in items], pa.large_string())
    data, offsets = T.flat(column)
    low = T.lower_table()[data]
    starts, ends, first = T.words(low, offsets, T.alnum_words())
    if not len(starts):
        return None
    words, symbols = np.unique(T.word_hashes(low, starts, ends), return_inverse=True)
    symbols = symbols + 1
    found: dict[tuple[int, ...], set[int]] = {}
    ids = [None if i is None else str(i) for i, _ in items]
    numbers = {name: k for k, name in enumerate(dict.fromkeys(ids))}
    for item, a, b in zip(ids, first[:-1].tolist(), first[1:].tolist(), strict=True):
        for i in range(a, max(a + 1, b - window + 1) if b > a else a):
            found.setdefault(tuple(symbols[i : min(i + window, b)].tolist()), set()).add(numbers[item])
    lengths = np.array([len(p) for p in found])
    table = np.zeros((len(found), window), np.int64)
    for row, p in zip(table, found, strict=True):
        row[: len(p)] = p
    inside = np.arange(1, window) < lengths[:, None]
    pairs = (table[:, :-1] * (len(words) + 1) + table[:, 1:])[inside]
    owners = [sorted(x) for x in found.values()]
    return Phrases(
        words,
        table,
        lengths,
        np.concatenate([[0], np.cumsum([len(x) for x in owners])]),
        np.concatenate(owners).astype(np.int64),
        list(numbers),
        np.unique(pairs),
        np.unique(table[lengths == 1, 0]),
        int(lengths.min()),
    )


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def occurrences(symbols: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, word) of all occurrences in a shard's words."""
    n = len(symbols)
    tied = np.zeros(n + 1, bool)  # tied[i]: words i - 1 and i may lie in one occurrence
    known = np.flatnonzero(symbols > 0)
    left = known[:-1][np.diff(known) == 1]
    left = left[_among(symbols[left] * (len(phrases.words) + 1) + symbols[left + 1], phrases.pairs)]
    tied[left + 1] = True
    tied[first] = False
    kept = tied[:-1] | tied[1:]
    kept[known[_among(symbols[known], phrases.singles)]] = True
    at = np.flatnonzero(kept)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(~tied[at])  # where a chain begins
    long = np.repeat(np.diff(np.append(heads, len(at))), np.diff(np.append(heads, len(at)))) >= phrases.shortest
    at = at[long]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.flatnonzero(~tied[at])
    seq = np.insert(symbols[at], fresh[fresh > 0], 0)
    words = np.insert(at, fresh[fresh > 0], -1)
    index = FMIndex(seq, len(phrases.words))
    low, high = index.search(phrases.table, phrases.lengths)
    counts = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    return which, words[index.locate(rows)]


def _scan_shard(data: np.ndarray, offsets: np.ndarray, p: Phrases) -> tuple:
    """Per text: number of words, merged spans of hit words (word numbers and
    bytes), items found."""
    low = T.lower_table()[data]
    starts, ends, first = T.words(low, offsets, T.alnum_words())
    hashes = T.word_hashes(low, starts, ends)
    at = np.minimum(np.searchsorted(p.words, hashes), len(p.words) - 1)
    symbols = np.where(p.words[at] == hashes, at + 1, 0)
    which, word = occurrences(symbols, first[:-1], p)
    texts = len(offsets) - 1
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + p.lengths[which], -1)
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.zeros(len(starts), bool)
    edge[first[:-1][first[:-1] < len(starts)]] = True
    begins = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
    stops = np.flatnonzero(hit & np.concatenate([edge[1:] | ~hit[1:], [True]])) + 1 if len(hit) else begins
    owner = np.searchsorted(first, begins, "right") - 1
    spans: list[list[dict]] = [[] for _ in range(texts)]
    for t, a, b in zip(owner.tolist(), begins.tolist(), stops.tolist(), strict=True):
        spans[t].append({"first": a - int(first[t]), "end": b - int(first[t]), "start_byte": int(starts[a] - offsets[t]), "end_byte": int(ends[b - 1] - offsets[t])})
    found: list[set] = [set() for _ in range(texts)]
    seen = np.unique(np.stack([np.searchsorted(first, word, "right") - 1, which], 1), axis=0) if len(word) else np.zeros((0, 2), int)
    for t, w in seen.tolist():
        found[t].update(p.item_ids[i] for i in p.items[p.first[w] : p.first[w + 1]])
    return np.diff(first), spans, [sorted(x, key=lambda v: (v is None, v)) for x in found]


def merge_spans(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["first"], s["end"])):
        if out and s["first"] <= out[-1]["end"]:
            if s["end"] > out[-1]["end"]:
                out[-1] |= {"end": s["end"], "end_byte": s["end_byte"]}
        else:
            out.append(dict(s))
    return out


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("start_byte", pa.int64()), ("end_byte", pa.int64())]))
_COLUMNS = "n_words long, spans array<struct<first: long, end: long, start_byte: long, end_byte: long>>, items array<string>"


def _scan(phrases, earlier: bool):
    """Adds what one block of phrases finds to the columns of a batch; of the
    columns, the last before those added is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = phrases.value
        for batch in batches:
            own = batch.num_columns - (3 if earlier else 0)
            for a, b, data, offsets in T.pieces(batch.column(own - 1), SHARD_BYTES):
                part = batch.slice(a, b - a)
                n_words, spans, items = _scan_shard(data, offsets, p)
                if earlier:
                    spans = [merge_spans(x + y) for x, y in zip(part.column(own + 1).to_pylist(), spans, strict=True)]
                    items = [sorted({*x, *y}, key=lambda v: (v is None, v)) for x, y in zip(part.column(own + 2).to_pylist(), items, strict=True)]
                columns = [part.column(i) for i in range(own)]
                columns += [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:own], "n_words", "spans", "items"])

    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, text_col: str = "text") -> DataFrame:
    """``docs`` with column ``found``: n_words, spans, items.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are
    lower-cased. A phrase is ``window`` consecutive words of an item, or a
    shorter item whole. ``spans`` are the maximal runs of words inside
    occurrences (word numbers and bytes of the text, end excluded), ``items``
    the distinct ids, as sorted strings, of items with occurrences (null last).
    Null text has no words; an item without words is never found. All columns
    of ``docs`` are kept, whatever their names.

    Tasks hold ``block_bytes`` of benchmark text at once; a larger benchmark is
    searched block by block.
    """
    spark = docs.sparkSession
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    plain = plain.withColumn("text", F.col(f"c{names.index(text_col)}").cast("string"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields]
    items = benchmark.select(F.col("item_id").alias("id"), F.col("text").cast("string").alias("text"))
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-volume // block_bytes))
    earlier = False
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        phrases = phrases_of([(r[0], r[1]) for r in own.collect()], window)
        if phrases is None:
            continue
        plain = plain.mapInArrow(_scan(Shipped(spark, phrases), earlier), ", ".join([*kinds, _COLUMNS]))
        earlier = True
    if not earlier:
        words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
        plain = plain.select(
            "*",
            F.coalesce(words, F.lit(0)).cast("long").alias("n_words"),
            F.array().cast("array<struct<first: long, end: long, start_byte: long, end_byte: long>>").alias("spans"),
            F.array().cast("array<string>").alias("items"),
        )
    return plain.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c != "found"], F.struct("n_words", "spans", "items").alias("found")
    )


def n_hit():
    return F.aggregate("found.spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["first"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, spans. ``items_sha256`` hashes the ids joined by commas (a
    null id is counted and adds nothing)."""
    found = find_passages(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "found.n_words",
        n_hit().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
        "found.spans",
    )


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test phrase, all columns as they were."""
    return find_passages(docs, benchmark).where(F.size("found.spans") == 0).select(*docs.columns)


def cut_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, with the text of every merged span replaced by a space."""
    kept = F.expr(
        """array_join(transform(sequence(0, size(found.spans)), i -> decode(substring(cast(text AS binary),
             cast(coalesce(get(found.spans, i - 1).end_byte, 0) + 1 AS int),
             cast(coalesce(get(found.spans, i).start_byte, octet_length(text)) - coalesce(get(found.spans, i - 1).end_byte, 0) AS int)),
           'utf-8')), ' ')"""
    )
    found = find_passages(docs, benchmark)
    return found.withColumn("text", F.when(F.size("found.spans") > 0, kept).otherwise(F.col("text"))).select(*docs.columns)
