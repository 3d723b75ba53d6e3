"""Set-similarity join of documents on word n-grams, by token combinations.

A document is its set of n-gram hashes ("tokens") in one global order. Of two
sets with Jaccard similarity of at least ``t = 3/4``, with ``l`` tokens in one
of them, these hold:

* each other's first ``l/4 + 1`` tokens have a token in common;
* each other's first ``2 l/4 + 2`` tokens have two tokens in common that are
  neighbours in both (every token that only one set has can part one pair of
  common neighbours, and there are too few such tokens).

So rare tokens are indexed alone, over the short prefix. Documents whose short
prefix holds a frequent token are indexed again with the frequent tokens last;
those that still have one in front, by two-token combinations over the
extended prefix. Two similar sets with a rare token of both short prefixes in
common are found by it; otherwise both have a frequent one there, and both go
on to the next index.

Short lists of the index give their pairs, a bounded number each. Long lists
are never expanded into all pairs: every member is compared with one member of
its length class, and what matches is merged. After that only members of
different groups can still matter, and those are looked up by their token
combinations. A bitmap of the parities of hashed tokens bounds the number of
tokens that two sets don't share from below; pairs within the bound are
verified on the whole sets.

Short lists of combinations give their pairs too. A long one, while it holds
several groups, gives each member A its difference D(A) from the list's hub h,
the member of the fewest rare tokens. A and B are similar when
``|D(A) ^ D(B)| = |A ^ B| <= (|A| + |B|) / 7``. Then

* D(A) and D(B) have a token in common, or both A and B are similar to h;
* the first such token, in any order that all members keep, has i tokens of
  D(A) and j of D(B) before it, at most ``|A| / 3``; as p and q tokens follow
  it there, ``i + j + |p - q| <= (|A| + |B|) / 7``.

Members similar to h are merged with it; the others meet by the first tokens
of their differences: their own rare ones first, then frequent ones, then what
they lack of h. The tokens of a passage that a whole list shares are in none
of these differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm import text as T
from remitlens.llm.components import components
from remitlens.llm.lm import merged_counts, packed_counts
from remitlens.llm.scratch import cut, in_bitmap, key_bitmap, key_filter, partitions, release, slot_of

#: Similarity in hundredths.
THRESHOLD = 75
#: A list with more members than this is a frequent one.
FREQUENT = 16
#: Tokens that a task packs at once, about.
PART_TOKENS = 400_000
#: Bytes of text that a task shingles at once, about.
PIECE_BYTES = 1 << 18
#: No more tokens than this are ordered last (8 bytes each are broadcast).
MOST_HEAVY = 1 << 18
#: The same, of those counted for documents with a frequent token in front.
MOST_LATE = 1 << 21
#: A round of hubs has one of so many of the first index's entries, about,
ROUND_SHARE = 4
#: and may always have this many.
LEAST_ROUND = 1 << 20
_U64 = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text of a piece."""
    low = T.lower_table()[data]
    starts, ends, first = T.words(low, offsets, T.space_words())
    w = T.word_hashes(low, starts, ends)
    s = w.copy()
    for j in range(1, min(n, len(w))):
        s[: len(w) - j] = T.mix(s[: len(w) - j] * _U64(0x9E3779B97F4A7C15) + w[j:])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(s[a : b - n + 1]))
        elif b > a:
            h = T.mix(np.array([b - a], dtype=_U64))
            for j in range(a, b):
                h = T.mix(h * _U64(0xD6E8FEB86659FD93) + w[j : j + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, _U64))
    return out


def identity(tokens: np.ndarray) -> int:
    """64-bit name of a set (equal sets, equal names), as a signed integer."""
    h = T.mix(T.mix(tokens ^ _U64(0xA5A5A5A55A5A5A5A)).sum(dtype=_U64, keepdims=True) + _U64(len(tokens)))
    return int(h.view(np.int64)[0])


def parities(tokens: np.ndarray) -> bytes:
    """For each residue of the tokens, whether an odd number has it; as many
    bits as tokens, rounded up to a power of two."""
    bits = max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    odd = np.bincount((tokens & _U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """At least so many tokens are in one of the sets of two bitmaps only."""
    x, y = np.frombuffer(a, _U64), np.frombuffer(b, _U64)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def among(tokens: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Which tokens are in the sorted array ``heavy``."""
    if not len(heavy):
        return np.zeros(len(tokens), bool)
    return heavy[np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)] == tokens


def ordered(tokens: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Tokens in the global order: by hash, the heavy ones last."""
    late = among(tokens, heavy)
    return np.concatenate([tokens[~late], tokens[late]]) if late.any() else tokens


def signatures(tokens: np.ndarray, k: int) -> np.ndarray:
    """Index keys of an ordered set: k neighbouring tokens of its prefix."""
    l = len(tokens)
    head = tokens[: k * l // 4 + k]
    if k == 1 or len(head) < k:
        return head
    return T.mix(T.mix(head[:-1]) * _U64(0x9E3779B97F4A7C15) + head[1:])


def _column(values, kind) -> pa.Array:
    return pa.array(np.asarray(values), type=kind)


def _survey(n: int):
    """(doc_id, n_shingles, set, bitmap) per document; (null, count, token,
    null) for tokens that several sets of a batch have in their short
    prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, np.ndarray] = {}
            ids, sizes, bits = [], [], []
            for _, _, data, offsets in T.pieces(batch.column(1), PIECE_BYTES):
                for tokens in shingle_sets(data, offsets, n):
                    name = identity(tokens)
                    ids.append(name)
                    sizes.append(len(tokens))
                    bits.append(parities(tokens))
                    if name not in seen:
                        seen[name] = signatures(tokens, 1)
            rows = len(ids)
            token, count = np.unique(np.concatenate([*seen.values(), np.zeros(0, _U64)]), return_counts=True)
            often = count >= max(3, rows // 2000)
            token, count = token[often].astype(np.int64), count[often]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(len(token), batch.column(0).type)]),
                    _column(np.concatenate([np.array(sizes, np.int64), count.astype(np.int64)]), pa.int64()),
                    _column(np.concatenate([np.array(ids, np.int64), token]), pa.int64()),
                    pa.array(bits + [None] * len(token), pa.binary()),
                ],
                names=["doc_id", "n", "name", "bits"],
            )

    return run


def _cells(sets: list[tuple[int, np.ndarray]], heavy: np.ndarray, k: int, buckets: int) -> pa.RecordBatch:
    """The index entries of some sets, packed by bucket of the key.

    Entries of heavy tokens are dealt by set instead: their lists are long,
    and none of their keys needs to be looked for.
    """
    keys, names, sizes = [np.zeros(0, _U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for name, tokens in sets:
        s = signatures(ordered(tokens, heavy), k)
        keys.append(s)
        names.append(np.full(len(s), name, np.int64))
        sizes.append(np.full(len(s), len(tokens), np.int32))
    key, name, size = np.concatenate(keys), np.concatenate(names), np.concatenate(sizes)
    bucket = (key >> _U64(40)).astype(np.int64) % buckets
    if k == 1 and len(heavy) and len(key):
        bucket = np.where(among(key, heavy), -1 - T.mix(name.astype(_U64)).astype(np.int64) % buckets, bucket)
    return _packed(key, name, size, bucket)


def _packed(key: np.ndarray, name: np.ndarray, size: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """Index entries as one row per bucket."""
    order = np.argsort(bucket, kind="stable")
    key, name, size, bucket = key[order], name[order], size[order], bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1)) if len(bucket) else np.zeros(0, np.int64)
    spans = list(zip(edges.tolist(), [*edges[1:].tolist(), len(bucket)], strict=False))
    cut_up = lambda x: pa.array([x[a:b].tobytes() for a, b in spans], pa.binary())
    return pa.RecordBatch.from_arrays(
        [_column(bucket[edges], pa.int64()), cut_up(key), cut_up(name), cut_up(size)],
        names=["bucket", "keys", "names", "sizes"],
    )


def _different_sets(batch: pa.RecordBatch, n: int, bits) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The different non-empty sets of a batch's texts (slot, text) whose slot
    is in the bitmap, in parts of bounded size (a larger single set is a part
    of its own)."""
    if bits is not None:
        batch = batch.filter(pa.array(in_bitmap(bits.value, np.asarray(batch.column(0)))))
    seen: set[int] = set()
    part, size = [], 0
    for _, _, data, offsets in T.pieces(batch.column(1), PIECE_BYTES):
        for tokens in shingle_sets(data, offsets, n):
            if len(tokens) and (name := identity(tokens)) not in seen:
                seen.add(name)
                part.append((name, tokens))
                size += len(tokens)
                if size >= PART_TOKENS:
                    yield part
                    part, size = [], 0
    if part:
        yield part


def _index_texts(n: int, heavy, k: int, buckets: int, bits=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _different_sets(batch, n, bits):
                yield _cells(part, heavy.value, k, buckets)

    return run


def _count_tokens(n: int, bits):
    """Packed counts of the tokens of different sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _different_sets(batch, n, bits):
                yield packed_counts(np.concatenate([tokens for _, tokens in part]))

    return run


def _frequent_tokens(more_than: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, key, count in merged_counts(batches):
            often = count > more_than
            yield pa.RecordBatch.from_arrays([_column(key[often].view(np.int64), pa.int64()), _column(count[often], pa.int64())], names=["key", "m"])

    return run


def _lists(size_type: type):
    """Index entries whose key several sets have: (key, name, size).

    A task holds the packed entries of its buckets, 20 to 24 bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def rows(key, name, size) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(key), 100_000):
                b = a + 100_000
                yield pa.RecordBatch.from_arrays(
                    [_column(key[a:b].view(np.int64), pa.int64()), _column(name[a:b], pa.int64()), _column(size[a:b].astype(np.int64), pa.int64())],
                    names=["key", "name", "size"],
                )

        for batch in batches:
            for bucket, *cell in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                entry = tuple(np.frombuffer(x, t) for x, t in zip(cell, (_U64, np.int64, size_type), strict=True))
                if bucket < 0:
                    yield from rows(*entry)
                else:
                    parts.append(entry)
        if not parts:
            return
        key, name, size = (np.concatenate([p[i] for p in parts]) for i in range(3))
        parts.clear()
        order = np.lexsort((name, key))
        key, name, size = key[order], name[order], size[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        key, name, size = key[new], name[new], size[new]
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        several = same[1:] | same[:-1]
        yield from rows(key[several], name[several], size[several])

    return run


def _index_heads(buckets: int):
    """The packed index entries of (name, hub, d, head): keys of hub and token,
    with the numbers of tokens before and after the token in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, hub, d = (np.asarray(batch.column(i)) for i in range(3))
            head = batch.column(3)
            length = np.asarray(head.value_lengths()).astype(np.int64)
            of = np.repeat(np.arange(len(length)), length)
            place = np.arange(len(of)) - (np.cumsum(length) - length)[of]
            token = np.asarray(head.flatten()).astype(np.int64).view(_U64)
            key = T.mix(T.mix(hub.astype(np.int64).view(_U64))[of] * _U64(0x9E3779B97F4A7C15) + token)
            yield _packed(key, name[of], (place << 32) + d[of] - 1 - place, (key >> _U64(40)).astype(np.int64) % buckets)

    return run


def _sets_of_texts(n: int, heavy=None):
    """(name, tokens) of texts whose set is the wanted one; with ``heavy``, in
    that order, and with the number of other tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_pylist()
            seen: set[int] = set()
            for first, end, data, offsets in T.pieces(batch.column(0), PIECE_BYTES):
                names, sets = [], []
                for want, tokens in zip(wanted[first:end], shingle_sets(data, offsets, n), strict=True):
                    if want not in seen and identity(tokens) == want:
                        seen.add(want)
                        names.append(want)
                        sets.append(tokens if heavy is None else ordered(tokens, heavy.value))
                ends = np.cumsum([0, *(len(x) for x in sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *(x.view(np.int64) for x in sets)])))
                columns = {"name": _column(np.array(names, np.int64), pa.int64()), "tokens": lists}
                if heavy is not None:
                    columns["rare"] = _column(np.array([len(x) - int(among(x, heavy.value).sum()) for x in sets], np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _index(cells: DataFrame, size_type: type = np.int32) -> DataFrame:
    entries = cells.repartition(partitions(cells), "bucket")
    lists = cut(entries.mapInArrow(_lists(size_type), "key long, name long, size long"))
    release(cells.sparkSession)  # the shuffle of all entries
    return lists


def _alike(a: str, b: str):
    return F.lit(100) * F.least(a, b) >= F.lit(THRESHOLD) * F.greatest(a, b)


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each member of a list with one member of its list and length class;
    the lists of a cluster agree on a few."""
    classed = lists.withColumn("class", F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100 / THRESHOLD))))
    hubs = cut(classed.groupBy("key", "class").agg(F.min(F.struct(F.xxhash64("name", F.pmod("key", F.lit(8))), "name", "size")).alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1"))
    hubs = hubs.select(F.col("key").alias("k"), F.col("class").alias("c"), F.col("hub.name").alias("b"), F.col("hub.size").alias("nb"))
    return (
        classed.join(hubs, (F.col("key") == F.col("k")) & (F.col("class") == F.col("c")))
        .where("name <> b")
        .where(_alike("size", "nb"))
        .select(F.col("name").alias("a"), "b")
        .distinct()
    )


def _all_pairs(members: DataFrame, across: bool = False) -> DataFrame:
    """Pairs of members of one list, of fitting sizes; ``across``: of
    different groups."""
    a, b = members.alias("x"), members.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.name") < F.col("y.name")) & _alike("x.size", "y.size")
    if across:
        on &= F.col("x.label") != F.col("y.label")
    return a.join(b, on).select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct()


def _hubs(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """(name, hub): the hubs of the lists that a set is in, the hub itself
    among the names. All lists choose by one order, so those of one passage
    mostly have one hub."""
    rare = sets.select("name", (F.col("rare") / F.size("tokens")).alias("share"))
    members = cut(lists.join(rare, "name").select("key", "name", "share"))
    hubs = members.groupBy("key").agg(F.min(F.struct("share", F.xxhash64("name"), "name")).alias("hub"))
    hubs = cut(hubs.select(F.col("key").alias("k"), F.col("hub.name").alias("hub")))
    return cut(members.join(hubs, F.col("key") == F.col("k")).select("name", "hub").distinct())


def _head_length(n: str):
    """Tokens of a set's difference in which a similar set's is met."""
    return F.floor(F.col(n) / 3) + 1


def _differences(against: DataFrame, sets: DataFrame) -> DataFrame:
    """Each set against a hub (name, hub): (name, hub, d, linked, head),
    where ``head`` holds the first of the d tokens of the difference."""
    left = sets.select("name", F.col("tokens").alias("ta"))
    right = sets.select(F.col("name").alias("hub"), F.col("tokens").alias("th"))
    both = against.join(left, "name").join(right, "hub")
    own, lacks = F.array_except("ta", "th"), F.array_except("th", "ta")
    whole = both.select("name", "hub", F.size("ta").cast("long").alias("n"), F.size("th").cast("long").alias("nh"), F.concat(own, lacks).alias("d"))
    linked = F.lit(7) * F.size("d") <= F.col("n") + F.col("nh")
    return cut(whole.select("name", "hub", F.size("d").cast("long").alias("d"), linked.alias("linked"), F.slice("d", F.lit(1), _head_length("n").cast("int")).alias("head")))


def _meeting_pairs(entries: DataFrame) -> DataFrame:
    """Pairs of members of different groups whose differences from a hub have
    a token in common, early enough in both and with like rests."""
    a, b = entries.alias("x"), entries.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.name") < F.col("y.name")) & (F.col("x.label") != F.col("y.label"))
    differ = F.col("x.before") + F.col("y.before") + F.abs(F.col("x.after") - F.col("y.after"))
    on &= _alike("x.n", "y.n") & (F.lit(7) * differ <= F.col("x.n") + F.col("y.n"))
    return a.join(b, on).select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct()


def _by_length(lists: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The lists of up to ``most`` members, and the longer ones."""
    lengths = cut(lists.groupBy("key").agg(F.count(F.lit(1)).alias("members"))).withColumnRenamed("key", "k")
    release(lists.sparkSession)
    lists = cut(lists.join(lengths, F.col("key") == F.col("k")).drop("k"))
    return lists.where(F.col("members") <= most).drop("members"), lists.where(F.col("members") > most).drop("members")


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of lists that still hold several groups, with their group."""
    known = cut(lists.join(labels, F.col("name") == F.col("node"), "left").withColumn("label", F.coalesce("label", "name")).drop("node"))
    mixed = known.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h")
    return known.join(cut(mixed.select(F.col("key").alias("k"))), F.col("key") == F.col("k"), "left_semi")


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, x, y, n = (batch.column(i) for i in range(5))
        keep = [7 * apart(p, q) <= m for p, q, m in zip(x.to_pylist(), y.to_pylist(), n.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose bitmaps allow the similarity. J >= 3/4 means that at most
    a seventh of both sizes is in one set only."""
    left = sets.select(F.col("name").alias("a"), F.col("bits").alias("x"), F.col("n").alias("na"))
    right = sets.select(F.col("name").alias("b"), F.col("bits").alias("y"), F.col("n").alias("nb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", F.expr("na + nb").alias("n"))
    return cut(both.mapInArrow(_near, "a long, b long"))


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, name) of the documents that ``wanted`` (name, want_id) names;
    most other texts are spared the shuffle."""
    may = key_filter(wanted, "want_id")
    return rows.where(may("doc_id")).join(wanted, F.col("doc_id").eqNullSafe(F.col("want_id"))).select("text", "name")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough, compared whole."""
    left = sets.select(F.col("name").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("name").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("ta", "tb")).cast("long")
    return cut(
        both.select("a", "b", common.alias("i"), F.size("ta").alias("na"), F.size("tb").alias("nb"))
        .where(F.lit(100) * F.col("i") >= F.lit(THRESHOLD) * (F.col("na") + F.col("nb") - F.col("i")))
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def jaccard_components(
    docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A document's set holds the distinct n-grams of its lower-cased (A-Z) words
    ``[^\\x20\\x09-\\x0D]+``; fewer words are one token; without words the
    set is empty and linked with nothing (component: its own id). Documents
    link at a Jaccard similarity of 0.75 or more; ``component_id`` is the
    smallest doc_id reachable (null only where no member has an id). Null text
    counts as empty, repeated rows as copies; rows with null id take part.
    Other columns are ignored. An empty table gives no rows.

    Sets carry 64-bit hashes of n-grams and are named by a 64-bit hash.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    buckets = 8 * partitions(docs)
    release(spark)  # what an earlier job left

    survey = cut(rows.mapInArrow(_survey(n), f"doc_id {kind}, n long, name long, bits binary"))
    known = survey.where("bits is not null")
    total = known.agg(F.sum(F.floor(F.col("n") / 4) + 1)).first()[0] or 0
    # at most MOST_HEAVY tokens can be counted so often
    heavy = survey.where("bits is null").groupBy("name").agg(F.sum("n").alias("n"))
    heavy = heavy.where(F.col("n") >= max(64, -(-total // MOST_HEAVY))).select("name").toPandas()["name"]
    none = spark.sparkContext.broadcast(np.zeros(0, _U64))
    heavy = spark.sparkContext.broadcast(np.sort(heavy.to_numpy(dtype=np.int64).view(_U64)))
    named = cut(known.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits")))

    cells = "bucket long, keys binary, names binary, sizes binary"
    slotted = rows.select(slot_of("doc_id").alias("slot"), "text")
    lists = _index(slotted.mapInArrow(_index_texts(n, heavy, 1, buckets), cells))
    short, long = _by_length(lists, frequent)
    pairs = _plausible(_all_pairs(short).unionByName(_star_pairs(long)).distinct(), named)

    def wanted(names: DataFrame) -> DataFrame:
        return cut(named.join(names.distinct(), "name", "left_semi").select("name", F.col("doc_id").alias("want_id")))

    # an index pass over the texts of one document for each of some sets, and
    # of a few others: these only add entries to the index
    def index_of(names: DataFrame, late, k: int) -> DataFrame:
        bits = key_bitmap(wanted(names), "want_id")
        return _index(slotted.mapInArrow(_index_texts(n, late, k, buckets, bits), cells))

    def verified(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs.toDF("u", "v")
        names = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name")))
        return _similar(pairs, cut(_texts(rows, wanted(names)).mapInArrow(_sets_of_texts(n), "name long, tokens array<long>")))

    def merged(labels: DataFrame, found: DataFrame) -> DataFrame:
        if found.isEmpty():
            return labels
        return components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(found))

    release(spark)
    labels = components(verified(pairs))
    release(spark)
    again = cut(_open(long, labels).select("name").distinct())
    if not again.isEmpty():
        # documents with a frequent token in front: count all their tokens,
        # and index them again with the frequent ones last
        bits = key_bitmap(wanted(again), "want_id")
        counts = slotted.mapInArrow(_count_tokens(n, bits), "bucket long, keys binary, counts binary")
        often = counts.repartition(partitions(docs), "bucket").mapInArrow(_frequent_tokens(frequent), "key long, m long")
        often = often.orderBy(F.desc("m"), "key").limit(MOST_LATE).select("key").toPandas()["key"]
        late = spark.sparkContext.broadcast(np.sort(often.to_numpy(dtype=np.int64).view(_U64)))
        release(spark)
        lists = index_of(again, late, 1)
        release(spark)
        short, long = _by_length(lists, frequent)
        pairs = _all_pairs(cut(_open(short, labels)), across=True)
        labels = merged(labels, verified(_plausible(pairs.unionByName(_star_pairs(long)).distinct(), named)))
        release(spark)
        # documents of little but frequent tokens: by combinations, in an order
        # that mixes frequent and rare tokens
        again = cut(_open(long, labels).select("name").distinct())
        if not again.isEmpty():
            # short lists give their pairs, as before
            short, long = _by_length(cut(_open(index_of(again, none, 2), labels)), frequent)
            labels = merged(labels, verified(_plausible(_all_pairs(short, across=True), named)))
            release(spark)
            lists = cut(_open(long.drop("label"), labels)).drop("label")
            names = lists.select("name").distinct()
            sets = cut(_texts(rows, wanted(names)).mapInArrow(_sets_of_texts(n, late), "name long, tokens array<long>, rare long").dropDuplicates(["name"]))
            hubs = _hubs(lists, sets)
            sizes = cut(sets.select("name", F.size("tokens").cast("long").alias("n")))
            heads = hubs.where("name <> hub").join(sizes, "name").agg(F.sum(_head_length("n"))).first()[0] or 0
            del short, long, lists, names

            def met_by(some: DataFrame, labels: DataFrame) -> DataFrame:
                against = _open(some.withColumnRenamed("hub", "key"), labels)
                against = cut(against.where("name <> key").select("name", F.col("key").alias("hub")))
                apart_from_hub = _differences(against, sets)
                release(spark)
                labels = merged(labels, apart_from_hub.where("linked").select(F.col("name").alias("u"), F.col("hub").alias("v")))
                cells_of_heads = apart_from_hub.select("name", "hub", "d", "head").mapInArrow(_index_heads(partitions(docs)), cells)
                entries = _open(_index(cells_of_heads, np.int64), labels)
                places = F.expr("shiftright(size, 32)").alias("before"), F.expr("size & 4294967295L").alias("after")
                entries = cut(entries.join(sizes, "name").select("key", "name", "label", "n", *places))
                release(spark)
                return merged(labels, verified(_plausible(_meeting_pairs(entries), named)))

            # all differences together can be much more than the texts: a
            # round takes some of the hubs, and gives back its disk
            rounds = -(-heads // max(LEAST_ROUND, total // ROUND_SHARE))
            for i in range(rounds):
                labels = met_by(hubs.where(F.pmod(F.xxhash64("hub"), F.lit(rounds)) == i), labels)
                release(spark)

    grouped = cut(
        known.join(labels, F.col("name") == F.col("node"), "left").select("doc_id", "n", F.coalesce("label", "name").alias("label"))
    )
    least = cut(grouped.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")).select(F.col("label").alias("l"), "least"))
    return grouped.join(least, (F.col("label") == F.col("l")) & (F.col("n") > 0), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
