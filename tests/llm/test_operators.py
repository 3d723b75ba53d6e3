"""Each operator against a plain computation on sf0.001 or a small table, and
on odd tables: nulls, empty and repeated rows, clashing columns, no rows."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from remitlens.llm import decontaminate, dedup, fm_index, html_extract, jaccard, langid, lm, mix, quality, shard, suffix_dedup, suffix_sort

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and repeated rows, names that clash."""
    long = " ".join(f"Word{i}" for i in range(300))
    rows = [
        (1, long, "en", "a", 1),
        (1, long, "en", "a", 1),
        (2, long + " end", "en", None, 2),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n", "fr", "b", 0),
        (None, long, None, "a", 3),
        (None, "12 34 !?", "fr", "c", 3),
        (6, "é\x00ü 𝒳 ok ok", "fr", "b", 9),
        (7, "one two three", "de", "b", 9),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = {c: F.lit("x") for c in ("row", "size", "key", "found", "name", "n", "bits", "taken", "id", "html", "c0", "__s")}
    return spark.createDataFrame(rows, schema).withColumns(extra)


def collected(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()] if columns else df.collect()


def texts(docs):
    return {r[0]: r[1] or "" for r in docs.select("doc_id", "text").collect()}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_jaccard_matches_all_pairs(docs):
    sets = {}
    for i, t in texts(docs).items():
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and (common := len(sets[a] & sets[b])) and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    for frequent in (16, 1):
        got = collected(jaccard.jaccard_components(docs, frequent=frequent), "doc_id", "n_shingles", "component_id")
        assert sorted(got) == sorted((i, len(s), root(i)) for i, s in sets.items())


def test_neighbouring_tokens_of_similar_sets_are_found():
    rng = np.random.default_rng(1)
    for _ in range(300):
        size = int(rng.integers(4, 60))
        pool = np.unique(rng.integers(0, 2**63, 2 * size, dtype=np.uint64))
        a = np.sort(pool[:size])
        gone = rng.permutation(size)[: rng.integers(0, size // 4 + 1)]
        b = np.sort(np.concatenate([np.delete(a, gone), pool[size : size + rng.integers(0, size // 4 + 1)]]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 75 * (len(a) + len(b) - common) and len(a) + len(b) > 6:
            for k in (1, 2):
                assert set(jaccard.signatures(a, k).tolist()) & set(jaccard.signatures(b, k).tolist())
        apart = len(a) + len(b) - 2 * common
        assert jaccard.apart(jaccard.parities(a), jaccard.parities(b)) <= apart


def test_similar_sets_meet_in_their_differences_from_a_hub():
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(2000):
        size = int(rng.integers(4, 60))
        base = rng.permutation(10 * size)
        hub, a = set(base[:size].tolist()), set(base[: rng.integers(1, size + 1)].tolist())
        a |= set(base[size : size + rng.integers(0, size)].tolist())
        a_order = rng.permutation(list(a))
        b = set(a_order[rng.integers(0, len(a) // 4 + 1) :].tolist()) | set(base[2 * size : 2 * size + rng.integers(0, len(a) // 4 + 1)].tolist())
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        da, db = (sorted(x - hub) + sorted(hub - x) for x in (a, b))
        if all(7 * len(d) <= len(x) + len(hub) for d, x in ((da, a), (db, b))):
            continue  # both are merged with the hub
        c = next(t for t in da if t in db)
        i, j = da.index(c), db.index(c)
        assert i <= len(a) // 3 and j <= len(b) // 3
        assert 7 * (i + j + abs((len(da) - i) - (len(db) - j))) <= len(a) + len(b)
        met += 1
    assert met > 300


def test_jaccard_of_many_variants_of_one_text(spark):
    """Variants near the threshold, all of frequent tokens: the last index."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rng.choice(120, int(rng.integers(0, 7)), replace=False):
            w[k] = f"x{int(rng.integers(0, 3))}"
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t in rows}
    up = {i: i for i in sets}
    for _ in range(len(sets)):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
        if all(up[a] == up[b] for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])):
            break
    got = collected(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), frequent=2), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == sorted((i, len(s), up[i]) for i, s in sets.items())


def test_mix_meets_targets(docs):
    got = mix.mix_sources(docs).collect()
    by = collections.defaultdict(list)
    source = dict(collected(docs, "doc_id", "source"))
    for r in got:
        assert r["size"] == len(words_of(texts_cache(docs)[r["doc_id"]]))
        assert r["taken"] <= 3 * r["size"]
        by[source[r["doc_id"]]].append(r)
    for rows in by.values():
        assert rows[0]["source_size"] == sum(r["size"] for r in rows)
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= max(r["size"] for r in rows)
        assert rows[0]["target"] <= 3 * rows[0]["source_size"]
    total = sum(r["size"] for r in got)
    assert math.isclose(sum(rows[0]["target"] for rows in by.values()), total)
    copies = mix.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r["copies"] for r in got)


def test_shards(docs):
    rows = shard.assign_shards(docs, [1.0] * 40).collect()
    slots = collections.defaultdict(list)
    for r in rows:
        text = texts_cache(docs)[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    weighted = collections.Counter(r["shard"] for r in shard.assign_shards(docs.sparkSession.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), [1.0, 3.0]).collect())
    assert 2.8 < weighted[1] / weighted[0] < 3.2


_TEXTS: dict = {}


def texts_cache(docs):
    if not _TEXTS:
        _TEXTS.update(texts(docs))
    return _TEXTS


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    for _ in range(30):
        seq = rng.integers(0, 4, int(rng.integers(1, 120)))
        index = fm_index.FMIndex(seq, 3)
        phrases = rng.integers(1, 4, (20, 4))
        lengths = rng.integers(1, 5, 20)
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high, strict=True):
            want = [i for i in range(len(seq) - n + 1) if (seq[i : i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_decontamination(spark, docs):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    more = spark.createDataFrame([(900, "of the"), (901, None), (902, "!!"), (None, "of the")], "item_id long, text string")
    items = benchmark.unionByName(more)
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for i, t in collected(items, "item_id", "text"):
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(None if i is None else str(i))
    want = {}
    for i, t in texts_cache(docs).items():
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if x := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= x
        listed = ",".join(sorted(x for x in found if x is not None))
        want[i] = (len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = {r[0]: r[1:] for r in collected(decontaminate.contamination(docs, items), *columns)}
    assert got == want
    in_blocks = decontaminate.find_passages(docs.select("doc_id", "text"), items, block_bytes=2000)
    blocks = {r[0]: (r[1], sum(s["end"] - s["first"] for s in r[2]), len(r[3])) for r in collected(in_blocks, "doc_id", "found.n_words", "found.spans", "found.items")}
    assert blocks == {i: x[:3] for i, x in want.items()}
    clean = decontaminate.without_passages(docs, items)
    assert clean.columns == docs.columns
    assert {r[0] for r in collected(clean, "doc_id")} == {i for i, x in want.items() if not x[4]}
    cut = texts(decontaminate.cut_passages(docs, benchmark))
    assert cut.keys() == want.keys() and any(len(cut[i]) < len(t) for i, t in texts_cache(docs).items())


def test_language_accuracy(docs):
    rows = langid.predicted_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_broadcast_filter_keeps_a_share_of_any_corpus():
    assert lm.frequent_level(1000) == 0 and lm.least_level(np.array([1, 2]), lm.frequent_level(1000)) == 0
    for times in (8, 64):  # a larger corpus of the same shares: the same n-grams, levels higher
        level = np.array([1, 2, 3, 4, 6]) + times.bit_length() - 1
        frequent = lm.frequent_level(times * 4 * lm.FREQUENT)
        assert (level >= lm.least_level(level, frequent)).tolist() == [False, False, True, True, True]


def test_language_model_is_trained_in_a_task(spark, monkeypatch):
    own = langid.train

    def marked(rows):
        import os

        model = own(rows)
        model.temperature = float(os.getpid())
        return model

    monkeypatch.setattr(langid, "train", marked)
    rows = [(i, x * 9, lang) for i, (x, lang) in enumerate([("abc ", "a"), ("xyz ", "b")] * 20)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), 50)
    assert model.languages == ["a", "b"] and model.temperature != os.getpid()


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} words of it", f"l{i:04}") for i in range(1010)]
    rows += [(2000, "again and again", "l0000")] * 300
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), 2)
    assert model.languages == [f"l{i:04}" for i in range(1010)]


def test_quality_ranks_held_out_documents(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_html_main_text():
    page = "<html><body><nav><a href='/'>Home</a></nav><div><h1>T &amp; U</h1><p>One <b>two</b>\n three<br><p>Four</div><script>x='</p>'</script></body></html>"
    nodes = html_extract.parse(page)
    kept = [n.tag in ("div", "h1", "p", "b") for n in nodes]
    assert html_extract.text_of(nodes, kept) == "T & U\n\nOne two three\n\nFour"
    assert html_extract.text_of(html_extract.parse(""), [True]) == ""
    odds = np.full(len(nodes), 3.0)
    state = html_extract.decode(nodes, odds)
    assert not any(state[i] for i, n in enumerate(nodes) if n.tag in ("script", "nav"))


def test_html_extraction(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = {r["page_id"]: r for r in html_extract.main_texts(pages).collect()}
    assert len(rows) == pages.count()
    for page, text in collected(pages, "page_id", "html"):
        article = re.search(r"<article>(.*?)</article>", text, re.S)[1]
        import html as h

        want = [re.sub(r"\s+", " ", h.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split("</?(?:p|h1)>", article)]
        assert rows[page]["text"] == "\n\n".join(b for b in want if b)
        assert rows[page]["n_chars"] == len(rows[page]["text"])
    odd = spark.createDataFrame([(1, None, None), (2, "u", ""), (2, "u", "")], "page_id long, url string, html string")
    assert [r["text"] for r in html_extract.main_texts(odd).collect()] == ["", "", ""]
    assert html_extract.main_texts(odd.limit(0)).count() == 0


def test_html_article_in_a_form(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").orderBy("page_id").limit(40)
    plain = {r["page_id"]: r["text"] for r in html_extract.main_texts(pages).collect()}
    wrapped = pages.withColumn("html", F.regexp_replace("html", "(?s)(<body[^>]*>)(.*?)(</body>|$)", '$1<form id="aspnetForm" action="/p">$2</form>$3'))
    assert wrapped.where("html like '%aspnetForm%'").count() == len(plain)
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(pages.unionByName(wrapped.withColumn("page_id", F.col("page_id") + 1000000))).collect()}
    assert all(got[i] == t and got[i + 1000000] == t for i, t in plain.items())
    nodes = html_extract.parse("<article><p>Let <math><mi>x</mi></math> be</p><form><p>Vote</p></form></article>")
    assert html_extract.text_of(nodes, html_extract.decode(nodes, np.full(len(nodes), 3.0))) == "Let x be"
    assert html_extract.weak_labels(nodes)[[n.tag for n in nodes].index("form")] == 0


def test_html_learns_from_the_few_marked_pages(spark):
    plain = "<html><body><div id='menu'><a href='/'>mainly</a></div><div class='mainframe'><p>Text of a page, long enough.</p></div></body></html>"
    rows = [(i, "u", plain) for i in range(600)]
    assert html_extract.fit(spark.createDataFrame(rows, "page_id long, url string, html string"), sample=1) is None
    rows[17] = (17, "u", "<html><body><nav>Home</nav><article><p>One, two.</p></article></body></html>")
    assert html_extract.fit(spark.createDataFrame(rows, "page_id long, url string, html string"), sample=1)
    long = "<p>x</p>" * 30000
    rows[17] = (17, "u", f"<html><body>{long}<article><p>One, two.</p></article></body></html>")
    assert html_extract.fit(spark.createDataFrame(rows, "page_id long, url string, html string"), sample=1)


def test_lm_base_scores(docs):
    count = collections.Counter()
    tokens = {i: [*words_of(t), "\0end "] for i, t in texts_cache(docs).items()}
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(w)
    total, kinds = sum(count.values()), len(count)
    for head in (1 << 19, 5):
        for r in lm.lm_scores(docs, head_words=head).collect():
            w = tokens[r["doc_id"]]
            base = sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(count[x] > 0 for x in w), total)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9)
            assert r["score"] < 0


def test_count_filter_levels():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2**52, 2000, dtype=np.uint64))  # all in the first segment
    counts = rng.integers(1, 40, len(keys))
    bits = np.concatenate([lm.segment_bitmap(keys, counts), np.zeros(8, np.uint8)])
    got = lm.CountFilter(bits).counts(keys)
    assert (got >= 2.0 ** np.floor(np.log2(counts))).all()
    assert np.mean(got <= counts) > 0.95


def test_segment_with_more_entries_than_room():
    rng = np.random.default_rng(6)
    keys = np.unique(rng.integers(0, 2**52, 30000, dtype=np.uint64))
    counts = np.where(np.arange(len(keys)) % 10 == 0, 5, 1)
    rows = lm.packed_counts(np.repeat(keys, counts))
    filled = next(lm._fill(lm.BUCKET_BITS)(iter([rows])))  # the first segment
    own = lm.OwnFilters({0: filled.column("more")[0].as_py()})
    least = np.zeros(1 << lm.SEGMENT_BITS, np.int64)
    least[0] = filled.column("least")[0].as_py()
    counter = lm.CountFilter(np.frombuffer(filled.column("bits")[0].as_py(), np.uint8), least)
    read = counter.counts(keys)
    asked = counter.undecided(keys, read)
    assert asked[counts == 1].mean() > 0.9 and not asked[counts == 5].any()
    got = np.where(asked, own.counts(keys), read)
    assert (got >= np.where(counts == 5, 4, 1)).all() and (got[asked] == 1).mean() > 0.98
    others = rng.integers(0, 2**52, 30000, dtype=np.uint64)
    assert (own.counts(np.setdiff1d(others, keys)) > 0).mean() < 0.01
    assert (own.counts(keys + np.uint64(1 << 60)) == 0).all()  # a segment without a filter


def test_names_of_ngrams_and_their_planes():
    rng = np.random.default_rng(8)
    keys = rng.integers(0, 2**64, 999, dtype=np.uint64)
    for total, width in ((0, 5), (10**8, 5), (10**10, 6), (10**13, 7), (2**62, 8)):
        assert lm.key_bytes(total) == width
        short = lm.named(keys, width)
        assert (lm.from_planes(lm.planes(short, width), width, np.uint64) == short).all()
        counted = list(lm.merged_counts(iter([lm.packed_counts(np.concatenate([short, short[:9]]), width=width)] * 2)))
        found = dict(zip(np.concatenate([k for _, k, _ in counted]).tolist(), np.concatenate([c for _, _, c in counted]).tolist(), strict=True))
        assert found == {k: 4 if i < 9 else 2 for i, k in enumerate(short.tolist())}
    assert lm.planes(keys[:0], 5) == b"" and lm.from_planes(b"", 5, np.uint64).size == 0


def test_followers_of_a_context_sum_to_one_at_most():
    low = lambda c: np.exp2(np.floor(np.log2(c)))
    for followers in ([1] * 127, [1] * 255, [127], [3, 5, 120], [1] * 64, [2] * 40):
        pairs = np.array(followers, float)
        total, kinds = int(pairs.sum()) + 50, len(pairs) + 1
        for own in (pairs, low(pairs)):  # words as frequent as their bigrams, exact or quantised
            mass = lm.numerator(low(pairs), lm.steps(own), total, kinds).sum() / (pairs.sum() + lm.SMOOTHING)
            assert mass <= 1.0


def test_lm_scores_without_room_in_the_filter(docs, monkeypatch):
    """Segments of one byte have room for next to nothing: counts from the
    segments' own filters."""
    monkeypatch.setattr(lm, "SEGMENT", 8)
    monkeypatch.setattr(lm, "MORE_BITS", 96)  # no false positives to speak of
    tokens = {i: [*words_of(t), "\0end "] for i, t in texts_cache(docs).items()}
    trained = [w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    words = collections.Counter(x for w in trained for x in w)
    pairs = collections.Counter(x for w in trained for x in zip(["\0end ", *w], w, strict=False))
    total, kinds = sum(words.values()), len(words)
    low = lambda c: 2.0 ** math.floor(math.log2(c)) if c else 0.0
    for head in (1 << 19, 5):
        least = 0 if head > 5 else sorted(words.values())[-5]
        known = lambda x: words[x] if words[x] >= least else low(words[x])
        for r in lm.lm_scores(docs, head_words=head).collect():
            want, before = 0.0, "\0end "
            for x in tokens[r["doc_id"]]:
                joint = low(pairs[before, x])
                alone = 2.0 ** (math.floor(8 * math.log2(known(x) + 1)) / 8)
                want += math.log10((joint + 16.0 * alone / (total + kinds + 1)) / (words[before] + 16.0))
                before = x
            assert math.isclose(r["score"], want, rel_tol=1e-6)


def test_suffix_sort_orders_suffixes():
    rng = np.random.default_rng(9)
    for _ in range(40):
        depth = 6
        strings = [bytes(rng.integers(97, 100, int(rng.integers(depth, 40))).astype(np.uint8)) for _ in range(5)]
        ends = np.cumsum([len(s) for s in strings])
        starts = np.concatenate([[0], ends[:-1]])
        wanted = ends - starts - depth + 1
        data = np.frombuffer(b"".join(strings), np.uint8)
        order = suffix_sort.sort_suffixes(data, starts, ends, wanted, depth)
        heads = [bytes(data[i : i + depth]) for i in order.tolist()]
        assert heads == sorted(heads) and len(heads) == wanted.sum()
        common = suffix_sort.common_prefixes(data, order, depth)
        assert all((c == depth) == (a == b) for a, b, c in zip(heads, heads[1:], common[1:], strict=False))


@pytest.mark.parametrize("regions", [256, 2])
def test_repeated_passages(docs, regions):
    raw = {i: t.encode() for i, t in texts_cache(docs).items()}
    seen = collections.Counter(b[k : k + 400] for b in raw.values() for k in range(len(b) - 399))
    for r in suffix_dedup.remove_repeats(docs, regions).collect():
        b = raw[r["doc_id"]]
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        kept = hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), sum(gone), spans, kept)


def test_exact_dedup_on_odd_rows(odd):
    rows = dedup.exact_dedup(odd, fan_in=2).collect()
    assert len(rows) == odd.count()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["text_sha256"]].append(r)
    assert all(sum(r["kept"] for r in g) == 1 and all(r["group_size"] == len(g) for r in g) for g in groups.values())
    empty = groups[hashlib.sha256(b"").hexdigest()]
    assert sorted(r["doc_id"] for r in empty) == [3, 4, 5] and {r["keep_id"] for r in empty} == {5}


def _odd_results(odd, labels):
    return {
        "mix": mix.mix_sources(odd),
        "mixed": mix.mixed_documents(odd),
        "jaccard": jaccard.jaccard_components(odd),
        "language": langid.predicted_languages(odd),
        "spoken": langid.spoken_documents(odd),
        "passages": decontaminate.contamination(odd, odd.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 7")),
        "quality": quality.quality_scores(odd, labels),
        "lm": lm.lm_scores(odd),
        "repeats": suffix_dedup.remove_repeats(odd),
        "shards": shard.assign_shards(odd, [1.0, 2.0]),
        "dedup": dedup.exact_dedup(odd),
    }


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = {k: v.collect() for k, v in _odd_results(odd, labels).items()}
    assert all(len(v) == 10 for k, v in out.items() if k not in ("mixed", "spoken"))
    groups = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in out["jaccard"])
    assert groups == [(0, 1, 0), (0, 296, 1), (1, 296, 1), (1, 296, 1), (2, 297, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 7)]
    assert {r["lang_pred"] for r in out["language"] if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert {r["doc_id"]: r["n_hit"] for r in out["passages"]}[7] == 3
    assert all(r["n_removed"] > 2000 for r in out["repeats"] if r["doc_id"] in (1, 2))
    assert {r["doc_id"] for r in out["spoken"]} >= {1, 2} and "__s" in out["spoken"][0].asDict()


def test_empty_tables(spark, odd):
    none = odd.where("doc_id < 0")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, df in _odd_results(none, labels).items():
        assert df.collect() == [], name


def test_component_rounds_give_back_their_disk(spark, monkeypatch):
    """A path takes several rounds; the shuffles of each go before the next."""
    from remitlens.llm import components as module

    calls = []
    monkeypatch.setattr(module, "release", lambda s: calls.append(s), raising=False)
    path = spark.createDataFrame([((7 * i) % 64, (7 * i + 7) % 64) for i in range(63)], "u long, v long")
    assert {r.label for r in module.components(path).collect()} == {0}
    assert len(calls) >= 2


def test_shingled_pieces_are_bounded():
    """The memory of a task that shingles texts, without the sets it yields."""
    import tracemalloc

    from remitlens.llm.jaccard import _different_sets

    words = [f"w{i:05d}" for i in range(5000)]
    texts = [" ".join(words[(i * j * 31 + j) % 5000] for j in range(350)) for i in range(800)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(800), pa.int64()), pa.array(texts)], names=["slot", "text"])
    list(_different_sets(batch.slice(0, 10), 5, None))
    tracemalloc.start()
    try:
        seen = sum(len(part) for part in _different_sets(batch, 5, None))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert seen == 800 and peak < 16e6


def _shuffled_passages(spark):
    """Texts of passages in many orders, whose combinations of tokens are in
    short and long lists, and the components of a brute force."""
    rng = np.random.default_rng(5)
    passages = [[f"p{p}w{k}" for k in range(24)] for p in range(12)]
    rows = []
    for i in range(40):
        w = [x for p in rng.permutation(12)[: int(rng.integers(6, 9))] for x in passages[p]]
        rows.append((2 * i, " ".join(w)))
        rows.append((2 * i + 1, " ".join(w[: int(rng.integers(100, len(w)))])))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return spark.createDataFrame(rows, "doc_id long, text string"), sorted((i, len(s), root(i)) for i, s in sets.items())


def _sent(monkeypatch):
    """Keys sent to the indexes of a run: (of differences, keys) by index."""
    sent, index = [], jaccard._index
    monkeypatch.setattr(jaccard, "_index", lambda cells, *a: (sent.append((bool(a), cells.agg(F.sum(F.length("keys") / 8)).first()[0] or 0)), index(cells, *a))[1])
    return sent


def test_short_lists_of_combinations_are_not_compared_with_hubs(spark, monkeypatch):
    """The entries of differences grew with the square of the corpus."""
    docs, expected = _shuffled_passages(spark)
    sent = _sent(monkeypatch)
    got = collected(jaccard.jaccard_components(docs, frequent=16), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == expected
    assert [of_heads for of_heads, _ in sent] == [False, False, False, True]
    assert sent[3][1] < 12 * sent[0][1]  # 18 times with the short lists


def test_a_round_of_hubs_is_bounded(spark, monkeypatch):
    docs, expected = _shuffled_passages(spark)
    sent = _sent(monkeypatch)
    collected(jaccard.jaccard_components(docs, frequent=4))
    whole = sum(n for of_heads, n in sent if of_heads)
    sent.clear()
    monkeypatch.setattr(jaccard, "LEAST_ROUND", int(whole) // 2)
    got = collected(jaccard.jaccard_components(docs, frequent=4), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == expected
    heads = [n for of_heads, n in sent if of_heads]
    assert len(heads) > 1 and max(heads) < whole


def test_release_tells_the_jvm_of_dropped_frames(spark):
    from remitlens.llm.scratch import release

    frames = [spark.range(3).select("id") for _ in range(50)]
    del frames
    release(spark)
    assert not spark.sparkContext._gateway._gateway_client.finalizer_deque
