"""SimHash, I-Match, quality, mixing, language model, URL filter and top-k against brute force."""

import collections
import hashlib
import math
import re
import struct

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from harkline.llm import components, ctw, imatch, mixing, quality, simhash, topk, urls
from harkline.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import ROWS

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def small_documents():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --- components and SimHash


def roots_of(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (500, 400), (400, 500), (None, 3)]
    got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    want = roots_of([(a, b) for a, b in links if a is not None and a != b])
    assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_print(text):
    words = SPACE.findall(lower(text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_print(t) for _, t, *_ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a, len(rows)) if (prints[a] ^ prints[b]).bit_count() <= 4]
    root = roots_of(links)
    smallest = {}
    for k, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            smallest[root[k]] = min(doc_id, smallest.get(root[k], doc_id))
    return [(doc_id, f"{prints[k]:016x}", smallest.get(root[k])) for k, (doc_id, *_) in enumerate(rows)], root


def test_every_near_pair_shares_a_key():
    r = np.random.default_rng(3)
    keys = simhash.chain_keys()
    for _ in range(3000):
        a = int(r.integers(0, 1 << 63))
        b = a
        for p in r.choice(64, r.integers(0, 7), replace=False):
            b ^= 1 << int(p)
        met = any(
            (a & m) == (b & m) and len(simhash._within(np.uint64(a), np.array([b], dtype=np.uint64), simhash._chain_checks(s)))
            for s, m in keys
        )
        assert met == ((a ^ b).bit_count() <= 4)


def test_simhash(spark, docs, empty):
    for rows, frame in ((ROWS, docs), (small_documents(), table(spark, SMALL, "documents"))):
        got = simhash.near_duplicate_components(frame).collect()
        assert sorted(map(tuple, got), key=str) == sorted(plain_components(rows)[0], key=str)
    assert simhash.near_duplicate_components(empty).count() == 0


def test_links_of_a_large_near_group(spark):
    """A chain in which only neighbours are near must stay whole."""
    r = np.random.default_rng(4)
    prints = [int(r.integers(0, 1 << 62))]
    for _ in range(600):
        step = prints[-1]
        for p in r.choice(62, 4, replace=False):
            step ^= 1 << int(p)
        prints.append(step)
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "doc_id long, fingerprint long")
    assert {r.component_id for r in simhash.fingerprint_components(frame).collect()} == {0}


def test_keep_one_each(docs, empty):
    kept = simhash.keep_one_each(docs).collect()
    _, root = plain_components(ROWS)
    best = {}
    for k, (doc_id, text, *_) in enumerate(ROWS):
        mine = (doc_id is None, doc_id or 0, plain_print(text))
        best[root[k]] = min(best.get(root[k], mine), mine)
    want = sorted((0 if missing else doc_id, found) for missing, doc_id, found in best.values())
    assert sorted((r.doc_id or 0, plain_print(r.text)) for r in kept) == want
    assert kept[0].__fields__ == docs.columns and simhash.keep_one_each(empty).count() == 0


# --- I-Match


@pytest.mark.parametrize("distinct", [False, True])
def test_imatch(docs, empty, distinct):
    """The registered query takes distinct texts for its lexicon."""
    for rows, frame in ((ROWS, docs), (small_documents(), None)):
        frame = frame if frame is not None else table(docs.sparkSession, SMALL, "documents")
        rows = sorted(
            ((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()), reverse=True
        )
        terms = [{xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\W_]+", t.lower())} for _, t in rows]
        counted = list({t: found for (_, t), found in zip(rows, terms)}.values()) if distinct else terms
        seen = collections.Counter(c for s in counted for c in s)
        low, high = max(2, len(counted) / 1024), max(2, len(counted) / (2 if distinct else 4))
        band = {c for c, n in seen.items() if low <= n <= high}
        masks = [m & ((1 << 64) - 1) for m in imatch._subset_masks()]

        def signed(c):
            return c - (1 << 64) if c >> 63 else c

        def prints(text):
            codes = sorted(signed(c) for c in {xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\W_]+", text.lower())} & band)
            out = []
            for m in masks:
                members = [c for c in codes if not (c & ((1 << 64) - 1)) & m]
                h = 42
                for c in members:
                    h = xxhash.xxh64_intdigest(struct.pack("<q", c), h)
                out.append(f"{h:016x}" if members else "-")
            whole = f"whole.{xxhash.xxh64_intdigest(text.encode(), 42):016x}"
            return whole if set(out) == {"-"} else ".".join(out)

        def like(a, b):
            if a.startswith("whole") and b.startswith("whole"):
                return float(a == b)
            a, b = (["-"] * 16 if x.startswith("whole") else x.split(".") for x in (a, b))
            filled = [(x, y) for x, y in zip(a, b) if (x, y) != ("-", "-")]
            return sum(x == y for x, y in filled) / len(filled)

        want = []
        for k, (i, t) in enumerate(rows):
            after = rows[(k + 1) % len(rows)][1]
            edit = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
            a, b, c = prints(t), prints(edit), prints(after)
            want.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), a, b, round(like(a, b), 9), round(like(a, c), 9)))
        got = [(*tuple(r)[:5], round(r[5], 9), round(r[6], 9)) for r in imatch.fingerprint_report(frame, distinct=distinct).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert imatch.fingerprint_report(empty, distinct=distinct).count() == 0


def test_imatch_over_many_blocks(docs, monkeypatch):
    whole = sorted(map(str, imatch.fingerprint_report(docs).collect()))
    monkeypatch.setattr(imatch, "BLOCK", 3)
    monkeypatch.setattr(imatch, "GROUP", 4)
    assert sorted(map(str, imatch.fingerprint_report(docs).collect())) == whole


# --- quality


def plain_quality(rows, labels):
    """Model, weights, threshold and draw from single documents; features are those of the operator."""
    found = {}
    for text in {t or "" for _, t in rows}:
        found[text] = quality.features(pa.array([text]))[0].reshape(-1, quality.VIEWS)
    good = {}
    for i, q in labels:
        if i is not None and q is not None:
            good[i] = min(good.get(i, 1), int(q == 1))
    target, raw = np.zeros((2, quality.VIEWS * quality.BUCKETS))
    for i, t in rows:
        np.add.at(raw, found[t or ""].reshape(-1), 1)
        if good.get(i) == 1:
            np.add.at(target, found[t or ""].reshape(-1), 1)
    model = np.zeros(len(raw))
    for view in range(quality.VIEWS):
        at = slice(view * quality.BUCKETS, (view + 1) * quality.BUCKETS)
        share = target[at].sum() / max(raw[at].sum(), 1)
        model[at] = np.log((target[at] + quality.PRIOR) / (raw[at] * share + quality.PRIOR))
    model = model.astype(np.float32)
    weights = [float(model[found[t or ""]].sum(axis=1, dtype=np.float64).sum()) for _, t in rows]

    def key(doc_id, weight):
        h = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", quality.SEED), h)
        h = xxhash.xxh64_intdigest(struct.pack("<d", round(weight, 6) + 0.0), h)
        return weight / quality.TEMPERATURE - math.log(-math.log(((h >> 11) + 0.5) / (1 << 53)))

    keys = [key(i, w) for (i, _), w in zip(rows, weights)]
    width = 2 * quality.FAR / quality.BINS
    bins = [(math.floor((min(max(w, -quality.FAR), quality.FAR) + quality.FAR) / width), good[i]) for (i, _), w in zip(rows, weights) if i in good]
    bad_of, good_of = ([b for b, g in bins if g == k] for k in (0, 1))
    edges = sorted({b for b, _ in bins} | {b + 1 for b, _ in bins})
    gain = {e: sum(b < e for b in bad_of) / len(bad_of) - sum(b < e for b in good_of) / len(good_of) for e in edges}
    best = [e for e in edges if gain[e] >= max(gain.values()) - 1e-12]
    # the gain stays the same up to the next document's bin
    last = min([b for b, _ in bins if b >= best[-1]], default=quality.BINS + 1)
    threshold = (best[0] + last) / 2 * width - quality.FAR
    stays = sum(w >= threshold for w in weights)
    least = sorted(keys, reverse=True)[stays - 1]
    return [(i, round(w, 4), round(k, 3), k >= least) for (i, _), w, k in zip(rows, weights, keys)]


def test_quality_against_single_documents(spark):
    docs, labels = (table(spark, SMALL, name) for name in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()] + [(None, "some words here"), (0, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_quality(rows, [tuple(r) for r in labels.select("doc_id", "quality").collect()])
    got = [(r.doc_id, round(r.log_weight, 4), round(r.draw_key, 3), r.kept) for r in quality.quality_report(frame, labels).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert 0 < sum(k for *_, k in got) < len(rows)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    fitted = labels.where(F.xxhash64("doc_id") % 2 == 0)
    got = {r.doc_id: r.kept for r in quality.quality_report(table(spark, sf, "documents"), fitted).collect()}
    assert len(got) == 1000
    held = [r for r in labels.where(F.xxhash64("doc_id") % 2 != 0).collect()]
    good = [got[r.doc_id] for r in held if r.quality == 1]
    bad = [got[r.doc_id] for r in held if r.quality == 0]
    assert len(good) > 100 and len(bad) > 15
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_quality_features():
    texts = ["Same same same. other", "", None, "a&&& b%%% c"]
    buckets, counts = quality.features(pa.array(texts))
    assert counts.tolist() == [4, 0, 0, 3] and buckets.shape == (7, quality.VIEWS)
    # a repeated word is one pair of its own, wherever it stands
    assert buckets[1, 1] == buckets[1, 1] and buckets[0, 0] == buckets[1, 0] and buckets[1, 1] != buckets[2, 1]
    assert ((buckets // quality.BUCKETS) == np.arange(quality.VIEWS)).all()
    alone, _ = quality.features(pa.array(["a&&& b%%% c"]))
    assert (alone == buckets[4:]).all()


def test_log_weights_by_hand(docs):
    model = np.random.default_rng(1).normal(size=quality.VIEWS * quality.BUCKETS)
    got = quality.add_log_weights(docs, model, ["doc_id", "text"]).collect()
    for r in got:
        buckets, counts = quality.features(pa.array([r.c1], pa.string()))
        assert r._words == counts[0] and math.isclose(r._weight, model[buckets].sum(), rel_tol=1e-4, abs_tol=1e-3)


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(2).normal(size=500)] + [1.0] * 50
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 77, 100, 549, 550):
        assert quality.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]


def test_quality_defined_cases(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_drawn(docs, none).count() == len(ROWS)
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (33, 0, 0), (None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    kept = quality.keep_drawn(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(ROWS)
    assert quality.keep_drawn(empty, labels).count() == 0 and quality.quality_report(empty, labels).count() == 0


# --- mixing


def plain_targets(size):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped = {}
    while True:
        free = [s for s in order if s not in capped]
        rest = 1.5 * sum(size.values()) - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            return capped | share
        capped |= {s: 2 * size[s] for s in over}


def test_mix(spark, docs, empty):
    for rows, frame in ((ROWS, docs), (small_documents(), table(spark, SMALL, "documents"))):
        got = mixing.mix_report(frame).collect()
        assert len(got) == len(rows)
        size = collections.Counter()
        for _, t, s in rows:
            size[s] += len(SPACE.findall(t or ""))
        target = plain_targets(size)
        source = {}
        for i, t, s in rows:
            source.setdefault((i, len(SPACE.findall(t or ""))), set()).add(s)
        taken = collections.Counter()
        for r in got:
            near = [s for s in source[r.doc_id, r.size] if size[s] == r.source_size and math.isclose(target[s], r.target, abs_tol=1e-6)]
            assert near, r
            assert 0 <= r.taken <= 2 * r.size
            taken[near[0]] += r.taken
        for s in size:
            assert abs(taken[s] - target[s]) <= 4 * mixing.BLOCK_WORDS, s
            assert target[s] < 1 or taken[s] > 0
        assert sorted(map(tuple, mixing.mix_report(frame).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix_report(empty).count() == 0


def test_mix_of_many_small_sources(spark):
    """A thousand sources of 1 to 40 words and a large one: none vanishes, all meet their targets."""
    rows = [(i, " ".join(["w"] * (1 + i % 40)), f"s{i:04d}") for i in range(1000)] + [(1000, "word " * 50_000, "t")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix_report(frame).collect()
    target = plain_targets(collections.Counter({s: len(t.split()) for _, t, s in rows}))
    by_source = {s: (r.taken, r.target) for r in got for i, _, s in rows if i == r.doc_id}
    for s, (taken, wanted) in by_source.items():
        assert math.isclose(wanted, target[s], abs_tol=1e-6) and abs(taken - wanted) <= max(1, wanted / 50), s
    assert abs(sum(t for t, _ in by_source.values()) - sum(target.values())) <= 0.01 * sum(target.values())
    mixed = mixing.mixed_documents(frame.withColumn("n_chars", F.length("text")))
    words = collections.Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    assert set(words) == {s for s, (taken, _) in by_source.items() if taken}
    assert all(words[s] == taken for s, (taken, _) in by_source.items() if s != "t")


def test_slots_of_a_large_source_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 8)
    monkeypatch.setattr(mixing, "CHUNKS", 4)
    targets = spark.createDataFrame([("a", 0, 64 * 301, 64 * 450.0), ("b", 1, 3, 6.0)], "source string, no long, source_size long, target double")
    rows = mixing.slots(targets).collect()
    assert sorted(r.shard * mixing.SHARD_SLOTS + r.slot for r in rows) == list(range(456))
    assert sorted((r.turn, r.block) for r in rows if r.no == 1) == [(t, b) for t in (0, 1) for b in range(3)]


def test_permutations(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("k"))).collect()]
        assert sorted(got) == list(range(n))
        if n == 1000:
            assert sum(a == b for a, b in enumerate(got)) < 10
            other = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("j"))).collect()]
            assert other != got


def test_slots_and_blocks(spark):
    """Every slot once; in each turn a source's blocks at most once; shards hold all sources by share."""
    targets = spark.createDataFrame([("a", 0, 64 * 300, 64 * 450.0), ("b", 1, 64 * 900 + 5, 64 * 700.0)], "source string, no long, source_size long, target double")
    rows = mixing.slots(targets).collect()
    assert sorted((r.shard * mixing.SHARD_SLOTS + r.slot) for r in rows) == list(range(1150))
    assert max(collections.Counter((r.no, r.turn, r.block) for r in rows).values()) == 1
    first = [r.no for r in rows if r.shard == 0 and r.slot < 230]
    assert 60 < first.count(0) < 120


def test_word_count_and_positions(spark, docs):
    got = docs.select("text", mixing.word_count(F.col("text")).alias("n"), mixing.words(F.col("text")).alias("w")).collect()
    assert all((r.n, r.w) == (len(SPACE.findall(r.text or "")), SPACE.findall(r.text or "")) for r in got)


def test_mixed_documents(spark, docs, empty):
    """The texts of the mix hold exactly the words the report says are taken."""
    sure = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    taken = {r.doc_id: r.taken for r in mixing.mix_report(sure).collect()}
    mixed = mixing.mixed_documents(sure)
    assert mixed.columns == docs.columns
    words = collections.Counter()
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(SPACE.findall(r.text))
    size = sum(taken.values())
    assert abs(sum(words.values()) - size) <= 0.02 * size + 64
    assert mixing.mixed_documents(empty).count() == 0


# --- language model


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.3, 100.0, 1e6, 1e12])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


@pytest.mark.parametrize("frequent", [1 << 17, 3])
def test_language_model(spark, docs, empty, monkeypatch, frequent):
    monkeypatch.setattr(ctw, "FREQUENT", frequent)
    import zlib

    got = ctw.score_documents(docs).collect()
    assert len(got) == len(ROWS)
    tokens = [[*SPACE.findall(lower(t or "")), None] for _, t, _ in ROWS]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in ROWS]
    seen = collections.Counter(w for ws, o in zip(tokens, out) if not o for w in ws)
    total, distinct = sum(seen.values()), len(seen)
    want = [
        (i, o, len(ws), sum(seen[w] > 0 for w in ws), total, round(sum(math.log10((seen[w] + 1) / (total + distinct + 1)) for w in ws), 6))
        for (i, *_), ws, o in zip(ROWS, tokens, out)
    ]
    assert sorted(((*tuple(r)[:5], round(r.base_score, 6)) for r in got), key=str) == sorted(want, key=str)
    assert all(r.score < 0 for r in got)
    assert ctw.score_documents(empty).count() == 0


def test_language_model_learns(spark):
    got = ctw.score_documents(table(spark, SMALL, "documents")).where("held_out").collect()
    assert np.median([r.bits_per_byte for r in got]) < 3.5


# --- URL filter


def test_aliases(spark):
    pages = [
        (1, "https://good.org/a", '<link rel="canonical" href="https://bad.net/es/x">'),
        (2, "http://good.org/a/?utm_source=f#top", None),
        (3, "https://else.org/r", "<meta http-equiv='refresh' content='0; url=/b'>"),
        (4, "https://else.org/b.html", '<LINK href="https://bad.net/fr/y" rel=canonical>'),
        (5, "https://free.org/q", '<link rel="canonical" href="https://bad.net/es/z">'),
        (6, "https://free.org/q?ref=1", '<link rel="canonical" href="https://ok.com/">'),
        (7, "no scheme", "x"), (8, None, None), (9, "http://ALL.Net/es/", None), (10, "https://alone.org", ""),
        (None, "https://good.org/a", None),
    ]
    rules = [urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"), urls.Rule("allow", "com", "/")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()}
    verdicts = {i: (r.verdict, r.by) for i, r in got.items()}
    assert verdicts == {
        1: ("block", "alias"), 2: ("block", "alias"), 3: ("block", "alias"), 4: ("block", "alias"), 5: ("allow", "alias"),
        6: ("allow", "alias"), 7: ("allow", "default"), 8: ("allow", "default"), 9: ("block", "rule"), 10: ("allow", "default"),
        None: ("block", "alias"),
    }
    assert (got[9].host, got[9].path, got[9].rule) == ("all.net", "/es/", "net/es/")
    assert (got[7].host, got[8].path, got[2].path) == ("", "", "/a/")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(none, rules).count() == 0 and urls.judge(spark.createDataFrame(pages, none.schema), []).count() == len(pages)


BLOCKED = "https://bad.net/es/x"


LINKS = [
    (f'<!-- <link rel="canonical" href="{BLOCKED}"> -->', "allow"),
    (f'<!-- never closed <link rel="canonical" href="{BLOCKED}">', "allow"),
    (f'<script>var x = \'<link rel="canonical" href="{BLOCKED}">\'</script>', "allow"),
    (f'<style>/* <link rel=canonical href={BLOCKED}> */</style>', "allow"),
    (f"<!-- a --><link rel='alternate canonical' href='{BLOCKED}'>", "block"),
    (f'<link href="{BLOCKED}" rel="Canonical shortlink"/>', "block"),
    (f'<link rel="notcanonical" href="{BLOCKED}"><link rel="canonical-ish" href="{BLOCKED}">', "allow"),
    (f'<link rel="stylesheet" href="/s.css"><link rel=canonical href={BLOCKED}>', "block"),
    (f'<link rel="canonical" href=" {BLOCKED}#part ">', "block"),
    ('<link rel="canonical" href="?a=1&amp;b=2">', "block"),
    ('<link rel="canonical" href="../fr/./q/../q">', "block"),
    ('<link rel="canonical" href="../../../../fr/q">', "block"),
    ('<link rel="canonical" href="//bad.net/es/x">', "block"),
    ('<link rel="canonical" href="mailto:a@bad.net/es/x">', "allow"),
    ('<link rel="canonical" href="">', "allow"),
    ('<base href="https://bad.net/es/"><link rel="canonical" href="x">', "block"),
    ('<base href="/fr/deep/"><link rel="canonical" href="../q">', "block"),
    ("<meta http-equiv=refresh content='5; URL=\"https://bad.net/es/x\"'>", "block"),
    ('<meta http-equiv="refresh" content="3;url= ../fr/q ">', "block"),
    ("<link rel=canonical", "allow"),
]


def test_links_of_a_page(spark):
    """Each case on a site of its own, with two more pages that are aliases of a blocked one."""
    pages = []
    for i, (markup, _) in enumerate(LINKS):
        site = f"https://some{i}.org"
        pages += [(i, f"{site}/en/p.htm?x#y", markup), (1000 + i, f"{site}/fr/q", f'<link rel="canonical" href="{BLOCKED}{i}">')]
        pages += [(2000 + i, f"{site}/en/p.htm?a=1&b=2", f"<link rel='canonical' href='{BLOCKED}{i}'>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judge(frame, [urls.Rule("block", "net", "/es/")]).collect()}
    assert [(m, got[i]) for i, (m, _) in enumerate(LINKS)] == LINKS


# --- top-k


@pytest.mark.parametrize("shard", [7, 60, 1 << 13])
@pytest.mark.parametrize("large", [1.0, 1e6])
def test_top_k(spark, monkeypatch, shard, large):
    monkeypatch.setattr(topk, "SHARD", shard)
    r = np.random.default_rng(6)
    vectors = [(int(i), [float(x) for x in r.normal(size=6) * large]) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(40)] + [(50, vectors[3][1])]
    rest = [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, [1.0] * 6), (2050, []), (2100, [1.0, 2.0])]
    frame = spark.createDataFrame(vectors + rest, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(frame, F.col("id") % 50 == 0, k=5).collect()
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    want = []
    for a, (q, v) in enumerate(whole):
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for b, (i, w) in enumerate(whole) if b != a)
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_few_rows(spark):
    frame = spark.createDataFrame([(50, [1.0]), (51, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.exact_top_k(frame, F.col("id") % 50 == 0, k=5).collect()] == [(50, 1, 51, 256 * 512)]
    assert topk.exact_top_k(frame.where("false"), F.col("id") % 50 == 0, k=5).count() == 0


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_ball_tree(monkeypatch, leaf):
    """Deep trees, copies, and a shared k-th score from elsewhere."""
    monkeypatch.setattr(topk, "LEAF", leaf)
    r = np.random.default_rng(8)
    vectors = r.integers(-300, 300, (200, 5))
    vectors[50:90] = vectors[50]
    ids = r.permutation(200)
    tree = topk.BallTree(vectors, ids, np.arange(200))
    queries, own = vectors[[3, 50, 120]], np.array([3, 50, 500])
    for least in (-np.inf, 20_000.0):
        got = {p: list(zip(i.tolist(), s.tolist())) for p, i, s in tree.search(queries, own, np.full(3, least), 5)}
        for place in range(3):
            scores = sorted((-int(v @ queries[place]), int(ids[k])) for k, v in enumerate(vectors) if k != own[place])[:5]
            want = [(i, -s) for s, i in scores if -s >= least]
            assert [x for x in got.get(place, []) if x[1] >= least] == want
