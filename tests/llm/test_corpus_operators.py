"""Operators over the corpus: shards, lines, fingerprints, quality, Jaccard."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from coldtide.llm import components, imatch, jaccard, linededup, quality, sharding
from coldtide.session import scratch_path

DOCS = "doc_id long, text string, source string, _id string, _text string"


def docs_of(spark, rows):
    """Rows (id, text[, source]) with columns that clash with inner names."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "s", "x", "y") for r in rows], DOCS)


# Sharding


def test_shards_merge_and_keep_all_rows(spark):
    store = sharding.ShardStore(spark, scratch_path(spark, "test-shards"), target_bytes=40_000, fanout=3)
    df = spark.range(3000).selectExpr("id", "if(id % 7 = 0, null, repeat(cast(id as string), 3)) as text", "id % 2 as arrival")
    versions = store.append_many(df, F.col("id") % 5)
    assert [m.version for m in versions] == [1, 2, 3, 4, 5]
    store.append(df.limit(0))
    store.append(df.limit(10))
    before = store.manifest()
    after = store.compact()
    assert len(after.shards) < len(before.shards) and store.read().count() == 3010
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, df.union(df.limit(10)).collect()))
    tiers = Counter(store.tier(s.size) for s in after.shards)
    assert all(n < 3 for t, n in tiers.items() if t)
    assert store.read(5).count() == 3000 and store.vacuum() > 0 and store.read().count() == 3010


def test_a_version_has_one_author(spark):
    root = scratch_path(spark, "test-shards")
    a, b = sharding.ShardStore(spark, root), sharding.ShardStore(spark, root)
    assert a.read().count() == 0 and a.compact().version == 0
    first = a.append(spark.range(5).toDF("x"))
    with pytest.raises(sharding.Conflict):
        b._commit(sharding.Manifest(first.version, first.schema, ()))
    assert b.manifest() == first
    # A compaction whose shards another one replaced changes nothing.
    stale = [sharding.Shard("gone", 1, 0)]
    assert b._replace(stale, []) == first
    assert b.append(spark.range(3).toDF("x")).version == 2 and a.read().count() == 8
    # What a lost writer leaves is not read.
    spark.range(9).toDF("x").write.parquet(f"{root}/data/orphan")
    assert a.read().count() == 8 and a.vacuum() == 0 and a.vacuum(grace_s=-60) > 0 and a.read().count() == 8


def test_arrivals_of_other_columns(spark):
    store = sharding.ShardStore(spark, scratch_path(spark, "test-shards"), target_bytes=1 << 20, fanout=2)
    store.append(spark.range(3).selectExpr("id", "'a' as text"))
    store.append(spark.range(3, 5).selectExpr("id", "'b' as text", "id * 2 as added"))
    store.append(spark.range(5, 6).selectExpr("id"))
    with pytest.raises(ValueError, match="column text"):
        store.append(spark.range(2).selectExpr("id", "id as text"))
    want = [(0, "a", None), (1, "a", None), (2, "a", None), (3, "b", 6), (4, "b", 8), (5, None, None)]
    for change in (lambda: None, store.compact, store.vacuum):
        change()
        assert sorted(map(tuple, store.read().collect())) == want
    assert store.read().columns == ["id", "text", "added"] and not store.manifest().retired
    # Nothing was published, and nothing is left, of the rejected arrival.
    assert store.vacuum(grace_s=-60) == 0


def test_vacuum_spares_an_arrival_not_published_yet(spark, monkeypatch):
    store = sharding.ShardStore(spark, scratch_path(spark, "test-shards"))
    publish = store._publish
    monkeypatch.setattr(store, "_publish", lambda *a: (store.vacuum(), publish(*a))[1])
    store.append(spark.range(7).toDF("x"))
    assert store.read().count() == 7
    monkeypatch.setattr(store, "_publish", lambda *a: (store.vacuum(grace_s=-60), publish(*a))[1])
    with pytest.raises(FileNotFoundError):
        store.append(spark.range(7).toDF("x"))
    assert store.read().count() == 7


# Lines


def brute_lines(rows, hashes, least):
    seen = set()
    for d, t in rows:
        for p, line in enumerate((t or "").lower().split("\n")):
            w = re.split(r"[\x20\x09-\x0D]+", line)
            w = tuple(x for x in w if x)
            if w:
                seen.add(((d is None, d or 0, hashes[d, t], p), w))
    seen = sorted(seen)

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) < least:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for i, (k, w) in enumerate(seen):
        if any(w == v for _, v in seen[:i]):
            out.setdefault(k[:3], ([], []))[0].append(k[3])
        elif any(near(w, v) for _, v in seen[:i]):
            out.setdefault(k[:3], ([], []))[1].append(k[3])
    return out


@pytest.mark.parametrize("seed,least", [(1, 5), (2, 5), (3, 1)])
def test_line_dedup_against_brute_force(spark, seed, least):
    rng = random.Random(seed)
    rows = [(i, "\n".join(" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(0, 5)))) for i in range(90)]
    rows += [(None, "a b c d a\nx"), (3, None), (3, ""), (5, "a b c d a b"), (5, "a b c d a b"), (500, "a " * 3000 + "\n" + "a " * 3001 + "\n\nA  a\ta a a")]
    df = docs_of(spark, rows)
    got = Counter((r.doc_id, r.n_lines, tuple(r.equal_lines), tuple(r.near_lines)) for r in linededup.report(df, near_words=least).collect())
    hashes = {(r.doc_id, r.text): r.t for r in df.select("doc_id", "text", F.xxhash64("text").alias("t")).collect()}
    found = brute_lines(rows, hashes, least)
    want = Counter()
    for d, t in rows:
        a, b = found.get((d is None, d or 0, hashes[d, t]), ([], []))
        want[d, 0 if t is None else t.count("\n") + 1, tuple(a), tuple(b)] += 1
    assert got == want
    cleaned = linededup.apply(df, near_words=least)
    assert cleaned.columns == df.columns
    # Nothing is left to remove of equal lines.
    assert linededup.report(cleaned, near_words=least).where("size(equal_lines) > 0").count() == 0


def test_line_dedup_of_nothing(spark):
    empty = docs_of(spark, [(1, "x")]).limit(0)
    assert linededup.report(empty).count() == 0 and linededup.apply(empty).count() == 0


def test_within_one():
    for a, b, want in (("a b", "a b", True), ("a b", "a c", True), ("a b", "b", True), ("a b", "x a b", True), ("a b", "b a", False), ("a b c", "a", False), ("a", "b", True)):
        assert linededup.within_one(a.split(), b.split()) is want


# Fingerprints


def test_next_text_in_descending_order(spark):
    rng = random.Random(4)
    ids = rng.sample(range(10**6), 60) + [None, 5, 5]
    rows = [(i, f"text {i} {n}") for n, i in enumerate(ids)]
    got = imatch.with_next(docs_of(spark, rows), buckets=7).where("not _copy").collect()
    order = {t: n for n, (_, t) in enumerate(sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0))))}
    assert len(got) == len(rows)
    for r in got:
        if r._id not in (5, None) and order[r._text] + 1 < len(rows) and rows and order[r._text] < len(rows) - 4:
            assert order[r._next] == order[r._text] + 1
    last = next(r for r in got if r._id is None)
    assert order[last._next] == 0
    assert [r._next for r in imatch.with_next(docs_of(spark, [(7, "alone")])).where("not _copy").collect()] == ["alone"]
    assert imatch.with_next(docs_of(spark, [(7, "alone")]).limit(0)).count() == 0


def test_fingerprints(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(200, texts[0]), (201, None), (202, ""), (203, "unseen"), (204, " ".join(texts[1].split()[:110]))]
    df = docs_of(spark, rows)
    words = imatch.lexicon(df, max_share=0.9)
    keyed = df.select("doc_id", F.coalesce("text", F.lit("")).alias("own"))
    out = imatch.fingerprints(keyed, ["doc_id"], ["own"], words, [])
    got = {r.doc_id: r.own_fingerprint for r in out.collect()}
    assert len(got) == len(rows) and got[0] == got[200] and got[201] == got[202] and got[201] != got[203]
    by_shuffle = {r.doc_id: r.own_fingerprint for r in imatch.fingerprints(keyed, ["doc_id"], ["own"], words, [], most=-1).collect()}
    assert by_shuffle == got
    pairs = [(0, 200), (1, 204), (2, 3), (201, 202), (201, 203), (0, 201)]
    like = [r[0] for r in spark.createDataFrame([(got[a], got[b]) for a, b in pairs], "a string, b string").select(imatch.likeness(F.col("a"), F.col("b"))).collect()]
    assert like[0] == 1 and like[1] > 0.6 and like[2] < 0.45 and like[3] == 1 and like[4] == 0 and 0 <= like[5] < 0.2


def brute_fingerprint(text, lexicon):
    """The fingerprint by a second implementation of its hashes."""
    import xxhash

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def folded(parts):
        seed = 42
        for raw in parts:
            seed = xxhash.xxh64_intdigest(raw, seed)
        return seed

    eight, four = (lambda x, n=n: (x % (1 << 8 * n)).to_bytes(n, "little") for n in (8, 4))
    plain = "".join(" " if c in imatch.STOPS else c for c in (text or "").lower())
    found = sorted({signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.split(r"[\x20\x09-\x0D]+", plain) if w})
    kept = [x for x in found if x in lexicon]
    whole = hashlib.sha256(",".join(map(str, kept)).encode()).hexdigest()[:16] if kept else f"{folded(map(eight, found)):016x}"
    out = f"{len(kept):08x}{whole}"
    for level, rate in enumerate(imatch.RATES):
        slot = {x: signed(folded([eight(x), four(level)])) % rate for x in kept}
        for k in range(imatch.PER_RATE):
            out += f"{folded(eight(x) for x in kept if slot[x] == k) & 0xFFFF:04x}"
    return out


def test_fingerprints_against_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"W{i}" for i in range(300)] + ["é", "漢字", "a.b", "(x)"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 150))) for _ in range(120)] + [None, "", "unseen words", "W1 w1\tW1\x0bw2", "w7 " * 60_000]
    df = docs_of(spark, list(enumerate(texts)))
    words = imatch.lexicon(df, min_share=0.05, max_share=0.6)
    held = {r[0] for r in words.collect()}
    counts = Counter(w for t in texts for w in {x for x in re.split(r"[\x20\x09-\x0D.,;:!?\"()|]+", (t or "").lower()) if x})
    assert len(held) == sum(0.05 * len(texts) <= n <= 0.6 * len(texts) for n in counts.values()) > 50
    out = imatch.fingerprints(df.select("doc_id", F.coalesce("text", F.lit("")).alias("own")), ["doc_id"], ["own"], words, [])
    got = {r.doc_id: r.own_fingerprint for r in out.collect()}
    assert got == {i: brute_fingerprint(t, held) for i, t in enumerate(texts)}


def test_fingerprint_query(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in imatch.op3(spark, d).collect()}
    rows = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    assert len(got) == len(rows)
    for n, (i, text) in enumerate(rows):
        after, k = rows[(n + 1) % len(rows)][1], len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.9 * len(got)


# Quality


def brute_quality(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    held = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(held)


def test_quality_measures(spark):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "a b c", "a b c a b c", "é\x0b漢 #$%\x0c<x>\n\nx\nx\n x", "w " * 20000, "a a a a"] + [" ".join(rng.choice(["a", "b", "c\n", "d"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = docs_of(spark, [(i, t) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in quality.verdicts(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        n, chars, symbols, dup, rep = brute_quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)


def test_boilerplate(spark):
    rng = random.Random(7)
    body = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    notice = " ".join(f"notice{i}" for i in range(80))
    rows = [(i, f"{body()}\n  {notice.upper()} ", "host") for i in range(30)]
    rows += [(100 + i, f"{body()}\n{notice}", None) for i in range(4)]
    short = " ".join(f"s{i}" for i in range(12))
    rows += [(300 + i, f"{' '.join(body().split()[: 47 + i])}\n{short}", "small") for i in range(5)]
    copied = body()
    rows += [(200 + i, copied, "host") for i in range(60)] + [(None, copied, "host"), (200, copied, "host")]
    df = docs_of(spark, rows)
    got = Counter((r.doc_id, r.kept, r.lost_words) for r in quality.verdicts(df).collect())
    assert got[0, True, 0] == 1 and all(got[i, False, 80] == 1 for i in range(1, 30)) and all(got[100 + i, True, 0] == 1 for i in range(4))
    # Without the short line, fewer than 50 words are left of three of them.
    assert got[300, True, 0] == 1 and [got[300 + i, kept, 12] for i, kept in ((1, False), (2, False), (3, True), (4, True))] == [1] * 4
    assert got[200, True, 0] == 2 and got[None, True, 0] == 1 and sum(got.values()) == len(rows)
    loose = quality.apply(df, limits=quality.Limits(min_left=0.1))
    assert loose.columns == df.columns and loose.count() == len(rows) - 2
    assert loose.where("doc_id = 5").first().text == rows[5][1].split("\n")[0] and loose.where("doc_id = 0").first().text == rows[0][1]
    assert quality.apply(df).where("doc_id between 1 and 29").count() == 0
    empty = df.limit(0)
    assert quality.verdicts(empty).count() == 0 and quality.apply(empty).count() == 0


# Jaccard


def brute_classes(rows, k, percent):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(jaccard.ASCII_LOWER)) if x]
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("seed,like", [(1, jaccard.Similarity()), (2, jaccard.Similarity(5, 80))])
def test_jaccard_against_brute_force(spark, seed, like):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for g in range(28):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 20, 60, 150, 400]))] + (passage if g % 3 == 0 else [])
        for c in range(rng.randint(1, 8)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 40))):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((3 * len(rows), "  ".join(t).upper() if c % 3 == 0 else "\n".join(t)))
    rows += [(5, None), (7, ""), (8, " \t"), (9, "one two"), (10, "one two"), (11, "ONE TWO"), (None, "one two"), (9, "one two"), (None, None), (12, "É x"), (13, "é x")]
    rng.shuffle(rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(docs_of(spark, rows), like).collect())
    assert got == brute_classes(rows, like.words, like.percent)


def test_jaccard_keeps_one_of_each_group(spark):
    df = docs_of(spark, [(3, "a b c d e f g"), (2, "a b c d e f g"), (9, "x y z"), (1, None), (4, None), (None, "X y z"), (None, "alone"), (9, "X Y Z")])
    kept = jaccard.apply(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0, (r.text or "").lower()) for r in kept.collect()) == [(0, "alone"), (1, ""), (2, "a b c d e f g"), (4, ""), (9, "x y z")]
    assert jaccard.classes(df.limit(0)).count() == 0 and jaccard.apply(df.limit(0)).count() == 0


def test_jaccard_beyond_the_key_filter(spark, monkeypatch):
    """With more keys than a filter may hold, joins by the keys take its place."""
    made = jaccard.KeyFilter.of
    monkeypatch.setattr(jaccard.KeyFilter, "of", lambda keys, name: made(keys, name, most=-1))
    test_jaccard_against_brute_force(spark, 3, jaccard.Similarity())


def test_jaccard_of_a_very_long_text(spark):
    long = " ".join(f"w{i % 7919}x{i % 104729}" for i in range(300_000))
    rows = [(1, long), (2, long + " more"), (3, long[: len(long) // 2]), (4, "short one")]
    assert {r.doc_id: r.component_id for r in jaccard.classes(docs_of(spark, rows)).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}

def star(rng, size, changes, words=200):
    """Texts that each replace as many distinct words of one unseen base."""
    base = [f"b{i}" for i in range(words)]
    for c in range(size):
        t = list(base)
        for at in rng.sample(range(0, words, 4), changes):
            t[at] = f"n{c}x{at}"
        yield " ".join(t)


@pytest.mark.parametrize("changes", [1, 2, 3])
def test_jaccard_in_large_clusters(spark, changes):
    """2,000 copies that replace 1 to 3 words of an absent base each: by how many
    of these places they share, two of them are alike to 0.78, 0.82, 0.8498
    (three words changed), 0.8498 and 0.89 (two), 0.92 and 0.96 (one)."""
    rows = [(i, t) for i, t in enumerate(star(random.Random(changes), 2000, changes))] + [(5000, "b0 " * 400)]
    got = {r.doc_id: r.component_id for r in jaccard.classes(docs_of(spark, rows).repartition(4)).collect()}
    held = [set(zip(*(t.split()[k:] for k in range(4)))) for _, t in rows[:-1]]
    column = {x: n for n, x in enumerate(sorted(set().union(*held)))}
    there = np.zeros((2000, len(column)), np.float32)
    for i, grams in enumerate(held):
        there[i, [column[x] for x in grams]] = 1
    same = there @ there.T
    links = 100 * same >= 85 * (2 * 197 - same)
    least = np.arange(2000)
    while (better := np.where(links, least[None, :], 2000).min(1)).tolist() != least.tolist():
        least = better
    assert got == {**{i: int(x) for i, x in enumerate(least)}, 5000: 5000}


def test_size_groups_cover_every_partner():
    for like in (jaccard.Similarity(), jaccard.Similarity(5, 80)):
        for n in range(1, 700):
            assert n <= jaccard.group_top(jaccard.size_group(n)) and (jaccard.size_group(n) == 0 or n > jaccard.group_top(jaccard.size_group(n) - 1))
            for m in range(n, 100 * n // like.percent + 1):
                assert set(like.groups(n)) & set(like.groups(m)), (n, m)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 120)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 120)}, 300: 300, 301: 300}
