"""Fingerprints, resampling and the manifest against brute force, with nulls, ties, repeated rows, long texts and empty tables."""

import base64
import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logspark.llm import merkle, radix, resample, syncmers

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    words = ["alpha", "Beta", "gamma", "été", "日本", "x1", "the", "of", "MIT", "über"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 120)))) for i in range(60)]
    return [*rows, (100, None), (101, ""), (102, "a"), (103, "ab" * 4000), (104, rows[0][1]), (105, "😀é" * 30), rows[7], rows[7], (7, "another text of the same id"), (None, "without id"), (-5, "negative id " * 9)]


# ---- fingerprints -----------------------------------------------------------------------------------------------------------
def brute_anchors(text, k, s):
    """Places whose k-mer has its leftmost least inner s-mer at an edge."""
    if not text:
        return []
    if len(text) <= k:
        return [0]
    points = np.array([ord(c) for c in text], np.uint64)
    small = syncmers._hashes(points, slice(len(text) - s + 1), s).tolist()
    inner = k - s + 1
    return [i for i in range(len(text) - k + 1) if (part := small[i : i + inner]).index(min(part)) in (0, inner - 1)]


@pytest.mark.parametrize(("k", "s"), [(24, 5), (16, 4), (8, 3), (5, 5)])
def test_anchors_are_closed_syncmers(texts, k, s):
    for _, t in texts:
        places, hashes = syncmers.anchors((t or "")[:2000], k, s)
        assert places.tolist() == brute_anchors((t or "")[:2000], k, s)
        assert (syncmers.read_as(syncmers.written_as(hashes)) == hashes).all()


def test_anchors_do_not_depend_on_context():
    r = random.Random(1)
    passage = "".join(r.choices("abcdefgh ", k=300))
    alone = dict(zip(*(x.tolist() for x in syncmers.anchors(passage)), strict=True))
    for before in ("", "x", "other words in front of it, "):
        places, hashes = syncmers.anchors(before + passage + " and behind")
        inside = {p - len(before): h for p, h in zip(places.tolist(), hashes.tolist(), strict=True) if len(before) <= p <= len(before) + len(passage) - syncmers.K}
        assert inside == alone
    gaps = np.diff(sorted(alone))
    assert gaps.max() <= syncmers.K - syncmers.S + 1  # no gap is longer than the window


def brute_chain(a, b):
    """Longest common chain where the n-th occurrence meets the n-th one."""
    seen = collections.Counter()
    of_b = {}
    for i, x in enumerate(b):
        of_b[x, seen[x]] = i
        seen[x] += 1
    seen.clear()
    places = []
    for x in a:
        if (x, seen[x]) in of_b:
            places.append(of_b[x, seen[x]])
        seen[x] += 1
    best = [1] * len(places)
    for i in range(len(places)):
        best[i] = 1 + max([best[j] for j in range(i) if places[j] < places[i]], default=0)
    return max(best, default=0)


def test_likeness_against_brute_force():
    r = random.Random(2)
    for _ in range(400):
        a, b = ([r.randint(0, 12) for _ in range(r.randint(0, 25))] for _ in range(2))
        want = 1.0 if a == b else 2 * brute_chain(a, b) / (len(a) + len(b)) if a and b else 0.0
        assert syncmers.likeness(np.array(a, np.uint32), np.array(b, np.uint32)) == want
    x = syncmers.anchors("one passage that is long enough to hold anchors, some of them at least " * 3)[1]
    assert syncmers.likeness(x, x) == 1.0
    began = time.process_time()
    syncmers.likeness(np.arange(400_000, dtype=np.uint32), np.random.default_rng(1).permutation(400_000).astype(np.uint32))
    syncmers.anchors("a" * 3_000_000)
    assert time.process_time() - began < 15


@pytest.mark.parametrize("ranges", [1, 40])
def test_compare_edited(frame, texts, monkeypatch, ranges):
    monkeypatch.setattr(syncmers, "RANGES", ranges)
    got = syncmers.compare_edited(frame(texts)).collect()
    spark = frame([]).sparkSession
    hashes = {r.text: r.h for r in spark.createDataFrame([(t or "",) for _, t in texts], "text string").select("text", F.xxhash64("text").alias("h")).collect()}
    rows = sorted(((i, t or "") for i, t in texts), key=lambda x: (x[0] is not None, x[0] or 0, hashes[x[1]]))
    want = collections.Counter()
    for n, (i, t) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = (syncmers.anchors(x)[1] for x in (t, edited, following))
        want[i, len(t), sha(edited), base64.b64encode(a.tobytes()).decode(), base64.b64encode(b.tobytes()).decode(), syncmers.likeness(a, b), syncmers.likeness(a, c)] += 1
    assert collections.Counter(tuple(r)[:7] for r in got) == want
    by = collections.defaultdict(set)
    for r in syncmers.fingerprints(frame(texts)).collect():
        by[r.n_chars, r.fingerprint].add(r.doc_id)
    assert {0, 104} <= next(v for v in by.values() if 0 in v)
    assert syncmers.compare_edited(frame([])).count() == 0
    lone = syncmers.compare_edited(frame([(3, "just one document of a few words, no more than that")])).collect()
    assert [(r.near_next, 0 < r.near_edited <= 1) for r in lone] == [(1.0, True)]


def test_anchor_places_and_likeness_columns(frame):
    docs = frame([(1, "a passage of some length that two of the documents share, word for word"), (2, "x. a passage of some length that two of the documents share, word for word"), (3, None)])
    held = syncmers.anchor_places(docs)
    one, two = (held.where(F.col("doc_id") == i).select("anchor", F.col("place").alias(f"p{i}")) for i in (1, 2))
    shifts = {r.p2 - r.p1 for r in one.join(two, "anchor").collect()}
    assert shifts == {3}
    prints = syncmers.fingerprints(docs).select("doc_id", "fingerprint")
    both = prints.alias("a").join(prints.select(F.col("doc_id").alias("other"), F.col("fingerprint").alias("b")), F.col("doc_id") < F.col("other"))
    got = {(r.doc_id, r.other): r.likeness for r in syncmers.likenesses(both, "fingerprint", "b").collect()}
    assert got[1, 2] > 0.8
    assert got[1, 3] == got[2, 3] == 0.0


# ---- resampling -------------------------------------------------------------------------------------------------------------
def brute_resample(rows, target, percent=10, runs=1, buckets=10_000, least=20):
    def features(t):
        w = ALNUM.findall(low(t))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, runs + 1) for i in range(len(w) - k + 1)]

    s, t = (collections.Counter(b for x in texts for b in features(x)[1]) for texts in ([x for _, x in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, x in rows:
        n, f = features(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in f)
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    open_ = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = collections.Counter()
    ranks = {}
    for at, r in enumerate(open_[: percent * len(open_) // 100]):
        ranks.setdefault(r, []).append(at + 1)
        rank[r] += 1
    got = []
    for r in out:
        mine = ranks.get(r, []) if r[1] >= least else []
        got.append((r[0], *r[2:], mine.pop(0) if mine else None))
    return collections.Counter(got)


@pytest.mark.parametrize(("percent", "runs", "buckets"), [(10, 1, 10_000), (60, 2, 97)])
def test_resample(frame, texts, percent, runs, buckets):
    rows = [r for r in texts if r != (7, "another text of the same id")]
    target = ["alpha the of alpha x1", None, "", "the été"]
    bench = frame([(i, t) for i, t in enumerate(target)])
    got = resample.resample(frame(rows), bench, percent, runs=runs, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collections.Counter(map(tuple, got.collect())) == brute_resample(rows, target, percent, runs, buckets)
    assert resample.resample(frame([]), bench).count() == 0
    assert resample.resample(frame(rows), frame([])).count() == len(rows)
    kept = resample.drop_undrawn(frame(rows), bench, percent, runs=runs, buckets=buckets)
    assert kept.columns == frame([]).columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got.where("rank is not null").collect()}


def test_resample_prefers_the_target(frame):
    r = random.Random(4)
    rows = [(i, " ".join(r.choices(["law", "court", "judge"] if i % 10 == 0 else ["cat", "dog", "bird", "law"], k=200))) for i in range(300)]
    got = resample.resample(frame(rows), frame([(0, "law court judge court")])).where("rank is not null").collect()
    assert len(got) == 30
    assert all(x.doc_id % 10 == 0 for x in got)


@pytest.mark.parametrize("bits", [3, 11])
def test_radix_places(spark, monkeypatch, bits):
    monkeypatch.setattr(radix, "LEAST", 8)
    monkeypatch.setattr(radix, "BLOCKS", 16)
    r = random.Random(9)
    rows = [(r.choice([-(1 << 62), -7, 0, 3, 3, 3, 1 << 62]) if n % 5 else r.randint(-50, 50), r.randint(0, 40), n) for n in range(300)]
    df = spark.createDataFrame(rows, "a long, b long, n long").repartition(5)
    got = radix.radix_places(df, [("a", True), ("b", False), ("n", False)], bits).orderBy("place").collect()
    assert [x.place for x in got] == list(range(300))
    assert [tuple(x)[:3] for x in got] == sorted(rows, key=lambda x: (-x[0], x[1], x[2]))
    wide = spark.createDataFrame([(x,) for x in (-(1 << 63), (1 << 63) - 1, 0, -1, 5)], "a long")
    for down in (False, True):
        assert [x.a for x in radix.radix_places(wide, [("a", down)], 16).orderBy("place").collect()] == sorted((-(1 << 63), (1 << 63) - 1, 0, -1, 5), reverse=down)
    assert radix.radix_places(df.limit(0), [("a", True)]).count() == 0


def test_radix_passes_are_stable(spark):
    """Rows that tie keep the order of the pass before: sorted by b, then by a, is sorted by (a, b)."""
    df = spark.range(5000).select((F.col("id") * 7919 % 13).alias("a"), (F.col("id") * 104729 % 5003).alias("b"))
    got = [tuple(r)[:2] for r in radix.radix_places(df, [("a", False), ("b", False)]).orderBy("place").collect()]
    assert got == sorted(got)


# ---- manifest -----------------------------------------------------------------------------------------------------------------
def brute_tree(leaves, fanout):
    """Levels of a tree, bottom up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([sha("".join(at[i : i + fanout])) for i in range(0, len(at), fanout)])
    return levels


def brute_path(levels, i, fanout):
    out = []
    for at in levels[:-1]:
        first = i // fanout * fanout
        out.append(("".join(at[first:i]), "".join(at[i + 1 : first + fanout])))
        i //= fanout
    return out


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows, fanout):
    leaf = lambda r, more=0: sha("".join(map(field, (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]))))
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [brute_tree([leaf(r) for r in groups[g]], fanout) for g in names]
    top = brute_tree([t[-1][0] for t in trees], fanout)
    out = collections.Counter()
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            path = brute_path(trees[k], i, fanout) + brute_path(top, k, fanout)
            at = leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf(r)
            for left, right in path:
                at = sha(left + at + right)
            out[r[0], leaf(r), trees[k][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), at, at == top[-1][0]] += 1
    return out


DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int"


@pytest.mark.parametrize(("n", "fanout"), [(1, 2), (2, 2), (3, 2), (9, 2), (70, 2), (150, 2), (70, 3), (40, 5), (40, 20)])
def test_manifest(spark, n, fanout):
    r = random.Random(n * fanout)
    rows = [(i, r.choice(["", "text é", None, "日本 " * 50]), r.choice(["en", "en", "en", "é", None, "", "EN"]), r.choice(["web", None]), r.choice([None, 0, 12])) for i in range(n)]
    if n > 3:
        rows += [rows[1], rows[1], (rows[2][0], "same id", rows[2][2], None, 1), (None, "no id", "en", None, 3), (-4, "x" * 200_000, "en", "web", 5)]
    df = spark.createDataFrame([(*x, "a", 1) for x in rows], DOCS)
    got = merkle.verify_documents(df, fanout).collect()
    assert collections.Counter(map(tuple, got)) == brute_manifest(rows, fanout)


def test_manifest_of_nothing_and_many_groups(spark):
    assert merkle.verify_documents(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(i, "t", f"lang{i}", None, i) for i in range(40)]
    got = merkle.verify_documents(spark.createDataFrame([(*x, "a", 1) for x in rows], DOCS)).collect()
    assert collections.Counter(map(tuple, got)) == brute_manifest(rows, 2)
    assert {r.leaf == r.subroot for r in got} == {True}
    with pytest.raises(ValueError):
        merkle.climb(spark.createDataFrame([], DOCS), [], 1)


def test_manifest_is_whole_and_finds_any_change(spark):
    """A changed row is found by its proof; the root changes with any row."""
    rows = [(i, f"text {i}", "en" if i % 3 else "de", "web", 5) for i in range(30)]
    df = spark.createDataFrame([(*x, "a", 1) for x in rows], DOCS)
    columns = ["doc_id", "text", "lang"]
    sound = merkle.prove(df, columns, "lang", "doc_id").collect()
    assert all(r.verified for r in sound)
    bad = merkle.prove(df, columns, "lang", "doc_id", tampered={"text": F.lit("changed")}, where=F.col("doc_id") == 11).collect()
    assert [r.id for r in bad if not r.verified] == [11]
    assert len({r.root for r in bad} | {r.root for r in sound}) == 1
    other = merkle.prove(df.withColumn("text", F.when(F.col("doc_id") == 29, "new").otherwise(F.col("text"))), columns, "lang", "doc_id").head()
    assert other.root != sound[0].root
