"""Removal of word passages that stand earlier in the corpus.

A window is SIZE consecutive words; a word goes if a window over it has the same words as one that starts earlier
(smaller id, or the same document and an earlier place). Windows are judged on the input.

0. A first pass counts windows by their least part, in 2^18 groups of parts, combined in each task. The number of shards
   follows from the total. Windows of a group with more than HOT are spread over all shards by their full hash, each on
   its own, so a part that stands among many different neighbours fills no single shard. Counts choose the way of a
   window only: they may be too high (repeated windows are counted), never change a result.
1. One pass over the texts. To keep the shuffle small, inside a slice of a task's documents windows of one hash are compared word by word, as runs
   of neighbours; all but the earliest of equal ones are removed at once, so a passage that a third of all documents
   share is shuffled once for each slice and not once for each document. A window's shard comes from the least hash of its
   GRAM-word parts; most of its neighbours share it, so windows travel as runs: a symbol of 8 bits for each word, and 16
   bits of each window's hash. Equal windows have equal least parts, so each has to be looked for in one shard only.
2. In a shard, runs whose least part no other run has are done: none of their windows is anywhere else. Over all others a
   compressed FM-index is built (a wavelet matrix over the BWT), and
   backward search streams the windows through it: a window whose matching statistic reaches SIZE with two places or more
   shares its suffix interval with its copies. Those that share their 16 bits, too, are candidates; nothing is removed yet.
3. Candidates, packed by document, are joined to the texts, and each gets a 128-bit digest of its very words. In a batch,
   and then in buckets by digest, all but the earliest window of a digest are removed.
4. Removed windows, packed by document, come together, are joined to the texts as ranges of words and cut.

Symbols and hashes only find candidates. Windows are taken for equal if their words are (1) or their BLAKE2b digests (3).

Edge cases: null, empty and blank texts have no words, and fewer than SIZE words no window; of repeated rows with one
id and one text none is earlier than the other, both get the same result; a null id counts as the smallest; an empty
table gives an empty result. Columns other than id and text are ignored. White space between kept words becomes one blank.

Scale: a join to the texts broadcasts ranges of at most BROADCAST_BYTES and shuffles beyond. No group is larger than its
bound on average: slices, shards and buckets follow from the counts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logspark.llm.common import arrow_schema, hash_words, id_text, mix, word_bounds, word_hashes
from logspark.llm.fmindex import FmIndex
from logspark.llm.tables import written

SIZE = 20
GRAM = 4
#: Text and rows of a slice.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 2048
#: Rows, and bytes of their ranges, that a join may broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 250_000, 32 << 20
#: Places of documents: windows to remove, or with runs, tags, words and checks those to search, or with checks alone those to compare.
PACKED = "shard int, docs binary, keys binary, cuts binary, steps binary, runs binary, tags binary, words binary, checks binary"
#: Windows of a shard, on average, and of a group of least parts that stay together; found places of a bucket of documents.
SHARD_WINDOWS, HOT, BUCKET_PLACES = 1_000_000, 250_000, 4_000_000
#: Digests in a bucket, on average, and in a batch of a task; bytes of one.
BUCKET_DIGESTS, BATCH_DIGESTS, DIGEST = 1_000_000, 250_000, 16  # two 64-bit numbers
#: Groups of least parts are told apart by this many bits.
GROUP_BITS = 18
NULL_ID = -(1 << 63)


def window_hashes(words: np.ndarray, size: int, lane: int) -> np.ndarray:
    """Hash of each window that starts at words[i], by doubling; lane tells independent hashes apart."""
    salt = mix(np.array([lane + 1], np.uint64))
    parts, h, width = [], mix(words ^ salt), 1
    while True:
        if size & width:
            parts.append((width, h))
        if 2 * width > size:
            break
        h = mix(h[: len(h) - width] * np.uint64(0x9E3779B97F4A7C15) + h[width:] + salt)
        width *= 2
    n, at = len(words) - size + 1, 0
    out = np.zeros(n, np.uint64)
    for width, h in reversed(parts):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[at : at + n] + np.uint64(width))
        at += width
    return out


def least_grams(words: np.ndarray, size: int) -> np.ndarray:
    """For each window the least hash of its GRAM-word parts: sliding minima by doubling."""
    gram = min(GRAM, size)
    low, width, n = window_hashes(words, gram, 2), 1, size - gram + 1
    while 2 * width <= n:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    return np.minimum(low[: len(low) - (n - width)], low[n - width :]) if n > width else low


def _slices(batches):
    """Lists of (id, key, words joined by blanks) of bounded size."""
    held, size = [], 0
    for b in batches:
        for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.large_binary()).to_pylist(), strict=True):
            held.append((NULL_ID if i is None else i, k, b" ".join((t or b"").split())))
            size += len(held[-1][2])
            if size >= SLICE_BYTES or len(held) >= SLICE_ROWS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _pack(shard: int, docs: np.ndarray, keys: np.ndarray, counts: np.ndarray, at: np.ndarray, **more: bytes) -> dict:
    """A row: ids and keys of documents, the number of places of each, the places as steps, and more."""
    steps = np.diff(at, prepend=0).astype(np.int32)
    steps[np.cumsum(counts)[:-1]] = at[np.cumsum(counts)[:-1]]  # each document's first place stands for itself
    return {"shard": shard, "docs": docs.tobytes(), "keys": keys.tobytes(), "cuts": counts.astype(np.int32).tobytes(), "steps": steps.tobytes(), **more}


def _unpack(row: dict) -> tuple[np.ndarray, ...]:
    """(id, key, place) for each place."""
    counts, steps = np.frombuffer(row["cuts"], np.int32), np.frombuffer(row["steps"], np.int32).astype(np.int64)
    first = np.cumsum(counts) - counts
    total = np.cumsum(steps)
    base = total[first] - steps[first]
    places = total - np.repeat(base, counts)
    return np.repeat(np.frombuffer(row["docs"], np.int64), counts), np.repeat(np.frombuffer(row["keys"], np.int64), counts), places


def _groups(least: np.ndarray) -> np.ndarray:
    """The group of each least part."""
    return (mix(least) >> np.uint64(64 - GROUP_BITS)).astype(np.int64)


def _counted(size: int):
    """(part, n) rows: the windows of each group of least parts in a task."""

    def run(batches):
        total = np.zeros(1 << GROUP_BITS, np.int64)
        for b in batches:
            for t in b.column(0).cast(pa.large_binary()):
                words = word_hashes(t.as_py() or b"")
                if len(words) >= size:
                    np.add.at(total, _groups(least_grams(words, size)), 1)
        held = np.flatnonzero(total)
        for at in range(0, len(held), 1 << 16):
            part = held[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["part", "n"])

    return run


def count_windows(df: DataFrame, size: int = SIZE) -> tuple[int, np.ndarray]:
    """The number of windows of (text) rows, and the groups of least parts with more than HOT of them (total / HOT at most)."""
    counts = df.select("text").mapInArrow(_counted(size), "part int, n long").groupBy("part").agg(F.sum("n").alias("n"))
    total, hot, more = counts.agg(F.sum("n"), F.collect_list(F.when(F.col("n") > HOT, F.col("part"))), F.sum(F.when(F.col("n") > HOT, F.col("n")))).head()
    # A window that travels on its own brings all its words: it weighs as much as seven in a run.
    return (total or 0) + 6 * (more or 0), np.array(sorted(hot), np.int64)


def _equal(blob: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, other: np.ndarray, size: int) -> np.ndarray:
    """Whether the words of the windows at these word numbers are those of the other ones: by runs of neighbours, then one by one."""
    out = np.ones(len(at), bool)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (other[1:] != other[:-1] + 1), [True]))) if len(at) else np.zeros(1, int)
    same = lambda x, y, n: blob[starts[x] : ends[x + n + size - 2]] == blob[starts[y] : ends[y + n + size - 2]]
    for a, b in zip(new[:-1].tolist(), new[1:].tolist(), strict=True):
        if not same(at[a], other[a], b - a):
            out[a:b] = [same(at[k], other[k], 1) for k in range(a, b)]
    return out


def _hashed(shards: int, size: int, hot: np.ndarray):
    types = None

    def run(batches):
        for rows in _slices(batches):
            rows = sorted((r for r in rows if r[2].count(b" ") >= size - 1), key=lambda r: (r[0], r[1]))
            if not rows:
                continue
            n = np.array([r[2].count(b" ") + 1 for r in rows])
            blob = b" ".join([r[2] for r in rows])
            first_byte, last_byte = word_bounds(blob)
            joined = hash_words(blob, first_byte, last_byte)
            starts = np.cumsum(n) - n
            held = n - size + 1
            doc = np.repeat(np.arange(len(rows)), held)
            place = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
            index = place + starts[doc]
            high = window_hashes(joined, size, 0)[index]
            ids, keys = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
            order = np.argsort(high, kind="stable")  # earlier windows first
            h = high[order]
            same = np.concatenate(([False], h[1:] == h[:-1]))
            lead = np.empty(len(order), np.int64)
            lead[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            again = np.sort(order[same])
            equal = _equal(blob, first_byte, last_byte, index[again], index[lead[again]], size)
            firsts: dict[bytes, int] = {}
            for w in again[~equal].tolist():  # of one hash with the first, but other words
                lead[w] = firsts.setdefault(blob[first_byte[index[w]] : last_byte[index[w] + size - 1]], w)
            again = again[lead[again] != again]
            twin = (ids[doc[again]] == ids[doc[lead[again]]]) & (place[again] == place[lead[again]])  # a repeated row
            gone = again[~twin]
            left = np.ones(len(order), bool)
            left[gone] = False
            yield from _found(gone, doc, place, ids, keys, shards)
            yield from _runs(np.flatnonzero(left), least_grams(joined, size)[index], hot, index, doc, place, ids, keys, high, joined, size, shards)

    def batches(it):
        for row in run(it):
            yield pa.RecordBatch.from_pylist(row, schema=types)

    def start(schema):
        nonlocal types
        types = schema
        return batches

    return start


def _cuts(shard: np.ndarray):
    """Ranges of equal neighbours."""
    cut = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True])))
    return zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)


def _found(gone, doc, place, ids, keys, shards):
    """Packed rows of windows that a slice has found already."""
    if len(gone):
        gone = gone[np.argsort(doc[gone] % shards, kind="stable")]
        out = []
        for a, b in _cuts(doc[gone] % shards):
            d, counts = np.unique(doc[gone[a:b]], return_counts=True)
            out.append(_pack(int(d[0] % shards), ids[d], keys[d], counts, place[gone[a:b]]))
        yield out


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each length."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _runs(first, least, hot, index, doc, place, ids, keys, high, words, size, shards):
    """Packed rows of runs: neighbouring windows of one least part, with the words they cover; hot ones are on their own."""
    if not len(first):
        return
    alone = np.zeros(len(least), bool)
    if len(hot):
        spread = np.zeros(1 << GROUP_BITS, bool)
        spread[hot] = True
        alone = spread[_groups(least)]
        least = np.where(alone, mix(high + np.uint64(1)), least)  # equal windows have equal hashes, too
    new = np.concatenate(([True], (first[1:] != first[:-1] + 1) | (least[first[1:]] != least[first[:-1]]) | (doc[first[1:]] != doc[first[:-1]]) | alone[first[1:]] | alone[first[:-1]]))
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(first)))
    long = n > 255  # a run's length fits in a byte; longer ones are cut
    if long.any():
        parts = -(-n // 255)
        begin = np.repeat(begin, parts) + _ramp(parts) * 255
        n = np.diff(np.append(begin, len(first)))
    head = first[begin]
    shard = (mix(least[head]) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    begin, n, head, shard = begin[order], n[order], head[order], shard[order]
    out = []
    for a, b in _cuts(shard):
        at, long_ = head[a:b], n[a:b]
        d, counts = np.unique(doc[at], return_counts=True)
        covered = words[np.repeat(index[at], long_ + size - 1) + _ramp(long_ + size - 1)]
        held = first[np.repeat(begin[a:b], long_) + _ramp(long_)]
        out.append(_pack(
            int(shard[a]), ids[d], keys[d], counts, place[at], runs=long_.astype(np.uint8).tobytes(), tags=(least[at] >> np.uint64(32)).astype(np.uint32).tobytes(),
            words=covered.astype(np.uint8).tobytes(), checks=high[held].astype(np.uint16).tobytes(),
        ))
        if len(out) == 256:
            yield out
            out = []
    if out:
        yield out


def _search(rows: list[dict], size: int) -> list[tuple[np.ndarray, ...]]:
    """(id, key, place) of the windows of a shard's runs that may stand in it twice."""
    parts = [(*_unpack(r), np.frombuffer(r["runs"], np.uint8).astype(np.int64), np.frombuffer(r["tags"], np.uint32)) for r in rows]
    doc, key, place, n, tag = (np.concatenate([p[i] for p in parts]) for i in range(5))
    words = b"".join([r["words"] for r in rows])
    raw = b"".join([r["checks"] for r in rows])
    checks = np.frombuffer(raw, np.uint16)
    _, inverse, counts = np.unique(tag, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts[inverse] > 1)
    if not len(shared):
        return []
    at_word, at_check = np.cumsum(n + size - 1) - (n + size - 1), np.cumsum(n) - n
    length = n[shared] + size - 1
    symbols = np.frombuffer(words, np.uint8)[np.repeat(at_word[shared], length) + _ramp(length)]
    text = np.zeros(len(symbols) + len(shared), np.int64)  # a separator after each run
    starts = np.cumsum(length + 1) - (length + 1)
    text[np.repeat(starts, length) + _ramp(length)] = symbols.astype(np.int64) + 1
    windows = np.repeat(starts, n[shared]) + _ramp(n[shared])
    matched, low, _ = FmIndex(text).search(text, windows, size)
    hit = np.flatnonzero(matched == size)
    if not len(hit):
        return []
    run = np.repeat(shared, n[shared])[hit]
    p = np.repeat(place[shared], n[shared])[hit] + _ramp(n[shared])[hit]
    together = low[hit] * 65536 + checks[np.repeat(at_check[shared], n[shared]) + _ramp(n[shared])][hit]
    _, inverse, counts = np.unique(together, return_inverse=True, return_counts=True)
    found = counts[inverse] > 1
    return [(doc[run[found]], key[run[found]], p[found])] if found.any() else []


def _bucket(doc: np.ndarray, key: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.astype(np.uint64) + mix(key.astype(np.uint64))) % np.uint64(buckets)).astype(np.int64)


def _by_document(found: list[tuple[np.ndarray, ...]], buckets: int, **more: bytes) -> list[dict]:
    """Packed rows of (id, key, place), by buckets of documents."""
    doc, key, place = (np.concatenate([f[i] for f in found]) for i in range(3))
    bucket = _bucket(doc, key, buckets)
    order = np.lexsort((place, key, doc, bucket))
    doc, key, place, bucket = doc[order], key[order], place[order], bucket[order]
    first = np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))[: len(doc)]
    out = []
    for a, b in _cuts(bucket) if len(doc) else ():
        at = np.flatnonzero(first[a:b]) + a
        at = at if len(at) and at[0] == a else np.append(a, at)
        out.append(_pack(int(bucket[a]), doc[at], key[at], np.diff(np.append(at, b)), place[a:b], **more))
    return out


def _judged(types: pa.Schema, buckets: int, size: int):
    """Windows that slices have found, and candidates (with empty runs), by document."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        done = [_unpack(r) for r in rows if r["runs"] is None]
        out = _by_document(done, buckets) if done else []
        if (runs := [r for r in rows if r["runs"] is not None]) and (found := _search(runs, size)):
            out += _by_document(found, buckets, runs=b"")
        return pa.Table.from_pylist(out, schema=types)

    return run


def _digested(types: pa.Schema, size: int, buckets: int, documents: int):
    """Of (doc_id, key, text, maybe): the digests of the candidates, the earliest of each in a batch by bucket, all others as found."""

    def flush(docs: list[tuple[int, int, np.ndarray]], raw: list[bytes]):
        doc, key = (np.repeat([d[i] for d in docs], [len(d[2]) for d in docs]) for i in (0, 1))
        place, digests = np.concatenate([d[2] for d in docs]), np.frombuffer(b"".join(raw), np.uint64).reshape(-1, 2)
        yield from _first_of_each(doc, key, place, digests, buckets, documents)

    def run(batches):
        docs, raw = [], []
        for b in batches:
            for i, k, t, maybe in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.large_binary()).to_pylist(), b.column(3).to_pylist(), strict=True):
                text = b" ".join((t or b"").split())
                starts, ends = word_bounds(text)
                at = np.concatenate([np.arange(x, y - size + 1) for x, y in np.frombuffer(maybe, np.int32).reshape(-1, 2)])
                docs.append((NULL_ID if i is None else i, k, at))
                raw += [hashlib.blake2b(text[x:y], digest_size=DIGEST).digest() for x, y in zip(starts[at].tolist(), ends[at + size - 1].tolist(), strict=True)]
                if len(raw) >= BATCH_DIGESTS:
                    yield from flush(docs, raw)
                    docs, raw = [], []
        if docs:
            yield from flush(docs, raw)

    def batches(it):
        for rows in run(it):
            yield pa.RecordBatch.from_pylist(rows, schema=types)

    return batches


def _earliest(doc: np.ndarray, place: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by digest, then place; in it, which windows are not the earliest of their digest (or at its very place)."""
    order = np.lexsort((place, doc, digests[:, 0], digests[:, 1]))
    d, p, x = doc[order], place[order], digests[order]
    same = np.concatenate(([False], (x[1:] == x[:-1]).all(1)))
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    return order, same & ~((d == d[lead]) & (p == p[lead]))


def _first_of_each(doc, key, place, digests, buckets: int, documents: int):
    order, gone = _earliest(doc, place, digests)
    if gone.any():
        at = order[gone]
        yield _by_document([(doc[at], key[at], place[at])], documents)
    at = np.sort(order[~gone])
    bucket = (digests[at, 0] % np.uint64(buckets)).astype(np.int64)
    at = at[np.argsort(bucket, kind="stable")]
    out = []
    for a, b in _cuts((digests[at, 0] % np.uint64(buckets)).astype(np.int64)):
        part = at[a:b]
        new = np.flatnonzero(np.concatenate(([True], (doc[part][1:] != doc[part][:-1]) | (key[part][1:] != key[part][:-1]))))
        out.append(_pack(int(digests[part[0], 0] % np.uint64(buckets)), doc[part[new]], key[part[new]], np.diff(np.append(new, len(part))), place[part], checks=digests[part].tobytes()))
        if len(out) == 256:
            yield out
            out = []
    if out:
        yield out


def _decided(types: pa.Schema, documents: int):
    """All but the earliest window of each digest of a bucket, by document; what batches have found goes on as it is."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        done = [r for r in rows if r["checks"] is None]
        if left := [r for r in rows if r["checks"] is not None]:
            doc, key, place = (np.concatenate(x) for x in zip(*map(_unpack, left), strict=True))
            digests = np.frombuffer(b"".join([r["checks"] for r in left]), np.uint64).reshape(-1, 2)
            order, gone = _earliest(doc, place, digests)
            at = order[gone]
            done += _by_document([(doc[at], key[at], place[at])], documents)
        return pa.Table.from_pylist(done, schema=types)

    return run


def _listed(types: pa.Schema, size: int):
    """The ranges of each document of a bucket, of windows to remove and of candidates."""

    def run(table: pa.Table) -> pa.Table:
        parts = []
        for wanted in (False, True):
            found = [_unpack(row) for row in table.to_pylist() if (row["runs"] is not None) == wanted]
            if not found:
                continue
            doc, key, place = (np.concatenate([f[i] for f in found]) for i in range(3))
            order = np.lexsort((place, key, doc))
            doc, key, place = doc[order], key[order], place[order]
            cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]), [True])))
            ranges = [_ranges(place[a:b], size, 1 if wanted else size) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            parts.append(pa.table([pa.array(doc[cut[:-1]], pa.int64()), pa.array(key[cut[:-1]], pa.int64()), pa.array([wanted] * len(ranges), pa.bool_()), pa.array(ranges, pa.binary())], schema=types))
        return pa.concat_tables(parts)

    return run


def _ranges(starts: np.ndarray, size: int, gap: int) -> bytes:
    """Sorted window starts as ranges of words (start, end); starts up to gap apart are in one."""
    new = np.concatenate(([True], starts[1:] > starts[:-1] + gap))
    last = np.concatenate((new[1:], [True]))
    return np.column_stack((starts[new], starts[last] + size)).astype(np.int32).tobytes()


def find_repeats(df: DataFrame, size: int = SIZE, shards: int | None = None) -> DataFrame:
    """(doc_id, key, ranges) of the documents (doc_id, key, text) with words to remove; ranges are packed int pairs, in two lists at most."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    windows, hot = count_windows(df, size)
    shards = shards or max(64, 4 * partitions, -(-windows // SHARD_WINDOWS))
    documents = max(16, partitions, -(-windows // BUCKET_PLACES))
    buckets = max(16, partitions, -(-windows // BUCKET_DIGESTS))
    types = arrow_schema(spark, PACKED)
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "key", "text"]
    out = "doc_id long, key long, candidate boolean, ranges binary"
    listed = lambda rows: rows.groupBy("shard").applyInArrow(_listed(arrow_schema(spark, out), size), out)
    packed = df.select(*columns).mapInArrow(_hashed(shards, size, hot)(types), PACKED)
    judged = packed.groupBy("shard").applyInArrow(_judged(types, documents, size), PACKED)
    first = written(listed(judged), "ranges")
    digested = with_ranges(df, first.where("candidate"), "inner").select(*columns, "ranges").mapInArrow(_digested(types, size, buckets, documents), PACKED)
    # Digests and what batches have found go to buckets of their own: the latter only pass through.
    decided = digested.groupBy("shard").applyInArrow(_decided(types, documents), PACKED)
    second = written(listed(decided), "ranges")
    return first.where("not candidate").select("doc_id", "key", "ranges").union(second.select("doc_id", "key", "ranges"))


def with_ranges(df: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """Documents (doc_id, key, text) with their ranges; these are broadcast if they are few and small."""
    named = ranges.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "ranges")
    held = named.agg(F.count(F.lit(1)), F.sum(F.octet_length("ranges") if dict(named.dtypes)["ranges"] == "binary" else F.expr("aggregate(ranges, 0L, (a, x) -> a + octet_length(x))"))).head()
    side = F.broadcast(named) if held[0] <= BROADCAST_ROWS and (held[1] or 0) <= BROADCAST_BYTES else named
    return df.join(side, (F.coalesce(df.doc_id, F.lit(NULL_ID)) == side["_id"]) & (df.key == side["_key"]), how)


def _kept(data: bytes, ranges: list[bytes] | None) -> tuple[int, int, str]:
    """Number of words, number removed and the kept words joined by blanks."""
    starts, ends = word_bounds(data)
    keep = np.ones(len(starts), bool)
    for a, b in np.frombuffer(b"".join(ranges or ()), np.int32).reshape(-1, 2):
        keep[a:b] = False
    text = b" ".join([data[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)]) if ranges else b" ".join(data.split())
    return len(starts), int(len(keep) - keep.sum()), text.decode("utf-8", "replace")


def remove_repeats(df: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row for each row of df: doc_id, n_words, n_removed, kept_sha256, and the kept text unless with_text is false."""
    docs = id_text(df, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    found = written(find_repeats(docs, size).groupBy("doc_id", "key").agg(F.collect_list("ranges").alias("ranges")), "ranges")  # two for a document at most
    both = with_ranges(docs, found, "left").select("doc_id", "text", "ranges")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")
    types = arrow_schema(df.sparkSession, schema)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                rows = [_kept(t or b"", r) for t, r in zip(part.column(1).cast(pa.large_binary()).to_pylist(), part.column(2).to_pylist(), strict=True)]
                cols = [part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[2].encode()).hexdigest() for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([r[2] for r in rows], pa.string())] if with_text else cols, schema=types)

    return both.mapInArrow(run, schema)
