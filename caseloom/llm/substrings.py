"""Exact repeated passages, found by fixed-block anchors and removed from all but the first document.

A run of ``width`` words holds a whole block of ``(width + 1) // 2`` words wherever blocks are cut. So every document's
non-overlapping blocks are the index, and the rolling windows of all documents probe it. Windows of full width around
hits are compared by 95 bits of hash; the windows found to repeat, joined where they overlap, are the maximal repeats.

Texts are dealt once into groups of bounded size by a hash of the row. A group sends its probes, sorted and packed, to
ranges of hash values and gets back which of them hit; then it sends its windows around hits and gets back which of
them repeat, and whether the first is elsewhere. No pair of documents is ever made, and a passage costs a group one entry however
many copies of it the group holds.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, marked, others, pack, prepare, ranges, unpack, window_hashes, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A probe is this many bits of hash and two flags; a chance hit only makes a few windows be compared in vain.
KEY_BITS = 46
KEY_SPAN = 1 << (KEY_BITS + 2)
ANCHOR, SEVERAL = 1, 2
#: The free bit of a window's second hash.
FLAG = np.uint32(1)
LAST = np.iinfo(np.int64).max
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_HASHES = Hashes()


def word_hashes(data: bytes | None) -> np.ndarray:
    parts = [_HASHES.of(words) for words in word_chunks(data or b"")]
    return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.uint64), *parts])


def documents(group: pa.Table) -> Iterator[tuple[int, bytes | None]]:
    """doc_id (a null one as the largest) and text of a group's rows."""
    ids = group.column("doc_id").to_pylist()
    texts = group.column("text").cast(pa.binary()).to_pylist()
    return ((LAST if i is None else i, t) for i, t in zip(ids, texts, strict=True))


def probe_keys(words: np.ndarray, block: int) -> np.ndarray:
    return window_hashes(words, block, salt=7) >> np.uint64(64 - KEY_BITS)


def runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in a sorted array."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, int)


def group_probes(group: pa.Table, block: int) -> np.ndarray:
    """Distinct probes of a group, sorted, with flags: some document's block; in several documents."""
    keys, owners, anchors = [], [], []
    for k, (_, text) in enumerate(documents(group)):
        h = probe_keys(word_hashes(text), block)
        keys.append(h)
        owners.append(np.full(len(h), k, np.int32))
        anchors.append(np.arange(len(h)) % block == 0)
    h = np.concatenate(keys)
    order = np.argsort(h, kind="stable")
    h, owner, anchor = h[order], np.concatenate(owners)[order], np.concatenate(anchors)[order]
    at = runs(h)
    if not len(at):
        return h
    several = np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at)
    flags = np.logical_or.reduceat(anchor, at) * ANCHOR + several * SEVERAL
    return (h[at] << np.uint64(2)) | flags.astype(np.uint64)


def bucket_hits(probes: list[np.ndarray]) -> list[np.ndarray]:
    """For the probes of each group in one range of hashes, the keys that are a block and are in two documents."""
    keys = np.concatenate(probes) >> np.uint64(2)
    flags = np.concatenate(probes)
    distinct, at, count = np.unique(keys, return_inverse=True, return_counts=True)
    anchored, several = np.zeros(len(distinct), bool), count > 1
    anchored[at[(flags & np.uint64(ANCHOR)) > 0]] = True
    several[at[(flags & np.uint64(SEVERAL)) > 0]] = True
    hit = (anchored & several)[at]
    edges = np.cumsum([0, *map(len, probes)])
    return [keys[a:b][hit[a:b]] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def full_windows(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window: 64 bits, and 31 bits above a free one."""
    return window_hashes(words, width, salt=13), (window_hashes(words, width, salt=31) >> np.uint64(32)).astype(np.uint32) & ~FLAG


def equal_windows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal windows side by side, and where each new one starts."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    return order, np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.empty(0, int)


def near_hits(words: np.ndarray, hits: np.ndarray, width: int, block: int) -> np.ndarray:
    """Starts of the windows of full width that hold a hit."""
    n = len(words) - width + 1
    if n <= 0 or not len(hits):
        return np.empty(0, int)
    h = probe_keys(words, block)
    spot = np.searchsorted(hits, h)
    hit = hits[np.minimum(spot, len(hits) - 1)] == h
    total = np.concatenate(([0], np.cumsum(hit)))
    return np.flatnonzero(total[width - block + 1 :][:n] > total[:n])


def group_windows(group: pa.Table, hits: np.ndarray, width: int, block: int) -> tuple[np.ndarray, ...]:
    """Distinct windows of a group around hits, sorted: both hashes (flagged: in several documents), smallest doc_id."""
    parts = []
    for doc, text in documents(group):
        words = word_hashes(text)
        at = near_hits(words, hits, width, block)
        if len(at):
            a, b = full_windows(words, width)
            parts.append((a[at], b[at], np.full(len(at), doc, np.int64)))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64)
    a, b, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
    order, new = equal_windows(a, b)
    doc = doc[order]
    least = np.minimum.reduceat(doc, new)
    several = least != np.maximum.reduceat(doc, new)
    return a[order][new], b[order][new] | several.astype(np.uint32), least


def bucket_repeats(windows: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each group in one range, its windows that repeat, flagged if they start in a smaller document elsewhere."""
    a, b, doc = (np.concatenate(x) for x in zip(*windows, strict=True))
    several, b = b & FLAG > 0, b & ~FLAG
    order, new = equal_windows(a, b)
    least = np.empty(len(a), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], new), np.diff(np.append(new, len(a))))
    smaller = least < doc
    told = smaller | several
    out, at = [], 0
    for x in windows:
        own = slice(at, at + len(x[0]))
        out.append((a[own][told[own]], (b | smaller)[own][told[own]].astype(np.uint32)))
        at += len(x[0])
    return out


def planes(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane: small ones leave planes of zeros."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def repeated(group: pa.Table, known: tuple[np.ndarray, np.ndarray], width: int) -> Iterator[np.ndarray]:
    """For each row of a group which of its words a repeated window covers, from the group's repeating windows."""
    order = np.lexsort((known[1], known[0]))
    a, b = known[0][order], known[1][order]
    keys, elsewhere = b & ~FLAG, b & FLAG > 0
    first = np.full(len(a), LAST)
    found, sizes = [], []
    for doc, text in documents(group):
        words = word_hashes(text)
        at, which = places(words, a, keys, width)
        np.minimum.at(first, which, doc)
        found.append((doc, at, which))
        sizes.append(len(words))
    for (doc, at, which), n in zip(found, sizes, strict=True):
        yield marked(at[elsewhere[which] | (first[which] < doc)], n, width)


def places(words: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of a text are among given ones (sorted by both hashes), and which these are."""
    own_a, own_b = full_windows(words, width)
    if not len(a) or not len(own_a):
        return np.empty(0, int), np.empty(0, int)
    spot = np.minimum(np.searchsorted(a, own_a), len(a) - 1)
    at = np.flatnonzero(a[spot] == own_a)
    which, out_at, out_which = spot[at], [], []
    # windows that share the first hash stand side by side; nearly always the first one is meant
    while len(at):
        same = b[which] == own_b[at]
        out_at.append(at[same])
        out_which.append(which[same])
        left = ~same & (which + 1 < len(a))
        at, which = at[left], which[left] + 1
        still = a[which] == own_a[at]
        at, which = at[still], which[still]
    return (np.concatenate(out_at), np.concatenate(out_which)) if out_at else (at, which)


def without(text: bytes, gone: np.ndarray) -> bytes:
    """The text without marked words and the white space after them."""
    out, at = [], 0
    spans = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    for first, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        out.append(text[at : spans[first][0]])
        at = spans[end][0] if end < len(spans) else len(text)
    return b"".join([*out, text[at:]])


def dedup(docs: DataFrame, width: int = 13, group_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts, n_words, n_removed and kept_sha256 (of the kept words).

    A word goes if a window of ``width`` words that covers it also starts in a row with a smaller doc_id; windows are
    judged on the input. Rows of one doc_id do not count as smaller than each other, and a null doc_id is larger than
    all. Null and empty texts have no words and stay as they are; so do texts without repeats, white space included. An
    empty table gives no rows; columns named like an added one are replaced. doc_id must be an integer.

    ``group_bytes`` of text form a group and ``bucket_bytes`` of text send their probes to one range of hashes; raise
    the first to some 64 MB for many terabytes, so that packed probes stay dense.
    """
    prepare(docs.sparkSession)
    block = (width + 1) // 2
    added = ["n_words", "n_removed", "kept_sha256"]
    columns = others(docs, *added, "_grp")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, buckets = max(1, math.ceil(total / group_bytes)), max(1, math.ceil(total / bucket_bytes))
    spot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    dealt = docs.select(spot.alias("_grp"), *columns)

    def probe(key: tuple, group: pa.Table) -> pa.Table:
        found = group_probes(group, block)
        edges = [0, *np.searchsorted(found, np.array([KEY_SPAN * i // buckets for i in range(1, buckets)], np.uint64)).tolist(), len(found)]
        spans = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
        rows = [(i, key[0].as_py(), pack(found[a:b])) for i, a, b in spans]
        return as_table(rows, {"bucket": pa.int32(), "_grp": pa.int32(), "data": pa.binary()})

    def hits(key: tuple, bucket: pa.Table) -> pa.Table:
        found = bucket_hits([unpack(x) for x in bucket.column("data").to_pylist()])
        rows = [(g, pack(h)) for g, h in zip(bucket.column("_grp").to_pylist(), found, strict=True) if len(h)]
        return as_table(rows, {"_grp": pa.int32(), "data": pa.binary()})

    def windows(key: tuple, group: pa.Table, answer: pa.Table) -> pa.Table:
        known = [unpack(x) for x in answer.column("data").to_pylist()]
        a, b, doc = group_windows(group, np.sort(np.concatenate(known)) if known else np.empty(0, np.uint64), width, block)
        rows = [
            (i, key[0].as_py(), pack(a[x:y]), b[x:y].tobytes(), planes(doc[x:y]))
            for i, (x, y) in enumerate(ranges(a, buckets))
            if x < y
        ]
        return as_table(rows, {"bucket": pa.int32(), "_grp": pa.int32(), "a": pa.binary(), "b": pa.binary(), "doc": pa.binary()})

    def compare(key: tuple, bucket: pa.Table) -> pa.Table:
        col = {c: bucket.column(c).to_pylist() for c in ("_grp", "a", "b", "doc")}
        sent = [
            (unpack(a), np.frombuffer(b, np.uint32), from_planes(d, "<i8"))
            for a, b, d in zip(col["a"], col["b"], col["doc"], strict=True)
        ]
        rows = [
            (g, pack(a), b.tobytes())
            for g, (a, b) in zip(col["_grp"], bucket_repeats(sent), strict=True)
            if len(a)
        ]
        return as_table(rows, {"_grp": pa.int32(), "a": pa.binary(), "b": pa.binary()})

    def cut(key: tuple, group: pa.Table, answer: pa.Table) -> pa.Table:
        a = [unpack(x) for x in answer.column("a").to_pylist()]
        b = [np.frombuffer(x, np.uint32) for x in answer.column("b").to_pylist()]
        known = np.concatenate([np.empty(0, np.uint64), *a]), np.concatenate([np.empty(0, np.uint32), *b])
        texts, counts, removed, digests = [], [], [], []
        originals = group.column("text").cast(pa.binary()).to_pylist()
        for text, gone in zip(originals, repeated(group, known, width), strict=True):
            n = int(gone.sum())
            left = text if not n else without(text, gone)
            digest = hashlib.sha256()
            for k, words in enumerate(word_chunks(left or b"")):
                digest.update(b" " * (k > 0 and len(words) > 0) + b" ".join(words))
            texts.append(left)
            counts.append(len(gone))
            removed.append(n)
            digests.append(digest.hexdigest())
        out = {c: group.column(c) for c in columns} | {"text": pa.array(texts, pa.binary()).cast(group.schema.field("text").type)}
        out |= {"n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests)}
        return pa.table(out)

    asked = dealt.groupBy("_grp").applyInArrow(probe, "bucket int, _grp int, data binary")
    hit = asked.groupBy("bucket").applyInArrow(hits, "_grp int, data binary")
    compared = (
        dealt.groupBy("_grp").cogroup(hit.groupBy("_grp"))
        .applyInArrow(windows, "bucket int, _grp int, a binary, b binary, doc binary")
        .groupBy("bucket").applyInArrow(compare, "_grp int, a binary, b binary")
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    out = dealt.groupBy("_grp").cogroup(compared.groupBy("_grp"))
    return out.applyInArrow(cut, f"{kinds}, n_words long, n_removed long, kept_sha256 string")


def as_table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.table({c: pa.array(list(v), k) for (c, k), v in zip(kinds.items(), columns, strict=True)})
