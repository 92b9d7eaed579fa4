"""Removal of repeated passages by a hash-compared sparse suffix sort.

A byte goes when a string of ``length`` bytes that covers it also starts in a document with a
smaller id.  Suffixes of one length need not all be sorted to find those strings: of the
``length - K + 1`` strings of ``K`` bytes inside each such string the one with the smallest hash is
its *anchor*, and equal strings have equal anchors.  So only the suffixes (and, read backwards, the
prefixes) at anchors are sorted, within the anchors of equal hash.

* **Comparison.** Prefix sums of a polynomial hash give the hash of any substring; binary search
  over its length finds how far two suffixes agree, and the byte after that decides.  A bottom-up
  mergesort, all runs of a level at once, sorts with these logarithmic comparisons.
* **Verification.** Neighbours of the sorted order are compared byte by byte over the length the
  hashes report, and at the byte that decided.  A collision means another base and a new sort.
* **Result.** With the common lengths of neighbours on both sides, two strings of ``length`` bytes
  that start ``a`` bytes before their anchors agree when they are in one run of the backward order
  with at least ``a`` bytes in common and in one run of the forward order with ``length - a``.

Steps, each a grouped Spark job: documents are dealt to *shards*; each shard sends short hashes of
its anchors to *buckets*, which tell every shard which of them other shards have too; for those, the
shard sends the bytes around the anchor; buckets sort them and return spans; shards cut.  The texts
are shuffled once and that exchange is read three times.

Hot groups: equal texts meet in one shard and are settled there, but a text with more copies than
an average shard has rows is spread over all.  A shard sends a passage once, for the smallest id that
has it there, and settles the others itself, so a bucket gets a hot passage once per shard at most.

Null text is empty text.  A null id counts as larger than all ids; rows of equal id are one
document to each other (nothing of one is removed because of the other).  Empty and short texts
lose nothing.  Input columns named like an added one are replaced, all others are kept.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, tasks
from .registry import named, table

#: Bytes of the hashed strings among which the anchor is chosen.
K = 20
ADDED = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
#: Contexts that are sorted at a time: a sort holds some 2 KB for each.
MOST = 1 << 15
_LAST = np.iinfo(np.int64).max
_SLICE = 1 << 18
_U = np.uint64


def _random_bytes_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)


_TABLE = _random_bytes_table(5)
_BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return _U(pow(_BASE, n, 1 << 64))


def _rolling(b: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` bytes of ``b``, put together from those of powers of two."""
    parts, size, done, out = _TABLE[b], 1, 0, None
    while size <= k:
        if k & size:
            out = parts if out is None else out[: len(out) - size] * _power(size) + parts[done:]
            done += size
        parts = parts[:-size] * _power(size) + parts[size:] if len(parts) > size else parts[:0]
        size *= 2
    out = out ^ (out >> _U(32))
    out = out * _U(0xD6E8FEB86659FD93)
    return out ^ (out >> _U(29))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def anchors(buffer: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The anchors of all strings of ``length`` bytes that lie in one document.

    For each: where its first string starts, where its last one ends, its own place, its hash.
    ``ends`` are the documents' ends in the buffer.
    """
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    n = len(buffer) - length + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    valid = np.ones(len(buffer), bool)
    for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True):
        valid[max(lo, hi - length + 1) : hi] = False
    found = []
    with np.errstate(over="ignore"):
        for a in range(0, n, _SLICE):
            e = min(n, a + _SLICE)
            h = _rolling(buffer[a : e + length - 1], K)
            # The smallest hash, the first one among equals, and where it is.
            key = (h >> _U(20) << _U(20)) | np.arange(len(h), dtype=np.uint64)
            at = (_sliding_min(key, length - K + 1) & _U((1 << 20) - 1)).astype(np.int64)
            v = valid[a:e]
            same = v[:-1] & v[1:] & (at[1:] == at[:-1])
            first, last = v.copy(), v.copy()
            first[1:] &= ~same
            last[:-1] &= ~same
            q = np.nonzero(first)[0]
            found.append((q + a, np.nonzero(last)[0] + a + length, at[q] + a, h[at[q]]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---------------------------------------------------------------- suffix sort


class _Suffixes:
    """Suffixes of a buffer, each with a limit to its length, compared by prefix hashes."""

    def __init__(self, buffer: np.ndarray, at: np.ndarray, limit: np.ndarray, seed: int):
        self.buffer = np.append(buffer, np.uint8(0))
        self.at, self.limit = at, limit
        base = (_BASE + 2 * seed * 0x51ED2701) % (1 << 64) | 1
        n = len(buffer) + 1
        self.inverse = _powers(pow(base, -1, 1 << 64), n)
        with np.errstate(over="ignore"):
            terms = _random_bytes_table(100 + seed)[buffer] * _powers(base, n)[:-1]
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bytes agree, by binary search over the hashes of prefixes."""
        x, y = self.at[i], self.at[j]
        lo, hi = np.zeros(len(i), np.int64), np.minimum(self.limit[i], self.limit[j])
        sx, sy, ix, iy = self.sums[x], self.sums[y], self.inverse[x], self.inverse[y]
        for _ in range(int(hi.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = (self.sums[x + mid] - sx) * ix == (self.sums[y + mid] - sy) * iy
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def sign(self, i: np.ndarray, j: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Below, equal to or above 0 as suffix i is before, equal to or after j."""
        a, b = self.limit[i], self.limit[j]
        ended = common >= np.minimum(a, b)
        bytes_ = self.buffer[self.at[i] + common].astype(np.int64) - self.buffer[self.at[j] + common]
        return np.where(ended, a - b, bytes_)

    def verified(self, i: np.ndarray, j: np.ndarray, common: np.ndarray) -> bool:
        """Whether i and j do agree in so many bytes, and not in the next one."""
        x, y, live = self.at[i], self.at[j], np.arange(len(i))
        for t in range(int(common.max(initial=0))):
            live = live[common[live] > t]
            if (self.buffer[x[live] + t] != self.buffer[y[live] + t]).any():
                return False
        open_ = common < np.minimum(self.limit[i], self.limit[j])
        return bool((self.buffer[(x + common)[open_]] != self.buffer[(y + common)[open_]]).all())


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    size = 1
    with np.errstate(over="ignore"):
        while size < n:
            m = min(size, n - size)
            out[size : size + m] = out[:m] * _U(pow(base, size, 1 << 64))
            size *= 2
    return out


def suffix_sort(buffer: np.ndarray, at: np.ndarray, limit: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes within each group (groups in ascending order), and how many bytes each
    has in common with the one before it (-1 at the start of a group)."""
    n = len(at)
    start = np.zeros(n, bool)
    for seed in range(16):
        suffixes = _Suffixes(buffer, at, limit, seed)
        order = np.argsort(group, kind="stable")
        sorted_group = group[order]
        start = np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]]) if n else start
        number = np.cumsum(start) - 1
        first = np.nonzero(start)[0]
        size = np.diff(np.append(first, n))
        lo_of, end_of = first[number], (first + size)[number]
        width, most = 1, int(size.max(initial=0))
        with np.errstate(over="ignore"):
            while width < most:
                slots = np.nonzero(end_of - lo_of > width)[0]  # groups that are already one run rest
                local = slots - lo_of[slots]
                run = local // width
                left = run % 2 == 0
                pair = lo_of[slots] + (run // 2) * 2 * width
                begin = np.minimum(np.where(left, pair + width, pair), end_of[slots])
                stop = np.minimum(begin + width, end_of[slots])
                lo, hi = begin.copy(), np.where(left, stop, np.minimum(pair + width, end_of[slots]))
                mine = order[slots]
                live = np.nonzero(lo < hi)[0]
                while len(live):
                    mid = (lo[live] + hi[live]) >> 1
                    other = order[mid]
                    sign = suffixes.sign(mine[live], other, suffixes.common(mine[live], other))
                    # Rank among the other run: those before it, and equal ones of the left run.
                    after = np.where(left[live], sign > 0, sign >= 0)
                    lo[live] = np.where(after, mid + 1, lo[live])
                    hi[live] = np.where(after, hi[live], mid)
                    live = live[lo[live] < hi[live]]
                place = pair + local % width + (lo - begin)
                moved = order.copy()
                moved[place] = mine
                order = moved
                width *= 2
            common = np.full(n, -1, np.int64)
            inner = np.nonzero(~start)[0]
            i, j = order[inner - 1], order[inner]
            common[inner] = suffixes.common(i, j)
            if suffixes.verified(i, j, common[inner]) and (suffixes.sign(i, j, common[inner]) <= 0).all():
                return order, common
    raise RuntimeError("hash collisions with every base")


def covered_strings(
    buffer: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, group: np.ndarray, doc: np.ndarray, length: int, offsets: range | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Strings of ``length`` bytes around anchors that a smaller document has too, of all ``offsets`` or some.

    Element e is an anchor at ``at[e]`` with ``before[e]`` and ``after[e]`` bytes around it; its
    strings start ``length - after[e]`` .. ``before[e]`` bytes before it.  For each offset: the offset
    and the elements whose string there is covered.
    """
    order, common = suffix_sort(buffer, at, after, group)
    back, back_common = suffix_sort(buffer[::-1], len(buffer) - at, before, group)
    n, out = len(at), []
    forward_class, backward_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(length) if offsets is None else offsets:
        if a > before.max(initial=-1):
            break
        have = np.nonzero((before >= a) & (after >= length - a))[0]
        if len(have) < 2:
            continue
        forward_class[order] = np.cumsum(common < length - a)
        backward_class[back] = np.cumsum(back_common < a)
        key = forward_class[have] * (n + 1) + backward_class[have]
        rank = np.lexsort((doc[have], key))
        have, key = have[rank], key[rank]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        smallest = doc[have][new][np.cumsum(new) - 1]
        hit = have[doc[have] > smallest]
        if len(hit):
            out.append((a, hit))
    return out


# ---------------------------------------------------------------- shards and buckets


class _Shard:
    """The distinct texts of a shard, each with the smallest id that has it."""

    def __init__(self, ids: pa.ChunkedArray, texts: pa.ChunkedArray):
        raw = [(x or "").encode() for x in texts.to_pylist()]
        keys = [_LAST if x is None else x for x in ids.to_pylist()]
        best: dict[bytes, int] = {}
        for x, k in zip(raw, keys, strict=True):
            best[x] = min(k, best.get(x, _LAST))
        # The same order whenever the shard is read again.
        self.texts = sorted(best, key=lambda x: (best[x], x))
        self.doc = np.array([best[x] for x in self.texts], np.int64)
        self.number = {x: i for i, x in enumerate(self.texts)}
        self.rows = list(zip(raw, keys, strict=True))
        self.raw = b"".join(self.texts)
        self.ends = np.cumsum([len(x) for x in self.texts], dtype=np.int64)

    def anchors(self, length: int):
        start, end, at, h = anchors(np.frombuffer(self.raw, np.uint8), self.ends, length)
        return start, end, at, h, np.searchsorted(self.ends, start, side="right")


def _by_bucket(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of hashes by bucket, and the buckets in that order."""
    bucket = ((h & _U(0xFFFFFFFF)) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _cuts(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each key with its range."""
    if len(sorted_keys):
        first = np.nonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))[0]
        for lo, hi in zip(first.tolist(), np.append(first[1:], len(sorted_keys)).tolist(), strict=True):
            yield int(sorted_keys[lo]), lo, hi


def _table(names: list[str], rows: list[tuple], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    parts = [struct.pack("<q", a.nbytes) + a.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(block: bytes, *kinds: str) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(block), 0, []
    for k in kinds:
        (n,) = struct.unpack_from("<q", data, at)
        out.append(np.frombuffer(data, k, n // np.dtype(k).itemsize, at + 8))
        at += 8 + n
    return out


def _shared_hashes(blocks: list[np.ndarray]) -> list[np.ndarray]:
    """For each block of short hashes, which of them are in another place too."""
    every = np.concatenate(blocks)
    _, at, count = np.unique(every, return_inverse=True, return_counts=True)
    return np.split(count[at] > 1, np.cumsum([len(x) for x in blocks])[:-1])


def _records(shard: _Shard, masks: dict[int, np.ndarray], buckets: int, length: int) -> tuple[list[tuple], list[tuple]]:
    """What goes to each bucket, and the spans that the shard can settle itself."""
    start, end, at, h, doc = shard.anchors(length)
    distinct, of = np.unique(h, return_inverse=True)
    order, bucket = _by_bucket(distinct, buckets)
    shared = np.zeros(len(distinct), bool)
    for b, lo, hi in _cuts(bucket):
        if b in masks:
            shared[order[lo:hi]] = np.unpackbits(masks[b], count=hi - lo).astype(bool)
    # Anchors of several texts of this shard.
    low, high = np.full(len(distinct), len(shard.texts)), np.full(len(distinct), -1)
    np.minimum.at(low, of, doc)
    np.maximum.at(high, of, doc)
    shared |= low < high
    take = np.nonzero(shared[of])[0]
    take = take[np.argsort(doc[take], kind="stable")]
    doc_start = shard.ends - np.array([len(x) for x in shard.texts], np.int64)
    seen: dict[bytes, list] = {}
    settled = []
    for i, s, e, d in zip(take.tolist(), start[take].tolist(), end[take].tolist(), doc[take].tolist(), strict=True):
        around = shard.raw[s:e]
        known = seen.get(around)
        if known is None:
            seen[around] = [shard.doc[d], i, [d], [s - doc_start[d]]]
        elif known[0] < shard.doc[d]:
            settled.append((d, s - doc_start[d], e - doc_start[d]))
        else:  # the same document again
            known[2].append(d)
            known[3].append(s - doc_start[d])
    out = []
    if seen:
        contexts, found = list(seen), list(seen.values())
        which = np.array([f[1] for f in found])
        order, bucket = _by_bucket(h[which], buckets)
        for b, lo, hi in _cuts(bucket):
            mine = order[lo:hi].tolist()
            block = _pack(
                h[which[mine]],
                np.array([found[m][0] for m in mine], np.int64),
                (at[which[mine]] - start[which[mine]]).astype(np.uint8),
                np.array([len(contexts[m]) for m in mine], np.uint8),
                np.array([len(found[m][2]) for m in mine], np.uint32),
                np.array([x for m in mine for x in found[m][2]], np.uint32),
                np.array([x for m in mine for x in found[m][3]], np.uint32),
                np.frombuffer(b"".join(contexts[m] for m in mine), np.uint8),
            )
            out.append((b, block))
    return out, settled


def _portions(group: np.ndarray, matrix: np.ndarray, before: np.ndarray, after: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, range]]:
    """Elements that are sorted at a time, their groups, and the offsets to look at.

    A string leaves ``length - K`` bytes around its anchor, half of them at least on one side.  So a group of
    more than ``MOST`` elements falls into those that have as many bytes before the anchor in common, for the
    strings with so many there, and those that have as many bytes after it in common, for all others.
    ``matrix`` has the contexts, one in a row.
    """
    size = np.bincount(group, minlength=1)
    large, side = size[group] > MOST, (length - K) // 2
    every = range(length - K + 1)
    sets = [(np.nonzero((size[group] > 1) & ~large)[0], group, every)]
    if large.any():
        for enough, shift, offsets in ((before >= side, -side, every[side:]), (after >= K + side, K, every[:side])):
            which = np.nonzero(large & enough)[0]
            columns = (before[which] + shift)[:, None] + np.arange(side)
            keys = np.concatenate([group[which].astype("<u4").view(np.uint8).reshape(-1, 4), matrix[which[:, None], columns]], 1)
            finer = np.zeros(len(group), np.int64)
            _, finer[which], times = np.unique(_whole(keys), return_inverse=True, return_counts=True)
            sets.append((which[times[finer[which]] > 1], finer, offsets))
    for which, number, offsets in sets:
        which = which[np.argsort(number[which], kind="stable")]
        ends = np.append(np.nonzero(np.diff(number[which]))[0] + 1, len(which))
        lo = 0
        while lo < len(which):  # whole groups, as many as fit
            hi = int(ends[max(np.searchsorted(ends, lo, "right"), np.searchsorted(ends, lo + MOST, "right") - 1)])
            yield which[lo:hi], number[which[lo:hi]], offsets
            lo = hi


def _whole(rows: np.ndarray) -> np.ndarray:
    """The rows of a matrix of bytes as one value each."""
    return np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).reshape(-1)


def _sorted_spans(blocks: list[bytes], length: int) -> list[np.ndarray]:
    """For each block the spans (text number, start, end) that smaller documents cover."""
    kinds = ("u8", "i8", "u1", "u1", "u4", "u4", "u4", "u1")
    columns = [np.concatenate(x) for x in zip(*(_unpack(b, *kinds) for b in blocks), strict=True)]
    h, doc, anchor, size, times, texts, starts, raw = columns
    own = np.repeat(np.arange(len(blocks)), [len(_unpack(b, "u8")[0]) for b in blocks])
    # One element for each distinct context: the smallest document that has it.
    wide = int(size.max(initial=0))
    matrix = np.zeros((len(h), wide + 1), np.uint8)
    matrix[:, :wide][np.arange(wide) < size[:, None]] = raw
    matrix[:, wide] = size
    _, first, of = np.unique(_whole(matrix), return_index=True, return_inverse=True)
    matrix = matrix[first]
    e_doc = np.full(len(first), _LAST)
    np.minimum.at(e_doc, of, doc)
    before, after = anchor[first].astype(np.int64), size[first].astype(np.int64) - anchor[first]
    _, group = np.unique(h[first], return_inverse=True)
    hits = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for which, number, offsets in _portions(group, matrix, before, after, length):
        sizes = before[which] + after[which]
        buffer = matrix[which, :wide][np.arange(wide) < sizes[:, None]]
        start = np.cumsum(sizes) - sizes
        for a, hit in covered_strings(buffer, start + before[which], before[which], after[which], number, e_doc[which], length, offsets):
            hits.append((which[hit], before[which[hit]] - a))
    hit, at = (np.concatenate(x) for x in zip(*hits, strict=True))
    order = np.argsort(hit, kind="stable")
    hit, at = hit[order], at[order]
    # Where a context stands: all of it goes if a smaller document has it, else its strings that were hit.
    record = np.repeat(np.arange(len(h)), times)
    whole = doc[record] > e_doc[of[record]]
    lo, hi = (np.searchsorted(hit, of[record], x) for x in ("left", "right"))
    number = np.where(whole, 0, hi - lo)
    place = np.repeat(np.arange(len(record)), number)
    string = at[np.arange(len(place)) - np.repeat(np.cumsum(number) - number, number) + lo[place]]
    place = np.concatenate([np.nonzero(whole)[0], place])
    begin = starts[place] + np.concatenate([np.zeros(int(whole.sum()), np.int64), string])
    stop = begin + np.concatenate([size[record[whole]].astype(np.int64), np.full(len(string), length)])
    spans = np.stack([texts[place], begin, stop], 1).astype(np.uint32)
    block = own[record[place]]
    order = np.argsort(block, kind="stable")
    return np.split(spans[order], np.searchsorted(block[order], np.arange(1, len(blocks))))


def _union(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the (start, end) rows."""
    if not len(spans):
        return []
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return list(zip(spans[new, 0].tolist(), reach[np.append(np.nonzero(new)[0][1:] - 1, len(spans) - 1)].tolist(), strict=True))


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 50, decode: bool = False) -> DataFrame:
    """``df`` with n_bytes, n_removed, n_spans, spans (start and end of each maximal removed run of
    bytes) and kept: the remaining bytes, or with ``decode`` the text they are."""
    if length < K or length > 100:
        raise ValueError(f"length must be from {K} to 100")
    base = df.select(*[c for c in df.columns if c not in ADDED])
    # A row goes from every shard to every bucket, so there are not many more of them than tasks.
    shards, buckets, parts = 2 * tasks(df), tasks(df), tasks(df)

    # A text with more copies than a shard has rows on average: at most as many as there are shards.
    copies = base.groupBy(F.xxhash64(text).alias("__hot")).agg(F.count(F.lit(1)).alias("n"))
    hot = stage(copies.filter(F.col("n") * shards > base.count()).select("__hot"))
    own = F.pmod(F.xxhash64(text, F.lit(1)), F.lit(shards))
    spread = F.pmod(F.xxhash64(doc_id, F.lit(2)), F.lit(shards))
    columns = list(base.columns)
    docs = (
        base.join(F.broadcast(hot), F.xxhash64(text) == F.col("__hot"), "left")
        .withColumn("shard", F.when(F.col("__hot").isNull(), own).otherwise(spread).cast("int"))
        .drop("__hot")
        .select(F.col("shard").alias("__shard"), *columns)
        .repartition(parts, "__shard")
    )

    def read(rows: pa.Table) -> _Shard:
        return _Shard(rows.column(doc_id), rows.column(text))

    def hashes(rows: pa.Table) -> pa.Table:
        shard = rows.column("__shard")[0].as_py()
        distinct = np.unique(read(rows).anchors(length)[3])
        order, bucket = _by_bucket(distinct, buckets)
        short = (distinct[order] >> _U(32)).astype("<u4")
        out = [(b, shard, short[lo:hi].tobytes()) for b, lo, hi in _cuts(bucket)]
        return _table(["bucket", "shard", "hashes"], out, [pa.int32(), pa.int32(), pa.binary()])

    def shared(rows: pa.Table) -> pa.Table:
        blocks = [np.frombuffer(x, "<u4") for x in rows.column("hashes").to_pylist()]
        masks = _shared_hashes(blocks)
        out = [
            (s, b, np.packbits(m).tobytes())
            for s, b, m in zip(rows.column("shard").to_pylist(), rows.column("bucket").to_pylist(), masks, strict=True)
            if m.any()
        ]
        return _table(["__shard", "bucket", "mask"], out, [pa.int32(), pa.int32(), pa.binary()])

    def records(rows: pa.Table, masks: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            shard = rows.column("__shard")[0].as_py()
            of = dict(zip(masks.column("bucket").to_pylist(), masks.column("mask").to_pylist(), strict=True))
            of = {b: np.frombuffer(m, np.uint8) for b, m in of.items()}
            found, settled = _records(read(rows), of, buckets, length)
            out = [(b, shard, False, block) for b, block in found]
            if settled:  # no bucket needs them: they travel in a group of their own
                out.append((-1 - shard, shard, True, _pack(np.array(settled, np.uint32))))
        return _table(["bucket", "shard", "settled", "block"], out, [pa.int32(), pa.int32(), pa.bool_(), pa.binary()])

    def spans(rows: pa.Table) -> pa.Table:
        shard, blocks = rows.column("shard").to_pylist(), rows.column("block").to_pylist()
        if rows.column("settled")[0].as_py():
            out = list(zip(shard, blocks, strict=True))
        else:
            found = _sorted_spans(blocks, length)
            out = [(s, _pack(x)) for s, x in zip(shard, found, strict=True) if len(x)]
        return _table(["__shard", "block"], out, [pa.int32(), pa.binary()])

    schema = T.StructType(
        [
            *base.schema.fields,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("kept", T.StringType() if decode else T.BinaryType()),
        ]
    )
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        shard = read(rows)
        every = [_unpack(x, "u4")[0].reshape(-1, 3).astype(np.int64) for x in found.column("block").to_pylist()]
        every = np.concatenate(every) if every else np.empty((0, 3), np.int64)
        every = every[np.argsort(every[:, 0], kind="stable")]
        lo = np.searchsorted(every[:, 0], np.arange(len(shard.texts)))
        hi = np.searchsorted(every[:, 0], np.arange(len(shard.texts)), side="right")
        removed, kept = [], []
        for raw, key in shard.rows:
            i = shard.number[raw]
            if key > shard.doc[i]:  # a copy of a smaller document of this shard
                runs = [(0, len(raw))] if len(raw) >= length else []
            else:
                runs = _union(every[lo[i] : hi[i], 1:])
            removed.append(runs)
            ends = [0, *[x for run in runs for x in run], len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
        n = [len(raw) for raw, _ in shard.rows]
        added = [
            pa.array(n, pa.int64()),
            pa.array([a - len(b) for a, b in zip(n, kept, strict=True)], pa.int64()),
            pa.array([len(x) for x in removed], pa.int64()),
            pa.array([[{"start": a, "end": b} for a, b in x] for x in removed], span_type),
            pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if decode else pa.array(kept, pa.binary()),
        ]
        return pa.table([*[rows.column(c) for c in columns], *added], names=schema.names)

    by_shard = docs.groupBy("__shard")
    sent = by_shard.applyInArrow(hashes, "bucket int, shard int, hashes binary")
    masks = sent.groupBy("bucket").applyInArrow(shared, "__shard int, bucket int, mask binary")
    wide = by_shard.cogroup(masks.groupBy("__shard")).applyInArrow(records, "bucket int, shard int, settled boolean, block binary")
    found = wide.groupBy("bucket").applyInArrow(spans, "__shard int, block binary")
    return by_shard.cogroup(found.groupBy("__shard")).applyInArrow(cut, schema)


def kept_text(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """``df`` with repeated passages cut out of its texts.  Of a character that a cut divides no
    part is left; null stays null."""
    others = [c for c in df.columns if c not in (doc_id, text)]
    rest = [F.struct(*others).alias("__row")] if others else []
    done = dedup(df.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"), *rest), "__id", "__text", length, True)
    own = {doc_id: F.col("__id"), text: F.when(F.col("__text").isNotNull(), F.col("kept"))}
    return done.select(*[(own[c] if c in own else F.col("__row").getField(c)).alias(c) for c in df.columns])


@named("op5_suffix")
def op5_suffix(spark: SparkSession, folder: str) -> DataFrame:
    done = dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
