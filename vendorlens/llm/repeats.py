"""Substring dedup by recompression: every later occurrence of a long word window goes.

Names are 64-bit content hashes, so tasks name a run or pair alike without a shared
dictionary. A first round names the runs of equal words; each further round splits the
names in two halves by a hash bit and names every pair of a left and a right one. A
symbol's interior depends on few neighbours, and how far that reaches is kept with it.
So each window of ``window`` words has symbols that it alone determines, the same in all
of its occurrences; the longest of the highest round (ties by hash, then the first) is
its anchor. A window without any is its own anchor.

Equal windows thus meet under one anchor at one offset. A task settles the windows
of a block of texts among themselves and sends on a row per anchor with the windows'
digests; so a passage that all documents share is one row a block, not one a document.
Grouped by anchor, digests verify the windows; all but the earliest are removed.

Digests have 48 bits beside the anchor's 64. Rows that share key and text are removed
from alike and are not earlier than each other. Defined results: a null or empty text
has no words; a null key comes after all others; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import text_blocks, utf8, worker_cache

#: Rounds of pair naming.
ROUNDS = 3
REMEMBERED = 300_000
LAST = np.iinfo(np.int64).max
DIGEST = np.uint64((1 << 48) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def named(a: np.ndarray, b) -> np.ndarray:
    """The name of a pair, or of a name and a count."""
    return mix(mix(a) * np.uint64(3) + b)


def windows_of(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each position on, by doubling."""
    out, at, step, part = None, 0, 1, h
    while step <= size:
        if size & step:
            piece = part[at:]
            out = piece if out is None else named(out[:len(piece)], piece)
            at += step
        if 2 * step <= size:
            part = named(part[:-step], part[step:])
        step *= 2
    return out[:len(h) - size + 1]


def runs_named(h: np.ndarray, doc: np.ndarray):
    """The first round: runs of equal words. Gives names, begins, ends and what they depend on."""
    begin = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))))
    size = np.diff(np.append(begin, len(h)))
    name = np.where(size > 1, named(h[begin], size.astype(np.uint64)), h[begin])
    end = begin + size
    return name, begin, end, begin - 1, end + 1  # a run ends where another word stands


def pairs_named(symbols, doc: np.ndarray, number: int):
    """A round: each pair of a left and a right name becomes one symbol."""
    name, begin, end, low, high = symbols
    left = mix(name + np.uint64(number)) >> np.uint64(63) == 1
    own = doc[begin]
    next_to = np.append(own[1:] == own[:-1], False)
    first = next_to & left & ~np.append(left[1:], True)
    keep = ~np.concatenate(([False], first[:-1]))
    after = np.minimum(np.arange(len(name)) + 1, len(name) - 1)
    before = np.maximum(np.arange(len(name)) - 1, 0)
    name2 = np.where(first, named(name, name[after]), name)
    end2 = np.where(first, end[after], end)
    high2 = np.where(left & next_to, high[after], high)
    low2 = np.where(~left & np.concatenate(([False], next_to[:-1])), low[before], low)
    return name2[keep], begin[keep], end2[keep], low2[keep], high2[keep]


def anchors_of(h: np.ndarray, doc: np.ndarray, start: np.ndarray, whole: np.ndarray, size: int):
    """For each window (by its start): its anchor's name, its position, and an id of the anchor."""
    name = whole[start].copy()
    place, ident = start.copy(), -1 - start
    symbols, rounds = runs_named(h, doc), []
    for r in range(ROUNDS):
        symbols = pairs_named(symbols, doc, r)
        rounds.append(symbols)
    todo = np.arange(len(start))
    for r in range(ROUNDS - 1, -1, -1):
        names, begin, end, low, high = rounds[r]
        rank = (np.uint64(63) - np.minimum(end - begin, 63).astype(np.uint64)) << np.uint64(58) | mix(names) >> np.uint64(6)
        n = len(h) + size + 2
        lo = np.cumsum(np.bincount(low + 1, minlength=n))[start[todo]]  # symbols that reach before the window
        hi = np.cumsum(np.bincount(high, minlength=n))[start[todo] + size]  # symbols settled within its end
        some = hi > lo
        at, lo, hi = todo[some], lo[some], hi[some]
        best, least = lo.copy(), rank[lo] if len(lo) else lo.astype(np.uint64)
        more, k = np.arange(len(at)), 1
        while True:
            more = more[hi[more] - lo[more] > k]
            if not len(more):
                break
            value = rank[lo[more] + k]
            better = value < least[more]
            best[more[better]], least[more[better]] = lo[more[better]] + k, value[better]
            k += 1
        name[at], place[at], ident[at] = named(names[best], np.uint64(r)), begin[best], r << 48 | best
        todo = todo[~some]
    return name, place, ident


def ranges_of(doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, size: int):
    """Window starts as word ranges, those that overlap joined: doc, tag, begin, end."""
    order = np.lexsort((pos, tag, doc))
    doc, tag, pos = doc[order], tag[order], pos[order]
    new = np.ones(len(pos), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (pos[1:] > pos[:-1] + size)
    at = np.flatnonzero(new)
    return doc[at], tag[at], pos[at], pos[np.append(at[1:], len(pos))[:len(at)] - 1] + size


def settle(group: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which rows aren't the earliest (doc, pos) of their group; rows come in that order in a group."""
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    of = np.repeat(first, np.diff(np.append(first, len(group))))
    return (doc > doc[of]) | (doc == doc[of]) & (pos > pos[of])


def block_rows(raw: list[bytes], doc_ids: np.ndarray, tags: np.ndarray, size: int, known: dict[bytes, int]):
    """The anchors of a block, and the ranges that it settles itself."""
    words = [t.split() for t in raw]
    for w in {w for x in words for w in x}.difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    count = np.fromiter(map(len, words), np.int64, len(words))
    h = np.fromiter((known[w] for x in words for w in x), np.uint64, int(count.sum()))
    if len(h) < size:
        return None
    doc = np.repeat(np.arange(len(words)), count)
    offset = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
    whole = windows_of(h, size)
    start = np.flatnonzero(doc[:len(whole)] == doc[size - 1:])
    if not len(start):
        return None
    name, place, ident = anchors_of(h, doc, start, whole, size)
    value, pos, row = whole[start], offset[start], doc[start]
    order = np.argsort(value, kind="stable")  # the texts of a block come by key
    later = np.zeros(len(start), bool)
    later[order] = settle(value[order], doc_ids[row[order]], pos[order])
    gone = ranges_of(doc_ids[row[later]], tags[row[later]], pos[later], size)

    digest = np.maximum(value & DIGEST, np.uint64(1))
    digest[later] = 0
    new = np.concatenate(([True], (ident[1:] != ident[:-1]) | (start[1:] != start[:-1] + 1)))
    at = np.flatnonzero(new)
    live = np.add.reduceat(digest != 0, at) > 0
    segment = np.cumsum(new) - 1
    sent = live[segment]
    digest, segment, at = digest[sent], (np.cumsum(live) - 1)[segment[sent]], at[live]
    n = np.bincount(segment, minlength=len(at))
    ends = np.cumsum(1 + 6 * n)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    heads = ends - 1 - 6 * n
    data[heads] = place[at] - start[at]
    body = np.ones(len(data), bool)
    body[heads] = False
    data[body] = digest.view(np.uint8).reshape(-1, 8)[:, :6].ravel()
    packed = pa.Array.from_buffers(pa.binary(), len(at), [
        None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
    where = pos[at] << 32 | tags[row[at]]
    return (name[at].view(np.int64), doc_ids[row[at]], where, packed), gone


NAMES = ["name", "doc", "at", "windows"]
#: The first byte of a settled range; an anchor's offset in its window is less.
SETTLED = 255


def expanded(windows: list[bytes], size: int):
    """Each anchor's windows: the row, offsets of window starts from the first, anchor offsets, digests."""
    n = np.fromiter(((len(w) - 1) // 6 for w in windows), np.int64, len(windows))
    data = np.frombuffer(b"".join([w[1:] for w in windows]), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :6] = data
    row = np.repeat(np.arange(len(windows)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    head = np.fromiter((w[0] for w in windows), np.int64, len(windows))
    return row, step, head[row] - step, wide.view(np.uint64).ravel()


def removed_ranges(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """The word ranges to remove: ``doc``, ``tag`` (31 bits of the text's hash), ``begin``, ``end``."""

    def name_windows(batches):
        for block in text_blocks(batches):
            doc_ids = block.column("doc").to_numpy(zero_copy_only=False)
            order = np.argsort(doc_ids, kind="stable")
            raw = utf8(block)
            got = block_rows([raw[i] for i in order], doc_ids[order],
                             block.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)[order], size,
                             worker_cache("word_hashes_plain", REMEMBERED))
            if got is None:
                continue
            (name, doc, at, packed), (gdoc, gtag, begin, end) = got
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(doc), pa.array(at), packed], names=NAMES)
            if len(gdoc):
                spread = mix(gdoc.view(np.uint64) + begin.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spread), pa.array(gdoc), pa.array(begin << 32 | gtag),
                     pa.array([bytes([SETTLED]) + int(e).to_bytes(4, "little") for e in end], pa.binary())], names=NAMES)

    def settle_names(batches):
        """Rows come by name, then by place: of the name that goes on in the next batch only the windows' first places are kept."""
        held = None  # (name, kinds, docs, positions)
        for batch in batches:
            if len(batch):
                parts, held = settled(batch, held)
                if parts:
                    cols = [np.concatenate(c) for c in zip(*parts)]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["doc", "tag", "begin", "end"])

    def settled(rows, held):
        name, doc, at = (rows.column(c).to_numpy() for c in NAMES[:3])
        windows = rows.column("windows").to_pylist()
        own = np.fromiter((w[0] == SETTLED for w in windows), bool, len(windows))
        done = np.flatnonzero(own)
        parts = []
        if len(done):
            end = np.fromiter((int.from_bytes(windows[i][1:], "little") for i in done), np.int64, len(done))
            parts.append((doc[done], at[done] & 0x7FFFFFFF, at[done] >> 32, end))
        same = np.concatenate(([False], name[1:] == name[:-1]))
        some = same | np.append(same[1:], False) | (name == name[-1])
        if held is not None:
            some |= name == held[0]
        several = np.flatnonzero(some & ~own)
        if not len(several):
            return parts, held if held is not None and held[0] == name[-1] else None
        row, step, off, digest = expanded([windows[i] for i in several], size)
        row, step, off, digest = (x[digest != 0] for x in (row, step, off, digest))
        row = several[row]
        n, d, p, tag = name[row], doc[row], (at[row] >> 32) + step, at[row] & 0x7FFFFFFF
        kind = digest | off.astype(np.uint64) << np.uint64(48)
        if held is not None:
            n = np.append(n, np.full(len(held[1]), held[0]))
            kind, d, p = (np.append(x, y) for x, y in zip((kind, d, p), held[1:]))
            tag = np.append(tag, np.full(len(held[1]), -1))
        order = np.lexsort((p, d, kind, n))
        n, kind, d, p, tag = (x[order] for x in (n, kind, d, p, tag))
        new = np.concatenate(([True], (kind[1:] != kind[:-1]) | (n[1:] != n[:-1])))
        gone = settle(np.cumsum(new), d, p) & (tag >= 0)
        if gone.any():
            parts.append(ranges_of(d[gone], tag[gone], p[gone], size))
        first = new & (n == name[-1])
        return parts, (name[-1], kind[first], d[first], p[first])

    rows = docs.select(F.coalesce(docs[key].cast("long"), F.lit(int(LAST))).alias("doc"), tag_of(docs, text).alias("tag"),
                       docs[text].alias("text"))
    named_rows = rows.mapInArrow(name_windows, "name long, doc long, at long, windows binary")
    return named_rows.repartition("name").sortWithinPartitions("name", "doc", "at").mapInArrow(
        settle_names, "doc long, tag long, begin long, end long")


def tag_of(docs: DataFrame, text: str):
    return F.xxhash64(docs[text]).bitwiseAND(0x7FFFFFFF)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """Per document row: ``key``, ``n_words``, ``n_removed`` and ``kept``, the words that stay joined by a space.

    Windows are judged on the input; the earliest is that of the smallest key (an integer), then of the
    smallest position.
    """
    if not 2 <= window < 200:
        raise ValueError("window must be between 2 and 199 words")
    ranges = removed_ranges(docs, key, text, window).groupBy("doc", "tag").agg(
        F.collect_list(F.struct("begin", "end")).alias("ranges"))
    rows = docs.select(docs[key].cast("long").alias("key"), F.coalesce(docs[key].cast("long"), F.lit(int(LAST))).alias("doc"),
                       tag_of(docs, text).alias("tag"), docs[text].alias("text"))

    def apply(batches):
        for block in text_blocks(batches):
            total, gone, kept = [], [], []
            for t, ranges in zip(utf8(block), block.column("ranges").to_pylist()):
                words = t.split()
                total.append(len(words))
                if ranges:
                    stays = np.ones(len(words), bool)
                    for r in ranges:
                        stays[r["begin"]:r["end"]] = False
                    words = [words[i] for i in np.flatnonzero(stays)]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=["key", "n_words", "n_removed", "kept"])

    out = rows.join(ranges, ["doc", "tag"], "left").select("key", "text", "ranges").mapInArrow(
        apply, "key long, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("key", key)
