"""Suffix-array dedup by distributed prefix doubling: long byte strings that occur twice go.

Positions. A window is a string of ``length`` bytes. The least hash of its first ``GAP`` short strings
(the leftmost of equals) is its anchor, a position that the window's bytes alone determine;
one byte in some eighty is an anchor. The windows of one anchor lie side by side: their union is its stretch.

Doubling. An anchor's first rank is the name of its first ``SHORT`` bytes. In each round Spark sorts
(rank, name of the following bytes) pairs by range; equal neighbours get a common new rank, an anchor that
is alone leaves. Names are hashes of content, so a rank is the same in every partition; ties are broken by
place, so a pair that a third of all positions share is spread over ranges, and what stands at the edge
of a range stays in. The offsets grow by SHORT, 2 * SHORT and past the threshold, to the whole stretch.
A stretch that occurs twice is removed whole.

Rest. Where surroundings differ, stretches differ though some of their windows are equal. The lone
stretches of a rank and, for each repeated one, an occurrence at the edge of its run send the names of
their windows; equal names under one rank are repeated windows. Ranks with many such rows are split by name.

All occurrences are removed, the first included, so equal texts have equal results: a
text is known by 81 hash bits, and texts that can't have a repeat aren't shuffled.

Names have 64 bits beside a rank's 64. Defined results: a null text is empty; null
and repeated keys are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import bit_table, has_bit, stored, text_blocks, utf8, worker_cache

#: Text bytes that a task hashes at a time, at some 90 bytes of arrays each; longer texts are taken in overlapping pieces.
PIECE = 1 << 19
#: Slots of the table of texts that may have a repeat, and of the counts of ranks.
TEXT_SLOTS = 1 << 26
RANK_SLOTS = 1 << 16
#: Rows of a rank that one task compares; a rank with more is split by window names.
TOGETHER = 20_000
PLACE = np.uint64((1 << 24) - 1)
BASE = 0x9E3779B97F4A7C15 | 1
#: A fixed random number for each byte value.
BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


class Names:
    """Names of any substrings of a text in two steps each: a polynomial over 64-bit numbers, by prefix sums."""

    def __init__(self, text: bytes):
        raw = np.frombuffer(text, np.uint8)
        cache = worker_cache("suffix_powers")
        if len(cache.get("up", ())) <= len(raw):
            n = max(len(raw) + 1, PIECE + 4096)
            for side, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                cache[side] = np.cumprod(powers)
        self.down = cache["down"]
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTES[raw] * cache["up"][:len(raw)], out=self.sums[1:])

    def __call__(self, begin, end) -> np.ndarray:
        """The names of [begin, end), arrays or slices of equal length."""
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])


def without_runs(piece, first, last, one, two, stretch):
    """Periodic text has an anchor per period, with equal stretches side by side; they are repeated by themselves.

    The first two of such a run stay; the windows of the others are taken together, and each such row is given
    twice, so that it counts as repeated. Gives the row, its first and last window and a mark of the rows taken together.
    """
    same = np.concatenate(([False], (first[1:] == last[:-1] + 1) & (piece[1:] == piece[:-1]) & (one[1:] == one[:-1])
                           & (two[1:] == two[:-1]) & (stretch[1:] == stretch[:-1])))
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))  # each row's run
    third = np.arange(len(same)) - begin >= 2
    if not third.any():
        return np.arange(len(same)), first, last, np.zeros(len(same), np.uint64)
    single, rows = np.flatnonzero(~third), np.flatnonzero(third)
    chunk = (first[rows] - first[begin[rows]]) // 95  # at most 255 windows after a row's first
    new = np.flatnonzero(np.concatenate(([True], (chunk[1:] != chunk[:-1]) | (begin[rows][1:] != begin[rows][:-1]))))
    end = rows[np.append(new[1:], len(rows)) - 1]
    merged = np.repeat(rows[new], 2)
    return (np.concatenate((single, merged)), np.concatenate((first[single], first[merged])),
            np.concatenate((last[single], np.repeat(last[end], 2))),
            np.concatenate((np.zeros(len(single), np.uint64), np.repeat(1 + chunk[new], 2).astype(np.uint64))))


class Shape:
    """The lengths that follow from the threshold."""

    def __init__(self, length: int):
        if not 16 <= length <= 250:
            raise ValueError("length must be between 16 and 250 bytes")
        self.length, self.short = length, max(4, length // 10)
        self.gap = length - 2 * self.short + 1  # an anchor is followed by 2 * short bytes of each of its windows

    def anchors(self, pieces: list[bytes]):
        """For each anchor: its piece, its first and last window and its place, and three names."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = np.cumsum(size) - size
        names = Names(b"".join(pieces))
        n = int(size.sum())
        k = self.short
        grams = names(slice(0, n - k + 1), slice(k, n + 1))
        low = grams & ~PLACE | np.arange(len(grams), dtype=np.uint64)
        step = 1
        while 2 * step <= self.gap:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        low = np.minimum(low[:len(low) - self.gap + step], low[self.gap - step:])
        windows = np.maximum(size - self.length + 1, 0)
        piece = np.repeat(np.arange(len(pieces)), windows)
        start = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[piece]
        anchor = (low[start] & PLACE).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]))))
        piece, first, last, anchor = piece[new], start[new], start[np.append(new[1:], len(start)) - 1], anchor[new]
        stretch = mix(names(first, last + self.length) + (anchor - first).astype(np.uint64))
        one, two = grams[anchor], grams[anchor + k]
        row, first, last, again = without_runs(piece, first, last, one, two, stretch)
        piece, anchor, one, two, stretch = (x[row] for x in (piece, anchor, one, two, stretch))
        at = begin[piece]
        return piece, first - at, last - at, anchor - at, one, two, stretch + again


def pieces_of(batches, length: int):
    """Lists of (h, tag, offset, bytes): texts, or pieces of them that share ``length`` - 1 bytes."""
    out, held = [], 0
    for block in text_blocks(batches, block_bytes=PIECE):
        for h, tag, raw in zip(block.column("h").to_pylist(), block.column("tag").to_pylist(), utf8(block)):
            for at in range(0, max(len(raw) - length + 1, 0), PIECE):
                piece = raw[at:at + PIECE + length - 1]
                if held and held + len(piece) > PIECE + 4095:
                    yield out
                    out, held = [], 0
                out.append((h, tag, at, piece))
                held += len(piece)
    if out:
        yield out


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def packed(first, tag, last, anchor) -> np.ndarray:
    """Where a stretch lies in 64 bits: its first window, the text's tag, the windows after the first, the anchor's offset."""
    first, tag, wide, off = (x.astype(np.uint64) for x in (first, tag, last - first, anchor - first))
    return first << np.uint64(33) | tag << np.uint64(16) | wide << np.uint64(8) | off


def unpacked(at: np.ndarray):
    at = at.view(np.uint64)
    part = lambda shift, bits: (at >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64)
    return part(33, 31), part(16, 17), part(8, 8), part(0, 8)


def neighbours(batches, keys: list[str]):
    """Sorted record batches with how many leading keys each row shares with the row before and after; -1 at an edge."""

    def shared(a, b):
        out = np.zeros(len(a[0]), np.int64)
        same = np.ones(len(a[0]), bool)
        for x, y in zip(a, b):
            same &= x == y
            out += same
        return out

    held, before = None, None  # the last row waits for the one after it
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        cols = [rows.column(k).to_numpy() for k in keys]
        inner = shared([c[1:] for c in cols], [c[:-1] for c in cols])
        prev = np.concatenate(([-1 if before is None else before], inner))
        if len(rows) > 1:
            yield rows.slice(0, len(rows) - 1), prev[:-1], inner
        held, before = rows.slice(len(rows) - 1).to_batches()[0], int(prev[-1])
    if held is not None:
        yield pa.Table.from_batches([held]), np.array([before]), np.array([-1])


def sorted_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    order = [*keys, "h", "at"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def ranked(rows: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    """One round: what shares its (rank, name) keys with a neighbour gets the common ``rank``; the others leave."""

    def run(batches):
        for table, prev, after in neighbours(batches, keys):
            keep = (prev == len(keys)) | (after == len(keys)) | (prev < 0) | (after < 0)
            if not keep.any():
                continue
            table = table.filter(pa.array(keep))
            rank = table.column(keys[0]).to_numpy().view(np.uint64)
            for k in keys[1:]:
                rank = mix(rank * np.uint64(3) + table.column(k).to_numpy().view(np.uint64))
            for b in pa.table([signed(rank), *(table.column(c) for c in rest)], names=["rank", *rest]).to_batches():
                yield b

    return sorted_by(rows, keys).mapInArrow(run, ", ".join(f"{c} long" for c in ["rank", *rest]))


def stretches(rows: DataFrame) -> DataFrame:
    """The last round: ``settled`` stretches occur twice; ``open`` ones send their windows."""

    def run(batches):
        for table, prev, after in neighbours(batches, ["rank", "stretch"]):
            settled = (prev == 2) | (after == 2)
            beside = (prev == 1) | (after == 1) | (prev < 0) | (after < 0)
            for b in pa.table([table.column("rank"), table.column("h"), table.column("at"), pa.array(settled),
                               pa.array(~settled | beside)], names=["rank", "h", "at", "settled", "open"]).to_batches():
                yield b

    return sorted_by(rows, ["rank", "stretch"]).mapInArrow(run, "rank long, h long, at long, settled boolean, open boolean")


def first_of(at):
    return F.shiftrightunsigned(at, 33)


def tag_in(at):
    return F.shiftrightunsigned(at, 16).bitwiseAND(0x1FFFF)


def texts_of(docs: DataFrame, text: str, *more) -> DataFrame:
    """``more``, the text and its key: a 64-bit hash ``h`` and 17 bits of another, ``tag``."""
    return docs.select(*more, docs[text].alias("text"), F.xxhash64(docs[text]).alias("h"),
                       F.hash(docs[text]).bitwiseAND(0x1FFFF).cast("long").alias("tag"))


def passing(rows: DataFrame, bits, wanted: bool) -> DataFrame:
    """The rows whose text's bit is as ``wanted``."""

    def run(batches):
        for batch in batches:
            at = batch.column("h").to_numpy().view(np.uint64) % np.uint64(TEXT_SLOTS)
            yield batch.filter(pa.array(has_bit(bits.value, at.astype(np.int64)) == wanted))

    return rows.mapInArrow(run, rows.schema)


def repeated_ranges(docs: DataFrame, text: str, length: int):
    """``h``, ``tag`` and ``ranges`` of each text with a repeat, and the bits of texts that may have one."""
    shape = Shape(length)
    rows = texts_of(docs, text)

    def scan(batches):
        for held in pieces_of(batches, length):
            piece, first, last, anchor, one, two, whole = shape.anchors([x[3] for x in held])
            h, tag, base = (np.array(x, np.int64)[piece] for x in list(zip(*held))[:3])
            yield pa.RecordBatch.from_arrays(
                [signed(one), signed(two), signed(whole), pa.array(h), signed(packed(first + base, tag, last + base, anchor + base))],
                names=["one", "two", "stretch", "h", "at"])

    places = rows.mapInArrow(scan, "one long, two long, stretch long, h long, at long")
    twice = ranked(places, ["one"], ["two", "stretch", "h", "at"])
    twice = ranked(twice, ["rank", "two"], ["stretch", "h", "at"])
    ends = stored(stretches(twice), "stretches")
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(
        ends.select(F.pmod(F.col("h"), F.lit(TEXT_SLOTS)).alias("slot")), TEXT_SLOTS))
    whole = ends.where("settled").select(
        "h", tag_in("at").alias("tag"), first_of("at").alias("begin"),
        (first_of("at") + F.shiftrightunsigned("at", 8).bitwiseAND(0xFF) + length).alias("end"))
    parts = repeated_windows(passing(rows, bits, True), ends.where("open"), shape)
    # equal texts send equal ranges: sets, combined before the shuffle
    return whole.unionByName(parts).groupBy("h", "tag").agg(F.collect_set(F.struct("begin", "end")).alias("ranges")), bits


def repeated_windows(rows: DataFrame, ends: DataFrame, shape: Shape) -> DataFrame:
    """``h``, ``tag``, ``begin`` and ``end`` of windows that are equal under one rank, of lone stretches only."""
    slot = F.pmod(F.col("rank"), F.lit(RANK_SLOTS))
    many = dict(map(tuple, ends.groupBy(slot.alias("slot")).count().where(F.col("count") > TOGETHER).collect()))
    split = {k: 1 + n // TOGETHER for k, n in many.items()}
    asked = ends.groupBy("h", tag_in("at").alias("tag")).agg(F.collect_set(F.struct("rank", "at", "settled")).alias("ends"))
    length = shape.length

    def name_windows(batches):
        for block in text_blocks(batches):
            for h, raw, ends in zip(block.column("h").to_pylist(), utf8(block), block.column("ends").to_pylist()):
                for i in range(0, len(ends), 4096):
                    yield named(h, raw, ends[i:i + 4096])

    def named(h, raw, ends):
        at = np.array([e["at"] for e in ends], np.int64)
        first, _, wide, off = unpacked(at)
        size = wide + length
        begin = np.cumsum(size) - size
        names = Names(b"".join([raw[f:f + s] for f, s in zip(first.tolist(), size.tolist())]))
        row = np.repeat(np.arange(len(at)), wide + 1)
        step = np.arange(len(row)) - np.repeat(np.cumsum(wide + 1) - wide - 1, wide + 1)
        start = begin[row] + step
        name = mix(names(start, start + length) + (off[row] - step).astype(np.uint64))
        rank, bucket, ats, settled, steps, all_names = [], [], [], [], [], []
        for e, lo, n in zip(ends, (np.cumsum(wide + 1) - wide - 1).tolist(), (wide + 1).tolist()):
            mine, where = name[lo:lo + n], step[lo:lo + n].astype(np.uint8)
            buckets = split.get(e["rank"] % RANK_SLOTS, 1)
            of = (mine % np.uint64(buckets)).astype(np.int64) if buckets > 1 else None
            for b in range(buckets) if of is None else np.unique(of).tolist():
                chosen = slice(None) if of is None else of == b
                rank.append(e["rank"])
                bucket.append(b)
                ats.append(e["at"])
                settled.append(e["settled"])
                steps.append(where[chosen].tobytes())
                all_names.append(mine[chosen].tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(rank, pa.int64()), pa.array(bucket, pa.int32()), pa.array([h] * len(rank), pa.int64()), pa.array(ats, pa.int64()),
             pa.array(settled), pa.array(steps, pa.binary()), pa.array(all_names, pa.binary())],
            names=["rank", "bucket", "h", "at", "settled", "steps", "names"])

    def compare(batches):
        held, of = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != of:
                    yield from compared(held)
                    held, of = [], row[:2]
                held.append(row[2:])
        yield from compared(held)

    def compared(rows):
        if len(rows) < 2 or all(r[2] for r in rows):
            return
        count = np.fromiter((len(r[3]) for r in rows), np.int64, len(rows))
        row = np.repeat(np.arange(len(rows)), count)
        step = np.frombuffer(b"".join([r[3] for r in rows]), np.uint8).astype(np.int64)
        name = np.frombuffer(b"".join([r[4] for r in rows]), np.uint64)
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        twice = np.zeros(len(name), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= ~np.array([r[2] for r in rows])[row]
        row, step = row[twice], step[twice]
        if not len(row):
            return
        new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1))))
        first, tag, _, _ = unpacked(np.array([r[1] for r in rows], np.int64))
        h = np.array([r[0] for r in rows], np.int64)
        at, last = row[new], step[np.append(new[1:], len(step)) - 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[at]), pa.array(tag[at]), pa.array(first[at] + step[new]), pa.array(first[at] + last + length)],
            names=["h", "tag", "begin", "end"])

    once = rows.dropDuplicates(["h", "tag"]).join(asked, ["h", "tag"]).select("h", "text", "ends")
    windows = once.mapInArrow(name_windows, "rank long, bucket int, h long, at long, settled boolean, steps binary, names binary")
    return (windows.repartition("rank", "bucket").sortWithinPartitions("rank", "bucket")
            .mapInArrow(compare, "h long, tag long, begin long, end long"))


SPANS = "array<struct<begin:long,end:long>>"


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """Per document row: ``key``, ``n_bytes``, ``n_removed``, the removed ``spans`` and ``kept``, the bytes that stay.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in any document.
    """
    ranges, bits = repeated_ranges(docs, text, length)
    rows = texts_of(docs, text, docs[key].alias("key"))
    found = passing(rows, bits, True).join(ranges, ["h", "tag"], "left").select("key", "text", "ranges")
    clean = passing(rows, bits, False).select("key", "text", F.lit(None).cast(SPANS).alias("ranges"))

    def apply(batches):
        for block in text_blocks(batches):
            total, gone, spans, kept = [], [], [], []
            for raw, ranges in zip(utf8(block), block.column("ranges").to_pylist()):
                runs = []
                for b, e in sorted((r["begin"], r["end"]) for r in ranges or ()):
                    if runs and b <= runs[-1]["end"]:
                        runs[-1]["end"] = max(e, runs[-1]["end"])
                    else:
                        runs.append({"begin": b, "end": e})
                cuts = [0, *(x for r in runs for x in (r["begin"], r["end"])), len(raw)]
                rest = b"".join([raw[b:e] for b, e in zip(cuts[::2], cuts[1::2])])
                total.append(len(raw))
                gone.append(len(raw) - len(rest))
                spans.append(runs)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["key", "n_bytes", "n_removed", "spans", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    out = found.unionByName(clean).mapInArrow(apply, f"key {kind}, n_bytes long, n_removed long, spans {SPANS}, kept binary")
    return out.withColumnRenamed("key", key)
