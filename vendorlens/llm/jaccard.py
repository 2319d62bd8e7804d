"""N-gram Jaccard join by vertical partitioning.

Texts are sets of word shingles. The space of shingles is cut into ranges; every set falls
into its parts, and each range by itself counts which shingles of a set also occur in
another set. Summed over the ranges this bounds the overlap that a set can have with any
other: only sets with enough shared shingles go on (copies and texts made of common
passages). Among these one global order holds, rarer shingles first. Two sets that reach
the threshold share a shingle among the first of each (its prefix), which gives
candidates. The order is cut into fragments of like weight, the overlap of a candidate
pair is counted in every fragment by itself, and the counts are summed per pair.

Equal sets are one class from the start. Candidates are first the pairs of one class of
each prefix shingle, another in every round, with the others of its list; when that
stops joining components, all pairs of a list that lie in different components. So a group
of many near copies isn't expanded into all its pairs, and no link that joins two
components is missed. Before a pair's overlap is counted, the signatures of its sets bound it: a bit of a signature is the parity of a
set's shingles there, so two signatures differ in no more bits than their sets in shingles. Where all pairs of a list are looked at, the rows
of the lists bring their signatures, so that a pair they rule out is never a row. ``all_links`` verifies all candidate pairs instead and returns
every link.

Shingles are 64-bit hashes and a class is known by a 64-bit digest of its set. What is
broadcast has a fixed size: the order's sketch (``2**SKETCH_BITS`` bytes) and a filter of
``2**FILTER_BITS`` bits; at any corpus size both only choose work, not results.

Defined results: a null or empty text has an empty set, which is linked with nothing;
a text of fewer words than a shingle is one shingle; rows with a null key are classes
as others are but never name a component; repeated rows are copies of one another.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import as_sql_type, stored, text_blocks, utf8, worker_cache
from vendorlens.llm.components import components

SKETCH_BITS = 22
FILTER_BITS = 24
#: Classes of other components that a class is compared with in a round.
HUBS = 6
#: The sketch travels in this many parts.
PARTS = 64
FRAGMENTS = 4
#: Bits of a set's signature.
SIGNATURE = 1024
REMEMBERED = 300_000


def shingle_sets(raw: list[bytes], words: int, known: dict[bytes, int]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z in lower case)."""
    split = [t.lower().split() for t in raw]
    for w in {w for x in split for w in x}.difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    out = []
    for x in split:
        h = np.fromiter(map(known.__getitem__, x), np.uint64, len(x))
        k = min(words, len(h))
        g = np.full(len(h) - k + 1 if k else 0, k, np.uint64)
        for i in range(k):
            g = (g ^ h[i:len(h) - k + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
            g ^= g >> np.uint64(32)
        g.sort()
        out.append(g[np.diff(g, prepend=~g[:1]) != 0])
    return out


def class_of(s: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None


def slots(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


#: Ranges of the shingle space in the first count.
RANGES = 1024
#: The row of a document itself goes to no range.
MEMBER = -1


def packed(hashes: np.ndarray, owner: np.ndarray, nodes: np.ndarray) -> bytes:
    """Sorted hashes as byte planes of their differences, the owners' numbers and the owners."""
    gaps = np.diff(hashes, prepend=np.uint64(0))
    own, number = np.unique(owner, return_inverse=True)
    head = np.array([len(hashes), len(own)], np.int64).tobytes()
    return b"".join((head, np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(),
                     number.astype(np.uint32 if len(own) > 65535 else np.uint16).tobytes(), nodes[own].tobytes()))


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and the node of each."""
    n, m = np.frombuffer(blob, np.int64, 2)
    gaps = np.ascontiguousarray(np.frombuffer(blob, np.uint8, 8 * n, 16).reshape(8, n).T).view(np.uint64).ravel()
    kind = np.dtype(np.uint32 if m > 65535 else np.uint16)
    number = np.frombuffer(blob, kind, n, 16 + 8 * n)
    nodes = np.frombuffer(blob, np.int64, m, 16 + (8 + kind.itemsize) * n)
    return np.cumsum(gaps, dtype=np.uint64), nodes[number]


def shared_counts(hashes: np.ndarray, nodes: np.ndarray, sure: np.ndarray):
    """The nodes with shingles that another node has too, and how many.

    Rows in ``sure`` are of node 0 and only tell that several other nodes have the shingle.
    """
    order = np.lexsort((nodes, hashes))
    h, n, sure = hashes[order], nodes[order], sure[order]
    again = np.concatenate(([False], (h[1:] == h[:-1]) & (n[1:] == n[:-1]) & ~sure[1:] & ~sure[:-1]))
    h, n, sure = h[~again], n[~again], sure[~again]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    size = np.diff(np.append(first, len(h)))
    several = np.repeat((size > 1), size) & ~sure
    found, count = np.unique(n[several], return_counts=True)
    return found, count


def describe(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """One pass over the texts. A row per document (``key``, ``n``, ``node``) and, with ``shared`` set, rows
    that sum to the number of a node's shingles that other nodes have as well.

    A task settles a block of texts by itself: of a shingle that several nodes of the block
    have, it counts these and sends on one row for all, so a passage that all documents share is one row a block.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType
    kind = as_sql_type(docs, key)
    key_type = to_arrow_type(StructType.fromDDL(f"key {kind}")["key"].dataType)  # as tasks get it: any part of a key may be null
    names = ["range", "key", "n", "node", "shared", "blob"]

    def rows(size, **columns):
        kinds = {"range": pa.int32(), "key": key_type, "n": pa.int64(), "node": pa.int64(), "shared": pa.int64(), "blob": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[c]) if c in columns else pa.nulls(size, kinds[c]) for c in names],
                                          names=names)

    def cut_up(batches):
        seen = set()  # classes that this task has sent already
        for block in text_blocks(batches):
            sets = shingle_sets(utf8(block), words, worker_cache("word_hashes", REMEMBERED))
            nodes = [class_of(s) for s in sets]
            spread = [(x or i) % RANGES for i, x in enumerate(nodes)]
            yield rows(len(sets), range=[MEMBER - x for x in spread], key=block.column("key"), n=[len(s) for s in sets], node=nodes)
            own = {x: s for x, s in zip(nodes, sets) if x is not None and x not in seen}
            seen.update(own)
            if not own:
                continue
            nodes = np.fromiter(own, np.int64, len(own))
            owner = np.repeat(np.arange(len(own)), [len(s) for s in own.values()])
            hashes = np.concatenate(list(own.values()))
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            size = np.diff(np.append(first, len(hashes)))
            local = np.repeat(size > 1, size)
            count = np.bincount(owner[local], minlength=len(own))
            some = np.flatnonzero(count)
            yield rows(len(some), range=[MEMBER - int(x) % RANGES for x in nodes[some]], node=nodes[some], shared=count[some])
            known = hashes[first[size > 1]]
            lone, lone_owner = hashes[~local], owner[~local]
            width = np.uint64(64 - int(RANGES).bit_length() + 1)
            edges = np.arange(1, RANGES, dtype=np.uint64) << width
            parts = zip(np.split(lone, a := np.searchsorted(lone, edges)), np.split(lone_owner, a), np.split(known, np.searchsorted(known, edges)))
            out = [(r, packed(h, o, nodes), k.tobytes()) for r, (h, o, k) in enumerate(parts) if len(h) or len(k)]
            yield rows(2 * len(out), range=[r for r, _, _ in out for _ in "ab"], n=[x for _ in out for x in (0, 1)],
                       blob=[x for _, h, k in out for x in (h, k)])

    def settle(batches):
        at, held = None, []
        for batch in batches:
            where = batch.column("range").to_pylist()
            own = np.array([r < 0 for r in where], bool)
            if own.any():
                yield batch.filter(pa.array(own)).select(["key", "n", "node", "shared"])
            for r, kind, blob in zip(where, batch.column("n").to_pylist(), batch.column("blob").to_pylist()):
                if r < 0:
                    continue
                if r != at:
                    yield from counted(held)
                    at, held = r, []
                held.append((kind, blob))
        yield from counted(held)

    def counted(held):
        if not held:
            return
        pairs = [unpacked(b) for k, b in held if k == 0]
        known = [np.frombuffer(b, np.uint64) for k, b in held if k == 1]
        several = np.concatenate(known)
        hashes = np.concatenate([h for h, _ in pairs] + [several, several])  # twice: more than one node has it
        nodes = np.concatenate([n for _, n in pairs] + [np.zeros(2 * len(several), np.int64)])
        sure = np.concatenate([np.zeros(len(hashes) - 2 * len(several), bool), np.ones(2 * len(several), bool)])
        found, count = shared_counts(hashes, nodes, sure)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.nulls(len(found), key_type), pa.nulls(len(found), pa.int64()), pa.array(found), pa.array(count, pa.int64())],
                                             names=["key", "n", "node", "shared"])

    cut = docs.select(docs[key].cast(kind).alias("key"), docs[text].alias("text")).mapInArrow(
        cut_up, f"range int, key {kind}, n long, node long, shared long, blob binary")
    return cut.repartition("range").sortWithinPartitions("range").mapInArrow(settle, f"key {kind}, n long, node long, shared long")


class Order:
    """The global order: a frequency class for each slot, and where fragments are cut."""

    def __init__(self, counts: np.ndarray):
        self.level = np.minimum(16 * np.log2(1.0 + counts), 255).astype(np.uint8)
        mass = np.bincount(self.level, weights=counts, minlength=256)
        self.before = np.concatenate(([0.0], np.cumsum(mass)[:-1])) / max(mass.sum(), 1)
        self.share = mass / max(mass.sum(), 1)

    def prefix(self, s: np.ndarray, size: int) -> np.ndarray:
        return s[np.lexsort((s, self.level[slots(s)]))[:size]]

    def fragment(self, s: np.ndarray) -> np.ndarray:
        level = self.level[slots(s)]
        at = self.before[level] + self.share[level] * (s.astype(np.float64) / 2.0 ** 64)
        return np.minimum((at * FRAGMENTS).astype(np.int64), FRAGMENTS - 1)


def wanted_sets(docs: DataFrame, wanted, text: str, words: int) -> DataFrame:
    """The shingle sets of the classes in the filter: ``node``, ``grams``, ``sig``; a task writes a class once."""

    def run(batches):
        done = set()
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).astype(bool)
        for block in text_blocks(batches):
            nodes, sets = [], []
            for s in shingle_sets(utf8(block), words, worker_cache("word_hashes", REMEMBERED)):
                node = class_of(s)
                if node is not None and node not in done and bits[(node & (1 << 64) - 1) >> 64 - FILTER_BITS]:
                    done.add(node)
                    nodes.append(node)
                    sets.append(s)
            yield from set_batches(nodes, sets)

    return docs.select(docs[text].alias("text")).mapInArrow(run, "node long, grams binary, sig array<long>")


def signature(s: np.ndarray) -> np.ndarray:
    """The parities of the shingles by the last bits of their hashes, in 64-bit numbers."""
    odd = np.bincount((s & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def set_batches(nodes, sets):
    for i in range(0, len(nodes), 1000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i:i + 1000], pa.int64()),
                                          pa.array([s.tobytes() for s in sets[i:i + 1000]], pa.binary()),
                                          pa.array([signature(s) for s in sets[i:i + 1000]], pa.list_(pa.int64()))], names=["node", "grams", "sig"])


def sets_of(batch):
    return zip(batch.column("node").to_pylist(), (np.frombuffer(x, np.uint64) for x in batch.column("grams").to_pylist()))


def count_sketch(sets: DataFrame) -> np.ndarray:
    """How many sets have a shingle in each slot; tasks add up their counts, then a stream for each part does."""

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            grams = [s for _, s in sets_of(batch)]
            if grams:
                at, n = np.unique(slots(np.concatenate(grams)), return_counts=True)
                total[at] += n.astype(np.uint32)
        if total.any():
            cut = np.split(np.minimum(total, 65535).astype("<u2"), PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for c in cut], pa.binary())],
                                             names=["part", "counts"])

    def add(batches):
        total = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                c = np.frombuffer(zlib.decompress(counts), "<u2")
                total[part] = total.get(part, 0) + c.astype(np.int64)
        for part, c in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([np.minimum(c, 2 ** 32 - 1).astype("<u4").tobytes()], pa.binary())],
                names=["part", "counts"])

    schema = "part int, counts binary"
    parts = sets.mapInArrow(count, schema).repartition(PARTS, "part").mapInArrow(add, schema).collect()  # PARTS rows of fixed size
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    width = len(out) // PARTS
    for p in parts:
        out[p["part"] * width:(p["part"] + 1) * width] = np.frombuffer(p["counts"], "<u4")
    return out


def prefixes(sets: DataFrame, order, num: int, den: int) -> DataFrame:
    """The prefix shingles of each class, their places in it and its size: ``h``, ``node``, ``pos``, ``n``."""

    def run(batches):
        for batch in batches:
            got = [(node, order.value.prefix(s, len(s) - -(-len(s) * num // den) + 1), len(s)) for node, s in sets_of(batch)]
            if got:
                size = [len(p) for _, p, _ in got]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p for _, p, _ in got]).view(np.int64)),
                     pa.array(np.repeat(np.array([n for n, _, _ in got], np.int64), size)),
                     pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in size])),
                     pa.array(np.repeat(np.array([n for _, _, n in got], np.int32), size))], names=["h", "node", "pos", "n"])

    return sets.mapInArrow(run, "h long, node long, pos int, n int")


def filter_of(nodes: DataFrame) -> np.ndarray:
    """A bit for each node at its hash, built in a few streaming tasks."""

    def run(batches):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[batch.column("node").to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], names=["bits"])

    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for row in nodes.select("node").repartition(4, "node").mapInArrow(run, "bits binary").collect():
        out |= np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return np.unpackbits(out).astype(bool)


def segments(sets: DataFrame, order) -> DataFrame:
    """The segments of each class in the fragments of the order: ``node``, ``fragment``, ``grams``."""

    def run(batches):
        for batch in batches:
            rows = []
            for node, s in sets_of(batch):
                f = order.value.fragment(s)
                by = np.argsort(f, kind="stable")
                for part in np.split(by, np.flatnonzero(np.diff(f[by])) + 1):
                    rows.append((node, int(f[part[0]]), s[part].view(np.int64)))
            for i in range(0, len(rows), 2000):
                node, fragment, grams = zip(*rows[i:i + 2000])
                at = np.concatenate(([0], np.cumsum([len(g) for g in grams])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(fragment, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(grams)))],
                    names=["node", "fragment", "grams"])

    return sets.mapInArrow(run, "node long, fragment int, grams array<long>")


class Join:
    """The state of one join over ``docs``: its classes, prefix index and verifier."""

    def __init__(self, docs: DataFrame, key: str, text: str, words: int, num: int, den: int):
        self.num, self.den = num, den
        sc = docs.sparkSession.sparkContext
        described = stored(describe(docs, key, text, words), "shingles")
        self.rows = described.where("shared IS NULL").select("key", "n", "node")
        self.nodes = stored(self.rows.where("n > 0").groupBy("node").agg(
            F.min("n").alias("n"), F.min("key").alias("first")), "classes")
        shared = described.where("shared IS NOT NULL").groupBy("node").agg(F.sum("shared").alias("shared"))
        some = stored(self.nodes.join(shared, "node").where(den * F.col("shared") >= num * F.col("n")).select("node", "n"), "wanted")
        wanted = sc.broadcast(np.packbits(filter_of(some)).tobytes())
        sets = wanted_sets(docs, wanted, text, words).dropDuplicates(["node"])  # the same class in several tasks
        self.sets = stored(sets.join(some, "node").select("node", "n", "grams", "sig"), "sets")
        self.order = sc.broadcast(Order(count_sketch(self.sets)))
        index = stored(prefixes(self.sets, self.order, num, den), "prefixes")
        self.buckets = stored(self.matching(index, "node"), "buckets")
        self.segments = stored(segments(self.sets, self.order), "segments")

    def matching(self, rows: DataFrame, part: str) -> DataFrame:
        """The rows that may share their shingle, within the prefixes that ``all_pairs`` names, with one of another ``part``: sets of
        sizes n and m do if num * m is at most den * n less (num + den) * pos, and the same the other way round."""
        room = self.den * F.col("n").cast("long") - (self.num + self.den) * F.col("pos").cast("long")
        several = rows.groupBy("h").agg(F.min(part).alias("lo"), F.max(part).alias("hi"), F.min("n").cast("long").alias("least"), F.max(room).alias("most")).where(
            "lo <> hi").select("h", "least", "most")
        return rows.join(several, "h").where((self.num * F.col("least") <= room) & (self.num * F.col("n").cast("long") <= F.col("most"))).drop("least", "most")

    def reaches(self, overlap):
        return (self.num + self.den) * overlap >= self.num * (F.col("na") + F.col("nb"))

    def sized(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b, and ``c`` shared prefix shingles with their last places ``pa``, ``pb``) that may link, with
        their sizes: all shared shingles up to the last of them are counted, later ones are at most what is left; and the
        shingles of one set only are at least as many as the bits in which the signatures differ."""
        a, b = (self.sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}")) for x in "ab")
        most = F.col("c") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
        return pairs.join(a, "a").join(b, "b").where(self.reaches(F.least("na", "nb", most)) & self.alike()).select("a", "b", "na", "nb")

    def alike(self):
        """Whether the signatures ``sa`` and ``sb`` leave sets of sizes ``na`` and ``nb`` the chance of a link."""
        apart = F.expr(" + ".join(f"bit_count(sa[{i}] ^ sb[{i}])" for i in range(SIGNATURE // 64)))
        return (self.num + self.den) * apart <= (self.den - self.num) * (F.col("na").cast("long") + F.col("nb").cast("long"))

    def signed(self, mixed: DataFrame) -> DataFrame:
        """The rows of ``mixed`` with the signatures of their sets, ``sig``."""
        return mixed.join(self.sets.select("node", "sig"), "node")

    def mixed(self, labels: DataFrame | None) -> DataFrame:
        """The buckets that hold several components, with these: ``h``, ``node``, ``pos``, ``n``, ``root``."""
        if labels is None:  # each class is one
            return self.buckets.withColumn("root", F.col("node"))
        rows = self.buckets.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
        return stored(self.matching(rows, "root").select("h", "node", "pos", "n", "root"), "mixed")

    def star_pairs(self, mixed: DataFrame, number: int) -> DataFrame:
        """Each class with up to ``HUBS`` of other components: in every one of so many orders of the classes,
        the first of those that come first in its buckets."""
        orders = range(number * HUBS, (number + 1) * HUBS)
        hubs = mixed.groupBy("h").agg(*[F.min(F.struct(F.xxhash64(F.lit(k), "node").alias("turn"), "node", "root")).alias(f"hub{k}")
                                        for k in orders])
        met = mixed.join(hubs, "h").groupBy("node").agg(
            *[F.min(F.when(F.col("root") != F.col(f"hub{k}.root"), F.col(f"hub{k}"))).alias(f"hub{k}") for k in orders])
        each = met.select("node", F.explode(F.array(*[f"hub{k}.node" for k in orders])).alias("hub")).where("hub IS NOT NULL")
        pairs = each.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        return pairs.select("a", "b", F.lit(0).alias("c"), F.lit(-1).alias("pa"), F.lit(-1).alias("pb"))  # not counted

    def all_pairs(self, mixed: DataFrame) -> DataFrame:
        """All pairs of a bucket that lie in different components, with their shared prefix shingles.

        Two sets that reach the threshold with sizes na and nb have an overlap of at least some k, so they share a shingle
        among the first na - k + 1 of one and nb - k + 1 of the other: shorter prefixes than those
        that serve sets of any size, and none at all where the sizes differ too much. Nor are those pairs made whose
        signatures, where the rows have them, rule out a link."""
        cols = {"node": "", "root": "r", "pos": "p", "n": "n", "sig": "s"}
        a, b = (mixed.select("h", *[F.col(c).alias(f"{to}{x}") for c, to in cols.items() if c in mixed.columns]) for x in "ab")
        both = self.num + self.den
        shared = (F.expr(f"{both} * cast(na - pa as long) >= {self.num} * cast(na + nb as long)")
                  & F.expr(f"{both} * cast(nb - pb as long) >= {self.num} * cast(na + nb as long)"))
        if "sig" in mixed.columns:
            shared &= self.alike()
        return a.join(b, "h").where("a < b AND ra <> rb").where(shared).groupBy("a", "b").agg(
            F.count("*").alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs that reach the threshold: ``a``, ``b``, ``overlap``."""
        pairs = stored(self.sized(pairs), "pairs")
        a, b = (self.segments.select(F.col("node").alias(x), "fragment", F.col("grams").alias(f"g{x}")) for x in "ab")
        parts = pairs.join(a, "a").join(b, ["b", "fragment"]).select(
            "a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("part"))
        total = parts.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("overlap"))
        return stored(total.where(self.reaches(F.col("overlap"))).select("a", "b", "overlap"), "links")

    def connected(self) -> DataFrame:
        """``node`` and ``root`` of all classes that are linked with another one."""
        links, roots, number, last = None, None, 0, None
        while True:
            mixed = self.mixed(roots)
            kinds = mixed.groupBy("h", "root").agg(F.count("*").alias("m"))
            each = kinds.groupBy("h").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("mm"))
            row = each.agg(F.sum("m").alias("rows"), (F.sum(F.col("m") * F.col("m") - F.col("mm")) / 2).alias("pairs")).first()
            if not row["rows"]:
                break
            # no more pairs than rows, or the stars hardly join components any more: look at every pair
            finish = row["pairs"] <= row["rows"] or last is not None and row["pairs"] > 0.8 * last
            got = self.verify(self.all_pairs(self.signed(mixed)) if finish else self.star_pairs(mixed, number))
            links = got if links is None else links.union(got)
            roots = stored(components(_edges(links)), "roots")
            if finish:
                break
            last, number = row["pairs"], number + 1
        return roots


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    num: int = 4, den: int = 5) -> DataFrame:
    """Every document row with the component that links of Jaccard ``num / den`` or more make.

    Returns ``key``, ``n_shingles`` and ``component_id``, the smallest key reachable.
    """
    join = Join(docs, key, text, words, num, den)
    roots = join.connected()
    rooted = join.nodes
    rooted = (rooted.withColumn("root", F.col("node")) if roots is None
              else rooted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    member = rooted.join(ids, "root").select("node", "component_id")
    return join.rows.join(member, "node", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


def all_links(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
              num: int = 4, den: int = 5) -> tuple[DataFrame, DataFrame]:
    """Every link between classes (``a``, ``b``, ``overlap``) and the classes of the documents
    (``key``, ``n_shingles``, ``node``)."""
    join = Join(docs, key, text, words, num, den)
    return join.verify(join.all_pairs(join.signed(join.mixed(None)))), join.rows.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "node")
