"""Source divergence audit over a minimal acyclic transducer of the kept vocabulary.

1. Tasks count the documents of every term and language; terms are sorted by range over
   (lang, term), and each run of sorted terms makes a shard. A term of ``min_docs`` or more
   documents is kept.
2. Each shard's kept terms, read in order, build a minimal acyclic transducer whose output
   is the term's place in the order (the sum of the outputs along its path).
3. Text streams through the transducers for the counts of each (lang, source): a task cuts
   its words by the shards' first terms and sends each shard its distinct words with their
   numbers; there the words walk through the transducer all at once, a byte a step.
4. Per shard, the groups' rates (integers of a billionth, see ``rates``) give partial sums for every pair
   of sources and each group's best terms; ordinals order ties and are spelt out again by the transducer.

Shards are cut by terms seen, kept or not, so rare words spread too; their number is bounded by
2**16, and what is broadcast is the shortest start that parts each from the term before it. A task holds one shard's counts for the sources of one language:
their number times a shard's terms is bounded by ``CELLS`` until a shard is down to ``LEAST`` terms.
The report itself has a row per pair of sources.

Defined results: null text, lang and source count as ''; repeated rows count each; a language without
kept terms has pairs of value 0 and no terms; group without terms take part with a count of 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendorlens.llm.common import stored, text_blocks, utf8

BILLION = 1_000_000_000
#: Sources times terms that a task counts at a time.
CELLS = 1 << 22
LEAST, MOST = 256, 1 << 14
SHARDS = 1 << 16
#: Text bytes whose distinct words a task gathers before it sends them on.
GATHERED = 16 << 20
#: Byte to byte: A-Z in lower case, other ASCII but letters as spaces.
NORMAL = bytes(b if chr(b).isalpha() else 32 for b in range(128)).lower() + bytes(range(128, 256))


def shared_bytes(a: bytes, b: bytes) -> int:
    """The length of the longest common prefix."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


class Transducer:
    """Minimal acyclic transducer from sorted distinct terms to their ordinals.

    Edges lie sorted by (state, byte); ``target`` and ``output`` belong to them. A state's ``final`` says
    whether a term ends there. State 0 is the first one.
    """

    def __init__(self, key, target, output, final, n: int, depth: int):
        self.key, self.target, self.output, self.final, self.n, self.depth = key, target, output, final, n, depth

    @classmethod
    def build(cls, terms: list[bytes]):
        register: dict = {}
        done: list = []  # (final, ((byte, number of state), ...)) of each finished state
        path = [[False, []]]  # states of the last term that may still change
        last = b""

        def close(down_to: int):
            while len(path) > down_to + 1:
                final, edges = path.pop()
                state = (final, tuple(edges))
                number = register.get(state)
                if number is None:
                    number = register[state] = len(done)
                    done.append(state)
                path[-1][1][-1] = (path[-1][1][-1][0], number)

        for term in terms:
            shared = shared_bytes(term, last)
            close(shared)
            for byte in term[shared:]:
                path[-1][1].append((byte, -1))
                path.append([False, []])
            path[-1][0] = True
            last = term
        close(0)
        done.append((path[0][0], tuple(path[0][1])))
        below = []  # terms that end at or after each state
        for final, edges in done:
            below.append(final + sum(below[t] for _, t in edges))
        size = len(done)
        key, target, output = [], [], []
        for number in range(size - 1, -1, -1):  # the first state is finished last
            final, edges = done[number]
            skipped = int(final)
            for byte, t in edges:
                key.append((size - 1 - number) << 8 | byte)
                target.append(size - 1 - t)
                output.append(skipped)
                skipped += below[t]
        final = np.fromiter((f for f, _ in reversed(done)), bool, size)
        return cls(np.array(key, np.int64), np.array(target, np.int64), np.array(output, np.int64), final,
                   len(terms), max(map(len, terms), default=0))

    def dumped(self) -> bytes:
        head = np.array([len(self.key), len(self.final), self.n, self.depth], np.int64)
        return b"".join(x.tobytes() for x in (head, self.key, self.target, self.output, self.final))

    @classmethod
    def loaded(cls, raw: bytes):
        edges, states, n, depth = np.frombuffer(raw, np.int64, 4).tolist()
        key, target, output = np.frombuffer(raw, np.int64, 3 * edges, 32).reshape(3, edges)
        return cls(key, target, output, np.frombuffer(raw, bool, states, 32 + 24 * edges), n, depth)

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """Each word's ordinal, -1 if it isn't a term; all words take a step at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        out = np.full(len(words), -1, np.int64)
        live = np.flatnonzero(size <= self.depth)
        state, total, step = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64), 0
        while len(live):
            ended = size[live] == step
            there = ended & self.final[state]
            out[live[there]] = total[there]
            live, state, total = live[~ended], state[~ended], total[~ended]
            if not len(live) or not len(self.key):
                break
            key = state << 8 | text[begin[live] + step]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            on = self.key[at] == key
            live, state, total, step = live[on], self.target[at[on]], total[on] + self.output[at[on]], step + 1
        return out

    def term(self, ordinal: int) -> bytes:
        state, out = 0, bytearray()
        while True:
            if ordinal == 0 and self.final[state]:
                return bytes(out)
            lo, hi = np.searchsorted(self.key, [state << 8, state + 1 << 8])
            at = lo + int(np.searchsorted(self.output[lo:hi], ordinal, "right")) - 1
            out.append(int(self.key[at]) & 255)
            ordinal -= int(self.output[at])
            state = int(self.target[at])


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


def document_counts(rows: DataFrame) -> DataFrame:
    """``lang``, ``term`` and ``df``, the documents that hold it."""

    def count(batches):
        seen, held = defaultdict(Counter), 0

        def flush():
            for lang, df in seen.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(df)), pa.array(list(df), pa.binary()),
                                                  pa.array(list(df.values()), pa.int64())], names=["lang", "term", "df"])
            seen.clear()

        for block in text_blocks(batches):
            for lang, raw in zip(block.column("lang").to_pylist(), utf8(block)):
                seen[lang].update(set(words_of(raw)))
                held += len(raw)
            if held > GATHERED:
                yield from flush()
                held = 0
        yield from flush()

    return rows.mapInArrow(count, "lang string, term binary, df long").groupBy("lang", "term").agg(F.sum("df").alias("df"))


SHARD_COLUMNS = "lang string, first binary, n long, machine binary"


def shards_of(counts: DataFrame, min_docs: int, per_shard: int) -> DataFrame:
    """The shards with their first terms and transducers, numbered within their language in the order of terms."""

    def build(batches):
        lang, first, seen, kept, last = None, b"", 0, [], b""

        def shard():
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([first], pa.binary()), pa.array([len(kept)], pa.int64()),
                 pa.array([Transducer.build(kept).dumped()], pa.binary())], names=["lang", "first", "n", "machine"])

        for batch in batches:
            for new, term, df in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "df"))):
                if lang is not None and (new != lang or seen >= per_shard):
                    yield shard()
                    seen, kept = 0, []
                if seen == 0:  # the shortest start that parts the shard from the term before
                    lang, first = new, term if new != lang else term[:shared_bytes(term, last) + 1]
                seen, last = seen + 1, term
                if df >= min_docs:
                    kept.append(term)
        if seen:
            yield shard()

    ordered = counts.repartitionByRange(F.col("lang"), F.col("term")).sortWithinPartitions("lang", "term")
    cut = ordered.mapInArrow(build, SHARD_COLUMNS)
    # a row per shard: these windows hold at most SHARDS rows
    return cut.withColumn("shard", F.row_number().over(Window.partitionBy("lang").orderBy("first")).cast("long") - 1)


def streamed_counts(rows: DataFrame, shards: DataFrame, firsts) -> DataFrame:
    """Counts of each (lang, source) in each shard: ``places`` (int32) and ``counts`` (int64), in pieces."""

    def cut(batches):
        seen, held = defaultdict(Counter), 0

        def flush():
            for (lang, source), count in seen.items():
                bounds = firsts.value.get(lang)
                if not bounds:
                    continue
                pieces = defaultdict(list)
                for word in count:
                    pieces[bisect_right(bounds, word) - 1].append(word)
                for shard, words in pieces.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([shard], pa.int64()), pa.array([1], pa.int32()), pa.array([source]),
                         pa.array([b" ".join(words)], pa.binary()),
                         pa.array([np.array([count[w] for w in words], np.int64).tobytes()], pa.binary())],
                        names=["lang", "shard", "kind", "source", "a", "b"])
            seen.clear()

        for block in text_blocks(batches):
            for lang, source, raw in zip(block.column("lang").to_pylist(), block.column("source").to_pylist(), utf8(block)):
                seen[lang, source].update(words_of(raw))
                held += len(raw)
            if held > GATHERED:
                yield from flush()
                held = 0
        yield from flush()

    def walk(batches):
        machine, of, held = None, None, {}

        def flush():
            for source, count in held.items():
                at = np.flatnonzero(count)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([of[0]]), pa.array([of[1]], pa.int64()), pa.array([source]), pa.array([int(count.sum())], pa.int64()),
                         pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([count[at].tobytes()], pa.binary())],
                        names=["lang", "shard", "source", "total", "places", "counts"])
            held.clear()

        for batch in batches:
            for lang, shard, kind, source, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    yield from flush()
                    machine, of = Transducer.loaded(a), (lang, shard)
                    continue
                if not machine.n:
                    continue
                place = machine.ordinals(a.split(b" "))
                known = place >= 0
                if len(held) * machine.n > CELLS and source not in held:
                    yield from flush()
                count = held.setdefault(source, np.zeros(machine.n, np.int64))
                np.add.at(count, place[known], np.frombuffer(b, np.int64)[known])
        yield from flush()

    words = rows.mapInArrow(cut, "lang string, shard long, kind int, source string, a binary, b binary")
    machines = shards.select("lang", "shard", F.lit(0).alias("kind"), F.lit("").alias("source"),
                             F.col("machine").alias("a"), F.lit(None).cast("binary").alias("b"))
    return (machines.unionByName(words).repartition("lang", "shard").sortWithinPartitions("lang", "shard", "kind")
            .mapInArrow(walk, "lang string, shard long, source string, total long, places binary, counts binary"))


def rates(counts: np.ndarray, total) -> np.ndarray:
    """1 + floor(10**9 * counts / total) in 64-bit integers, by three steps of a thousand."""
    out, rest = counts // total, counts % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def compared(rows: DataFrame, added: int, top: int) -> DataFrame:
    """Per shard: partial sums of pairs of sources, and each group's best terms.

    ``rows``: ``lang``, ``shard``, ``kind`` (0 the transducer, 1 a group with its total, 2 counts), ``source``, ``a``, ``b``, ``total``.
    """
    names = ["lang", "source", "part", "item", "value", "shard", "place"]

    def compare(batches):
        of, machine, groups, v, count = None, None, [], 0, None

        def out():
            if count is None:
                return
            n = np.array([g[1] for g in groups], np.int64)
            p = np.stack([rates(c + added, t + added * v) for c, t in zip(count, n)])
            q = rates(count.sum(0) + added, int(n.sum()) + added * v)
            for i, (source, _) in enumerate(groups):
                far = np.abs(p[i + 1:] - p[i]).sum(1)
                m = len(far)
                if m:
                    yield batch_of(source, "pair", [g[0] for g in groups[i + 1:]], far, np.zeros(m, np.int64))
                at = np.flatnonzero((count[i] > 0) & (p[i] > q))
                at = at[np.lexsort((at, -(p[i] - q)[at]))[:top]]
                if len(at):
                    yield batch_of(source, "term", [machine.term(int(x)).decode() for x in at], (p[i] - q)[at], at)

        def batch_of(source, part, items, value, place):
            k = len(items)
            return pa.RecordBatch.from_arrays(
                [pa.array([of[0]] * k), pa.array([source] * k), pa.array([part] * k), pa.array(items),
                 pa.array(value.astype(np.int64)), pa.array([of[1]] * k, pa.int64()), pa.array(place.astype(np.int64))], names=names)

        for batch in batches:
            for lang, shard, kind, source, a, b, total, all_terms in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if of:
                        yield from out()
                    of, machine, groups, count, v = (lang, shard), Transducer.loaded(a), [], None, all_terms
                elif kind == 1:
                    groups.append((source, total))
                else:
                    if count is None:
                        count = np.zeros((len(groups), machine.n), np.int64)
                        place_of = {g[0]: i for i, g in enumerate(groups)}
                    count[place_of[source], np.frombuffer(a, np.int32)] += np.frombuffer(b, np.int64)
        if of:
            yield from out()

    return rows.mapInArrow(compare, "lang string, source string, part string, item string, value long, shard long, place long")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = 30, added: int = 5, top: int = 50) -> DataFrame:
    """``lang``, ``source``, ``part`` ('pair' or 'term'), ``item``, ``value`` and ``rank``."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(docs[source].cast("string"), F.lit("")).alias("source"), docs[text].alias("text"))
    groups = stored(rows.select("lang", "source").distinct(), "audit-groups")
    counts = stored(document_counts(rows.select("lang", "text")), "audit-terms")
    most = groups.groupBy("lang").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]
    per_shard = max(counts.count() // SHARDS + 1, min(MOST, max(LEAST, CELLS // most)))
    shards = stored(shards_of(counts, min_docs, per_shard), "audit-shards")
    bounds = defaultdict(list)
    for code, first in shards.select("lang", "first").orderBy("lang", "shard").toLocalIterator():
        bounds[code].append(bytes(first))
    found = stored(streamed_counts(rows, shards, spark.sparkContext.broadcast(dict(bounds))), "audit-counts")
    kept = shards.groupBy("lang").agg(F.sum("n").alias("v"))
    totals = (groups.join(found.groupBy("lang", "source").agg(F.sum("total").alias("total")), ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total")))
    nothing, number = F.lit(None).cast("binary"), F.lit(0).cast("long")
    parts = (shards.where("n > 0").join(kept, "lang")
             .select("lang", "shard", F.lit(0).alias("kind"), F.lit("").alias("source"), F.col("machine").alias("a"),
                     nothing.alias("b"), number.alias("total"), "v")
             .unionByName(shards.where("n > 0").select("lang", "shard").join(totals, "lang")
                          .select("lang", "shard", F.lit(1).alias("kind"), "source", nothing.alias("a"), nothing.alias("b"), "total", number.alias("v")))
             .unionByName(found.select("lang", "shard", F.lit(2).alias("kind"), "source", F.col("places").alias("a"),
                                       F.col("counts").alias("b"), number.alias("total"), number.alias("v"))))
    ordered = parts.repartition("lang", "shard").sortWithinPartitions("lang", "shard", "kind", "source")
    got = stored(compared(ordered, added, top), "audit-parts")
    sides = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    sums = got.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pair = sides.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"),
        F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.coalesce("value", F.lit(0)).desc(), "item")).alias("rank"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "shard", "place")
    term = got.where("part = 'term'").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pair.unionByName(term.select("lang", "source", "part", "item", "value", "rank"))


ORACLE_SQL = r"""
WITH doc AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tok AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM tok t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
tot AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM grp g LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source GROUP BY ALL),
rate AS (
  SELECT tot.lang, tot.source, kept.term, coalesce(cnt.c, 0) AS c,
         1 + (1000000000 * (coalesce(cnt.c, 0) + 5)::HUGEINT) // (tot.n + 5 * v.v) AS p
  FROM tot JOIN v ON v.lang = tot.lang JOIN kept ON kept.lang = tot.lang
  LEFT JOIN cnt ON cnt.lang = tot.lang AND cnt.source = tot.source AND cnt.term = kept.term),
whole AS (
  SELECT r.lang, r.term, 1 + (1000000000 * (sum(r.c) + 5)::HUGEINT) // (any_value(n.n) + 5 * any_value(v.v)) AS q
  FROM rate r JOIN (SELECT lang, sum(n) AS n FROM tot GROUP BY lang) n ON n.lang = r.lang JOIN v ON v.lang = r.lang GROUP BY r.lang, r.term),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM rate a JOIN rate b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0) AS value
  FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
term AS (
  SELECT r.lang, r.source, 'term' AS part, r.term AS item, r.p - q AS value
  FROM rate r JOIN whole w ON w.lang = r.lang AND w.term = r.term WHERE r.c > 0 AND r.p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50
"""
