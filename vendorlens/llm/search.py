"""Ranked lexical search by best-first intervals over range-maximum tables.

Spark cuts the documents into shards and writes, per shard and term, a posting list of
(document, occurrences); only terms that a fixed-size bit table of the items' terms lets
through, the rest by an exact join. Document counts come from the same lists.

In a shard each list gets a sparse table of range maxima over its impacts. A search
starts with the interval of all documents. An interval's bound is the sum of its terms'
range maxima; the best intervals are taken first, split at the document with the highest
single impact, which is scored whole, and the two rests get their own bounds. It ends
when no bound can reach the ``k`` best. The shards' best are ranked once more per item.

A shard holds at most about ``SHARD_POSTINGS`` postings and ``SHARD_BYTES`` of text, and
meets items in groups of about ``ITEM_GROUP``, so a task's memory doesn't grow with either table.

Defined results: a null text or one without terms is no document of the statistics and is
never found; rows that share a key are documents of their own; a null key comes last
among equal scores; item rows with one id are one item with the terms of all; rows
without an id or a text are no items; an item without a hit has no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendorlens.llm.common import as_sql_type, bit_table, has_bit, stored, text_blocks, utf8

#: Bits of the table that lets terms through, a multiple of 32,768.
SLOTS = 1 << 22
SHARD_POSTINGS = 1 << 20
SHARD_BYTES = 64 << 20
ITEM_GROUP = 4096
#: (interval, term) cells that a step of the search holds.
CELLS = 1 << 17
LAST = np.iinfo(np.int64).max
#: Byte to byte: A-Z in lower case, other ASCII but letters and digits as spaces.
NORMAL = bytes(b if chr(b).isalnum() else 32 for b in range(128)).lower() + bytes(range(128, 256))


def slot(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) % SLOTS


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item``, ``term`` and the term's ``slot``, a row for each distinct pair."""

    def split(batches):
        for block in text_blocks(batches):
            for i, raw in zip(range(len(block)), utf8(block)):
                terms = list(set(raw.translate(NORMAL).split()))
                if terms:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.column("item")[i].as_py()] * len(terms), block.column("item").type),
                         pa.array(terms, pa.binary()), pa.array([slot(t) for t in terms], pa.int64())],
                        names=["item", "term", "slot"])

    rows = items.select(items[item].alias("item"), items[text].alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(split, f"item {as_sql_type(items, item)}, term binary, slot long").distinct()


class Passing(dict):
    """Whether a term's bit is set, remembered per term."""

    def __init__(self, table):
        super().__init__()
        self.table = table

    def __missing__(self, term):
        if len(self) > 300_000:
            self.clear()
        self[term] = out = bool(has_bit(self.table, slot(term)))
        return out


INDEX = ["shard", "term", "n", "total", "a", "b"]


def index(docs: DataFrame, key: str, text: str, table) -> DataFrame:
    """The posting lists. Rows with a null term describe a shard's documents.

    Documents: ``n`` with a term, ``total`` terms, ``a`` keys, ``b`` terms each (-1 - terms for a null key).
    Lists: ``n`` postings, ``a`` the documents' places in the shard, ``b`` occurrences.
    """

    def build(batches):
        task, number = TaskContext.get().partitionId(), 0
        passes = Passing(table.value)
        keys, sizes, hits, terms, tfs, held, ids = [], [], [], [], [], 0, {}

        def flush():
            nonlocal number, held
            keyed = np.array([LAST if k is None else k for k in keys], np.int64)
            many = np.array(sizes, np.int64)
            many = np.where([k is None for k in keys], -1 - many, many)
            t, tf = np.array(terms, np.int32), np.array(tfs, np.int32)
            doc = np.repeat(np.arange(len(keys), dtype=np.int32), hits)
            order = np.argsort(t, kind="stable")
            count = np.bincount(t, minlength=len(ids))
            ends = np.cumsum(count)
            doc, tf = doc[order], tf[order]
            cut = lambda x: [x[e - c:e].tobytes() for e, c in zip(ends, count)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number] * (1 + len(ids)), pa.int64()), pa.array([None, *ids], pa.binary()),
                 pa.array([sum(s > 0 for s in sizes), *count.tolist()], pa.int64()),
                 pa.array([sum(sizes)] + [0] * len(ids), pa.int64()),
                 pa.array([keyed.tobytes(), *cut(doc)], pa.binary()), pa.array([many.tobytes(), *cut(tf)], pa.binary())],
                names=INDEX)
            number += 1
            held = 0
            for x in (keys, sizes, hits, terms, tfs, ids):
                x.clear()

        for block in text_blocks(batches):
            for k, raw in zip(block.column("key").to_pylist(), utf8(block)):
                words = raw.translate(NORMAL).split()
                if not words:
                    continue
                tf = Counter(words)
                found = [w for w in tf if passes[w]]
                keys.append(k)
                sizes.append(len(words))
                hits.append(len(found))
                terms.extend([ids.setdefault(w, len(ids)) for w in found])
                tfs.extend([tf[w] for w in found])
                held += len(raw)
                if held > SHARD_BYTES or len(terms) > SHARD_POSTINGS:
                    yield from flush()
        if keys:
            yield from flush()

    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    return rows.mapInArrow(build, "shard long, term binary, n long, total long, a binary, b binary")


class Shard:
    """Posting lists of one shard with their range-maximum tables."""

    def __init__(self, keys, sizes, lists, n_docs: int, n_terms: int):
        """``lists``: (places, occurrences, weight) for each term."""
        null = sizes < 0
        order = np.lexsort((keys, null))
        self.keys, self.null = keys[order], null[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes = np.where(null, -1 - sizes, sizes)[order]
        m = 10 + 90 * sizes * n_docs // n_terms
        count = np.array([len(a) for a, _, _ in lists])
        term = np.repeat(np.arange(len(lists)), count)
        doc = place[np.concatenate([a for a, _, _ in lists])]
        tf = np.concatenate([b for _, b, _ in lists]).astype(np.int64)
        weight = np.repeat(np.array([w for _, _, w in lists], np.int64), count)
        at = np.argsort(term * len(order) + doc, kind="stable")
        self.n, self.doc = len(order), doc[at]
        self.posting = (term * len(order) + doc)[at]
        self.impact = (weight * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc])))[at]
        best = [np.arange(len(at), dtype=np.int32)]
        for j in range(1, int(count.max()).bit_length()):
            left, right = best[-1][:len(at) - (1 << j) + 1], best[-1][1 << j - 1:len(at) - (1 << j - 1) + 1]
            level = best[-1].copy()  # entries too near the end are never asked for
            level[:len(left)] = np.where(self.impact[left] >= self.impact[right], left, right)
            best.append(level)
        self.best = np.stack(best)

    def maxima(self, a, b):
        """For posting ranges [a, b) of an interval's terms: its bound, and its document with the highest impact."""
        size = b - a
        some = size > 0
        level = np.frexp(np.maximum(size, 1))[1] - 1
        a = np.where(some, a, 0)
        left, right = self.best[level, a], self.best[level, np.where(some, b - (1 << level), 0)]
        top = np.where(self.impact[left] >= self.impact[right], left, right)
        value = np.where(some, self.impact[top], 0)
        first = value.argmax(1)
        return value.sum(1), self.doc[top[np.arange(len(top)), first]]

    def search(self, terms, k: int):
        """The ``k`` best documents for these lists: places and scores, scores above 0 only."""
        base = np.asarray(terms, np.int64) * self.n
        step = max(1, CELLS // len(base))
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        low, high = np.array([0]), np.array([self.n])
        bound, split = self.maxima(*(np.searchsorted(self.posting, base + x)[None] for x in (0, self.n)))
        while True:
            least, last = (scores[k - 1], docs[k - 1]) if len(scores) == k else (0, -1)
            alive = (bound > least) | (bound == least) & (low < last)
            low, high, bound, split = (x[alive] for x in (low, high, bound, split))
            if not len(low):
                return docs, scores
            take = np.argpartition(bound, -min(step, len(bound), 256))[-min(step, len(bound), 256):]
            lo, hi, x = low[take], high[take], split[take]
            a, mid, b = (np.searchsorted(self.posting, base + y[:, None]) for y in (lo, x, hi))
            at = np.minimum(mid, len(self.posting) - 1)
            hit = self.posting[at] == base + x[:, None]
            docs = np.append(docs, x)
            scores = np.append(scores, np.where(hit, self.impact[at], 0).sum(1))
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            parts = [self.maxima(a, mid), self.maxima(mid + hit, b)]
            rest = np.ones(len(low), bool)
            rest[take] = False
            low = np.concatenate((low[rest], lo, x + 1))
            high = np.concatenate((high[rest], x, hi))
            bound, split = (np.concatenate((old[rest], *new)) for old, new in ((bound, [p[0] for p in parts]), (split, [p[1] for p in parts])))


def rank(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """Per item its ``k`` best documents: ``item``, ``rank``, ``key`` (a long) and ``score``."""
    spark = docs.sparkSession
    kind = as_sql_type(items, item)
    asked = stored(item_terms(items, item, item_text), "search-terms")
    table = spark.sparkContext.broadcast(bit_table(asked, SLOTS))
    lists = stored(index(docs, key, text, table), "search-index")
    n_docs, n_terms = lists.where("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    groups = 1 + asked.select(F.count_distinct("item")).first()[0] // ITEM_GROUP
    df = lists.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    wanted = (asked.groupBy("term", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int").alias("g"))
              .agg(F.collect_list("item").alias("items")).join(df, "term")
              .select("term", "g", "items", weight.cast("long").alias("w")).where("w > 0"))
    found = lists.where("term IS NOT NULL").join(wanted, "term").select("shard", "g", "items", "w", "a", "b")
    every = (lists.where("term IS NULL").select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(None).cast(f"array<{kind}>").alias("items"),
        F.lit(-1).cast("long").alias("w"), "a", "b"))

    def search(batches):
        held, of = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != of:
                    yield from searched(held)
                    held, of = [], row[:2]
                held.append(row[2:])
        yield from searched(held)

    def searched(rows):
        if len(rows) < 2:
            return
        keys, sizes = (np.frombuffer(x, np.int64) for x in rows[0][2:])
        terms = {}
        for t, (ids, *_) in enumerate(rows[1:]):
            for i in ids:
                terms.setdefault(i, []).append(t)
        shard = Shard(keys, sizes, [(np.frombuffer(a, np.int32), np.frombuffer(b, np.int32), w) for _, w, a, b in rows[1:]], n_docs, n_terms)
        out = [(i, shard.keys[d], shard.null[d], s) for i, ts in terms.items() for d, s in zip(*shard.search(ts, k))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], arrow_item), pa.array([None if r[2] else int(r[1]) for r in out], pa.int64()),
             pa.array([int(r[3]) for r in out], pa.int64())], names=["item", "key", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    arrow_item = to_arrow_type(items.schema[item].dataType)
    best = (every.unionByName(found).repartition("shard", "g").sortWithinPartitions("shard", "g", "w")
            .mapInArrow(search, f"item {kind}, key long, score long"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score"))


ORACLE_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents WHERE text IS NOT NULL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc) GROUP BY r, term),
stat AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM doc WHERE len(w) > 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
scored AS (
  SELECT a.item_id, doc.doc_id, doc.r,
         sum(CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2 * df.df + 1))) AS BIGINT)
             * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * len(doc.w) * n_docs) // n_terms)))) AS score
  FROM asked a JOIN df ON df.term = a.term JOIN tf ON tf.term = a.term JOIN doc ON doc.r = tf.r CROSS JOIN stat
  GROUP BY a.item_id, doc.doc_id, doc.r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""
