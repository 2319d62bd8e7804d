"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, in
lower case (A-Z only). Each distinct benchmark word is one symbol of the automaton's
alphabet, each window of ``window`` item words a pattern; a shorter item is one pattern.
Every text is scanned once, and hits are mapped back to character offsets of the
original. Benchmarks beyond ``block_words`` words are taken in blocks, a scan of all
documents for each, so the automaton's memory is bounded at any benchmark size.

Defined results: a null or empty text has no words and no hit; a document row appears
once for each time it is given; benchmark rows without an id or without words match
nothing; an item id that occurs twice counts once; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import as_sql_type, text_blocks, utf8, worker_cache

_ASCII = bytes(b if chr(b).isalnum() else 32 for b in range(128)).lower()
#: Byte to byte: A-Z in lower case, other ASCII but letters and digits as spaces.
NORMAL = _ASCII + bytes(range(128, 256))
ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(NORMAL).split()


def item_blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int):
    """Lists of (item id, words) with at most about ``block_words`` words each.

    The benchmark streams through the driver a partition at a time; a long item goes
    into several pieces that overlap by a window less one word.
    """
    block, held = [], 0
    rows = benchmark.select(item, text).where(F.col(item).isNotNull() & F.col(text).isNotNull())
    for item_id, t in rows.toLocalIterator():
        words = normal_words(t.encode())
        for at in range(0, max(1, len(words) - window + 1), block_words):
            piece = words[at:at + block_words + window - 1]
            if not piece:
                continue
            if block and held + len(piece) > block_words:
                yield block
                block, held = [], 0
            block.append((item_id, piece))
            held += len(piece)
    yield block


class Scanner:
    """The automaton of one block of items."""

    def __init__(self, items, window: int):
        self.symbol: dict[bytes, str] = {}
        found = defaultdict(set)
        for n, (_, words) in enumerate(items):
            # 0 stands for every other word; surrogates aren't characters
            line = "".join([self.symbol.setdefault(w, chr(k + 1 if k < 0xD7FF else k + 0x801))
                            for w in words for k in (len(self.symbol),)])
            for i in range(max(1, len(line) - window + 1)):
                found[line[i:i + window]].add(n)
        self.ids = [i for i, _ in items]
        self.automaton = ahocorasick.Automaton()
        for pattern, owners in found.items():
            self.automaton.add_word(pattern, (len(pattern), tuple(owners)))
        self.empty = not found
        self.automaton.make_automaton()

    def scan(self, words: list[bytes]):
        """Merged word ranges [begin, end) under hits, and the ids of the items that hit."""
        if self.empty or not words:
            return [], []
        get = self.symbol.get
        line = "".join([get(w, "\0") for w in words])
        ranges, owners = [], set()
        for last, (size, which) in self.automaton.iter(line):
            begin, end = last + 1 - size, last + 1
            while ranges and begin <= ranges[-1][1]:  # hits come by their ends
                begin = min(begin, ranges.pop()[0])
            ranges.append((begin, end))
            owners.update(which)
        return ranges, list({self.ids[n] for n in owners})


def spans_of(text: str, ranges) -> list[dict]:
    """Word ranges with the character offsets of the original text that they cover."""
    at = [m.span() for m in ORIGINAL_WORD.finditer(text)]
    return [{"begin": b, "end": e, "start": at[b][0], "stop": at[e - 1][1]} for b, e in ranges]


SPANS = "array<struct<begin:int,end:int,start:int,stop:int>>"


def find_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text", window: int = 13,
               block_words: int = 100_000) -> DataFrame:
    """Per document row: ``key``, ``n_words``, ``spans`` and ``items``.

    ``spans`` holds disjoint word ranges inside item windows with their character
    offsets in the original text, ``items`` the distinct ids of the items that occur.
    """
    sc, item_type = docs.sparkSession.sparkContext, as_sql_type(benchmark, item)
    schema = f"key {as_sql_type(docs, key)}, id long, n_words long, spans {SPANS}, items array<{item_type}>"
    blocks = list(map(sc.broadcast, item_blocks(benchmark, item, item_text, window, block_words)))

    def scan_with(items):
        name = uuid.uuid4().hex

        def run(batches):
            cache = worker_cache("scanners", 1)
            if name not in cache:
                cache[name] = Scanner(items.value, window)
            scanner = cache[name]
            for block in text_blocks(batches):
                counts, spans, owners = [], [], []
                for i, raw in enumerate(utf8(block)):
                    words = normal_words(raw)
                    ranges, ids = scanner.scan(words)
                    counts.append(len(words))
                    spans.append(spans_of(raw.decode(), ranges) if ranges else [])
                    owners.append(ids)
                yield pa.RecordBatch.from_arrays(
                    [block.column("key"), block.column("id"), pa.array(counts, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([(k, pa.int32()) for k in ("begin", "end", "start", "stop")]))),
                     pa.array(owners, pa.list_(arrow_item))],
                    names=["key", "id", "n_words", "spans", "items"])

        return rows.mapInArrow(run, schema)

    from pyspark.sql.pandas.types import to_arrow_type
    arrow_item = to_arrow_type(benchmark.schema[item].dataType)
    ident = F.lit(0).cast("long") if len(blocks) == 1 else F.xxhash64(docs[key], docs[text])
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"), ident.alias("id"))
    scans = [scan_with(b) for b in blocks]
    out = scans[0] if len(scans) == 1 else merged(scans)
    return out.select(F.col("key").alias(key), "n_words", "spans", "items")


def merged(scans: list[DataFrame]) -> DataFrame:
    """One row per document row from the scans of several blocks."""
    every = scans[0]
    for s in scans[1:]:
        every = every.unionByName(s)
    rows = every.groupBy("key", "id", "n_words").agg(
        (F.count("*") / len(scans)).cast("int").alias("copies"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("found"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    # ranges in order of their begin: each starts a new range or widens the last one
    join = F.reduce(
        "found", F.array().cast(SPANS),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["begin"] <= F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.element_at(acc, -1)["begin"].alias("begin"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop")))))
        .otherwise(F.concat(acc, F.array(x))))
    return (rows.withColumn("spans", join)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select("key", "n_words", "spans", "items"))


def verdicts(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, the digest of the items and the contamination rule for ``find_spans`` rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return (found.withColumn("n_hit", n_hit)
            .select(key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))


ORACLE_SQL = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i : i + 12], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
hit AS (
  SELECT d.doc_id, d.i, d.size, win.item_id
  FROM (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc CROSS JOIN sizes)) d
  JOIN win ON win.size = d.size AND win.gram = d.gram),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hit)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered ON covered.doc_id = doc.doc_id LEFT JOIN named ON named.doc_id = doc.doc_id
"""
