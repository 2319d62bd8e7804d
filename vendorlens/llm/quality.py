"""Quality rules with n-gram perplexity.

A character model over 64 symbol classes (letters in lower case, one class for capitals,
one for digits, single punctuation marks, folded bytes beyond ASCII) of order four with
modified Kneser-Ney smoothing. Spark counts the 4-grams of all documents and derives
the lower orders, the discounts and the probabilities with grouped aggregations. A
packed n-gram is its own hash; probabilities lie in arrays sorted by it. There are at
most 2**24 + 2**18 + 2**12 + 2**6 n-grams at any corpus size, which bounds what is broadcast
(12 bytes each; a corpus of few scripts has a few hundred thousand).

Perplexity is that of a word, the loss of a whole text over its words. Each language has
a lower and an upper band of its logarithm, the median less and plus ``width`` scaled
median deviations; documents outside are rejected, as are those that fail the base
rules. The same holds for the perplexity by the word bigrams of ``wordgrams``, whose tables
grow with the corpus: characters tell noise from words, bigrams the order of words. Medians come from counts over
bins, so no group is collected; a bin is ``BIN`` wide in the logarithm of the loss, so any loss has its
own place, and deviations are taken in that logarithm. A band reaches at least ``least`` to either side, for
languages whose texts are all alike. A short
text's mean varies more: its deviation is divided by ``1 + sqrt(short / n_words)``.

Defined results: a null text has no words and fails; a null language is a language of
its own; repeated rows each get the same verdict (and count in the corpus statistics).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendorlens.llm.common import BLOCK_BYTES, as_sql_type, let_go, salted_join, stored, text_blocks, utf8, worker_cache
from vendorlens.llm.wordgrams import LINES, PIECES, SLOTS, sketch_of, sketch_pieces, word_losses, words_of

ORDER = 4
BITS = 6
SYMBOLS = b"#*$%&|<>"
BREAKS = b" \t\n\r\x0b\x0c"
#: Marks with a class of their own, in the order of their classes from 31 on.
MARKS = b".,;:'\"!?-()/%#$&*|@_="


def symbol_classes() -> np.ndarray:
    """The class of each byte; 0xFF, which UTF-8 never has, is the start of a text."""
    c = np.full(256, 62, np.int32)
    c[list(BREAKS)] = 1
    c[ord("\n")] = 2
    for b in range(26):
        c[ord("a") + b], c[ord("A") + b] = 3 + b, 29
    c[ord("0"):ord("9") + 1] = 30
    c[list(MARKS)] = np.arange(31, 31 + len(MARKS))
    c[0x80:0xC0] = 52 + np.arange(64) % 5
    c[0xC0:0xFF] = 57 + np.arange(63) % 5
    c[0xFF] = 0
    return c


CLASSES = symbol_classes()


def grams_of(raw: list[bytes]):
    """The packed n-grams of texts, one ending at each byte, and the bytes of each text."""
    pad = b"\xff" * (ORDER - 1)
    c = CLASSES[np.frombuffer(b"".join([pad + t for t in raw]), np.uint8)]
    g = c[ORDER - 1:].copy()
    for k in range(1, ORDER):
        g |= c[ORDER - 1 - k:len(c) - k] << (BITS * k)
    return g[c[ORDER - 1:] != 0], np.fromiter(map(len, raw), np.int64, len(raw))


def count_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """The 4-grams of all documents with their counts: ``gram``, ``c``."""

    def run(batches):
        let_go()
        total = np.zeros(1 << BITS * ORDER, np.int32)
        for block in text_blocks(batches):
            g, _ = grams_of(utf8(block))
            g.sort()
            at = np.flatnonzero(np.diff(g, prepend=-1))
            total[g[at]] += np.diff(at, append=len(g)).astype(np.int32)
        seen = np.flatnonzero(total)
        for i in range(0, len(seen), 100_000):
            k = seen[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(total[k].astype(np.int64))],
                                             names=["gram", "c"])

    part = docs.select(F.col(text).alias("text")).mapInArrow(run, "gram int, c long")
    return part.groupBy("gram").agg(F.sum("c").alias("c"))


def discounts(n: list[int]) -> list[float]:
    """The discounts of counts 1, 2 and 3 or more, from the number of n-grams that occur once to four times."""
    if not all(n):
        return [k / 2 for k in (1, 2, 3)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k) for k in (1, 2, 3)]


def smoothed(grams: DataFrame) -> list[DataFrame]:
    """For each order, highest first, and the empty one: ``gram``, its probability ``p`` and, as a context,
    the share ``gamma`` that it leaves to the next order (null where it is none)."""
    tables = [grams]
    for k in range(ORDER - 1, 0, -1):  # lower orders count different left neighbours
        tables.append(stored(tables[-1].groupBy(F.col("gram").bitwiseAND((1 << BITS * k) - 1).alias("gram"))
                             .agg(F.count("*").alias("c")), f"grams{k}"))
    lower, out = None, []
    for t in reversed(tables):
        seen = t.agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()  # four numbers
        d1, d2, d3 = discounts(list(seen))
        d = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        ctx = W.partitionBy(F.shiftright("gram", BITS))  # at most 64 rows each
        t = t.select("gram", F.shiftright("gram", BITS).alias("ctx"),
                     (F.greatest(F.col("c") - d, F.lit(0.0)) / F.sum("c").over(ctx)).alias("own"),
                     (F.sum(d).over(ctx) / F.sum("c").over(ctx)).alias("left"))
        if lower is None:
            p = t.withColumn("below", F.lit(1.0 / (1 << BITS)))
        else:
            shorter = F.col("gram").bitwiseAND((1 << BITS * len(out)) - 1)
            p = t.withColumn("suffix", shorter).join(
                lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix")
        lower = stored(p.select("gram", "ctx", "left", (F.col("own") + F.col("left") * F.col("below")).alias("p")),
                       f"probabilities{len(out) + 1}")
        if not out:
            rest = (lower.agg(F.max("left")).first()[0] or 1.0)  # of the empty context
        if out:  # what the contexts of this order leave belongs to the n-grams one shorter
            leaves = lower.groupBy(F.col("ctx").alias("gram")).agg(F.first("left").alias("gamma"))
            # (a context that only starts texts is no n-gram itself)
            out[-1] = out[-1].join(leaves, "gram", "full").select("gram", "p", "gamma")
        out.append(lower)
    out[-1] = out[-1].select("gram", "p", F.lit(None).cast("double").alias("gamma"))
    nothing = out[0].sparkSession.range(1).select(F.lit(0).alias("gram"), F.lit(1.0 / (1 << BITS)).alias("p"), F.lit(rest).alias("gamma"))
    return [*out[::-1], nothing]


def train(docs: DataFrame, text: str = "text") -> list[dict[str, np.ndarray]]:
    """The model as sorted arrays, highest order first; bounded as the module says."""
    grams = stored(count_grams(docs, text), "grams")
    every = None
    for k, t in enumerate(smoothed(grams)):
        t = t.select(F.lit(k).alias("k"), "gram", F.col("p").cast("float"), F.col("gamma").cast("float"))
        every = t if every is None else every.unionByName(t)
    rows = every.toArrow()
    k, gram, p, gamma = (rows.column(c).to_numpy() for c in ("k", "gram", "p", "gamma"))
    model = []
    for n in range(ORDER + 1):
        own = np.flatnonzero(k == n)
        own = own[np.argsort(gram[own])]
        model.append({"gram": gram[own], "p": np.nan_to_num(p[own], nan=1.0), "gamma": np.nan_to_num(gamma[own], nan=1.0)})
    return model


def probabilities(grams: np.ndarray, model, k: int = 0) -> np.ndarray:
    """The probability of each n-gram; those not in the model back off to shorter ones."""
    if k == ORDER:
        return np.full(len(grams), 1.0 / (1 << BITS), np.float32)
    have, p = model[k]["gram"], model[k]["p"]
    if not len(have):
        return probabilities(grams & ((1 << BITS * (ORDER - 1 - k)) - 1), model, k + 1)
    at = np.minimum(np.searchsorted(have, grams), len(have) - 1)
    out = p[at]
    miss = np.flatnonzero(have[at] != grams)
    if len(miss):
        g = grams[miss]
        below = probabilities(g & ((1 << BITS * (ORDER - 1 - k)) - 1), model, k + 1)
        if len(up := model[k + 1]["gram"]):
            ctx = g >> BITS
            i = np.minimum(np.searchsorted(up, ctx), len(up) - 1)
            below = below * np.where(up[i] == ctx, model[k + 1]["gamma"][i], 1.0)
        out = out.copy()
        out[miss] = below
    return out


def tabulated(model) -> tuple[np.ndarray, np.ndarray]:
    """The logarithms of all probabilities: where the line of each context begins, and lines with a place for each symbol.

    A context that the model has not seen gets the line of the context one shorter; lines of these are first."""
    upto = 1 << BITS * (ORDER - 1)
    seen = np.unique(model[0]["gram"] >> BITS)
    line = np.arange(upto, dtype=np.int32) & (upto - 1 >> BITS)
    line[seen] = np.arange(len(seen), dtype=np.int32) + (upto >> BITS)
    logs = np.empty(upto + (len(seen) << BITS), np.float32)
    logs[:upto] = np.log(probabilities(np.arange(upto, dtype=np.int32), model, 1))
    for i in range(0, len(seen), 4096):
        grams = (seen[i:i + 4096, None].astype(np.int32) << BITS | np.arange(1 << BITS, dtype=np.int32)).ravel()
        logs[upto + (i << BITS):][:len(grams)] = np.log(probabilities(grams, model))
    return line << BITS, logs


def base_counts(raw: list[bytes]):
    """The counts of the base rules for each text, and the hashes of all words."""
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
    at = np.concatenate(([0], np.cumsum(size)))

    def per_text(flags):
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[at[1:]] - total[at[:-1]]

    of = np.zeros(256, bool)
    of[list(SYMBOLS)] = True
    char = np.ones(256, bool)
    char[0x80:0xC0] = False
    char[list(BREAKS)] = False
    h, n_words = words_of(raw)
    lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in raw]
    out = {"n_words": n_words, "word_chars": per_text(char[flat]), "n_symbols": per_text(of[flat]),
           "n_dup_lines": np.fromiter((len(x) - len(set(x)) for x in lines), np.int64, len(raw)),
           "n_repeat_words": np.zeros(len(raw), np.int64)}
    if len(h) >= 8:
        text = np.repeat(np.arange(len(raw), dtype=np.uint64), n_words)
        g = text[:-7] * np.uint64(0x9E3779B97F4A7C15)  # windows of other texts differ
        for k in range(8):
            g = (g ^ h[k:len(h) - 7 + k]) * np.uint64(0xD6E8FEB86659FD93)
            g ^= g >> np.uint64(32)
        whole = np.flatnonzero(text[:-7] == text[7:])
        order = whole[np.argsort(g[whole], kind="stable")]
        same = g[order[1:]] == g[order[:-1]]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, order[twice], 1)
        np.add.at(edge, order[twice] + 8, -1)
        out["n_repeat_words"] = np.bincount(text[np.cumsum(edge[:-1]) > 0].astype(np.int64), minlength=len(raw))
    return out, h


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, model, key: str = "doc_id", text: str = "text", group: str = "lang") -> DataFrame:
    """Per document row: ``text_hash``, the base counts and ``log_perplexity`` (null without words).

    Rows with a ``piece`` are no documents: they hold the ``context_counts`` of the texts, from the same words."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(f"key {as_sql_type(docs, key)}, grp {as_sql_type(docs, group)}, text_hash long, "
                                + ", ".join(f"{c} long" for c in COUNTS) + ", log_perplexity double, piece int, counts binary")
    arrow = to_arrow_schema(schema)

    def run(batches):
        let_go("character_model")
        lines = worker_cache("character_model")  # of the last model only
        if name not in lines:
            lines.clear()
            lines[name] = tabulated(shared.value)
        begin, logs = lines[name]
        sketch, kinds = np.zeros((LINES, SLOTS), np.int64), dict(zip(arrow.names, arrow.types))

        def rows(size, **columns):
            kinds.update({c: x.type for c, x in columns.items()})  # the types that came in, in every batch
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, kind) for c, kind in kinds.items()], names=arrow.names)

        for block in text_blocks(batches, block_bytes=BLOCK_BYTES // 4):  # some 40 bytes of arrays a byte of text
            raw = utf8(block)
            g, size = grams_of(raw)
            total = np.concatenate(([0.0], np.cumsum(logs[begin[g >> BITS] + (g & (1 << BITS) - 1)], dtype=np.float64)))
            at = np.concatenate(([0], np.cumsum(size)))
            loss = total[at[:-1]] - total[at[1:]]
            counts, words = base_counts(raw)
            sketch += sketch_of(words, counts["n_words"])
            yield rows(len(raw), key=block.column("key"), grp=block.column("grp"), text_hash=block.column("text_hash"),
                       **{c: pa.array(counts[c], pa.int64()) for c in COUNTS},
                       log_perplexity=pa.array(loss / np.maximum(counts["n_words"], 1), pa.float64(), mask=counts["n_words"] == 0))
        yield rows(PIECES, piece=pa.array(range(PIECES), pa.int32()), counts=pa.array(sketch_pieces(sketch), pa.binary()))

    out = docs.select(docs[key].alias("key"), docs[group].alias("grp"), docs[text].alias("text"),
                      F.xxhash64(docs[text]).alias("text_hash")).mapInArrow(run, schema)
    return out.withColumnsRenamed({"key": key, "grp": group})


def binned_median(rows: DataFrame, group: str, bin_: str) -> DataFrame:
    """The median bin per group, from counts per bin: ``group``, ``median``."""
    counts = rows.groupBy(group, bin_).agg(F.count("*").alias("n"))
    upto = W.partitionBy(group).orderBy(bin_)  # as many rows as there are bins at most
    half = F.sum("n").over(upto) * 2 >= F.sum("n").over(W.partitionBy(group))
    return counts.withColumn("half", half).where("half").groupBy(group).agg(F.min(bin_).alias("median"))


#: Width of a bin of the logarithm of a loss (nats a word).
BIN = 0.002


def level(loss):
    """The logarithm of a loss in bins; losses from nothing to any size have a place."""
    return F.log(F.greatest(loss, F.lit(1e-6))) / BIN


def bands(rows: DataFrame, width: float, short: float, least: float, group: str = "lang", loss: str = "log_perplexity") -> DataFrame:
    """Per group the centre, lower and upper ``level`` of the log-perplexity: ``group``, ``centre``, ``lower``, ``upper``."""
    def bin_of(x):
        return F.round(level(x)).cast("int")

    usual = rows.where((F.col("n_words") >= 20) & F.col(loss).isNotNull())
    grp = F.struct(F.col(group).alias("g")).alias("grp")  # a null group joins with itself
    usual = usual.select(grp, bin_of(F.col(loss)).alias("b"), "n_words")
    mid = binned_median(usual, "grp", "b").withColumnRenamed("median", "mid")
    off = salted_join(usual, mid, ["grp"], "inner").select("grp", F.round(
        F.abs(F.col("b") - F.col("mid")) / (1 + F.sqrt(short / F.greatest(F.col("n_words"), F.lit(1))))).cast("int").alias("off"))
    mad = binned_median(off, "grp", "off").withColumnRenamed("median", "mad")
    reach = F.greatest(width * 1.4826 * F.col("mad"), F.lit(least / BIN))
    return mid.join(mad, "grp").select("grp", F.col("mid").alias("centre"), (F.col("mid") - reach).alias("lower"),
                                       (F.col("mid") + reach).alias("upper"))


def assess(docs: DataFrame, key: str = "doc_id", text: str = "text", group: str = "lang",
           width: float = 5.0, short: float = 200.0, least: float = 0.1) -> DataFrame:
    """Base counts, perplexity and verdict of every document row.

    ``kept`` is false where the base rules fail or a log-perplexity lies outside its
    language's bands. Returns ``key``, the counts, ``base_failed``, ``kept``, ``log_perplexity``
    (by characters) and ``word_log_perplexity``.
    """
    found = stored(measured(docs, train(docs, text), key, text, group), "measured")  # so that no re-planned join runs it twice
    rows, contexts = found.where("piece IS NULL").drop("piece", "counts"), found.where("piece IS NOT NULL").select("piece", "counts")
    rows = salted_join(rows, stored(word_losses(docs, discounts, text, contexts), "word-losses"), ["text_hash"], salts=4)
    rows = stored(rows.withColumn("word_log_perplexity", F.col("word_loss") / F.when(F.col("n_words") > 0, F.col("n_words"))).drop("word_loss"), "quality")
    grp = F.struct(F.col(group).alias("g"))
    out = rows.withColumn("grp", grp)
    fails = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = ~fails
    for loss in ("log_perplexity", "word_log_perplexity"):
        band = bands(rows, width, short, least, group, loss).select("grp", *[F.col(c).alias(f"{loss}_{c}") for c in ("centre", "lower", "upper")])
        out = salted_join(out, band, ["grp"])
        centre = F.col(f"{loss}_centre")
        off = (level(F.col(loss)) - centre) / (1 + F.sqrt(short / F.greatest(F.col("n_words"), F.lit(1))))
        kept &= F.coalesce(off.between(F.col(f"{loss}_lower") - centre, F.col(f"{loss}_upper") - centre), F.lit(True))
    return out.select(key, *COUNTS, fails.alias("base_failed"), kept.alias("kept"), "log_perplexity", "word_log_perplexity")
