"""A word bigram model with modified Kneser-Ney discounts, counted and applied in one exchange of the bigrams.

Words are runs of bytes other than ASCII white space, as they stand; a text's first word follows the word 0.
Tasks pack the bigrams of a block of texts, sorted by context, with the number of the text, and send
each piece to the shipment of its contexts' hashes. A shipment's task unpacks all bigrams of one bucket of its contexts
at a time, in sorted arrays. The exchange is read twice: first to count, which gives one set of discounts for the whole corpus, then to
score every text and send on one sum per text. So the tables grow with the corpus and are never collected, and a text's bigrams travel once.

The counts are those of the other texts: a text's own bigrams are taken out of a count, of its context and of the
context's discounts before its words are scored (leave one out), and equal texts count once. What a context's
discounts leave goes to a vocabulary of ``VOCABULARY`` equally likely words: the model is about the order of
words; their spelling is the character model's part. A word after a context that no other text has gets just that share.

A bucket holds about ``BUCKET`` bigrams; ``SHIPPED`` buckets travel together. Contexts with more than ``PART`` bigrams (by a sketch; some
others may be taken for such) are split by words among the buckets: a bucket counts its words and sends the counts on by texts,
where they meet the totals of their contexts. There are about as many of these contexts as buckets at most, and only their totals reach every task.
So the numbers of buckets and parts choose where work is done, not results. Contexts have 40 hash bits, words under a context 24:
of m contexts or a context's m words about m * m / 2**41 or m * m / 2**25 pairs are taken for one (of the 200,000 words of
a part as full as they get, six in a thousand).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import let_go, text_blocks, utf8

VOCABULARY = 1 << 20
BUCKET = 1 << 20
SHIPPED = 4
PART = 1 << 20
#: Slots in which contexts are counted to find those with many bigrams, in each of so many lines of a sketch.
SLOTS = 1 << 16
LINES = 3
#: The sketch travels in this many pieces.
PIECES = 16
#: Text bytes whose bigrams a task packs at a time.
BLOCK = 16 << 20
#: Words of more bytes are hashed one by one.
LONG = 32
CONTEXT = np.uint64((1 << 40) - 1)
WORD = np.uint64((1 << 24) - 1)
#: Numbers of a context: its bigrams that occur once to four times and three times or more, and its words.
TALLIES = ("n1", "n2", "n3", "n4", "more", "words")
#: Parts of the texts' hashes in which their sums are added up, at least; one more for each 4 buckets.
SUMS = 64


#: ASCII white space, and what is kept of eight bytes of which the first few belong to a word.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def words_of(raw: list[bytes]):
    """The 64-bit hashes of all words of texts, in their order, and the number of words of each text.

    Equal words are found all at once, eight bytes of each at a time; only distinct ones are hashed by themselves."""
    flat = b" ".join((b"", *raw, b" " * 8))  # white space around, and eight bytes to read at any word's end
    space = SPACE[np.frombuffer(flat, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, n = edges[::2], edges[1::2] - edges[::2]
    texts = np.cumsum(np.fromiter((len(t) + 1 for t in (b"", *raw)), np.int64, len(raw) + 1))
    size = np.diff(np.searchsorted(begin, texts))
    eight = np.ndarray((len(flat) - 7,), "<u8", flat, strides=(1,))
    h = mix(n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(0, LONG, 8):
        some = np.flatnonzero(n > k) if k else slice(None)
        h[some] = mix(mix(h[some] ^ eight[begin[some] + k] & FIRST[np.minimum(n[some] - k, 8)]))
    view = memoryview(flat)
    for i in np.flatnonzero(n > LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(view[begin[i]:begin[i] + n[i]])
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    words = zip(begin[first].tolist(), (begin + n)[first].tolist())
    return np.fromiter((xxhash.xxh3_64_intdigest(view[i:j]) for i, j in words), np.uint64, len(first))[number], size


def bigrams_of(raw: list[bytes]):
    """Hashes of contexts and words of texts, in their order, and the number of words of each text."""
    word, size = words_of(raw)
    ctx = np.concatenate((np.zeros(min(1, len(word)), np.uint64), word[:-1]))
    starts = np.cumsum(size) - size
    ctx[starts[size > 0]] = 0
    return ctx, word, size


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def slots_of(ctx: np.ndarray):
    """The slot of each context in each line of the sketch, one line after the other: other bits of its hash."""
    for k in range(LINES):
        yield (ctx >> np.uint64(16 * k)).astype(np.uint16)


def sketch_of(word: np.ndarray, size: np.ndarray) -> np.ndarray:
    """About the bigrams per slot of contexts: but for a text's last word each is a context, and so is each text's start."""
    out = np.stack([np.bincount(at, minlength=SLOTS) for at in slots_of(word)])
    out[:, 0] += np.count_nonzero(size)
    return out


def sketch_pieces(sketch: np.ndarray) -> list[bytes]:
    return [zstandard.ZstdCompressor(level=1).compress(x.astype(np.int64).tobytes()) for x in np.split(sketch.ravel(), PIECES)]


def context_counts(docs: DataFrame) -> DataFrame:
    """The sketch of contexts by tasks, in pieces: ``piece``, ``counts``."""

    def run(batches):
        total = np.zeros((LINES, SLOTS), np.int64)
        for block in text_blocks(batches):
            total += sketch_of(*words_of(utf8(block)))
        yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array(sketch_pieces(total), pa.binary())], names=["piece", "counts"])

    return docs.select("text").mapInArrow(run, "piece int, counts binary")


def added_sketch(counts: DataFrame) -> np.ndarray:
    """The whole sketch, of a fixed size: a stream for each piece adds up what tasks counted."""

    def add(batches):
        total = {}
        for batch in batches:
            for piece, counts in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist()):
                total[piece] = total.get(piece, 0) + np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.int64)
        for piece, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["piece", "counts"])

    out = np.zeros((PIECES, LINES * SLOTS // PIECES), np.int64)
    for row in counts.repartition(PIECES, "piece").mapInArrow(add, "piece int, counts binary").collect():
        out[row["piece"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(LINES, SLOTS)


def firsts(*keys) -> np.ndarray:
    """Where a run of rows with equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def planes(*arrays) -> bytes:
    """Arrays byte by byte, under compression."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays))


def arrays_of(raw, sizes_and_kinds) -> list[np.ndarray]:
    body, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8), 0, []
    for size, kind in sizes_and_kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(body[at:at + size * width].reshape(width, size).T).view(kind).ravel())
        at += size * width
    return out


def packed_texts(hashes) -> bytes:
    return np.int64(len(hashes)).tobytes() + planes(np.diff(hashes, prepend=np.uint64(0)))


def unpacked_texts(raw) -> np.ndarray:
    return np.cumsum(arrays_of(memoryview(raw)[8:], [(np.frombuffer(raw, np.int64, 1)[0], np.uint64)])[0], dtype=np.uint64)


def packed(ctx, word, text, count) -> bytes:
    """Bigrams sorted by context (40 bits), as arrays under compression; words as differences under a context, modulo 2**32."""
    at = firsts(ctx)
    kinds, word = ctx[at], word.astype(np.uint32)
    step = np.diff(word, prepend=np.uint32(0))
    step[at] = word[at]
    return np.array([len(at), len(word)], np.int64).tobytes() + planes(
        np.diff(kinds, prepend=np.uint64(0)), np.diff(np.append(at, len(ctx))).astype(np.uint32), step, text.astype(np.uint32), count.astype(np.uint32))


def unpacked(raw, hashes):
    """The bigrams with their texts' ``hashes`` in place of numbers."""
    contexts, n = np.frombuffer(raw, np.int64, 2).tolist()
    ctx, runs, step, text, count = arrays_of(memoryview(raw)[16:], [(contexts, np.uint64), (contexts, np.uint32), *[(n, np.uint32)] * 3])
    word, begin = np.cumsum(step, dtype=np.uint32), np.cumsum(runs) - runs
    word -= np.repeat(word[begin] - step[begin], runs)
    return np.repeat(np.cumsum(ctx, dtype=np.uint64), runs), word, hashes[text], count


def joined(rows) -> list[np.ndarray]:
    """Each column of ``rows`` of arrays as one array; what is joined is let go."""
    columns, out = [list(c) for c in zip(*rows)], []
    while columns:
        out.append(np.concatenate(columns.pop(0)))
    return out


def settled(ctx, word, text, count):
    """Sorted by context, word and text, equal texts of several tasks once."""
    key = ctx << np.uint64(24) | word.astype(np.uint64)
    order = np.lexsort((text, key))
    key, text = key[order], text[order]
    once = firsts(key, text)
    return key[once], text[once], count[order[once]].astype(np.int64)


def spread(x, at, size):
    """Each value of ``x`` for all rows from its place in ``at`` to the next."""
    return np.repeat(x, np.diff(np.append(at, size)))


def tallied(ctx, word, text, count):
    """The contexts, and a line for each of their ``TALLIES``."""
    key, text, count = settled(ctx, word, text, count)
    gram = firsts(key)
    n, kinds = np.add.reduceat(count, gram), key[gram] >> np.uint64(24)
    group = firsts(kinds)
    return kinds[group], np.stack([np.add.reduceat(x.astype(np.int64), group) for x in (n == 1, n == 2, n == 3, n == 4, n >= 3, n)])


def losses(steps, other, count, total, left):
    """Of words with ``other`` occurrences in other texts, after contexts with ``total`` words and ``left`` discounts there."""
    p = np.full(len(other), 1.0 / VOCABULARY)
    some = total > 0
    p[some] = (np.maximum(other - steps[np.minimum(other, 3)], 0.0) + left / VOCABULARY)[some] / total[some]
    return -np.log(np.maximum(p, 1e-300)) * count


def without_own(steps, group, text, other, count, total, left):
    """``total`` and ``left`` of contexts (numbered by ``group``) less what each text has itself of them."""
    by = np.lexsort((text, group))
    own = firsts(group[by], text[by])
    lost = steps[np.minimum(other + count, 3)] - steps[np.minimum(other, 3)]
    own_n, own_left = np.empty(len(by), np.int64), np.empty(len(by))
    own_n[by] = spread(np.add.reduceat(count[by], own), own, len(by))
    own_left[by] = spread(np.add.reduceat(lost[by], own), own, len(by))
    return total - own_n, np.maximum(left - own_left, 0.0)


def by_text(text, loss):
    hashes, at = np.unique(text, return_inverse=True)
    return hashes, np.bincount(at, weights=loss, minlength=len(hashes))


def scored(ctx, word, text, count, steps):
    """For each text: its hash and the sum of its words' losses."""
    key, text, count = settled(ctx, word, text, count)
    gram, group = firsts(key), firsts(key >> np.uint64(24))
    n, size = np.add.reduceat(count, gram), len(key)
    other = spread(n, gram, size) - count  # in other texts
    at = np.searchsorted(gram, group)
    total, left = (spread(np.add.reduceat(x, at), group, size) for x in (n, steps[np.minimum(n, 3)]))
    hashes, number = np.unique(text, return_inverse=True)
    total, left = without_own(steps, spread(np.arange(len(group)), group, size), number, other, count, total, left)
    return hashes, np.bincount(number, weights=losses(steps, other, count, total, left), minlength=len(hashes))


def scored_apart(ctx, other, text, count, steps, contexts, tallies):
    """The same for bigrams whose occurrences in ``other`` texts are known, of contexts with ``tallies``."""
    other, count = other.astype(np.int64), count.astype(np.int64)
    group = np.searchsorted(contexts, ctx)
    left = steps[1] * tallies[0] + steps[2] * tallies[1] + steps[3] * tallies[4]
    total, left = without_own(steps, group, text, other, count, tallies[5][group], left[group])
    return by_text(text, losses(steps, other, count, total, left))


def word_losses(docs: DataFrame, discounts, text: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """Per distinct text with words: ``text_hash`` and ``word_loss``, the sum of its words' losses.

    ``discounts`` gives those of counts 1, 2 and 3 or more from the numbers of bigrams that occur once to four times.
    ``counts`` are the ``context_counts`` of ``docs`` where they are known already.
    """
    rows = docs.select(docs[text].alias("text"), F.xxhash64(docs[text]).alias("text_hash"))
    sketch = added_sketch(context_counts(rows) if counts is None else counts)
    buckets = 1 + int(sketch[0].sum()) // BUCKET
    shipments = -(-buckets // SHIPPED)
    ends = SUMS + buckets // 4
    split_of = (1 + sketch // PART).astype(np.uint32)

    def bucket_of(ctx):
        return (ctx * np.uint64(buckets) >> np.uint64(40)).astype(np.int64)  # rises with the context

    def pack(batches):
        let_go()
        held, size = [], 0
        for block in text_blocks(batches):
            raw = utf8(block)
            hashes, first = np.unique(block.column("text_hash").to_numpy().view(np.uint64), return_index=True)  # equal texts once
            held.append((hashes, *bigrams_of([raw[i] for i in first.tolist()])))
            size += sum(map(len, raw))
            if size > BLOCK:
                yield from pieces(held)
                held, size = [], 0
        yield from pieces(held)

    def pieces(held):
        if not held:
            return
        hashes, ctx, word, size = joined(held)
        held.clear()
        hashes, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        number, once = number.astype(np.uint32), first[number] == np.arange(len(number))
        text = np.repeat(number, size)
        if not once.all():  # a text of several blocks counts once
            once = np.repeat(once, size)
            ctx, word, text = ctx[once], word[once], text[once]
        split = None
        for k, at in enumerate(slots_of(ctx)):
            split = split_of[k][at] if split is None else np.minimum(split, split_of[k][at])
        apart, key = split > 1, (ctx & CONTEXT) << np.uint64(24) | word & WORD
        del ctx
        if apart.any():
            to = mix((key[apart] >> np.uint64(24)) + (word[apart] >> np.uint64(40)) % split[apart] * np.uint64(0x9E3779B97F4A7C15))
            yield from sent(True, key[apart], text[apart], hashes, (to % np.uint64(shipments)).astype(np.int64))
            key, text = key[~apart], text[~apart]
        del word, split, apart
        yield from sent(False, key, text, hashes, None)

    def sent(apart, key, text, hashes, to):
        if not len(key):
            return
        if to is None:
            order = np.argsort(key, kind="stable")  # a text's bigrams stay together
        else:  # by portions of a shipment
            order = np.lexsort((key, to := to * SHIPPED + (mix(key >> np.uint64(24)) % np.uint64(SHIPPED)).astype(np.int64)))
        key, text = key[order], text[order]
        at = firsts(key, text)
        count = np.diff(np.append(at, len(key)))
        key, text = key[at], text[at]
        ctx = key >> np.uint64(24)
        to = bucket_of(ctx) if to is None else to[order[at]]
        del order, at
        begins = firsts(to // SHIPPED)
        for lo, hi in zip(begins.tolist(), [*begins[1:].tolist(), len(key)]):
            mine = np.zeros(len(hashes), bool)
            mine[text[lo:hi]] = True
            number = np.cumsum(mine) - 1
            shipment = int(to[lo]) // SHIPPED
            cuts = (lo + np.searchsorted(to[lo:hi], shipment * SHIPPED + np.arange(SHIPPED + 1))).tolist()
            portions = [packed(ctx[i:j], key[i:j] & WORD, number[text[i:j]], count[i:j]) if i < j else None for i, j in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shipment], pa.int64()), pa.array([apart]), pa.array([packed_texts(hashes[mine])], pa.binary()),
                 pa.array([portions], pa.list_(pa.binary()))], names=["shipment", "apart", "texts", "grams"])

    def shipped(batches):
        """What a shipment holds, in portions of about a bucket: whether of contexts apart, the bigrams and the ``totals`` row."""
        held, of, row = [], None, None

        def portions():
            for b in range(SHIPPED if held else 0):  # the others stay packed
                parts = [unpacked(grams[b].as_buffer(), unpacked_texts(texts.as_buffer())) for texts, grams in held if grams[b].is_valid]
                if parts:
                    yield of[1], joined(parts), row
            held.clear()

        for batch in batches:
            totals = batch.column("totals") if "totals" in batch.schema.names else [None] * len(batch)
            for shipment, apart, texts, grams, now in zip(*(batch.column(c).to_pylist() for c in ("shipment", "apart")),
                                                          batch.column("texts"), batch.column("grams"), totals):
                if (shipment, apart) != of:
                    yield from portions()
                    of = shipment, apart
                row = now
                held.append((texts, grams))  # not copied
        yield from portions()

    def tally(batches):
        let_go()
        every = np.zeros(4, np.int64)
        for apart, grams, _ in shipped(batches):
            contexts, n = tallied(*grams)
            every += n[:4].sum(1)
            if apart:
                which, at = np.nonzero(n)
                yield tallies_batch(pa.array(contexts.view(np.int64)[at]), which, n[which, at])
        yield tallies_batch(pa.nulls(4, pa.int64()), np.arange(4), every)

    def tallies_batch(contexts, which, n):
        return pa.RecordBatch.from_arrays([contexts, pa.array(which, pa.int32()), pa.array(n)], names=["ctx", "which", "n"])

    def score(batches):
        let_go()
        sums = []

        def out():
            if sums:
                text, loss = added(sums)
                sums.clear()
                yield from parted(text, lambda mine: (packed_texts(text[mine]), planes(loss[mine].astype(np.float32))), False)

        def parted(text, body, apart):
            part = text % np.uint64(ends)
            for p in np.unique(part).tolist():
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([2 if apart else 1], pa.int32()),
                                                  *[pa.array([x], pa.binary()) for x in body(part == p)]], names=["part", "kind", "texts", "body"])

        for apart, grams, totals in shipped(batches):
            if apart:
                key, text, count = settled(*grams)
                gram = firsts(key)
                other = spread(np.add.reduceat(count, gram), gram, len(key)) - count
                ctx = key >> np.uint64(24)

                def body(mine):
                    hashes, number = np.unique(text[mine], return_inverse=True)
                    return packed_texts(hashes), packed(ctx[mine], other[mine], number, count[mine])

                yield from parted(text, body, True)
                continue
            sums.append(scored(*grams, steps_of(totals.as_py())))
            if len(sums) >= SHIPPED:
                sums[:] = [added(sums)]
                if len(sums[0][0]) > 2_000_000:
                    yield from out()
        yield from out()

    def steps_of(totals):
        return np.array([0.0, *discounts(totals)])

    def add(batches):
        let_go()
        held, grams, of, known = [], [], None, None

        def settle():
            if grams:
                held.append(scored_apart(*(np.concatenate(c) for c in zip(*grams)), *known))
                grams.clear()
                held[:] = [added(held)]

        def out():
            settle()
            if held:
                text, loss = added(held)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(text.view(np.int64)), pa.array(loss)], names=["text_hash", "word_loss"])

        for batch in batches:
            for part, kind, texts, body, totals, table in zip(*(batch.column(c) for c in ("part", "kind", "texts", "body", "totals", "tallies"))):
                if part != of:
                    yield from out()
                    of, known = part, None
                if kind.as_py() == 0:  # comes first
                    ctx, which, n = (table.values.field(c).to_numpy() for c in ("ctx", "which", "n"))
                    contexts, at = np.unique(ctx.view(np.uint64), return_inverse=True)
                    tallies = np.zeros((len(TALLIES), len(contexts)), np.int64)
                    tallies[which, at] = n
                    known = steps_of(totals.as_py()), contexts, tallies
                    continue
                hashes = unpacked_texts(texts.as_buffer())
                if kind.as_py() == 2:
                    grams.append(unpacked(body.as_buffer(), hashes))
                    continue
                held.append((hashes, arrays_of(body.as_buffer(), [(len(hashes), np.float32)])[0].astype(np.float64)))
                if len(held) > 64:
                    held[:] = [added(held)]
        yield from out()

    grams = rows.mapInArrow(pack, "shipment long, apart boolean, texts binary, grams array<binary>").repartition("shipment")
    # in rows, so that both uses below have one exchange
    tallies = (grams.sortWithinPartitions("shipment", "apart").mapInArrow(tally, "ctx long, which int, n long")
               .groupBy("ctx", "which").agg(F.sum("n").alias("n")))
    # one row: four numbers and the contexts apart
    known = tallies.agg(F.array(*[F.coalesce(F.sum(F.when(F.col("ctx").isNull() & (F.col("which") == k), F.col("n"))), F.lit(0)) for k in range(4)]).alias("totals"),
                        F.collect_list(F.when(F.col("ctx").isNotNull(), F.struct("ctx", "which", "n"))).alias("tallies"))
    each = (grams.crossJoin(F.broadcast(known.select("totals"))).sortWithinPartitions("shipment", "apart")
            .mapInArrow(score, "part int, kind int, texts binary, body binary"))
    for_all = docs.sparkSession.range(ends).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("kind"),
                                                     *[F.lit(None).cast("binary").alias(c) for c in ("texts", "body")])
    return (each.withColumns({c: F.lit(None).cast(known.schema[c].dataType) for c in ("totals", "tallies")})
            .unionByName(for_all.crossJoin(F.broadcast(known)))
            .repartition("part").sortWithinPartitions("part", "kind").mapInArrow(add, "text_hash long, word_loss double"))


def added(sums):
    """Sums of the same texts added up; ``sums`` are pairs of text hashes and losses."""
    text, loss = (np.concatenate(c) for c in zip(*sums))
    text, at = np.unique(text, return_inverse=True)
    return text, np.bincount(at, weights=loss, minlength=len(text))
