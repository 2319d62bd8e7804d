"""BPE encoding and decoding with a pair occurrence index.

A task takes its partition in blocks of texts. The distinct pre-tokens of a block lie
in one array of symbols, and an index maps every mergeable pair to all its positions in
that array. The active ranks are applied in ascending order from a heap; each merge
touches only its own list and appends the two pairs that it creates to theirs. The lists of
the lowest ranks are long in a large block; they are merged as arrays.

Defined results: a null text is the empty text (no ids); rows repeat as they come; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame

from vendorlens.llm.common import as_sql_type, text_blocks, texts, worker_cache

# The published split pattern of byte-level BPE, with White_Space spelled out.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+"
         rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+")

AFTER_WHITE = [chr(x) + " " for x in (*range(9, 14), 32, 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                                      0x2028, 0x2029, 0x202f, 0x205f, 0x3000)]

#: Pre-tokens whose ids a worker remembers; a bound on memory only.
REMEMBERED = 300_000

#: Ranks that are applied to all positions at once, where there are as many symbols as ``LARGE``; both choose speed only.
EARLY = 500
LARGE = 100_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks, ids and bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
               if model.get(k)]
        odd += [k for k in ("byte_fallback", "ignore_merges") if model.get(k)]
        odd += [k for k in ("normalizer", "post_processor") if spec.get(k)]
        if model["type"] != "BPE" or odd or pre.get("type") != "ByteLevel" \
                or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"only plain byte-level BPE is supported; found {odd or pre}")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        self.token_bytes = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        self.byte_id = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        #: The rank of a pair by its right or left symbol, under its other one.
        self.after: dict[int, dict[int, int]] = {}
        self.before: dict[int, dict[int, int]] = {}
        self.merge: list[tuple[int, int, int]] = []
        made: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if made.get(x, -1) >= r or made.get(y, -1) >= r:
                raise ValueError("a merge precedes the merge that makes its parts")
            made[z] = r
            self.after.setdefault(x, {}).setdefault(y, r)
            self.before.setdefault(y, {}).setdefault(x, r)
            self.merge.append((x, y, z))
        self.byte_rank = np.full((max(self.byte_id) + 1,) * 2, -1, np.int64)
        for x in self.byte_id.tolist():
            for y in self.byte_id.tolist():
                self.byte_rank[x, y] = self.after.get(x, {}).get(y, -1)
        self.special = {}
        for t in spec.get("added_tokens", []):
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError("added tokens with stripping or word rules aren't supported")
            self.special[t["content"]] = t["id"]
            self.token_bytes[t["id"]] = t["content"].encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None
        self.split = regex.compile(SPLIT)


def by_rank(positions: np.ndarray, ranks: np.ndarray):
    """The ranks that occur, ascending, each with its positions."""
    order = np.argsort(ranks, kind="stable")
    positions, ranks = positions[order], ranks[order]
    at = np.flatnonzero(np.diff(ranks, prepend=-1))
    return ((r, positions[x:y]) for r, x, y in zip(ranks[at].tolist(), at.tolist(), [*at[1:].tolist(), len(ranks)]))


def merge_early(sym: np.ndarray, nxt: np.ndarray, prv: np.ndarray, positions: np.ndarray, ranks: np.ndarray, v: Vocabulary):
    """Applies the ranks below ``EARLY``, whose lists are long, in ascending order: a whole list of positions at a time.

    Changes ``sym``, ``nxt`` and ``prv``; returns the positions and ranks of the pairs left, some of them gone since.
    """
    early = ranks < EARLY
    rest = [(positions[~early], ranks[~early])]
    index = {r: [x] for r, x in by_rank(positions[early], ranks[early])}
    heap = list(index)
    row = np.full(len(v.byte_rank) + max(v.token_bytes) + 2, -1, np.int64)  # the last for the end of a word

    def add(at, ranks_of, beside):
        """To the index the pairs at ``at`` that have a rank by their other symbol."""
        if not ranks_of or not len(at):
            return
        others = np.fromiter(ranks_of, np.int64, len(ranks_of))
        row[others] = np.fromiter(ranks_of.values(), np.int64, len(ranks_of))
        q = row[beside]
        row[others] = -1
        rest.append((at[q >= EARLY], q[q >= EARLY]))
        now = (q >= 0) & (q < EARLY)
        for r, x in by_rank(at[now], q[now]):
            if r not in index:
                index[r] = []
                heapq.heappush(heap, r)
            index[r].append(x)

    while heap:
        r = heapq.heappop(heap)
        a, b, c = v.merge[r]
        i = np.sort(np.concatenate(index.pop(r)))
        j = nxt[i]
        here = (sym[i] == a) & (sym[j] == b)  # where no earlier merge took one of the two
        i, j = i[here], j[here]
        if a == b:  # of a run of equal symbols every other pair
            at = np.arange(len(i))
            begins = np.ones(len(i), bool)
            begins[1:] = j[:-1] != i[1:]
            odd = (at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 1
            i, j = i[~odd], j[~odd]
        k = nxt[j]
        sym[i], sym[j] = c, -2
        nxt[i], prv[k] = k, i
        p = prv[i]
        add(i, v.after.get(c), sym[k])
        p = p[sym[p] != c]  # between two new symbols the pair is there already
        add(p, v.before.get(c), sym[p])
    return [np.concatenate(x) for x in zip(*rest)]


def merge_words(words: list[str], v: Vocabulary) -> list[bytes]:
    """The ids of each word as little-endian 32-bit integers."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(size + 1) - 1
    flat = np.full(int(ends[-1]) + 1 if len(raw) else 0, -1, np.int64)
    inside = np.ones(len(flat), bool)
    inside[ends] = False
    flat[inside] = v.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    n = len(flat)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)

    # The index: each rank's pair to its positions, first those of neighbouring bytes.
    both = np.flatnonzero(inside[:-1] & inside[1:]) if n else np.empty(0, np.int64)
    first = v.byte_rank[flat[both], flat[both + 1]] if len(both) else both
    both, first = both[first >= 0], first[first >= 0]
    if n >= LARGE:
        both, first = merge_early(flat, nxt, prv, both, first, v)
    sym, nxt, prv = flat.tolist(), nxt.tolist(), prv.tolist()
    index: list[list[int] | None] = [None] * len(v.merge)
    heap = []  # ascending, so already a heap
    for r, positions in by_rank(both, first):
        heap.append(r)
        index[r] = positions.tolist()

    pop, push, merge, none = heapq.heappop, heapq.heappush, v.merge, {}
    while heap:
        r = pop(heap)
        a, b, c = merge[r]
        after, before = v.after.get(c, none).get, v.before.get(c, none).get
        positions, index[r] = index[r], None
        positions.sort()
        for i in positions:
            j = nxt[i]
            if sym[i] != a or sym[j] != b:
                continue  # an earlier merge took one of the two
            k, p = nxt[j], prv[i]
            sym[i], sym[j] = c, -2
            nxt[i], prv[k] = k, i
            q = after(sym[k])
            if q is not None:
                if index[q] is None:
                    index[q] = [i]
                    push(heap, q)
                else:
                    index[q].append(i)
            q = before(sym[p])  # before the first symbol stands the end of the last word
            if q is not None:
                if index[q] is None:
                    index[q] = [p]
                    push(heap, q)
                else:
                    index[q].append(p)
    flat = np.array(sym, dtype=np.int64)
    left = flat >= 0
    ids = flat[left].astype("<u4").tobytes()
    at = np.concatenate(([0], np.cumsum(left)[ends])) * 4
    return [ids[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]


def encode_block(block: list[str], v: Vocabulary, known: dict[str, bytes],
                 older: dict[str, bytes]) -> list[bytes]:
    """The ids of each text as little-endian 32-bit integers.

    A pre-token never crosses a space that follows a visible character. So what stands
    between two spaces is a word that is split once a block, however often it occurs, and a
    pre-token is merged unless its ids are in ``known`` or ``older``; those used come to
    ``known``. A text with a space after white space is split as a whole.
    """
    split, special = v.split.findall, v.special
    rows, middles, used = [], [], set()
    for t in block:
        pieces = []
        for p in v.cut.split(t) if v.cut else [t]:
            if p in special:
                pieces.append(p)
                continue
            i, j = p.find(" "), p.rfind(" ")
            if i == j or any(w in p for w in AFTER_WHITE):
                cut = split(p), None
            else:
                cut = split(p[:i]), split(p[j:])
                middles.append(p[i + 1:j])
            used.update(cut[0], cut[1] or ())
            pieces.append(cut)
        rows.append(pieces)
    split_words = pa.compute.split_pattern(pa.array(middles, pa.string()), " ")
    words = split_words.flatten().dictionary_encode()
    # A word of ASCII letters is a pre-token with its space. The others, none of which ends in
    # white space, are split together: each begins where a space does.
    plain = pa.compute.ascii_is_alpha(words.dictionary)
    one = led(words.dictionary.filter(plain), "\n ").split("\n")[1:]
    many = split(led(words.dictionary.filter(pa.compute.invert(plain)), " "))
    used.update(one, many)
    new = used.difference(known)
    again = new.intersection(older)
    known.update(zip(again, map(older.__getitem__, again)))
    new = list(new - again)
    known.update(zip(new, merge_words(new, v)))
    ids = known.__getitem__
    parts = list(map(ids, many))
    begins = [i for i, x in enumerate(many) if x[0] == " "]
    of_word = [*map(ids, one), *(b"".join(parts[i:j]) for i, j in zip(begins, [*begins[1:], len(many)]))]
    at = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")  # the words in the order of of_word
    place = np.empty(len(at), np.int64)
    place[at] = np.arange(len(at))
    between = gathered(of_word, place[words.indices.to_numpy()], split_words.offsets.to_numpy())
    out = []
    for pieces in rows:
        got = []
        for p in pieces:
            if isinstance(p, str):
                got.append(np.array([special[p]], "<u4").tobytes())
                continue
            got += map(ids, p[0])
            if p[1]:
                got.append(next(between))
                got += map(ids, p[1])
        out.append(b"".join(got))
    return out


def led(words: pa.Array, by: str) -> str:
    """All words in one string, each after ``by``."""
    if not len(words):
        return ""
    return by + pa.compute.binary_join(pa.ListArray.from_arrays([0, len(words)], words), by)[0].as_py()


def gathered(ids: list[bytes], order: np.ndarray, bounds: np.ndarray):
    """The ids of the words ``order[bounds[k]:bounds[k + 1]]`` for each k; ``ids`` has those of every distinct word."""
    n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    pool = np.frombuffer(b"".join(ids), "<u4")
    size = n[order]
    ends = np.concatenate(([0], np.cumsum(size)))
    flat = pool[np.repeat((np.cumsum(n) - n)[order] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
    at = (ends[bounds] * 4).tolist()
    return (flat[x:y] for x, y in zip(at, at[1:]))


def decode_ids(ids: bytes, v: Vocabulary) -> str:
    """The text of ids; bytes that aren't UTF-8 become replacement characters."""
    return b"".join(map(v.token_bytes.__getitem__, array_of(ids))).decode("utf-8", "replace")


def array_of(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


def load_vocabulary(spec) -> Vocabulary:
    """The vocabulary of a broadcast file, parsed once in each worker."""
    cache = worker_cache("bpe_vocabularies")
    key = hashlib.sha256(spec.value.encode()).hexdigest()
    if key not in cache:
        cache[key] = Vocabulary(spec.value)
        cache[key].name = key
    return cache[key]


def remembered(v: Vocabulary) -> tuple[dict, dict]:
    """What a worker knows of a vocabulary's pre-tokens, and what it knew before; it forgets those not used lately."""
    known, older = worker_cache(f"bpe_known_{v.name}"), worker_cache(f"bpe_older_{v.name}")
    if len(known) > REMEMBERED:
        older.clear()
        older.update(known)
        known.clear()
    return known, older


def encode_decode(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    ``vocabulary`` is the path of a tokenizers JSON file, read on the driver (a fixed
    file of a few MB) and broadcast. Returns ``key``, ``n_tokens``, ``ids`` (little-endian
    unsigned 32-bit integers) and ``decoded``. Special tokens' strings in a text become
    their ids, as in the tokenizers library.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    Vocabulary(spec)  # reject an unsupported file here, not in a task
    shared = df.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        v = load_vocabulary(shared)
        for block in text_blocks(batches):
            ids = encode_block(texts(block), v, *remembered(v))
            yield pa.RecordBatch.from_arrays([
                block.column("key"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()), pa.array([decode_ids(x, v) for x in ids], pa.string()),
            ], names=["key", "n_tokens", "ids", "decoded"])

    out = df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(
        run, f"key {as_sql_type(df, key)}, n_tokens long, ids binary, decoded string")
    return out.withColumnRenamed("key", key)
