"""Token counts by section, from character offsets.

A document is encoded once and whole. The tokens' character spans are joined with the
document's sections as intervals (both sorted, so by binary search), and every token is
given to one section by an explicit rule: the section that holds most of its
characters, and of two with equally many the earlier one. The tokens that cross a
boundary are counted as such. Counts of sections always add up to the document's.

Bytes of one character may fall into several tokens; each of these spans the character.

Sections are lines by default, each with the line break that ends it. Defined results: a
null or empty text has no tokens and no sections; rows repeat as they come; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vendorlens.llm.bpe import Vocabulary, encode_block, load_vocabulary, remembered
from vendorlens.llm.common import as_sql_type, text_blocks, texts


def line_starts(text: str) -> np.ndarray:
    """The character offsets at which lines begin."""
    at = [0]
    for line in text.split("\n")[:-1]:
        at.append(at[-1] + len(line) + 1)
    if len(at) > 1 and at[-1] == len(text):
        at.pop()
    return np.array(at, np.int64)


def token_spans(text: bytes, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token; ``size`` has the bytes of each id."""
    end = np.cumsum(size[ids])
    char = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)  # characters begun up to each byte
    return char[end - size[ids]] - 1, char[end - 1]


def allocate(start: np.ndarray, stop: np.ndarray, sections: np.ndarray, length: int):
    """Tokens of each section by the rule, and how many cross a boundary."""
    first = np.searchsorted(sections, start, "right") - 1
    last = np.searchsorted(sections, stop - 1, "right") - 1
    owner = first.copy()
    ends = np.append(sections[1:], length)
    for i in np.flatnonzero(first != last):  # few: only tokens that span a boundary
        s = np.arange(first[i], last[i] + 1)
        owner[i] = s[np.argmax(np.minimum(ends[s], stop[i]) - np.maximum(sections[s], start[i]))]
    return np.bincount(owner, minlength=len(sections)), int((first != last).sum())


def token_counts(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                 fields: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``key``, ``n_tokens``, ``n_sections``, ``n_crossing``, ``section_start`` and ``section_tokens``.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers library. With ``fields``,
    the sections are these columns instead of lines: they are encoded as one text, joined by line breaks
    (a field's break belongs to it).
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    Vocabulary(spec)
    shared = df.sparkSession.sparkContext.broadcast(spec)
    columns = list(fields) or [text]

    def run(batches):
        v = load_vocabulary(shared)
        size = np.zeros(max(v.token_bytes) + 1, np.int64)
        for i, b in v.token_bytes.items():
            size[i] = len(b)
        for block in text_blocks(batches, "c0"):
            parts = [texts(block, f"c{k}") for k in range(len(columns))]
            if fields:
                rows = ["\n".join(p) for p in zip(*parts)]
                starts = [np.cumsum([0] + [len(x) + 1 for x in p[:-1]]) for p in zip(*parts)]
            else:
                rows, starts = parts[0], [line_starts(t) if t else np.empty(0, np.int64) for t in parts[0]]
            ids = encode_block(rows, v, *remembered(v))
            out = []
            for t, i, s in zip(rows, ids, starts):
                if not t:
                    out.append((0, len(s), 0, s, np.zeros(len(s), np.int64)))
                    continue
                i = np.frombuffer(i, "<u4").astype(np.int64)
                n, crossing = allocate(*token_spans(t.encode(), i, size), s, len(t))
                out.append((len(i), len(s), crossing, s, n))
            n, m, crossing, s, c = zip(*out)
            at = pa.array(np.concatenate(([0], np.cumsum(m))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(crossing, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(np.concatenate(s).astype(np.int64))),
                 pa.ListArray.from_arrays(at, pa.array(np.concatenate(c).astype(np.int64)))],
                names=["key", "n_tokens", "n_sections", "n_crossing", "section_start", "section_tokens"])

    out = df.select(df[key].alias("key"), *[df[c].cast("string").alias(f"c{k}") for k, c in enumerate(columns)]).mapInArrow(
        run, f"key {as_sql_type(df, key)}, n_tokens long, n_sections long, n_crossing long, "
             "section_start array<long>, section_tokens array<long>")
    return out.withColumnRenamed("key", key)
