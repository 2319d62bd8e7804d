"""Line dedup with a log-template tree, in DataFrame functions only.

A line's tokens are its runs of characters other than ASCII white space; a token with a
digit is a variable field. A line that is nothing but such fields is compared as it stands, and lines
without tokens stay. The tree has a fixed depth: the token count, then the leading ``depth`` tokens; a leaf holds
all lines that agree in both. The other tokens of a line are cut into up to ``FIELDS`` runs (one
token each in a short line); a line of at most ``depth`` tokens has a leaf of its own.

A leaf has any number of templates: each choice of ``similarity`` of the fields, with their values, that
lines of ``min_docs`` distinct texts share, and each masked line that ``min_docs`` distinct texts hold. All
lines that follow one are dropped. Exact copies count once, so they don't make their own lines recurring. Of
texts that would lose more than half of themselves (by the characters of their distinct lines) and share their longest
recurring line (the first of equally long ones), that with the least md5 keeps its text, so that it
stays in the corpus once; all others lose their recurring lines.

Defined results: a null text stays null and has no lines; documents are counted by text; all columns are
kept, whatever their names; rows that are repeated get the same text; an empty table stays empty.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import salted_join, stored

FIELDS = 8
_SPACE = r"[ \t\r\f\x0B]"


def tidied(line: Column) -> Column:
    """The tokens of a line joined by one space."""
    return F.regexp_replace(F.regexp_replace(line, rf"^{_SPACE}+|{_SPACE}+$", ""), f"{_SPACE}+", " ")


def compared(line: Column) -> Column:
    """The tokens of a line joined by one space, those with a digit as ``<*>`` unless nothing else is left.

    Most lines are neither untidy nor hold a digit: they pass as they are, after plain searches.
    """
    tidy = F.when(line.startswith(" ") | line.endswith(" ") | F.contains(line, F.lit("  ")) | F.contains(line, F.lit("\t"))
                  | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\f")) | F.contains(line, F.lit("\x0b")), tidied(line)).otherwise(line)
    # from the start of a token, without backtracking over its characters
    masked = F.regexp_replace(tidy, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", "<*>")
    return F.when(line.rlike("[0-9<]"), F.when(masked.rlike(r"^<\*>( <\*>)*$"), tidy).otherwise(masked)).otherwise(tidy)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def every_line(docs: DataFrame, text: str, depth: int) -> DataFrame:
    """The distinct compared lines of each distinct text: ``text_hash``, ``line``, ``leaf``, ``fields`` as hashes,
    ``pos`` among them, ``size`` in characters and the ``total`` of the text."""
    own = F.filter(F.array_distinct(F.transform(lines_of(F.col(text)), compared)), lambda x: x != "")
    each = (docs.select("text_hash", own.alias("own"))
            .withColumn("total", F.aggregate("own", F.lit(0).cast("long"), lambda s, x: s + F.length(x)))
            .select("text_hash", "total", F.posexplode("own").alias("pos", "masked"))
            .withColumn("tokens", F.split("masked", " ")).withColumn("n", F.size("tokens"))
            .withColumn("m", F.greatest(F.col("n") - depth, F.lit(0))).withColumn("k", F.least(F.col("m"), F.lit(FIELDS))))
    cut = F.expr(f"if(k = 0, cast(array() as array<bigint>), transform(sequence(0, greatest(k - 1, 0)), j -> xxhash64(array_join("
                 f"slice(tokens, {depth + 1} + cast(j * m div k as int), cast((j + 1) * m div k - j * m div k as int)), ' '))))")
    return each.select("text_hash", F.xxhash64("masked").alias("line"),
                       F.xxhash64("n", F.array_join(F.slice("tokens", 1, depth), " ")).alias("leaf"), cut.alias("fields"),
                       "pos", F.length("masked").alias("size"), "total").dropDuplicates(["text_hash", "line"])


def choices(similarity: float) -> Column:
    """The sets of fields, as bits, that make a template of a line with ``k`` fields."""
    every = [[sum(1 << i for i in c) for c in combinations(range(k), max(1, ceil(similarity * k - 1e-9)))] for k in range(1, FIELDS + 1)]
    return F.expr(f"element_at(array({', '.join('array(' + ', '.join(map(str, c)) + ')' for c in every)}), size(fields))")


def every_recurring(docs: DataFrame, text: str, depth: int, similarity: float, min_docs: int) -> DataFrame:
    """The recurring lines of each distinct text: ``text_hash``, ``drop`` (hashes of compared lines)."""
    lines = stored(every_line(docs, text, depth), "every-line")
    kinds = stored(lines.groupBy("line").agg(F.first("leaf").alias("leaf"), F.first("fields").alias("fields"),
                                             F.count("*").alias("docs")), "every-kind")
    often = kinds.where(F.col("docs") >= min_docs).select("line")
    # fields whose value is frequent at their place, those of a frequent line among them
    fields = kinds.select("line", "docs", "leaf", F.posexplode("fields").alias("pos", "value"))
    frequent = (fields.groupBy("leaf", "pos", "value").agg(F.sum("docs").alias("n"))
                .where(F.col("n") >= min_docs).select("leaf", "pos", "value"))
    bits = (salted_join(fields, frequent, ["leaf", "pos", "value"], "inner", salts=8)
            .groupBy("line").agg(F.expr("bit_or(shiftleft(1, pos))").alias("bits")))
    of = F.expr("xxhash64(leaf, choice, transform(fields, (v, i) -> if((shiftright(choice, i) & 1) = 1, v, null)))")
    chosen = stored(kinds.where(F.size("fields") > 0).join(bits, "line")
                    .withColumn("choice", F.explode(F.filter(choices(similarity), lambda c: c.bitwiseAND(F.col("bits")) == c)))
                    .select("line", "docs", of.alias("template")), "line-choices")
    # a template with a frequent line recurs; any other has rare lines only, in fewer than min_docs texts each
    sums = chosen.groupBy("template").agg(F.sum("docs").alias("n"), F.max("docs").alias("most"), F.count("*").alias("lines"))
    sums = stored(sums.where((F.col("n") >= min_docs) & (F.col("lines") > 1)), "line-templates")
    open_ = sums.where(F.col("most") < min_docs).select("template")
    rare = chosen.where(F.col("docs") < min_docs).select("line", "template")
    counted = (salted_join(lines.select("text_hash", "line"), salted_join(rare, open_, ["template"], "inner", salts=8), ["line"], "inner", salts=8)
               .select("template", "text_hash").distinct().groupBy("template").agg(F.count("*").alias("n"))
               .where(F.col("n") >= min_docs).select("template"))
    found = sums.where(F.col("most") >= min_docs).select("template").unionByName(counted)
    follow = stored(salted_join(rare, found, ["template"], "inner", salts=8).select("line").distinct().unionByName(often), "every-follow")
    hits = salted_join(lines.select("text_hash", "line", "pos", "size", "total"), follow, ["line"], "inner", salts=8)
    gone = stored(hits.groupBy("text_hash").agg(
        F.collect_list("line").alias("drop"), F.max(F.struct("size", -F.col("pos"), "line"))["line"].alias("longest"),
        (2 * F.sum("size") > F.first("total")).alias("most")), "every-hit")  # a text's own lines
    stays = gone.where("most").groupBy("longest").agg(F.min("text_hash").alias("text_hash")).select("text_hash")
    return gone.select("text_hash", "drop").join(stays, "text_hash", "left_anti")


def drop_recurring_lines(docs: DataFrame, text: str = "text", depth: int = 3, similarity: float = 0.6,
                         min_docs: int = 10) -> DataFrame:
    """``doc``, a struct of the columns of ``docs`` with recurring lines taken out of ``text``; ``n_lines`` and
    ``n_dropped`` count the lines before and those that went. A row per row of ``docs``."""
    own = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("doc"), F.unhex(F.md5(F.col(f"`{text}`"))).alias("text_hash"))
    whole = F.col(f"doc.`{text}`")
    gone = every_recurring(rows.select("text_hash", whole.alias("text")), "text", depth, similarity, min_docs)
    out = salted_join(rows, gone, ["text_hash"], salts=8)
    kept = F.filter(lines_of(whole), lambda x: ~F.array_contains("drop", F.xxhash64(compared(x))))
    out = out.withColumn("kept", F.when(F.col("drop").isNotNull(), kept))
    count = F.size(lines_of(whole))
    new = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(whole)
    return out.select(
        F.struct(*[new.alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in own]).alias("doc"),
        F.when(whole.isNull(), 0).otherwise(count).cast("long").alias("n_lines"),
        F.when(F.col("kept").isNotNull(), count - F.size("kept")).otherwise(0).cast("long").alias("n_dropped"))


def digests(docs: DataFrame) -> DataFrame:
    """Lines, dropped lines and the digest of the text that stays, a row per document."""
    return drop_recurring_lines(docs.select("doc_id", "text")).select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH line AS (
  SELECT text, i, raw, list_filter(regexp_split_to_array(raw, '[ \t\r\f\x0B]+'), lambda t: t <> '') AS t
  FROM (SELECT text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL))),
compared AS (
  SELECT text, i, raw, CASE WHEN len(list_filter(t, lambda x: NOT regexp_matches(x, '[0-9]') AND x <> '<*>')) = 0 THEN t
         ELSE list_transform(t, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) END AS w FROM line),
own AS (SELECT text, w, min(i) AS i, length(array_to_string(w, ' ')) AS size FROM compared WHERE len(w) > 0 GROUP BY text, w),
kind AS (SELECT w, len(w) AS n, greatest(len(w) - 3, 0) AS m, least(8, greatest(len(w) - 3, 0)) AS k, count(*) AS docs FROM own GROUP BY w),
fields AS (SELECT w, n, k, list_transform(range(k), lambda j: w[4 + (j * m) // k : 3 + ((j + 1) * m) // k]) AS f FROM kind WHERE k > 0),
choice AS (
  SELECT w, n, w[1:3] AS head, mask, list_transform(range(k), lambda j: CASE WHEN (mask >> j) & 1 = 1 THEN f[j + 1] END) AS v
  FROM fields JOIN (SELECT range AS mask FROM range(1, 256)) ON mask < (1 << k) AND bit_count(mask) = greatest(1, CAST(ceil(0.6 * k - 1e-9) AS INT))),
template AS (SELECT n, head, mask, v FROM choice JOIN own USING (w) GROUP BY ALL HAVING count(DISTINCT text) >= 10),
follow AS (SELECT w FROM kind WHERE docs >= 10 UNION SELECT DISTINCT c.w FROM choice c JOIN template t
           ON t.n = c.n AND t.head = c.head AND t.mask = c.mask AND t.v IS NOT DISTINCT FROM c.v),
share AS (SELECT text, sum(size) AS total FROM own GROUP BY text),
hit AS (SELECT own.text, arg_max(own.w, (own.size, -own.i)) AS longest, 2 * sum(own.size) > any_value(share.total) AS most
        FROM own JOIN follow USING (w) JOIN share ON share.text = own.text GROUP BY own.text),
stays AS (SELECT arg_min(text, md5(text)) AS text FROM hit WHERE most GROUP BY longest),
cut AS (
  SELECT c.text, count(follow.w) AS n_dropped, string_agg(c.raw, chr(10) ORDER BY c.i) FILTER (follow.w IS NULL) AS rest
  FROM compared c JOIN hit ON hit.text = c.text LEFT JOIN follow ON follow.w = c.w
  WHERE c.text NOT IN (SELECT text FROM stays) GROUP BY c.text)
SELECT doc_id, CAST(CASE WHEN doc.text IS NULL THEN 0 ELSE len(string_split(doc.text, chr(10))) END AS BIGINT) AS n_lines,
       CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       sha256(CASE WHEN cut.text IS NULL THEN coalesce(doc.text, '') ELSE coalesce(rest, '') END) AS kept_sha256
FROM documents doc LEFT JOIN cut ON cut.text = doc.text
"""
