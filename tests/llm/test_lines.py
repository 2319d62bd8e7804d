import duckdb

import corpus_pipeline as cp
from tests.llm.fixtures import documents, empty
from vendorlens.llm import lines


def test_oracle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = sorted(map(tuple, lines.digests(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()))
    want = sorted(con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({lines.ORACLE_SQL})").fetchall())
    assert got == want


def test_oracle_on_templates_and_copies(spark):
    """The SQL and the operator agree on variants, several templates a leaf, near copies and numbers."""
    table = many_templates()
    notice = "this notice stands below very many of our pages and is much longer than their own text " * 3
    table += [(400 + i, f"{notice}\n{own(i, 6)}\n12 13") for i in range(15)] + [(420, table[3][1]), (421, None), (422, "")]
    table += [(430 + i, f"Short line.\n\n{own(i)}\n7 {i}\n5 5\t5") for i in range(12)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    got = sorted(map(tuple, lines.digests(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()))
    want = sorted(con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({lines.ORACLE_SQL})").fetchall())
    assert got == want and sum(r[2] > 0 for r in got) > 60


def test_templates_with_variable_fields(spark):
    rows = [(i, f"{own(i)}\nPosted by user{i} on day {i} of may\n{own(40 + i)}") for i in range(12)]
    assert all(t == f"{own(i)}\n{own(40 + i)}" for i, t in all_dropped(spark, rows).items())
    rows = [(i, f"{own(i)}\nWritten by our author {n} for the daily news\n{own(40 + i)}") for i, n in enumerate(WORDS)]
    assert all("Written by" not in t for t in all_dropped(spark, rows).values())


def test_edges(spark):
    docs = documents(spark).withColumnsRenamed({"key": "n_lines", "row": "doc", "tag": "__salt", "h": "text_hash"})
    out = lines.drop_recurring_lines(docs)
    assert out.columns == ["doc", "n_lines", "n_dropped"] and out.select("doc.*").columns == docs.columns
    assert out.count() == docs.count()
    assert out.where("doc.text IS NULL").count() == docs.where("text IS NULL").count()
    assert {r[0] for r in out.select("doc.`__salt`").distinct().collect()} == {"t"}
    assert lines.drop_recurring_lines(empty(spark)).count() == 0


def test_long_texts(spark):
    long = "\n".join(own(i, 60) for i in range(3000)) * 4
    assert len(long) > 4 << 20
    table = [(i, f"a notice that stands in all of them here\n{t}") for i, t in enumerate([long, "x" * (5 << 20), "\n" * 300_000])]
    table += [(10 + i, f"a notice that stands in all of them here\n{own(i)}") for i in range(9)]
    out = all_dropped(spark, table)
    assert out[0] == long and out[1] == "x" * (5 << 20) and out[10] == own(0)
    assert out[2] == table[2][1]  # it would lose all its lines, and no other such text keeps the notice


def all_dropped(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["text"] for r in cp.line_dedup(spark, docs, "").collect()}


WORDS = "anna bert carl dora emil fred gina hugo ida jens karl lena".split()


def own(i, n=14):
    """A line that no other text has, as long as ``n`` words."""
    return " ".join(WORDS[i % 12] * 2 + chr(97 + (i + j) % 26) + chr(97 + i // 26) + chr(97 + j) for j in range(n))


def test_short_lines_and_copies(spark):
    rows = [(i, f"All rights reserved.\n\n{own(i)}\n{i}") for i in range(12)]
    copy = "a whole article that was copied often\nits second line also stands in all copies"
    rows += [(100 + i, copy) for i in range(30)]
    out = all_dropped(spark, rows)
    assert all(out[i] == f"\n{own(i)}\n{i}" for i in range(12))  # numbers and empty lines stay
    assert all(out[100 + i] == copy for i in range(30))


def test_mostly_recurring_texts(spark):
    notice = "this notice stands below very many of our pages and is much longer than their own text " * 3
    rows = [(i, f"{notice}\n{own(i, 6)}") for i in range(15)] + [(50, f"{notice}\n{own(3, 6)}")] * 2
    out = all_dropped(spark, rows)
    assert len({t for t in out.values() if notice in t}) == 1  # one text keeps it
    assert all(t == own(i, 6) for i, t in out.items() if i < 15 and notice not in t)


def many_templates():
    heads = ["common head words then alpha beta gamma delta", "common head words then eins zwei drei vier",
             "common head words then unus duo tres quattuor"]
    rows = [(i, f"{heads[i % 3]}\n{own(i, 20)}") for i in range(36)]
    # a field that varies, and prose with the same head and length
    rows += [(100 + i, f"common head words by {own(i, 1)} at the mill\n{own(40 + i, 20)}") for i in range(12)]
    prose = [f"common head words {own(60 + i, 5)}" for i in range(60)]
    rows += [(200 + i, f"{t}\n{own(130 + i, 20)}") for i, t in enumerate(prose)]
    # many variants of a line in one text only
    rows.append((300, "\n".join(f"other head words by {own(i, 1)} at the mill" for i in range(20))))
    return rows


def test_many_templates_in_a_leaf(spark):
    rows = many_templates()
    out = all_dropped(spark, rows)
    assert all(out[i] == own(i, 20) for i in range(36))
    assert all(out[100 + i] == own(40 + i, 20) for i in range(12))
    assert all(out[200 + i] == rows[48 + i][1] for i in range(60)) and out[300] == rows[-1][1]
