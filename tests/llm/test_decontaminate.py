import duckdb

from tests.llm.fixtures import documents, empty, rows, sentence
from vendorlens.llm import decontaminate as d


def bench(spark):
    import random
    table = rows()
    rng = random.Random(1)
    items = [("b1", " ".join(table[40][1].split()[:40])), ("b2", "seven Green hills"), ("b3", None), (None, "old mills"), ("b4", ""),
             ("b5", sentence(rng, 50)), ("b1", " ".join(table[41][1].split()[:20])), ("b6", table[70][1])]
    return spark.createDataFrame(items, "item_id string, text string")


def test_oracle(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    found = d.find_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    got = sorted(map(tuple, d.verdicts(found).select(cols).collect()))
    assert got == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({d.ORACLE_SQL})").fetchall())
    assert any(r[-1] for r in got)


def test_blocks_agree_and_offsets_map_back(spark):
    docs, items = documents(spark), bench(spark)
    norm = lambda df: sorted((repr((r[0], r[1], [tuple(s) for s in r[2]], sorted(r[3])))) for r in df.collect())
    one = d.find_spans(docs, items)
    assert one.count() == docs.count()
    assert norm(one) == norm(d.find_spans(docs, items, block_words=25))
    texts = {r[0]: r[1] for r in rows() if r[0] not in (None, 3)}
    seen = 0
    for r in one.where("doc_id IS NOT NULL AND doc_id <> 3 AND size(spans) > 0").collect():
        words = d.normal_words(texts[r["doc_id"]].encode())
        for s in r["spans"]:
            seen += 1
            cut = texts[r["doc_id"]][s["start"]:s["stop"]]
            assert d.normal_words(cut.encode()) == words[s["begin"]:s["end"]]
    assert seen


def test_empty(spark):
    items = bench(spark)
    assert d.verdicts(d.find_spans(empty(spark), items)).count() == 0
    none = d.verdicts(d.find_spans(documents(spark), items.where("false")))
    assert none.where("n_hit > 0 OR contaminated").count() == 0 and none.count() == documents(spark).count()
