import json

import duckdb

from vendorlens.llm import chat
from vendorlens.llm.queries import op2_chat_formatting


def test_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    out = op2_chat_formatting(spark, sf_dir)
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({chat.ORACLE_SQL})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_links_order_and_schemas(spark):
    calls = spark.createDataFrame([
        ("c", 5, "add", '{"y": 2.50, "x": 1}', "b"), ("a", 1, "add", '{"x":1,"y":2}', None), ("b", 2, "add", '{"x":"1"}', "a"),
        ("b", 9, "add", "later", None), ("d", 6, "nope", '{"k": [1, 2.0, {"b":1,"a":null}]}', "missing"), ("e", 7, "add", "{bad", "f"),
        ("f", 8, "add", None, "e"), (None, 3, "add", '{"x":1,"y":2,"z":3}', None), ("g", 10, "add", '{"x":1,"y":2}', "e")],
        "id string, at int, tool string, arguments string, after string")
    results = spark.createDataFrame([("a", 3, "three"), ("a", 2, "first"), ("a", 2, "second"), ("zz", 1, "none"), (None, 1, "x"), ("c", 1, None)],
                                    "id string, at int, content string")
    schemas = spark.createDataFrame([("add", "x", "integer", True), ("add", "y", "number", True)], "tool string, param string, type string, required boolean")
    out = {r["id"]: r for r in chat.link_calls(calls, results, schemas).collect()}
    assert {k: r["depth"] for k, r in out.items()} == {"a": 1, "b": 2, "c": 3, "d": 1, "e": None, "f": None, "g": None, None: 1}
    assert {k: list(r["errors"]) for k, r in out.items()} == {
        "a": [], "b": ["missing:y", "type:x"], "c": [], "d": ["tool"], "e": ["json"], "f": ["json"], "g": [], None: ["unknown:z"]}
    assert out["a"]["linked"] and out["c"]["linked"] and not out["b"]["linked"] and not out[None]["linked"]
    assert out["a"]["line"] == '{"arguments":{"x":1,"y":2},"id":"a","name":"add","order":1,"result":"first"}'
    assert out["d"]["line"].startswith('{"arguments":{"k":[1,2,{"a":null,"b":1}]},"id":"d"')
    assert all(json.loads(r["line"])["order"] == r["depth"] for r in out.values())


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, id string, at int, line string"
    rows = [(1, 0, "system", None), (1, 1, "user", "q\n\"x\""), (1, 2, "assistant", "a"), (1, 2, "assistant", "a"), (None, 1, "user", "n"),
            (2, None, "user", "m"), (3, 0, None, "r"), (3, 1, "user", ""), (4, 1, "user", "u"), (4, 1, "user", "u")]
    calls, results = chat.turns_as_calls(spark.createDataFrame([(*r, "i", 1, "l") for r in rows], schema))
    out = chat.link_calls(calls, results, chat.turn_schemas(spark)).collect()
    assert sorted((str(r["id"]), r["depth"], r["linked"], len(r["errors"])) for r in out) == [
        ("1:0", 1, False, 1), ("1:1", 2, True, 0), ("3:1", 1, False, 0), ("4:1", 1, False, 0), ("None", 1, False, 0), ("None", 1, False, 1)]
    calls, results = chat.turns_as_calls(spark.createDataFrame([], schema))
    assert chat.link_calls(calls, results, chat.turn_schemas(spark)).count() == 0
