"""Tables that are replaced as a whole and outlive the session that wrote them.

A table is a folder. Each load writes a version of its own; a numbered manifest that names it is written
last, under a temporary name and then renamed, so readers see the old version or the new one and never a
part. The manifest also keeps the schema and the counts that were observed while writing. Versions that
no manifest of the last ``grace`` seconds names are removed by a later load, so that readers which
resolved the table before can finish.

Everything goes through Hadoop's FileSystem API. A manifest's number can be taken once: of two loads at the
same time the later renames to the next number.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Seconds for which replaced versions stay.
GRACE = 7 * 24 * 3600
MANIFEST = "_manifest-"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def manifests(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(number, time in ms) of the table's manifests, oldest first."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [(st.getPath().getName(), st.getModificationTime()) for st in fs.listStatus(p)]
    return sorted((int(name[len(MANIFEST):]), at) for name, at in found if name.startswith(MANIFEST) and name[len(MANIFEST):].isdigit())


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict:
    """The current manifest of the table at ``path`` (or that with ``number``)."""
    if number is None:
        found = manifests(spark, path)
        if not found:
            raise FileNotFoundError(f"no table at {path}")
        number = found[-1][0]
    fs, p = _fs(spark, f"{path.rstrip('/')}/{MANIFEST}{number:09d}")
    stream = fs.open(p)
    try:
        text = spark._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
    finally:
        stream.close()
    return json.loads(text)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table at ``path``, from any session."""
    m = manifest(spark, path)
    return spark.read.schema(T.StructType.fromJson(m["schema"])).parquet(m["version"])


def publish(spark: SparkSession, path: str, version: str, schema: T.StructType, counts: dict, grace: float = GRACE) -> None:
    """Make ``version`` (a written folder) the current one of the table at ``path``."""
    root = path.rstrip("/")
    fs, p = _fs(spark, root)
    fs.mkdirs(p)
    text = json.dumps({"version": version, "schema": schema.jsonValue(), "written": time.time(), **counts})
    Path = spark._jvm.org.apache.hadoop.fs.Path
    draft = Path(f"{root}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    number = 1 + max((n for n, _ in manifests(spark, root)), default=0)
    while fs.exists(Path(f"{root}/{MANIFEST}{number:09d}")) or not fs.rename(draft, Path(f"{root}/{MANIFEST}{number:09d}")):
        number += 1
    clear(spark, root, grace)


def clear(spark: SparkSession, path: str, grace: float = GRACE) -> None:
    """Remove manifests that were replaced more than ``grace`` seconds ago, and the versions that only they name."""
    root = path.rstrip("/")
    fs, _ = _fs(spark, root)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    found = manifests(spark, root)
    # a manifest was current until the next one came
    old = [n for (n, _), (_, replaced) in zip(found, found[1:]) if replaced < (time.time() - grace) * 1000]
    if not old:
        return
    kept = {manifest(spark, root, n)["version"] for n, _ in found if n not in old}
    for n in old:
        version = manifest(spark, root, n)["version"]
        if version not in kept:
            fs.delete(Path(version), True)
        fs.delete(Path(f"{root}/{MANIFEST}{n:09d}"), False)


def observed(df: DataFrame):
    """``df`` with an observation of its rows, nulls per column and negatives per numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls {c}") for c in df.columns]
    metrics += [F.count_if(F.col(f"`{c}`") < 0).alias(f"negatives {c}") for c in numeric]
    seen = Observation()
    return df.observe(seen, *metrics), seen


def counts_of(seen: Observation) -> dict:
    got = seen.get
    part = lambda kind: {k[len(kind) + 1:]: v for k, v in got.items() if k.startswith(kind + " ")}
    return {"rows": got["rows"], "nulls": part("nulls"), "negatives": part("negatives")}


def replace_table(df: DataFrame, path: str, grace: float = GRACE) -> DataFrame:
    """Write ``df`` as the new version of the table at ``path`` and return that version.

    The table's counts come from the write itself. A write that fails leaves the old version as it is.
    """
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"
    rows, seen = observed(df)
    rows.write.parquet(version)
    publish(spark, path, version, df.schema, counts_of(seen), grace)
    return spark.read.schema(df.schema).parquet(version)
