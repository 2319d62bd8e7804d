"""Exact order statistics of many columns and groups at once, by counting ranges of 64-bit keys.

A double becomes a 64-bit key of the same order. A first pass counts, inside each task, the
values of every column and group by the key's upper 16 bits, with the least and the greatest value: the
*range summary*, at most 65,536 rows for each column and group. The ranges that hold
the wanted order statistics are then narrowed 16 bits a pass, for all columns, groups and
probabilities at once; once few values are left in them, one pass counts those whole. Nothing is
sorted, and no value but the ranges' counts is shuffled.

Fences and outliers come from the same summary: only the two ranges that hold the fences are looked at again.

Nulls and NaN are missing. -0.0 counts as 0.0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendorlens.session import stored

#: Values that may be left in the wanted ranges for them to be counted whole.
FEW = 1 << 20
#: Groups that the counting tasks know by number; with more, callers sort (see ``ranking``).
MOST_GROUPS = 1 << 16
#: Ranges that a task gathers before it sends them on.
GATHERED = 1 << 19
SIGN = np.uint64(1 << 63)
COUNTS = ["slot", "part", "n", "low", "high"]
COUNTS_SCHEMA = "slot long, part long, n long, low double, high double"


def keys_of(x: np.ndarray) -> np.ndarray:
    """64-bit keys in the order of the doubles."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & SIGN, ~bits, bits | SIGN)


def value_of(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def summed(parts):
    """Counts of equal (slot, part) added up; ``parts`` are tuples of arrays as in ``COUNTS``."""
    slot, part, n, low, high = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((part, slot))
    slot, part, n, low, high = (c[order] for c in (slot, part, n, low, high))
    new = np.flatnonzero(np.concatenate(([True], (slot[1:] != slot[:-1]) | (part[1:] != part[:-1]))))
    return (slot[new], part[new], np.add.reduceat(n, new), np.minimum.reduceat(low, new), np.maximum.reduceat(high, new))


class Selection:
    """The columns ``cols`` of ``df``, per group of ``by`` if given; a target is a (group, column)."""

    def __init__(self, df: DataFrame, cols, by=(), reread: bool = False):
        """``reread``: ``df`` is a table already, so it isn't written once more."""
        self.cols, self.by = list(cols), list(by)
        group = F.xxhash64(*self.by) if self.by else F.lit(0).cast("long")
        rows = df.select(group.alias("_group"), *[F.col(b).alias(f"_by{i}") for i, b in enumerate(self.by)],
                         *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(self.cols)])
        self.rows = rows if reread else stored(rows, "selection")
        self.spark = df.sparkSession
        self.groups = self.summary = None
        self.hashes = np.zeros(1, np.int64)
        self.countable = True
        if self.by:
            names = [f"_by{i}" for i in range(len(self.by))]
            self.groups = stored(self.rows.select("_group", *names).distinct().limit(MOST_GROUPS + 1), "groups")
            hashes = [r[0] for r in self.groups.select("_group").collect()]
            self.hashes = np.unique(np.array(hashes, np.int64))
            self.countable = len(hashes) == len(self.hashes) <= MOST_GROUPS

    def values(self, batch):
        """For each column: the targets and keys of its values in a record batch."""
        group = np.searchsorted(self.hashes, batch.column("_group").to_numpy()) if self.by else np.zeros(len(batch), np.int64)
        for i in range(len(self.cols)):
            x = batch.column(f"_c{i}").to_numpy(zero_copy_only=False).astype(np.float64)
            there = ~np.isnan(x)
            x = x[there] + 0.0
            yield group[there] * len(self.cols) + i, x, keys_of(x)

    def counted(self, cells) -> DataFrame:
        """``COUNTS`` rows of what ``cells`` gives for each batch, combined in the task and again by Spark."""

        def run(batches):
            held, size = [], 0

            def out():
                if held:
                    cols = summed(held)
                    held.clear()
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=COUNTS)

            for batch in batches:
                for slot, part, x in cells(batch):
                    if len(slot):
                        held.append(summed([(slot, part, np.ones(len(x), np.int64), x, x)]))
                        size += len(held[-1][0])
                if size > GATHERED:
                    held[:] = [summed(held)]
                    size = len(held[0][0])
                    if size > GATHERED // 2:
                        yield from out()
                        size = 0
            yield from out()

        rows = self.rows.drop(*[f"_by{i}" for i in range(len(self.by))])
        return rows.mapInArrow(run, COUNTS_SCHEMA).groupBy("slot", "part").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))

    def ranges(self) -> DataFrame:
        """The range summary: ``slot`` (the target), ``part`` (the key's upper 16 bits), ``n``, ``low``, ``high``."""
        if self.summary is None:
            me = self.lean()
            self.summary = stored(self.counted(
                lambda batch: [(t, (k >> np.uint64(48)).astype(np.int64), x) for t, x, k in me.values(batch)]), "ranges")
        return self.summary

    def lean(self):
        """What tasks need of this object (frames and sessions don't travel)."""
        out = object.__new__(Selection)
        out.cols, out.by, out.hashes = self.cols, self.by, self.hashes
        return out

    def quantiles(self, probs) -> dict:
        """{target: (n, [quantile for each probability])}, linearly interpolated; targets without values are absent."""
        before = F.sum("n").over(Window.partitionBy("slot").orderBy("part")) - F.col("n")
        cells = self.ranges().withColumn("before", before).withColumn("total", F.sum("n").over(Window.partitionBy("slot")))
        at = [(F.col("total") - 1).cast("double") * F.lit(float(p)) for p in probs]
        wanted = F.array(*[F.struct(F.lit(i).alias("prob"), F.lit(side).alias("side"), f(x).cast("long").alias("rank"), x.alias("at"))
                           for i, x in enumerate(at) for side, f in enumerate((F.floor, F.ceil))])
        found = (cells.select("slot", "part", "n", "before", "total", F.explode(wanted).alias("w"))
                 .where("before <= w.rank AND w.rank < before + n")
                 .select("slot", "part", "n", "total", "w.prob", "w.side", F.col("w.rank") - F.col("before"), "w.at").collect())
        left = {}  # (target, key's upper bits) -> {rank inside: [(prob, side)]}
        size, place = {}, {}
        for slot, part, n, total, prob, side, rank, x in found:
            left.setdefault((slot, part), {}).setdefault(rank, []).append((prob, side))
            size[slot, part] = n
            place[slot, prob] = (x, total)
        values, bits = {}, 48
        while left:
            step = bits if sum(size.values()) <= FEW else 16
            left, size, bits = self.narrowed(left, bits, step, values)
        out = {}
        for (slot, prob), (x, total) in place.items():
            lo, hi = values[slot, prob, 0], values[slot, prob, 1]
            out.setdefault(slot, (total, [None] * len(probs)))[1][prob] = lo if lo == hi else lo + (hi - lo) * (x - np.floor(x))
        return out

    def narrowed(self, left: dict, bits: int, step: int, values: dict):
        """One pass: the next ``step`` of ``bits`` open bits. Fills ``values`` once none is left."""
        targets = {}
        for slot, part in sorted(left):
            targets.setdefault(slot, []).append(part)
        m = max(map(len, targets.values()))
        table = np.full((m, len(self.hashes) * len(self.cols)), -1, np.int64)
        for slot, parts in targets.items():
            table[:len(parts), slot] = parts
        me, rest = self.lean(), bits - step

        def cells(batch):
            for t, x, key in me.values(batch):
                upper = (key >> np.uint64(bits)).astype(np.int64) if bits < 48 else (key >> np.uint64(48)).astype(np.int64)
                for s in range(m):
                    hit = upper == table[s][t]
                    inner = (key[hit] & np.uint64((1 << bits) - 1)) >> np.uint64(rest)
                    yield t[hit] * m + s, inner.astype(np.int64), x[hit]

        counts = self.counted(cells)
        before = F.sum("n").over(Window.partitionBy("slot").orderBy("part")) - F.col("n")
        asked = [(slot * m + parts.index(part), part, rank) for slot, parts in targets.items() for part in parts for rank in left[slot, part]]
        want = self.spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*asked)], names=["slot", "upper", "rank"]))
        got = (counts.withColumn("before", before).join(want, "slot").where("before <= rank AND rank < before + n")
               .select("slot", "upper", "rank", "part", "n", "before").collect())
        after, size = {}, {}
        for s, upper, rank, part, n, before_it in got:
            key, users = upper << step | part, left[s // m, upper][rank]
            if rest == 0:
                values.update({(s // m, prob, side): value_of(key) for prob, side in users})
            else:
                after.setdefault((s // m, key), {}).setdefault(rank - before_it, []).extend(users)
                size[s // m, key] = n
        return after, size, rest

    def between(self, fences: dict) -> dict:
        """{target: (values inside, least and greatest of them)} for {target: (lower, upper)}, bounds included."""
        if not fences:
            return {}
        slots = sorted(fences)
        lower, upper = (np.array([fences[s][i] for s in slots], np.float64) for i in (0, 1))
        a, b = ((keys_of(x) >> np.uint64(48)).astype(np.int64) for x in (lower, upper))
        table = pa.table([pa.array(slots, pa.int64()), pa.array(a), pa.array(b)], names=["slot", "a", "b"])
        whole = (self.ranges().join(self.spark.createDataFrame(table), "slot").where("a < part AND part < b")
                 .groupBy("slot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")))
        count = len(self.hashes) * len(self.cols)
        edge = np.full((2, count), -1, np.int64)
        fence = np.full((2, count), np.nan)
        edge[:, slots], fence[:, slots] = (a, b), (lower, upper)
        me = self.lean()

        def cells(batch):
            for t, x, key in me.values(batch):
                part = (key >> np.uint64(48)).astype(np.int64)
                hit = ((part == edge[0][t]) | (part == edge[1][t])) & (x >= fence[0][t]) & (x <= fence[1][t])
                yield t[hit], np.zeros(int(hit.sum()), np.int64), x[hit]

        both = whole.unionByName(self.counted(cells).drop("part"))
        rows = both.groupBy("slot").agg(F.sum("n"), F.min("low"), F.max("high")).collect()
        return {s: tuple(r) for s, *r in rows}

    def extremes(self) -> dict:
        """{target: (least, greatest value)}."""
        return {s: (lo, hi) for s, lo, hi in self.ranges().groupBy("slot").agg(F.min("low"), F.max("high")).collect()}

    def frame(self, rows: dict, fields: list[tuple[str, pa.DataType]]) -> DataFrame:
        """The groups' columns, ``column`` and ``fields``, a row for each target in ``rows``."""
        slots = sorted(rows)
        k = len(self.cols)
        data = [pa.array([int(self.hashes[s // k]) for s in slots], pa.int64()), pa.array([self.cols[s % k] for s in slots], pa.string())]
        data += [pa.array([rows[s][i] for s in slots], kind) for i, (_, kind) in enumerate(fields)]
        out = self.spark.createDataFrame(pa.table(data, names=["_group", "column", *[f for f, _ in fields]]))
        if not self.by:
            return out.drop("_group")
        back = [F.col(f"_by{i}").alias(b) for i, b in enumerate(self.by)]
        return self.groups.join(out, "_group").select(*back, "column", *[f for f, _ in fields])
