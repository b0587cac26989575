"""Numeric band join by a sweep over sorted events: totals of all pairs, ranked nearest pairs.

A centre (item_id, p) pairs with every point (sale_id, line_no, item_id, u) of another item_id
whose gap |u - p| is at most w(p), the larger of ``least`` and ``per_mille`` thousandths of p.
For each centre's interval the events start (p - w), price (p) and end (p + w) are united
with the points and sorted over all partitions. A task walks its range once: it keeps running
totals, the candidates before the place where it is, and the set of active centres, each
with a bounded heap of the candidates after it. What a range adds to later and to earlier ones
(totals, at most 2k candidates either way) is carried over in blocks of ranges, so no task
and not the driver sees all ranges.

Before the sort, points are counted for each u, and for each (item_id, u), as a centre's own
points are taken off again by a sweep within its item; only the first 2k points of a u, at
most k of an item, can be among anyone's first k. So neither a value nor an item that holds a
third of all rows makes a large group, and work is that of sorting distinct values.

Nulls: points with a null item_id, sale_id or u, and centres with a null item_id or p never
pair. A null line_no pairs, sorts first and is empty in the checksum. Repeated points count
and rank each; repeated centres give their rows each. Further columns are ignored, empty
tables give no rows (centres without points: one row of rank 0).
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

START, POINTS, POINT, PRICE, END = range(5)
#: Stands for a null line_no while sorting; no line has it.
NO_LINE = -(1 << 63)
ORDER = ["own", "g", "pos", "role", "sale_id", "line_no", "item_id"]
PLACES = "array<struct<u:bigint,sale_id:bigint,line_no:bigint,item_id:bigint>>"
PLACES_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("u", "sale_id", "line_no", "item_id")]))
SWEPT = f"part int, own int, item bigint, p bigint, role int, n bigint, su bigint, sc bigint, low {PLACES}, high {PLACES}"
SWEPT_ARROW = pa.schema([("part", pa.int32()), ("own", pa.int32()), ("item", pa.int64()), ("p", pa.int64()), ("role", pa.int32()), ("n", pa.int64()), ("su", pa.int64()), ("sc", pa.int64()), ("low", PLACES_ARROW), ("high", PLACES_ARROW)])
CARRY = f"part int, n decimal(38,0), su decimal(38,0), sc decimal(38,0), low {PLACES}, high {PLACES}"

Place = tuple[int, int, int, int]


def cents(x: Column) -> Column:
    """floor(100 x + 0.5) in doubles; null for null and for what is not finite."""
    x = x.cast("double")
    fine = ~F.isnan(x) & (F.abs(x) < F.lit(9e15))
    return F.when(fine, F.floor(F.lit(100.0) * x + F.lit(0.5))).cast("long")


def unit_cents(amount: Column, quantity: Column) -> Column:
    """floor((2 a + q) / (2 q)) in exact integers; null for a quantity of zero."""
    q = quantity.cast("long")
    over, under = F.lit(2).cast("long") * amount + q, F.lit(2).cast("long") * q
    over, under = F.when(q < 0, -over).otherwise(over), F.abs(under)
    known = F.when(under > 0, under)
    return F.call_function("div", over - F.pmod(over, known), known)


def width(p: Column, least: int, per_mille: int) -> Column:
    """The largest gap that a centre at ``p`` accepts."""
    return F.greatest(F.lit(least).cast("long"), F.call_function("div", p * per_mille, F.lit(1000)))


# --- candidates ------------------------------------------------------------------------


def first_places(places: list[Place], k: int) -> list[Place]:
    """The first 2k of sorted places, at most k of an item: whatever item is left out, the first k others are in it."""
    count: dict[int, int] = {}
    out: list[Place] = []
    for x in places:
        if count.get(x[3], 0) < k:
            count[x[3]] = count.get(x[3], 0) + 1
            out.append(x)
            if len(out) == 2 * k:
                break
    return out


def before(places: list[Place], k: int) -> list[Place]:
    """The candidates nearest from below."""
    return first_places(sorted(places, key=lambda x: (-x[0], *x[1:])), k)


def after(places: list[Place], k: int) -> list[Place]:
    """The candidates nearest from above."""
    return first_places(sorted(places), k)


class Active:
    """A centre that waits for candidates after it: a heap of at most 2k, k of an item."""

    def __init__(self, row: tuple, low: list[Place]):
        self.row, self.low, self.high = row, low, []
        self.count: dict[int, int] = {}

    def push(self, x: Place, k: int) -> bool:
        """False if this heap, and so each older one, has no use for the candidate."""
        if len(self.high) == 2 * k or self.count.get(x[3], 0) == k:
            return False
        self.count[x[3]] = self.count.get(x[3], 0) + 1
        self.high.append(x)
        return True


class Sweep:
    """The walk over a range of events in order."""

    def __init__(self, k: int):
        self.k, self.u = k, None
        self.now: list[Place] = []
        self.past: list[Place] = []
        self.first: list[Place] = []
        self.active: list[Active] = []
        self.done: list[Active] = []

    def point(self, x: Place) -> None:
        if x[0] != self.u:
            self.past, self.now, self.u = first_places(self.now + self.past, self.k), [], x[0]
        self.now.append(x)
        if len(self.first) < 2 * self.k and sum(y[3] == x[3] for y in self.first) < self.k:
            self.first.append(x)
        # an older heap has seen all that a newer one has: where one refuses, the older ones do
        for heap in reversed(self.active):
            if not heap.push(x, self.k):
                break

    def price(self, row: tuple) -> None:
        self.active.append(Active(row, first_places(self.now + self.past, self.k)))

    def end(self, p: int) -> None:
        """Centres up to ``p`` are closed; ends come in the order of prices."""
        while self.active and self.active[0].row[1] <= p:
            self.done.append(self.active.pop(0))

    def taken(self) -> list[Active]:
        out, self.done = self.done, []
        return out


def swept(k: int):
    """The function of a partition of sorted events: each query's totals within the partition, and the partition's own row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, totals, part = Sweep(k), np.zeros(3, np.int64), None

        def rows(found: list[Active]) -> pa.RecordBatch:
            columns = list(zip(*((part, 0, *a.row[:2], PRICE, *a.row[2:], a.low, a.high) for a in found), strict=True)) or [[]] * 10
            return pa.RecordBatch.from_arrays([pa.array([[dict(zip(("u", "sale_id", "line_no", "item_id"), x, strict=True)) for x in v] if n > 7 else v for v in c], t.type) for n, (c, t) in enumerate(zip(columns, SWEPT_ARROW, strict=True))], schema=SWEPT_ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            own, g, pos, role, sale, line, item, p, n, su, sc, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(12))
            part = int(at[0])
            running = np.stack([np.cumsum(x) for x in (n, su, sc)]) + totals[:, None]
            totals = running[:, -1].copy()
            main = np.flatnonzero(own == 0)
            for i, r, x, q in zip(main.tolist(), role[main].tolist(), pos[main].tolist(), p[main].tolist(), strict=True):
                if r == POINT:
                    state.point((x, int(sale[i]), int(line[i]), int(item[i])))
                elif r == PRICE:
                    state.price((0, q, *running[:, i].tolist()))
                elif r == END:
                    state.end(q)
            # all queries but the prices of the outer sweep, which wait for their heaps
            asks = np.flatnonzero(((role == START) | (role == PRICE) | (role == END)) & ((own == 1) | (role != PRICE)))
            empty = pa.array([[]] * len(asks), PLACES_ARROW)
            whole = pa.array(np.full(len(asks), part, np.int32))
            yield pa.RecordBatch.from_arrays([whole, pa.array(own[asks].astype(np.int32)), pa.array(g[asks]), pa.array(p[asks]), pa.array(role[asks].astype(np.int32)), *(pa.array(running[j, asks]) for j in range(3)), empty, empty], schema=SWEPT_ARROW)
            yield rows(state.taken())
        if part is not None:
            yield rows(state.active)
            last = Active((0, 0, *totals.tolist()), first_places(state.now + state.past, k))
            last.high = state.first
            row = rows([last])
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()) if name == "own" else c for name, c in zip(SWEPT_ARROW.names, row.columns, strict=True)], schema=SWEPT_ARROW)

    return run


# --- what ranges carry to each other -----------------------------------------------------


def _places(column) -> list[list[Place]]:
    return [[(x["u"], x["sale_id"], x["line_no"], x["item_id"]) for x in v] for v in column]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["part", "n", "su", "sc", "low", "high"]
    listed = lambda v: [dict(zip(("u", "sale_id", "line_no", "item_id"), x, strict=True)) for x in v]
    return pd.DataFrame([(r[0], *(Decimal(x) for x in r[1:4]), listed(r[4]), listed(r[5])) for r in rows], columns=names)


def carried(sums: DataFrame, k: int, fan: int = 256) -> DataFrame:
    """Of each part: the totals and last candidates of all parts before, the first candidates of all after.

    ``fan`` neighbouring parts are one group; the groups' own sums are carried likewise.
    """
    number = sums.agg(F.max("part").alias("m")).first()["m"]

    def inside(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        parts, low, high = frame["part"].tolist(), _places(frame["low"]), _places(frame["high"])
        out, so_far, kept = [], [0, 0, 0], []
        for part, own, x in zip(parts, zip(frame["n"], frame["su"], frame["sc"], strict=True), low, strict=True):
            out.append([part, *so_far, kept])
            so_far = [a + int(b) for a, b in zip(so_far, own, strict=True)]
            kept = before(kept + x, k)
        kept = []
        for row, x in zip(reversed(out), reversed(high), strict=True):
            row.append(kept)
            kept = after(kept + x, k)
        return _frame(out)

    def whole(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        low = before([x for v in _places(frame["low"]) for x in v], k)
        high = after([x for v in _places(frame["high"]) for x in v], k)
        return _frame([(int(key[0]), *(sum(int(x) for x in frame[c]) for c in ("n", "su", "sc")), low, high)])

    block = F.floor(F.col("part") / fan).cast("int")
    within = sums.groupBy(block).applyInPandas(inside, CARRY)
    if number is None or number < fan:
        return within
    outer = carried(sums.groupBy(block).applyInPandas(whole, CARRY), k, fan)
    outer = outer.select(F.col("part").alias("block"), *(F.col(c).alias(f"o_{c}") for c in ("n", "su", "sc", "low", "high")))
    both = within.join(outer, block == F.col("block"))
    return both.select("part", *((F.col(c) + F.col(f"o_{c}")).cast("decimal(38,0)").alias(c) for c in ("n", "su", "sc")), *(F.concat(c, f"o_{c}").alias(c) for c in ("low", "high")))


# --- the join ------------------------------------------------------------------------------


def events(points: DataFrame, centres: DataFrame, k: int, least: int, per_mille: int) -> DataFrame:
    """Sorted events' rows (own, g, pos, role, sale_id, line_no, item_id, p, n, su, sc) of both sweeps."""
    zero, none = F.lit(0).cast("long"), F.lit(0).cast("int")
    fine = points.where("item_id IS NOT NULL AND sale_id IS NOT NULL AND u IS NOT NULL").select(
        "u", "item_id", "sale_id", F.coalesce(F.col("line_no").cast("long"), F.lit(NO_LINE)).alias("line_no"),
        F.crc32(F.concat(F.col("sale_id").cast("string"), F.lit(","), F.coalesce(F.col("line_no").cast("string"), F.lit("")), F.lit(","), F.col("item_id").cast("string"))).alias("crc"),
    )
    by_item = fine.groupBy("item_id", "u").agg(F.count(F.lit(1)).alias("n"), F.sum("crc").alias("sc"))
    by_value = fine.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.sum("crc").alias("sc"))
    of_item = Window.partitionBy("u", "item_id").orderBy("sale_id", "line_no")
    of_value = Window.partitionBy("u").orderBy("sale_id", "line_no", "item_id")
    few = fine.select("u", "item_id", "sale_id", "line_no").withColumn("r", F.row_number().over(of_item)).where(F.col("r") <= k).drop("r")
    few = few.withColumn("r", F.row_number().over(of_value)).where(F.col("r") <= 2 * k).drop("r")

    counted = lambda own, g: [F.lit(own).alias("own"), g.alias("g"), F.col("u").alias("pos"), F.lit(POINTS).alias("role"), zero.alias("sale_id"), zero.alias("line_no"), zero.alias("item_id"), zero.alias("p"), F.col("n"), (F.col("n") * F.col("u")).alias("su"), F.col("sc")]
    out = by_value.select(*counted(0, zero)).union(by_item.select(*counted(1, F.col("item_id"))))
    out = out.union(few.select(F.lit(0), zero, "u", F.lit(POINT), "sale_id", "line_no", "item_id", zero, zero, zero, zero))
    w = width(F.col("p"), least, per_mille)
    asked = F.explode(F.array(*(F.struct(pos.alias("pos"), F.lit(role).alias("role")) for pos, role in ((F.col("p") - w, START), (F.col("p"), PRICE), (F.col("p") + w, END)))))
    prices = centres.where("p IS NOT NULL AND item_id IS NOT NULL")
    outer = prices.select("p").distinct().select(none.alias("own"), zero.alias("g"), "p", asked.alias("e"))
    own = prices.select("item_id", "p").distinct().select(F.lit(1).alias("own"), F.col("item_id").alias("g"), "p", asked.alias("e"))
    ends = outer.union(own).select("own", "g", "e.pos", "e.role", zero, zero, zero, "p", zero, zero, zero)
    return out.union(ends)


def band_join(points: DataFrame, centres: DataFrame, *, k: int = 5, least: int = 10, per_mille: int = 2, parts: int | None = None, fan: int = 256) -> DataFrame:
    """(item_id, rank, gap, u, sale_id, line_no, line_item_id, n_pairs, gap_sum, lines_crc) of each centre.

    The first ``k`` pairs by (gap, u, sale_id, line_no, line_item_id), null line_no first, and
    the number, summed gaps and summed crc32 of "sale_id,line_no,item_id" over all pairs. Centres
    without pairs have one row of rank 0, nulls and zeros. ``parts`` ranges are sorted.
    """
    spark = points.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = events(points, centres, k, least, per_mille).repartitionByRange(parts, *ORDER, "p").sortWithinPartitions(*ORDER, "p")
    found = materialize(placed.withColumn("part", F.spark_partition_id()).mapInArrow(swept(k), SWEPT), "band")

    to_carry = found.where("own = -1").select("part", *(F.col(c).cast("decimal(38,0)").alias(c) for c in ("n", "su", "sc")), "low", "high")
    carry = carried(to_carry, k, fan).select(F.col("part").alias("of"), *(F.col(c).alias(f"c_{c}") for c in ("n", "su", "sc", "low", "high")))
    asked = found.where("own >= 0").join(carry, F.col("part") == F.col("of"))
    added = lambda c: (F.col(c) + F.col(f"c_{c}")).cast("decimal(38,0)")
    at = lambda c, role: F.max(F.when(F.col("role") == role, added(c)))
    price = F.col("role") == PRICE
    sums = asked.groupBy("own", "item", "p").agg(
        *(at(c, r).alias(f"{c}{r}") for c in ("n", "su", "sc") for r in (START, PRICE, END)),
        F.max(F.when(price, F.concat("low", "c_low", "high", "c_high"))).alias("near"),
    )
    # pairs below and above the price: p - u summed over the former, u - p over the latter
    gaps = F.col("p") * (F.col(f"n{PRICE}") - F.col(f"n{START}")) - (F.col(f"su{PRICE}") - F.col(f"su{START}")) + (F.col(f"su{END}") - F.col(f"su{PRICE}")) - F.col("p") * (F.col(f"n{END}") - F.col(f"n{PRICE}"))
    sums = sums.select("own", "item", "p", (F.col(f"n{END}") - F.col(f"n{START}")).cast("long").alias("n"), gaps.cast("long").alias("gaps"), (F.col(f"sc{END}") - F.col(f"sc{START}")).cast("decimal(38,0)").alias("crc"), "near")

    outer = sums.where("own = 0").select(F.col("p").alias("p0"), F.col("n").alias("n0"), F.col("gaps").alias("g0"), F.col("crc").alias("c0"), "near")
    own = sums.where("own = 1").select(F.col("item").alias("item1"), F.col("p").alias("p1"), F.col("n").alias("n1"), F.col("gaps").alias("g1"), F.col("crc").alias("c1"))
    each = centres.select("item_id", "p")
    # a null centre meets nothing; prices of null items are not asked for
    each = each.join(outer, (F.col("p") == F.col("p0")) & F.col("item_id").isNotNull(), "left")
    each = each.join(own, (F.col("item_id") == F.col("item1")) & (F.col("p") == F.col("p1")), "left")
    fits = F.filter("near", lambda x: (x["item_id"] != F.col("item_id")) & (F.abs(x["u"] - F.col("p")) <= width(F.col("p"), least, per_mille)))
    ranked = F.transform(fits, lambda x: F.struct(F.abs(x["u"] - F.col("p")).alias("gap"), x["u"].alias("u"), x["sale_id"].alias("sale_id"), x["line_no"].alias("line_no"), x["item_id"].alias("line_item_id")))
    less = lambda a, b: (F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))).cast("long")
    each = each.select("item_id", F.slice(F.array_sort(ranked), 1, k).alias("best"), less(F.col("n0"), F.col("n1")).alias("n_pairs"), less(F.col("g0"), F.col("g1")).alias("gap_sum"), less(F.col("c0"), F.col("c1")).alias("lines_crc"))
    out = each.select("item_id", F.posexplode_outer("best").alias("r", "x"), "n_pairs", "gap_sum", "lines_crc")
    line_no = F.when(F.col("x.line_no") != NO_LINE, F.col("x.line_no")).alias("line_no")
    return out.select("item_id", F.coalesce(F.col("r") + 1, F.lit(0)).alias("rank"), "x.gap", "x.u", "x.sale_id", line_no, "x.line_item_id", "n_pairs", "gap_sum", "lines_crc")
