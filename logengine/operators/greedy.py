"""Greedy cut of ordered lines into batches of at most so many bytes.

A batch takes lines until the next one no longer fits, so where a batch
starts depends on all batches before it. In parallel:

1. Every line has its running byte offset in its group; the offset axis is
   cut into cells of ``CELL`` limits. A line's jump is the first line that
   no longer fits beside it, found by binary search over the running sums;
   it lies in the line's cell or in the first ``limit`` bytes of the next.
2. In each cell the jumps are doubled until they lead out of it. So for each
   line that a batch from the cell before can end at (those in the first
   ``limit`` bytes) it is known where the batches leave the cell, and how
   many there are: a small table instead of the lines.
3. Up to ``FAN`` neighbouring cells' tables are joined end to end into one
   for all of them, level by level, until one node is left for a group. From
   the top down, each node then learns where its first batch starts and the
   number of it.
4. Each cell cuts its own lines from there.

Lines are shuffled once after numbering (offset and size, no text), tables
once a level; no task holds more than a cell's lines or FAN tables. The
steps inside a cell are numpy on Arrow columns: a chain of jumps has no form
in built-in functions but a join of all lines for every doubling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from logengine.session import checkpoint_dir

#: Bytes of a cell, in limits.
CELL = 64
#: Cells or nodes that a node of the next level stands for.
FAN = 256

_NODE = "node long, entry binary, leave binary, many binary"


def _blob(a: np.ndarray) -> pa.Array:
    return pa.array([a.astype("<i8").tobytes()], pa.binary())


def _numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<i8")


def _kept(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def jumps(start: np.ndarray, size: np.ndarray, limit: int) -> np.ndarray:
    """For each line the number of the first that does not fit into a batch which it starts."""
    return np.searchsorted(start + size, start + limit, "right")


def leaves(jump: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the batches from each of the first ``inside`` lines lead beyond these, and how many they are."""
    at, many = jump[:inside].copy(), np.ones(inside, np.int64)
    while (go := np.flatnonzero(at < inside)).size:
        to = at[go]
        many[go], at[go] = many[go] + many[to], at[to]
    return at, many


def greedy_batches(placed: DataFrame, keys: list[str], limit: int, cell_limits: int = CELL, fan: int = FAN) -> DataFrame:
    """``(*keys, batch_no, n_points, n_bytes)`` of lines with ``start`` (running offset in their
    group) and ``n`` (bytes, at least 1): the fewest batches of consecutive lines that hold at
    most ``limit`` bytes each. A line beyond the limit is an error."""
    if cell_limits < 1 or fan < 2:
        raise ValueError("a cell spans at least one limit, a node at least two cells")
    width = cell_limits * limit
    n = F.when(F.col("n") > limit, F.raise_error(F.lit(f"a line does not fit in {limit} bytes"))).otherwise(F.col("n"))
    cell = F.expr(f"start div {width}")
    also = F.when((F.col("start") >= width) & (F.col("start") % width < limit), F.array(cell, cell - 1)).otherwise(F.array(cell))
    lines = placed.select(F.struct(*keys).alias("_g"), "start", n.cast("long").alias("n"), F.explode(also).alias("node"))
    g = lines.schema["_g"].dataType.simpleString()  # of nullable fields, as what the functions return
    g_type = to_arrow_type(_parse_datatype_string(g))

    def keys_of(rows: pa.Table, times: int = 1) -> pa.Array:
        return pa.array([rows.column("_g")[0].as_py()] * times, g_type)

    def table(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        node = key[1].as_py()
        start, size = (rows.column(c).to_numpy() for c in ("start", "n"))
        order = np.argsort(start)
        start, size = start[order], size[order]
        inside = int(np.searchsorted(start, (node + 1) * width))
        leave, many = leaves(jumps(start, size, limit), inside)
        entries = int(np.searchsorted(start, node * width + limit)) if node else min(1, inside)
        ends = np.r_[start, -1]  # beyond the last line there is no batch
        return pa.table([keys_of(rows), pa.array([node]), _blob(start[:entries]), _blob(ends[leave[:entries]]),
                         _blob(many[:entries]), _blob(start), _blob(size)],
                        ["_g", "node", "entry", "leave", "many", "starts", "sizes"])

    def joined(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        children = sorted(rows.to_pylist(), key=lambda r: r["node"])
        entry, at, many = (_numbers(children[0][c]) for c in ("entry", "leave", "many"))
        for child in children[1:]:
            own, leave, more = (_numbers(child[c]) for c in ("entry", "leave", "many"))
            go = at >= 0
            k = np.searchsorted(own, at[go])
            at, many = at.copy(), many.copy()
            many[go] += more[k]
            at[go] = leave[k]
        return pa.table([keys_of(rows), pa.array([key[1].as_py()]), _blob(entry), _blob(at), _blob(many)],
                        ["_g", "node", "entry", "leave", "many"])

    def handed_down(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        children = sorted(rows.to_pylist(), key=lambda r: r["node"])
        at, number, out = children[0]["first"], children[0]["number"], []
        for child in children:
            out.append((child["node"], at, number))
            if at >= 0:
                k = int(np.searchsorted(_numbers(child["entry"]), at))
                at, number = int(_numbers(child["leave"])[k]), number + int(_numbers(child["many"])[k])
        nodes, firsts, numbers = zip(*out, strict=True)
        return pa.table([keys_of(rows, len(out)), pa.array(nodes, pa.int64()),
                         pa.array(firsts, pa.int64()), pa.array(numbers, pa.int64())], ["_g", "node", "first", "number"])

    cells = _kept(lines.groupBy("_g", "node").applyInArrow(table, f"_g {g}, {_NODE}, starts binary, sizes binary"))
    levels = [cells.drop("starts", "sizes")]
    nodes = (cells.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > fan:
        over = levels[-1].withColumn("over", F.expr(f"node div {fan}"))
        levels.append(_kept(over.groupBy("_g", "over").applyInArrow(joined, f"_g {g}, {_NODE}")))
        nodes = -(-nodes // fan)
    # The top nodes of a group are one run; its first batch is number 0 and starts at offset 0.
    known = None
    for level in reversed(levels):
        over = level.withColumn("over", F.expr(f"node div {fan}"))
        if known is None:
            given = over.select("*", F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("number"))
        else:
            given = over.join(known.withColumnRenamed("node", "over"), ["_g", "over"])
        known = given.groupBy("_g", "over").applyInArrow(handed_down, f"_g {g}, node long, first long, number long")

    def cut(batches):
        for batch in batches:
            for r in batch.to_pylist():
                start, size = _numbers(r["starts"]), _numbers(r["sizes"])
                jump, end = jumps(start, size, limit), (r["node"] + 1) * width
                at, rows = int(np.searchsorted(start, r["first"])), []
                while at < len(start) and start[at] < end:
                    to = int(jump[at])
                    rows.append((r["number"] + len(rows), to - at, int(start[to - 1] + size[to - 1] - start[at])))
                    at = to
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([r["_g"]] * len(rows), g_type), *columns],
                                                     ["_g", "batch_no", "n_points", "n_bytes"])

    met = cells.select("_g", "node", "starts", "sizes").join(known.where("first >= 0"), ["_g", "node"])
    found = met.mapInArrow(cut, f"_g {g}, batch_no long, n_points long, n_bytes long")
    return found.select(*[F.col(f"_g.{k}").alias(k) for k in keys], F.col("batch_no").cast("int").alias("batch_no"), "n_points", "n_bytes")
