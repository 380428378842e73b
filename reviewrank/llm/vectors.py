"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors within the distance that a cosine allows are linked. Vectors are rotated to their principal
axes, sorted by the grid cells of the leading ones, and cut into blocks by their rank in that order. A
tree of boxes stands over the sequence of blocks; starting with the whole sequence against itself, pairs
of intervals are split again and again, and pairs whose boxes are provably farther apart than the distance
are skipped. What is left are pairs of blocks, which are compared one by one, in double precision on
the vectors as given. A task returns, for each vector, how many it is linked with and one root of its
component among the pairs of the task, and holds the links of one pair at a time; no table holds them.

Equal vectors are grouped first and compared once. The principal axes come from the second moments of all
vectors; they steer the order only, the result is exact whatever they are.

Pairs of blocks are dealt to tasks as tiles: a stretch of the sequence against a stretch, with the pairs
between them. A block goes once to each tile that needs it, so what is moved grows with the number of
stretches, which is bounded while a stretch fits a task's memory, and not with the number of pairs.

Defined cases: null, zero and non-finite vectors, vectors with null components and vectors of another
length than most (the shorter of equals) link with nothing; rows that repeat a vec_id count as one, with
the smallest vector; rows with a null vec_id are left out; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewrank.llm.components import components
from reviewrank.session import written

#: Leading axes in the grid order, cells per distance, vectors of a block and of one row of it, and
#: intervals under one node of the tree.
AXES, CELLS, BLOCK, PAGE, FAN = 8, 2, 2048, 256, 8
#: Bytes of vectors in one side of a tile.
TILE_BYTES = 32 << 20
#: Slack for rounding when boxes are compared.
SLACK = 1e-9


def _valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Principal axes as columns; the driver gets one matrix of ``size`` squared sums."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((size, size))
        for batch in batches:
            x = np.array(batch.column("vector").flatten(), float).reshape(-1, size)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(size * size), pa.int32()), pa.array(total.ravel())], ["i", "v"])

    sums = vectors.select("vector").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    moments = np.zeros(size * size)
    for r in sums:
        moments[r["i"]] = r["v"]
    return np.linalg.eigh(moments.reshape(size, size))[1][:, ::-1]


def _in_grid_order(vectors: DataFrame, axes: np.ndarray, width: float) -> DataFrame:
    """``vectors`` with ``place``: a binary key that sorts by the cells of the leading axes."""
    lead = axes[:, :AXES]
    size = len(axes)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch.column("vector").flatten(), float).reshape(-1, size)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            cells = np.floor(x @ lead / width).astype("i8") + 2**15
            keys = [k.tobytes() for k in np.clip(cells, 0, 2**16 - 1).astype(">u2")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "place"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInArrow(run, f"rep bigint, copies bigint, vector {kind}, place binary")


def _ranked(placed: DataFrame, rows: int, block: int) -> DataFrame:
    """``placed`` with ``block``: the rank in grid order, divided by the block's size.

    Rows are numbered inside range partitions and shifted by the partitions before.
    """
    parts = max(1, rows // (4 * block))
    ordered = placed.repartitionByRange(parts, "place", "rep").sortWithinPartitions("place", "rep")
    numbered = written(ordered.withColumn("seq", F.monotonically_increasing_id()), "grid-order")
    part = F.shiftright("seq", 33)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shifts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    rank = F.col("seq").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("shift")
    return numbered.withColumn("part", part).join(shifts, "part").select("rep", "copies", "vector", F.floor(rank / block).alias("block"))


def _pages(ranked: DataFrame, axes: np.ndarray, page: int) -> DataFrame:
    """Each block as rows of up to ``page`` packed vectors with the box of their rotated coordinates."""
    size = len(axes)

    def packed(table):
        import numpy as np
        import pyarrow as pa

        block = table.column("block")[0].as_py()
        x = np.array(table.column("vector").combine_chunks().flatten())
        x = x.reshape(-1, size)
        reps, copies = (np.array(table.column(c)).astype("i8") for c in ("rep", "copies"))
        turned = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True) @ axes
        cuts = range(0, len(x), page)
        return pa.table(
            [
                pa.array([block] * len(cuts), pa.int64()),
                *(pa.array([v[i : i + page].tobytes() for i in cuts], pa.binary()) for v in (reps, copies, x)),
                *(pa.array([f(turned[i : i + page], 0).tolist() for i in cuts]) for f in (np.min, np.max)),
            ],
            ["block", "reps", "copies", "vectors", "low", "high"],
        )

    schema = "block bigint, reps binary, copies binary, vectors binary, low array<double>, high array<double>"
    return ranked.groupBy("block").applyInArrow(packed, schema)


def _boxes(parts: DataFrame, node: Column, size: int) -> DataFrame:
    """``node, low, high``: the box around all boxes of a node."""
    cell = F.posexplode(F.arrays_zip("low", "high"))
    each = parts.select(node.alias("node"), cell.alias("axis", "v"))
    sides = each.groupBy("node", "axis").agg(F.min("v.low").alias("l"), F.max("v.high").alias("h"))
    lists = sides.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("axis", "l", "h"))).alias("s"))  # one item per axis
    return lists.select("node", F.transform("s", lambda x: x["l"]).alias("low"), F.transform("s", lambda x: x["h"]).alias("high"))


def _near_blocks(pages: DataFrame, blocks: int, size: int, distance: float) -> DataFrame:
    """``a, b`` (a <= b): pairs of blocks whose boxes are not provably farther apart than the distance."""
    levels = [written(_boxes(pages, F.col("block"), size), "boxes")]
    while blocks > 1:
        levels.append(written(_boxes(levels[-1], F.floor(F.col("node") / FAN), size), "boxes"))
        blocks = -(-blocks // FAN)
    gap = lambda al, ah, bl, bh: F.zip_with(
        F.zip_with(bl, ah, lambda x, y: x - y), F.zip_with(al, bh, lambda x, y: x - y), lambda p, q: F.greatest(p, q, F.lit(0.0))
    )
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for boxes in reversed(levels[:-1]):
        child = lambda c: F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1)
        split = pairs.select("b", F.explode(child("a")).alias("x")).select("x", F.explode(child("b")).alias("y")).where("x <= y")
        left = boxes.select(F.col("node").alias("x"), F.col("low").alias("xl"), F.col("high").alias("xh"))
        right = boxes.select(F.col("node").alias("y"), F.col("low").alias("yl"), F.col("high").alias("yh"))
        apart = F.aggregate(gap(F.col("xl"), F.col("xh"), F.col("yl"), F.col("yh")), F.lit(0.0), lambda s, d: s + d * d)
        kept = split.join(left, "x").join(right, "y").where(apart <= distance * distance + SLACK)
        pairs = written(kept.select(F.col("x").alias("a"), F.col("y").alias("b")), "block-pairs")
    return pairs


def _tile(blocks: int, block: int, size: int, cores: int) -> int:
    """Blocks in one side of a tile: as many as leave each core a few tiles, and fit a task's memory."""
    stretches = math.ceil(math.sqrt(8 * cores))
    return max(1, min(-(-blocks // stretches), TILE_BYTES // (block * size * 8)))


def _links(pages: DataFrame, pairs: DataFrame, tile: int, size: int, least: float, kind: str) -> DataFrame:
    """``rep, root, links`` for every linked vector of every tile of pairs of blocks."""
    tiled = pairs.select(F.floor(F.col("a") / tile).alias("ta"), F.floor(F.col("b") / tile).alias("tb"), "a", "b")
    ends = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("block"), F.col("b").alias("mate")))).otherwise(
        F.array(F.struct(F.col("a").alias("block"), F.col("b").alias("mate")), F.struct(F.col("b").alias("block"), F.lit(None).cast("bigint").alias("mate")))
    )
    # A block's mates are at most the blocks of a side.
    sides = tiled.select("ta", "tb", F.inline(ends)).groupBy("ta", "tb", "block").agg(F.collect_list("mate").alias("mates"))
    sides = written(sides, "tile-sides")
    content = sides.join(pages.select("block", "reps", "copies", "vectors"), "block")
    tiles = sides.select("ta", "tb").distinct().count()

    def compare(table):
        import numpy as np
        import pyarrow as pa

        rows = table.select(["block", "mates", "reps", "copies", "vectors"]).to_pylist()
        mates = {r["block"]: r["mates"] for r in rows}
        own: dict = {block: [] for block in sorted(mates)}
        for r in rows:
            own[r["block"]].append((r["reps"], r["copies"], r["vectors"]))
        reps, copies, packed, start, n = [], [], {}, {}, 0
        for block, parts in own.items():
            parts.sort()
            reps.append(np.frombuffer(b"".join(p[0] for p in parts), "i8"))
            copies.append(np.frombuffer(b"".join(p[1] for p in parts), "i8"))
            packed[block] = b"".join(p[2] for p in parts)
            start[block], n = n, n + len(reps[-1])
        del rows, own
        reps, copies = np.concatenate(reps), np.concatenate(copies)
        links, label = np.zeros(n, "i8"), np.arange(n)

        def unit(block: int):
            x = np.frombuffer(packed[block], kind).astype(float).reshape(-1, size)
            return x / np.linalg.norm(x, axis=1, keepdims=True)

        for a, others in mates.items():
            xa = unit(a) if others else None
            for b in sorted(others):
                xb = xa if a == b else unit(b)
                at, to = start[a], slice(start[b], start[b] + len(xb))
                us, vs = [], []
                for i in range(0, len(xa), 512):
                    near = xa[i : i + 512] @ xb.T >= least
                    here = slice(at + i, at + i + len(near))
                    if a == b:
                        near[np.arange(len(near)), np.arange(i, i + len(near))] = False
                    else:
                        links[to] += copies[here] @ near
                    links[here] += near @ copies[to]
                    u, v = np.nonzero(near)
                    us.append((u + here.start).astype("i4"))
                    vs.append((v + to.start).astype("i4"))
                u, v = label[np.concatenate(us)], label[np.concatenate(vs)]
                while (apart := u != v).any():  # roots take the smallest root that they are linked with
                    u, v = u[apart], v[apart]
                    np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
                    while ((up := label[label]) != label).any():
                        label = up
                    u, v = label[u], label[v]
        found = np.flatnonzero(links)
        return pa.table({"rep": reps[found], "root": reps[label[found]], "links": links[found]})

    # Comparing is work for the processor: keep the tiles apart.
    parts = max(1, min(tiles, pages.sparkSession.sparkContext.defaultParallelism * 4))
    return content.repartition(parts, "ta", "tb").groupBy("ta", "tb").applyInArrow(compare, "rep bigint, root bigint, links bigint")


def linked_vectors(vectors: DataFrame, least: float = 0.9, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id`` of every vector (``vec_id, embedding``)."""
    rows = vectors.where("vec_id is not null").groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
    rows = written(rows, "vectors")
    ok = F.when(_valid(F.col("embedding")), F.col("embedding"))
    lengths = rows.where(ok.isNotNull()).groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    single = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    if lengths is None:
        return single
    size = lengths["n"]
    usable = ok.isNotNull() & (F.size("embedding") == size)
    distinct = rows.where(usable).groupBy(F.col("embedding").alias("vector")).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    distinct = written(distinct.select("rep", "copies", "vector"), "distinct-vectors")
    count = distinct.count()
    distance = math.sqrt(max(0.0, 2 - 2 * least))
    axes = _axes(distinct, size)
    ranked = _ranked(_in_grid_order(distinct, axes, max(distance, 1e-6) / CELLS), count, block)
    pages = written(_pages(ranked, axes, PAGE), "pages")
    blocks = -(-count // block)
    pairs = _near_blocks(pages, blocks, size, distance)
    kind = "f8" if "double" in rows.schema["embedding"].dataType.simpleString() else "f4"
    tile = _tile(blocks, block, size, rows.sparkSession.sparkContext.defaultParallelism)
    links = written(_links(pages, pairs, tile, size, least, kind), "vector-links")
    groups = components(links, "rep", "root")
    others = links.groupBy("rep").agg(F.sum("links").alias("others"))
    by_rep = distinct.join(others, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("vector").alias("embedding"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    linked = rows.where(usable).join(by_rep, "embedding").select("vec_id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(usable, F.lit(False))).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest)
