"""Terrain steps on grids of (row, col, value): sink filling, flow over flats, slope. A cell without a row is nodata.

Cells are dealt to square tiles, each with a halo of one cell of its neighbours; a tile is one task's work, and what tiles
must agree on travels as a graph of their borders or as changed borders, never as cells.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.operators.grid import DIRECTIONS
from runnel.staging import discard, materialize, new_path

#: Cells on a side of a tile; a tile's arrays take some 10 MB.
TILE = 256
#: The vertex that stands for all that lies beyond the grid.
OUTSIDE = -(1 << 63)
#: The eight steps to a neighbour in the order of their direction codes.
STEPS = [DIRECTIONS[code] for code in sorted(DIRECTIONS)]


def with_halo(cells: DataFrame, tile: int) -> DataFrame:
    """Each cell once for every tile (tr, tc) that it lies in or borders on."""

    def near(of: str) -> list[Column]:
        return [F.floor((F.col(of) + d) / tile).cast("int") for d in (-1, 0, 1)]

    tiles = F.array_distinct(F.array(*[F.struct(r.alias("tr"), c.alias("tc")) for r in near("row") for c in near("col")]))
    inner = F.array(F.struct(near("row")[1].alias("tr"), near("col")[1].alias("tc")))
    # Only cells at a tile's border belong to several.
    at_border = (F.pmod("row", F.lit(tile)).isin(0, tile - 1)) | (F.pmod("col", F.lit(tile)).isin(0, tile - 1))
    return cells.withColumn("_t", F.explode(F.when(at_border, tiles).otherwise(inner))).select("*", "_t.tr", "_t.tc").drop("_t")


class Window:
    """A tile and its halo as arrays of (tile + 2) squared; ``there`` marks cells, ``own`` those of the tile itself."""

    def __init__(self, table: pa.Table, tile: int, values: dict[str, float]) -> None:
        self.tr, self.tc = table["tr"][0].as_py(), table["tc"][0].as_py()
        self.tile = tile
        self.row, self.col = (table[c].to_numpy().astype(np.int64) for c in ("row", "col"))
        self.at = self.row - self.tr * tile + 1, self.col - self.tc * tile + 1
        self.there = np.zeros((tile + 2, tile + 2), bool)
        self.there[self.at] = True
        self.own = self.there.copy()
        self.own[[0, -1]] = self.own[:, [0, -1]] = False
        self.arrays = {}
        for name, missing in values.items():
            column = table[name].to_numpy()
            self.arrays[name] = np.full(self.there.shape, missing, np.result_type(column.dtype, type(missing)))
            self.arrays[name][self.at] = column

    def __getitem__(self, name: str) -> np.ndarray:
        return self.arrays[name]

    def shifted(self, a: np.ndarray, step: tuple[int, int]) -> np.ndarray:
        """For every cell but those of the rim of the halo the value one step away."""
        n, (dr, dc) = self.tile + 2, step
        return a[1 + dr : n - 1 + dr, 1 + dc : n - 1 + dc]

    def places(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns in the grid of the cells of a mask."""
        r, c = np.nonzero(mask)
        return r + self.tr * self.tile - 1, c + self.tc * self.tile - 1


def by_tile(cells: DataFrame, run: Callable[[Window], pa.Table | None], schema: str, values: dict[str, float], tile: int, empty: pa.Schema) -> DataFrame:
    """``run`` on every tile that has cells of its own."""

    def one(table: pa.Table) -> pa.Table:
        window = Window(table, tile, values)
        return run(window) if window.own.any() else empty.empty_table()

    return with_halo(cells, tile).groupBy("tr", "tc").applyInArrow(one, schema)


# --- Sink filling -----------------------------------------------------------------------------------------------------

_FLOOD = pa.schema(
    [
        ("tr", pa.int32()), ("tc", pa.int32()), ("rows", pa.list_(pa.int32())), ("cols", pa.list_(pa.int32())), ("level", pa.list_(pa.float64())),
        ("label", pa.list_(pa.int64())), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())), ("w", pa.list_(pa.float64())),
        ("border", pa.list_(pa.int64())), ("border_label", pa.list_(pa.int64())), ("near_a", pa.list_(pa.int64())), ("near_b", pa.list_(pa.int64())),
        ("near_w", pa.list_(pa.float64())),
    ]
)
_FLOOD_SQL = (
    "tr int, tc int, rows array<int>, cols array<int>, level array<double>, label array<long>, a array<long>, b array<long>, w array<double>, "
    "border array<long>, border_label array<long>, near_a array<long>, near_b array<long>, near_w array<double>"
)


def _flood(window: Window) -> pa.Table:
    """Water rises in one tile from its border and from the outside, each cell at the lowest level that reaches it.

    A cell has the label of the border cell that its water comes from, or of the outside; where two labels meet, the
    lowest level of a passage between them is an edge. Pairs of cells of two tiles are edges of their own.
    """
    tile, there, own, z = window.tile, window.there, window.own, window["z"]
    n = tile + 2
    ids = ((np.arange(n)[:, None] + window.tr * tile - 1) << 32) | ((np.arange(n)[None, :] + window.tc * tile - 1) & 0xFFFFFFFF)
    inner = own[1:-1, 1:-1]
    open_side = np.zeros(own.shape, bool)
    next_door = np.zeros(own.shape, bool)
    for step in STEPS:
        open_side[1:-1, 1:-1] |= inner & ~window.shifted(there, step)
        next_door[1:-1, 1:-1] |= inner & window.shifted(there & ~own, step)
    flat_own, flat_z, flat_id = own.ravel().tolist(), z.ravel().tolist(), ids.ravel().tolist()
    level, label = [math.inf] * (n * n), [None] * (n * n)
    queue = []
    for i in np.flatnonzero((open_side | next_door).ravel()).tolist():
        level[i] = flat_z[i]
        if open_side.flat[i]:
            label[i] = OUTSIDE
        queue.append((flat_z[i], i))
    heapq.heapify(queue)
    moves = [dr * n + dc for dr, dc in STEPS]
    passages: dict[tuple[int, int], float] = {}
    while queue:
        here, i = heapq.heappop(queue)
        mine = label[i]
        if mine is None:
            mine = label[i] = flat_id[i]
        for move in moves:
            j = i + move
            if not flat_own[j]:
                continue
            other = label[j]
            if other is None:
                if level[j] == math.inf:  # else a cell of the border, which waits at its own height
                    level[j] = flat_z[j] if flat_z[j] > here else here
                    heapq.heappush(queue, (level[j], j))
                label[j] = mine
            elif other != mine:
                pair = (mine, other) if mine < other else (other, mine)
                high = here if here > level[j] else level[j]
                if high < passages.get(pair, math.inf):
                    passages[pair] = high
    at = np.flatnonzero(own.ravel())
    rows, cols = window.places(own)
    rim = np.flatnonzero(next_door.ravel())
    near: list[np.ndarray] = [[], [], []]
    for step in STEPS:
        pairs = np.zeros(own.shape, bool)
        pairs[1:-1, 1:-1] = inner & window.shifted(there & ~own, step)
        mine = np.flatnonzero(pairs.ravel())
        other = mine + step[0] * n + step[1]
        once = ids.ravel()[mine] < ids.ravel()[other]
        near[0].append(ids.ravel()[mine[once]])
        near[1].append(ids.ravel()[other[once]])
        near[2].append(np.maximum(z.ravel()[mine[once]], z.ravel()[other[once]]))
    labels = np.array([OUTSIDE if x is None else x for x in label], np.int64)
    lists = (
        rows, cols, np.array(level)[at], labels[at], [p[0] for p in passages], [p[1] for p in passages], list(passages.values()),
        ids.ravel()[rim], labels[rim], *[np.concatenate(x) for x in near],
    )
    columns = [pa.array([x], f.type) for x, f in zip([window.tr, window.tc, *lists], _FLOOD, strict=True)]
    return pa.Table.from_arrays(columns, schema=_FLOOD)


def _followed(pointers: DataFrame) -> DataFrame:
    """(v, root, most) of pointers (v, p, w): the end of each chain and the greatest w on the way; an end has no p."""
    path = new_path(pointers.sparkSession, "chains")
    state = materialize(pointers.select("v", "p", F.col("w").alias("most"), F.when(F.col("p").isNull(), F.col("v")).alias("root")), "chains", path)
    while not state.filter("root is null").isEmpty():
        ahead = state.select(F.col("v").alias("p"), F.col("p").alias("_p"), F.col("most").alias("_most"), F.col("root").alias("_root"))
        open_ones = state.filter("root is null").join(ahead, "p", "left")
        moved = open_ones.select("v", F.col("_p").alias("p"), F.greatest("most", "_most").alias("most"), F.col("_root").alias("root"))
        old, path = path, new_path(pointers.sparkSession, "chains")
        state = materialize(state.filter("root is not null").unionByName(moved), "chains", path)
        discard(pointers.sparkSession, old)
    return state.select("v", "root", "most")


def spill_levels(edges: DataFrame, outside: int = OUTSIDE) -> DataFrame:
    """(v, spill): the least level at which water at v reaches the outside, over edges (a, b, w) that open at level w.

    A minimum spanning forest by rounds: each component points over its cheapest edge (ties by its ends), which any way
    out of it must at least reach; chains of pointers are followed by doubling, with the greatest level on them, and
    contracted. A round at least halves the components that are not the outside yet. Vertices that are
    not connected to the outside have a null level.
    """
    spark = edges.sparkSession

    def least(rows: DataFrame) -> DataFrame:
        return rows.filter("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("w").alias("w"))

    edges_path, members_path = new_path(spark, "passages"), new_path(spark, "members")
    edges = materialize(least(edges), "passages", edges_path)
    ends = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
    members = materialize(ends.select("v", F.col("v").alias("c"), F.lit(-math.inf).alias("most")), "members", members_path)
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a", "w"))
        choice = F.min(F.struct("w", F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))).alias("m")
        chosen = both.filter(F.col("a") != outside).groupBy(F.col("a").alias("v")).agg(choice)
        chosen = chosen.select("v", F.when(F.col("m.low") == F.col("v"), F.col("m.high")).otherwise(F.col("m.low")).alias("p"), F.col("m.w").alias("w"))
        pointers_path = new_path(spark, "pointers")
        chosen = materialize(chosen, "pointers", pointers_path)
        back = chosen.select(F.col("v").alias("p"), F.col("p").alias("_back"))
        # Of two that point to each other the smaller one is the end; the level between them holds for both.
        mutual = F.coalesce(F.col("_back") == F.col("v"), F.lit(False)) & (F.col("v") < F.col("p"))
        pointers = chosen.join(back, "p", "left").select("v", F.when(~mutual, F.col("p")).alias("p"), "w")
        top = spark.createDataFrame([(outside, None, -math.inf)], "v long, p long, w double")
        found = _followed(pointers.unionByName(top))
        step = found.select(F.col("v").alias("c"), F.col("root"), F.col("most").alias("_most"))
        moved = members.join(step, "c", "left").select("v", F.coalesce("root", "c").alias("c"), F.greatest("most", "_most").alias("most"))
        old = [edges_path, members_path, pointers_path]
        edges_path, members_path = new_path(spark, "passages"), new_path(spark, "members")
        members = materialize(moved, "members", members_path)
        of_a, of_b = (found.select(F.col("v").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        edges = materialize(least(edges.join(of_a, "a").join(of_b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"), "w")), "passages", edges_path)
        for path in old:
            discard(spark, path)
    return members.select("v", F.when(F.col("c") == outside, F.col("most")).alias("spill"))


def _raise(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            rows, cols, level, label = (batch[c].slice(r, 1).flatten() for c in ("rows", "cols", "level", "label"))
            spills = batch["spills"].slice(r, 1).flatten()
            known = spills.field("v")
            at = pc.index_in(label, known).fill_null(-1).to_numpy()
            spill = np.r_[spills.field("spill").to_numpy(zero_copy_only=False), -np.inf][at]  # the outside has no level
            yield pa.RecordBatch.from_arrays([rows, cols, pa.array(np.maximum(level.to_numpy(), spill))], names=["row", "col", "filled"])


def fill_sinks(cells: DataFrame, z: str = "z", tile: int = TILE) -> DataFrame:
    """row, col, filled: each cell at the least level from which water leaves the grid, its own height at least.

    Water moves in eight directions. It leaves where a neighbour is missing: at the edge of the grid and beside nodata. Cells
    whose height is null or NaN are nodata. One shuffle of the cells; then a row for each tile.
    """
    known = cells.filter(F.col(z).isNotNull() & ~F.isnan(F.col(z).cast("double")))
    known = known.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(z).cast("double").alias("z"))
    tiles = materialize(by_tile(known, _flood, _FLOOD_SQL, {"z": math.inf}, tile, _FLOOD), "floods")

    def pairs(*names: str) -> DataFrame:
        return tiles.select(F.explode(F.arrays_zip(*names)).alias("e")).select(*[F.col(f"e.{n}").alias(x) for n, x in zip(names, "abw", strict=True)])

    border = tiles.select(F.explode(F.arrays_zip("border", "border_label")).alias("e")).select("e.border", "e.border_label")
    across = pairs("near_a", "near_b", "near_w")
    for side in "ab":
        named = border.select(F.col("border").alias(side), F.col("border_label").alias("_label"))
        across = across.join(named, side).drop(side).withColumnRenamed("_label", side)
    levels = spill_levels(pairs("a", "b", "w").unionByName(across.select("a", "b", "w")))
    # A label is the number of a cell, which tells its tile.
    row, col = F.shiftright("v", 32), F.shiftright(F.shiftleft("v", 32), 32)
    dealt = levels.filter(F.col("v") != OUTSIDE).select(F.floor(row / tile).cast("int").alias("tr"), F.floor(col / tile).cast("int").alias("tc"), "v", "spill")
    dealt = dealt.groupBy("tr", "tc").agg(F.collect_list(F.struct("v", "spill")).alias("spills"))
    rows = tiles.select("tr", "tc", "rows", "cols", "level", "label").join(dealt, ["tr", "tc"], "left")
    rows = rows.withColumn("spills", F.coalesce("spills", F.array().cast(dealt.schema["spills"].dataType)))
    return rows.mapInArrow(_raise, "row int, col int, filled double")


# --- Directions of flow, over flats too -----------------------------------------------------------------------------------

_FALLS = pa.schema([("row", pa.int32()), ("col", pa.int32()), ("z", pa.float64()), ("code", pa.int32()), ("under", pa.bool_()), ("kind", pa.int32())])
_FALLS_SQL = "row int, col int, z double, code int, under boolean, kind int"
_AWAY = pa.schema([("row", pa.int32()), ("col", pa.int32()), ("z", pa.float64()), ("kind", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("moved", pa.bool_())])
_AWAY_SQL = "row int, col int, z double, kind int, low long, high long, moved boolean"
_CODES = pa.schema([("row", pa.int32()), ("col", pa.int32()), ("direction", pa.int32())])
_CODES_SQL = "row int, col int, direction int"
#: What a cell is to the flats: of none, a flat cell, or a cell at whose height a flat drains.
PLAIN, FLAT, DRAIN = 0, 1, 2
#: Farther than any step.
FAR = 1 << 40


def _own_rows(window: Window, schema: pa.Schema, mask: np.ndarray, *columns: np.ndarray) -> pa.Table:
    rows, cols = window.places(mask)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip((rows, cols, *(c[mask] for c in columns)), schema, strict=True)], schema=schema)


def _fall(window: Window) -> pa.Table:
    """The direction of steepest descent; without one that of a missing neighbour; else 0, with what lies around at the same height."""
    z, there, own = window["z"], window.there, window.own
    inner = slice(1, -1), slice(1, -1)
    best, code = np.zeros(z[inner].shape), np.zeros(z[inner].shape, np.int32)
    gone = np.zeros(z[inner].shape, np.int32)
    under = np.zeros(z[inner].shape, bool)
    here = z[inner]
    for k, step in enumerate(STEPS, 1):
        near, known = window.shifted(z, step), window.shifted(there, step)
        with np.errstate(invalid="ignore"):
            drop = np.where(known, (here - near) / math.hypot(*step), 0.0)
        steeper = drop > best
        best, code = np.where(steeper, drop, best), np.where(steeper, k, code)
        gone = np.where((gone == 0) & ~known, k, gone)
        under |= known & (near > here)
    code = np.where(code == 0, gone, code)
    full = [np.zeros(z.shape, x.dtype) for x in (code, under)]
    full[0][inner], full[1][inner] = code, under
    kind = np.where(full[0] == 0, FLAT, PLAIN)
    return _own_rows(window, _FALLS, own, z, *full, kind)


def _beside_flats(window: Window) -> pa.Table:
    """The cells of flats, and those at a flat's height beside it that drain."""
    z, flat = window["z"], window["kind"] == FLAT
    drains = np.zeros(z.shape, bool)
    for step in STEPS:
        drains[1:-1, 1:-1] |= window.shifted(flat, step) & (window.shifted(z, step) == z[1:-1, 1:-1])
    drains &= window.own & ~flat
    some = window.own & (flat | drains)
    kind = np.where(drains, DRAIN, FLAT)
    low = np.where(drains, 0, FAR)
    high = np.where(flat & (window["under"] > 0), 1, FAR)
    return _own_rows(window, _AWAY, some, z, kind, low, high, np.ones(z.shape, bool))


def _relax(window: Window) -> pa.Table:
    """Steps to the nearest draining cell and from the nearest higher ground, as far as one tile and its halo know."""
    z, flat, part = window["z"], window["kind"] == FLAT, window.there
    inner = slice(1, -1), slice(1, -1)
    same = [window.shifted(part, s) & (window.shifted(z, s) == z[inner]) & (window.own & flat)[inner] for s in STEPS]
    out = []
    for name, through in (("low", part), ("high", flat)):
        d = window[name].copy()
        while True:
            reach = np.full(z[inner].shape, FAR)
            for step, ok in zip(STEPS, same, strict=True):
                reach = np.where(ok & window.shifted(through, step), np.minimum(reach, window.shifted(d, step) + 1), reach)
            nearer = reach < d[inner]
            if not nearer.any():
                break
            d[inner] = np.where(nearer, reach, d[inner])
        out.append(d)
    moved = (out[0] != window["low"]) | (out[1] != window["high"])
    return _own_rows(window, _AWAY, window.own, z, window["kind"], *out, moved)


def _over_flats(window: Window) -> pa.Table:
    """Each flat cell's direction: to the draining cell beside it, else where the way out is shorter and higher ground farther."""
    z, flat = window["z"], window["kind"] == FLAT
    inner = slice(1, -1), slice(1, -1)
    height = np.where(window["kind"] == DRAIN, -FAR, 2 * window["low"] - np.where(window["high"] < FAR, window["high"], 0))
    best, code = height[inner].copy(), np.zeros(z[inner].shape, np.int32)
    for k, step in enumerate(STEPS, 1):
        near = np.where(window.shifted(window.there, step) & (window.shifted(z, step) == z[inner]), window.shifted(height, step), FAR)
        lower = near < best
        best, code = np.where(lower, near, best), np.where(lower, k, code)
    full = np.zeros(z.shape, np.int32)
    full[inner] = np.where(window["low"][inner] < FAR, code, 0)  # a flat that nothing drains
    return _own_rows(window, _CODES, window.own & flat, full)


def flow_directions(cells: DataFrame, z: str = "z", tile: int = TILE) -> DataFrame:
    """row, col, direction: the code of the neighbour that a cell drains to.

    That is the neighbour of the steepest descent (ties by code). A cell without a lower neighbour drains to a missing one, so off
    the grid, by the first code. All others lie in flats: their water goes towards the nearest cell at the same height that
    drains, and away from higher ground, by twice the steps to the former less the steps from the latter. Each such cell has
    a neighbour where that is less, so no cell of filled terrain is left over and directions form no cycle; in a sink that
    was not filled they are null. The steps are found tile by tile; a round lets them cross a tile border, so there are as
    many rounds as borders on the longest way out of a flat, over cells of flats alone.
    """
    spark = cells.sparkSession
    known = cells.filter(F.col(z).isNotNull() & ~F.isnan(F.col(z).cast("double")))
    known = known.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(z).cast("double").alias("z"))
    falls = materialize(by_tile(known, _fall, _FALLS_SQL, {"z": math.inf}, tile, _FALLS), "falls")
    path = new_path(spark, "flats")
    flats = materialize(by_tile(falls, _beside_flats, _AWAY_SQL, {"z": math.nan, "kind": PLAIN, "under": 0}, tile, _AWAY), "flats", path)
    values = {"z": math.nan, "kind": PLAIN, "low": FAR, "high": FAR}
    while not flats.filter("moved").isEmpty():
        old, path = path, new_path(spark, "flats")
        flats = materialize(by_tile(flats.drop("moved"), _relax, _AWAY_SQL, values, tile, _AWAY), "flats", path)
        discard(spark, old)
    over = by_tile(flats.drop("moved"), _over_flats, _CODES_SQL, values, tile, _CODES)
    over = over.withColumn("direction", F.nullif("direction", F.lit(0)))
    return falls.filter(F.col("kind") == PLAIN).select("row", "col", F.col("code").alias("direction")).unionByName(over)


# --- Slope ----------------------------------------------------------------------------------------------------------------

_SLOPES = pa.schema([("row", pa.int32()), ("col", pa.int32()), ("slope", pa.float64())])


def slope(cells: DataFrame, dx: float, dy: float, z: str = "z", tile: int = TILE) -> DataFrame:
    """row, col, slope in degrees by the weighted differences of the eight neighbours; null where one of them is missing."""

    def incline(window: Window) -> pa.Table:
        def at(dr: int, dc: int) -> np.ndarray:
            return window.shifted(window["z"], (dr, dc))

        across = (at(-1, 1) + 2 * at(0, 1) + at(1, 1)) - (at(-1, -1) + 2 * at(0, -1) + at(1, -1))
        along = (at(1, -1) + 2 * at(1, 0) + at(1, 1)) - (at(-1, -1) + 2 * at(-1, 0) + at(-1, 1))
        full = np.full(window.there.shape, math.nan)
        full[1:-1, 1:-1] = np.degrees(np.arctan(np.hypot(across / (8 * dx), along / (8 * dy))))
        return _own_rows(window, _SLOPES, window.own, full)

    known = cells.filter(F.col(z).isNotNull() & ~F.isnan(F.col(z).cast("double")))
    known = known.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(z).cast("double").alias("z"))
    found = by_tile(known, incline, "row int, col int, slope double", {"z": math.nan}, tile, _SLOPES)
    return found.withColumn("slope", F.when(~F.isnan("slope"), F.col("slope")))
