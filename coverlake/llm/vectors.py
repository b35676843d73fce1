"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them, one vector kept of each group.

Equal vectors are folded first. Vectors of one dimension are one cell at the start. A cell of more than ``leaf`` vectors is
split by spherical k-means, fitted on a bounded sample of the cell, and the parts are split again until they are small; a
cell is worked on in chunks, so a large one spreads over tasks. Centres too close to each other are thinned out, which
leaves a tight group in one cell. Each vector enters the ``PROBES`` cells nearest to it and all whose centre is within one
and a half times the angle of a link; pairs are compared where they first meet.

A vector within half the angle of a link of its centre is core. Two cores of one cell are linked whatever else they are,
so they are counted, not compared: a group of near copies costs its size, not its square. A core enters its own cell and
those within the wider angle only, and whoever links with it is within that angle of its centre, so no link of a core is
lost. Other pairs are found if two of their cells agree, which depends on the data; the tests and the README give the share.

Within a cell, vectors that are no core meet each other and the cores in pairs of blocks of at most ``block`` vectors, each
pair of blocks a task of its own. A task sends a sum of links for each vector and a spanning forest, never its pairs.
Cosines are taken in double precision.

Defined cases: a vector that is null, empty or zero or holds a null or a value that is not finite links with nothing;
vectors of different dimensions do not link; equal rows are vectors of their own and link with each other; a group with
null ids only has a null ``component_id``; a row with a null id is never kept; every input row gives one output row; an
empty table gives an empty result; further columns are not looked at. Equal vectors are known by 128 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from coverlake.llm.common import components, stored

LINK = 0.9
#: Vectors in a cell that is not split, on average in a new cell, and cells made of one; vectors a fit looks at.
LEAF, PART, SPLIT, SAMPLE = 2048, 768, 512, 32_768
PROBES, DEPTH, STEPS = 3, 5, 8
#: Vectors compared at a time, and vectors of one chunk of a cell that is split.
BLOCK, CHUNK = 2048, 16_384
#: A cell that keeps this share of the cell it comes from is not split again.
STUCK = 0.8
_PAIRS = 1 << 18


def angles(link: float) -> tuple[float, float]:
    """Cosines of half and of one and a half times the angle of a link, on the safe side."""
    angle = float(np.arccos(link))
    return float(np.cos(angle / 2)) + 1e-9, float(np.cos(min(np.pi, 1.5 * angle))) - 1e-9


def units(blobs: list[bytes]) -> np.ndarray:
    """Vectors of one dimension, of length one."""
    values = _values(blobs)
    values = values / np.abs(values).max(1, keepdims=True)  # squares of very large or small values stay finite
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _values(blobs: list[bytes]) -> np.ndarray:
    """Each blob is one byte for the width of a value (4 or 8) and the values."""
    wide = {b[0] for b in blobs}
    if len(wide) == 1:
        kind = np.float32 if wide == {4} else np.float64
        return np.frombuffer(b"".join([b[1:] for b in blobs]), kind).reshape(len(blobs), -1).astype(np.float64)
    return np.array([_values([b])[0] for b in blobs])


# -- reading


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id``, ``key`` (null: links with nothing), ``dim`` and ``vector`` of every row."""
    schema = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("dim", pa.int64()), ("vector", pa.binary())])
    for batch in batches:
        column = batch.column("vector")
        kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
        head = bytes([np.dtype(kind).itemsize])
        keys, dims, blobs = [], [], []
        for value in column:
            x = value.values if value.is_valid else None
            ok = x is not None and len(x) and not x.null_count
            x = x.to_numpy(zero_copy_only=False).astype(kind) + kind(0) if ok else None
            ok = ok and bool(np.isfinite(x).all()) and bool(x.any())
            blob = head + x.tobytes() if ok else None
            keys.append(xxh3_128_digest(blob) if ok else None)
            dims.append(len(x) if ok else None)
            blobs.append(blob)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(dims, pa.int64()), pa.array(blobs, pa.binary())], schema=schema)


# -- cells


def thinned(centres: np.ndarray, weights: np.ndarray, apart: float) -> np.ndarray:
    """Centres by falling weight, without those closer than ``apart`` to one before them."""
    centres = centres[np.argsort(-weights, kind="stable")]
    close = centres @ centres.T >= apart
    kept = np.zeros(len(centres), bool)
    for k in range(len(centres)):
        kept[k] = not (close[k] & kept).any()
    return centres[kept]


def _moved(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres after one step of k-means, and the weight of each; one without a vector stays."""
    of = (x @ centres.T).argmax(1)
    sums = np.zeros_like(centres)
    np.add.at(sums, of, x)
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres), np.bincount(of, minlength=len(centres))


def fitted(x: np.ndarray, parts: int, apart: float) -> np.ndarray:
    """Centres of a spherical k-means over the rows of ``x``, which come in a random order."""
    centres = x[:parts].copy()
    weights = np.ones(len(centres))
    for _ in range(STEPS):
        centres, weights = _moved(x, centres)
    centres = thinned(centres, weights, apart)
    for _ in range(2):
        centres = thinned(*_moved(x, centres), apart)
    return centres


def chosen(x: np.ndarray, centres: np.ndarray, core: float, near: float, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, centre, whether the row is core there) of every cell a vector enters."""
    close = x @ centres.T
    home = close.argmax(1)
    inner = close[np.arange(len(x)), home] >= core
    enters = close >= near
    enters[np.arange(len(x)), home] = True
    if probes > 1:
        k = min(probes, len(centres))
        most = np.argpartition(-close, k - 1, axis=1)[:, :k]
        outer = np.flatnonzero(~inner)
        enters[outer[:, None], most[outer]] = True
    row, cell = np.nonzero(enters)
    return row, cell, inner[row] & (home[row] == cell)


_SPREAD = 1024  # children's numbers within the number of their cell; above SPLIT


def _split(cells: DataFrame, link: float, part: int, probes: int) -> DataFrame:
    """Cells (``cell``, ``size``, ``node``, ``vector``) dealt to new ones: ``cell``, ``node``, ``core``, ``of_size``, ``final``."""
    core, near = angles(link)
    mixed = F.xxhash64("node", F.lit(7))
    sample = cells.filter(F.pmod(mixed, "size") < SAMPLE)

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        order = np.argsort(table.column("mixed").to_numpy(), kind="stable")[: 2 * SAMPLE]
        x = units([table.column("vector")[int(k)].as_py() for k in order])
        centres = fitted(x, max(1, min(SPLIT, -(-size // part), len(x))), link)
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int64()), "centres": pa.array([centres.tobytes()], pa.binary()), "salts": pa.array([-(-size // CHUNK)], pa.int64())})

    def deal(key: tuple, members: pa.Table, centres: pa.Table) -> pa.Table:
        out = {"cell": [], "node": [], "core": [], "of_size": [], "final": []}
        if len(members):
            x = units(members.column("vector").to_pylist())
            of = np.frombuffer(centres.column("centres")[0].as_py(), np.float64).reshape(-1, x.shape[1])
            row, cell, inner = chosen(x, of, core, near, probes)
            parent = members.column("cell")[0].as_py()
            out = {
                "cell": parent * _SPREAD + 1 + cell,
                "node": members.column("node").to_numpy()[row],
                "core": inner,
                "of_size": np.full(len(row), members.column("size")[0].as_py()),
                "final": np.full(len(row), len(of) == 1),
            }
        kinds = {"cell": pa.int64(), "node": pa.int64(), "core": pa.bool_(), "of_size": pa.int64(), "final": pa.bool_()}
        return pa.table({n: pa.array(v, kinds[n]) for n, v in out.items()})

    centres = stored(sample.withColumn("mixed", mixed).groupBy("cell").applyInArrow(fit, "cell long, centres binary, salts long"))
    spread = centres.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "centres")
    salted = cells.withColumn("salt", F.pmod(F.xxhash64("node"), F.expr(f"cast(ceil(size / {CHUNK}) as long)")))
    return (
        salted.groupBy("cell", "salt")
        .cogroup(spread.groupBy("cell", "salt"))
        .applyInArrow(deal, "cell long, node long, core boolean, of_size long, final boolean")
    )


def cells_of(vectors: DataFrame, link: float = LINK, leaf: int = LEAF, part: int = PART, probes: int = PROBES) -> DataFrame:
    """``cell``, ``node``, ``core``: the cells that every row of ``vectors`` (``node``, ``dim``, ``vector``) enters."""
    none = [F.lit(False).alias("core"), F.lit(None).cast("long").alias("of_size"), F.lit(False).alias("final")]
    open_ = vectors.select(F.col("dim").alias("cell"), "node", *none)
    done = None
    for depth in range(DEPTH + 1):
        sizes = open_.groupBy("cell").agg(F.count("*").alias("size"), F.max("of_size").alias("of"), F.max("final").alias("last"))
        more = (F.col("size") > leaf) & ~F.col("last") & (F.col("of").isNull() | (F.col("size") < F.col("of") * STUCK))
        large = stored(sizes.filter(more).select("cell", "size"))
        rest = open_.join(large, "cell", "left_anti").select("cell", "node", "core")
        done = rest if done is None else done.union(rest)
        if depth == DEPTH or large.isEmpty():
            if depth == DEPTH:
                done = done.union(open_.join(large, "cell", "left_semi").select("cell", "node", "core"))
            return done
        held = open_.join(large, "cell").select("cell", "size", "node").join(vectors.select("node", "vector"), "node")
        open_ = stored(_split(held, link, part, probes))


# -- links


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of ``n`` places under the links ``a``-``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _first_common(of: np.ndarray, a: np.ndarray, b: np.ndarray, cell: int) -> np.ndarray:
    """Whether ``cell`` is the smallest cell that both rows of a pair enter."""
    x, y = of[a], of[b]
    common = np.where((x[:, :, None] == y[:, None, :]).any(2) & (x >= 0), x, np.iinfo(np.int64).max)
    return common.min(1) == cell


def _compare(link: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        cell, i, j = (k.as_py() for k in key)
        side = table.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        table = table.take(pa.array(order))
        n, m = len(table), int((side == 0).sum())
        second = 0 if i == j else m
        if n == second or m == 0:
            return schema.empty_table()
        x = units(table.column("vector").to_pylist())
        lists = table.column("cells").to_pylist()
        of = np.full((n, max(map(len, lists))), -1, np.int64)
        for k, own in enumerate(lists):
            of[k, : len(own)] = own
        home = table.column("core_of").fill_null(-1).to_numpy()
        copies, node = table.column("copies").to_numpy(), table.column("node").to_numpy()
        links = np.zeros(n, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        step = max(1, _PAIRS // max(1, n - second))
        for low in range(0, m, step):
            a, b = np.nonzero(x[low : min(m, low + step)] @ x[second:].T >= link)
            a, b = a + low, b + second
            fit = (a < b) & ((home[a] != home[b]) | (home[a] < 0))
            a, b = a[fit], b[fit]
            fit = _first_common(of, a, b, cell)
            a, b = a[fit], b[fit]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            found.append((a, b))
        label = forest(n, *(np.concatenate(f) for f in zip(*found)))
        at = np.flatnonzero(links)
        return pa.table({"node": node[at], "links": links[at], "root": node[label[at]]}, schema=schema)

    return run


def block_links(cells: DataFrame, vectors: DataFrame, link: float = LINK, block: int = BLOCK) -> DataFrame:
    """Links of every vector that are found by products: ``node``, ``links``, ``root`` (a vector of the same group)."""
    sizes = stored(cells.groupBy("cell").agg(F.count_if(~F.col("core")).alias("outer"), F.count_if("core").alias("inner")).filter("outer > 0 AND outer + inner > 1"))
    of_node = cells.groupBy("node").agg(
        F.collect_list(F.struct("cell", "core")).alias("entered"), F.max(F.when(F.col("core"), F.col("cell"))).alias("core_of")
    )
    rows = of_node.join(vectors.select("node", "copies", "vector"), "node").select(
        "*", F.transform("entered", lambda e: e.cell).alias("cells"), F.explode("entered").alias("e")
    )
    rows = rows.select("node", "copies", "vector", "cells", "core_of", F.col("e.cell").alias("cell"), F.col("e.core").alias("core")).join(sizes, "cell")
    blocks = {c: F.expr(f"cast(ceil({c} / {block}) as int)") for c in ("outer", "inner")}
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.when(F.col("core"), blocks["inner"]).otherwise(blocks["outer"])).cast("int")
    rows = rows.withColumn("own", own)
    # blocks of vectors that are no core have numbers from 0 on, those of cores go on after them
    outer = F.transform(
        F.sequence(F.lit(0), blocks["outer"] + blocks["inner"] - 1),
        lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j"), F.when(k < F.col("own"), 1).otherwise(0).alias("side")),
    )
    inner = F.transform(F.sequence(F.lit(0), blocks["outer"] - 1), lambda k: F.struct(k.alias("i"), (blocks["outer"] + F.col("own")).alias("j"), F.lit(1).alias("side")))
    dealt = rows.withColumn("task", F.explode(F.when(F.col("core"), inner).otherwise(outer)))
    dealt = dealt.select("cell", "task.i", "task.j", "task.side", "node", "copies", "cells", "core_of", "vector")
    return dealt.groupBy("cell", "i", "j").applyInArrow(_compare(link), "node long, links long, root long")


def core_links(cells: DataFrame, vectors: DataFrame) -> DataFrame:
    """Links among the cores of one cell, without a product: ``node``, ``links``, ``root``."""
    cores = stored(cells.filter("core").select("cell", "node").join(vectors.select("node", "copies"), "node"))
    sums = stored(cores.groupBy("cell").agg(F.sum("copies").alias("all"), F.min("node").alias("root")))
    return cores.join(sums, "cell").select("node", (F.col("all") - F.col("copies")).alias("links"), "root").filter("links > 0")


def near_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    link: float = LINK,
    leaf: int = LEAF,
    part: int = PART,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``table``."""
    base = table.select(table[id_col].cast("long").alias("vec_id"), table[vector_col].alias("vector"))
    read = stored(base.mapInArrow(_read, "vec_id long, key binary, dim long, vector binary"))
    folded = read.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("dim").alias("dim"), F.any_value("vector").alias("vector")
    )
    vectors = stored(folded.withColumn("node", F.monotonically_increasing_id()))
    cells = stored(cells_of(vectors, link, leaf, part, probes))
    found = stored(block_links(cells, vectors, link, block).union(core_links(cells, vectors)))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "of")
    named = vectors.select("key", "node", "least", "copies").join(links, "node", "left").join(roots, F.col("node") == F.col("of"), "left")
    named = stored(named.select("key", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answers = named.join(smallest, "root").select("key", "n_links", "component_id")
    all_rows = read.select("vec_id", "key").join(answers, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return all_rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
