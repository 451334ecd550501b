"""Near duplicates of embeddings by spherical k-means cells.

Vectors go to the cell of the nearest centroid; within a cell, cosine products are
taken block by block.  A vector also visits every other cell that a linked partner
could lie in: a partner in cell c is on c's side of the plane between c and the
vector's own cell, so the vector must be within the link angle of that plane, and
within the link angle of the cell's radius.  No pair is missed, and a pair is
compared in one cell only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope.llm.common import shuffle_partitions, staged
from ipscope.llm.links import components
from ipscope.llm.near_dup import _groups, _roots

SLACK = 1e-9  # on the bounds, far above rounding errors


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; by their largest entry first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Unit centroids by Lloyd's rounds on cosine; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(size > 1e-12, total / np.maximum(size, 1e-12), centroids)
    return centroids


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(values.to_pylist()), np.float64)


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str | None = "label",
                 threshold: float = 0.93, per_cell: int = 1000, most_sample: int = 20_000, block: int = 1024) -> DataFrame:
    """Links and classes of vectors: vec_id, n_links, component_id, kept.

    Two vectors with equal, non-null labels (any two where ``label`` is None) are
    linked if their cosine in double precision is at least ``threshold``, between 0 and
    1.  component_id is the smallest vec_id reachable over links, n_links the number of
    other vectors linked directly, kept whether the vector is its component's smallest.
    Vectors that are null, empty, zero, or hold a null or non-finite component, and those
    without label, are linked with nothing and kept.  Vectors of different lengths are
    not linked.  Equal vectors are compared once and counted as often as they occur.
    One row per input row.  Vectors are compared whatever their vec_id: one without it
    links like any other, but names no component (component_id is null where no vector
    of it has one) and is not kept unless it is linked with nothing and alone.  The
    centroids are fitted on about ``most_sample`` vectors picked by a digest of the
    vector; ``per_cell``, of the most frequent label, sets how many cells there are (a
    twentieth of the sample at most), and ``block`` how many vectors of a
    cell are compared at once, not how many it holds.  All vectors are compared.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(embedding).cast("array<double>").alias("v"),
                          (F.lit("") if label is None else F.col(label).cast("string")).alias("label"))
    valid = (F.col("label").isNotNull() & (F.size("v") > 0)
             & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
             & F.exists("v", lambda x: x != 0.0))
    # Equal vectors are one row; a vector that a third of the rows have is combined map-side.
    keyed = rows.withColumn("code", F.when(F.coalesce(valid, F.lit(False)),
                                           F.unhex(F.md5(F.to_json(F.struct("label", "v"))))))
    grouped = staged(keyed.filter("code IS NOT NULL").groupBy("code").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("v").alias("v")), "vector_classes")
    # Numbered once they are written out; the numbers are the nodes of the graph.
    classes = staged(grouped.withColumn("rep", F.monotonically_increasing_id()), "numbered_vectors")
    links = _links(classes, threshold, per_cell, most_sample, block)
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    member = staged(classes.select("code", "rep", "least", "copies").join(counted, "rep", "left").join(roots, "rep", "left")
                    .withColumn("root", F.coalesce("root", "rep")), "vector_components")
    smallest = staged(member.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    known = staged(member.join(smallest, "root").select(
        "code", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector_known")
    codes = keyed.select("vec_id", "code")
    linked = codes.filter("code IS NOT NULL").join(known, "code").select("vec_id", "n_links", "component_id")
    alone = codes.filter("code IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull() & (F.col("n_links") == 0)))


def _links(classes: DataFrame, threshold: float, per_cell: int, most_sample: int, block: int) -> DataFrame:
    """Links of the distinct vectors found in each block: rep, links, root."""
    spark = classes.sparkSession
    total = classes.count()
    largest = classes.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    place = F.pmod(F.xxhash64("code"), F.lit(1 << 30))
    cells = max(1, min(most_sample // 20, -(-largest // per_cell)))
    picked = classes.filter(place < int(min(1.0, most_sample / max(1, total)) * (1 << 30))).select("v").collect()
    centroids = {}  # by length of the vectors; almost always one
    for size in {len(r.v) for r in picked}:
        centroids[size] = spherical_kmeans(unit_rows(np.array([r.v for r in picked if len(r.v) == size])), cells)
    shared = spark.sparkContext.broadcast(centroids)  # at most most_sample / 20 centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            size = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy()
            start = np.cumsum(size) - size
            cell, unit, near = np.zeros(len(size), np.int32), [b""] * len(size), np.zeros(len(size))
            for n in np.unique(size):
                who = np.flatnonzero(size == n)
                x = unit_rows(flat[start[who][:, None] + np.arange(n)])
                c = shared.value.get(int(n), np.eye(1, n))
                dots = x @ c.T
                cell[who], near[who] = dots.argmax(axis=1), dots.max(axis=1)
                for i, row in zip(who, x):
                    unit[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("copies"), b.column("label"), pa.array(size, pa.int32()),
                                              pa.array(cell), pa.array(near), pa.array(unit, pa.binary())],
                                             names=["rep", "copies", "label", "size", "cell", "near", "unit"])

    homes = staged(classes.select("rep", "copies", "label", "v").mapInArrow(
        assign, "rep long, copies long, label string, size int, cell int, near double, unit binary"), "vector_homes")
    radii = {(r.size, r.cell): math.acos(max(-1.0, min(1.0, r.near)))  # one per cell
             for r in homes.groupBy("size", "cell").agg(F.min("near").alias("near")).collect()}
    angle = math.acos(threshold)
    reach = spark.sparkContext.broadcast(radii)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, cell = b.column("size").to_numpy(), b.column("cell").to_numpy()
            who, where = [np.arange(len(size))], [cell]
            for n in np.unique(size):
                mine = np.flatnonzero(size == n)
                x = _matrix(b.column("unit").take(pa.array(mine))).reshape(len(mine), n)
                c = shared.value.get(int(n), np.eye(1, n))
                dots = x @ c.T
                apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * c @ c.T))
                own = cell[mine]
                for k in range(len(c)):
                    if (int(n), k) not in reach.value:
                        continue  # an empty cell
                    gap = apart[own, k]
                    plane = (dots[np.arange(len(mine)), own] - dots[:, k]) <= math.sin(angle) * gap + SLACK
                    ball = np.arccos(np.clip(dots[:, k], -1.0, 1.0)) <= reach.value[int(n), k] + angle + SLACK
                    go = mine[(own > k) & plane & ball]  # a pair of cells is compared in the smaller one
                    who.append(go)
                    where.append(np.full(len(go), k, np.int32))
            who, where = np.concatenate(who), np.concatenate(where)
            moved = b.take(pa.array(who)).select(["rep", "copies", "label", "size", "unit"])
            home = where == cell[who]
            yield pa.RecordBatch.from_arrays([*moved.columns, pa.array(where.astype(np.int32)), pa.array(home)],
                                             names=[*moved.schema.names, "cell", "home"])

    placed = staged(homes.mapInArrow(visits, "rep long, copies long, label string, size int, unit binary, cell int, home boolean"),
                    "vector_cells")
    # Blocks of a cell: homes against homes, and homes against visitors.
    where = ["label", "size", "cell"]
    sizes = placed.groupBy(*where).agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("guests"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(float(block)))).cast("long")
    dealt = (placed.join(sizes, where).withColumn("home_blocks", blocks("homes")).withColumn("guest_blocks", blocks("guests"))
             .withColumn("mine", F.pmod(F.xxhash64("rep", F.lit(17)), F.when(F.col("home"), F.col("home_blocks")).otherwise(F.col("guest_blocks")))))
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    with_homes = dealt.filter("home").withColumn("other", F.explode(up_to("home_blocks"))).select(
        "rep", "copies", "size", "unit", F.xxhash64(*where, F.least("mine", "other"), F.greatest("mine", "other"), F.lit(0)).alias("key"),
        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))
    hosts = dealt.filter("home AND guests > 0").withColumn("other", F.explode(up_to("guest_blocks"))).select(
        "rep", "copies", "size", "unit", F.xxhash64(*where, "mine", "other", F.lit(1)).alias("key"), F.lit(1).alias("side"))
    guests = dealt.filter("NOT home").withColumn("other", F.explode(up_to("home_blocks"))).select(
        "rep", "copies", "size", "unit", F.xxhash64(*where, "other", "mine", F.lit(1)).alias("key"), F.lit(2).alias("side"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _groups(batches, "key"):
            rep, copies, side, size = (table.column(c).to_numpy() for c in ("rep", "copies", "side", "size"))
            units, out = table.column("unit").combine_chunks(), []
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                x = _matrix(units.slice(s, e - s)).reshape(e - s, int(size[s]))
                linked = (x @ x.T) >= threshold
                np.fill_diagonal(linked, False)
                if side[s:e].any():
                    linked &= side[s:e][:, None] != side[s:e][None, :]
                found = (linked * copies[None, s:e]).sum(axis=1)
                some = np.flatnonzero(found)
                if len(some):
                    out.append((rep[s:e][some], found[some], rep[s:e][_roots(linked)[some]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)],
                                                 names=["rep", "links", "root"])

    n = shuffle_partitions(spark)
    return staged(with_homes.unionAll(hosts).unionAll(guests).repartition(n, "key").sortWithinPartitions("key", "rep")
                  .mapInArrow(compare, "rep long, links long, root long"), "vector_links")
