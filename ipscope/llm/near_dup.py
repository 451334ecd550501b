"""N-gram Jaccard join by a MinHash LSH forest.

Each text is the set of its five-word shingles, and every tree of the forest holds a
path of ``depth`` MinHash values of it.  Paths are kept as sortable keys, so the texts
under a node of a tree's prefix trie are those whose keys begin alike.  The join first
takes the full paths: texts at one leaf are candidates, their similarity is verified
on the sets.  From the similarities of the pairs found so far, and the chance that a
pair of that similarity meets at this depth, the recall is measured; while it is below
the target, the matched prefix is shortened by one value, and the nodes there that
branch give new candidates.

Texts with equal sets form a class, which is one node of the join.  A node of any
size is cut into blocks, and pairs of blocks are verified side by side; only the
number of links of each text, a spanning forest of them and counts of similarities
leave a task.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ipscope.llm.common import WordHashes, held, mix64, shuffle_partitions, slices, staged
from ipscope.llm.links import components

ASCII_WHITE = "\x20\t\n\x0b\x0c\r"
_TO_SPACE = str.maketrans(dict.fromkeys(ASCII_WHITE, " "))


VALUE_BYTES, DEEPEST = 2, 8  # of a value in a path, and values of the deepest path
BINS = 50  # of similarities, in the measure of recall


def meets(similarity: float, trees: int, length: int) -> float:
    """Chance that a pair shares a prefix of that length in one of the trees."""
    return 1.0 - (1.0 - similarity ** length) ** trees


def shortest_prefix(trees: int, depth: int, threshold: float, recall: float) -> int:
    """Longest prefix at which even a pair at the threshold meets with the wanted recall; nothing shorter is needed."""
    return next((k for k in range(depth, 1, -1) if meets(threshold, trees, k) >= recall), 1)


def measured_recall(pairs: dict[int, int], trees: int, length: int) -> float:
    """Share of all links that have been found, from the links found in each bin of similarity.

    A link of similarity s stands for 1 / meets(s) links; the lower end of its bin counts.
    """
    found = sum(pairs.values())
    return found / sum(n / meets(b / BINS, trees, length) for b, n in pairs.items()) if found else 1.0


def shingles(texts: list[str], size: int, hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text; a text of fewer words is one shingle, none has none."""
    # Words are what ASCII white space separates; other white space belongs to words.
    words, counts = hashes.of([[w for w in x.translate(_TO_SPACE).split(" ") if w] for x in texts])
    out, start = [], 0
    powers = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(size)]
    scrambled = mix64(words)
    for n in counts.tolist():
        w = scrambled[start:start + n]
        start += n
        wide = min(size, n)
        code = np.zeros(max(0, n - wide + 1) if n else 0, np.uint64)
        for i in range(wide):
            code = code + w[i:i + len(code)] * powers[i]
        out.append(np.unique(mix64(code + np.uint64(wide))) if n else code)
    return out


class Signer:
    """Paths of MinHash values: for each tree ``depth`` values of 16 bits, as sortable bytes."""

    def __init__(self, trees: int, depth: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.flip = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint32)
        self.odd = rng.integers(0, 1 << 31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def paths(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of bytes per non-empty set: tree after tree."""
        size = np.array([len(s) for s in sets])
        start = np.cumsum(size) - size
        low = np.concatenate(sets).astype(np.uint32)
        out = np.zeros((len(sets), self.trees * self.depth), ">u2")
        for k, (flip, odd) in enumerate(zip(self.flip, self.odd)):
            x = (low ^ flip) * odd
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            # The least values are all small numbers: they are scrambled before bits are taken.
            least = np.minimum.reduceat(x, start).astype(np.uint64)
            out[:, k] = (mix64(least + np.uint64(1)) >> np.uint64(48)).astype(np.uint16)
        return out


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (sorted by ``key``) with the starts of the groups; a group never spans two."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(b.schema.get_field_index(key)).to_numpy()
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if last == 0 and held and held[-1].column(b.schema.get_field_index(key))[-1].as_py() == keys[0]:
            held.append(b)  # still one group
            continue
        if last:
            held.append(b.slice(0, last))
            yield _whole(held, key)
            held = [b.slice(last)]
        else:
            if held:
                yield _whole(held, key)
            held = [b]
    if held:
        yield _whole(held, key)


def _whole(batches: list[pa.RecordBatch], key: str) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    keys = table.column(key).to_numpy()
    return table, np.concatenate([np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), [len(keys)]])


class _Paths:
    """Paths of a task's texts, to be compared by prefix: two 64-bit words a tree."""

    def __init__(self, column: pa.ChunkedArray, trees: int, depth: int):
        values = np.zeros((len(column), trees, DEEPEST), ">u2")
        values[:, :, :depth] = np.frombuffer(b"".join(column.to_pylist()), ">u2").reshape(-1, trees, depth)
        self.words, self.trees, self.depth = values.view(">u8").astype(np.uint64), trees, depth

    def prefix(self, length: int) -> np.ndarray:
        """Words with everything behind the first ``length`` values cleared: texts x trees x 2."""
        keep = [max(0, min(4, length - 4 * w)) for w in (0, 1)]
        mask = np.array([((1 << 64) - 1) ^ ((1 << (64 - 16 * k)) - 1) if k else 0 for k in keep], np.uint64)
        return self.words & mask


def _alike(p: np.ndarray, tree: int) -> np.ndarray:
    """Which pairs of texts have the same prefix in a tree."""
    a, b = p[:, tree, 0], p[:, tree, 1]
    return (a[:, None] == a[None, :]) & (b[:, None] == b[None, :])


def _own(here: np.ndarray, deeper: np.ndarray | None, tree: int, side: np.ndarray) -> np.ndarray:
    """Pairs this block answers for: alike in none of the earlier trees, nor anywhere one value deeper
    (those were answered for before), and of different sides where the block joins two."""
    n = len(here)
    own = np.triu(np.ones((n, n), bool), 1)
    if side.any():
        own &= side[:, None] != side[None, :]
        # rows are sorted by node, not by side, so the upper triangle still has each pair once
    for t in range(tree):
        own &= ~_alike(here, t)
    if deeper is not None:
        for t in range(deeper.shape[1]):
            own &= ~_alike(deeper, t)
    return own


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the incidence of the shingles that two or more share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    code, owner = (lambda o, c: (c[o], owner[o]))(np.argsort(c := np.concatenate(sets), kind="stable"), c)
    first = np.r_[True, code[1:] != code[:-1]]
    which = np.cumsum(first) - 1
    keep = np.bincount(which)[which] > 1
    owner, which = owner[keep], which[keep]
    out = np.zeros((len(sets), len(sets)), np.float32)
    if not len(which):
        return out
    which = np.cumsum(np.r_[True, which[1:] != which[:-1]]) - 1
    for begin in range(0, int(which[-1]) + 1, 4096):
        a, b = np.searchsorted(which, [begin, begin + 4096])
        x = np.zeros((len(sets), min(4096, int(which[-1]) + 1 - begin)), np.float32)
        x[owner[a:b], which[a:b] - begin] = 1.0
        out += x @ x.T
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest member reachable from each, over a symmetric matrix of links."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5,
                    threshold: tuple[int, int] = (4, 5), trees: int = 28, depth: int = 8, recall: float = 0.9995,
                    block: int = 512) -> DataFrame:
    """Classes and links of near duplicates: doc_id, class_id, n_links, n_copies, kept; one row per input row.

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word
    shingles is at least threshold[0] / threshold[1].  Words are what ASCII white
    space separates; a text of fewer words is one shingle.  class_id is the smallest
    doc_id reachable over links (null where no document there has one), n_links the
    number of other documents linked directly, n_copies the documents with the same
    set, itself included.  kept is true for one document of each class, that with the
    smallest doc_id (a null one last), then the smallest hash of its text; rows that
    repeat both doc_id and text are kept or dropped together.  Texts are compared whatever their
    doc_id, so rows that repeat one with other texts, and rows without one, lose no link.
    A text without words (null, empty, white space) is linked with nothing and kept.

    Prefixes are shortened from ``depth`` (at most 8) values until the recall measured on
    the links found is at least ``recall``; no pair below the threshold is linked.  Other
    columns are not read.  ``block`` bounds the texts a task compares at once, not the size of a node.
    """
    return _labelled(docs, doc_id, text, words, threshold, trees, depth, recall, block).drop("text_hash")


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, columns unchanged."""
    dropped = _labelled(docs, doc_id, text, **options).filter("NOT kept").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__hash"))
    return docs.join(staged(dropped, "dropped_rows"), same, "left_anti")


def _labelled(docs: DataFrame, doc_id: str, text: str, words: int = 5, threshold: tuple[int, int] = (4, 5), trees: int = 28,
              depth: int = 8, recall: float = 0.9995, block: int = 512) -> DataFrame:
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    signature = StructType([StructField("doc_id", id_type), StructField("text_hash", LongType()), StructField("digest", BinaryType()),
                            StructField("paths", BinaryType())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, hashes = Signer(trees, depth), held("shingles", "words", WordHashes)
        for b in slices(batches, "text"):
            sets = shingles([x or "" for x in b.column("text").to_pylist()], words, hashes)
            full = [i for i, s in enumerate(sets) if len(s)]
            digest, paths = [None] * len(sets), [None] * len(sets)
            if full:
                for i, row in zip(full, signer.paths([sets[i] for i in full])):
                    digest[i], paths[i] = _digest(sets[i]), row.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(digest, pa.binary()),
                                              pa.array(paths, pa.binary())], names=signature.names)

    signed = staged(rows.select("doc_id", "text", "text_hash").mapInArrow(sign, signature), "signatures")
    # Combined map-side: a set that a third of all texts have is one row per task. All copies
    # have the same paths, so any of them will do. A class gets a number once it is written out.
    best = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash"))
    grouped = staged(signed.filter("digest IS NOT NULL").groupBy("digest").agg(
        best.alias("best"), F.count("*").alias("copies"), F.first("paths").alias("paths")), "classes")
    classes = staged(grouped.withColumn("node", F.monotonically_increasing_id()), "numbered_classes")
    found, pairs = [], Counter()
    for length in range(depth, shortest_prefix(trees, depth, threshold[0] / threshold[1], recall) - 1, -1):
        asked = _wanted(_buckets(classes, trees, depth, length, block), trees, depth, length, spark)
        part = _verify(rows, classes, asked, words, threshold, trees, depth, length, spark)
        pairs.update({r.bin: r.n for r in part.filter("bin IS NOT NULL").groupBy("bin").agg(F.sum("links").alias("n")).collect()})
        found.append(part.filter("bin IS NULL"))
        if measured_recall(pairs, trees, length) >= recall:
            break
    all_found = reduce(DataFrame.unionAll, found)
    links = staged(all_found.groupBy("node").agg(F.sum("links").alias("links")), "link_counts")
    roots = staged(components(all_found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "link_roots")
    member = staged(classes.select("digest", "node", "best", "copies").join(links, "node", "left").join(roots, "node", "left")
                    .withColumn("root", F.coalesce("root", "node")), "class_links")
    # The smallest of a class, map-side first: all classes of a corpus may hang together.
    chosen = staged(member.groupBy("root").agg(F.min("best").alias("chosen")), "class_chosen")
    known = staged(member.join(chosen, "root").select("digest", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                                      "chosen", (F.col("best") == F.col("chosen")).alias("its")), "class_known")
    # Copies join their class last, on plain exchanges that the runtime can split.
    out = signed.select("doc_id", "text_hash", "digest").filter("digest IS NOT NULL").join(known, "digest").select(
        "doc_id", F.col("chosen.doc_id").alias("class_id"), "n_links", F.col("copies").alias("n_copies"),
        (F.col("its") & F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("text_hash") == F.col("chosen.text_hash"))).alias("kept"), "text_hash")
    alone = signed.filter("digest IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"),
        F.lit(True).alias("kept"), "text_hash")
    return out.unionAll(alone)


def _digest(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def _buckets(classes: DataFrame, trees: int, depth: int, length: int, block: int) -> DataFrame:
    """Members of every node at this depth that has something new, dealt to pairs of blocks: key, tree, side, node, copies, paths.

    A leaf of full paths is new whole; a node above is new only where it branches, as the
    texts under one child have met below.
    """
    path = lambda t, n: F.substring(F.col("paths"), t * (depth * VALUE_BYTES) + 1, F.lit(n * VALUE_BYTES))
    entries = classes.select("node", "paths", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).select(
        "node", "tree", path(F.col("tree"), length).alias("prefix"), F.xxhash64(path(F.col("tree"), min(depth, length + 1))).alias("child"))
    inner = entries.groupBy("tree", "prefix").agg(F.count("*").alias("n"), F.min("child").alias("a"), F.max("child").alias("z"))
    shared = staged(inner.filter("n > 1" if length == depth else "a <> z").select("tree", "prefix", "n"), "shared_prefixes")
    members = staged(entries.select("node", "tree", "prefix").join(shared, ["tree", "prefix"]), "node_members")
    cuts = F.ceil(F.col("n") / F.lit(float(block))).cast("long")
    mine = F.pmod(F.xxhash64("node", "tree"), F.col("cuts"))
    dealt = members.withColumn("cuts", cuts).withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    keyed = dealt.select("node", "tree", F.xxhash64("tree", "prefix", low, high).alias("key"),
                         # 1 and 2: the two blocks of a pair; 0: a block with itself
                         F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))
    return keyed.join(classes.select("node", "copies", "paths"), "node")


def _wanted(blocks: DataFrame, trees: int, depth: int, length: int, spark) -> DataFrame:
    """Of each block, the members with a pair the block answers for (numbers and paths only travel)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _groups(batches, "key"):
            paths = _Paths(table.column("paths"), trees, depth)
            here, deeper = paths.prefix(length), paths.prefix(length + 1) if length < depth else None
            tree, side = table.column("tree").to_numpy(), table.column("side").to_numpy()
            keep = np.zeros(len(tree), bool)
            sizes = np.diff(starts)
            two = starts[:-1][sizes == 2]
            if len(two):  # most blocks have two members
                a, b = two, two + 1
                earlier = np.arange(trees) < tree[a][:, None]
                met = ((here[a] == here[b]).all(axis=2) & earlier).any(axis=1)
                if deeper is not None:
                    met |= (deeper[a] == deeper[b]).all(axis=2).any(axis=1)
                good = ~met & ((side[a] == 0) | (side[a] != side[b]))
                keep[a[good]] = keep[b[good]] = True
            for s, n in zip(starts[:-1][sizes > 2], sizes[sizes > 2]):
                own = _own(here[s:s + n], None if deeper is None else deeper[s:s + n], int(tree[s]), side[s:s + n])
                keep[s:s + n] = own.any(axis=0) | own.any(axis=1)
            if keep.any():
                yield from table.filter(pa.array(keep)).select(["key", "tree", "side", "node", "copies", "paths"]).to_batches()

    n = shuffle_partitions(spark)
    return staged(blocks.repartition(n, "key").sortWithinPartitions("key", "node").select(
        "key", "tree", "side", "node", "copies", "paths").mapInArrow(
        run, "key long, tree int, side int, node long, copies long, paths binary"), "wanted_members")


def _verify(rows: DataFrame, classes: DataFrame, wanted: DataFrame, words: int, threshold: tuple[int, int], trees: int,
            depth: int, length: int, spark) -> DataFrame:
    """Exact similarities within blocks: node, links (documents linked in this block), root (spanning link);
    and, with a ``bin``, how many pairs of that similarity were linked."""
    asked = wanted.groupBy("node").agg(F.first("copies").alias("copies"), F.first("paths").alias("paths"),
                                       F.collect_list(F.struct("key", "tree", "side")).alias("blocks"))
    asked = staged(asked.join(classes.select("node", "best"), "node"), "asked_members")
    texts = rows.join(asked, rows["doc_id"].eqNullSafe(F.col("best.doc_id")) & (rows["text_hash"] == F.col("best.text_hash"))).select(
        "node", "copies", "paths", "blocks", "text")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = held("shingles", "words", WordHashes)
        for b in slices(batches, "text"):
            sets = [s.tobytes() for s in shingles([x or "" for x in b.column("text").to_pylist()], words, hashes)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("node", "copies", "paths", "blocks")),
                                              pa.array(sets, pa.binary())], names=["node", "copies", "paths", "blocks", "shingles"])

    sets = texts.mapInArrow(shingle, "node long, copies long, paths binary, "
                                     "blocks array<struct<key:bigint,tree:int,side:int>>, shingles binary")
    dealt = sets.select("node", "copies", "paths", "shingles", F.explode("blocks").alias("b")).select(
        F.col("b.key").alias("key"), F.col("b.tree").alias("tree"), F.col("b.side").alias("side"),
        "node", "copies", "paths", "shingles")
    part, whole = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BINS + 1, np.int64)
        for table, starts in _groups(batches, "key"):
            key, node = table.column("key").to_numpy(), table.column("node").to_numpy()
            once = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
            if not once.all():  # a row occurs again in the input
                table, starts = _whole(table.filter(pa.array(once)).to_batches(), "key")
            paths = _Paths(table.column("paths"), trees, depth)
            here, deeper = paths.prefix(length), paths.prefix(length + 1) if length < depth else None
            tree, side, node, copies = (table.column(c).to_numpy() for c in ("tree", "side", "node", "copies"))
            sets = table.column("shingles").to_pylist()
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                mine = [np.frombuffer(x, np.uint64) for x in sets[s:e]]
                size = np.array([len(x) for x in mine], np.int64)
                if e - s == 2:
                    both = np.concatenate(mine)
                    both.sort()
                    common = np.array([[0, (both[1:] == both[:-1]).sum()]] * 2)
                else:
                    common = _common(mine).astype(np.int64)
                # common / (sizes - common) >= part / whole, in whole numbers
                either = size[:, None] + size[None, :]
                linked = common * (whole + part) >= part * either
                linked &= _own(here[s:e], None if deeper is None else deeper[s:e], int(tree[s]), side[s:e])
                i, j = np.nonzero(linked)
                np.add.at(seen, common[i, j] * BINS // (either[i, j] - common[i, j]), 1)
                linked |= linked.T
                links = (linked * copies[None, s:e]).sum(axis=1)
                some = np.flatnonzero(links)
                if len(some):
                    out.append((node[s:e][some], links[some], node[s:e][_roots(linked)[some]]))
            if out:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(columns[0]), pa.int32())], names=["node", "links", "root", "bin"])
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.array(seen[some], pa.int64()), pa.nulls(len(some), pa.int64()),
                                          pa.array(some, pa.int32())], names=["node", "links", "root", "bin"])

    n = shuffle_partitions(spark)
    return staged(dealt.repartition(n, "key").sortWithinPartitions("key", "node").mapInArrow(
        run, "node long, links long, root long, bin int"), "verified_links")
