"""Fill-in-the-middle transformation over a set of code-point boundaries.

The bytes of a text at which a code point starts, and its end, form a set of
integers held the way Roaring bitmaps hold one: a container for every 2**16
positions, as a sorted array, a bitmap or runs, whichever is smallest, with the
cumulative cardinalities of the containers beside them.  A cut after ``k`` code
points is the k-th member: a search over the cumulative cardinalities finds the
container, a select inside it the position.  Plain ASCII is a single run a
container, so its cuts cost no scan of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ipscope.llm.common import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
CHUNK = 1 << 16  # positions of a container
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])  # bytes that start a code point


class ArrayContainer:
    """Few positions, each on its own: 2 bytes a member."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """Many scattered positions: 8 KB, with the members of each 64-bit word counted up."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(CHUNK, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        w = int(np.searchsorted(self.upto, k, side="right"))
        word, rank = int(self.words[w]), k - (int(self.upto[w - 1]) if w else 0)
        for _ in range(rank):
            word &= word - 1  # drop the lowest member
        return 64 * w + (word & -word).bit_length() - 1


class RunContainer:
    """Runs of neighbours: 4 bytes a run, with the members before each run counted up."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.int64)
        self.before = np.cumsum(lengths, dtype=np.int64) - lengths

    def select(self, k: int) -> int:
        r = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[r]) + k - int(self.before[r])


def container(low: np.ndarray):
    """The smallest container of sorted distinct positions below 2**16 (at least one)."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    array, bitmap, runs = 2 * len(low), CHUNK // 8, 4 * (len(breaks) + 1)
    if runs <= min(array, bitmap):
        edges = np.concatenate(([0], breaks, [len(low)]))
        return RunContainer(low[edges[:-1]], np.diff(edges))
    return ArrayContainer(low) if array <= bitmap else BitmapContainer(low)


class BoundarySet:
    """Where the code points of a UTF-8 text start, and where it ends."""

    def __init__(self, text: bytes):
        self.size = len(text)
        lead = _LEAD[np.frombuffer(text, np.uint8)]
        self.keys, self.containers, counts = [], [], []
        for key in range(0, self.size // CHUNK + 1):
            low = np.flatnonzero(lead[key * CHUNK:(key + 1) * CHUNK])
            if key == self.size // CHUNK:
                low = np.append(low, self.size % CHUNK)  # the end of the text
            if len(low):
                self.keys.append(key)
                self.containers.append(container(low))
                counts.append(len(low))
        self.upto = np.cumsum(counts, dtype=np.int64)

    @property
    def points(self) -> int:
        """Code points of the text."""
        return int(self.upto[-1]) - 1

    def select(self, *ks: int) -> list[int]:
        """Byte offsets behind the first ``k`` code points, for each ``k`` of 0 to ``points``."""
        found = np.searchsorted(self.upto, ks, side="right")
        return [self.keys[c] * CHUNK + self.containers[c].select(k - (int(self.upto[c - 1]) if c else 0))
                for k, c in zip(ks, found.tolist())]


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four 32-bit numbers of a document: 8-digit groups of the hex SHA-256 of ``seed:doc_id``; a null id counts as ''."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1,
              rate: int = 90, spm: int = 20) -> DataFrame:
    """Each document cut in three at two code points and put in order for infilling.

    Returns one row per input row: doc_id, n (code points), form, prefix_chars,
    middle_chars (null where nothing was cut) and output.  With the draws h1 to h4 of
    the document, the cuts are the smaller and larger of h1 % (n+1) and h2 % (n+1).
    form is plain (output is the text) if the text is empty, contains one of the three
    marks, or h3 % 100 >= ``rate``; else spm if h4 % 100 < ``spm``, else psm:
    ``<P>``prefix``<S>``suffix``<M>``middle and ``<S>``suffix``<P>``prefix``<M>``middle.  A null text
    counts as empty.  A part may be empty.  Rows that repeat a doc_id are cut alike if
    their texts are equal; a null doc_id draws like an empty one and stays null.  Texts
    of any length are cut whole; a task holds about 1 MB of them at once, or one text.
    An empty table gives no rows.  Other columns are not read.
    """
    id_type = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"),
                       *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col(doc_id), seed), 1)])
    out = StructType([StructField("doc_id", id_type), StructField("n", LongType()), StructField("form", StringType()),
                      StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                      StructField("output", BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(iter([b]), "raw"):
                h = np.stack([part.column(f"h{i}").to_numpy() for i in range(1, 5)], axis=1).tolist()
                made = [_cut(raw, hs, rate, spm) for raw, hs in zip(part.column("raw").to_pylist(), h)]
                n, form, first, middle, output = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary())], names=out.names)

    return rows.mapInArrow(cut, out).withColumn("output", F.col("output").cast("string"))


def _cut(raw: bytes, h: list[int], rate: int, spm: int) -> tuple:
    points = BoundarySet(raw)
    n = points.points
    if not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw or h[2] % 100 >= rate:
        return n, "plain", None, None, raw
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = points.select(low, high)
    parts = (SUFFIX, raw[b:], PREFIX, raw[:a]) if h[3] % 100 < spm else (PREFIX, raw[:a], SUFFIX, raw[b:])
    return n, "spm" if h[3] % 100 < spm else "psm", low, high - low, b"".join([*parts, MIDDLE, raw[a:b]])


def restore(output: bytes, form: str) -> bytes:
    """The text that ``output`` of that form was made from; cut texts contain no mark, so the first one found is the mark."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE, 1)
    if form == "psm":
        prefix, suffix = head[len(PREFIX):].split(SUFFIX, 1)
    else:
        suffix, prefix = head[len(SUFFIX):].split(PREFIX, 1)
    return prefix + middle + suffix


def digests(made: DataFrame, output: str = "output") -> DataFrame:
    """``made`` with the SHA-256 of its output and of the text restored from it, in place of the output."""
    names = [c for c in made.columns if c != output]
    fields = StructType([*(made.schema[c] for c in names), StructField("output_sha256", StringType()),
                         StructField("restored_sha256", StringType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            outputs, forms = b.column("raw").to_pylist(), b.column("form").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array([hashlib.sha256(x).hexdigest() for x in outputs], pa.string()),
                 pa.array([hashlib.sha256(restore(x, f)).hexdigest() for x, f in zip(outputs, forms)], pa.string())],
                names=fields.names)

    return made.select(*names, F.col(output).cast("binary").alias("raw")).mapInArrow(digest, fields)
