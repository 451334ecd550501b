"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their frequency rank, so frequent ones are small, and stored in
one to four bytes; the lengths stand apart, two bits each, in control bytes.  A
folder holds ``blocks`` (Parquet rows of whole documents in doc_id order: control
bytes and data bytes), ``ranks`` (the ids by rank) and ``shards`` (ids before each
shard).  Blocks are written by Spark's committer, so a lost task leaves no partial
file, on any file system Spark can write.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ipscope.llm.common import held, shuffle_partitions, slices, staged
from ipscope.llm.bpe_lexicon import byte_letters
from ipscope.llm.pieces import ColumnEncoder

#: Lengths in bytes of the four numbers of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = np.ascontiguousarray(numbers, dtype="<u4")
    code = ((numbers >> 8) > 0).astype(np.uint8) + ((numbers >> 16) > 0) + ((numbers >> 24) > 0)
    padded = np.zeros(-(-len(code) // 4) * 4, dtype=np.uint8)
    padded[:len(code)] = code
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = numbers.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers back: lengths by table lookup, then one masked load for each."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    start = np.cumsum(length) - length
    loads = np.ndarray((len(data) + 1,), dtype="<u4", buffer=data + b"\0\0\0\0", strides=(1,))
    return loads[start] & MASKS[length]


class PieceEncoder:
    """The tokenizers library over the distinct words of texts; a worker keeps the ids of words it met again.

    The library splits a text at special tokens and by its pattern, spells each word's
    bytes as letters and merges them.  Splitting and spelling are done here for many
    texts at once, and the library's model merges each distinct word.
    """

    def __init__(self, path: str, most: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or model["type"] != "BPE":
            raise ValueError(f"{path} is no byte-level BPE file")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.tokenizer = Tokenizer(BPE(model["vocab"], merges, cache_capacity=0))  # known words are kept here
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letter = {b: c for c, b in byte_letters().items()}
        self.code = "H" if max([*model["vocab"].values(), *self.special.values()]) < 1 << 16 else "I"
        self.column = ColumnEncoder(self._encode, "<u2" if self.code == "H" else "<u4", list(self.special), most)

    @classmethod
    def at(cls, path: str) -> PieceEncoder:
        return held("token files", path, lambda: cls(path))

    def _spell(self, word: str) -> str:
        if word.isascii() and word[1:].isalpha():
            return (self.letter[ord(word[0])]) + word[1:]
        return "".join([self.letter[b] for b in word.encode()])

    def _encode(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([self._spell(w) for w in words], add_special_tokens=False)
        return [array(self.code, [self.special[w]] if w in self.special else e.ids).tobytes() for w, e in zip(words, found)]

    def encode(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """Ids of each text as little-endian numbers, with ``end_id`` behind."""
        ids, counts = self.column(texts)
        end, wide = array(self.code, [end_id]).tobytes(), self.column.kind.itemsize
        raw, stops = ids.tobytes(), (np.cumsum(counts) * wide).tolist()
        return [raw[a:b] + end for a, b in zip([0, *stops], stops)]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                      end_id: int = 2, block: int = 1 << 16) -> None:
    """Encode every text and write the files under ``path`` in ascending doc_id order.

    ``tokenizer`` is a byte-level BPE file of the tokenizers library that every
    executor has.  A null or empty text is its end id alone.  A null doc_id comes
    first; rows that share a doc_id are ordered by their ids.  Blocks close at
    ``block`` ids or behind a longer document.  An empty table gives empty files.
    Other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.at(tokenizer)
        for b in slices(batches, "text", 1 << 22):
            ids = encoder.encode(b.column("text"), end_id)
            wide = 2 if encoder.code == "H" else 4
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ids, pa.binary()), pa.array([wide] * len(ids), pa.int32())],
                names=["doc_id", "ids", "wide"])

    coded = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
                   .mapInArrow(encode, f"doc_id {id_type}, ids binary, wide int"), "token_ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in slices(batches, "ids", 1 << 24):
            kind = f"<u{b.column('wide')[0].as_py()}"
            n = np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), kind))
            total = np.pad(total, (0, max(0, len(n) - len(total))))
            total[:len(n)] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())],
                                         names=["id", "n"])

    # One row per vocabulary entry: the size is the tokenizer's, whatever the input.
    by_count = coded.select("ids", "wide").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ids_by_rank = np.array([r.id for r in by_count.orderBy(F.desc("n"), "id").select("id").collect()], dtype="<u4")
    rank_of = np.zeros(int(ids_by_rank.max(initial=0)) + 1, dtype="<u4")
    rank_of[ids_by_rank] = np.arange(len(ids_by_rank))
    ranks = spark.sparkContext.broadcast(rank_of)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, offset = TaskContext.get().partitionId(), 0, 0
        names, rows, held = [], [], 0

        def close() -> pa.RecordBatch:
            counts = [len(x) for x in rows]
            control, data = pack(ranks.value[np.concatenate(rows)])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int64()), pa.array([offset], pa.int64()),
                 pa.array([sum(counts)], pa.int64()),
                 pa.array([names], pa.list_(id_arrow)), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["shard", "block", "offset", "n_ids", "doc_ids", "counts", "control", "data"])

        id_arrow = pa.int64()
        for b in batches:
            id_arrow = b.schema.field("doc_id").type
            for name, ids, wide in zip(b.column("doc_id").to_pylist(), b.column("ids"), b.column("wide").to_pylist()):
                row = np.frombuffer(ids.as_buffer(), f"<u{wide}")
                names.append(name)
                rows.append(row)
                held += len(row)
                if held >= block:
                    yield close()
                    number, offset, names, rows, held = number + 1, offset + held, [], [], 0
        if rows:
            yield close()

    (coded.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "ids")
     .mapInArrow(blocks, f"shard int, block long, offset long, n_ids long, doc_ids array<{id_type}>, "
                         "counts array<bigint>, control binary, data binary")
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    (spark.createDataFrame([(ids_by_rank.tobytes(),)], "ids_by_rank binary").coalesce(1)
     .write.parquet(f"{path}/ranks"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    (spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
     .withColumn("ids_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
     .coalesce(1).write.parquet(f"{path}/shards"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before), ids (little-endian uint32)."""
    blocks, shards = spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/shards")
    table = spark.read.parquet(f"{path}/ranks").first()[0]  # as long as the vocabulary
    ids_by_rank = spark.sparkContext.broadcast(np.frombuffer(table, "<u4"))
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                ids = ids_by_rank.value[unpack(b["control"], b["data"], b["n_ids"])]
                counts = np.array(b["counts"], np.int64)
                stop = np.cumsum(counts)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                     pa.array(b["ids_before"] + b["offset"] + stop - counts, pa.int64()),
                     pa.array([raw[4 * s:4 * e] for s, e in zip(stop - counts, stop)], pa.binary())],
                    names=["doc_id", "start", "ids"])

    return (blocks.join(shards.select("shard", "ids_before"), "shard")
            .select("doc_ids", "counts", "n_ids", "offset", "ids_before", "control", "data")
            .mapInArrow(decode, f"doc_id {id_type}, start long, ids binary"))
