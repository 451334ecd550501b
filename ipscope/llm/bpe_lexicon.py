"""Byte-level BPE through a minimal acyclic transducer of frequent words.

The frequent words of the corpus are compiled, with their ids as output, into a
deterministic acyclic automaton whose common suffixes are shared.  The file is put
in the shared folder, Spark copies it to each executor once, and the workers
memory-map it.  Words it does not accept are merged exactly by rank.
"""

from __future__ import annotations

import json
import mmap
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ipscope.llm.common import _HELD, held, slices, staged
from ipscope.llm.pieces import ColumnEncoder, cut_column, words_column
from ipscope.session import scratch_path

WORD_BYTES = 32  # longest word of the automaton


def byte_letters() -> dict[str, int]:
    """The letters in which a byte-level vocabulary spells bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file; exact merging of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token.encode()
        self.lengths = np.array([len(x) for x in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        ranks = {x: i for i, x in enumerate(spelled) if x and i not in self.special.values()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        self.merger = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def at(cls, path: str) -> Merges:
        return held("lexicon", path, lambda: cls(path))

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of words: the pair of lowest rank, then leftmost, is merged until none is left."""
        return [self.merger.encode_ordinary(w) for w in words]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids; bytes that are no UTF-8 become U+FFFD."""
        length = self.lengths[ids]
        stop = np.cumsum(length)
        where = np.repeat(self.starts[ids] - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)
        raw = self.bytes[where].tobytes()
        ends = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(counts)])]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton of the words; numbers on its arcs add up to a word's place.

    Words are added in order; a state whose words are complete is replaced by an
    equal one seen before, so suffixes are shared.  The place leads to the word's ids.
    """
    states: list[list] = [[False, {}]]  # final, arcs
    known: dict[tuple, int] = {}
    path, last = [0], b""

    def settle(depth: int) -> None:
        while len(path) - 1 > depth:
            child = path.pop()
            final, arcs = states[child]
            same = known.setdefault((final, tuple(arcs.items())), child)
            states[path[-1]][1][last[len(path) - 1]] = same

    for word in sorted(words):
        depth = 0
        while depth < min(len(word), len(last)) and word[depth] == last[depth]:
            depth += 1
        settle(depth)
        for byte in word[depth:]:
            states.append([False, {}])
            states[path[-1]][1][byte] = len(states) - 1
            path.append(len(states) - 1)
        states[path[-1]][0] = True
        last = word
    settle(0)

    order, below = [], {}  # children before parents, without recursion
    stack = [(0, False)]
    while stack:
        state, done = stack.pop()
        if done:
            order.append(state)
            below[state] = states[state][0] + sum(below[c] for c in states[state][1].values())
        elif state not in below:
            below[state] = 0
            stack.append((state, True))
            stack += [(c, False) for c in states[state][1].values() if c not in below]
    place = {s: i for i, s in enumerate(reversed(order))}
    arcs = []
    for s in order:
        final, out = states[s]
        before = int(final)
        for byte in sorted(out):
            arcs.append((place[s] << 8 | byte, place[out[byte]], before))
            before += below[out[byte]]
    table = np.array(sorted(arcs), np.int64).reshape(-1, 3)
    final = np.zeros(len(order), np.int64)
    for s in order:
        final[place[s]] = states[s][0]
    ids = [words[w] for w in sorted(words)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    parts = [table[:, 0], table[:, 1], table[:, 2], final, offsets, np.array([i for x in ids for i in x], np.int64)]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


class Lexicon:
    """A compiled automaton, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, np.int64, 6)
        at, parts = sizes.nbytes, []
        for n in sizes:
            parts.append(np.frombuffer(self.map, np.int64, n, at))
            at += 8 * int(n)
        self.keys, self.next, self.add, self.final, self.offsets, self.ids = parts


    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 where the automaton does not accept it; all words advance together."""
        size = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(words), np.uint8)
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        live = np.flatnonzero((size > 0) & (size <= WORD_BYTES))
        out = np.full(len(words), -1, np.int64)
        step = 0
        while len(live) and len(self.keys):
            key = state[live] << 8 | raw[start[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            live, arc = live[hit], arc[hit]
            total[live] += self.add[arc]
            state[live] = self.next[arc]
            step += 1
            ended = size[live] == step
            done = live[ended]
            accepted = done[self.final[state[done]] > 0]
            out[accepted] = total[accepted]
            live = live[~ended]
        return out


class LexiconEncoder:
    """Ids of texts: automaton first, exact merging for the words it does not accept."""

    def __init__(self, tokenizer: str, lexicon: str, most: int = 100_000):
        self.name, self.merges, self.lexicon = lexicon, Merges.at(tokenizer), Lexicon(SparkFiles.get(lexicon))
        self.column = ColumnEncoder(self.words, "<i4", list(self.merges.special), most)

    @classmethod
    def at(cls, tokenizer: str, lexicon: str) -> LexiconEncoder:
        old = held("lexicon", "encoder", lambda: cls(tokenizer, lexicon))
        if old.name != lexicon:  # one automaton at a time stays mapped
            del _HELD["encoder"]
        return held("lexicon", "encoder", lambda: cls(tokenizer, lexicon))

    def words(self, words: list[str]) -> list[bytes]:
        raw, special = [w.encode() for w in words], self.merges.special
        place = self.lexicon.places(raw).tolist()
        unseen = [i for i, p in enumerate(place) if p < 0]
        merged = iter(self.merges.merge([words[i] for i in unseen]))
        offsets, ids = self.lexicon.offsets.tolist(), self.lexicon.ids.astype("<i4").tobytes()
        out = [ids[4 * offsets[p]:4 * offsets[p + 1]] if p >= 0 else array("i", next(merged)).tobytes() for p in place]
        for i in [i for i in unseen if words[i] in special]:
            out[i] = array("i", [special[words[i]]]).tobytes()
        return out


def word_counts(docs: DataFrame, text: str = "text", most: int = 150_000) -> DataFrame:
    """Words of all whole texts with their counts (word, n); a task adds up before it sends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.table({"word": pa.array(list(counted), pa.string()), "n": pa.array(list(counted.values()), pa.int64())})
            counted.clear()
            yield from table.to_batches(1 << 16)

        for b in slices(batches, "text", 1 << 22):
            pieces, codes, size = cut_column(b.column("text"))
            first = np.cumsum(size) - size
            begin = np.bincount(codes[first], minlength=len(pieces))
            later = np.bincount(codes, minlength=len(pieces)) - begin
            whole = pa.concat_arrays([pieces, pc.binary_join_element_wise("", pieces, " ")])
            names, words, count = words_column(whole, [])
            times = np.bincount(words, np.repeat(np.concatenate([begin, later]), count), len(names)).astype(np.int64).tolist()
            counted.update({w: n for w, n in zip(names, times) if n})
            if len(counted) > most:
                yield from flush()
        yield from flush()

    return (docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, tokenizer: str, text: str = "text", share: float = 2.0 ** -17) -> str:
    """Compile the words that make up ``share`` or more of all words; returns the file's name.

    At most 1 / share words can be that frequent, so what the driver compiles and
    Spark copies to the executors is bounded whatever the corpus; words over
    WORD_BYTES bytes are left to merging.  Counts cover all documents.
    """
    spark = docs.sparkSession
    counts = staged(word_counts(docs, text), "word_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = counts.filter((F.col("n") >= max(2, total * share)) & (F.octet_length("word") <= WORD_BYTES))
    words = [r.word for r in frequent.select("word").collect()]
    ids = Merges.at(tokenizer).merge(words)
    return publish(spark, compile_lexicon({w.encode(): i for w, i in zip(words, ids)}))


def publish(spark: SparkSession, content: bytes) -> str:
    """Write bytes to the shared folder and have Spark copy the file to every executor."""
    path = scratch_path(spark, "llm", "lexicon") + ".bin"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(hadoop)
    try:
        out.write(content)
    finally:
        out.close()
    spark.sparkContext.addFile(fs.makeQualified(hadoop).toString())
    return path.rsplit("/", 1)[1]


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, lexicon: str) -> Iterator[pa.RecordBatch]:
    encoder = LexiconEncoder.at(tokenizer, lexicon)
    for b in slices(batches, "text", 1 << 22):
        found, counts = encoder.column(b.column("text"))
        stops = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(stops), pa.array(found))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    merges = Merges.at(tokenizer)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            b = batch.slice(start, 256)
            ids = b.column(b.schema.get_field_index("ids"))
            counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            texts = merges.decode(ids.flatten().to_numpy(zero_copy_only=False), counts.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[*b.schema.names, "decoded"])


def _named(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), f"doc_id {kind}, ids array<int>"


def encode(docs: DataFrame, tokenizer: str, lexicon: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text: doc_id, ids (array of int).

    Ids are those of the tokenizers library with this file, without special tokens
    added; strings of special tokens in a text become their ids.  A null or empty
    text has no ids.  One row per input row, in any order; repeated rows give
    repeated results, null doc_ids stay null; other columns are not read.
    """
    rows, schema = _named(docs, doc_id, text)
    return rows.mapInArrow(lambda batches: _encoded(batches, tokenizer, lexicon), schema)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Texts of id lists: adds column ``decoded``; null ids give an empty text."""
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    return encoded.mapInArrow(lambda batches: _decoded(batches, tokenizer), schema)


def round_trip(docs: DataFrame, tokenizer: str, lexicon: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one worker per task: doc_id, ids, decoded."""
    rows, schema = _named(docs, doc_id, text)
    return rows.mapInArrow(lambda batches: _decoded(_encoded(batches, tokenizer, lexicon), tokenizer), schema + ", decoded string")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """Counts and digests of ``ids`` and ``decoded``: doc_id, n_tokens, ids_sha256, decoded_sha256, and ``more`` columns."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more)
