"""Removal of long repeated passages by longest-previous-factor arrays.

Texts are bytes.  Every string of ``span`` bytes that also starts in a document with
a smaller id is covered and removed.  Suffixes are dealt to buckets by a minimizer,
the smallest hash among the k-grams of their first ``span`` bytes, so suffixes that
agree that far meet; a run of neighbouring suffixes with one minimizer travels as one
segment.  In a bucket the suffixes whose first ``span`` bytes occur twice are put in
suffix order; with the common prefixes of neighbours, the previous and the next
suffix of a smaller document give each suffix its longest earlier match.  A suffix
is covered if that match has ``span`` bytes or more; shorter ones are not looked for.

Minimizers that occur in one document only cannot belong to a repeat.  They are found
first, and a filter of fixed size keeps their segments from travelling.  A second such
filter marks minimizers of very many documents: their segments are cut into windows of
``span`` bytes, and each window is dealt by its own hash, so that a phrase of most
documents amid varied text is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope.llm.common import mix64, shuffle_partitions, slices, staged
from ipscope.llm.near_dup import _groups

GRAM = 24  # bytes of a k-gram: three 8-byte loads
COARSE = 6  # 2**COARSE minimizers share a bit of the filter of hot ones
FINE = 8  # buckets of segments a task matches, one after another
WINDOWS = 1 << 17  # windows of hot minimizers that a task holds back
PART = 1 << 16  # positions hashed at once, to stay in cache
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the offsets of its rows; nulls are empty."""
    texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) else b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def minimizers(raw: np.ndarray, span: int) -> np.ndarray:
    """Smallest k-gram hash within the first ``span`` bytes from each position; len(raw) - span + 1 values."""
    wide = span - GRAM + 1
    out = np.empty(max(0, len(raw) - span + 1), np.uint64)
    for begin in range(0, len(out), PART):
        n = min(PART, len(out) - begin) + wide - 1  # k-grams needed
        loads = np.ndarray((n + GRAM - 8,), "<u8", raw[begin:begin + n + GRAM - 1].tobytes(), strides=(1,))
        h = loads[:n] * _C[0]
        h ^= h >> np.uint64(29)
        h += loads[8:n + 8]
        h *= _C[1]
        h ^= h >> np.uint64(32)
        h += loads[16:n + 16]
        h *= _C[2]
        h ^= h >> np.uint64(31)
        h *= _C[0]
        h ^= h >> np.uint64(32)
        reach = 1
        while reach * 2 <= wide:
            h = np.minimum(h[:-reach], h[reach:])
            reach *= 2
        if reach < wide:
            h = np.minimum(h[:reach - wide], h[wide - reach:])
        out[begin:begin + len(h)] = h
    return out


def runs(raw: np.ndarray, offsets: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of positions with one minimizer within a row: minimizer, row, position in raw, positions."""
    count = np.maximum(0, np.diff(offsets) - span + 1)
    if not count.sum():
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    row = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(row)) + np.repeat(offsets[:-1] - (np.cumsum(count) - count), count)
    found = minimizers(raw, span)[place]
    first = np.flatnonzero(np.r_[True, (found[1:] != found[:-1]) | (row[1:] != row[:-1])])
    return found[first], row[first], place[first], np.diff(np.r_[first, len(row)])


def repeated_minimizers(docs: DataFrame, span: int, bits: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Two filters: minimizers of two documents or more (2**bits bits), and those of about ``hot`` or more.

    A task sends each minimizer once per few megabytes of text: 36 bits of it, and in 4
    bits how many documents had it, to the next power of two.  Every bucket of minimizers
    answers with its part of the filters; up to 2**COARSE minimizers share a bit of the second.
    Their sizes are fixed: with more repeats they let more through, which costs traffic
    and changes no result.
    """
    buckets = 1 << min(bits - 3, (2 * shuffle_partitions(docs.sparkSession) - 1).bit_length())
    low, shift = np.uint64((1 << 36) - 1), np.uint64(bits - buckets.bit_length() + 1)
    coarse = min(COARSE, int(shift) - 3)  # a bucket's part of a filter is whole bytes

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 22):
            found, row, _, _ = runs(*buffers(b.column("text")), span)
            order = np.lexsort((row, found))
            found, row = found[order], row[order]
            once = np.r_[True, (found[1:] != found[:-1]) | (row[1:] != row[:-1])] if len(found) else np.zeros(0, bool)
            values, documents = np.unique(found[once], return_counts=True)
            level = np.minimum(15, np.ceil(np.log2(documents))).astype(np.uint64)
            code = (values & low) << np.uint64(4) | level
            bucket = ((values & np.uint64((1 << bits) - 1)) >> shift).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            raw = np.ascontiguousarray(code[order]).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
            used, starts = np.unique(bucket[order], return_index=True)
            stops = np.r_[starts[1:], len(order)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array([raw[5 * s:5 * e] for s, e in zip(starts, stops)], pa.binary())],
                names=["bucket", "codes"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _groups(batches, "bucket"):
            bucket, codes = table.column("bucket").to_numpy(), table.column("codes").to_pylist()
            for s, e in zip(starts[:-1], starts[1:]):
                wide = np.zeros((sum(map(len, codes[s:e])) // 5, 8), np.uint8)
                wide[:, :5] = np.frombuffer(b"".join(codes[s:e]), np.uint8).reshape(-1, 5)
                code = np.sort(wide.view("<u8").ravel())
                first = np.flatnonzero(np.r_[True, code[1:] >> np.uint64(4) != code[:-1] >> np.uint64(4)])
                documents = np.add.reduceat(np.int64(1) << (code & np.uint64(15)).astype(np.int64), first)
                place = (code[first] >> np.uint64(4) & np.uint64((1 << int(shift)) - 1)).astype(np.int64)
                some, many = np.zeros(1 << int(shift), np.uint8), np.zeros(1 << int(shift) - coarse, np.uint8)
                some[place[documents > 1]] = 1
                many[place[documents >= hot] >> coarse] = 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket[s]], pa.int64()),
                     *(pa.array([np.packbits(x, bitorder="little").tobytes()], pa.binary()) for x in (some, many))],
                    names=["bucket", "some", "many"])

    partitions = 2 * shuffle_partitions(docs.sparkSession)
    parts = (docs.select("text").mapInArrow(send, "bucket long, codes binary")
             .repartitionById(partitions, F.expr(f"int(bucket % {partitions})")).sortWithinPartitions("bucket")
             .mapInArrow(answer, "bucket long, some binary, many binary"))
    filters = [np.zeros(1 << n - 3, np.uint8) for n in (bits, bits - coarse)]
    for r in staged(parts, "minimizer_filter").toLocalIterator():  # 2**bits bits in all, and a part of that
        for out, part in zip(filters, (r.some, r.many)):
            out[r.bucket * len(part):(r.bucket + 1) * len(part)] = np.frombuffer(part, np.uint8)
    return filters[0], filters[1]


def marked(flags: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bit of each value is set."""
    at = values & np.uint64(len(flags) * 8 - 1)
    return (flags[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


SLICE = 1 << 18  # suffixes put in order at once
COUNTED = 256  # bytes up to which the length of a match is counted; ``span`` is what decides


def window_hashes(loads: np.ndarray, place: np.ndarray, span: int) -> np.ndarray:
    """A hash of the ``span`` bytes from each position; ``loads`` are the 8-byte words from every byte on."""
    out = np.zeros(len(place), np.uint64)
    for k in [*range(0, span - 7, 8), span - 8]:
        out = (out ^ loads[place + k]) * _C[k // 8 % 3]
        out ^= out >> np.uint64(29)
    return out


def _rest(loads: np.ndarray, place: np.ndarray, left: np.ndarray, k: int) -> np.ndarray:
    """The 8 bytes from ``place + k`` as a big-endian number, zero behind the end of the segment."""
    inside = np.clip(left - k, 0, 8).astype(np.uint64)
    drop = np.uint64(8) * (np.uint64(8) - inside)
    word = loads[np.minimum(place + k, len(loads) - 1)].byteswap()
    return np.where(inside == 0, np.uint64(0), word >> np.minimum(drop, np.uint64(63)) << np.minimum(drop, np.uint64(63)))


def _leading(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes in which big-endian words agree."""
    differ = a ^ b
    high = np.zeros(len(differ), np.int64)  # the highest bit that differs, in steps of bytes
    for bits in (32, 16, 8):
        high += np.where(differ >> (high + bits).astype(np.uint64) > 0, bits, 0)
    return np.where(differ == 0, 8, 7 - high // 8)


def nearest_smaller(documents: np.ndarray, common: np.ndarray, span: int) -> np.ndarray:
    """Common prefix with the previous suffix of a smaller document, 0 if that has under ``span`` bytes.

    ``common`` is that of each suffix with the one before.  Every suffix points to one
    before it; as long as that one's document is not smaller, it takes over its pointer,
    with the least common prefix on the way.
    """
    at, least = np.maximum(np.arange(len(documents)) - 1, 0), np.where(common >= span, common, 0)
    while True:
        more = np.flatnonzero((least > 0) & (documents[at] >= documents))
        if not len(more):
            return least
        j = at[more]
        least[more], at[more] = np.minimum(least[more], least[j]), at[j]


def longest_previous(raw: np.ndarray, loads: np.ndarray, place: np.ndarray, left: np.ndarray, documents: np.ndarray, span: int) -> np.ndarray:
    """Longest match of each suffix in a smaller document, 0 where it has under ``span`` bytes.

    The suffixes begin at ``place`` and have ``left`` bytes.  They are sorted by ``span``
    bytes, and those that agree there by what follows, up to ``COUNTED`` bytes or a few more.
    """
    keys = np.lib.stride_tricks.sliding_window_view(raw, span)[place].view(f"S{span}").ravel()
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    keep = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
    out = np.zeros(len(place), np.int64)
    if not len(keep):
        return out
    at, stretch = order[keep], np.cumsum(np.r_[True, ~same])[keep]
    common = np.where(np.r_[False, stretch[1:] == stretch[:-1]], span, 0)
    # Eight bytes at a time, suffixes that still agree with a neighbour are sorted on.
    some, group = np.arange(len(at)), stretch
    for k in range(span, min(COUNTED, int(left[at].max())), 8):
        word = _rest(loads, place[at[some]], left[at[some]], k)
        sorting = np.lexsort((left[at[some]], word, group))  # one that ends here stands before those that go on
        at[some], word = at[some[sorting]], word[sorting]
        pair = np.flatnonzero(group[1:] == group[:-1])
        agree = _leading(word[pair], word[pair + 1])
        common[some[pair + 1]] += agree
        ends = np.minimum(left[at[some[pair]]], left[at[some[pair + 1]]])
        on = pair[(agree == 8) & (ends > k + 8)]
        tied = np.zeros(len(some), bool)
        tied[on] = tied[on + 1] = True
        first = np.ones(len(some), bool)  # of its new group
        first[on + 1] = False
        some, group = some[tied], np.cumsum(first)[tied]
        if not len(some):
            break
    common[1:] = np.minimum(common[1:], np.minimum(left[at[1:]], left[at[:-1]]))  # zeros behind the end are no text
    back = nearest_smaller(documents[at], common, span)
    ahead = nearest_smaller(documents[at][::-1], np.r_[common[1:], 0][::-1], span)[::-1]
    out[at] = np.maximum(back, ahead)
    return out


def earlier_matches(segments: list[bytes], documents: np.ndarray, span: int) -> list[np.ndarray]:
    """For each distinct segment, its suffixes' longest matches in smaller documents (0 under ``span`` bytes).

    Equal windows have equal hashes, so suffixes whose window hash is alone have no such
    match; the others are put in order in slices that keep equal hashes together.
    """
    size = np.array([len(s) - span + 1 for s in segments])
    raw = np.frombuffer(b"".join([*segments, bytes(8)]), np.uint8)
    loads = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    owner = np.repeat(np.arange(len(segments)), size)
    place = np.arange(len(owner)) + owner * (span - 1)
    code = window_hashes(loads, place, span)
    order = np.argsort(code)
    code = code[order]
    same = code[1:] == code[:-1]
    order, code = (x[np.r_[False, same] | np.r_[same, False]] for x in (order, code))
    out = np.zeros(len(place), np.int64)
    ends = np.cumsum(size + span - 1)
    begin = 0
    while begin < len(order):
        stop = int(np.searchsorted(code, code[min(begin + SLICE, len(code)) - 1], side="right"))
        at = order[begin:stop]
        out[at] = longest_previous(raw, loads, place[at], ends[owner[at]] - place[at], documents[owner[at]], span)
        begin = stop
    return np.split(out, np.cumsum(size)[:-1])


class _Segments:
    """Segments of a task, held back where a smaller document of the task has the same one."""

    def __init__(self, span: int, buckets: int, keep: np.ndarray, hot: np.ndarray):
        self.span, self.buckets, self.keep, self.hot = span, buckets, keep, hot
        self.coarse = np.uint64((len(keep) // len(hot)).bit_length() - 1)
        self.clear()

    def clear(self) -> None:
        self.owner: dict[bytes, int] = {}
        self.sent: list[tuple[int, int, int, int, bytes]] = []  # bucket, doc, hash, position, segment
        self.spans: list[list[int]] = []  # doc, hash, start, stop
        self.size = self.windows = 0

    def add(self, docs: list[int], hashes: list[int], texts: pa.Array) -> Iterator[pa.RecordBatch]:
        raw, offsets = buffers(texts)
        found, row, place, count = runs(raw, offsets, self.span)
        some = np.flatnonzero(marked(self.keep, found))
        bucket = (mix64(found[some]) % np.uint64(self.buckets)).tolist()
        cut = marked(self.hot, (found[some] & np.uint64(len(self.keep) * 8 - 1)) >> self.coarse).tolist()
        whole, owner = raw.tobytes(), self.owner
        last: list[int] = [-1, 0, 0, 0]
        ends = (place + count + self.span - 1)[some].tolist()
        for b, r, a, z, zero, hot in zip(bucket, row[some].tolist(), place[some].tolist(), ends, offsets[row[some]].tolist(), cut):
            text, doc = whole[a:z], docs[r]
            known = owner.get(text)
            if known is not None and doc > known:
                if last[0] == r and a - zero <= last[3]:
                    last[3] = self.spans[-1][3] = z - zero
                else:
                    self.spans.append([doc, hashes[r], a - zero, z - zero])
                    last = [r, 0, 0, z - zero]
                continue
            owner[text] = doc
            if not hot:
                self.sent.append((b, doc, hashes[r], a - zero, text))
                continue
            for k in range(a, z - self.span + 1):
                window = whole[k:k + self.span]
                known = owner.get(window)
                if known is not None and doc > known:
                    self.spans.append([doc, hashes[r], k - zero, k - zero + self.span])
                    last = [-1, 0, 0, 0]
                else:
                    owner[window] = doc
                    self.sent.append((xxhash.xxh64_intdigest(window) % self.buckets, doc, hashes[r], k - zero, window))
            self.windows += z - self.span + 1 - a
            if self.windows >= WINDOWS:
                yield from self.flush()
                owner, last = self.owner, [-1, 0, 0, 0]
        self.size += len(whole)

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.sent.sort(key=lambda x: x[0])
        buckets = np.array([x[0] for x in self.sent], np.int64)
        starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(buckets) else np.zeros(0, int)
        columns: list[list] = [[], [], [], [], []]
        for s, e in zip(starts, np.r_[starts[1:], len(buckets)]):
            part = self.sent[s:e]
            for column, value in zip(columns, (int(buckets[s]), _numbers(x[1] for x in part), _numbers(x[2] for x in part),
                                               _numbers(y for x in part for y in (x[3], len(x[4]))), b"".join(x[4] for x in part))):
                column.append(value)
        if self.spans:
            for column, value in zip(columns, (-1, _numbers(x[0] for x in self.spans), _numbers(x[1] for x in self.spans),
                                               _numbers(y for x in self.spans for y in x[2:]), b"")):
                column.append(value)
        if columns[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.binary()] * 4))],
                names=["bucket", "docs", "hashes", "places", "segments"])
        self.clear()


def _numbers(values) -> bytes:
    return np.fromiter(values, np.int64).tobytes()


def _spans(docs: np.ndarray, hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (docs, hashes, starts, stops)],
                                      names=["doc_id", "hash", "start", "stop"])


def repeated_spans(docs: DataFrame, span: int, bits: int, hot: int) -> DataFrame:
    """Covered stretches, overlapping as found: doc_id, hash (of the text), start, stop."""
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast(repeated_minimizers(docs, span, bits, hot))  # 2**bits bits, and a part of that
    partitions = 2 * shuffle_partitions(spark)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Segments(span, FINE * partitions, *filters.value)
        for b in slices(batches, "text", 1 << 21):
            yield from held.add(b.column("doc_id").to_pylist(), b.column("hash").to_pylist(), b.column("text"))
            if held.size >= 1 << 24:
                yield from held.flush()
        yield from held.flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _groups(batches, "bucket"):
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                *numbers, raw = (b"".join(table.column(c).slice(s, e - s).to_pylist()) for c in ("docs", "hashes", "places", "segments"))
                doc, code, where = (np.frombuffer(x, np.int64) for x in numbers)
                where = where.reshape(-1, 2)
                stop = np.cumsum(where[:, 1])
                texts = [raw[a:z] for a, z in zip((stop - where[:, 1]).tolist(), stop.tolist())]
                number: dict[bytes, int] = {}
                which = np.array([number.setdefault(t, len(number)) for t in texts])
                least = np.full(len(number), np.iinfo(np.int64).max)
                np.minimum.at(least, which, doc)
                matched = earlier_matches(list(number), least, span)
                out = [(doc[k], code[k], where[k, 0], where[k].sum()) for k in np.flatnonzero(doc > least[which])]
                edges = [np.flatnonzero(np.diff(np.r_[0, m > 0, 0])).reshape(-1, 2) for m in matched]
                for k in np.flatnonzero(doc == least[which]):
                    out += [(doc[k], code[k], where[k, 0] + a, where[k, 0] + z + span - 1) for a, z in edges[which[k]]]
                if out:
                    yield _spans(*np.array(out, np.int64).T)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, code, where in zip(*(b.column(c).to_pylist() for c in ("docs", "hashes", "places"))):
                yield _spans(np.frombuffer(doc, np.int64), np.frombuffer(code, np.int64),
                             *np.frombuffer(where, np.int64).reshape(-1, 2).T)

    kind = "doc_id long, hash long, start long, stop long"
    found = staged(docs.mapInArrow(send, "bucket long, docs binary, hashes binary, places binary, segments binary"), "segments")
    far = (found.filter("bucket >= 0").repartitionById(partitions, F.expr(f"int(bucket % {partitions})"))  # as many buckets in each
           .sortWithinPartitions("bucket").mapInArrow(match, kind))
    return far.unionAll(found.filter("bucket < 0").select("docs", "hashes", "places").mapInArrow(local, kind))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = 50, bits: int = 28, hot: int = 1 << 18) -> DataFrame:
    """Remove every byte covered by a ``span``-byte string that also starts in a smaller document.

    Returns one row per input row: doc_id, n_bytes, spans (removed stretches as start and
    stop, apart and in order) and kept (the remaining bytes).  Strings are judged on the
    input and never cross documents; a repeat within one document stays.  Null texts count
    as empty, and texts under ``span`` bytes stay whole.  Rows with the same doc_id are no
    earlier than each other.  A row without doc_id stays whole and removes nothing
    elsewhere.  Other columns are not read.  ``span`` is at least 32; ``bits`` sets the size
    of the filter sent to the tasks (2**bits bits).  Minimizers of about ``hot`` documents
    or more are dealt by window.  Neither changes a result.
    """
    if span < 32:
        raise ValueError("span must be at least 32 bytes")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "hash", F.xxhash64("text"))
    covered = repeated_spans(rows.filter("doc_id IS NOT NULL"), span, bits, hot)
    by_doc = staged(covered.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("start", "stop")).alias("covered")), "covered")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 22):
            raw, offsets = buffers(b.column("text"))
            stretches, kept = [], []
            for covered, a, z in zip(b.column("covered").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                merged: list[list[int]] = []
                for s, e in sorted((x["start"], x["stop"]) for x in covered or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                stretches.append([{"start": s, "stop": e} for s, e in merged])
                edges = [0, *(x for m in merged for x in m), z - a]
                kept.append(b"".join(raw[a + s:a + e].tobytes() for s, e in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(offsets)),
                 pa.array(stretches, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"])

    return rows.join(by_doc, ["doc_id", "hash"], "left").select("doc_id", "text", "covered").mapInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary")
