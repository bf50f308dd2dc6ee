"""Windowed counts of words that state keeps together, many words to a row.

A state store works by the row: it looks up, writes, scans and deletes one row per window and word.
Here each task counts its words first and packs them, one binary per window and part of the words, so
that a row of state holds what would be hundreds.  Counts of several tasks stand side by side in it
and are added up when the window is read, exactly.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that a task counts at once, and their bytes; a text is not divided.
WORDS, BYTES = 1 << 21, 1 << 26
#: n, the widths of a length and of a count, and the bytes of what follows compressed: the lengths, the counts
#: and the words, one after another.
HEAD = "<IBBQ"


def pack_words(lines: DataFrame, width: str, slide: str, parts: int, ts: str = "timestamp") -> DataFrame:
    """(ts, part, packed): the ``words`` (arrays) of each task, counted per stretch of time that lies in the same windows.

    ``ts`` is the newest time of the packed words, so windows and watermark come out as from the words.
    """
    fields = [lines.schema[ts], T.StructField("part", T.IntegerType()), T.StructField("packed", T.BinaryType())]
    timed = lines.filter(F.col(ts).isNotNull()).select(ts, "words")
    return timed.mapInArrow(_packer(ts, *_micros(lines.sparkSession, width, slide), parts), T.StructType(fields))


def unpack_words(packed: str) -> Column:
    """Array of (word, n) from an array of packed words; each word once."""
    return F.arrow_udf(_unpacker(), "array<struct<word: string, n: bigint>>")(packed)


def _micros(spark: SparkSession, *lengths: str) -> list[int]:
    """The lengths of intervals; a day has 24 hours, as in windows."""
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    ends = [(zero + F.lit(x).cast("interval")).cast("string") for x in lengths]
    since = [F.unix_micros(F.to_timestamp(F.concat(e, F.lit("Z")))) for e in ends]
    return list(spark.range(1).select(*since).first())


def _packer(
    ts: str, width: int, slide: int, parts: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    most, heavy, head = WORDS, BYTES, HEAD

    def narrow(values: np.ndarray, spare: int = 0) -> np.ndarray:
        top = int(values.max()) + spare
        return values.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if top < 256**w))

    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, lists = (c.combine_chunks() for c in pa.Table.from_batches(held).columns)
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        at, size = times.cast(pa.int64()).to_numpy()[size > 0], size[size > 0]
        if not len(size):
            return
        # All times from one start or end of a window to the next lie in the same windows.
        begins, begin = np.unique(np.maximum(at // slide * slide, (at - width) // slide * slide + width), return_inverse=True)
        newest = np.full(len(begins), at.min())
        np.maximum.at(newest, begin, at)
        words = lists.flatten().dictionary_encode(null_encoding="encode")
        known = len(words.dictionary)
        found = pc.value_counts(pa.array(np.repeat(begin.astype(np.int64) * known, size) + words.indices.to_numpy()))
        key, n = found.field("values").to_numpy(), found.field("counts").to_numpy()
        # A hash that is the same in every task.
        part = np.fromiter((zlib.crc32(w or b"") % parts for w in words.dictionary.cast(pa.binary()).to_pylist()), np.int64, known)
        group = key // known * parts + part[key % known]
        order = np.argsort(group, kind="stable")
        key, n, group = key[order], n[order], group[order]
        texts = words.dictionary.take(pa.array(key % known)).cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        length, n = narrow(np.diff(ends), 1), narrow(n)
        if texts.null_count:
            length[texts.is_null().to_numpy(zero_copy_only=False)] = np.iinfo(length.dtype).max
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        text, codec, packed = memoryview(texts.buffers()[2] or b""), pa.Codec("zstd", 1), []
        for a, b in zip(cuts, cuts[1:]):
            body = b"".join((length[a:b].tobytes(), n[a:b].tobytes(), text[ends[a] : ends[b]]))
            packed.append(struct.pack(head, b - a, length.itemsize, n.itemsize, len(body)) + codec.compress(body, asbytes=True))
        first = group[cuts[:-1]]
        columns = [pa.array(newest[first // parts]).cast(times.type), pa.array(first % parts, pa.int32()), pa.array(packed, pa.binary())]
        out = pa.RecordBatch.from_arrays(columns, [ts, "part", "packed"])
        for a in range(0, len(packed), 4096):
            yield out.slice(a, 4096)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, used = [], 0, 0
        for batch in batches:
            ends, a = batch.column(1).offsets.to_numpy(), 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + most - n, "right")) - 1)
                held.append(batch.slice(a, b - a))
                n, used = n + int(ends[b] - ends[a]), used + held[-1].nbytes
                if b < batch.num_rows or n >= most or used >= heavy:
                    yield from counted(held)
                    held, n, used = [], 0, 0
                a = b
        if held:
            yield from counted(held)

    return pack


def _unpacker() -> Callable[[pa.Array], pa.Array]:
    most, head = WORDS // 8, HEAD
    entry = pa.struct([("word", pa.string()), ("n", pa.int64())])

    def added(first: int, rows: list[tuple[int, bytes]]) -> tuple[np.ndarray, pa.Array]:
        """Words per row from the ``first`` on, and the words with their sums, row after row."""
        row, lengths, counts, texts, codec = [], [], [], [], pa.Codec("zstd")
        for i, blob in rows:
            n, wide, deep, size = struct.unpack_from(head, blob)
            body = codec.decompress(memoryview(blob)[struct.calcsize(head) :], size)
            length = np.frombuffer(body, f"<u{wide}", n)
            missing = length == np.iinfo(length.dtype).max
            row.append(np.full(n, i - first))
            lengths.append(np.where(missing, -1, length.astype(np.int64)))
            counts.append(np.frombuffer(body, f"<u{deep}", n, n * wide).astype(np.int64))
            texts.append(memoryview(body)[n * (wide + deep) :])
        row, length, n = np.concatenate(row), np.concatenate(lengths), np.concatenate(counts)
        ends = np.concatenate([[0], np.cumsum(np.maximum(length, 0))])
        there = pa.py_buffer(np.packbits(length >= 0, bitorder="little"))
        words = pa.Array.from_buffers(pa.large_string(), len(row), [there, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))])
        words = words.dictionary_encode(null_encoding="encode")
        known = len(words.dictionary)
        key = pa.array(row * known + words.indices.to_numpy())
        sums = pa.table([key, pa.array(n)], ["key", "n"]).group_by("key").aggregate([("n", "sum")])
        key = sums["key"].to_numpy()
        order = np.argsort(key // known, kind="stable")
        key, n = key[order], sums["n_sum"].to_numpy()[order]
        texts = words.dictionary.take(pa.array(key % known)).cast(pa.string())
        return key // known + first, pa.StructArray.from_arrays([texts, pa.array(n)], fields=list(entry))

    def unpack(packed: pa.Array) -> pa.Array:
        sizes, out, rows, held, first = np.zeros(len(packed), np.int64), [], [], 0, 0

        def flush() -> None:
            if rows:
                row, entries = added(first, rows)
                np.add.at(sizes, row, 1)
                out.append(entries)
                rows.clear()

        for i, blobs in enumerate(packed):
            if held >= most:
                flush()
                held, first = 0, i
            for blob in blobs.as_py() or ():
                rows.append((i, blob))
                held += struct.unpack_from(head, blob)[0]
        flush()
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.concat_arrays(out) if out else pa.array([], entry))

    return unpack
