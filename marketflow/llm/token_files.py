"""Token ids of documents in files of independent zstandard frames with a seek table.

A file holds the ids of consecutive documents.  Its id stream is cut into frames of ``frame_ids``
ids; each is a zstandard frame of its own with a content checksum.  Behind them stand two
skippable frames, which plain zstandard readers pass over: the documents (their ids and where their
token ids begin) and the seek table, a list of (compressed size, plain size, low 32 bits of the
plain bytes' XXH64) with a fixed-size footer.  A reader fetches the footer, the table and only the
frames that hold a wanted document.

Files are written next to each other in the shared folder by the tasks; a table of files, written
by Spark's own committer, names those of successful attempts, so files left by lost or repeated
attempts are never read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.blocks import IS_SEPARATOR, text_slices
from marketflow.llm.shipping import arrow_map
from marketflow.session import scratch_path, stored

# Fixed values of the zstandard seekable format.
SKIPPABLE_TABLE = 0x184D2A5E
SEEKABLE_END = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
FOOTER = struct.Struct("<IBI")

# The frame of documents, in a skippable frame of another number.
SKIPPABLE_DOCS = 0x184D2A50
SKIP_HEAD = struct.Struct("<II")
DOCS_HEAD = struct.Struct("<4sBBIQ")
DOCS_MAGIC = b"MFTK"

MANIFEST = "path string, first_doc long, n_docs long, n_ids long, n_bytes long"


class TokenFileWriter:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, sink, id_bytes: int = 4, frame_ids: int = 1 << 16, level: int = 3):
        self.sink, self.kind, self.frame_ids = sink, np.dtype(f"<u{id_bytes}"), frame_ids
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.pending: list[bytes] = []
        self.pending_bytes = self.n_ids = self.n_bytes = 0
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.starts = [0]

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian integers of the file's width."""
        self.docs.append(doc_id)
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        self.n_ids += len(ids) // self.kind.itemsize
        self.starts.append(self.n_ids)
        if self.pending_bytes >= self.frame_ids * self.kind.itemsize:
            self._flush(False)

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.n_bytes += len(data)

    def _flush(self, rest: bool) -> None:
        size = self.frame_ids * self.kind.itemsize
        plain = b"".join(self.pending)
        cut = len(plain) if rest else len(plain) // size * size
        for at in range(0, cut, size):
            frame = plain[at : at + size]
            packed = self.packer.compress(frame)
            self.entries.append((len(packed), len(frame), xxhash.xxh64_intdigest(frame) & 0xFFFFFFFF))
            self._write(packed)
        self.pending = [plain[cut:]]
        self.pending_bytes = len(plain) - cut

    def close(self) -> None:
        self._flush(True)
        ids = np.array([0 if d is None else d for d in self.docs], "<i8")
        null = np.array([d is None for d in self.docs], "u1")
        plain = ids.tobytes() + null.tobytes() + np.array(self.starts, "<u8").tobytes()
        head = DOCS_HEAD.pack(DOCS_MAGIC, 1, self.kind.itemsize, self.frame_ids, len(self.docs))
        body = head + self.packer.compress(plain)
        self._write(SKIP_HEAD.pack(SKIPPABLE_DOCS, len(body)) + body)
        table = np.array(self.entries, ENTRY).tobytes()
        foot = FOOTER.pack(len(self.entries), CHECKSUM_FLAG, SEEKABLE_END)
        self._write(SKIP_HEAD.pack(SKIPPABLE_TABLE, len(table) + len(foot)) + table + foot)


class TokenFileReader:
    """Random access to one file; ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, os.SEEK_END)
        size = source.tell()
        count, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_END or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - FOOTER.size - count * ENTRY.itemsize
        self.entries = np.frombuffer(self._at(table, count * ENTRY.itemsize), ENTRY)
        self.begins = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        at = int(self.begins[-1])
        magic, length = SKIP_HEAD.unpack(self._at(at, SKIP_HEAD.size))
        body = self._at(at + SKIP_HEAD.size, length)
        tag, _, width, self.frame_ids, n = DOCS_HEAD.unpack(body[: DOCS_HEAD.size])
        if magic != SKIPPABLE_DOCS or tag != DOCS_MAGIC:
            raise ValueError("no list of documents before the seek table")
        self.kind, self.unpacker = np.dtype(f"<u{width}"), zstandard.ZstdDecompressor()
        plain = self.unpacker.decompress(body[DOCS_HEAD.size :], max_output_size=17 * n + 8)
        null = np.frombuffer(plain, "u1", n, 8 * n)
        ids = np.frombuffer(plain, "<i8", n)
        self.docs = [None if z else int(d) for d, z in zip(ids, null)]
        self.starts = np.frombuffer(plain, "<u8", n + 1, 9 * n).astype(np.int64)
        self._last: tuple[int, bytes] = (-1, b"")
        self.frames_read = 0

    def _at(self, where: int, size: int) -> bytes:
        self.source.seek(where)
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            e = self.entries[k]
            plain = self.unpacker.decompress(self._at(int(self.begins[k]), int(e["packed"])))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != e["check"]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last, self.frames_read = (k, plain), self.frames_read + 1
        return self._last[1]

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the file."""
        a, b, width = int(self.starts[i]), int(self.starts[i + 1]), self.kind.itemsize
        if a == b:
            return np.zeros(0, self.kind)
        first, last = a // self.frame_ids, (b - 1) // self.frame_ids
        plain = b"".join(self.frame(k) for k in range(first, last + 1))
        begin = (a - first * self.frame_ids) * width
        return np.frombuffer(plain[begin : begin + (b - a) * width], self.kind)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Kinds of bytes: white space, ASCII letter, digit, apostrophe, other ASCII mark, part of a longer character.
SPACE, LETTER, DIGIT, APOSTROPHE, MARK, HIGH = range(6)
KINDS = np.full(256, MARK, np.uint8)
KINDS[128:] = HIGH
KINDS[list(range(65, 91)) + list(range(97, 123))] = LETTER
KINDS[48:58] = DIGIT
KINDS[39] = APOSTROPHE
KINDS[IS_SEPARATOR] = SPACE

#: Whether a piece may end between two kinds of bytes.  An apostrophe may belong to the letter behind it
#: ('s), and a longer character may be a letter, a mark or an accent of the character before it.
PARTS = np.zeros((6, 6), bool)
PARTS[LETTER, [DIGIT, APOSTROPHE, MARK]] = True
PARTS[DIGIT, [LETTER, DIGIT, APOSTROPHE, MARK]] = True
PARTS[MARK, [LETTER, DIGIT]] = True
PARTS[SPACE, 1:] = True

#: The first bytes of characters from U+0300 on; only there a character can be an accent.
FIRST_ACCENT = 0xCC


class WordEncoder:
    """Ids of texts, through a bounded memory of the ids of pieces of words.

    It holds for tokenizers whose pre-tokenizer drops white space and never joins across it, as the
    word-end BPE file does: then the ids of a text are those of its words, one after the other.  That
    file also sets ASCII letters, single digits and runs of marks apart and reads capitals as small
    letters, so words are cut there and looked up without capitals; ``lower_case=False`` is for files
    that do not.
    """

    def __init__(self, path: str, id_bytes: int, most: int = 250_000, lower_case: bool = True):
        self.tokenizer, self.code, self.most = _tokenizer(path), {2: "H", 4: "I"}[id_bytes], most
        self.lower_case = lower_case
        self.width = id_bytes
        vocabulary = self.tokenizer.get_vocab(True)
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # pieces met lately, and those met before the last time that the first were too many
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """All pieces of the texts, and the index of each text's first piece (and the end)."""
        kinds = KINDS[data]
        word = kinds != SPACE
        begins = word.copy()
        if self.lower_case:
            begins[1:] = PARTS.ravel()[kinds[:-1] * np.uint8(6) + kinds[1:]]
            capital = (data >= 65) & (data <= 90)
            capital[:-1] &= data[1:] < FIRST_ACCENT
            small = data.tobytes().lower()
            for name in self.special:  # written as it stands, and in one piece
                at = small.find(name)
                while at >= 0:
                    begins[at + 1 : at + len(name)] = False
                    capital[at : at + len(name)] = False
                    at = small.find(name, at + 1)
            data = data | (capital.view(np.uint8) << 5)
        else:
            begins[1:] &= ~word[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[firsts] = word[firsts]
        first_piece = np.searchsorted(np.flatnonzero(begins), offsets)
        letters = data[word]
        cuts = np.append(np.flatnonzero(begins[word]), len(letters)).astype(np.int32)
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(letters)]
        return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, buffers), first_piece

    def _joined(self, letters: list[bytes]) -> list[bytes]:
        """Ids of words of letters alone, encoded as texts of 100: each ends with its one word-end token."""
        if not letters:
            return []
        out: list[bytes] = []
        rows = [letters[k : k + 100] for k in range(0, len(letters), 100)]
        coded = self.tokenizer.encode_batch_fast([b" ".join(r).decode() for r in rows], add_special_tokens=False)
        for row, e in zip(rows, coded):
            ids = np.array(e.ids, np.int64)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(row):  # not a word-end vocabulary
                alone = self.tokenizer.encode_batch_fast([w.decode() for w in row], add_special_tokens=False)
                out += [array(self.code, x.ids).tobytes() for x in alone]
                continue
            raw = ids.astype(f"<u{self.width}").tobytes()
            cuts = [0, *(ends * self.width).tolist()]
            out += [raw[i:j] for i, j in zip(cuts, cuts[1:])]
        return out

    def _learn(self, new: list[bytes]) -> None:
        letters, others = [], []
        for w in new:
            (letters if self.lower_case and w.decode().isalpha() else others).append(w)
        self.recent.update(zip(letters, self._joined(letters)))
        coded = self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)
        self.recent.update((w, array(self.code, e.ids).tobytes()) for w, e in zip(others, coded))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Little-endian ids of each text; the texts are ``data`` between ``offsets``."""
        pieces, first_piece = self._pieces(data, offsets)
        distinct = pieces.dictionary_encode()
        found = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        lost = [w for w in found if w not in self.recent]
        if len(self.recent) + len(lost) > self.most:
            self.older, self.recent, lost = self.recent, {}, found
        older = self.older
        self.recent.update((w, older[w]) for w in lost if w in older)
        self._learn([w for w in lost if w not in older])
        ids = pa.array(list(map(self.recent.__getitem__, found)), pa.large_binary()).take(distinct.indices)
        _, ends, raw = ids.buffers()
        cuts = np.frombuffer(ends, np.int64)[first_piece].tolist()
        raw = memoryview(raw or b"")
        return [bytes(raw[i:j]) for i, j in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def word_encoder(path: str, id_bytes: int) -> WordEncoder:
    """One for each Python worker, kept between tasks."""
    return WordEncoder(path, id_bytes)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    frame_ids: int = 1 << 16,
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the ids in ascending doc_id order; returns the table of files.

    Every document is closed by ``end_id``.  A null text is empty; an empty table gives no file.
    Rows of the same doc_id stand next to each other, in the order of their texts; a null doc_id
    comes first.  Other columns are ignored.  Texts are shuffled once, by ranges of doc_id.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    _, base = pafs.FileSystem.from_uri(folder)
    vocabulary = max(_tokenizer(tokenizer_path).get_vocab_size(True), end_id + 1)
    id_bytes = 2 if vocabulary <= 1 << 16 else 4

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(tokenizer_path, id_bytes)
        end = np.array([end_id], f"<u{id_bytes}").tobytes()
        store, _ = pafs.FileSystem.from_uri(folder)
        sink = out = None
        name = f"{base}/ids-{uuid.uuid4().hex}.zst"
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, data, at in text_slices(batch.column(1), 2 << 20):
                coded = coder.encode(data, at)
                if out is None:
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(name, compression=None)
                    out = TokenFileWriter(sink, id_bytes, frame_ids)
                for doc_id, text_ids in zip(ids[a:b], coded):
                    out.add(doc_id, text_ids + end)
        if out is not None:
            out.close()
            sink.close()
            row = [[name], [out.docs[0]], [len(out.docs)], [out.n_ids], [out.n_bytes]]
            kinds = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, kinds)], ["path", "first_doc", "n_docs", "n_ids", "n_bytes"]
            )

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(arrow_map(ordered, write, MANIFEST), "token-manifest").withColumn("folder", F.lit(folder))


def read_token_files(manifest: DataFrame, wanted: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) of all documents, or of the ``wanted`` doc_ids, of whose files only the
    frames that hold them are decompressed.

    ``start`` counts the ids of all documents before.  One row per file is ordered in one task;
    nothing else is.
    """
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("begin", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    chosen = None if wanted is None else frozenset(wanted)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, folder in zip(*(c.to_pylist() for c in batch.columns)):
                store, _ = pafs.FileSystem.from_uri(folder)
                with store.open_input_file(path) as source:
                    file = TokenFileReader(source)
                    places = [i for i, d in enumerate(file.docs) if chosen is None or d in chosen]
                    for some in range(0, len(places), 512):
                        part = places[some : some + 512]
                        lists = [file.ids(i).astype("<u4") for i in part]
                        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                        flat = np.concatenate(lists).view("<i4") if lists else np.zeros(0, "<i4")
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([file.docs[i] for i in part], pa.int64()),
                                pa.array(file.starts[part] + begin, pa.int64()),
                                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())),
                            ],
                            ["doc_id", "start", "ids"],
                        )

    spread = files.select("path", "begin", "folder").repartition(max(1, manifest.count()), "path")
    return arrow_map(spread, read, "doc_id long, start long, ids array<int>")


def crc32_of_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what :func:`read_token_files` returns."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return arrow_map(ids, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
