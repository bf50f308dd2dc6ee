"""SentencePiece encoding and decoding for byte-fallback BPE models, as a streaming Viterbi search.

The search runs over boundaries between characters.  At each boundary a path ends with one piece; it
may be continued by a piece only if the model, merging greedily, would leave those two pieces apart.
Every beginning of a text has exactly one greedy encoding, so one path survives per boundary.  No
piece is longer than the model's longest one, so only boundaries within that distance of the end can
still be continued; whenever the paths to all of them pass one boundary, the ids before it are final
and are handed out, and the window moves on.

Between two characters that stand side by side in no piece every path has a boundary: there the
search starts anew, and what lies between two such places is remembered.  Such parts are searched in
ascending order: the paths to a boundary depend only on the characters before it, so those of the
beginning that a part shares with the one before it stand already.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.blocks import text_slices
from marketflow.llm.shipping import arrow_map

# Fixed values of the model format.
SPACE = "▁"
BYTE = re.compile(r"<0x([0-9A-F]{2})>")

#: Parts up to so many characters are searched in ascending order.
SHORT = 256
#: Bytes of text whose new words are learnt together.
SLICE = 4 << 20


class PieceModel:
    """Pieces and scores of a model; greedy merging of short strings."""

    def __init__(self, pieces: Sequence[str], scores: Sequence[float], special: Sequence[bool]):
        self.text_of: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[int] = [0] * 256
        self.byte_ids: set[int] = set()
        for i, (piece, score, odd) in enumerate(zip(pieces, scores, special)):
            byte = BYTE.fullmatch(piece)
            if byte:
                value = int(byte[1], 16)
                self.bytes[value] = i
                self.byte_ids.add(i)
                self.text_of.append(bytes([value]))
            elif odd:
                self.text_of.append(b"")
            else:
                self.ids[piece], self.scores[piece] = i, score
                self.text_of.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.ids), default=1)
        self.neighbours = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        #: True for pieces, False for what is only the end of one.
        self.tails = {p[k:]: p[k:] in self.ids for p in self.ids for k in range(len(p))}
        #: What :meth:`apart` has found, by left and right piece.
        self.beside: dict[str, dict[str, bool]] = {}
        self._n_beside = 0

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        return cls(
            [sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n],
            [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in n],
        )

    def merge(self, text: str) -> list[str]:
        """Greedy merging: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        scores = self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = scores.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: str, right: str) -> bool:
        """Whether merging leaves these two pieces side by side (``left`` empty: leaves ``right`` whole)."""
        known = self.beside.get(left, {}).get(right)
        if known is None:
            if self._n_beside > 200_000:
                self.beside.clear()
                self._n_beside = 0
            known = self.merge(left + right) == ([left, right] if left else [right])
            self.beside.setdefault(left, {})[right] = known
            self._n_beside += 1
        return known

    def ids_of(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [self.bytes[b] for b in piece.encode("utf-8", "replace")] if i is None else [i]


class StreamingViterbi:
    """Encodes a stream of characters in bounded memory; ``feed`` and ``finish`` return final ids."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.text = ""  # from the last committed boundary on
        self.before = ""  # the piece that ends there
        self.last = [""]  # the piece that ends at each boundary
        self.widest = 0

    def feed(self, text: str) -> list[int]:
        model, out = self.model, []
        for a in range(0, len(text), 64):
            self._advance(text[a : a + 64])
            self.widest = max(self.widest, len(self.text))
            if len(self.text) > 2 * model.longest:
                out += self._commit(self._meeting())
        return out

    def finish(self) -> list[int]:
        out = self._commit(len(self.text))
        self.before = ""
        return out

    def _advance(self, text: str) -> None:
        self.text += text
        model, whole, last = self.model, self.text, self.last
        kind_of, beside, longest = model.tails.get, model.beside, model.longest
        for end in range(len(last), len(whole) + 1):
            found = None
            for begin in range(end - 1, max(-1, end - longest - 1), -1):
                piece = whole[begin:end]
                kind = kind_of(piece)
                if kind or end - begin == 1:
                    left = last[begin] if begin else self.before
                    if left is not None:
                        known = beside[left].get(piece) if left in beside else None
                        if model.apart(left, piece) if known is None else known:
                            found = piece
                            break
                if kind is None:
                    break
            last.append(found)

    def _path(self, boundary: int) -> list[str]:
        """The pieces up to a boundary, the last one first."""
        parts = []
        while boundary > 0:
            parts.append(self.last[boundary])
            boundary -= len(parts[-1])
        return parts

    def restart(self, text: str) -> list[int]:
        """All ids of another text; boundaries that it shares with the text before stand already.

        For short texts: nothing is committed, so the window is the whole text.
        """
        shared = len(commonprefix((self.text, text)))
        self.text = text[:shared]
        del self.last[shared + 1 :]
        self._advance(text[shared:])
        return [i for p in reversed(self._path(len(text))) for i in self.model.ids_of(p)]

    def _meeting(self) -> int:
        """The last boundary on the paths to all boundaries that can still be continued."""
        ends = {e for e in range(max(0, len(self.text) - self.model.longest + 1), len(self.text) + 1)}
        while len(ends) > 1:
            far = max(ends)
            ends.discard(far)
            if self.last[far] is not None:
                ends.add(far - len(self.last[far]))
        return ends.pop()

    def _commit(self, boundary: int) -> list[int]:
        parts = self._path(boundary)
        out = [i for p in reversed(parts) for i in self.model.ids_of(p)]
        if parts:
            self.before = parts[0]
        self.text, self.last = self.text[boundary:], [""] + self.last[boundary + 1 :]
        return out


class PieceEncoder:
    """Ids of whole texts; remembers a bounded number of words and of the parts they are made of."""

    def __init__(self, model: PieceModel, most: int = 400_000):
        self.model, self.most = model, most
        #: Ids are remembered in as few bytes as the model needs.
        self.code = "H" if len(model.text_of) <= 1 << 16 else "I"
        self.kind = np.dtype(np.uint16 if self.code == "H" else np.uint32)
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _learn(self, parts: set[str]) -> None:
        """Remember the ids of parts, searched in ascending order."""
        new = parts.difference(self.parts)
        if len(self.parts) + len(new) > self.most:
            self.parts = {p: self.parts[p] for p in parts.difference(new)}
        shared = StreamingViterbi(self.model)
        for part in sorted(new):
            if len(part) <= SHORT:
                ids = shared.restart(part)
            else:
                search = StreamingViterbi(self.model)
                ids = search.feed(part) + search.finish()
            self.parts[part] = array(self.code, ids).tobytes()

    def _cut(self, word: str) -> list[str]:
        """The parts of a word: cut where no piece can reach across."""
        neighbours = self.model.neighbours
        cuts = [k for k in range(1, len(word)) if word[k - 1 : k + 1] not in neighbours]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts, as the bytes of numbers of ``kind``."""
        mark = SPACE.encode()
        texts = [t.replace(mark, b" ") if mark in t else t for t in texts]
        plain = [not (t[:1] == b" " or t[-1:] == b" " or b"  " in t) for t in texts]
        split = [
            t.split(b" ") if ok else [w[1:] for w in re.findall(rb" +[^ ]*", b" " + t)]
            for t, ok in zip(texts, plain)
        ]
        split = [ws if t else [] for ws, t in zip(split, texts)]
        found = set().union(*split) if split else set()
        if len(self.known) + len(found) > self.most:
            self.known = {w: self.known[w] for w in found & self.known.keys()}
        new = list(found.difference(self.known))
        cut = [self._cut((b" " + w).decode("utf-8", "replace").replace(" ", SPACE)) for w in new]
        self._learn(set().union(*cut))
        part = self.parts.__getitem__
        self.known.update((w, b"".join(map(part, ps))) for w, ps in zip(new, cut))
        get = self.known.__getitem__
        return [b"".join(map(get, ws)) for ws in split]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One for each Python worker, kept between tasks."""
    return PieceEncoder(PieceModel.load(path))


def decode(model: PieceModel, ids: Sequence[int]) -> str:
    """The text of ids, without the space that encoding puts in front; broken bytes become U+FFFD."""
    text = model.text_of
    out = b"".join([text[i] for i in ids]).decode("utf-8", "replace")
    return out[1:] if out[:1] == " " else out


def encode_texts(docs: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``n_tokens`` and ``ids``, one row per row of ``docs``.

    Null and empty texts have no ids.  Other columns are ignored; there is no shuffle.
    """
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    names = [*keep, "n_tokens", "ids"]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(model_path)
        for batch in batches:
            for a, b, data, at in text_slices(batch.column(len(keep)), SLICE):
                raw = data.tobytes()
                lists = coder.encode([raw[at[i] : at[i + 1]] for i in range(b - a)])
                sizes = np.array([len(x) // coder.kind.itemsize for x in lists], np.int64)
                flat = np.frombuffer(b"".join(lists), coder.kind).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(sizes), ids], names)

    return arrow_map(chosen, encode, f"{kinds}, n_tokens long, ids array<int>")


def decode_ids(encoded: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``text``, decoded from ``ids`` (null: null)."""
    chosen = encoded.select(*[F.col(f"`{c}`") for c in keep], "ids")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_encoder(model_path).model
        for batch in batches:
            column = batch.column(len(keep))
            ends, flat = column.offsets.to_numpy(), column.values.to_pylist()
            real = column.is_valid().to_pylist()
            texts = [decode(model, flat[a:b]) if ok else None for a, b, ok in zip(ends[:-1], ends[1:], real)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"]
            )

    return arrow_map(chosen, back, f"{kinds}, text string")


def with_decoded_digest(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with ``decoded_sha256``: the digest (hex) of the text that its ids decode to."""
    names = encoded.columns
    place = names.index("ids")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_encoder(model_path).model
        for batch in batches:
            column = batch.column(place)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            sums = [
                hashlib.sha256(decode(model, flat[a:b].tolist()).encode()).hexdigest()
                for a, b in zip(ends[:-1], ends[1:])
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums)], [*names, "decoded_sha256"])

    return arrow_map(encoded, digest, f"{kinds}, decoded_sha256 string")
