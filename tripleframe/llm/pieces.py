"""SentencePiece encoding and decoding that keeps the place of every piece in the original text.

The model file is read once in a worker: its normaliser settings with the compiled character map, and its pieces. A text is
normalised by the longest prefix the map holds at each place, while every normalised character remembers the original bytes
it came from. The normalised text is cut into runs of word marks with the letters or the other characters behind them; no
piece crosses such a border (checked when the model is loaded), so byte-pair merges run word by word and a bounded memo
serves repeated words.
Pieces are projected through the recorded alignment to byte spans of the original text.

Null and empty texts have no pieces. Repeated rows and ties are encoded alike; other columns are carried, but give way to a
result of their name. An empty table gives an empty result.
"""

from __future__ import annotations

import contextlib
import heapq
import itertools
import math
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripleframe.llm.common import held, map_text

MARK = "▁"
#: Words of which a worker remembers the pieces. A full memo is kept for look-ups while a new one fills, so common words stay.
MEMO_WORDS = 250_000

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


#: Ways to cut a normalised text, finest first. A model uses the first that cuts through none of its pieces.
BORDERS = [re.compile(p, re.S) for p in (f"{MARK}*[A-Za-zÀ-ɏ]+|{MARK}*[^{MARK}A-Za-zÀ-ɏ]+|{MARK}+", f"{MARK}*[^{MARK}]+|{MARK}+", ".+")]


class CharacterMap:
    """Longest-prefix replacement by the compiled map: a double array over bytes, and zero-terminated replacements."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length in bytes of the longest key that starts at ``at``, and its replacement."""
        found, units = None, self.units
        node, unit = 0, units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = end + 1 - at, self.strings[start : self.strings.index(b"\0", start)].decode()
        return found


class PieceModel:
    """A byte-pair model: ``normalise``, ``encode``, ``spans`` and ``decode``."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self._load(file.read())

    def _load(self, data: bytes) -> None:
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        norm: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                norm = dict(_fields(value))
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("only byte-pair models with marks before words, and without user-defined or unused pieces, are read")
        self.map = CharacterMap(norm[2]) if norm.get(2) else None
        self.dummy = bool(norm.get(3, 1))
        self.squeeze = bool(norm.get(4, 1))
        if not norm.get(5, 1):
            raise ValueError("the model does not mark spaces")
        self.unknown = self.kinds.index(UNKNOWN)
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.surfaces = {i: p.replace(MARK, " ") for p, i in self.ids.items()}
        self.scores = {p: scores[i] for p, i in self.ids.items()}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i, kind in enumerate(self.kinds) if kind == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.words = next(b for b in BORDERS if all(b.fullmatch(p) and b.match(p).end() == len(p) for p in self.ids))
        self.memo: dict[str, tuple[bytes, str, bytes]] = {}
        self.older: dict[str, tuple[bytes, str, bytes]] = {}

    def aligned(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text with marks for spaces, and for each of its characters the original byte where its source starts.

        The array has one item more: the end of the source of the last character. Where the model has no map, the longest
        prefix at every place is the character itself, and all places are found at once.
        """
        data = text.encode()
        if self.map is None:
            chars: str | list[str] = text
            starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).astype(np.int32)
        else:
            chars, starts = self._mapped(data)
        end = len(data)
        if self.squeeze:
            kept = [i for i, c in enumerate(chars) if c != " " or (i and chars[i - 1] != " ")]
            while kept and chars[kept[-1]] == " ":
                end = int(starts[kept.pop()])
            chars, starts = [chars[i] for i in kept], starts[kept]
        normal = "".join(chars).replace(" ", MARK)
        if self.dummy and normal:
            normal, starts = MARK + normal, np.concatenate([starts[:1], starts])
        return normal, np.append(starts, np.int32(end))

    def _mapped(self, data: bytes) -> tuple[list[str], np.ndarray]:
        """Characters by the longest prefix the map holds at each place, and where their sources start."""
        chars: list[str] = []
        starts: list[int] = []
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit:
                size, out = hit
            else:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                out = data[at : at + size].decode()
            chars.extend(out)
            starts.extend([at] * len(out))
            at += size
        return chars, np.array(starts, dtype=np.int32)

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """``aligned`` with a plain list."""
        normal, starts = self.aligned(text)
        return normal, starts.tolist()

    def marked(self, text: str) -> str:
        """The normalised text alone."""
        return self.aligned(text)[0]

    def _merge_short(self, parts: list[str]) -> list[str]:
        """Merge the best adjacent pair, the leftmost of equals, until none is a piece."""
        score = self.scores.get
        links = [score(a + b, -math.inf) for a, b in itertools.pairwise(parts)]
        while links:
            best = max(links)
            if best == -math.inf:
                break
            i = links.index(best)
            parts[i] += parts.pop(i + 1)
            del links[i]
            if i:
                links[i - 1] = score(parts[i - 1] + parts[i], -math.inf)
            if i < len(links):
                links[i] = score(parts[i] + parts[i + 1], -math.inf)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same merges in n log n steps, by a heap over linked parts."""
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (score := self.scores.get(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (-score, left, right, parts[left] + parts[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, merged = heapq.heappop(heap)
            if not parts[left] or not parts[right] or parts[left] + parts[right] != merged or after[left] != right:
                continue
            parts[left], parts[right] = merged, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def split(self, word: str) -> list[str]:
        """Pieces of a normalised word, in order; characters without a piece stay alone."""
        parts = list(word)
        return self._merge_short(parts) if len(parts) <= 40 else self._merge_long(parts)

    def _piece_ids(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        if known is not None:
            return [known]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def _learn(self, word: str) -> tuple[bytes, str, bytes]:
        """Ids of a word, the text they decode to, and the first and the end character of each id; numbers as 32-bit integers."""
        if (entry := self.older.get(word)) is not None:
            self.memo[word] = entry
            return entry
        ids: list[int] = []
        places: list[int] = []
        at = 0
        for piece in self.split(word):
            end = at + len(piece)
            for i in self._piece_ids(piece):
                ids.append(i)
                places += (at, end)
            at = end
        entry = array("i", ids).tobytes(), self._surface(ids), array("i", places).tobytes()
        if len(self.memo) >= MEMO_WORDS:
            self.older, self.memo = self.memo, {}
        if len(word) <= 64:
            self.memo[word] = entry
        return entry

    def coded(self, text: str) -> tuple[np.ndarray, str, np.ndarray]:
        """The ids, the text that ``decode`` makes of them, and the first and the end byte of each id in the original text.

        Words decode alone, as no byte run crosses their border.
        """
        normal, starts = self.aligned(text)
        known, learn = self.memo.get, self._learn
        words = self.words.findall(normal)
        entries = [known(w) or learn(w) for w in words]
        ids = np.frombuffer(b"".join([e[0] for e in entries]), np.int32)
        before = np.cumsum([0, *map(len, words)])[:-1]
        counts = np.fromiter((len(e[0]) for e in entries), np.int64, len(entries)) // 4
        places = np.frombuffer(b"".join([e[2] for e in entries]), np.int32).reshape(-1, 2) + np.repeat(before, counts)[:, None]
        surface = "".join([e[1] for e in entries])
        return ids, surface[1:] if self.dummy and surface[:1] == " " else surface, starts[places]

    def encode(self, text: str) -> list[int]:
        """Ids of all pieces, without begin and end."""
        return self.coded(text)[0].tolist()

    def both(self, text: str) -> tuple[list[int], str]:
        """The ids, and the text that ``decode`` makes of them."""
        ids, surface, _ = self.coded(text)
        return ids.tolist(), surface

    def spans(self, text: str) -> list[tuple[int, str, int, int]]:
        """Id, piece, first byte and end byte in the original text, for every id.

        The pieces of a character that is spelled as bytes each have the span of that character.
        """
        normal, starts = self.normalise(text)
        out, at = [], 0
        for word in self.words.findall(normal):
            for piece in self.split(word):
                end = at + len(piece)
                out.extend((i, self.pieces[i], starts[at], starts[end]) for i in self._piece_ids(piece))
                at = end
        return out

    def _surface(self, ids: tuple[int, ...] | list[int]) -> str:
        with contextlib.suppress(KeyError):
            return "".join([self.surfaces[i] for i in ids])
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            if self.kinds[i] == NORMAL:
                out.append(self.surfaces[i])
            elif i == self.unknown:
                out.append(" ⁇ ")
        if held:
            out.append(held.decode(errors="replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of a list of ids; the mark the encoder put in front is taken off again."""
        text = self._surface(ids)
        return text[1:] if self.dummy and text[:1] == " " else text


def encode_documents(df: DataFrame, model: str, text: str = "text", decoded: bool = True, spans: bool = False, bounds: bool = False) -> DataFrame:
    """Replace the text by ``ids``, and if asked for by ``decoded``, ``spans`` (id, piece, start, end) and ``bounds``.

    Starts and ends count bytes of the original text. ``bounds`` gives the columns ``starts`` and ``ends``: the spans without
    ids and pieces. ``model`` is the path of a model file that exists on every machine (part of an installed package, or
    shipped with ``addFile``); it is opened once in a Python worker, whose tasks share the memo.
    """
    parts = ["ids array<int>"] + ["decoded string"] * decoded + ["spans array<struct<id:int,piece:string,start:int,end:int>>"] * spans
    parts += ["starts array<int>", "ends array<int>"] * bounds

    def make():
        # Words learnt in a task are known to the next one of the worker.
        coder = held(("pieces", model, MEMO_WORDS), lambda: PieceModel(model))
        names = pa.array(coder.pieces, pa.string())

        def work(texts: list[str]) -> dict[str, pa.Array]:
            found = [coder.coded(t) for t in texts]
            limits = pa.array(np.cumsum([0, *[len(ids) for ids, _, _ in found]]), pa.int32())
            flat = pa.array(np.concatenate([ids for ids, _, _ in found]) if found else np.empty(0, np.int32))
            new = {"ids": pa.ListArray.from_arrays(limits, flat)}
            if decoded:
                new["decoded"] = pa.array([d for _, d, _ in found], pa.string())
            if spans or bounds:
                places = np.concatenate([p for _, _, p in found]) if found else np.empty((0, 2), np.int32)
                start, end = (pa.array(np.ascontiguousarray(places[:, side])) for side in (0, 1))
            if spans:
                told = pa.StructArray.from_arrays([flat, names.take(flat), start, end], ["id", "piece", "start", "end"])
                new["spans"] = pa.ListArray.from_arrays(limits, told)
            if bounds:
                new["starts"], new["ends"] = pa.ListArray.from_arrays(limits, start), pa.ListArray.from_arrays(limits, end)
            return new

        return work

    return map_text(df, text, ", ".join(parts), make)
