"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by score, then position: the
best pair merges, its neighbours enter the agenda. Merges never cross the start of a run
of space marks, since no piece holds a space mark after another character (checked), so
each distinct segment is encoded once a task. Short segments run their agendas side by
side on arrays; long ones use a heap. Segments are compared with the library in the same
Arrow batch.

Defined results: NULL and empty texts have no ids but the end id. Characters outside the
vocabulary become byte pieces. Rows that repeat, other columns and empty tables pass.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from .common import code_points, map_texts, sums

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Symbols of characters without a piece: this much above their code point.
PLAIN = 1 << 17
NEVER = np.iinfo(np.int64).max
#: Longer segments go to the heap.
SIDE_BY_SIDE = 48


class Merges:
    """The vocabulary of a model as a table of pair merges."""

    def __init__(self, model: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        if sp.normalize(" a\t½  b ") != f"{MARK}{MARK}a\t½{MARK}{MARK}b{MARK}":
            raise ValueError("only vocabularies without text normalization are taken")
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.bytes_of = [None if c else p.encode() for p, c in zip(self.pieces, special)]
        for value, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([value])
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece holds a space mark after another character")
        self.end = sp.eos_id()
        #: Every id in decimal, with a space behind it.
        digits = [f"{i} ".encode() for i in range(n)]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_starts = np.concatenate([[0], np.cumsum([len(d) for d in digits])])
        scores = [sp.get_score(i) for i in range(n)]
        ranks = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        table = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if a is not None and b is not None:
                    table[(a << 21) | b] = (ranks[scores[i]], i)
        self.keys = np.array(sorted(table), np.int64)
        self.rank = np.array([table[k][0] for k in self.keys.tolist()], np.int64)
        self.merged = np.array([table[k][1] for k in self.keys.tolist()], np.int64)
        self.table = table
        #: The symbol of every code point.
        self.symbols = np.arange(PLAIN, PLAIN + 0x110000, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i

    def symbol(self, piece: str) -> int | None:
        return self.ids.get(piece, PLAIN + ord(piece) if len(piece) == 1 else None)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER if the pair doesn't merge) and position in the table of pairs."""
        keys = (left.astype(np.int64) << 21) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.rank[at], NEVER), at

    def side_by_side(self, characters: str, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Encodes segments of one length, joined, one merge of each at a step; gives the
        symbols of all, and how many of each."""
        n = len(characters) // width
        # A column more on the right, of symbols that never merge.
        s = np.full((n, width + 1), -1, np.int32)
        s[:, :width] = self.symbols[code_points(characters)].reshape(-1, width)
        r, at = self.look(s[:, :-1], s[:, 1:])
        live, places, out = np.arange(n), np.arange(width), np.full((n, width), -1, np.int32)
        while len(live):
            j = r.argmin(1)
            row = np.arange(len(live))
            go = r[row, j] < NEVER
            if not go.all():
                out[live[~go]] = s[~go, :width]
                live, j, s, r, at = live[go], j[go], s[go], r[go], at[go]
                row = np.arange(len(live))
            if not len(live):
                break
            joined = self.merged[at[row, j]]
            # The symbol on the right is gone; what follows moves up. Only the pairs on
            # both sides of the new symbol change.
            move = places + (places > j[:, None])
            s[:, :width] = np.take_along_axis(s, move, 1)
            s[row, j] = joined
            move = np.minimum(move, width - 1)
            r, at = np.take_along_axis(r, move, 1), np.take_along_axis(at, move, 1)
            r[:, -1] = NEVER
            for place in (np.maximum(j - 1, 0), j):
                r[row, place], at[row, place] = self.look(s[row, place], s[row, place + 1])
        filled = out >= 0
        return out[filled], filled.sum(1)

    def by_heap(self, segment: str) -> list[int]:
        """Encodes one segment with a heap as the agenda, in n log n."""
        s = [self.symbol(c) for c in segment]
        n = len(s)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int]] = []

        def offer(a, b):
            if a >= 0 and b >= 0 and (found := self.table.get((s[a] << 21) | s[b])):
                heapq.heappush(agenda, (found[0], a, s[a], s[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, a, left, right = heapq.heappop(agenda)
            b = after[a] if s[a] == left else -1
            if b < 0 or s[b] != right:
                continue  # one of the two has merged meanwhile
            s[a], s[b] = self.table[(left << 21) | right][1], -1
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [x for x in s if x >= 0]

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all segments one after the other, and how many of each."""
        widths = np.fromiter(map(len, segments), np.int64, len(segments))
        parts, sizes = [], np.zeros(len(segments), np.int64)
        for width in np.unique(widths).tolist():
            places = np.flatnonzero(widths == width)
            mine = [segments[i] for i in places.tolist()]
            if width <= SIDE_BY_SIDE:
                found, sizes[places] = self.side_by_side("".join(mine), width)
            else:
                lists = [self.by_heap(segment) for segment in mine]
                sizes[places] = [len(x) for x in lists]
                found = np.fromiter(chain.from_iterable(lists), np.int32)
            parts.append((places, found))
        starts = np.cumsum(sizes) - sizes
        ids = np.empty(sizes.sum(), np.int32)
        for places, found in parts:
            own = sizes[places]
            ids[np.arange(len(found)) + np.repeat(starts[places] - (np.cumsum(own) - own), own)] = found
        return self.with_bytes(ids, sizes)

    def with_bytes(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece become the ids of their bytes."""
        plain = ids >= PLAIN
        if not plain.any():
            return ids, sizes
        values, which = np.unique(ids[plain], return_inverse=True)
        spelt = [[self.byte_ids[b] for b in chr(v - PLAIN).encode()] for v in values.tolist()]
        lengths = np.ones(len(ids), np.int64)
        lengths[plain] = np.fromiter(map(len, spelt), np.int64)[which]
        begins = np.cumsum(lengths) - lengths
        out = np.empty(lengths.sum(), np.int32)
        out[begins[~plain]] = ids[~plain]
        for v, bytes_ in enumerate(spelt):
            own = begins[plain][which == v]
            for k, b in enumerate(bytes_):
                out[own + k] = b
        return out, sums(lengths, sizes)

    def segments(self, text: str) -> list[str]:
        return SEGMENT.findall(MARK + text.replace(" ", MARK)) if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control ids have none. One leading space mark goes."""
        text = b"".join(b for i in ids if (b := self.bytes_of[i]) is not None).decode("utf-8", "replace")
        return text.replace(MARK, " ").removeprefix(" ")


class Encoder:
    """Encodes texts, each distinct segment once; `check` compares with the library.

    The ids of all segments lie in one array, their decimal digits (each id followed by a
    space) in another; a text's ids and digits are gathered from there.
    """

    def __init__(self, model: str, check: bool = True, limit: int = 300_000):
        self.merges, self.check, self.limit = Merges(model), check, limit
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.digits = np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.id_starts, self.digit_starts = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def learn(self, segments: set[str]) -> None:
        if len(self.index) > self.limit:
            self.forget()
        fresh = sorted(segments.difference(self.index))
        if not fresh:
            return
        ids, sizes = self.merges.encode_segments(fresh)
        if self.check:
            self.compare(fresh, ids, sizes)
        self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
        self.ids = np.concatenate([self.ids, ids])
        self.digits = np.concatenate([self.digits, _gathered(self.merges.digits, self.merges.digit_starts, ids)])
        self.id_starts = _extended(self.id_starts, sizes)
        self.digit_starts = _extended(self.digit_starts, sums(np.diff(self.merges.digit_starts)[ids], sizes))

    def compare(self, segments: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Fails where the library encodes a segment otherwise."""
        # It puts a space mark before a text, which a marked segment has.
        marked = np.fromiter((len(s) > 1 and s[0] == MARK for s in segments), bool, len(segments))
        places = np.flatnonzero(marked).tolist()
        theirs = self.merges.library.encode([segments[i][1:] for i in places], num_threads=1)
        same = np.array_equal(np.fromiter(map(len, theirs), np.int64, len(theirs)), sizes[marked])
        if same and np.array_equal(np.fromiter(chain.from_iterable(theirs), np.int32), ids[np.repeat(marked, sizes)]):
            return
        starts = np.cumsum(sizes) - sizes
        for i, other in zip(places, theirs):
            own = ids[starts[i] : starts[i] + sizes[i]].tolist()
            if own != other:
                raise ValueError(f"the library encodes {segments[i]!r} as {other}, not {own}")

    def __call__(self, texts: list[str | None]) -> tuple[list[list[int]], list[bytes]]:
        """Ids of each text, and the same in decimal, each followed by a space; without
        the end id."""
        cut = [self.merges.segments(t or "") for t in texts]
        self.learn(set(chain.from_iterable(cut)))
        ids, digits = [], []
        for segments in cut:
            at = np.fromiter(map(self.index.__getitem__, segments), np.int64, len(segments))
            ids.append(_gathered(self.ids, self.id_starts, at).tolist())
            digits.append(_gathered(self.digits, self.digit_starts, at).tobytes())
        return ids, digits


def _extended(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([starts, starts[-1] + np.cumsum(sizes)])


def _gathered(values: np.ndarray, starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches of values that begin at starts[at], one after the other."""
    sizes = starts[at + 1] - starts[at]
    shift = starts[at] - (np.cumsum(sizes) - sizes)
    return values[np.arange(sizes.sum()) + np.repeat(shift, sizes)]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False, check: bool = True) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids of each text."""

    def make():
        encoder = Encoder(model, check)
        end = encoder.merges.end
        last = str(end).encode()

        def work(texts):
            full, digits = encoder(texts)
            for found in full:
                found.append(end)
            decoded = encoder.merges.library.decode(full, num_threads=1)
            out = {
                "n_tokens": [len(x) for x in full],
                "ids_sha256": [hashlib.sha256(d + last).hexdigest() for d in digits],
                "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for d in decoded],
            }
            return out | ({"ids": full} if ids else {})

        return work

    return map_texts(docs, [id_col], text_col, make, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)


def decode(frame: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of encoded rows; NULL ids give an empty text."""
    import pandas as pd

    schema = f"`{id_col}` {frame.schema[id_col].dataType.simpleString()}, text string"

    def run(frames):
        merges = Merges(model)
        for f in frames:
            yield pd.DataFrame({id_col: f[id_col], "text": [merges.decode([] if x is None else list(x)) for x in f[ids_col]]})

    return frame.select(id_col, ids_col).mapInPandas(run, schema)
