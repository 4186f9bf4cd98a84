"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Code points are mapped to classes (letter, number, space, other white space, apostrophe that opens a
contraction, other). Reading a class changes a small state: which kind of token is open. Each class is thus a
function from states to states, and as composing functions is associative, the state at every position comes
from a blocked scan: rows of a block are composed column by column for all blocks at once, then the blocks'
totals are chained. Token boundaries follow from class, state and the character after white space; no regular
expression runs. The distinct slices are merged once by ranks and kept in a cache; ids and byte offsets of
all tokens are then put together by array indexing, and decoding writes each token's bytes at its offset.

Texts are taken in chunks of bounded size, a very long text in windows that begin at a token boundary, so a
task's memory does not grow with a text beyond the text itself and its tokens.

Defined results: a null text is encoded as the empty text, which has no tokens; strings that look like special
tokens are ordinary text; repeated rows get equal results; an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

LETTER, NUMBER, OTHER, WHITE, SPACE, SHORT, LONG = range(7)
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_WHITE, AFTER_SPACE, TWO_LEFT, ONE_LEFT = range(8)
STATES = 8
#: The code points with the Unicode property White_Space.
WHITE_SPACE = [
    *range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
#: The contractions after an apostrophe.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

CHUNK = 250_000
WINDOW = 4_000_000
CACHE = 200_000
SHORT_PIECE = 24
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _next(state: int, kind: int) -> int:
    """The state after a character of a class."""
    if kind == LETTER:
        return {TWO_LEFT: ONE_LEFT, ONE_LEFT: START}.get(state, IN_LETTERS)
    if kind in (SHORT, LONG) and state not in (IN_OTHER, AFTER_SPACE):
        return ONE_LEFT if kind == SHORT else TWO_LEFT
    return {NUMBER: IN_NUMBERS, WHITE: AFTER_WHITE, SPACE: AFTER_SPACE}.get(kind, IN_OTHER)


class _Scan:
    """The functions that sequences of classes amount to, their composition table, and the tables of the scan."""

    def __init__(self) -> None:
        kinds = [tuple(_next(s, k) for s in range(STATES)) for k in range(7)]
        opening = [(f[START],) * STATES for f in kinds]  # at a text's first character
        functions = list(dict.fromkeys([tuple(range(STATES)), *kinds, *opening]))
        place = {f: i for i, f in enumerate(functions)}
        for f in functions:  # grows while it is walked
            for g in [*kinds, *opening]:
                both = tuple(g[s] for s in f)
                if both not in place:
                    place[both] = len(functions)
                    functions.append(both)
        self.size = len(functions)
        self.apply = np.array(functions, dtype=np.uint8)
        self.kind = np.array([place[f] for f in kinds], dtype=np.uint16)
        self.opening = np.array([place[f] for f in opening], dtype=np.uint16)
        self.then = np.array(
            [place[tuple(g[s] for s in f)] for f in functions for g in functions], dtype=np.uint16
        )
        joins = {
            LETTER: (IN_LETTERS, AFTER_SPACE, TWO_LEFT, ONE_LEFT),
            NUMBER: (IN_NUMBERS, AFTER_SPACE),
            OTHER: (IN_OTHER, AFTER_SPACE),
            SHORT: (IN_OTHER, AFTER_SPACE),
            LONG: (IN_OTHER, AFTER_SPACE),
            WHITE: (AFTER_WHITE, AFTER_SPACE),
            SPACE: (AFTER_WHITE, AFTER_SPACE),
        }
        self.begins = np.array([[s not in joins[k] for s in range(STATES)] for k in range(7)]).ravel()
        self.classes = np.full(0x110000, OTHER, dtype=np.uint8)
        for code in range(0x110000):
            first = unicodedata.category(chr(code))[0]
            if first in "LN":
                self.classes[code] = LETTER if first == "L" else NUMBER
        self.classes[WHITE_SPACE] = WHITE
        self.classes[0x20] = SPACE

    def states_before(self, functions: np.ndarray, columns: int = 256) -> np.ndarray:
        """The state in front of every position: a blocked scan over function composition."""
        n = len(functions)
        rows = -(-n // columns)
        grid = np.zeros(rows * columns, dtype=np.uint16)  # function 0 changes nothing
        grid[:n] = functions
        grid = np.ascontiguousarray(grid.reshape(rows, columns).T)
        for j in range(1, columns):
            grid[j] = self.then[grid[j - 1].astype(np.int64) * self.size + grid[j]]
        entry = np.zeros(rows, dtype=np.uint8)
        state = START
        for row, total in enumerate(grid[-1].tolist()):
            entry[row] = state
            state = self.apply[total, state]
        after = self.apply[grid, entry[None, :]].T.ravel()[:n]
        return np.concatenate((np.array([START], dtype=np.uint8), after[:-1]))

    def boundaries(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Positions where tokens begin, for texts joined end to end (``starts``: where each non-empty text begins)."""
        n = len(points)
        kinds = self.classes[points]
        opens = np.zeros(n + 1, dtype=bool)
        opens[starts] = True
        opens[n] = True
        for at in np.flatnonzero(points == ord("'")).tolist():
            tail = "".join(map(chr, points[at + 1 : at + 3].tolist()))
            if tail[:1] and tail[0] in ONE_LETTER and not opens[at + 1]:
                kinds[at] = SHORT
            elif tail in TWO_LETTERS and not opens[at + 1] and not opens[at + 2]:
                kinds[at] = LONG
        functions = np.where(opens[:n], self.opening[kinds], self.kind[kinds])
        before = self.states_before(functions)
        begins = self.begins[kinds.astype(np.int64) * STATES + before] | opens[:n]
        white = (kinds == WHITE) | (kinds == SPACE)
        last = white.copy()
        last[:-1] &= ~white[1:]
        last &= ~opens[1:]  # white space at the end of a text stays in one piece
        return np.flatnonzero(begins | last)


class Codec:
    """Encoder and decoder for one table of ranks."""

    _scan: _Scan | None = None

    def __init__(self, table: bytes) -> None:
        if Codec._scan is None:
            Codec._scan = _Scan()
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, table.splitlines())}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.places = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.cache: dict[str, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one slice: adjacent parts of lowest rank are joined, leftmost first."""
        ranks, none = self.ranks, 1 << 30
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > SHORT_PIECE:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at] += parts[at + 1]
            del parts[at + 1], pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
        return [ranks[part] for part in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same by a heap of pairs over a linked list, for slices of any length."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # where the part that begins here ends; 0 once it is joined to another
        left = list(range(-1, n - 1))
        heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, at, stop = heapq.heappop(heap)
            middle = end[at]
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[at], end[middle] = stop, 0
            if stop < n:
                left[stop] = at
                longer = piece[at : end[stop]]
                if longer in ranks:
                    heapq.heappush(heap, (ranks[longer], at, end[stop]))
            if left[at] >= 0:
                longer = piece[left[at] : stop]
                if longer in ranks:
                    heapq.heappush(heap, (ranks[longer], left[at], stop))
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and how many each has."""
        codes, distinct = pd.factorize(np.array(pieces, dtype=object))
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        found = []
        for piece in distinct:
            ids = cache.get(piece)
            if ids is None:
                ids = self.merge(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= SHORT_PIECE:
                    cache[piece] = ids
            found.append(ids)
        counts = np.array([len(ids) for ids in found], dtype=np.int64)
        flat = np.array([i for ids in found for i in ids], dtype=np.uint32)
        firsts = np.cumsum(counts) - counts
        per_piece = counts[codes]
        ends = np.cumsum(per_piece)
        index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(firsts[codes] - (ends - per_piece), per_piece)
        return flat[index], per_piece

    def _encode_joined(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of several texts at once."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, dtype=np.uint32) for _ in texts]
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        firsts = np.cumsum(lengths) - lengths
        begins = self._scan.boundaries(points, firsts[lengths > 0])
        cuts = [*begins.tolist(), len(joined)]
        ids, per_piece = self._ids([joined[a:b] for a, b in zip(cuts, cuts[1:])])
        before = np.concatenate(([0], np.cumsum(per_piece)))
        edges = before[np.searchsorted(begins, np.concatenate((firsts, [len(joined)])))]
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def _encode_long(self, text: str) -> np.ndarray:
        """Ids of a very long text, window by window; each begins where a token begins for certain."""
        out, at, width = [], 0, WINDOW
        while at < len(text):
            window = text[at : at + width]
            if at + width >= len(text):
                out += self._encode_joined([window])
                break
            points = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            begins = self._scan.boundaries(points, np.zeros(1, dtype=np.int64))
            sure = begins[begins <= len(window) - 4]
            if sure[-1] == 0:  # one token longer than the window
                width *= 2
                continue
            cuts = sure.tolist()
            out.append(self._ids([window[a:b] for a, b in zip(cuts, cuts[1:])])[0])
            at += cuts[-1]
            width = WINDOW
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)

    def encode_batch(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in order."""
        group: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if group and size + len(text) > CHUNK:
                yield from self._encode_joined(group)
                group, size = [], 0
            if len(text) > WINDOW:
                yield self._encode_long(text)
                continue
            group.append(text)
            size += len(text)
        if group:
            yield from self._encode_joined(group)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of every token, and the length of the text in bytes at the end."""
        return np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(self.lengths[ids])))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of a token sequence, each token written at its offset."""
        total = int(offsets[-1])
        source = np.arange(total) + np.repeat(self.places[ids] - offsets[:-1], self.lengths[ids])
        return self.flat[source].tobytes()


_CODECS: dict[str, Codec] = {}


def codec(table: bytes) -> Codec:
    """One codec per process and table."""
    key = hashlib.sha256(table).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(table)
    return _CODECS[key]


def _table(documents: DataFrame, ranks_path: str):
    """The rank file, read where the program runs and sent once to each executor; its size is that of a vocabulary."""
    with open(ranks_path, "rb") as file:
        return documents.sparkSession.sparkContext.broadcast(file.read())


def encode(documents: DataFrame, ranks_path: str) -> DataFrame:
    """The caller's columns but the text, with ``ids`` and ``offsets`` (of each token in bytes, and of the end)."""
    table = _table(documents, ranks_path)
    dropped = {"text", "ids", "offsets"}
    kept = [name for name in documents.columns if name.lower() not in dropped]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*_quoted(kept)).schema)
    schema = f"{fields}, ids array<int>, offsets array<bigint>".removeprefix(", ")

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(table.value)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256].reset_index(drop=True)
                ids = list(own.encode_batch(part["text"].tolist()))
                result = part.drop(columns=["text"])
                result["ids"] = [i.astype(np.int32) for i in ids]
                result["offsets"] = [own.offsets(i) for i in ids]
                yield result

    return documents.select(*_quoted(kept), "text").mapInPandas(encoded, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of :func:`encode` with ``decoded`` (the bytes of the text) in place of ids and offsets."""
    table = _table(encoded, ranks_path)
    kept = [name for name in encoded.columns if name not in ("ids", "offsets")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*_quoted(kept)).schema)
    schema = f"{fields}, decoded binary".removeprefix(", ")

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(table.value)
        for batch in batches:
            result = batch.drop(columns=["ids", "offsets"])
            pairs = zip(batch["ids"], batch["offsets"])
            result["decoded"] = [own.decode(np.asarray(i, dtype=np.int64), np.asarray(o)) for i, o in pairs]
            yield result

    return encoded.mapInPandas(decoded, schema)


def round_trip(documents: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them, in one map over the scan."""
    table = _table(documents, ranks_path)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(table.value)
        for batch in batches:
            rows = []
            for ids in own.encode_batch(batch["text"].tolist()):
                back = own.decode(ids, own.offsets(ids))
                rows.append(
                    (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest())
                )
            result = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            result.insert(0, "doc_id", batch["doc_id"].reset_index(drop=True))
            yield result

    return documents.select("doc_id", "text").mapInPandas(digests, DIGESTS)


def _quoted(names: list[str]) -> list[str]:
    return [f"`{name}`" for name in names]
