"""Alignment of two tokenizers' tokens over the same bytes by diagonal run skipping.

Tokenizer A (byte-level BPE, a JSON file) reads a space and the text, tokenizer B (byte-fallback pieces, a model file
that puts the space in front itself) the text; both then cover the same bytes. Byte offsets where a token of A and a
token of B both end cut the two sequences into groups. The end offsets of a batch of texts are two ascending
arrays. As long as they agree at the current index shift, tokens stand one to one: windows of doubling length are
compared at once, and the first difference is found by halving the last one. The irregular group that follows is
resolved by advancing the side that lies behind until both ends meet, which gives the next shift.

Each document also gives its distinct linked pairs of ids (both in one group) with their number of occurrences. The
number of documents of a pair is counted combined before the shuffle, so that a pair which every document holds costs
one row per task. To read the counts back, only pairs of two documents and more, or highest for their A id, are looked
up: that table is measured, broadcast up to 64 MB, and beyond joined with every key salted over 32 tasks; a pair that
is not in it stands in one document.

Defined results: texts that are null or empty, or that either tokenizer does not give back byte by byte, have no
tokens and count zero everywhere. Strings that look like special tokens are ordinary text. A text longer than
``SEGMENT`` is encoded piece by piece, cut before a single space between two words where neither tokenizer can join,
so a task's memory grows with a very long text's ids only. Equal ends are no ties to settle: groups are unique.
Repeated rows count as documents of their own and get equal results; a null doc_id is kept. Extra columns are
carried by ``align`` (a caller's column named like a result gives way) and not read by ``statistics``. An empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatgrid.llm.batches import small_batches
from beatgrid.operators.lookup import BROADCAST_BYTES, left_lookup
from beatgrid.session import Scratch, materialize

#: Characters of texts aligned at once, and of one piece of a very long text.
CHUNK = 500_000
SEGMENT = 200_000
#: Links spelled out at once; a larger group is counted by its distinct ids.
LINKS = 2_000_000
LARGE_GROUP = 100_000
#: Estimated bytes of a counted pair in a broadcast table.
PAIR_BYTES = 48
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: the pattern by which byte-level vocabularies cut texts.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STATISTICS = (
    "place bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<bigint>"
)


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _piece_bytes(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def aligned_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each group ends, as indices after its last token, for two ascending arrays with equal last ends."""
    one, two = a.astype(np.int64).tobytes(), b.astype(np.int64).tobytes()
    ends_a, ends_b = a.tolist(), b.tolist()
    i, j, n = 0, 0, len(ends_a)
    at_a, at_b, lengths = [], [], []
    while i < n:
        if ends_a[i] == ends_b[j]:
            low, step = 1, 4
            while True:  # the first `low` ends agree
                part = one[8 * (i + low) : 8 * (i + low + step)]
                if not part or part != two[8 * (j + low) : 8 * (j + low + step)]:
                    break
                low += len(part) // 8
                step *= 2
            step = min(step, n - i - low)
            while step > 4:  # they differ within the next `step`
                half = step // 2
                if one[8 * (i + low) : 8 * (i + low + half)] == two[8 * (j + low) : 8 * (j + low + half)]:
                    low, step = low + half, step - half
                else:
                    step = half
            while step and ends_a[i + low] == ends_b[j + low]:
                low, step = low + 1, step - 1
            at_a.append(i)
            at_b.append(j)
            lengths.append(low)
            i, j = i + low, j + low
        else:
            x, y = ends_a[i], ends_b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            at_a.append(i)
            at_b.append(j)
            lengths.append(1)
            i, j = i + 1, j + 1
    count = np.array(lengths, dtype=np.int64)
    step = np.arange(1, count.sum() + 1) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(np.array(at_a, dtype=np.int64), count) + step, np.repeat(np.array(at_b, dtype=np.int64), count) + step


class Aligned:
    """Ids of a batch of texts end to end, group ends, and where each text's tokens and groups end."""

    def __init__(self, both: Aligner, texts: list[str]) -> None:
        found = [both.encode(text) for text in texts]
        self.a = np.fromiter(chain.from_iterable(ids for ids, _ in found), dtype=np.int64)
        self.b = np.fromiter(chain.from_iterable(ids for _, ids in found), dtype=np.int64)
        self.text_a = np.cumsum([0, *(len(ids) for ids, _ in found)])
        self.text_b = np.cumsum([0, *(len(ids) for _, ids in found)])
        ends_a, ends_b = np.cumsum(both.length_a[self.a]), np.cumsum(both.length_b[self.b])
        self.end_a, self.end_b = aligned_ends(ends_a, ends_b)
        self.begin_a, self.begin_b = (np.concatenate(([0], e[:-1])) if len(e) else e for e in (self.end_a, self.end_b))
        self.size_a, self.size_b = self.end_a - self.begin_a, self.end_b - self.begin_b
        self.text_groups = np.searchsorted(self.end_a, self.text_a, side="right")
        self.both = both

    def links(self) -> np.ndarray:
        """Links of each text."""
        before = np.concatenate(([0], np.cumsum(self.size_a * self.size_b)))
        return np.diff(before[self.text_groups])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of each text as a * (ids of B) + b, how often each is linked, and where each text's begin."""
        width_b, width = len(self.both.length_b), len(self.both.length_a) * len(self.both.length_b)
        text = np.repeat(np.arange(len(self.text_groups) - 1), np.diff(self.text_groups)) * width
        links = self.size_a * self.size_b
        keys, times = [], []
        for group in np.flatnonzero(links > LARGE_GROUP).tolist():
            ids_a, n_a = np.unique(self.a[self.begin_a[group] : self.end_a[group]], return_counts=True)
            ids_b, n_b = np.unique(self.b[self.begin_b[group] : self.end_b[group]], return_counts=True)
            keys.append((text[group] + ids_a[:, None] * width_b + ids_b[None, :]).ravel())
            times.append((n_a[:, None] * n_b[None, :]).ravel())
        small = np.flatnonzero(links <= LARGE_GROUP)
        block = np.cumsum(links[small]) // LINKS
        for start, stop in _runs(block):
            groups = small[start:stop]
            count = links[groups]
            own = np.repeat(groups, count)
            nth = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            ids_a = self.a[self.begin_a[own] + nth // self.size_b[own]]
            ids_b = self.b[self.begin_b[own] + nth % self.size_b[own]]
            key, n = np.unique(text[own] + ids_a * width_b + ids_b, return_counts=True)
            keys.append(key)
            times.append(n)
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.text_groups), np.int64)
        if len(keys) == 1:
            key, n = keys[0], times[0]
        else:
            every = np.concatenate(keys)
            order = np.argsort(every, kind="stable")
            every = every[order]
            first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
            key, n = every[first], np.add.reduceat(np.concatenate(times)[order], first)
        begins = np.searchsorted(key, np.arange(len(self.text_groups)) * width)
        return key % width, n, begins

    def spelled(self) -> Iterator[bytes]:
        """Each text's groups in decimal: ids of A, a bar, ids of B, parted by semicolons."""
        names, offset = self.both.names, 2 * len(self.both.length_a)
        group = np.arange(len(self.end_a))
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.end_a - 1] = 1
        last_b[self.end_b - 1] = 1
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + self.begin_b[np.repeat(group, self.size_a)]] = 2 * self.a + last_a
        codes[np.arange(len(self.b)) + self.end_a[np.repeat(group, self.size_b)]] = offset + 2 * self.b + last_b
        cuts = self.text_a + self.text_b
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield b"".join([names[code] for code in codes[start:stop].tolist()])[:-1]


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and stop of each run of equal values."""
    if len(values):
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        yield from zip(cuts, cuts[1:])


def _encoder(table: bytes, read: dict, byte: dict[str, int], regular: bool) -> Callable[[str], list[int]]:
    """Encodes by the JSON file; where that holds plain byte-level BPE whose merges stand in order of their ids, the
    same tables are given to the faster of two libraries."""
    model = read["model"]
    plain = regular and model["type"] == "BPE" and not read["pre_tokenizer"].get("add_prefix_space")
    plain = plain and not read.get("normalizer") and not model.get("ignore_merges") and not model.get("dropout")
    pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", ())]
    made = [model["vocab"].get(a + b, -1) for a, b in pairs]
    plain = plain and made == list(range(256, 256 + len(made))) and len(model["vocab"]) == 256 + len(made)
    if plain:
        import tiktoken

        ranks = {bytes(byte[c] for c in word): i for word, i in model["vocab"].items()}
        return tiktoken.Encoding(
            "given", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    one = Tokenizer.from_buffer(table)
    one.encode_special_tokens = True
    return lambda text: one.encode(text, add_special_tokens=False).ids


class Aligner:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, table: bytes, model: bytes) -> None:
        import sentencepiece

        self.two = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte = _byte_of_character()
        read = json.loads(table)
        words = dict(read["model"]["vocab"]) | {t["content"]: t["id"] for t in read.get("added_tokens") or ()}
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            plain = all(c in byte for c in word)
            self.bytes_a[i] = bytes(byte[c] for c in word) if plain else word.encode()
        pieces = self.two.id_to_piece(list(range(self.two.get_piece_size())))
        self.bytes_b = [_piece_bytes(piece) for piece in pieces]
        self.length_a = np.array(list(map(len, self.bytes_a)), dtype=np.int64)
        self.length_b = np.array(list(map(len, self.bytes_b)), dtype=np.int64)
        ids = (range(len(self.bytes_a)), ",|"), (range(len(self.bytes_b)), ",;")
        self.names = [f"{i}{sign}".encode() for numbers, signs in ids for i in numbers for sign in signs]
        before = read.get("pre_tokenizer") or {}
        regular = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        self.cuts = regular and not any(re.search("[^▁]▁", piece) for piece in pieces)
        self.encode_a = _encoder(table, read, byte, regular)

    def _segments(self, text: str) -> list[str]:
        """Pieces of a long text without the space between them, which each piece gets back in front."""
        if len(text) <= SEGMENT or not self.cuts:
            return [text]
        out, at = [], 0
        while len(text) - at > SEGMENT and (cut := CUT.search(text, at + SEGMENT)):
            out.append(text[at : cut.start()])
            at = cut.end()
        return [*out, text[at:]]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both tokenizers; none if either does not give the text back."""
        if not text:
            return [], []
        a, b = [], []
        for part in self._segments(text):
            a += self.encode_a(" " + part)
            b += self.two.encode(part, num_threads=1)
        data = b" " + text.encode("utf-8", "surrogatepass")
        for ids, tokens in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(map(tokens.__getitem__, ids)) != data:
                return [], []
        return a, b

    def batches(self, texts: list[str | None]) -> Iterator[tuple[int, int, Aligned]]:
        """The texts aligned, in batches of bounded size, each with the range of texts it holds."""
        start, size = 0, 0
        for at, text in enumerate(texts):
            if at > start and size + len(text or "") > CHUNK:
                yield start, at, Aligned(self, texts[start:at])
                start, size = at, 0
            size += len(text or "")
        if start < len(texts):
            yield start, len(texts), Aligned(self, texts[start:])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(table: bytes, model: bytes) -> Aligner:
    """One per process and pair of files."""
    key = hashlib.sha256(table).hexdigest(), hashlib.sha256(model).hexdigest()
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(table, model)
    return _ALIGNERS[key]


def _files(documents: DataFrame, json_path: str, model_path: str):
    """Both vocabulary files, read where the program runs and sent once to each executor."""
    found = []
    for path in (json_path, model_path):
        with open(path, "rb") as file:
            found.append(file.read())
    return documents.sparkSession.sparkContext.broadcast(tuple(found))


def align(documents: DataFrame, json_path: str, model_path: str) -> DataFrame:
    """The caller's columns with ``ids_a``, ``ids_b``, and ``end_a``, ``end_b``: for each group the number of tokens
    of A and of B up to its end."""
    files = _files(documents, json_path, model_path)
    names = ("ids_a", "ids_b", "end_a", "end_b")

    @F.pandas_udf("struct<ids_a: array<int>, ids_b: array<int>, end_a: array<int>, end_b: array<int>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        both = _aligner(*files.value)
        for texts in batches:
            rows = []
            for _, _, one in both.batches([None if t is None else t for t in texts.tolist()]):
                for t in range(len(one.text_a) - 1):
                    a0, a1, b0, b1 = *one.text_a[t : t + 2], *one.text_b[t : t + 2]
                    groups = slice(*one.text_groups[t : t + 2])
                    rows.append((one.a[a0:a1], one.b[b0:b1], one.end_a[groups] - a0, one.end_b[groups] - b0))
            yield pd.DataFrame({name: [row[i].astype(np.int32) for row in rows] for i, name in enumerate(names)})

    result = found(F.col("text").cast("string"))
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns))
    both = documents.select(row.alias("row"), result.alias("found"))
    kept = [F.col(f"row.`{c}`") for c in documents.columns if c.lower() not in names]
    return both.select(*kept, *(F.col(f"found.{name}").alias(name) for name in names))


def _statistics(documents: DataFrame, files) -> DataFrame:
    schema = StructType.fromDDL(STATISTICS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, place = _aligner(*files.value), TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for start, stop, one in both.batches(texts):
                pairs, times, begins = one.pairs()
                shas = [hashlib.sha256(said).hexdigest() if said else "" for said in one.spelled()]
                begins = pa.array(begins, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(place, place + stop - start)),
                        ids.slice(start, stop - start),
                        pa.array(np.diff(one.text_a)),
                        pa.array(np.diff(one.text_b)),
                        pa.array(np.diff(one.text_groups)),
                        pa.array(one.links()),
                        pa.array(shas, pa.string()),
                        pa.ListArray.from_arrays(begins, pa.array(pairs)),
                        pa.ListArray.from_arrays(begins, pa.array(times)),
                    ],
                    names=schema.names,
                )
                place += stop - start

    columns = F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    return documents.select(*columns).mapInArrow(counted, schema)


def statistics(
    documents: DataFrame, json_path: str, model_path: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    files = _files(documents, json_path, model_path)
    width_b = len(_aligner(*files.value).length_b)
    with Scratch(documents.sparkSession) as scratch, small_batches(documents.sparkSession):
        rows = scratch.keep(_statistics(documents, files), "aligned")
        counts = scratch.keep(
            rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts"
        )
        a = F.expr(f"pair div {width_b}").alias("a")
        best = counts.groupBy(a).agg(F.max("n").alias("most"))  # a row per id of A at most
        known = counts.withColumn("a", a).join(F.broadcast(best), "a")
        known = known.select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))
        known = scratch.keep(known.where("n > 1 or is_best"), "known-pairs")
        linked = rows.select("place", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
        linked = linked.select("place", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
        found = left_lookup(linked, known, "pair", PAIR_BYTES * known.count(), limit=broadcast_bytes)
        sums = found.groupBy("place").agg(
            F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.coalesce("n", F.lit(1))).alias("count_sum"),
        )
        result = rows.drop("pairs", "times").join(sums, "place", "left")
        result = result.select(
            *("doc_id", "n_a", "n_b", "n_groups", "n_links"),
            *(F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in ("n_best", "count_sum")),
            "groups_sha256",
        )
        return materialize(result, "alignment")
