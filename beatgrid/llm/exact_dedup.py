"""Exact duplicates by owners in Patricia tries.

Every task first inserts the normalised texts of its rows as byte strings into a compressed radix trie, so that a
text reaches the shuffle once per task however often it occurs. These local classes (text, smallest identifier,
number of rows) are then dealt by length and content hash; each part inserts them into a trie of its own, whose
terminal nodes hold the smallest identifier, the number of rows and the codes of the local classes. Texts are
compared byte by byte along the edges: the hash only deals them out. A trie that outgrows its budget gives up its
heaviest subtree. A local one simply hands on the classes in it; an owner marks the place, hands on the classes
there and every later text that comes to it, and these are dealt anew over more parts until none is left over.

Rows learn their owner by the code of their local class. A code stands for at most ``CODE_ROWS`` rows, so no code
is a hot key, and a text held by a third of all rows sends one row per task to its owner.

Defined results: a null text counts as empty, and empty texts are equal to each other. Of rows with equal texts
that share the smallest doc_id, one stays; a null doc_id comes after all others and can only stay where no row of
its group has an id. A very long text is one byte string as any other; a trie always holds at least one. Extra
columns of any name and type are carried along by ``without_copies`` and ignored by ``owners``. An empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatgrid.llm.batches import small_batches
from beatgrid.session import Scratch, materialize

#: Bytes a trie may hold, its nodes included, before it gives up a subtree.
TRIE_BYTES = 24 << 20
#: Bytes of distinct texts that are dealt to one part of the owners.
PART_BYTES = 8 << 20
#: Rows that share one code.
CODE_ROWS = 512
#: Bytes of texts in one batch of output, and rows taken from a batch of input at once.
BATCH_BYTES = 4 << 20
SLICE = 500

NODE_BYTES = 400
LAST = (1 << 63) - 1
WHITE = b" \t\n\v\f\r"
LOCAL = (
    "place bigint, doc_id bigint, code bigint, sha binary, "
    "text binary, n_bytes bigint, hash bigint, codes array<bigint>, least_id bigint, least_place bigint, n_rows bigint"
)
OWNED = (
    "code bigint, keep_id bigint, keep_place bigint, group_size bigint, "
    "text binary, n_bytes bigint, hash bigint, codes array<bigint>, least_id bigint, least_place bigint, n_rows bigint"
)
CLASS = ("text", "n_bytes", "hash", "codes", "least_id", "least_place", "n_rows")


def normal(data: bytes) -> bytes:
    """Each run of white space as one space, also at both ends."""
    parts = data.split()
    if not parts:
        return b" " if data else b""
    out = b" ".join(parts)
    if data[0] in WHITE:
        out = b" " + out
    return out + b" " if data[-1] in WHITE else out


def _shared(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` stand in ``b`` from ``at`` on; galloping, so long runs are compared in one go."""
    low, step = 0, 16
    while b.startswith(a[low : low + step], at + low) and low < len(a):
        low += step
        step *= 2
    low, high = min(low, len(a)), min(low + step, len(a))
    while low < high:  # the first `low` bytes agree, the first `high` do not
        middle = (low + high + 1) // 2
        if b.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    """An edge's bytes and what lies below: children by first byte, and the class of the text that ends here."""

    __slots__ = ("children", "given_up", "held", "label")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] = {}
        self.held: Class | None = None
        self.given_up = False


class Class:
    """What a terminal node stores: the smallest (identifier, place), the number of rows, and codes."""

    __slots__ = ("codes", "least", "rows")

    def __init__(self) -> None:
        self.least, self.rows, self.codes = (LAST, LAST), 0, array("q")

    def add(self, least: tuple[int, int], rows: int) -> None:
        self.least = min(self.least, least)
        self.rows += rows


class Trie:
    """A compressed radix trie over byte strings with a budget of bytes."""

    def __init__(self, budget: int) -> None:
        self.root, self.budget, self.size, self.count = Node(b""), budget, 0, 0

    def find(self, text: bytes) -> Class | None:
        """The class of a text, new if it is not held yet; None if its place was given up."""
        node, at = self.root, 0
        while True:
            if node.given_up:
                return None
            if at == len(text):
                break
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += NODE_BYTES + len(child.label)
                node = child
                break
            if not text.startswith(child.label, at):
                child = self._split(node, child, _shared(child.label, text, at))
            node, at = child, at + len(child.label)
        if node.held is None:
            node.held = Class()
            self.count += 1
        return node.held

    def _split(self, parent: Node, child: Node, length: int) -> Node:
        middle = Node(child.label[:length])
        child.label = child.label[length:]
        middle.children[child.label[0]] = child
        parent.children[middle.label[0]] = middle
        self.size += NODE_BYTES
        return middle

    def classes(self, top: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, Class]]:
        """All texts below a node with their classes."""
        stack = [(top or self.root, before)]
        while stack:
            node, prefix = stack.pop()
            prefix += node.label
            if node.held is not None:
                yield prefix, node.held
            stack.extend((child, prefix) for child in node.children.values())

    def _weights(self) -> dict[int, int]:
        order, weights = [self.root], {}
        for node in order:
            order.extend(node.children.values())
        for node in reversed(order):
            codes = len(node.held.codes) if node.held else 0
            below = sum(weights[id(child)] for child in node.children.values())
            weights[id(node)] = NODE_BYTES + len(node.label) + 8 * codes + below
        return weights

    def over(self) -> bool:
        return self.size > self.budget and self.count > 1

    def give_up(self, leave_mark: bool) -> list[tuple[bytes, Class]]:
        """Take out the heaviest subtrees below the last branch that holds most of the trie, a quarter of the budget
        at least or all but one text."""
        weights = self._weights()
        node, prefix, total = self.root, b"", weights[id(self.root)]
        while True:
            heaviest = max(node.children.values(), key=lambda c: weights[id(c)])
            if len(heaviest.children) < 2 or weights[id(heaviest)] * 2 < total:
                break
            node, prefix = heaviest, prefix + heaviest.label
        self.size, taken = total, []
        for child in sorted(node.children.values(), key=lambda c: -weights[id(c)]):
            if self.size <= self.budget * 3 // 4 or self.count < 2:
                break
            below = list(self.classes(child, prefix))
            if leave_mark:
                child.children, child.held, child.given_up = {}, None, True
            else:
                del node.children[child.label[0]]
            self.count -= len(below)
            self.size -= weights[id(child)]
            taken += below
        return taken


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _hash(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "little", signed=True)


def _rows_of(classes: Iterator[tuple[bytes, Class]]) -> Iterator[dict[str, list]]:
    """Columns of CLASS for classes, in batches of bounded size; gives the codes' array as it is."""
    columns, size = {name: [] for name in CLASS}, 0
    for text, one in classes:
        values = (text, len(text), _hash(hashlib.sha256(text).digest()), one.codes, *one.least, one.rows)
        for name, value in zip(CLASS, values):
            columns[name].append(value)
        size += len(text) + 8 * len(one.codes) + 100
        if size > BATCH_BYTES:
            yield columns
            columns, size = {name: [] for name in CLASS}, 0
    if columns["text"]:
        yield columns


def _types(schema: str) -> dict[str, pa.DataType]:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return {name: kinds[kind] for name, kind in (field.split() for field in schema.split(", "))}


def _batch(types: dict[str, pa.DataType], columns: dict) -> pa.RecordBatch:
    """A batch of all the types' columns, null where none are given."""
    n = len(next(iter(columns.values())))
    arrays = []
    for name, kind in types.items():
        values = columns.get(name)
        if values is None:
            arrays.append(pa.nulls(n, kind))
        elif isinstance(values, pa.Array):
            arrays.append(values)
        elif pa.types.is_list(kind):
            ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(ends, np.concatenate(values).astype(np.int64), type=kind))
        else:
            arrays.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


def _local(documents: DataFrame, carry: bool, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """A row per document with the code of its local class (and its row, if carried), and the local classes."""
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")]
    schema = StructType.fromDDL(LOCAL)
    if carry:
        columns.append(F.struct(*(F.col(f"`{name}`") for name in documents.columns)).alias("row"))
        schema = schema.add("row", documents.select(columns[-1]).schema["row"].dataType)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, base = _types(LOCAL), TaskContext.get().partitionId() << 33
        trie, seen, codes = Trie(trie_bytes), 0, 0
        for batch in _slices(batches):
            if carry:
                types["row"] = batch.column("row").type
            out = {name: [] for name in ("place", "code", "sha")}
            spilled = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = normal(data or b"")
                one = trie.find(text)
                if one.rows % CODE_ROWS == 0:
                    one.codes.append(base + codes)
                    codes += 1
                one.add((LAST if doc_id is None else doc_id, base + seen), 1)
                out["place"].append(base + seen)
                out["code"].append(one.codes[-1])
                out["sha"].append(hashlib.sha256(text).digest())
                seen += 1
                if trie.over():
                    spilled += trie.give_up(leave_mark=False)
            out["doc_id"] = batch.column("doc_id")
            if carry:
                out["row"] = batch.column("row")
            yield _batch(types, out)
            for part in _rows_of(iter(spilled)):
                yield _batch(types, part)
        for part in _rows_of(trie.classes()):
            yield _batch(types, part)

    return documents.select(*columns).mapInArrow(local, schema)


def _own(classes: DataFrame, parts: int, trie_bytes: int) -> DataFrame:
    """A row per code with its owner, and the classes at places that were given up."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, trie = _types(OWNED), Trie(trie_bytes)
        for batch in _slices(batches):
            again = []
            for text, codes, least_id, least_place, rows in zip(
                *(batch.column(name).to_pylist() for name in ("text", "codes", "least_id", "least_place", "n_rows"))
            ):
                one = trie.find(text)
                if one is None:
                    one = Class()
                    again.append((text, one))
                one.codes.extend(codes)
                one.add((least_id, least_place), rows)
                trie.size += 8 * len(codes)
                if trie.over():
                    again += trie.give_up(leave_mark=True)
            for part in _rows_of(iter(again)):
                yield _batch(types, part)
        out = {name: [] for name in ("code", "keep_id", "keep_place", "group_size")}
        for _, one in trie.classes():
            out["code"].extend(one.codes)
            for name, value in zip(("keep_id", "keep_place", "group_size"), (*one.least, one.rows)):
                out[name].extend([value] * len(one.codes))
            if len(out["code"]) > 100_000:
                yield _batch(types, out)
                out = {name: [] for name in out}
        if out["code"]:
            yield _batch(types, out)

    return classes.select(*CLASS).repartition(parts, "n_bytes", "hash").mapInArrow(own, OWNED)


def _resolved(
    documents: DataFrame, scratch: Scratch, carry: bool, trie_bytes: int = TRIE_BYTES, part_bytes: int = PART_BYTES
) -> DataFrame:
    """A row per document with its owner's id and place, and the size of its group."""
    local = scratch.keep(_local(documents, carry, trie_bytes), "local-classes")
    classes, owners, factor = local.where(F.col("text").isNotNull()), None, 1
    while True:
        size = classes.agg(F.sum("n_bytes"), F.count("*")).first()
        if owners is not None and not size[1]:
            break
        parts = max(1, -(-((size[0] or 0) + NODE_BYTES * size[1]) // part_bytes)) * factor
        owned = scratch.keep(_own(classes, parts, trie_bytes), "class-owners")
        settled = owned.where(F.col("code").isNotNull()).select("code", "keep_id", "keep_place", "group_size")
        owners = settled if owners is None else owners.unionByName(settled)
        classes = owned.where(F.col("text").isNotNull())
        factor *= 2
    members = local.where(F.col("place").isNotNull()).drop(*CLASS)
    return members.join(owners, "code").withColumn("kept", F.col("place") == F.col("keep_place"))


def owners(documents: DataFrame, **sizes: int) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id (null if no row of the group has an id), group_size, kept
    and text_sha256 of the normalised text."""
    with Scratch(documents.sparkSession) as scratch, small_batches(documents.sparkSession):
        rows = _resolved(documents, scratch, carry=False, **sizes)
        result = rows.select(
            "doc_id",
            F.when(F.col("keep_id") < LAST, F.col("keep_id")).alias("keep_id"),
            "group_size",
            "kept",
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
        return materialize(result, "exact-dedup")


def without_copies(documents: DataFrame, **sizes: int) -> DataFrame:
    """The caller's rows that stay, with all their columns."""
    with Scratch(documents.sparkSession) as scratch, small_batches(documents.sparkSession):
        rows = _resolved(documents, scratch, carry=True, **sizes)
        return materialize(rows.where("kept").select("row.*"), "without-copies")
