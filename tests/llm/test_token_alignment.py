"""Token alignment against both libraries and nested loops."""

from __future__ import annotations

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from beatgrid.llm import token_alignment
from beatgrid.sources.parquet import read_table

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, n_a string, ids_a string, pairs string, `_aligned` string"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def both():
    one = Tokenizer.from_file(A_PATH)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def _byte_chars():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {}, 0
    for b in range(256):
        out[chr(b) if b in keep else chr(256 + n)] = b
        n += b not in keep
    return out


CHARS = _byte_chars()


def plain(both, text):
    """Groups of (ids of A, ids of B) by sets of end offsets."""
    one, two = both
    if not text:
        return []
    a, b = one.encode(" " + text, add_special_tokens=False), two.encode(text)
    bytes_a = [bytes(CHARS[c] for c in one.id_to_token(i)) for i in a.ids]
    names = [two.id_to_piece(i) for i in b]
    bytes_b = [
        bytes([int(n[3:5], 16)]) if re.fullmatch("<0x..>", n) else n.replace("▁", " ").encode() for n in names
    ]
    data = (" " + text).encode()
    if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
        return []
    ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
    groups = [([], []) for _ in sorted(set(ends_a) & set(ends_b))]
    common = sorted(set(ends_a) & set(ends_b))
    for side, (ids, ends) in enumerate(((a.ids, ends_a), (b, ends_b))):
        at = 0
        for i, end in zip(ids, ends):
            groups[at][side].append(i)
            at += end == common[at]
    return groups


def expected(both, rows):
    found = [(doc_id, plain(both, text)) for doc_id, text in rows]
    links = [Counter((a, b) for one, two in groups for a in one for b in two) for _, groups in found]
    counts = Counter(pair for own in links for pair in own)
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, groups), own in zip(found, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                own.total(),
                sum(n for pair, n in own.items() if counts[pair] == best[pair[0]]),
                sum(n * counts[pair] for pair, n in own.items()),
                hashlib.sha256(said.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


def _rows():
    draw = random.Random(1)
    words = ["the", "Straße", "unbelievable", "été", "naïvely", "\U0001f600\U0001f468‍\U0001f469", "12345", "it's", "漢字仮名", "=="]
    texts = [None, "", " ", "  ", "\n\n\t", "a", " a", "a  b   c    d", "<|endoftext|> <s> </s> <unk>", "▁x", "x▁ y", "\x00\x01\x7f"]
    texts += ["a" * 3_000, "ab" * 999, " " * 500, "‮́́ é", "﻿ bom", "١٢٣ ٤", "ﬁ ﬀ Å K", "x\r\ny"]
    texts += [" ".join(draw.choices(words, k=draw.randrange(1, 60))) for _ in range(60)]
    texts += [" ".join(draw.choices(words, k=4_000)), "the same text"] + ["the same text"] * 3
    return [(i, t) for i, t in enumerate(texts)] + [(None, "the same text"), (3, "text"), (3, "text")]


def _found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_equal_to_both_libraries(spark, both, monkeypatch, limit):
    rows = _rows()
    table = spark.createDataFrame([(d, t, "mine", "mine", "mine", "mine") for d, t in rows], SCHEMA).repartition(3)
    result = token_alignment.statistics(table, A_PATH, B_PATH, broadcast_bytes=limit)
    assert _found(result) == expected(both, rows)


def test_small_pieces_and_large_groups(spark, both, monkeypatch):
    monkeypatch.setattr(token_alignment, "SEGMENT", 20)
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 2)
    monkeypatch.setattr(token_alignment, "LINKS", 5)
    with open(A_PATH, "rb") as one, open(B_PATH, "rb") as two:
        aligner = token_alignment.Aligner(one.read(), two.read())
    assert aligner.cuts
    rows = [(d, t) for d, t in _rows() if d is not None]
    for _, _, batch in aligner.batches([t for _, t in rows]):
        pairs, times, begins = batch.pairs()
        for i, ((_, text), said) in enumerate(zip(rows, batch.spelled())):
            groups = plain(both, text)
            assert said.decode() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            own = Counter(a * 32_000 + b for x, y in groups for a in x for b in y)
            part = slice(begins[i], begins[i + 1])
            assert dict(zip(pairs[part].tolist(), times[part].tolist())) == own


def test_both_ways_to_encode_agree(both):
    with open(A_PATH, "rb") as file:
        table = file.read()
    read, byte = json.loads(table), token_alignment._byte_of_character()
    fast = token_alignment._encoder(table, read, byte, True)
    slow = token_alignment._encoder(table, read | {"normalizer": {"type": "NFC"}}, byte, True)
    assert type(fast).__name__ == "method" and type(slow).__name__ == "function"
    for _, text in _rows():
        assert fast(" " + (text or "")) == slow(" " + (text or ""))


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 200)), st.sets(st.integers(1, 200)), st.sets(st.integers(1, 200)))
def test_groups_end_where_both_end(only_a, only_b, shared):
    a, b = sorted(only_a | shared | {201}), sorted(only_b | shared | {201})
    end_a, end_b = token_alignment.aligned_ends(np.array(a), np.array(b))
    common = sorted(set(a) & set(b))
    assert [a[i - 1] for i in end_a] == common == [b[j - 1] for j in end_b]


def test_columns_are_carried(spark, both):
    rows = _rows()
    table = spark.createDataFrame([(d, t, "mine", "mine", "mine", "mine") for d, t in rows], SCHEMA).repartition(3)
    result = token_alignment.align(table, A_PATH, B_PATH)
    assert result.columns == ["doc_id", "text", "n_a", "pairs", "_aligned", "ids_a", "ids_b", "end_a", "end_b"]
    for row in result.collect():
        groups = plain(both, row["text"])
        assert row["n_a"] == row["_aligned"] == "mine"
        assert row["ids_a"] == [i for a, _ in groups for i in a] and row["ids_b"] == [i for _, b in groups for i in b]
        assert row["end_a"] == np.cumsum([len(a) for a, _ in groups]).tolist()
        assert row["end_b"] == np.cumsum([len(b) for _, b in groups]).tolist()


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_alignment.statistics(empty, A_PATH, B_PATH).count() == 0
    assert token_alignment.align(empty, A_PATH, B_PATH).count() == 0


def test_whole_table(spark, both, folder):
    table = read_table(spark, folder, "documents")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert _found(token_alignment.statistics(table, A_PATH, B_PATH)) == expected(both, rows)


def test_a_common_pair_is_sent_once_per_task(spark):
    table = spark.range(0, 2_000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"))
    result = token_alignment.statistics(table, A_PATH, B_PATH)
    assert result.select("n_best", "count_sum").distinct().collect()[0]["count_sum"] == 2 * 2_000
