"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from beatgrid.llm import lexical_search
from beatgrid.sources.parquet import read_table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id bigint, text string, length string, place string, `Terms` string, score string, item string"
ITEMS = "item_id bigint, text string, term string, rank string, doc_id string"


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def ranks(documents, items, top=10):
    """(item, rank, doc_id, score) by the definition."""
    read = [(d, Counter(terms(t))) for d, t in documents]
    read = [(d, own, own.total()) for d, own in read if own]
    n_all, length = len(read), sum(n for _, _, n in read)
    df = Counter(t for _, own, _ in read for t in own)
    asked: dict = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, wanted in asked.items():
        scored = []
        for d, own, n in read:
            m = 100 - 90 + (90 * n * n_all) // length
            score = 0
            for t in wanted & own.keys():
                w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * own[t]) // (1_000 * own[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(i, k, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    words = [f"w{int(draw.paretovariate(0.7)) % 700}" for _ in range(3_000)] + ["Été", "école", "ÉCOLE", "K", "x1y2"]
    texts = [None, "", " .,;", "one", "One-two_THREE", "a" * 5_000, "été\x85x  y", "don't İstanbul"]
    texts += [" ".join(draw.choices(words, k=draw.choice([3, 30, 300]))) for _ in range(500)]
    copy = " ".join(draw.choices(words, k=50))
    texts += [copy] * 200 + [" ".join(draw.choices(words, k=20_000))]
    documents = [(5 * i % 1_511, t) for i, t in enumerate(texts)] + [(None, copy), (None, copy), (4_000, texts[20])] * 2
    asked = [None, "", "?!", "unknown words only", copy, copy[:40], "ONE two three", "été École", texts[20], texts[-1]]
    asked += [" ".join(draw.choices(words, k=draw.choice([1, 5, 40]))) for _ in range(40)]
    items = [(i if i else None, t) for i, t in enumerate(asked)] + [(7, "x1y2"), (7, "x1y2"), (None, "one")]
    return documents, items


@pytest.mark.parametrize("sizes", [{}, {"bucket": 16}, {"block_terms": 500, "bucket": 50}, {"top": 3}])
def test_equal_to_scoring_everything(spark, rows, sizes):
    documents, items = rows
    one = spark.createDataFrame([(d, t, "a", "b", "c", "d", "e") for d, t in documents], DOCUMENTS).repartition(5)
    two = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in items], ITEMS).repartition(2)
    result = lexical_search.search(one, two, **sizes)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(result) == ranks(documents, items, sizes.get("top", 10))


def test_windows_of_a_long_text(monkeypatch):
    monkeypatch.setattr(lexical_search, "WINDOW_BYTES", 7)
    text = "Some WORDS of a_text, été 123 and averyveryverylongword at the end"
    assert [t.decode() for part in lexical_search.term_list(text.encode()) for t in part] == terms(text)


def test_empty_tables(spark, rows):
    documents = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "two")], "item_id bigint, text string")
    assert lexical_search.search(documents.limit(0), items).count() == 0
    assert lexical_search.search(documents, items.limit(0)).count() == 0
    assert lexical_search.search(documents, items).count() == 1


def test_whole_table(spark, folder):
    documents, items = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    result = lexical_search.search(documents, items)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(result) == ranks(rows, [tuple(r) for r in items.select("item_id", "text").collect()])


def test_bounds_spare_work_and_lose_nothing():
    draw = np.random.default_rng(4)
    weights = draw.integers(1, 9_000, 200)
    tfs = [np.sort(draw.choice(200, draw.integers(1, 40), replace=False)) for _ in range(400)]
    m = draw.integers(10, 400, 400)
    lengths = [
        float(np.sqrt((weights[t] * lexical_search.impacts(np.ones(len(t), np.int64), k) ** 2.0).sum())) for t, k in zip(tfs, m)
    ]
    order = np.argsort(lengths)[::-1]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(order),
            pa.array(np.array(lengths)[order]),
            pa.array(m[order]),
            pa.array([tfs[i].astype(np.int32) for i in order], pa.list_(pa.int32())),
            pa.array([np.ones(len(tfs[i]), np.int64) for i in order], pa.list_(pa.int64())),
        ],
        names=["doc_id", "length", "m", "terms", "tfs"],
    )
    spared, buckets = 0, [lexical_search.Bucket(batch.slice(s, 50), 200) for s in range(0, 400, 50)]
    for _ in range(50):
        item = lexical_search.Item(draw.choice(200, 12, replace=False), weights)
        every = np.concatenate([b.scores(item, np.arange(b.size)) for b in buckets])
        least = int(np.sort(every)[-10])
        reached = [b.reach(item, least) for b in buckets]
        spared += sum(b.size - len(r) for b, r in zip(buckets, reached))
        assert sum((b.scores(item, r) >= least).sum() for b, r in zip(buckets, reached)) == (every >= least).sum()
    assert spared > 50 * 400 / 4  # weights and impacts are drawn evenly here, which prunes least
