"""Exact duplicates against a plain grouping, with tries of every size."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from beatgrid.llm import exact_dedup
from beatgrid.sources.parquet import read_table

SCHEMA = "doc_id bigint, text string, lang string, keep_id string, `Row` string, group_size map<string,int>"


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        own = groups[normal(text)]
        ids = [d for d in own if d is not None]
        sha = hashlib.sha256(normal(text).encode()).hexdigest()
        out.append((doc_id, min(ids) if ids else None, len(own), sha))
    return sorted(out, key=str)


def _rows():
    draw = random.Random(3)
    texts = [None, "", " ", "\t\n", "a", " a", "a ", "a  b", "a\tb", "a b", "é \x85 x", "ab", "abc", "abcd" * 40_000]
    stem = "the same beginning of many texts " * 30
    texts += [stem + str(draw.randrange(40)) for _ in range(300)]
    texts += [f"{draw.randrange(10**6)} other" for _ in range(200)] + ["copy of all"] * 600
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    rows += [(None, "abc"), (None, "nobody else has this"), (None, "nobody  else has this"), rows[20], rows[20]]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"trie_bytes": 20_000, "part_bytes": 30_000}, {"trie_bytes": 1}])
def test_equal_to_plain_groups(spark, sizes):
    rows = _rows()
    table = spark.createDataFrame([(d, t, "en", "mine", "mine", {"a": 1}) for d, t in rows], SCHEMA).repartition(3)
    result = exact_dedup.owners(table, **sizes)
    found = [tuple(r) for r in result.select("doc_id", "keep_id", "group_size", "text_sha256").collect()]
    assert sorted(found, key=str) == expected(rows)
    kept = result.where("kept").select("doc_id", "keep_id", "text_sha256").collect()
    assert len({r["text_sha256"] for r in kept}) == len(kept) == len({normal(t) for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_rows_that_stay_keep_all_columns(spark):
    rows = _rows()
    table = spark.createDataFrame([(d, t, "en", "mine", "mine", {"a": 1}) for d, t in rows], SCHEMA).repartition(3)
    stays = exact_dedup.without_copies(table)
    assert stays.columns == table.columns and stays.dtypes == table.dtypes
    assert {tuple(r) for r in stays.select("lang", "keep_id", "Row").collect()} == {("en", "mine", "mine")}
    found = sorted(normal(r["text"]) for r in stays.select("text").collect())
    assert found == sorted({normal(t) for _, t in rows})


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.owners(empty).count() == 0
    assert exact_dedup.without_copies(empty).columns == empty.columns


def test_whole_table(spark, folder):
    table = read_table(spark, folder, "documents")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    result = exact_dedup.owners(table).select("doc_id", "keep_id", "group_size", "text_sha256").collect()
    assert sorted(map(tuple, result), key=str) == expected(rows)


def test_a_common_text_is_sent_once_per_task(spark):
    table = spark.range(0, 5_000, 1, 4).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"))
    local = exact_dedup._local(table, carry=False)
    classes = local.where("text is not null").agg(F.count("*"), F.sum("n_rows"), F.sum(F.size("codes"))).first()
    assert tuple(classes) == (4, 5_000, 4 * 3)
    most = local.where("code is not null and place is not null").groupBy("code").count().agg(F.max("count")).first()
    assert most[0] <= exact_dedup.CODE_ROWS


def test_trie_shares_beginnings_and_spills_whole_subtrees():
    trie = exact_dedup.Trie(1 << 30)
    texts = [b"", b"a", b"ab", b"abc", b"abd", b"b" * 1_000, b"b" * 1_000 + b"c", b"b" * 500]
    for i, text in enumerate(texts):
        trie.find(text).add((i, i), 1)
        trie.find(text).add((i + 100, i), 1)
    assert {t: (c.least[0], c.rows) for t, c in trie.classes()} == {t: (i, 2) for i, t in enumerate(texts)}
    trie.budget = 900
    taken = trie.give_up(leave_mark=True)
    assert {t for t, _ in taken} | {t for t, _ in trie.classes()} == set(texts)
    assert all(trie.find(text) is None for text, _ in taken)
    assert trie.count == sum(1 for _ in trie.classes())
