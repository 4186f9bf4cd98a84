"""The operators against plain versions, on edge cases and on the smallest tables."""

from __future__ import annotations

import hashlib
import random

import pytest
from brute import (
    WORD,
    edited,
    highest_quotients,
    jaccard,
    line_dedup,
    linked,
    repeated_share,
    repetition_base,
    sha,
    shingles,
    substring_dedup,
    targets,
    words,
)
from pyspark.sql import functions as F

from beatgrid.llm import fingerprints, mixing, ngram_join, repetition, substring_dedup as substring
from beatgrid.llm import line_dedup as lines
from beatgrid.sources.parquet import read_table

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _texts():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "Straße", "naïve", "x" * 40]

    def prose(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    passage = prose(80)
    base = prose(300)
    near = [base.split(" ") for _ in range(12)]
    for i, text in enumerate(near):
        for _ in range(3):
            text[draw.randrange(300)] = f"edit{i}{draw.randrange(9)}"
    chain = [base.split(" ")]
    for i in range(6):  # each close to the one before it, the ends far apart
        text = list(chain[-1])
        for k in range(i * 40, i * 40 + 5):
            text[k] = f"chain{i}-{k}"
        chain.append(text)
    return [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        "One",
        "two words",
        "a b c",
        "a b c d",
        "A B C D",
        "café   nbsp wide \x1c sep",
        "same line here\nsame line here\n  Same Line Here\t\nother line of text",
        "other line of text\nshort\nshort\n\nsame line HERE\nlast one only",
        "x y z " * 200,
        prose(40) + " " + passage + " " + prose(40),
        prose(10) + " " + passage + "\n" + prose(60),
        passage,
        prose(20) + "\t" + passage.replace(" ", "\n"),
        prose(20_000),
        *[" ".join(t) for t in near],
        *[" ".join(t) for t in chain],
        base,
        base,
        "it's we'll they'VE 'tis don't!!  \n\n  12345 ١٢ #tags &amp; \U0001f600\U0001f600 end   ",
        "École ÉCOLE K İ straße",
    ]


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    table = [(i * 3 + 1, t, "en", (None, "b", "a", "ä")[i % 4], len(t or "")) for i, t in enumerate(texts)]
    table += [table[14], table[14]]  # repeated rows
    table += [(None, texts[13], None, None, None), (None, None, None, None, None)]
    table += [(2, texts[13], "en", "a", 0), (10_000, texts[18], "en", "a", 0)]
    return table


@pytest.fixture(scope="module")
def documents(spark, rows):
    """Edge cases with extra columns named like results and helpers."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clash = ("taken", "size", "n_words", "kept", "n_lines", "component_id", "fingerprint", "ids", "Target")
    return df.withColumns({name: F.lit("mine") for name in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def table(spark, folder):
    df = read_table(spark, folder, "documents")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def found(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: [(v is None, v) for v in r])


def expected(rows):
    return sorted(rows, key=lambda r: [(v is None, v) for v in r])


# Repetition

BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_repetition_counts(documents, rows, table):
    for df, own in ((documents, pairs(rows)), table):
        result = repetition.repetition(df)
        assert found(result, *BASE) == expected([(d, *repetition_base(t)) for d, t in own])
        for row in result.select("base_failed", "kept").collect():
            assert not (row["base_failed"] and row["kept"])


def test_repetition_shares(rows):
    for text in ["a b c d e f g h i j " * 2, rows[20][1], "x y z " * 30, "p q r s t u v w " + "a b c d e " * 3]:
        share = max(repeated_share(text, n) for n in repetition.COVERAGE)
        assert repetition.measure(text)[8] == pytest.approx(share)


def test_hash_collisions_do_not_count(monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    clean = repetition.measure(text)
    monkeypatch.setattr(repetition, "_mixed", lambda ids: (ids % 2).astype("uint64"))
    assert repetition.measure(text)[:7] == clean[:7]


# Fingerprints


def test_fingerprints(documents, rows, table):
    for df, own in ((documents, pairs(rows)), table):
        smallest = [(-(2**63) if d is None else d, t or "") for d, t in own]
        want = {(d, t): (e, n) for d, t, e, n in edited(smallest)}
        result = fingerprints.compare_with_edited(df.select("doc_id", "text", F.lit("x").alias("_id"))).collect()
        assert len(result) == len(own)
        texts = {}
        for d, t in smallest:
            texts.setdefault((d, len(t)), []).append(t)
        errors = []
        for row in result:
            d = -(2**63) if row["doc_id"] is None else row["doc_id"]
            options = texts[(d, row["n_chars"])]
            text = next(t for t in options if sha(want[(d, t)][0].encode()) == row["edited_sha256"])
            after, following = want[(d, text)]
            for value, other in ((row["near_edited"], after), (row["near_next"], following)):
                errors.append(abs(value - jaccard(shingles(text, 5), shingles(other, 5))))
            distinct = len(shingles(text, 5))
            assert row["n_shingles"] == pytest.approx(distinct, rel=0.25)
        assert sum(errors) / len(errors) < 0.02 and max(errors) < 0.15


def test_sketches_merge(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("part"), F.xxhash64("id").alias("h"))
    parts = df.groupBy("part").agg(fingerprints.bottom(F.collect_list("h"), 64).alias("s"))
    whole = df.agg(fingerprints.bottom(F.collect_list("h"), 64).alias("s")).first()["s"]
    merged = fingerprints.merge_groups(parts.withColumn("g", F.lit(1)), "s", "g", size=64).first()["s"]
    assert merged == whole
    estimate = spark.range(1).select(fingerprints.distinct_count(F.array(*map(F.lit, whole)), 64)).first()[0]
    assert estimate == pytest.approx(3000, rel=0.4)
    a, b = (df.where(F.col("id_") < n) for n in (0, 0)) if False else (parts.first()["s"], whole)
    share = spark.range(1).select(
        fingerprints.containment(F.array(*map(F.lit, a)), F.array(*map(F.lit, b)), 64)
    ).first()[0]
    assert 0.5 <= share <= 1


# N-gram join


def test_ngram_join(documents, rows, table):
    for df, own in ((documents, pairs(rows)), table):
        result = ngram_join.linked(df)
        assert found(result, "doc_id", "n_shingles", "component_id") == expected(linked(own))


def test_ngram_join_frequent_shingles_and_open_blocks(spark, monkeypatch):
    """Documents that share most of their shingles without being links, and chains of links, whatever the list."""
    draw = random.Random(3)
    shared = [f"s{i}" for i in range(60)]
    own = []
    for i in range(40):
        tail = [f"d{i // 2}-{k}" for k in range(draw.choice((3, 9, 12, 30)))]
        own.append((i, " ".join(shared + tail + ([f"odd{i}"] if i % 2 else []))))
    df = spark.createDataFrame(own, "doc_id bigint, text string")
    for count in (2, 16):
        monkeypatch.setattr(ngram_join, "COMMON_COUNT", count)
        assert found(ngram_join.linked(df), "doc_id", "n_shingles", "component_id") == expected(linked(own))
    monkeypatch.setattr(ngram_join, "COMMON_SHINGLES", 1)
    assert found(ngram_join.linked(df), "doc_id", "n_shingles", "component_id") == expected(linked(own))


def test_ngram_join_links_every_text_of_a_doc_id(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(20)) for k in "abcd")
    own = [(1, a), (3, b), (4, d), (5, a), (5, b), (5, c), (5, d), (6, "by itself")]
    df = spark.createDataFrame(own, "doc_id bigint, text string")
    assert found(ngram_join.linked(df), "doc_id", "n_shingles", "component_id") == expected(linked(own))


def test_one_of_each_keeps_columns(documents, rows):
    kept = ngram_join.one_of_each(documents)
    assert kept.columns == documents.columns
    component = {(d, n, c) for d, n, c in linked(pairs(rows))}
    gone = {d for d, _, c in component if c is not None and c != d}
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == sorted(
        (d or -1) for d, _ in pairs(rows) if d not in gone
    )


# Mixing


def test_targets_and_quotas(documents, rows, table):
    df, own = table
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    for frame, own, of in (
        (documents, pairs(rows), None),
        (df, own, source),
    ):
        result = mixing.mix(frame).collect()
        assert len(result) == len(own)
        sizes = {}
        for r in result:
            sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        assert sum(sizes.values()) == sum(len(words(t)) for _, t in own)
        want = targets(sizes)
        taken = {}
        for r in result:
            assert r["source_size"] == sizes[r["source"]]
            assert r["target"] == pytest.approx(want[r["source"]], abs=1e-4)
            assert 0 <= r["taken"] <= 2 * r["size"]
            taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        for name, words_taken in taken.items():
            assert abs(words_taken - want[name]) <= 0.01 * want[name] + 1


def test_apportionment(spark):
    draw = random.Random(8)
    for seats in (0, 1, 7, 100):
        votes = {f"p{i}": draw.choice((0, 1, 3, 50, 999, 12345)) + draw.random() for i in range(9)}
        df = spark.createDataFrame([("g", p, v, seats) for p, v in votes.items()], "g string, p string, v double, s bigint")
        result = {r["p"]: r["_seats"] for r in mixing.apportion(df, ["g"], "p", "v", "s").collect()}
        assert result == highest_quotients(votes, seats)


def test_mixed_texts_follow_the_plan(table):
    df, own = table
    text = dict(own)
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix(df).collect()}
    mixed = mixing.mixed_texts(df)
    assert mixed.columns == df.columns
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
        assert len(words(r["text"])) < len(words(text[r["doc_id"]])) or r["text"] == text[r["doc_id"]]
    assert got == {d: t for d, t in plan.items() if t}
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(df.repartition(3)).collect()}
    assert again == plan


def test_shards_share_a_source(table):
    df, _ = table
    total = {}
    for r in mixing.mix(df, shard_words=500, block_words=16).collect():
        size, target, taken = total.get(r["source"], (0, 0, 0))
        total[r["source"]] = (size + r["size"], r["target"], taken + r["taken"])
    for size, target, taken in total.values():
        assert abs(taken - target) <= 0.02 * target + 1


def test_small_sources_reach_their_targets(spark):
    draw = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(draw.randrange(200))), "big") for i in range(120)]
    rows += [(1_000 + i, " ".join("x" for _ in range(15)), f"small{i}") for i in range(20)]
    rows += [(2_000 + i, " ".join("y" for _ in range(1 + i % 40)), f"tail{i // 3}") for i in range(300)]
    rows += [(3_000 + i, "" if i % 2 else None, "nothing") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for share in (1.5, 0.4):
        total = {}
        for r in mixing.mix(df, share=share).collect():
            target, taken = total.get(r["source"], (0, 0))
            total[r["source"]] = (r["target"], taken + r["taken"])
        sizes = {}
        for _, text, source in rows:
            sizes[source] = sizes.get(source, 0) + len(words(text))
        want = targets(sizes, share=share)
        for name, (target, taken) in total.items():
            assert target == pytest.approx(want[name], abs=1e-4)
            assert abs(taken - target) <= max(1, 0.02 * target), name
        mixed = mixing.mixed_texts(df, share=share).groupBy("source").agg(F.sum(F.size(F.split("text", "[wxy]")) - 1))
        assert {r[0]: r[1] for r in mixed.collect()} == {name: taken for name, (_, taken) in total.items() if taken}


def plain_mix(rows, want, shard_words, block_words, seed=mixing.SEED, limit=2):
    """doc_id -> words taken: quotas by highest quotients, then blocks of a shard word by word."""
    def digest(text):
        return hashlib.md5(text.encode()).hexdigest()

    def name(source):
        return "" if source is None else f"={source}"

    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    seats = highest_quotients({name(s): want[s] for s in sizes}, int(sum(want.values()) + 0.5))
    out = {}
    for source, size in sizes.items():
        shards, n = {}, max(1, -(-size // shard_words))
        for doc_id, text, own in rows:
            if own == source:
                order = digest(f"{seed}:{doc_id}")
                shards.setdefault(int(order[:8], 16) % n, []).append((order, doc_id, len(words(text))))
        held = {shard: sum(k for _, _, k in docs) for shard, docs in shards.items()}
        quotas = highest_quotients(held, seats[name(source)]) if any(held.values()) else held
        for shard, docs in shards.items():
            total, quota = held[shard], min(quotas[shard], limit * held[shard])
            full, rest = divmod(quota, max(1, total))
            block = min(block_words, max(1, rest // mixing.LEAST_BLOCKS))
            n_blocks = max(1, min(total, int(total / block + 0.5)))
            picks = int(rest * n_blocks / max(1, total) + 0.5)
            start = int(digest(f"{seed}:{name(source)}:{shard}")[:8], 16) % n_blocks
            of_word = [b for b in range(n_blocks) for _ in range(total // n_blocks + (b < total % n_blocks))]
            picked = [(b * picks + picks + start) // n_blocks > (b * picks + start) // n_blocks for b in range(n_blocks)]
            at = 0
            for _, doc_id, k in sorted(docs):
                out[doc_id] = full * k + sum(picked[b] for b in of_word[at : at + k])
                at += k
    return out


@pytest.mark.parametrize("shard_words, block_words", [(1_000_000, 64), (300, 8), (50, 3)])
def test_blocks_are_picked_as_a_plain_version_does(spark, shard_words, block_words):
    draw = random.Random(7)
    rows = [(i, " ".join("w" for _ in range(draw.randrange(90))), draw.choice("aaab") + str(i % 2)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    result = mixing.mix(df, shard_words=shard_words, block_words=block_words)
    found = {r["doc_id"]: r["taken"] for r in result.collect()}
    assert found == plain_mix(rows, targets(sizes), shard_words, block_words)


def test_mixing_takes_any_column_names(spark):
    names = ["_words", "_quota", "_text", "_from", "_full", "_size", "_shard", "_rest", "own0", "own1"]
    rows = [(i, "some words of a text " * (i + 1), "ab"[i % 2], *names) for i in range(8)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    for result in (mixing.mix(df), mixing.mixed_texts(df)):
        assert [c for c in result.columns if c in df.columns] == df.columns
        assert {tuple(r[n] for n in names) for r in result.collect()} == {tuple(names)}


# Lines


def test_runs_are_not_shuffled(spark):
    """A batch meets the runs bucket by bucket: only its own keys move."""
    rows = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("line"), F.xxhash64("id").alias("h1"), F.hash("id").cast("bigint").alias("h2")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    runs = lines.LineRuns(spark, 3)
    try:
        for start in (0, 100, 200, 300):
            run = runs.write(lines.batch_state(rows.where(F.col("doc_id").between(start, start + 120)), runs))
            runs.settle(run)
        assert [len(level) for level in runs.levels] == [1, 1]
        state = lines.batch_state(rows.where("doc_id >= 350"), runs)
        plan = state._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 2 and plan.count("SortMergeJoin") == 2
        assert plan.count("Exchange hashpartitioning(h1") == 1
        known = {r["first"]: r["known"] for r in state.collect()}
        assert known == {i: i <= 420 for i in range(350, 500)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        runs.clear()


def test_batches_follow_the_bytes(documents):
    assert len(lines._bounds(documents, 4, 1 << 40)) == 3
    assert len(lines._bounds(documents, 4, 20_000)) > 3
    few, many = (
        sorted(tuple(r) for r in lines.dropped_lines(documents, batch_bytes=n).select("doc_id", F.array_sort("dropped")).collect())
        for n in (1 << 40, 20_000)
    )
    assert few == many and few


def test_line_dedup(documents, rows, table):
    for df, own in ((documents, pairs(rows)), table):
        for batches in (1, 4, 7):
            result = lines.line_digests(df, batches)
            assert found(result, "doc_id", "n_lines", "n_dropped", "kept_sha256") == expected(
                [(d, n, gone if d is not None else 0, s) for d, n, gone, s in line_dedup(own)]
            )


def test_lines_leave_no_runs_and_keep_columns(spark, documents):
    kept = lines.without_repeated_lines(documents)
    assert kept.columns == documents.columns
    assert kept.where("doc_id is null").count() == 2


# Substrings


def test_substring_dedup(documents, rows, table):
    for df, own in ((documents, pairs(rows)), table):
        result = substring.repeat_digests(df)
        assert found(result, "doc_id", "n_words", "n_removed", "kept_sha256") == expected(substring_dedup(own))


def test_substring_small_windows_and_columns(documents, rows):
    kept = substring.without_repeats(documents, 12)
    assert kept.columns == documents.columns
    want = {}
    for (d, text), (_, n, gone, digest) in zip(pairs(rows), substring_dedup(pairs(rows), 12)):
        if gone:
            want[(d, digest)] = True
    changed = {(r["doc_id"], sha(r["text"].encode())) for r in kept.collect() if r["text"] is not None}
    assert set(want) <= changed


def test_empty_tables(empty):
    assert repetition.repetition(empty).count() == 0
    assert fingerprints.compare_with_edited(empty).count() == 0
    assert ngram_join.linked(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_texts(empty).count() == 0
    assert lines.line_digests(empty).count() == 0
    assert lines.without_repeated_lines(empty).count() == 0
    assert substring.repeat_digests(empty).count() == 0
    assert substring.without_repeats(empty).count() == 0
    assert WORD.findall("") == []
