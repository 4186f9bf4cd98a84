"""The corpus pipeline: its stages against plain versions on planted rows."""

from __future__ import annotations

import base64
import random

import public_tokenizers
import pyarrow.parquet as pq
import tiktoken
from brute import jaccard, line_dedup, linked, sha, shingles, targets, words
from test_operators import SCHEMA, plain_mix

import corpus_pipeline
from beatgrid.llm import mixing
from beatgrid.llm.batches import BATCH_SIZE, GROUP_SIZE


def test_texts_are_encoded_in_small_batches(spark, monkeypatch):
    """The last stage runs by itself, with the setting that its batches need, and leaves the caller's setting alone."""
    before, seen = spark.conf.get(BATCH_SIZE), []
    write = corpus_pipeline.materialize

    def watched(df, name):
        seen.append(spark.conf.get(BATCH_SIZE))
        return write(df, name)

    monkeypatch.setattr(corpus_pipeline, "materialize", watched)
    docs = spark.createDataFrame([(1, "one two", "en", "a", 7), (2, None, "en", "a", None)], SCHEMA)
    found = corpus_pipeline.encode_texts(spark, docs, "")
    assert seen == ["4m"] and spark.conf.get(BATCH_SIZE) == before
    assert [r["n_tokens"] for r in found.orderBy("doc_id").collect()] == [2, 0]


def test_encoded_texts_lie_in_small_row_groups(spark):
    """A task that writes or rereads the ids holds a row group of a few MB, not all that it encodes."""
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefghij 0123456789", k=20_000)) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    found = corpus_pipeline.encode_texts(spark, docs, "")
    groups = []
    for path in found.inputFiles():
        parts = pq.ParquetFile(path.removeprefix("file://")).metadata
        groups += [parts.row_group(i).total_byte_size for i in range(parts.num_row_groups)]
    assert len(groups) > 1 and max(groups) < 12 << 20
    assert spark.conf.get(GROUP_SIZE, None) is None and found.count() == len(texts)


def test_near_duplicates_between_both_contracts(spark):
    """100 words with the last 9 replaced: 0.81 or more by five words, below 0.85 by four."""
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base), " ".join(base[:-9] + [f"new{i}" for i in range(9)]), " ".join(f"o{i}" for i in range(100))]
    five, four = (jaccard(shingles(texts[0], n), shingles(texts[1], n)) for n in (5, 4))
    assert five >= 0.8 and four < 0.85
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], SCHEMA)
    kept = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def _planted():
    """Documents with toxic words, shared lines, near copies and sources of all sizes, and their labels."""
    draw = random.Random(12)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "ra", "lo", "ne", "mi")]
    vile = ["trash", "scum", "moron", "vermin"]

    def prose(n):
        return "\n".join(" ".join(draw.choices(vocabulary, k=12)) for _ in range(n))

    texts, toxic = [], set()
    for i in range(240):
        text = prose(draw.randrange(3, 9))
        if i % 6 == 0:
            parts = text.split(" ")
            for word in draw.sample(vile, 3):
                parts.insert(draw.randrange(len(parts)), word)
            text = " ".join(parts)
            toxic.add(i)
        texts.append(text)
    footer = "this very line stands under many documents of the corpus"
    texts += [prose(4) + "\n" + footer for _ in range(20)] + [footer]
    base = prose(1).replace("\n", " ") + " " + " ".join(draw.choices(vocabulary, k=200))
    for i in range(12):
        words_ = base.split(" ")
        words_[5 * i] = f"edit{i}"
        texts.append(" ".join(words_))
    texts += [texts[-1], None, "", "one", "İstanbul 'tis   été\n\n\x1c #1 " * 3]
    documents = [(i, t, "en", ["big", "big", "big", "mid", None, f"tail{i % 40}"][i % 6], len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, 1, int(i in toxic)) for i in range(240) if i % 4]
    return documents, labels, toxic


def test_every_stage_against_a_plain_version(spark, tmp_path):
    documents, labels, toxic = _planted()
    spark.createDataFrame(documents, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    schema = "doc_id bigint, quality int, toxic int"
    spark.createDataFrame(labels, schema).write.parquet(str(tmp_path / "labels.parquet"))
    docs, folder = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)

    def after(name):
        stages[name](spark, docs, folder).write.parquet(str(tmp_path / name))
        result = spark.read.parquet(str(tmp_path / name))
        assert result.columns == docs.columns
        return result, [(r["doc_id"], r["text"], r["source"]) for r in result.collect()]

    docs, rows = after("toxicity")
    assert {d for d, _, _ in rows} == {d for d, *_ in documents} - toxic

    before = [(d, t) for d, t, _ in rows]
    docs, rows = after("line_dedup")
    plain = {d: (n, gone, digest) for d, n, gone, digest in line_dedup(before)}
    assert {d for d, _, _ in rows} == {d for d, (n, gone, _) in plain.items() if gone < n}
    for d, text, _ in rows:
        assert sha((text or "").encode()) == plain[d][2]

    before = [(d, t) for d, t, _ in rows]
    docs, rows = after("ngram_join")
    groups: dict = {}
    for (d, _, component) in linked_with_text(before):
        groups.setdefault(component, []).append(d)
    assert len(rows) == len(groups) and {d for d, _, _ in rows} == {min(own) for own in groups.values()}

    before, sizes = [(d, t, s) for d, t, s in rows], {}
    for _, text, source in before:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    docs, rows = after("mixing")
    wanted = plain_mix(before, targets(sizes), mixing.SHARD_WORDS, mixing.BLOCK_WORDS)
    taken: dict = {}
    for d, text, _ in rows:
        taken[d] = taken.get(d, 0) + len(words(text))
    assert {d: n for d, n in taken.items() if n} == {d: n for d, n in wanted.items() if n}

    encoded = stages["byte_bpe"](spark, docs, folder).collect()
    assert len(encoded) == len(rows)
    with open(corpus_pipeline.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = sorted((d, library.encode_ordinary(t or "")) for d, t, _ in rows)
    assert sorted((r["doc_id"], list(r["ids"])) for r in encoded) == own
    assert sorted((r["doc_id"], list(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect()) == own


def linked_with_text(rows):
    """(doc_id, set size, component) by the contract of near-duplicate stages."""
    return linked(rows, percent=corpus_pipeline.NEAR_PERCENT, length=corpus_pipeline.NEAR_WORDS)


def test_odd_rows_and_names(spark, tmp_path):
    """Nulls, repeated rows, an empty table and columns named like helpers go through without a crash."""
    names = ["_p", "_body", "_dropped", "_words", "_quota", "_text", "own0", "kept", "ids2"]
    rows = [(None, None, None, None, None, *names), (1, "a b c d e f\nsame line of text", "en", "s", 9, *names)]
    rows += [(2, "same line of text", "en", "s", 9, *names)] * 2 + [(None, "same line of text", "en", None, 1, *names)]
    schema = SCHEMA + "".join(f", `{name}` string" for name in names)
    documents = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (documents, documents.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == documents.columns, name
            assert all(tuple(r[n] for n in names) == tuple(names) for r in docs.collect()), name
        found = corpus_pipeline.encode_texts(spark, docs, str(tmp_path))
        assert {"ids", "offsets", "n_tokens", *names} <= set(found.columns)
        found.collect()
