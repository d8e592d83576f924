"""Long runs, repeated rows and clashing names in the training-text operators."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from tallgrass.llm import bpe, exact_dedup, language, url_filter
from tallgrass.llm.names import free_names
from tallgrass.llm.queries import vocabulary


def test_cross_parsing_of_long_texts_equals_greedy_matching(spark):
    rng = np.random.default_rng(1)
    samples = {"x": "".join(rng.choice(list("abcd "), 400)), "y": "".join(rng.choice(list("abce "), 400))}
    whole = samples["x"].strip()
    texts = ["".join(rng.choice(list("abcde "), n)) for n in (3000, 1500, 700, 5, 0)] * 9 + [whole, whole * 3]

    def greedy(text, sample):
        """Phrases: each goes on while it occurs in the sample."""
        sample, text = " ".join(sample.split()), " ".join(text.split())
        count, at = 0, 0
        while at < len(text):
            end = at
            while end < len(text) and text[at:end + 1] in sample:
                end += 1
            count, at = count + 1, max(end, at + 1)
        return count

    parser = language.CrossParser(samples)
    got, _ = parser.phrases(texts)
    want = np.array([[greedy(t, samples[k]) for k in parser.languages] for t in texts])
    # spaces round a text and the phrase that is still open at its end count one at most
    assert np.abs(got - want).max() <= 1
    # one match from end to end is one phrase, however long
    assert got[-2][0] <= 1


def test_sample_is_shared_by_the_documents(spark, monkeypatch):
    monkeypatch.setattr(language, "TRAIN_CHARS", 80)
    long = "a" * 5000 + "z" * 5000
    docs = spark.createDataFrame([(1, long, "en"), (2, "short one", "en"), (3, "other", "en"), (4, None, "en"), (5, "x", None)], "doc_id long, text string, lang string")
    got = language.labelled_sample(docs)
    assert set(got) == {"en"} and "short one" in got["en"] and "other" in got["en"]
    assert got["en"].count("a") == got["en"].count("z") > 10 and len(got["en"]) <= 80 + 8


@pytest.mark.parametrize("few", [0, 1 << 30])
def test_merging_one_by_one_equals_the_library(few, monkeypatch):
    monkeypatch.setattr(bpe, "FEW_ROWS", few)
    library = tokenizers.Tokenizer.from_str(vocabulary())
    library.no_truncation()
    library.no_padding()
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdeinorst"), n)) for n in (1, 2, 3, 17, 64, 65, 900)] + ["a" * 700, "\u00e9\u65e5" * 90, "", "=" * 333, "8" * 129]
    got = bpe.BytePairCodec(vocabulary()).encode(texts)
    assert [np.frombuffer(g, np.uint32).tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_very_long_pretoken_is_quick():
    codec = bpe.BytePairCodec(vocabulary())
    word = "".join(np.random.default_rng(3).choice(list("abcdefghijklmnopqrstuvwxyz"), 80_000))
    begin = time.process_time()
    flat, _, count = codec.merge(pa.array([word]))
    assert time.process_time() - begin < 10
    assert b"".join(codec.token_bytes[i] for i in flat[:count[0]]) == word.encode()


def brute_templates(shapes):
    """Template by shape of one host: a node at a time, from the root down."""
    out = {}

    def walk(node, below):
        children = {}
        for shape, n, rest in below:
            children.setdefault(rest[0], []).append((shape, n, rest[1:]))
        whole = sum(n for _, n, _ in below)
        rare = [c for c, rows in children.items() if sum(n for _, n, _ in rows) < url_filter.RARE_SHARE * whole]
        if len(rare) >= url_filter.CHILDREN:
            for c in rare:
                rows = children.pop(c)
                children.setdefault("*", []).extend(rows)
        for part, rows in children.items():
            name = part if node is None else node + "/" + part
            going = [r for r in rows if r[2]]
            out.update({shape: name for shape, _, rest in rows if not rest})
            if going:
                walk(name, going)

    walk(None, [(s, n, s.split("/")) for s, n in shapes])
    return out


def test_templates_equal_a_walk_down_the_tree(spark):
    rng = np.random.default_rng(4)
    word = lambda n: "w" + "abcdefghijklmnopqrstuvwxyz"[rng.integers(n)] + "abcdefghijklmnopqrstuvwxyz"[rng.integers(n)]
    paths = {f"/user/{word(6)}/{word(9)}" for _ in range(300)} | {f"/{word(2)}/{word(3)}" for _ in range(60)} | {"", "/", "/user", "/user/wz/", "/a//b"}
    shapes = [(p, int(rng.integers(1, 4))) for p in sorted(paths)]
    table = spark.createDataFrame([("h", p, n, 0, 0) for p, n in shapes], "host string, shape string, n long, labelled long, blocked long")
    got = {r["shape"]: r["template"] for r in url_filter.templates(table).collect()}
    assert got == brute_templates(shapes)
    assert "/user/*/*" in got.values()
    assert url_filter.templates(table.where("n < 0")).count() == 0


def test_repeated_urls_change_no_verdict(spark):
    slugs = [f"s{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rules = {f"h.io/{s}/": "block" for s in slugs[:40]} | {f"k.io/{s}/": "allow" for s in slugs[:40]}
    urls = [f"http://{h}.io/{s}/v" for h in "hk" for s in slugs]
    for times in (1, 10):
        table = spark.createDataFrame(list(enumerate(urls * times)), "page_id long, url string")
        got = {(r["host"], r["verdict"]) for r in url_filter.judge_urls(table, rules).collect()}
        assert got == {("h.io", "block"), ("k.io", "allow")}


def test_copies_without_ids_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 4)
    rows = [(None, "same  text")] * 60 + [(7, "same text")] * 60 + [(3, "other")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = exact_dedup.exact_duplicates(table).collect()
    same = [r for r in got if r["group_size"] == 120]
    assert len(got) == 121 and len(same) == 120 and {r["keep_id"] for r in same} == {7} and sum(r["kept"] for r in same) == 1


def test_columns_with_the_names_of_helpers_stay(spark):
    names = ["_sha", "_kept_id", "_kept_sha", "_SHA_1"]
    table = spark.createDataFrame([(1, "a", "p", "q", "r", "s"), (2, "a", "p", "q", "r", "s"), (3, "b", None, "q", "r", "s")], ["doc_id", "text", *names])
    got = exact_dedup.keep_first(table)
    assert got.columns == table.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]
    assert got.where(F.col("_sha") == "p").count() == 1
    assert free_names(table, "sha", "row") == ["_sha_2", "_row"]


def test_stages_keep_columns_of_any_name_and_take_empty_tables(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    folder = "/root/testdata/sf0.001"
    extra = ["_score", "_lang", "_certainty", "_sha", "_row", "_id", "_y"]
    docs = spark.read.parquet(folder + "/documents.parquet").limit(40)
    for name in extra:
        docs = docs.withColumn(name, F.lit(name))
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns and kept.count() > 20
        assert stage(spark, docs.where("doc_id is null"), folder).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs.where("doc_id is null"), folder).count() == 0
