"""The corpus operators against brute force, libraries, round trips and held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallgrass.llm import bpe, exact_dedup, html_template, language, lm_score, mtree, near_join, packing, toxicity, url_filter
from tallgrass.llm.queries import URL_RULES, vocabulary
from tallgrass.llm.shingles import Shingler

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, norm string, digest string, salt long, key long, host string"


def awkward():
    """Nulls, empty, blank and very long texts, ties, repeated rows and ids, other writing."""
    rng = random.Random(3)
    words = ["alpha", "Beta", "gämma", "delta,", "x", "12", "日本", "it's"]
    texts = [None, "", " ", "\n\t", "a", "a", "A", "a b", "a\tb", "a  b", "a b c", "a b d", "1 2 3 --", "<|endoftext|> x", "\x00 y", "z" * 5000]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += [" ".join(rng.choice(words) for _ in range(20_000))] * 2
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "a"), (7, "a b"), (None, "a"), (None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "n", "d", 1, 2, "h") for i, t in awkward()], DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_every_operator_takes_an_empty_table(spark, empty):
    model = toxicity.train([], [], 0.0)
    vocab = vocabulary()
    assert packing.pack_documents(empty, vocab).count() == 0
    assert bpe.encode_documents(empty, vocab).count() == 0
    assert toxicity.score_toxicity(empty, model).count() == 0
    assert language.identify(empty, language.labelled_sample(empty, lang_col="host")).count() == 0
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.keep_first(empty).columns == empty.columns
    assert lm_score.backoff_scores(empty).count() == 0
    assert near_join.near_groups(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string, host string")
    assert html_template.extract_main_text(pages).count() == 0
    assert url_filter.judge_urls(pages, URL_RULES).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mtree.top_products(vectors, lambda i: i % 50 == 0).count() == 0


def test_encoding_equals_the_library_and_decodes(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in awkward():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    got = Counter((r.doc_id, tuple(np.frombuffer(bytes(r.token_ids), "<u4").tolist()), r.decoded) for r in bpe.encode_documents(docs, vocabulary()).collect())
    assert got == want


def test_encoding_of_random_white_space():
    import public_tokenizers
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(1)
    letters = "ab' \n\t é1٣²_.<|日　 \x0b\x1f"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for codec in (bpe.BytePairCodec(vocabulary()), packing.PieceTokenizer(vocabulary())):
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == want


def test_best_fill_is_the_closest_sum():
    rng = random.Random(2)
    for _ in range(100):
        items = Counter(rng.randint(1, 40) for _ in range(rng.randint(0, 9)))
        room = rng.randint(0, 90)
        sums = {0}
        for n in items.elements():
            sums |= {s + n for s in sums}
        chosen = packing.best_fill(items, room)
        assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= room)
        assert all(c <= items[n] for n, c in chosen.items())


def test_packing_holds_every_token_once(docs):
    rows = packing.pack_documents(docs, vocabulary(), size=64).collect()
    codec = bpe.BytePairCodec(vocabulary())
    want = Counter((i, codec.encode([t or ""])[0] + b"\1\0\0\0") for i, t in awkward())
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.token_ids) > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, bytes(r.token_ids)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0
    for (i, ids), n in want.items():
        if n == 1 and i is not None and sum(1 for j, _ in awkward() if j == i) == 1:
            assert b"".join(x for _, x in sorted(pieces[i, len(ids) // 4])) == ids
    assert sum(len(ids) // 4 * n for (_, ids), n in want.items()) == sum(r.length for r in rows)


def test_exact_duplicates_against_brute_force(docs, monkeypatch):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in awkward()]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    want = Counter()
    for t, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        for k, i in enumerate(order):
            want[i, order[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()] += 1
    for hot in (exact_dedup.HOT_ROWS, 1):  # with 1, every group of copies is salted
        monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot)
        assert Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()) == want
    assert exact_dedup.keep_first(docs).count() == len(groups)


def brute_components(rows, width, num, den):
    sets, parent = {}, {}
    for i, text in rows:
        x = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        sets[i] = {tuple(x[j:j + width]) for j in range(len(x) - width + 1)} if len(x) >= width else {tuple(x)} if x else set()
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    texts = ["", None, "a", "a b", "A B", "a b c"] + ["x y z"] * 20
    for size in (30, 150):
        for _ in range(2):
            base = [rng.choice(words) for _ in range(size)]
            for _ in range(30):
                share = rng.choice([0, 0.005, 0.01, 0.02, 0.04])
                texts.append(" ".join(rng.choice(words) if rng.random() < share else w for w in base))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("edges", [near_join.TASK_EDGES, 20])
def test_near_groups_against_brute_force(spark, monkeypatch, edges):
    monkeypatch.setattr(near_join, "TASK_EDGES", edges)
    rows = near_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    width, num = (3, 90) if edges > 20 else (5, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_join.near_groups(table, width, num, 100).collect()}
    assert got == brute_components(rows, width, num, 100)


def test_near_groups_compare_all_pairs_in_the_end(spark, monkeypatch):
    # centre c, c-y and x-y are links, c-x is just below the threshold but passes the sketch; c has the
    # smallest key, and is the centre as it meets the other centres under a signature of their own
    mark = Shingler(1).sets(["mark"])[0][0]

    class SmallestElement:
        def __init__(self, num, den):
            pass

        def signatures(self, sets, count):
            each = np.split(sets, np.cumsum(count)[:-1])
            marked = [k for k, x in enumerate(each) if mark in x]
            return np.array([x.min() for x in each] + [7] * len(marked), np.uint64), np.array([*range(len(count)), *marked])

    monkeypatch.setattr(near_join, "PartEnum", SmallestElement)
    rng, rows = random.Random(8), []
    while len(rows) < 30:
        w = ["mark"] + [f"w{rng.randrange(10 ** 9)}" for _ in range(44)]
        c, y, x = w[:40], w[2:42], w[5:45]
        sets, count = Shingler(1).sets([" ".join(t) for t in (c, y, x)])
        c_set, y_set, x_set = np.split(sets, np.cumsum(count)[:-1])
        keys = near_join._keys(sets, count, 0)
        marks = [near_join.sketch(t, near_join.sketch_words(40)).tobytes() for t in (c_set, x_set)]
        if len({s.min() for s in (c_set, y_set, x_set)}) == 1 and keys[0] == keys.min() and near_join._may_link(marks[0], 40, marks[1], 40, 80, 100):
            rows += [(len(rows) + k, " ".join(t)) for k, t in enumerate((c, y, x))]
    got = {r.doc_id: r.component_id for r in near_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80, 100).collect()}
    assert got == {i: i - i % 3 for i, _ in rows}


def test_near_groups_of_awkward_rows(docs):
    rows = near_join.near_groups(docs, 3, 90, 100).collect()
    assert len(rows) == len(awkward())
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert all(r.component_id == r.doc_id for r in rows if r.n_shingles == 0)


@pytest.mark.parametrize("sampled", [0.1, 1.5, 100])
def test_near_groups_with_any_sample(spark, monkeypatch, sampled):
    monkeypatch.setattr(near_join, "SAMPLED", sampled)
    rows = near_rows() + [(10 ** 6 + k, " ".join(f"own{k} own{j}" for j in range(50))) for k in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_join.near_groups(table, 5, 80, 100).collect()}
    assert got == brute_components(rows, 5, 80, 100)


def test_texts_that_share_a_passage_are_not_held(spark, monkeypatch):
    held, cut = [], near_join.cut_lineage

    def counting(df):
        out = cut(df)
        if "elements" in out.columns:
            held.append(out.count())
        return out

    monkeypatch.setattr(near_join, "cut_lineage", counting)
    rng = random.Random(3)
    passage = " ".join(f"p{j}" for j in range(60))
    rows = [(k, " ".join([passage, *(f"w{rng.randrange(10 ** 9)}" for _ in range(340))])) for k in range(60)]
    rows.append((100, rows[7][1] + " end"))
    got = {r.doc_id: r.component_id for r in near_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 7 if i == 100 else i for i, _ in rows}
    assert held == [2]


def test_pieces_do_not_depend_on_the_slices(spark, monkeypatch):
    rows = [(k, " ".join(f"word{(k * 7 + j) % 50}" for j in range(k * 5))) for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seen = []
    for chars in (packing.SLICE_CHARS, 500):
        monkeypatch.setattr(packing, "SLICE_CHARS", chars)
        seen.append(sorted(tuple(r) for r in packing.pack_documents(table, vocabulary()).collect()))
    assert len(seen[0]) >= 60 and seen[0] == seen[1]


def test_meeting_tells_what_it_leaves_out():
    x = np.arange(40, dtype=np.uint64)
    members = [{"key": k, "component": k % 2, "n": 40, "sketch": near_join.sketch(x, near_join.sketch_words(40)).tobytes()} for k in range(10)]
    block = pa.array(members)
    a, b, cut = near_join._meeting(block, block, 80, 100, False)
    assert len(a) == 1 and (a[0] + b[0]) % 2 and cut
    a, b, cut = near_join._meeting(block, block, 80, 100, True)
    assert sorted(zip(a, b)) == [(i, j) for i in range(10) for j in range(i + 1, 10) if (i + j) % 2] and not cut
    a, b, cut = near_join._meeting(block[:4], block[4:8], 80, 100, False)
    assert len(a) == 8 and not cut


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(0)
    for num, den in ((9, 10), (8, 10)):
        for n in (3, 12, 60, 400):
            for _ in range(20):
                a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
                b = a[rng.random(len(a)) >= 0.08 * rng.random()]
                both = len(np.intersect1d(a, b))
                if len(b) == len(a) or den * both < num * (len(a) + len(b) - both):
                    continue
                sig, owner = near_join.PartEnum(num, den).signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
                assert set(sig[owner == 0]) & set(sig[owner == 1])


def test_shingles_do_not_depend_on_the_place():
    texts = ["", "b", "a b c d a b c", "x a b c d a b c", "A B c\td A\nB c"]
    sets, count = Shingler(3).sets(texts)
    parts = np.split(sets, np.cumsum(count)[:-1])
    assert count.tolist() == [0, 1, 4, 5, 4] and set(parts[2]) == set(parts[4]) and set(parts[2]) < set(parts[3])


def test_cross_parsing_against_brute_force():
    rng = random.Random(4)
    samples = {k: "".join(rng.choice(k + " ") for _ in range(300)) for k in ("abcd", "cdef", "aefé")}
    parser = language.CrossParser(samples)

    def phrases(sample, text):
        s, t, n, at = parser._plain(sample), parser._plain(text), 0, 0
        while at < len(t):
            size = 1
            while at + size <= len(t) and t[at:at + size] in s:
                size += 1
            at, n = at + max(1, size - 1), n + 1
        return n

    texts = ["".join(rng.choice("abcdefé  1") for _ in range(rng.randint(0, 200))) for _ in range(40)]
    got, _ = parser.phrases(texts)
    # (a space at an end of the text is part of the last phrase or one of its own)
    assert all(abs(got[k, j] - phrases(samples[name], t)) <= 1 for k, t in enumerate(texts) for j, name in enumerate(parser.languages))


def test_language_of_awkward_rows(docs):
    rows = language.identify(docs, {"en": "alpha beta delta", "ja": "日本 日本"}).collect()
    assert len(rows) == len(awkward())
    assert all((r.lang_pred == "und") == (r.score == 0.0) for r in rows)
    nothing = {i for i, t in awkward() if i is not None and not any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in rows if r.lang_pred == "und" and r.doc_id is not None} == nothing


def test_held_out_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from pyspark.sql import functions as F
    from tallgrass.llm.queries import fold

    samples = language.labelled_sample(docs.where(fold(F.col("doc_id"), 4) != 2))
    got = language.identify(docs, samples).join(docs.select("doc_id", "lang"), "doc_id").where(fold(F.col("doc_id"), 4) == 2)
    assert got.where("lang_pred = lang").count() >= 0.95 * got.count()


def test_toxicity_is_learned():
    rng = random.Random(6)
    parts = ["tha", "ner", "ing", "sto", "wel", "ber", "cha", "mon", "rit", "dal"]
    def text(bad):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(150)]
        for _ in range(bad):
            words[rng.randrange(150)] = rng.choice(["zqxvillain", "wretchkopf"])
        return " ".join(words)
    model = toxicity.train([text(5) for _ in range(90)], [text(0) for _ in range(300)], 0.2)
    compressors = model.compressors()
    score = lambda t: float(model.score(np.array([toxicity._inputs(toxicity.saved_bytes(t, compressors))]))[0])
    assert sum(score(text(5)) >= 0.5 for _ in range(30)) >= 27 and sum(score(text(0)) >= 0.5 for _ in range(30)) <= 3
    assert 0 <= score("") < 0.5


def test_toxicity_of_awkward_rows(docs):
    rows = toxicity.score_toxicity(docs, toxicity.train([], ["a b c"], 0.1)).collect()
    assert len(rows) == len(awkward()) and all(abs(r.score - 0.1) < 1e-9 for r in rows)


PAGE = (
    '<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">{0}</a></li></ul></nav>'
    '<div class="cookie-notice">We use cookies</div><div class="ad">Buy {0}</div>{1}<form>Name</form><footer>&copy; {0}</footer></body></html>'
)


def test_main_text(spark):
    article = "<article><h1>Head &amp; {0}</h1><p>One <b>two</b>\n three<br><p>Four<script>x</script> five<aside>side</aside></article><section id=comments><p>no</p></section>"
    plain = "<div class='content'><p>Long story {0} that goes on and on</p><p>More of it {0}</p></div><div class='x'>short</div>"
    rows = [(i, "http://a.org/%d" % i, PAGE.format(i, article.format(i))) for i in range(10)]
    rows += [(100 + i, "http://b.org/%d" % i, PAGE.format(i, plain.format(i))) for i in range(10)]
    rows += [(200, None, None), (201, "x", ""), (202, "http://c.org", "<p>alone"), (None, "http://c.org", "<!-- c --><article>a&nbsp; b<p>c")]
    table = spark.createDataFrame([(*r, "h", "m") for r in rows], "page_id long, url string, html string, host string, main string")
    got = {r.page_id: r.text for r in html_template.extract_main_text(table).collect()}
    for i in range(10):
        assert got[i] == f"Head & {i}\nOne two three\nFour five"
        assert got[100 + i] == f"Long story {i} that goes on and on\nMore of it {i}"
    assert (got[200], got[201], got[202], got[None]) == ("", "", "alone", "a b\nc")


def test_url_rules(spark):
    urls = [
        "http://A.example.net/en/1", "https://x.net/", "https://x.net", "http://example.com/de/", "http://notexample.com/de/1", "http://b.org/fr/2?x",
        "b.org/fr/2", None, "", "http://u@c.org?q", "http://net/x#y", "a://b.net/en/://c.org/fr/",
    ]
    table = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(urls)] * 2, "page_id long, url string, rule string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(table, URL_RULES).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[1] == ("x.net", "/", "net/", "block")
    assert got[2] == ("x.net", "", None, "allow") and got[3] == ("example.com", "/de/", "example.com/de/", "block")
    assert got[4][2] is None and got[5] == ("b.org", "/fr/2", "org/fr/", "allow")
    assert got[6] == got[7] == got[8] == ("", "", None, "allow") and got[9] == ("u@c.org", "", None, "allow")
    assert got[10] == ("net", "/x", "net/", "block") and got[11] == ("b.net", "/en/://c.org/fr/", "net/", "block")


def test_url_templates_take_over_from_labels(spark):
    # the rule covers /bad/; siblings under a wildcard share its template
    urls = [f"http://h.io/s{chr(97 + i % 26)}{chr(97 + i // 26)}/v" for i in range(60)]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = {f"h.io/s{chr(97 + i % 26)}{chr(97 + i // 26)}/": "block" for i in range(40)}
    assert {r.verdict for r in url_filter.judge_urls(table, rules).collect()} == {"block"}
    assert {r.verdict for r in url_filter.judge_urls(table, {"h.io/sa": "block"}).where("rule is null").collect()} == {"allow"}


def test_top_products_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mtree, "SUBTREE_ROWS", 64)
    monkeypatch.setattr(mtree, "PAGE_ROWS", 8)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)]  # one common vector: ties
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2050, [float("inf")] * 6), (None, rows[1][1]), (2100, [0.0] * 6), (2101, [1.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, tree int").repartition(4)
    q = {i: np.floor(256 * np.pad(np.array(v, np.float32).astype(float), (0, 6 - len(v)))).astype(int) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = set()
    for i in q:
        if i % 50 == 0:
            best = sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:5]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert {tuple(r) for r in mtree.top_products(table, lambda i: i % 50 == 0).collect()} == want


def test_backoff_scores_of_awkward_rows(docs):
    rows = lm_score.backoff_scores(docs).collect()
    assert len(rows) == len({i for i, _ in awkward()})
    assert all((r.score is None) == (r.n_words == 0) for r in rows)


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    kept = {r.doc_id for r in pipeline.run(spark, SMALL).select("doc_id").distinct().collect()}
    assert kept < ids and len(kept) >= 0.5 * len(ids)
    texts = [r.text for r in docs.collect() if r.doc_id in kept]
    assert len(set(texts)) == len(texts) and all(any(c.isalpha() for c in t) for t in texts)


def test_fold_is_the_crc_of_the_id(spark):
    from pyspark.sql import functions as F
    from tallgrass.llm.queries import fold

    got = {r.id: r.f for r in spark.range(20).withColumn("f", fold(F.col("id"), 5)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(20)}


def test_pipeline_stages_reject_rows_not_ids(spark, monkeypatch):
    import corpus_pipeline as pipeline

    rng = random.Random(7)
    parts = ["tha", "ner", "ing", "sto", "wel", "ber", "cha", "mon", "rit", "dal"]
    def text(bad):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(150)]
        for _ in range(bad):
            words[rng.randrange(150)] = rng.choice(["zqxvillain", "wretchkopf"])
        return " ".join(words)
    model = toxicity.train([text(5) for _ in range(90)], [text(0) for _ in range(300)], 0.2)
    compressors = model.compressors()
    score = lambda t: float(model.score(np.array([toxicity._inputs(toxicity.saved_bytes(t, compressors))]))[0])
    bad, good = next(t for t in iter(lambda: text(8), "") if score(t) >= 0.5), next(t for t in iter(lambda: text(0), "") if score(t) < 0.5)
    monkeypatch.setattr(toxicity, "learn", lambda *_: model)
    monkeypatch.setattr(pipeline, "load_table", lambda *_: None)
    rows = [(None, bad, "en"), (None, good, "en"), (1, bad, "en"), (1, good, "en"), (None, "", "en"), (1, None, "en"), (2, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = pipeline.drop_toxic(spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter(tuple(r) for r in kept.collect()) == Counter(r for r in rows if r[1] != bad)
    kept = pipeline.drop_undetermined(spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter(tuple(r) for r in kept.collect()) == Counter(r for r in rows if r[1])


def test_toxicity_is_learned_from_whole_texts(spark):
    rng = random.Random(9)
    parts = ["tha", "ner", "ing", "sto", "wel", "ber", "cha", "mon", "rit", "dal"]
    def text(bad):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(1300)]
        return " ".join(words + ["zqxvillain wretchkopf"] * bad + [rng.choice(parts)])
    rows = [(i, text(3 * (i % 4 == 0)), int(i % 4 == 0)) for i in range(160)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert min(t.find("zqxvillain") for _, t, y in rows if y) > 6000
    from pyspark.sql import functions as F

    model = toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.lit(True))
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score_toxicity(table, model).collect()}
    assert sum(got[i] == bool(y) for i, _, y in rows) >= 150


@pytest.mark.parametrize("least", [1, 2, 3])
def test_backoff_scores_equal_brute_force(spark, least):
    """Blocks of a few words, so every n-gram's count comes from many blocks; unseen pairs do back off."""
    rows = awkward()
    said = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]) for i, t in rows]
    ones = Counter(w for _, words in said for w in words)
    twos = Counter(p for _, words in said for p in zip(words, words[1:]))
    total, want = sum(ones.values()), defaultdict(lambda: [0, 0, 0.0])
    for i, words in said:
        found = want[i]
        for k, w in enumerate(words):
            seen = k > 0 and twos[words[k - 1], w] >= least
            found[0] += 1
            found[1] += k > 0 and not seen
            found[2] += np.log(twos[words[k - 1], w] / ones[words[k - 1]]) if seen else np.log((0.4 if k else 1) * ones[w] / total)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    scored = lm_score.backoff_scores(docs, least=least, block_words=40)
    got = {r.doc_id: (r.n_words, r.n_backoff, r.score) for r in scored.collect()}
    assert got.keys() == want.keys()
    for i, (n, back, value) in want.items():
        assert got[i][:2] == (n, back)
        assert got[i][2] == (pytest.approx(value / n, abs=1e-9) if n else None)
    assert sum(back for _, back, _ in want.values()) > 0 or least == 1
    # no join of all word occurrences with the counts, as none of it is needed to tell what backs off
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
