"""The text operators against brute force, the libraries, exact round trips and held-out labels."""

import hashlib
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from encore.llm import (
    components,
    decontamination,
    license_scan,
    lm_scoring,
    near_dedup,
    quality_classifier,
    quality_rules,
    queries,
    sentencepiece_codec,
    token_shards,
    toxicity,
    url_filters,
)
from encore.llm.common import id_bucket
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string"
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack . "


def odd_rows():
    """Nulls, empty and blank texts, a very long text, repeated rows, ties and clashing columns."""
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
    texts = [None, "", " \n\t ", "one", "one two three four", PROSE * 5, PROSE * 5, long, long + " tail", "a\n\na\n a \nb", "😀 日本語 ▁ x"]
    rows = [(i, t, "en", None, None, "s", "w") for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, PROSE, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def lower_words(text):
    return WORD.findall((text or "").translate(LOWER))


# -- 1 -------------------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) for k in range(3) if c[tuple(w[i : i + 3])] > 1}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts_match_brute_force(spark, odd):
    for docs in (odd, spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        got = quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
        want = sorted((r["doc_id"] is None, r["doc_id"], *base_counts(r["text"])) for r in docs.collect() if r["doc_id"] is not None)
        assert sorted((False, *r) for r in got if r["doc_id"] is not None) == want


def test_quality_rules_drop_lines_then_documents(spark):
    good = "\n".join(f"Proper{i} sentence{i} number{i} with{i} some{i} words{i}, ending{i} well{i}." for i in range(12))
    mixed = good + "\nHome | News | About | Contact\nAll rights reserved.\nBUY!! NOW!! CHEAP!!"
    junk = "\n".join(f"Home | a{i} | b{i} | c{i} | d{i} | e{i} | f{i}" for i in range(12))
    docs = spark.createDataFrame([(1, good, 0), (2, mixed, 0), (3, junk, 0), (4, None, 0)], "doc_id bigint, text string, n_chars bigint")
    out = {r["doc_id"]: r for r in quality_rules.clean(docs).collect()}
    assert set(out) == {1, 2} and out[1]["text"] == good == out[2]["text"] and out[2]["n_chars"] == len(good)
    rows = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert (rows[2]["n_navigation_lines"], rows[2]["n_boilerplate_lines"], rows[2]["n_punctuation_lines"]) == (1, 1, 1)
    assert not rows[3]["kept"] and not rows[3]["base_failed"] and rows[4]["base_failed"]


def test_quality_rules_keep_labelled_clean_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality is not null")
    got = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id").where("not base_failed")
    rows = got.select("kept", "quality").collect()
    assert all(r["kept"] == (r["quality"] == 1) for r in rows)


# -- 2 -------------------------------------------------------------------------------------


def test_sentencepiece_equals_the_library_with_byte_spans(spark, odd, texts):
    codec = sentencepiece_codec.Codec(queries.tokenizer_path("piece_bpe_32k.model"))
    samples = [r[1] or "" for r in odd_rows()] + ["  a  b ", "a\n\n b\t c", "▁", "\x00a", "x ▁ ▁▁y"] + list(texts.values())[:60]
    for text in samples:
        ids, begins, ends = codec.encode(text.encode())
        want = codec.library.encode(text, return_type="proto").pieces
        assert [p.id for p in want] == ids.tolist()
        assert [(p.begin, p.end) for p in want] == list(zip(begins.tolist(), ends.tolist(), strict=True))
    got = sentencepiece_codec.digests(sentencepiece_codec.encode_documents(odd, queries.tokenizer_path("piece_bpe_32k.model")))
    want = []
    for i, text, *_ in odd_rows():
        ids = codec.library.encode(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(codec.library.decode(ids).encode()).hexdigest()))
    assert Counter(tuple(r)[:4] for r in got.collect()) == Counter(want)


def test_compiled_charsmap_normalises_like_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = next(v for f, _, _, v in sentencepiece_codec._fields(library.serialized_model_proto()) if f == 3)
    codec = sentencepiece_codec.Codec.__new__(sentencepiece_codec.Codec)
    codec.charsmap = sentencepiece_codec.CharsMap({f: v for f, _, _, v in sentencepiece_codec._fields(spec)}[2])
    codec.literal, codec.dummy_prefix, codec.squeeze = [], True, True
    for text in ["ｱﾊﾟｰﾄ  Ⅳ x", "①② ﬁ é ½  ", "zero nb  ", "", "  a  b ", "plain text"]:
        normal, align = codec.normalise(text.encode())
        want, offsets = library.normalize(text, with_offsets=True)
        at = np.cumsum([0] + [len(c.encode()) for c in text])
        assert normal.decode() == want
        chars = np.cumsum([0] + [len(c.encode()) for c in want])
        assert align[chars].tolist() == [int(at[o]) for o in offsets]


# -- 3, 4 ----------------------------------------------------------------------------------


def area(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def held_out(spark, query, label):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(f"{label} is not null")
    rows = query(spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    return rows["score"].to_numpy(), rows[label].to_numpy().astype(int)


def test_quality_classifier_on_held_out_labels(spark):
    score, y = held_out(spark, queries.op3_quality_classifier, "quality")
    assert area(score, y) > 0.99 and ((score >= 0.5) == y).mean() > 0.98


def test_toxicity_on_held_out_labels(spark):
    score, y = held_out(spark, queries.op4_toxicity, "toxic")
    assert area(score, y) > 0.93 and ((score >= 0.5) == y).mean() > 0.97


def test_discriminant_equals_gaussian_densities():
    rng = np.random.default_rng(1)
    xs = {0: rng.normal(0, 1, (400, 3)), 1: rng.normal(1, 2, (600, 3))}
    model = quality_classifier.fit_sums({k: (len(x), x.sum(axis=0), x.T @ x) for k, x in xs.items()}, 3, 0.0, 0.0)
    probe = rng.normal(0.5, 1.5, (20, 3))
    def density(x):
        mean, cov = x.mean(axis=0), np.cov(x.T, bias=True)
        d = probe - mean
        return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1]
    gap = density(xs[1]) - density(xs[0]) + math.log(600 / 400)
    assert np.allclose(model.score(probe), 1 / (1 + np.exp(-gap / 3)))


def test_classifiers_on_odd_and_empty_input(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 0), (5, None, None), (99, 0, 1)], "doc_id bigint, quality int, toxic int")
    every = lambda: id_bucket(1) == 0
    for docs, n in ((odd, 13), (empty, 0)):
        rows = quality_classifier.score_documents(docs, labels, every).collect()
        assert len(rows) == n and all(0 <= r["score"] <= 1 for r in rows)
        rows = toxicity.score_documents(docs, toxicity.fit(docs, labels, every)).collect()
        assert len(rows) == n and all(0 <= r["score"] <= 1 for r in rows)


def test_misspellings_share_the_vectors_of_their_words():
    clean = [f"plain words about trains number {i} and stations".encode() for i in range(200)]
    bad = [f"plain words about trains number {i} you horrid blockhead and stations".encode() for i in range(100)]
    model = toxicity.train(clean + bad, np.array([0] * 200 + [1] * 100))
    score = lambda t: model.score(np.array([model.features(model.word_logits(t.split()))]))[0]
    assert score(b"a blockheaad number") > 0.5 > score(b"a station number")


# -- 5 -------------------------------------------------------------------------------------


def test_wavelet_matrix_answers_like_the_plain_array():
    rng = np.random.default_rng(1)
    for n, kinds in ((0, 5), (1, 1), (50, 3), (3000, 700), (500, 1)):
        tokens = rng.integers(0, kinds, n).astype("<u4") * 7
        ids, sizes, matrix = token_shards.read_shard(token_shards.pack_shard([4, None], [n, 0], tokens))
        assert ids == [4, None] and sizes.tolist() == [n, 0] and (matrix.decode() == tokens).all()
        assert [matrix.access(i) for i in range(0, n, 17)] == tokens[::17].tolist()
        for t in set(tokens[:9].tolist()) | {5}:
            at = np.flatnonzero(tokens == t)
            assert matrix.occurrences(t) == at.tolist() and matrix.count(t, n // 4, n // 2) == ((at >= n // 4) & (at < n // 2)).sum()


def test_token_shards_round_trip(spark, odd, empty, texts):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate([" x  y ", "a <|endoftext|> b", "é \n c", "don't I'll"])], "doc_id bigint, text string")
    docs = odd.where("doc_id is not null and doc_id <> 5").select("doc_id", "text").union(extra)
    want, start = {}, 0
    for i, text in sorted((r["doc_id"], r["text"]) for r in docs.collect()):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert {r[0]: tuple(r)[1:] for r in token_shards.encode_documents(docs, path).collect()} == want
    assert token_shards.encode_documents(odd, path).count() == 13 and token_shards.encode_documents(empty, path).count() == 0


# -- 6 -------------------------------------------------------------------------------------


def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = lower_words(text)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= 75 * (len(x) + len(y) - shared) and find(a) != find(b):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates_match_brute_force(spark, texts):
    rng = np.random.default_rng(5)
    rows = list(texts.items())
    base = [f"v{i}" for i in range(120)]
    for k in range(150):  # one group around the threshold, where stars alone do not suffice
        copy = list(base)
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            copy[at] = f"u{rng.integers(1 << 30)}"
        rows.append((5000 + k, " ".join(copy)))
    rows += [(9000 + i, t) for i, t in ((0, None), (1, ""), (2, "One two"), (3, "one  TWO"), (4, "one two three"))]
    got = near_dedup.group(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute_components(rows)


def test_near_duplicates_on_odd_and_empty_input(odd, empty):
    rows = near_dedup.group(odd).collect()
    assert len(rows) == 13 and near_dedup.group(empty).count() == 0
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert {r["component_id"] for r in rows if r["doc_id"] in (7, 8)} == {7}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]


def test_bucket_kernels_find_all_links():
    rng = np.random.default_rng(2)
    core = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    sets = []
    for _ in range(40):
        keep = core.copy()
        at = rng.choice(100, int(rng.integers(0, 25)), replace=False)
        keep[at] = rng.integers(0, 1 << 63, len(at), dtype=np.uint64)
        sets.append(np.unique(keep))
    ids = list(range(40))
    linked = {(i, j) for i in ids for j in ids if i < j and 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))}
    found = near_dedup.links_between(ids, ids, [s.tobytes() for s in sets])
    assert {tuple(sorted(p)) for p in found} <= linked
    def groups(pairs):
        root = {i: i for i in ids}
        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in ids]
    assert groups(found) == groups(linked)
    payloads = [len(s).to_bytes(8, "little") + near_dedup.sketch(s).tobytes() for s in sets]
    assert {i for p in linked for i in p} <= {a for a, _ in near_dedup.plausible(ids, ids, payloads)}


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 480, dtype=np.uint64)
    assert (near_dedup.merge(near_dedup.sketch(x[:300]), near_dedup.sketch(x[200:])) == near_dedup.sketch(x)).all()
    a, b = near_dedup.sketch(x[:400]), near_dedup.sketch(x[80:])  # similarity 320 / 480
    got = near_dedup.likely_similarity(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([400.0]), np.array([400.0]))
    assert abs(got[0] - 2 / 3) < 0.12


def test_components_of_a_path_a_hub_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(200, 200), (None, 7), (300, 299), (299, 300)]
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(got) == 41 + 50 + 2
    assert all(r["component"] == (0 if r["node"] <= 40 else 100 if r["node"] < 200 else 299) for r in got)


# -- 7 -------------------------------------------------------------------------------------


def test_url_rules_and_aliases(spark):
    link = '<html><head><link rel="canonical" href="%s"></head>'
    pages = [
        (1, "http://A.Example.NET/en/1", None), (2, "http://example.net/de/1", None), (3, "https://x.org/fr/2#f", None),
        (4, "ftp://other.info/a?utm_source=f", link % "http://bad.net/a"), (5, "http://bad.net/a?ref=x", None),
        (6, "http://www.other.info/a#top", None), (7, "http://w.info/b", link % "http://bad.net/q"),
        (8, "http://q.info/c", '<meta http-equiv="refresh" content="0; url=http://w.info/b">'), (9, "http://bad.net/q", None),
        (10, "http://r.info/c", link % "http://s.org/fr/ok"), (11, "http://s.org/fr/ok", None), (12, "http://bad.net/z", link % "http://r.info/c"),
        (13, None, "<link rel=canonical href=http://bad.net/a>"), (14, "no scheme", None), (15, "http://net", None), (16, "http://notnet/x", None),
        (16, "http://notnet/x", None), (17, "http://example.com/de/x?y", None),
    ]
    df = spark.createDataFrame([(*p, "k") for p in pages], "page_id bigint, url string, html string, key string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["key"]) for r in url_filters.judge_urls(df).collect()}
    assert got == {
        1: ("a.example.net", "/en/1", "example.net/en/", "allow", "k"), 2: ("example.net", "/de/1", "net/", "block", "k"),
        3: ("x.org", "/fr/2", "org/fr/", "allow", "k"), 4: ("other.info", "/a", None, "block", "k"), 5: ("bad.net", "/a", "net/", "block", "k"),
        6: ("www.other.info", "/a", None, "block", "k"), 7: ("w.info", "/b", None, "block", "k"), 8: ("q.info", "/c", None, "block", "k"),
        9: ("bad.net", "/q", "net/", "block", "k"), 10: ("r.info", "/c", None, "allow", "k"), 11: ("s.org", "/fr/ok", "org/fr/", "allow", "k"),
        12: ("bad.net", "/z", "net/", "block", "k"), 13: ("", "", None, "allow", "k"), 14: ("", "", None, "allow", "k"),
        15: ("net", "", None, "allow", "k"), 16: ("notnet", "/x", None, "allow", "k"), 17: ("example.com", "/de/x", "example.com/de/", "block", "k"),
    }
    assert url_filters.judge_urls(df).count() == 18 and url_filters.judge_urls(df.where("false")).count() == 0


def test_url_links_resolve_against_the_page(spark):
    link, base = '<link rel="canonical" href="%s">', '<base href="%s">'
    refresh = '<meta http-equiv="refresh" content="0; url=%s">'
    at = "http://a.info/d/e/p.html?k=1"
    cases = {
        link % "page.html": "a.info/d/e/page.html", refresh % "next.html": "a.info/d/e/next.html", link % "?id=2": "a.info/d/e/p.html?id=2",
        link % "./x/../y": "a.info/d/e/y", link % "../../../z": "a.info/z", link % "/login?next=http://bad.net/": "a.info/login?next=http://bad.net/",
        link % "go?u=http://bad.net/": "a.info/d/e/go?u=http://bad.net/", link % "//b.org/q": "b.org/q", link % "HTTP://B.org/q/./r": "b.org/q/r",
        link % "mailto:x@bad.net": None, link % "#top": None, base % "/new/" + link % "page": "a.info/new/page", base % "http://c.org/u/v" + link % "w": "c.org/u/w",
    }
    pages = [(f"{at}{i}", page) for i, page in enumerate(cases)]
    got = url_filters.alias_edges(spark.createDataFrame(pages, "url string, html string")).collect()
    want = {(f"a.info/d/e/p.html?k=1{i}", b) for i, b in enumerate(cases.values()) if b}
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)
    rows = [(1, "http://w.info", refresh % "go.html"), (2, "http://bad.net/x", link % "http://w.info/go.html"), (3, "http://v.info/", link % "/login?next=http://bad.net/x")]
    got = {r["page_id"]: r["verdict"] for r in url_filters.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow"}


def test_url_component_of_many_pages_is_split(spark, tmp_path):
    """One component holds almost all pages: its join back must not be one task."""
    url = F.concat(F.lit("http://x.info/p?sessionid="), F.col("id").cast("string"))
    pages = spark.range(60_000).select(F.col("id").alias("page_id"), url.alias("url"), F.lit(None).cast("string").alias("html"))
    pages.union(spark.createDataFrame([(-1, "http://bad.net/a", '<link rel="canonical" href="http://x.info/p">')], pages.schema)).write.parquet(f"{tmp_path}/pages")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.files.maxPartitionBytes": "128k",
        "spark.sql.files.openCostInBytes": "16k", "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = url_filters.judge_urls(spark.read.parquet(f"{tmp_path}/pages"))
        rows = out.collect()
        assert len(rows) == 60_001 and all(r["verdict"] == "block" for r in rows)
        assert re.search(r"SortMergeJoin\(skew=true\) \[component", out._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# -- 8 -------------------------------------------------------------------------------------


def fold(text):
    return [w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER)) if w]


def brute_matches(docs, items):
    grams = lambda w: [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
    out = {}
    for i, text in docs:
        d = grams(fold(text))
        for j, item in items:
            b = grams(fold(item))
            if not b or not set(b) & set(d):
                continue
            best = max(decontamination.similarity(Counter(d[s : s + len(b)]), Counter(b)) for s in range(max(1, len(d) - len(b) + 1)))
            if best >= 0.75:
                out[i, j] = best
    return out


def test_decontamination_matches_brute_force(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    extra = items.limit(9).selectExpr("item_id + 5000 as doc_id", "concat('Und so weiter, ', upper(text), ' and so on') as text")
    every = docs.select("doc_id", "text").union(extra)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.matches(every, items).collect()}
    want = brute_matches([tuple(r) for r in every.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert got == pytest.approx(want) and len(got) > 9
    assert decontamination.matches(empty, items).count() == 0 and decontamination.matches(odd, items.where("false")).count() == 0
    assert decontamination.clean(odd, items).columns == odd.columns and decontamination.clean(odd, items).count() == 13


def test_benchmark_in_several_passes(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = Counter(map(tuple, decontamination.matches(docs, items).collect()))
    monkeypatch.setattr(decontamination, "ITEMS_PER_PASS", 15)
    assert Counter(map(tuple, decontamination.matches(docs, items).collect())) == want


def test_decontamination_passes_hold_one_part_of_the_items(spark, odd, monkeypatch):
    docs = odd.unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"), allowMissingColumns=True)
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want, kept = (Counter(map(tuple, f(docs, items).collect())) for f in (decontamination.matches, decontamination.clean))
    made, released = [], []
    broadcast, destroy = type(spark.sparkContext).broadcast, decontamination.Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: made.append(len(made) - len(released)) or broadcast(self, x))
    monkeypatch.setattr(decontamination.Broadcast, "destroy", lambda self, *a: released.append(1) or destroy(self, *a))
    monkeypatch.setattr(decontamination, "ITEMS_PER_PASS", 15)
    for f, rows in ((decontamination.matches, want), (decontamination.clean, kept)):
        made.clear(), released.clear()
        out = f(docs, items)
        assert len(made) > 1 and not any(made)  # none is alive when the next is made
        assert Counter(map(tuple, out.collect())) == rows and "MapInArrow" not in out._jdf.queryExecution().toString()


def test_very_long_texts_of_one_passage_are_searched_in_pieces():
    """20 MB of an item's passage, and of a near copy, within a minute and in bounded memory."""
    words = [f"word{k}" for k in range(300)]
    item, near = " ".join(words[:60]), " ".join(words[:56] + words[200:202])
    bench = decontamination.Benchmark([1, 2], [item.encode(), " ".join(words[100:140]).encode()])
    for passage, expect in ((item, 1.0), (near, None)):
        text = ((passage + " ") * (20_000_000 // len(passage))).encode()
        (hashes,), _ = decontamination.shingles([text], decontamination.ALNUM)
        tracemalloc.start()
        began = time.monotonic()
        (found,) = bench.search(hashes, *bench.held(hashes))
        took, (_, peak) = time.monotonic() - began, tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert took < 60 and peak < 500 << 20
        size = len(bench.sets[0])
        best = max(decontamination.similarity(Counter(hashes[a : a + size].tolist()), Counter(bench.sets[0].tolist())) for a in range(120))
        assert found[0] == 0 and found[2] == pytest.approx(best) and (expect is None or found[2] == expect)


def test_recall_at_the_threshold():
    """Windows at a similarity from 0.75 on, made by changing words: none of 2,000 is missed, as
    the radius promises all but about one in 20,000."""
    rng = np.random.default_rng(12)
    missed = near = 0
    for k in range(2000):
        words = [f"v{x}" for x in rng.integers(0, 5000, int(rng.integers(30, 120)))]
        changed = list(words)
        for j in rng.choice(len(words), max(1, len(words) // 60), replace=False):
            changed[j] = "other"
        bench = decontamination.Benchmark([0], [" ".join(words).encode()])
        (hashes,), _ = decontamination.shingles([" ".join(["x"] * 9 + changed + ["y"] * 9).encode()], decontamination.ALNUM)
        size = int(bench.lengths[0])
        best = max(decontamination.similarity(Counter(hashes[a : a + size].tolist()), Counter(bench.sets[0].tolist())) for a in (8, 9, 10))
        found = bench.search(hashes, *bench.held(hashes))
        if best >= 0.75:
            near += best < 0.85
            missed += not found or found[0][2] < best - 1e-12
        else:
            assert not found or found[0][2] >= 0.75
    assert near > 100 and missed == 0


def test_equal_items_and_items_without_id(spark):
    text = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"so {text} then"), (2, "nothing")], "doc_id bigint, text string")
    items = spark.createDataFrame([(4, text), (5, text), (None, text), (6, None), (7, "")], "item_id bigint, text string")
    got = Counter((r["doc_id"], r["item_id"]) for r in decontamination.matches(docs, items).collect())
    assert got == Counter([(1, 4), (1, 5), (1, None)])


def test_block_index_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    probes = prints[:50].copy()
    for k in range(50):
        for bit in rng.choice(64, int(rng.integers(0, 30)), replace=False):
            probes[k] ^= np.uint64(1) << np.uint64(bit)
    rows, cols = decontamination.BlockIndex(prints).within(probes)
    near = np.bitwise_count(probes[:, None] ^ prints[None, :]) <= decontamination.RADIUS
    assert set(zip(rows.tolist(), cols.tolist(), strict=True)) == set(zip(*np.nonzero(near), strict=True))


# -- 9 -------------------------------------------------------------------------------------


def test_language_model_base_matches_brute_force(spark, odd, texts, monkeypatch):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] is not None] + [(100 + i, t) for i, t in list(texts.items())[:80]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = Counter()
    train = [lower_words(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for d in train for w in [*d, None])
    n, v = sum(c.values()), len(c)
    want, scores = [], []
    for i, t in rows:
        d = [*lower_words(t), None]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in d)
        want.append((i, zlib.crc32(str(i).encode()) % 7 == 2, len(d), sum(c[w] > 0 for w in d), n, round(base, 5)))
    # One block with the spelling model sent along; many blocks with the model joined.
    for block_bytes, rows_sent in ((lm_scoring.BLOCK_BYTES, lm_scoring.SPELLING_ROWS), (9000, 0)):
        monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", block_bytes)
        monkeypatch.setattr(lm_scoring, "SPELLING_ROWS", rows_sent)
        out = lm_scoring.score_corpus(docs, lambda: id_bucket(7) == 2).collect()
        scores.append({(r["doc_id"], r["n_tokens"]): r["score"] for r in out})
        assert Counter((*tuple(r)[:5], round(r["base_score"], 5)) for r in out) == Counter(want)
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert scores[0].keys() == scores[1].keys() and all(scores[1][k] == pytest.approx(x, rel=1e-9) for k, x in scores[0].items())


def test_suffix_tree_is_a_distribution_and_beats_the_root():
    vocabulary = [b"banana", b"bandana", b"cabana", b"ana"]
    keys, counts = lm_scoring.context_keys(vocabulary, np.array([50, 30, 20, 10]))
    tree = lm_scoring.SuffixTree(keys, counts)
    for recent in (b" ", b" ban", b" cab", b"xyz"):
        packed = int.from_bytes(recent, "big")
        assert sum(10 ** tree._next(packed, len(recent), s) for s in range(256)) == pytest.approx(1, abs=1e-4)
    assert tree.escape and tree.word(b"banana") > sum(tree.root[s] for s in b"banana ")
    plain = Counter()
    for w, m in zip(vocabulary, (50, 30, 20, 10), strict=True):
        s = b" " + w + b" "
        for p in range(1, len(s)):
            for k in range(min(p, lm_scoring.DEPTH) + 1):
                plain[k, s[p - k : p], s[p]] += m
    assert {(int(x) >> 56, int(x)): int(y) for x, y in zip(keys, counts, strict=True)} == {
        (k, k << 56 | int.from_bytes(a, "big") << 8 | b): m for (k, a, b), m in plain.items()}


def test_language_model_knows_word_order_and_phrases(spark):
    rng = np.random.default_rng(9)
    lines = ["the quick brown fox jumps over the lazy dog", "seven wizards make toxic brew for the evil queen", "日本 の 言葉 は 長い"]
    train = [" ".join(lines[k] for k in rng.integers(0, 3, 6)) for _ in range(60)]
    texts = [" ".join(lines)] + [" ".join(rng.permutation(" ".join(lines).split())) for _ in range(10)]
    rows = [(i, t) for i, t in enumerate(train + texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in lm_scoring.score_corpus(docs, lambda: F.col("doc_id") >= len(train)).collect()}
    ordered, *shuffled = (got[len(train) + i] for i in range(len(texts)))
    assert all(ordered["base_score"] == pytest.approx(r["base_score"]) and ordered["score"] > r["score"] + 5 for r in shuffled)


def test_language_model_matches_brute_force(spark, texts):
    """Spelling as in the suffix tree in memory, contexts of words as in plain dictionaries; a
    context is kept from two occurrences on, however small its share."""
    rows = [(i, t) for i, t in list(texts.items())[:60]] + [(-1, "rare pair"), (-2, "rare pair rare pair"), (-3, "")]
    held = {i for i, _ in rows[::5]}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_corpus(docs, lambda: F.col("doc_id").isin(sorted(held))).collect()}
    split = {i: [w.encode() for w in lower_words(t)] for i, t in rows}
    c = Counter(w for i, d in split.items() if i not in held for w in d)
    n_docs = len(rows) - len(held)
    keys, weights = lm_scoring.context_keys(list(c), np.array(list(c.values())))
    ends = [lm_scoring.END, 1 << 56 | lm_scoring.SPACE << 8 | lm_scoring.END]
    tree = lm_scoring.SuffixTree(np.concatenate([keys, ends]), np.concatenate([weights, [n_docs, n_docs]]))
    c[None] = n_docs
    n, s = sum(c.values()), lm_scoring.SMOOTHING
    grams = Counter()
    for i, d in split.items():
        if i not in held:
            run = ["", "", *d, None]
            grams.update((tuple(run[p - k : p]), run[p]) for p in range(2, len(run)) for k in (1, 2))
    after = {}
    for (ctx, w), m in grams.items():
        after.setdefault(ctx, {})[w] = m

    def spelt(w):
        return tree.end() if w is None else tree.word(w)

    def p(ctx, w):
        if not ctx:
            return (c[w] + s * 10 ** spelt(w)) / (n + s)
        if ctx not in kept:
            return p(ctx[1:], w)
        return (after[ctx].get(w, 0) + s * p(ctx[1:], w)) / (sum(after[ctx].values()) + s)

    kept = set()
    for k in (1, 2):
        for ctx in [x for x in after if len(x) == k]:
            total = sum(after[ctx].values())
            gain = sum(m * math.log(m / total / p(ctx[1:], w)) for w, m in after[ctx].items())
            if total >= lm_scoring.MIN_COUNT and gain >= lm_scoring.MIN_GAIN:
                kept.add(ctx)
    assert any(len(x) == 2 for x in kept) and (b"rare",) in kept
    for i, d in split.items():
        run = ["", "", *d, None]
        want = sum(math.log10(p(tuple(run[q - 2 : q]), run[q])) for q in range(2, len(run)))
        # The tree in memory keeps contexts that were seen once; they may differ on unseen spellings.
        assert got[i] == pytest.approx(want, rel=2e-3, abs=1e-6)


def test_language_model_on_empty_input(spark, empty, odd):
    assert lm_scoring.score_corpus(empty, lambda: id_bucket(7) == 2).count() == 0
    rows = lm_scoring.score_corpus(odd, lambda: id_bucket(1) == 0).collect()  # nothing to learn from
    assert len(rows) == 13 and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in rows)


# -- 10 ------------------------------------------------------------------------------------


def brute_base(text):
    w = fold(text)
    places, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_matches_brute_force(spark, odd, texts):
    notes = ["Released under the MIT License. under the mit-license!", "Apache License, Version 2.0 CC BY-NC 4.0", "xunder the mit licensex"]
    rows = [(r[0], r[1]) for r in odd_rows()] + list(texts.items()) + [(9000 + i, t) for i, t in enumerate(notes)]
    got = license_scan.scan_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = Counter((i, *brute_base(t)) for i, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)


def test_license_expressions():
    value = license_scan.expression_freedom
    assert value("MIT OR GPL-3.0-only") == (["mit", "gpl-3"], 1.0)
    assert value("MIT AND GPL-3.0-only") == (["mit", "gpl-3"], 0.4)
    assert value("GPL-2.0-or-later WITH Classpath-exception-2.0") == (["gpl-2"], 0.4)
    assert value("(MIT AND (GPL-3.0 OR CC-BY-NC-4.0)) OR AGPL-3.0")[1] == 0.4
    assert value("MIT AND GPL-3.0 OR Apache-2.0")[1] == 1.0  # AND binds more tightly
    assert value("MIT AND (")[1] == 1.0 and value(") OR")[1] is None and value("MIT is our licence") == (["mit"], 1.0)
    scan = license_scan.Scanner().scan(b"/* SPDX-License-Identifier: (MIT OR GPL-2.0) */ All rights reserved.")
    assert scan[5] == "all-rights-reserved,gpl-2,mit" and scan[6] == 0.0


# -- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark, texts):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        rows = out.collect()
        seen[name] = ({r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in rows}, rows)
        docs = spark.createDataFrame(rows, docs.schema)
    before, after, rows = seen["MinHash near-dedup"]
    groups = brute_components([(r["doc_id"], r["text"]) for r in seen["toxicity"][2]])
    assert after == {i for i, (_, _, kept) in groups.items() if kept}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {i for i, _ in brute_matches([(r["doc_id"], r["text"]) for r in rows], items)}
    before, after, rows = seen["benchmark decontamination"]
    assert after == before - leaks
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r["doc_id"]: r["decoded"] for r in last} == {r["doc_id"]: r["text"] for r in rows}


def test_pipeline_stages_on_odd_and_empty_input(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert set(corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).columns) >= {"doc_id", "ids", "decoded"}
