"""URL components, quality statistics and toxicity scores against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from encore.llm import components, quality_classifier, toxicity, url_filters

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    """Union-find whose root is the smallest member."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def plain_key(url):
    if url is None or "://" not in url:
        return None
    rest = url.split("://", 1)[1].split("#")[0]
    place, _, query = rest.partition("?")
    host, slash, path = place.partition("/")
    kept = sorted(p for p in query.split("&") if p and not re.match(r"(utm_[^=]*|ref)(=|$)", p))
    return re.sub(r"^www\.", "", host.translate(LOWER)) + (slash + path).rstrip("/") + ("?" + "&".join(kept) if kept else "")


def plain_rule(url, rules):
    if url is None or "://" not in url:
        return None
    place = re.split("[?#]", url.split("://", 1)[1])[0]
    host, slash, path = place.partition("/")
    host, path = host.translate(LOWER), slash + path
    fits = []
    for rule, verdict in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), verdict))
    return max(fits)[1] if fits else None


@pytest.mark.parametrize("seed", [1, 2])
def test_url_verdicts_against_union_find(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.com", "www.a.com", "b.net", "sub.b.net", "example.net", "example.com", "c.org", "d.io", "E.io", "f.info"]
    paths = ["", "/", "/x", "/x/", "/en/1", "/de/1", "/fr/2", "/de/q/r"]
    tails = ["", "?utm_s=1", "?ref", "#f", "?k=2&utm_a=b", "?b=1&a=2"]

    def url():
        return f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}"

    pages = []
    for k in range(400):
        link = rng.choice([None, None, None, f'<link rel="canonical" href="{url()}">', f'<meta http-equiv="refresh" content="0; url={url()}">'])
        pages.append((k, rng.choice([url()] * 30 + [None, "no scheme"]), link))
    # A hub: many pages name one target.
    pages += [(1000 + k, f"http://hub{k}.io/p", '<link rel="canonical" href="http://target.io/">') for k in range(200)]
    sets, rules = Sets(), {}
    for _, u, html in pages:
        key = plain_key(u)
        if key is None:
            continue
        sets.root(key)
        if html and (found := re.search(r'(?:href=|url=)"?([^">]+)', html)):
            sets.join(key, plain_key(found.group(1)))
    for _, u, _ in pages:
        if (key := plain_key(u)) is not None and (rule := plain_rule(u, url_filters.RULES)):
            rules.setdefault(sets.root(key), set()).add(rule)
    want = Counter()
    for k, u, _ in pages:
        key, own = plain_key(u), plain_rule(u, url_filters.RULES)
        told = rules.get(sets.root(key), set()) if key is not None else set()
        want[k, own or ("block" if told == {"block"} else "allow"), None if key is None else sets.root(key)] += 1
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)
    got = Counter((r["page_id"], r["verdict"], r["component"]) for r in url_filters.judge_urls(df).collect())
    assert got == want and {v for _, v, _ in want} == {"allow", "block"}


def test_components_against_union_find(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500, 500 + k) for k in range(300)] + [(k, k + 1) for k in range(900, 960)] + [(3, None), (5, 5)]
    sets = Sets()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            sets.join(a, b)
    want = {x: sets.root(x) for x in sets.up}
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    assert {r["node"]: r["component"] for r in components.components(df).collect()} == want


def test_hub_edges_are_split_over_tasks(spark, tmp_path):
    """One node holds a third of all edges: the join of its edges with its minimum is a skewed
    join that adaptive execution splits."""
    rows = spark.range(90_000).selectExpr("case when id % 3 = 0 then 1 else id * 2 + 10 end as a", "id * 2 + 11 as b")
    rows.write.parquet(f"{tmp_path}/edges")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "16k", "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    kept, texts = components.checkpointed, []

    def noted(df):
        made = kept(df)
        texts.append(df._jdf.queryExecution().executedPlan().toString())
        return made

    components.checkpointed = noted
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = components.components(spark.read.parquet(f"{tmp_path}/edges"))
        assert found.where("component = 1").count() == 30_001
    finally:
        components.checkpointed = kept
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("skew=true" in t for t in texts)


def test_quality_statistics_against_python(spark):
    texts = [None, "", " \n\t ", "One two.", "A, b! C|d 42\n\nA\nA\n", "x" * 300, "#*$%&|<> é É", "a\x0bb\x85c d", "tail\n", "Ä Ö 日本 ｶ 1 2 3", ("Word word, 7!\n" * 40)]
    rng = random.Random(2)
    texts += ["".join(rng.choices(["Ab", " ", "\n", "!", ",", ".", "|", "9", "é", "\t", "#", "zz "], k=rng.randint(0, 80))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in quality_classifier.statistics(df).collect():
        t = texts[r["doc_id"]] or ""
        words, lines = WORD.findall(t), t.split("\n")
        n, chars = len(words), len(t)
        count = lambda chars_: sum(t.count(c) for c in chars_)  # noqa: B023, E731
        per = lambda a, b: math.sqrt(a / max(b, 1))
        want = [
            math.log1p(n), math.log1p(chars / max(n, 1)), per(count("#*$%&|<>"), chars), per(count("|"), n),
            per(sum("A" <= c <= "Z" for c in t), chars), per(count("!"), n), per(count("."), n), per(count(","), n), per(count("0123456789"), chars),
            math.asin(math.sqrt(len(set(words)) / max(n, 1))), per(len(lines) - len(set(lines)), len(lines)), math.log1p(n / len(lines)),
        ]
        assert [r[f"x{i}"] for i in range(12)] == pytest.approx(want, abs=1e-12), t


def test_quality_class_sums_against_numpy(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(120, 3)), rng.integers(0, 3, 120)
    rows = [(*map(float, r), int(k)) for r, k in zip(x, y, strict=True)]
    model = quality_classifier.fit(spark.createDataFrame(rows, "a double, b double, c double, y int").repartition(4), ["a", "b", "c"], "y")
    own = [x[y == k] for k in (0, 1)]
    both = np.concatenate(own)
    scale = np.sqrt(both.var(axis=0))
    assert np.allclose(model.centre, both.mean(axis=0)) and np.allclose(model.scale, scale) and model.prior == len(own[1]) / len(both)
    covs = [np.cov(((o - both.mean(axis=0)) / scale).T, bias=True) for o in own]
    pooled = sum(len(o) * c for o, c in zip(own, covs, strict=True)) / len(both)
    for k in (0, 1):
        mixed = 0.8 * covs[k] + 0.2 * pooled
        mixed = 0.95 * mixed + 0.05 * np.trace(mixed) / 3 * np.eye(3)
        assert np.allclose(model.whiten[k].T @ model.whiten[k], np.linalg.inv(mixed)) and model.log_dets[k] == pytest.approx(np.linalg.slogdet(mixed)[1])


def plain_buckets(word):
    """The n-grams of a word and the word itself, as numbered slots, one by one."""
    mul, full, marked = 0x9E3779B97F4A7C15, (1 << 64) - 1, b"<" + word + b">"

    def slot(h, kind):
        h = (h + kind) * mul & full
        h ^= h >> 29
        return (h * mul & full) >> (64 - toxicity.BITS)

    out = [slot(sum(b * pow(mul, k + 1, 1 << 64) for k, b in enumerate(marked)) & full, 1)]
    for n in toxicity.SIZES:
        for at in range(len(marked) - n + 1):
            h = 0
            for b in marked[at : at + n]:
                h = (h * 1099511628211 + b) & full
            out.append(slot(h, n + 1))
    return out


def plain_features(model, words):
    if not words:
        return model.bias, model.bias, 0.0
    logit = {w: sum(model.logits[b] for b in plain_buckets(w)) / len(plain_buckets(w)) for w in set(words)}
    starts = list(range(0, max(len(words) - toxicity.WINDOW, 0) + 1, toxicity.STRIDE))
    if len(words) > toxicity.WINDOW and starts[-1] != len(words) - toxicity.WINDOW:
        starts.append(len(words) - toxicity.WINDOW)
    found = [(sum(map(logit.get, words[s : s + toxicity.WINDOW])) / len(words[s : s + toxicity.WINDOW]) + model.bias, s) for s in starts]
    top, at = max(found, key=lambda f: (f[0], -f[1]))
    apart = [x for x, s in found if abs(s - at) >= toxicity.WINDOW]
    return top, max(apart) if apart else min(top, 0.0), math.sqrt(sum(x > 0 for x, _ in found) / len(found))


def test_toxicity_scores_against_python(spark):
    rng = random.Random(4)
    clean, bad = ["the", "plain", "word", "Haus", "été", "日本", "x"], ["horrid", "blockhead", "vile"]
    texts, toxic = [], []
    for k in range(160):
        words = rng.choices(clean, k=rng.randint(0, 60))
        if k % 4 == 0:
            words[len(words) // 2 : len(words) // 2] = rng.choices(bad, k=3)
        texts.append(" ".join(words))
        toxic.append(int(k % 4 == 0))
    model = toxicity.train([t.encode() for t in texts], np.array(toxic))
    probes = [*texts[:40], None, "", "blockheaad", "A VILE blockhead\tthe\nplain " * 30, "x " * 500]
    df = spark.createDataFrame(list(enumerate(probes)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(df, model).collect()}
    for k, t in enumerate(probes):
        f = plain_features(model, [w.encode() for w in WORD.findall((t or "").translate(LOWER))])
        z = sum(a * b for a, b in zip((*f, 1.0), model.beta, strict=True))
        assert got[k] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_toxicity_takes_only_associated_ngrams():
    texts = [["good", "day"], ["good", "bad"], ["bad", "day"], ["day"]] * 30
    toxic = np.array([0, 1, 1, 0] * 30)
    names = ["good", "day", "bad"]
    what, grams = toxicity._grams_by_word([n.encode() for n in names])
    kept = toxicity._associated([np.array([names.index(w) for w in t], dtype=np.int32) for t in texts], toxic, what, grams)
    of_word = {n: set(plain_buckets(n.encode())) for n in names}
    assert all(sorted(plain_buckets(n.encode())) == sorted(what[sum(grams[:k]) : sum(grams[: k + 1])].tolist()) for k, n in enumerate(names))
    for slot in set().union(*of_word.values()):
        has = np.array([any(slot in of_word[w] for w in t) for t in texts])
        shares = [has[toxic == y].mean() for y in (0, 1)]
        error = math.sqrt(max(has.mean() * (1 - has.mean()), 1e-12) * (1 / 60 + 1 / 60))
        assert kept[slot] == (abs(shares[1] - shares[0]) > toxicity.MIN_Z * error)


def test_edges_plan_stays_small(spark, capsys):
    """The links' addresses are made in steps that name their parts often: each stands in the plan once."""
    pages = spark.createDataFrame([(1, "http://a.com/x/y", '<base href="/z/"><link rel="canonical" href="../b?ref=1&amp;q=2">')], "page_id int, url string, html string")
    edges = url_filters.alias_edges(pages)
    assert [tuple(r) for r in edges.collect()] == [("a.com/x/y", "a.com/b?q=2")]
    edges.explain(True)
    assert len(capsys.readouterr().out) < 200_000  # 3,000,000 with every part written out
