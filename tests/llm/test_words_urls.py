"""Importance resampling, spelling variants and the URL filter against plain Python, and rows that break things."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cabwh.llm import importance, spelling, url_filter
from cabwh.llm.queries import ORACLE_SQL, QUERIES
from cabwh.llm.words import crc32_each, crc32_joined, slices, words_of
from cabwh.oracle.compare import canon, duck_rows

LONG = " ".join(f"w{i % 7919}" for i in range(300_000))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, word string, n int, salt int, bucket string, id string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, None, "y") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, sf_small, duck_small, name):
    df = QUERIES[name](spark, sf_small)
    cols, rows = duck_rows(duck_small, ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(cols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(rows, cols)


# --- words and checksums ---------------------------------------------------------------------------------------


def test_checksums_of_joined_strings():
    rng = random.Random(1)
    some = lambda sizes: [rng.randbytes(rng.choice(sizes)) for _ in range(2_000)]
    a, b = some([0, 1, 5, 20]), some([0, 1, 7, 63, 64, 65, 66, 200, 5_000])
    got = crc32_joined(crc32_each(a), crc32_each(b), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]


def test_words_of_slices(monkeypatch):
    monkeypatch.setattr("cabwh.llm.words.SLICE_BYTES", 30)
    texts = ["", None, "  A\x00b--Ünder é5x ", "ß" * 40, "!!", "a b A", LONG[:200], "\x7f\x80x"]
    pattern = importance.SEPARATORS
    got = []
    for at, part in slices(pa.array(texts)):
        words = words_of(part, pattern)
        assert at == len(got)
        ends = np.cumsum(words.count)
        names = words.distinct.to_pylist()
        got += [[names[k] for k in words.index[e - n:e]] for e, n in zip(ends, words.count, strict=True)]
    assert got == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) for t in texts]


# --- importance resampling -------------------------------------------------------------------------------------


def plain_resample(rows, target):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % 10_000 for f in runs]

    own = [features(t) for _, t in rows]
    s = Counter(b for _, f in own for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))
    out, eligible = [], []
    for (i, _), (n_words, f) in zip(rows, own, strict=True):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if n_words >= 20:
            eligible.append(out[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[:5 * len(eligible) // 100], 1):
        row[4] = rank
    return out


def test_importance_equals_plain_python_on_the_given_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("text").collect()]
    got = QUERIES["op12_importance"](spark, sf_small)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_features", "weight", "score", "rank")]]
    assert sorted(map(list, got.collect())) == sorted(plain_resample([tuple(r) for r in docs], target))


def test_importance_of_odd_rows(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice(["alpha", "Beta", "gamma", "Ünder", "d5", "e"]) for _ in range(25))
    rows = [(i, text()) for i in range(60)] + [(7, "one two"), (None, text()), (None, None), (61, ""), (62, "?!"), (63, LONG)]
    rows += [(64, rows[0][1]), (64, rows[0][1])]
    target = ["alpha beta gamma", None, "ünder Ünder", ""]
    got = importance.resample(docs_of(spark, rows), docs_of(spark, [(0, t) for t in target])).select(
        "id", "n_features", "weight", "score", "rank").collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, plain_resample(rows, target)), key=key)
    drawn = importance.draw(docs_of(spark, rows), docs_of(spark, [(0, t) for t in target]))
    assert drawn.columns == ["doc_id", "text", "word", "n", "salt", "bucket", "id"]
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.id for r in got if r.rank is not None)
    empty = docs_of(spark, [])
    assert importance.resample(empty, docs_of(spark, [(0, "a b")])).count() == 0
    assert importance.resample(docs_of(spark, rows[:3]), empty).count() == 3


# --- spelling variants -----------------------------------------------------------------------------------------


def near(word):
    """Patterns with one code point left out; two words are near if they are one edit apart."""
    return {word[:k] + "\0" + word[k + 1:] for k in range(len(word))}


def plain_variants(rows, drop_one_in=31):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_one_in and h % drop_one_in == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    by_pattern, links = defaultdict(set), defaultdict(set)
    for w in words:
        for p in near(w):
            by_pattern[p].add(w)
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1:]
            if shorter in words:
                links[w].add(shorter)
                links[shorter].add(w)
    for group in by_pattern.values():
        for w in group:
            links[w] |= group - {w}
    form = {}
    for w, n in words.items():
        if links[w]:
            best = min(links[w], key=lambda x: (-words[x], x))
            if words[best] >= 10 * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(links[w]), words.get(form.get(w))))
    return out


def test_variants_equal_plain_python_on_the_given_tables(spark, sf_small):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_spelling"](spark, sf_small).collect()]
    want = plain_variants(docs)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[1] for r in want)


def test_variants_of_odd_rows(spark):
    rng = random.Random(9)
    base = ["question", "antwörter", "ÿÀÿÿÀÿÀ", "aaaaaaaa", "x" * 300, "leveled", "lleveed"]
    words = []
    for w in base:
        words += [w] * 400
        for _ in range(60):
            k = rng.randrange(len(w))
            words += [rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("aez") + w[k:], w[:k] + "ö" + w[k + 1:]])] * rng.choice([1, 2, 3])
    words += ["question" + "s" * k for k in range(4) for _ in range(10 ** max(0, 2 - k))]
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::9])) for i in range(9)] + [(None, " ".join(words[:50])), (10, None), (11, ""), (3, "Question ×÷ 5")]
    for drop in (31, None):
        got = spelling.spelling_variants(docs_of(spark, rows), drop_one_in=drop).select(
            "word", "form", "root", "n", "n_near", "form_n").collect()
        assert sorted(map(tuple, got), key=str) == sorted(plain_variants(rows, drop), key=str)
    assert spelling.spelling_variants(docs_of(spark, [])).count() == 0


def test_signatures_meet_for_all_vectors_at_distance_two():
    rng = random.Random(4)
    for _ in range(300):
        word = "".join(rng.choice("abcdeéthrin") for _ in range(rng.randint(7, 14)))
        k, letter = rng.randrange(len(word)), rng.choice("abcxyzö")
        for other in (word[:k] + letter + word[k + 1:], word[:k] + letter + word[k:]):
            if other == word:
                continue
            sides, rows = spelling.signatures(spelling.letters_of([word, other]))
            if len(other) == len(word):
                mine, theirs = (set(r[sides == 0].tolist()) for r in rows)
            else:
                mine, theirs = set(rows[0][sides == 1].tolist()), set(rows[1][sides == 2].tolist())
            assert mine & theirs, (word, other)


def test_roots_follow_chains(spark):
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(13)] + [("a", "w5")], "word string, form string")
    assert {tuple(r) for r in spelling.roots_of(chain).collect()} == {(f"w{k}", "w13") for k in range(13)} | {("a", "w13")}
    assert spelling.roots_of(chain.limit(0)).count() == 0
    words = spark.createDataFrame([("w3", 1), ("zz", 2), (None, 3)], "word string, root int")
    known = spelling.roots_of(chain)
    got = spelling.with_standard_words(words.drop("root"), known)
    assert {tuple(r) for r in got.collect()} == {("w3", "w13"), ("zz", "zz"), (None, None)}


# --- url filter ------------------------------------------------------------------------------------------------


def test_rules_by_plain_python(spark):
    urls = ["http://a.com/x", "http://com/", "http://acom/x", "https://example.com/en/1", "http://b.Example.COM/en/",
            "http://www.example.com/en/5?q=/es/", "http://x.www.example.com/en/", "http://wwwexample.com/en/", "http://q.net/es/1",
            "http://q.net/es", "ftp://net/fr/?x", "no scheme com/en/", None, "", "http://", "http://h.net", "http://h.com#a/b", "x://y.net/fr/a://b/c",
            "http://h.com:80/en/", "http://ü.COM/É?", "http://1.2.3.4/es/", "a" * 100_000 + "://long.com/" + "p" * 100_000]
    pages = spark.createDataFrame([(i, u, "h", 1, "r") for i, u in enumerate([*urls, urls[0]])],
                                  "page_id int, url string, host string, salt int, rule string")
    none = spark.createDataFrame([], "item int, bad boolean")
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, none).collect()}
    for i, u in enumerate(urls):
        rest = (u or "").partition("://")[2]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = host.translate(LOWER)
        fits = [r for r in url_filter.RULES if f".{host}".endswith(f".{r.host}") and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.host + r.path), default=None)
        assert got[i] == (host, path, best and best.host + best.path, best.verdict if best else "allow"), u
    assert len(got) == len(urls) + 1
    kept = url_filter.keep_allowed(pages, none)
    assert kept.columns == pages.columns
    assert {r.page_id for r in kept.collect()} == {i for i, g in got.items() if g[3] == "allow"}
    assert url_filter.judge_urls(pages.limit(0), none).count() == 0


def test_suffixes_and_domains(spark):
    known = {"a.b.example.com": ("com", "example.com"), "example.co.uk": ("co.uk", "example.co.uk"), "x.y.com.br": ("com.br", "y.com.br"),
             "co.uk": ("co.uk", "co.uk"), "xco.uk": ("uk", "xco.uk"), "localhost": ("localhost", "localhost"), "": ("", ""),
             "1.2.3.4": ("4", "1.2.3.4"), "a.example.org.": ("org", "example.org"), "a.example.org:8080": ("org", "example.org")}
    rows = spark.createDataFrame([(h,) for h in known], "host string")
    got = {r.host: (r.s, r.d) for r in rows.select("host", url_filter.suffix_of(F.col("host")).alias("s"),
                                                   url_filter.domain_of(F.col("host")).alias("d")).collect()}
    assert got == known


def test_bound_is_the_betas_quantile(spark):
    rng = np.random.default_rng(5)
    cases = [(2.0, 3.0), (8.0, 2.0), (40.0, 60.0), (0.9, 6.1), (700.0, 300.0)]
    rows = spark.createDataFrame(cases, "a double, b double").select(
        "a", "b", url_filter.lower_bound(F.col("a"), F.col("b")).alias("bound")).collect()
    for r in rows:
        assert -0.04 < r.bound - np.quantile(rng.beta(r.a, r.b, 400_000), 0.05) < 0.01      # rather too low than too high


def test_reputation_shrinks_towards_domain_and_suffix(spark):
    hosts = [(f"h{k}.bad-farm.com", 20, 19) for k in range(12)] + [(f"g{k}.good.com", 20, 1) for k in range(12)]
    hosts += [(f"o{k}.else{k}.net", 10, 1) for k in range(30)]
    hosts += [("new.bad-farm.com", 0, 0), ("new.good.com", 0, 0), ("one.good.com", 1, 1), ("fresh.io", 0, 0)]
    judged = lambda rows: {r.host: r for r in url_filter.host_reputation(
        spark.createDataFrame(rows, "host string, n bigint, bad bigint")).collect()}
    got = judged(hosts)
    assert len(got) == len(hosts)
    mean = {h: r.a / (r.a + r.b) for h, r in got.items()}
    assert got["new.bad-farm.com"].bound > 0.5 > got["new.good.com"].bound       # a domain speaks for its new hosts
    assert mean["new.good.com"] < mean["one.good.com"] < 0.3                     # one page does little, many decide
    worse = judged([*hosts, ("worse.good.com", 200, 190)])
    assert worse["worse.good.com"].bound > 0.8
    assert worse["one.good.com"].a / (worse["one.good.com"].a + worse["one.good.com"].b) > 0.3    # hosts differ: weaker prior
    assert mean["new.good.com"] < mean["fresh.io"] < mean["new.bad-farm.com"]    # an unknown suffix: the overall share


def test_outcomes_of_a_hot_host_and_repeated_labels(spark):
    pages = spark.createDataFrame([(i, f"http://hot.net/x/{i % 40}") for i in range(900)] + [(i, f"http://h{i}.org/y") for i in range(900, 950)],
                                  "page_id bigint, url string")
    told = [(i, True) for i in range(30)] + [(5, False), (7, None), (35, False), (None, True), (36, None)]
    outcomes = spark.createDataFrame(told, "item bigint, bad boolean")
    got = url_filter.judge_urls(pages, outcomes, item=F.regexp_extract("url", r"/([0-9]+)$", 1).try_cast("bigint"))
    rows = {r.id: r for r in got.collect()}
    assert len(rows) == 950
    n = sum(1 for i in range(900) if i % 40 < 30 or i % 40 == 35)
    bad = sum(1 for i in range(900) if i % 40 < 30)
    assert (rows[3].n, rows[3].bad, rows[3].verdict) == (n, bad, "block")
    assert rows[910].n == 0
