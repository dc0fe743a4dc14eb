"""Phrase collocations, importance resampling and URL filters."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from made_texts import LONG, PROSE

from wordloom.llm import collocations, resample, url_rules
from wordloom.llm.collocations import Index, Mining, Shard

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Collocations


def phrases_by_hand(pieces, length):
    return Counter(tuple(p[i : i + length]) for p in pieces for i in range(len(p) - length + 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=9), min_size=1, max_size=6))
def test_index_counts_every_phrase(pieces):
    symbols = np.array([0] + [x for p in pieces for x in (*p, 0)])
    shard = Shard(symbols, 5, 5)
    for length in range(1, 6):
        found = shard.of_length(length)
        spelled = [tuple(r) for r in shard.spelled(found).tolist()]
        want = phrases_by_hand(pieces, length)
        assert dict(zip(spelled, found.count.tolist(), strict=True)) == want
        # Both intervals hold the phrase, forwards and in reverse.
        for phrase, back, n in zip(spelled, found.back.tolist(), found.count.tolist(), strict=True):
            for at in shard.back.suffixes[back : back + n]:
                assert tuple(symbols[::-1][at : at + length]) == phrase[::-1]


@pytest.mark.parametrize("steps", ["RRRR", "LLLL", "RLLR", "LRRL"])
def test_extension_to_either_side(steps):
    rng = random.Random(4)
    pieces = [[rng.randrange(1, 4) for _ in range(rng.randrange(1, 12))] for _ in range(20)]
    shard = Shard(np.array([0] + [x for p in pieces for x in (*p, 0)]), 4, 5)
    found = shard.words()
    for step in steps:
        found = shard.extended(found, step == "R")
        got = dict(zip(map(tuple, shard.spelled(found).tolist()), found.count.tolist(), strict=True))
        assert got == phrases_by_hand(pieces, found.length)


def test_suffix_order_by_hand():
    symbols = np.array([0, 2, 1, 2, 1, 1, 0, 2, 2, 0])
    index = Index(symbols, 3, 5)
    # Past the end stands what is less than any symbol.
    keys = [tuple(symbols[i : i + 5].tolist() + [-1] * max(0, i + 5 - len(symbols))) for i in index.suffixes]
    assert keys == sorted(keys)
    for row, at in enumerate(index.suffixes):
        if at and symbols[at - 1]:
            before = keys[int(index.step[row])]
            assert before[0] == symbols[at - 1] and before[1:] == keys[row][:4]


def collocations_by_hand(rows, mining):
    pieces = defaultdict(list)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            pieces[lang or "und"].append(re.findall(r"[^\x20\x09]+", piece))
    out = []
    for lang, found in pieces.items():
        n = sum(map(len, found))
        f = {}
        for length in range(1, mining.words + 1):
            f |= {p: c for p, c in phrases_by_hand(found, length).items() if c >= mining.least}
        kept = []
        for phrase, a in f.items():
            size = len(phrase)
            inside = lambda q: any(q[i : i + size] == phrase for i in range(len(q) - size + 1))  # noqa: B023, E731
            if size < 2 or any(len(q) > size and c >= a and inside(q) for q, c in f.items()):
                continue
            score, k = min((1000 * a * n // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, size))
            kept.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]], n))
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(kept)[: mining.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("shard_bytes", [300, 1 << 20])
@pytest.mark.parametrize("filter_bits", [6, 20])
def test_collocations_by_hand(spark, shard_bytes, filter_bits):
    rng = random.Random(7)
    vocabulary = ["the", "Of", "é", "new", "york", "city", "İs", "a-b", "x\u00a0y"]
    rows = []
    for i in range(120):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",\n", "\t", "\r"]) for _ in range(rng.randrange(1, 40))]
        rows.append((rng.choice(["en", "fr", None, "und"]), " ".join(words) + " new york city hall" * (i % 3)))
    rows += [("en", None), (None, ""), ("en", " .,\n"), ("zz", PROSE * 12), ("zz", PROSE * 12)]
    mining = Mining(least=6, top=25, shard_bytes=shard_bytes, filter_bits=filter_bits)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = collocations.collocations(docs, mining).collect()
    assert sorted(tuple(r) for r in found) == collocations_by_hand(rows, mining)


def test_collocations_on_odd_tables(spark, odd_docs, no_docs):
    mining = Mining(least=3)
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    found = sorted(tuple(r) for r in collocations.collocations(odd_docs, mining).collect())
    assert found and found == collocations_by_hand(rows, mining)
    assert collocations.collocations(no_docs, mining).count() == 0
    assert collocations.collocations(odd_docs, Mining(least=10**6)).count() == 0


# Resampling


def runs_by_hand(text, words):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return [" ".join(found[i : i + n]) for n in range(1, words + 1) for i in range(len(found) - n + 1)], len(found)


def resample_by_hand(rows, target, r):
    bucket = lambda f: zlib.crc32(f.encode()) % r.buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, runs_by_hand(text, r.words)[0]))
    for text in target:
        t.update(map(bucket, runs_by_hand(text, r.words)[0]))
    ns, nt = sum(s.values()), sum(t.values())
    out = []
    for doc, text in rows:
        features, n_words = runs_by_hand(text, r.words)
        gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + r.buckets) / ((s[b] + 1) * (nt + r.buckets))))
        weight = sum(gain(bucket(f)) for f in features)
        h = int(hashlib.sha256(f"{r.seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((x for x in out if x[4] >= r.least_words), key=lambda x: (-x[3], -1 if x[0] is None else x[0], x[2], x[1]))
    drawn = {id(x): i + 1 for i, x in enumerate(able[: r.percent * len(able) // 100])}
    return [(*x[:4], drawn.get(id(x))) for x in out]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x or 0) for x in r])


@pytest.mark.parametrize("words", [1, 2, 3])
@pytest.mark.parametrize("slice_bytes", [200, 1 << 20])
def test_resampling_by_hand(spark, words, slice_bytes):
    rng = random.Random(words)
    texts = [
        "".join(rng.choice(["The", "cat", "é9", "sat", "İ", "x_y"]) + rng.choice([" ", "\n", "\n\n", ". ", "\n same line\n"]) for _ in range(rng.randrange(60)))
        for _ in range(150)
    ]
    rows = [*enumerate(texts), (3, texts[3]), (3, texts[3]), (None, texts[9]), (200, None), (201, ""), (202, "\n\n")]
    target = ["the cat sat\nthe cat", None, "", "é9 sat " * 9]
    r = resample.Resampling(words=words, buckets=50, percent=30, slice_bytes=slice_bytes)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = resample.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), r).collect()
    assert ordered(found) == ordered(resample_by_hand(rows, target, r))


def test_distinct_lines_are_read_once():
    lines = resample.Lines(pa.array(["one two\nthree\none two\nthree", "one two\n", "three", None]))
    assert lines.lines == 3 and sorted(lines.words) == [b"one", b"three", b"two"]  # "three" with and without its end
    assert np.bincount(lines.line).sum() == 6


def test_resampling_on_odd_tables(spark, odd_docs, no_docs):
    found = resample.resample(odd_docs, odd_docs.limit(0)).collect()
    want = resample_by_hand([(r["doc_id"], r["text"]) for r in odd_docs.collect()], [], resample.Resampling())
    assert ordered(found) == ordered(want)
    assert max(r["n_features"] for r in found) >= len(LONG.split()) - 1
    assert resample.resample(no_docs, no_docs).count() == 0


# URL filters

RULES = [
    url_rules.Rule("block", "net"), url_rules.Rule("allow", "example.net", "/en/"), url_rules.Rule("block", "example.net", "/en/x"),
    url_rules.Rule("block", "a.example.net", "/e"), url_rules.Rule("allow", "b.example.net", ""), url_rules.Rule("allow", "net", "/en/xy/z"),
    url_rules.Rule("block", "both.org", "/p/"), url_rules.Rule("allow", "both.org", "/p/"), url_rules.Rule("allow", "net"),
    url_rules.Rule("block", "deep.org", "/a/b/c/"), url_rules.Rule("allow", "deep.org", "/a/b/"), url_rules.Rule("block", "org", "//"),
]
URLS = [
    None, "", "no scheme", "http://", "://net", "http://net", "http://net/", "https://EXAMPLE.net/EN/", "https://example.net/en/", "http://example.net/en/x",
    "http://q.a.example.net/en/xy/z/1?x=/en/#y", "http://a.example.net/e", "http://a.example.net/f", "http://b.example.net", "http://b.example.net?q",
    "http://c.b.example.net#f", "http://notnet/", "http://x.notnet/", "http://both.org/p/", "http://both.org/p", "http://www.deep.org/a/b/c",
    "http://deep.org/a/b/c/d", "http://deep.org/a/b", "http://deep.org//a", "http://x..net/", "http://net:80/", "http://a://b.net/c", "http://net./",
    "ftp://.net/en/xy/zz", "http://ÄÖ.net/en/", "http://example.net/en/\n", "http://example.net?/en/",
]


def judged_by_hand(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(UPPER)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else default


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
def test_urls_by_hand(spark, most_bytes):
    pages = spark.createDataFrame([(i, u, "x", "y", None) for i, u in enumerate(URLS)], "page_id bigint, url string, host string, _won string, rule int")
    found = url_rules.judge(pages.union(pages), RULES, "block", most_bytes).collect()
    want = [(i, *judged_by_hand(u, RULES, "block")) for i, u in enumerate(URLS)]
    assert sorted(map(tuple, found), key=str) == sorted(want * 2, key=str)
    assert url_rules.judge(pages.limit(0), RULES, most_bytes=most_bytes).count() == 0


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["allow", "block"]), st.sampled_from(["a", "b.a", "c.b.a", "b", "a.a"]), st.text("/xy", max_size=4)), max_size=8),
    st.sampled_from(["a", "b.a", "c.b.a", "d.c.b.a", "b", "xa", "a.a", "", "a.", "..a"]),
    st.text("/xy", max_size=6),
)
def test_trie_by_hand(rules, host, path):
    rules = [url_rules.Rule(*r) for r in rules]
    path = "/" + path if path else ""
    won = url_rules.longest(url_rules.trie(rules), host, path)
    assert judged_by_hand(f"http://{host}{path}", rules)[2:] == ((won.written, won.verdict) if won else (None, "allow"))


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert [tuple(r) for r in url_rules.judge(pages, []).collect()] == [(1, "a.net", "/", None, "allow")]
    with pytest.raises(ValueError):
        url_rules.Rule("maybe", "net")
