"""Operators across documents: repeated spans, leaks, near duplicates, revisits, and the pipeline."""

import random
import re
from collections import defaultdict
from itertools import combinations

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from check import canonical
from made_texts import PROSE, numbered
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm import decontaminate, near, queries, substrings, warc
from wordloom.llm.components import components
from wordloom.llm.oracles import ORACLES
from wordloom.llm.textbytes import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def shingles_by_hand(text):
    words = WORD.findall(text or "")
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes_by_hand(texts):
    """(class, links, copies) of each text, by comparing all pairs."""
    distinct = list(dict.fromkeys(t or "" for t in texts))
    sets = [shingles_by_hand(t) for t in distinct]
    parent, links = list(range(len(distinct))), [0] * len(distinct)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(distinct)), 2):
        common = len(sets[a] & sets[b])
        if common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
            links[a], links[b] = links[a] + 1, links[b] + 1
            parent[find(a)] = find(b)
    ids = defaultdict(list)
    for i, t in enumerate(texts):
        ids[find(distinct.index(t or ""))].append(i)
    return [
        (min(ids[find(distinct.index(t or ""))]), links[distinct.index(t or "")], sum((x or "") == (t or "") for x in texts))
        for t in texts
    ]


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"e{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("block", [4, 256])
def test_near_classes_equal_all_pairs(spark, block):
    """A family of near copies over several blocks, chains, pairs at the threshold, copies and short texts."""
    rng = random.Random(4)
    texts = [edited(rng, numbered(120, "f").split(), rng.randrange(6)) for _ in range(40)]
    texts += [edited(rng, numbered(60, f"g{i}").split(), k) for i in range(10) for k in (0, 1, 2, 3)]
    base = numbered(94, "h").split()  # 90 shingles; ten words more or fewer decide the threshold
    texts += [" ".join(base), " ".join(base[:76]), " ".join(base[:75]), " ".join(base[:77])]
    texts += [texts[0]] * 3 + ["", None, "", "one two", "one two", "one  two", "a b c d e", None]
    found = near.join_near(docs_of(spark, texts), near.Nearness(block=block, pruning_block=block)).collect()
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in found}
    assert [got[i] for i in range(len(texts))] == classes_by_hand(texts)


def test_pruning_keeps_pairs_at_the_threshold():
    limits = near.Nearness().least_equal()
    assert limits[-1][0] == 96 and all(0 <= least < n * 0.8 for n, least in limits)
    from wordloom.llm.quality_rules import tail

    for n, least in limits:
        assert tail(least, n + 1, 0.8) >= 1e-6
        assert least == 0 or tail(least - 1, n + 1, 0.8) < 1e-6


def test_signatures_estimate_similarity():
    config = near.Nearness()
    a, b = numbered(400, "s").split(), numbered(400, "s").split()
    b[350:] = numbered(50, "t").split()
    owner, hashes = near.shingles(Texts(pa.array([" ".join(a), " ".join(b)])), 5)
    sig = near.signatures(owner, hashes, 2, config)
    sets = [shingles_by_hand(" ".join(x)) for x in (a, b)]
    share = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert abs((sig[0] == sig[1]).mean() - share) < 0.15


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(7000, 7001), (7001, 7000), (5, 5)]
    rng.shuffle(edges)
    found = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect():
        found[r["root"]].add(r["node"])
    assert sorted(map(len, found.values())) == [2, 200, 301]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_document_of_each_class(spark, odd_docs, no_docs):
    kept = near.one_of_each(odd_docs)
    rows = kept.collect()
    assert kept.columns == odd_docs.columns
    texts = [r["text"] for r in rows]
    assert len([t for t in texts if not t]) == 1 and texts.count(PROSE * 3) == 1
    assert {r["doc_id"] for r in rows} == {0, 2, 3, 4, 5, 6, 8, 9}
    assert near.one_of_each(no_docs).count() == 0 and near.join_near(no_docs).count() == 0
    ties = spark.createDataFrame([(1, numbered(30, "a")), (1, numbered(30, "b")), (None, numbered(30, "c"))], "doc_id bigint, text string")
    assert near.one_of_each(ties).count() == 3


def chunks_of(texts):
    """The chunks of each text, as tuples of words."""
    held = Texts(pa.array(texts))
    begin, behind, owner = substrings.cut(held, substrings.Chunking())
    starts, ends, _ = held.words()
    word = [bytes(held.data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    out = [[] for _ in texts]
    for a, b, t in zip(begin, behind, owner, strict=True):
        out[t].append(tuple(word[a:b]))
    return out


def test_chunks_cover_and_resist_shifts():
    body = numbered(400, "c") + " é漢字😀 " * 40 + "z" * 3000
    texts = [body, "XX é " + body, "", "a", body.replace(" ", " \n\t"), body + " " + body]
    found = chunks_of(texts)
    for text, chunks in zip(texts, found, strict=True):
        assert [w for c in chunks for w in c] == WORD.findall(text)
        assert all(len(c) <= substrings.Chunking().reach for c in chunks)
    assert found[4] == found[0] and 5 < np.mean([len(c) for c in found[0] if c[0].startswith("cq")]) < 12
    for other in (1, 5):
        assert len(set(found[0]) - set(found[other])) <= 4


def test_cuts_are_those_of_a_plain_rule():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b cc ddd eeee".split()) for _ in range(rng.randrange(90))) for _ in range(40)]
    reach, seed = substrings.Chunking().reach, substrings.Chunking().seed
    for text, chunks in zip(texts, chunks_of(texts), strict=True):
        words = text.split()
        raw = "".join(texts).replace(" ", "")  # the hash rolls on over texts that stand before
        before = "".join(texts[: texts.index(text)]).replace(" ", "")
        rolled = substrings.gear_hashes(np.frombuffer(raw.encode(), np.uint8), seed)
        ends = np.cumsum([len(w) for w in words]) + len(before)
        h = [int(rolled[e - 1]) for e in ends]
        cut = {i for s in range(len(h) - reach + 1) for i in range(s, s + reach) if h[i] == min(h[s : s + reach])}
        assert [sum(map(len, chunks[: i + 1])) - 1 for i in range(len(chunks))] == sorted(cut | {len(h) - 1} if h else [])


def test_gear_hash_by_hand():
    data = np.frombuffer(numbered(30).encode(), np.uint8)
    single = np.array([substrings.gear_hashes(np.array([b], np.uint8), 3)[0] for b in range(256)], np.uint64)
    found = substrings.gear_hashes(data, 3)
    for i in range(20, 60):
        want = sum(int(single[data[i - j]]) << (2 * j) for j in range(16)) % (1 << 32)
        assert int(found[i]) == want


def test_repeated_passages(spark):
    passage = numbered(70, "p")
    texts = [numbered(80, f"d{i}") + " " + passage + " " + numbered(50, f"t{i}") for i in range(4)]
    texts += [numbered(200, "u"), numbered(90, "v") + " Licensed under some licence.", numbered(90, "w") + " Licensed under some licence.", None, ""]
    docs = docs_of(spark, texts)
    spans = substrings.repeated_spans(docs)
    found = spans.collect()
    assert sorted(r["doc_id"] for r in found) == [0, 1, 2, 3]
    for r in found:
        assert texts[r["doc_id"]][r["start"] : r["end"]] in passage + " " and 45 <= r["n_words"] <= 70
        assert r["first_doc_id"] == 0 and r["is_first"] == (r["doc_id"] == 0)
    cleaned = {r["doc_id"]: r["text"] for r in substrings.without_repeats(docs, spans).collect()}
    assert cleaned[0] == texts[0] and cleaned[7] is None and cleaned[4] == texts[4]
    assert len(cleaned[1]) < len(texts[1]) - 250 and cleaned[1].startswith(numbered(80, "d1"))


def test_repeats_on_odd_tables(odd_docs, no_docs):
    found = substrings.repeated_spans(odd_docs)
    assert {r["doc_id"] for r in found.collect()} == {6, 7, None}
    assert substrings.repeated_spans(no_docs).count() == 0
    assert substrings.without_repeats(odd_docs, found).columns == odd_docs.columns


@pytest.mark.parametrize("words", [50, 51, 55])
def test_short_passages_in_two_documents(spark, words):
    seeds = range(60)
    rng = np.random.default_rng(words)
    texts, passages = [], []
    for s in seeds:
        passages.append(" ".join(f"{rng.integers(1 << 20):x}" for _ in range(words)))
        texts += [f"{numbered(int(rng.integers(90)), f'{s}{side}')} {passages[s]} {numbered(40, f'{side}{s}')}" for side in "ab"]
    texts += [f"{numbered(40, m)} {numbered(49, 'short')} {numbered(40, m * 2)}" for m in "xy"]
    found = {r["doc_id"]: r for r in substrings.repeated_spans(docs_of(spark, texts)).collect()}
    assert sorted(found) == list(range(2 * len(seeds)))
    for i, r in found.items():
        assert texts[i][r["start"] : r["end"]] == passages[i // 2] and r["n_words"] == words
        assert r["first_doc_id"] == i // 2 * 2 and r["is_first"] == (i % 2 == 0)


def test_chunks_of_repetitive_passages():
    for s in range(60):
        body = " ".join((" ".join(f"{s}r{i}" for i in range(1 + s % 14)) + " ").split() * 70)
        one, two = chunks_of([numbered(20, f"a{s}") + " " + body + " " + numbered(9, "c"), numbered(31, f"bb{s}") + " " + body + " x"])
        assert set(one) & set(two)


def spans_by_hand(rows, width):
    """(doc_id, start, end, n_words, first_doc_id, is_first) by comparing all windows of all rows."""
    places, holders = [], defaultdict(set)
    for r, (_, text) in enumerate(rows):
        found = list(WORD.finditer(text or ""))
        windows = [tuple(m[0] for m in found[i : i + width]) for i in range(len(found) - width + 1)]
        places.append((found, windows))
        for w in windows:
            holders[w].add(r)
    out = []
    for r, (doc, _) in enumerate(rows):
        found, windows = places[r]
        at = [i for i, w in enumerate(windows) if len(holders[w]) > 1]
        runs = []
        for i in at:
            if runs and i <= runs[-1][-1] + width:
                runs[-1].append(i)
            else:
                runs.append([i])
        for run in runs:
            ids = [[rows[x][0] for x in holders[windows[i]] if rows[x][0] is not None] for i in run]
            firsts = [min(x) if x else None for x in ids]
            known = [f for f in firsts if f is not None]
            out.append((
                doc, found[run[0]].start(), found[run[-1] + width - 1].end(), run[-1] + width - run[0],
                min(known) if known else None, doc is not None and all(f == doc for f in firsts),
            ))
    return sorted(out, key=str)


def spans_found(docs):
    names = ("doc_id", "start", "end", "n_words", "first_doc_id", "is_first")
    return sorted((tuple(r[n] for n in names) for r in substrings.repeated_spans(docs).collect()), key=str)


def test_spans_equal_a_comparison_of_all_windows(spark):
    """Real texts, shifted by insertions: words before and inside them that no other text has."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rng = random.Random(2)
    shifted = []
    for doc, text in rows[:300]:
        words = re.split(r"(\s+)", text)
        for k in range(3):
            words.insert(2 * rng.randrange(len(words) // 2 + 1), f"ins{doc}x{k} ")
        shifted.append((10_000 + doc, "".join(words)))
    rows += shifted
    found = spans_found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert len(found) > 900 and found == spans_by_hand(rows, 50)


@pytest.mark.parametrize("hot", [20_000, 10**9])
def test_spans_of_copies_and_mosaics(spark, monkeypatch, hot):
    """Texts that share sentences in changing order, one-letter words, exact copies, one text that most rows have."""
    monkeypatch.setattr(substrings, "HOT_KEYS", hot)
    rng = random.Random(9)
    sentences = [" ".join(rng.choice("a b c d e ff g hh".split()) for _ in range(rng.randrange(8, 30))) for _ in range(25)]
    rows = [(i, " ".join(rng.choice(sentences) for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    rows += [(200 + i, numbered(80, "hot")) for i in range(70)] + [(5, rows[5][1]), (5, rows[5][1]), (None, rows[8][1]), (None, None)]
    rows += [(900, numbered(60, "once") + " " + numbered(60, "once")), (901, numbered(49, "s")), (902, numbered(49, "s"))]
    found = spans_found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert found == spans_by_hand(rows, 50)


def test_repetitive_passages(spark):
    texts, bodies = [], []
    for s in range(60):
        period = " ".join(f"{s}r{i}" for i in range(1 + s % 12))
        bodies.append(" ".join((f"{period} " * 80).split()[: 55 + s]))
        texts += [f"{numbered(3 * s + 1, f'{s}{side}')} {bodies[s]} {numbered(40, f'{side}{s}')}" for side in "ab"]
    found = {r["doc_id"]: r for r in substrings.repeated_spans(docs_of(spark, texts)).collect()}
    assert {i: texts[i][r["start"] : r["end"]] for i, r in found.items()} == {i: bodies[i // 2] for i in range(120)}


def edits_inside(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != x)))
        before = row
    return min(before)


def test_leaks_equal_full_alignment():
    rng = random.Random(8)
    letters = "abcdefghij klmno"
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([10, 14, 40, 96, 150])))) for i in range(12)] + [(90, None)]
    patterns = decontaminate.Patterns(items, decontaminate.Budget())
    texts = []
    for _ in range(60):
        fragment = list(rng.choice(items[:12])[1])
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(fragment))
            kind = rng.randrange(3)
            fragment[at : at + (kind > 0)] = [rng.choice(letters)] if kind < 2 else []
        texts.append("".join(rng.choice(letters) for _ in range(rng.randrange(60))) + "".join(fragment) + rng.choice(["", " tail of it"]))
    got = {(t, item) for t, item, *_ in decontaminate.search(patterns, texts)}
    want = set()
    for t, text in enumerate(texts):
        for p, item, k in zip(patterns.text, patterns.item, patterns.edits, strict=True):
            if edits_inside("".join(map(chr, p)), decontaminate.normal(text)) <= k:
                want.add((t, item))
    assert got == want and len(want) > 20


def test_leak_spans_point_into_the_raw_text(spark, odd_docs, no_docs):
    item = PROSE.strip()
    docs = docs_of(spark, ["İx  \n " + item.upper().replace(" ", " \n ") + " end", "clean text", None, item[:60]])
    bench = spark.createDataFrame([(7, item), (8, None), (9, "short"), (7, item)], "item_id bigint, text string")
    [r] = decontaminate.find_leaks(docs, bench).collect()
    text = docs.where("doc_id = 0").first()["text"]
    assert (r["doc_id"], r["item_id"], r["edits"]) == (0, 7, 0)
    assert decontaminate.normal(text[r["start"] : r["end"]]) == decontaminate.normal(item)
    assert sorted(x["doc_id"] for x in decontaminate.drop_leaks(docs, bench).collect()) == [1, 2, 3]
    small = decontaminate.Budget(slice_chars=50)
    assert decontaminate.find_leaks(docs, bench, small).count() == 1
    kept = decontaminate.drop_leaks(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.where("text is null").count() == 1 and kept.count() == 8
    assert decontaminate.find_leaks(no_docs, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0


def test_canonical_urls(spark):
    cases = {
        "HTTPS://WWW.Example.COM:443/a/?utm_source=x&b=1&utm_m=2#top": "example.com/a?b=1",
        " http://example.com/ ": "example.com",
        "http://example.com/x?utm_a=1": "example.com/x",
        "example.com/X/y": "example.com/X/y",
    }
    rows = spark.createDataFrame(list(cases.items()), "url string, want string")
    assert rows.where(warc.canonical(F.col("url")) != F.col("want")).count() == 0


def resolved_by_hand(records):
    out = []
    for rid, url, date, kind, headers in records:
        if kind != "revisit":
            continue
        earlier = [r for r in records if r[3] == "response" and r[1] == url and url and None not in (r[2], date) and r[2] < date]
        own = {k.lower(): v for k, v in headers or []}
        if not earlier:
            out.append((rid, None, "missing"))
            continue
        best = max(earlier, key=lambda r: (r[2], r[0]))
        have = {k.lower(): v for k, v in best[4] or []}
        if "etag" in own:
            good = own["etag"].removeprefix("W/") == have.get("etag", "\0").removeprefix("W/")
        elif "last-modified" in own:
            good = own["last-modified"] == have.get("last-modified")
        else:
            out.append((rid, None, "unvalidated"))
            continue
        out.append((rid, best[0] if good else None, "resolved" if good else "changed"))
    return sorted(out)


@pytest.mark.parametrize("ranges", [1, 7])
def test_revisits_as_of_their_date(spark, ranges):
    """One URL holds most records, so its captures lie in many ranges."""
    rng = random.Random(5)
    records = []
    for i in range(600):
        url = rng.choice(["hot.example/x"] * 8 + ["a.example", "b.example/y", None])
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        headers = rng.choice([[("ETag", f'"{rng.randrange(2)}"')], [("etag", f'W/"{rng.randrange(2)}"')], [("Last-Modified", "d")], [], None])
        records.append((i, url, rng.choice([None, *range(150)]), kind, headers))
    rows = spark.createDataFrame(
        records, "record_id bigint, url string, date bigint, kind string, headers array<struct<name:string,value:string>>"
    )
    found = warc.resolve(rows, ranges).collect()
    assert sorted((r["record_id"], r["response_id"], r["state"]) for r in found) == resolved_by_hand(records)
    assert warc.resolve(rows.where("false"), ranges).count() == 0


def test_merged_headers(spark):
    old = [("ETag", '"1"'), ("Content-Length", "10"), ("Cache-Control", "old"), ("X-A", "1"), (None, "n")]
    new = [("etag", 'W/"1"'), ("content-length", "0"), ("cache-control", "new"), ("X-B", "2"), ("Connection", "close")]
    rows = spark.createDataFrame(
        [(1, "u", 1, "response", old), (2, "u", 2, "revisit", new), (2, "u", 2, "revisit", new)],
        "record_id bigint, url string, date bigint, kind string, headers array<struct<name:string,value:string>>",
    )
    found = warc.resolve(rows).collect()
    want = [("cache-control", "new"), ("content-length", "10"), ("etag", 'W/"1"'), ("x-a", "1"), ("x-b", "2")]
    assert [[tuple(h) for h in r["headers"]] for r in found] == [want, want]


@pytest.mark.parametrize("ranges", [1, 2, 9])
def test_the_later_response_counts_across_ranges(spark, ranges):
    """Two responses of one URL lie in different ranges; the later one is stale for the revisit that names the first."""
    filler = [(100 + i, "http://www.b.example/", 10 + i, "response", [("ETag", f'"{i}"')]) for i in range(30)]
    records = [
        (1, "http://b.example", 1, "response", [("ETag", '"old"')]), *filler,
        (2, "https://b.example/#x", 90, "revisit", [("ETag", '"old"')]),
        (3, "b.example:443", 91, "revisit", [("ETag", 'W/"29"'), ("Date", "d")]),
        (4, "b.example", 2, "revisit", [("ETag", '"old"')]),
    ]
    rows = spark.createDataFrame(
        records, "record_id bigint, url string, date bigint, kind string, headers array<struct<name:string,value:string>>"
    )
    found = {r["record_id"]: (r["state"], r["response_id"]) for r in warc.resolve(rows, ranges).collect()}
    assert found == {2: ("changed", None), 3: ("resolved", 129), 4: ("resolved", 1)}


def test_repeated_header_names(spark):
    old = [("ETag", '"1"'), ("etag", '"2"'), ("Set-Cookie", "a"), ("Set-Cookie", "b"), ("Vary", "x"), ("vary", "y")]
    new = [("ETag", '"1"'), ("ETag", '"3"'), ("Vary", "z"), ("VARY", "w")]
    rows = spark.createDataFrame(
        [(1, "u", 1, "response", old), (2, "u", 2, "revisit", new)],
        "record_id bigint, url string, date bigint, kind string, headers array<struct<name:string,value:string>>",
    )
    [found] = warc.resolve(rows).collect()
    want = [("etag", '"1"'), ("etag", '"3"'), ("set-cookie", "a"), ("set-cookie", "b"), ("vary", "w"), ("vary", "z")]
    assert found["state"] == "resolved" and [tuple(h) for h in found["headers"]] == want


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels", "benchmark"):
        connection.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, db, name):
    got, want = queries.queries()[name](spark, FOLDER).toPandas(), db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    assert canonical(got).equals(canonical(want))


def test_pipeline_stages(spark):
    """Each stage on what its predecessor kept, against the tables and the operators' own tests."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.saved(stage(spark, docs, FOLDER))
        if name != "bpe":
            assert after.columns == docs.columns
            assert after.join(docs, "doc_id", "left_anti").count() == 0
        seen.append((name, docs, after))
        docs = after
    by_name = {n: (before, after) for n, before, after in seen}
    rows = by_name["ngram_jaccard_join"][0].collect()
    want = {c for c, _, _ in classes_by_hand([r["text"] for r in rows])}
    assert {r["doc_id"] for r in by_name["ngram_jaccard_join"][1].collect()} == {rows[i]["doc_id"] for i in want}
    before, after = (by_name["benchmark_decontamination"][i].collect() for i in (0, 1))
    items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in after}
    for r in before:
        if any(i in decontaminate.normal(r["text"]) for i in items):
            assert r["doc_id"] not in left
    library = Tokenizer.from_file(VOCABULARY)
    ids = {r["doc_id"]: r["ids"] for r in by_name["bpe"][1].collect()}
    for r in by_name["bpe"][0].collect():
        want = library.encode(r["text"], add_special_tokens=False).ids
        assert np.frombuffer(ids[r["doc_id"]], "<u4").tolist() == want
        assert not re.search("(?i)(password|token)[\"']? ?[:=] ?[\"']?[0-9a-f]{16}", r["text"])
    before, after = by_name["secret_scans"]
    assert before.count() == after.count() == by_name["bpe"][1].count()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1 and toxic = 0")
    lost = by_name["quality_classifier"][0].join(labels, "doc_id").join(by_name["quality_classifier"][1], "doc_id", "left_anti")
    assert lost.count() <= 0.02 * labels.count()


def test_pipeline_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    """Null ids and texts, repeated rows and other columns pass through every stage, and so does an empty table."""
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            after = corpus_pipeline.saved(stage(spark, docs, FOLDER))
            if name == "bpe":
                assert after.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]
                assert after.count() == docs.count()
            else:
                assert after.columns == docs.columns and after.count() <= docs.count()
            docs = after
