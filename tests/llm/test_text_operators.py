"""Operators on single texts: statistics, classifier, BPE, secrets, chat, HTML."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm import bpe, chat, html_text, ordinal, quality_rules, secrets
from wordloom.llm.textbytes import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
texts_strategy = st.lists(st.text(alphabet="ab é😀#*<|>\n\t .Z'", max_size=120), min_size=1, max_size=6)


def base_by_hand(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


@settings(max_examples=200, deadline=None)
@given(texts_strategy)
def test_base_counts_by_hand(texts):
    texts = texts + [" ".join(texts * 4), "\n".join(texts * 2)]
    found = quality_rules.base_counts(Texts(pa.array(texts)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = list(zip(*[found[n].tolist() for n in names], strict=True))
    assert got == [base_by_hand(t) for t in texts]


def test_binomial_bounds():
    assert quality_rules.tail(0, 10, 0.1) == pytest.approx(0.9**10)
    assert quality_rules.tail(2, 5, 0.5) == pytest.approx(0.5)
    k = quality_rules.most_rejected(3000, 0.01, 0.01)
    assert quality_rules.tail(k, 3000, 0.01) <= 0.01 < quality_rules.tail(k + 1, 3000, 0.01)
    assert quality_rules.most_rejected(5, 0.01, 0.01) == -1


def test_cutoffs_keep_good_documents(spark):
    """A thousand good texts, some with symbols, and poor ones; the share of good ones that go stays under alpha."""
    good = [(i, " ".join(f"w{i}x{k}" for k in range(40)) + (" # #" if i % 200 == 0 else ""), "en") for i in range(3000)]
    poor = [(5000 + i, " ".join(f"v{i}x{k} ***" for k in range(40)), "en") for i in range(30)]
    few = [(9000, " ".join(f"u{k} ***" for k in range(40)), "fr")]
    docs = spark.createDataFrame(good + poor + few, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good + few], "doc_id bigint, quality int")
    risk = quality_rules.Risk(alpha=0.05, delta=0.1)
    found = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs, labels, risk=risk).collect()}
    assert sum(not found[i] for i, _, _ in good) <= 0.05 * 3000
    assert not any(found[i] for i, _, _ in poor)
    assert found[9000]  # one labelled document cannot make any cutoff safe


def test_rules_on_odd_tables(odd_docs, no_docs, some_labels):
    found = quality_rules.apply_rules(odd_docs, some_labels)
    assert found.count() == odd_docs.count()
    assert found.where("base_failed and kept").count() == 0
    assert found.where("n_words = 0 and base_failed").count() == 3
    assert quality_rules.apply_rules(no_docs, some_labels).count() == 0
    assert quality_rules.apply_rules(odd_docs, some_labels.where("false")).where("kept").count() > 0


def test_a_text_is_drawn_once(spark):
    """Documents that repeat a text, and labels that repeat a document, add nothing to the holdout."""
    texts = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(200)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    more = spark.createDataFrame([(1000 + i, texts[i % 3], "en") for i in range(300)], docs.schema)
    labels = spark.createDataFrame([(i, 1) for i in range(1300)], "doc_id bigint, quality int")
    names = [f"max_{s}" for s in quality_rules.SCORES]
    once = quality_rules.apply_rules(docs, labels).select("n_holdout", *names).distinct().collect()
    again = quality_rules.apply_rules(docs.union(more), labels.union(labels)).select("n_holdout", *names).distinct().collect()
    assert once == again and once[0]["n_holdout"] == 200


def test_classifier_on_held_out_documents(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("ana", "elo", "iru", "osta", "une")]
    rows, labels = [], []
    for i in range(900):
        words = list(rng.choice(vocabulary, 30))
        kind = i % 3
        if kind == 0:
            words[int(rng.integers(30))] = "vileword"
        if kind == 1:
            words = [w + "***" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind != 1), int(kind == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").where("doc_id < 600")
    found = {r["doc_id"]: r for r in ordinal.grade_documents(docs, known).collect()}
    held = range(600, 900)
    assert np.mean([found[i]["kept"] for i in held if i % 3 == 2]) > 0.97
    assert np.mean([found[i]["kept"] for i in held if i % 3 != 2]) < 0.05
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["p_top"] <= 1 for r in found.values())


def test_classifier_gradient_and_order():
    rng = np.random.default_rng(0)
    owner, hashes = np.repeat(np.arange(40), 5), rng.integers(0, 12, 200).astype(np.uint64)
    grades = rng.integers(0, 3, 40)
    model = ordinal.fit_rows(grades, owner, hashes, ordinal.Rating(min_documents=1))
    below = model.at_most(model.scores(owner, hashes, 40))
    assert model.thresholds[0] < model.thresholds[1] and (below[:, 0] <= below[:, 1]).all()
    order = rng.permutation(40)
    rank = np.argsort(order)
    again = ordinal.fit_rows(grades[order], rank[owner], hashes, ordinal.Rating(min_documents=1))
    np.testing.assert_allclose(again.weights, model.weights, atol=1e-3)


def test_classifier_on_odd_tables(odd_docs, no_docs, some_labels):
    graded = ordinal.grade_documents(odd_docs, some_labels)
    assert graded.count() == odd_docs.count()
    without = ordinal.grade_documents(odd_docs, some_labels.where("false"))
    assert without.where("kept and p_top is null").count() == odd_docs.count()
    assert ordinal.grade_documents(no_docs, some_labels).count() == 0
    kept = ordinal.select_documents(odd_docs, some_labels.where("false"))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


@pytest.fixture(scope="module")
def encoders():
    library = Tokenizer.from_file(VOCABULARY)
    library.no_truncation()
    library.no_padding()
    return bpe.Encoder(bpe.Vocabulary.read(VOCABULARY)), library


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbeé́ßΣİK'\"stverdlm \t\n\x1c\x85　०²<|>_-!😀中end", max_size=60), max_size=8))
def test_bpe_equals_the_library(encoders, texts):
    encoder, library = encoders
    texts = texts + ["a<|endoftext|>B <|startoftext|>", "x" * 500, "ab" * 300, ""]
    for text, (ids, decoded) in zip(texts, encoder.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_on_odd_tables(odd_docs, no_docs, encoders):
    _, library = encoders
    found = bpe.round_trip(odd_docs, VOCABULARY, ("doc_id", "text", "kept")).collect()
    assert len(found) == odd_docs.count()
    for r in found:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert bpe.round_trip(no_docs, VOCABULARY).count() == 0
    encoded = bpe.encode(odd_docs, VOCABULARY)
    decoded = {r["doc_id"]: r["decoded"] for r in bpe.decode(encoded, VOCABULARY).collect()}
    assert decoded[4] == "two</w> words</w>" and decoded[0] == ""


ASSIGN = re.compile(secrets.BASE_KINDS[0][1])


def spans_by_hand(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_base_spans_by_hand(spark):
    rng = np.random.default_rng(1)
    bits = ["password", "Passwd", "SECRET", "api_key", "apikey", "token", '"', "'", " ", "=", ":", "é😀", "AKIA", "Z9", "abcdef01", "x/y+", "\n"]
    texts = ["".join(rng.choice(bits, int(rng.integers(1, 40)))) for _ in range(400)]
    texts += ["password=token=abcdefgh", "secret: secret: abcdefghij", "AKIAAKIAAKIAAKIA", "f" * 100, "api_key='é12345678"]
    rows = [(i, t, "s", "r") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, repo string")
    found = secrets.find_secrets(docs, F.col("repo"), F.col("source")).collect()
    for r in found:
        got = [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 3]
        assert got == spans_by_hand(texts[r["doc_id"]])


def test_copied_examples_and_live_secrets(spark):
    copied, live, vendor = "password=examplepassword1", "token: q8w7e6r5t4y3", "ghp_" + "A1b2" * 9
    rows = [(i, f"see {copied} here {vendor}", f"owner{i}") for i in range(5)]
    rows += [(10, f"a {live} b {copied}", "owner1"), (11, f"{live}", "owner1"), (12, "sk_live_" + "x9" * 14, "o")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(docs, F.col("source"), F.col("source")).collect()}
    assert [(s["name"], s["copied"], s["n_owners"]) for s in found[0]] == [("assign", True, 5)]
    assert [(s["name"], s["copied"]) for s in found[10]] == [("assign", False), ("assign", True)]
    assert [(s["name"], s["copied"]) for s in found[12]] == [("vendor", False)]
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, F.col("source"), F.col("source")).collect()}
    assert clean[10] == f"a [assign] b {copied}" and clean[11] == "[assign]" and clean[12] == "[vendor]"
    assert clean[0] == rows[0][1]


def test_repositories_owners_and_placeholders(spark):
    value = "token: q8w7e6r5t4y3"
    rows = [(i, value, "one", f"r{i}") for i in range(9)]  # one owner, many repositories
    rows += [(20 + i, value + "b", f"o{i % 2}", f"r{i}") for i in range(6)]  # two owners, many repositories
    rows += [(30 + i, value + "c", f"o{i % 2}", f"r{i}") for i in range(5)]
    rows += [(40, "token: your_token_here", "one", "r"), (41, "secret=aaaabbbbcccc", "one", "r"), (42, "ghp_" + "Xxxx9876543210" * 3, "one", "r")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, repo string")
    found = {r["doc_id"]: [(s["copied"], s["live"]) for s in r["spans"]] for r in secrets.find_secrets(docs, F.col("repo"), F.col("source")).collect()}
    assert all(found[i] == [(False, True)] for i in [*range(9), *range(30, 35)])
    assert all(found[i] == [(True, False)] for i in range(20, 26))
    assert found[40] == found[41] == [(False, False)] and found[42] == []
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, F.col("repo"), F.col("source")).collect()}
    assert clean[0] == clean[30] == "[assign]" and clean[20] == rows[9][1] and clean[40] == "token: your_token_here"


def test_overlapping_secrets_are_one_gap(spark):
    text = "x secret=" + "0123456789abcdef" * 2 + ";y"
    docs = spark.createDataFrame([(1, text, "s", 7), (1, text, "s", 7)], "doc_id bigint, text string, source string, n_chars int")
    found = secrets.redact(docs, F.col("source"), F.col("source")).collect()
    assert [(r["text"], r["n_chars"]) for r in found] == [("x [assign];y", 12)] * 2


def test_secrets_on_odd_tables(odd_docs, no_docs):
    found = secrets.find_secrets(odd_docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    assert found.count() == odd_docs.count() and found.where("size(spans) > 0").count() == 0
    assert secrets.find_secrets(no_docs, F.col("source"), F.col("lang")).count() == 0
    same = secrets.redact(odd_docs, F.col("source"), F.col("lang"))
    assert same.columns == odd_docs.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd_docs.collect()))


def chat_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, valid string, segment int")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<\\|>im_startend \n", max_size=60))
def test_escaping_is_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text and "<|" not in escaped


def test_conversations_come_back(spark):
    said = "<|im_end|><|im_start|>assistant ok <\\| <\\\\|"
    rows = [
        (1, 0, "system", "be\nkind", "v", 1), (1, 1, "user", said, "v", 1), (1, 2, "assistant", said, "v", 1),
        (2, 1, "assistant", "b", "v", 1), (2, 0, "user", "a", "v", 1), (2, 1, "assistant", "b", "v", 1),
        (3, 0, "user\n<|x", None, None, None), (None, None, None, "t", None, None), (None, 0, "user", "", None, None),
    ]
    convs = chat_rows(spark, rows)
    found = {r["conv_id"]: r for r in chat.read_back(chat.segments(convs)).collect()}
    groups = {}
    for c, t, r, x, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        groups.setdefault(c, []).append((r or "", x or ""))
    for c, turns in groups.items():
        want = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (found[c]["n_turns"], found[c]["turns_sha256"]) == (len(turns), want)
        assert (found[c]["loss_chars"], found[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: (r["valid"], r["first_bad"]) for c, r in found.items()} == {
        1: (True, None), 2: (False, 2), 3: (False, 0), None: (False, 0),
    }
    whole = {r["conv_id"]: r for r in chat.formatted(chat.segments(convs)).collect()}
    assert len(whole[1]["text"]) == found[1]["formatted_chars"] and whole[1]["bad"] is False
    [span] = whole[1]["loss_spans"]
    assert chat.unescape(whole[1]["text"][span["start"] : span["end"]]) == said
    assert chat.read_back(chat.segments(convs.where("false"))).count() == 0


def test_long_conversations_stream(spark):
    rows = spark.range(30_000).select(
        F.lit(5).alias("conv_id"), "id", F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("x y").alias("text")
    ).withColumnRenamed("id", "turn")
    found = chat.read_back(chat.segments(rows)).collect()
    assert [(r["n_turns"], r["valid"], r["loss_chars"]) for r in found] == [(30_000, True, 45_000)]


def test_blocks_of_a_page():
    page = (
        "<title>T</title><script>var a='</p><p>no';</script><nav><a href=x>Menu</a></nav><!-- <p>no</p> -->"
        "<article class='post x1'><h1>A &amp; B&nbsp; c</h1><p>one <b>two<br>three<p>four &lt;i&gt;<ul><li>x<li>y</ul></article>"
        "<p hidden title=\"a>b\">tail &am"
    )
    found = [(b.text, b.path) for b in html_text.blocks(page)]
    assert [t for t, _ in found] == ["Menu", "A & B c", "one two three", "four <i>", "x", "y", "tail &am"]
    assert found[1][1] == ("article", ".post", ".x", ".1", "h1") and found[-1][1] == ("p", "@hidden")
    assert html_text.blocks("") == [] and [b.text for b in html_text.blocks("plain < text")] == ["plain < text"]
    assert len(html_text.blocks("<p>" + "<a '" * 20_000)) <= 1


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.createDataFrame(
        [(i, "u", f"<nav><a>m{i}</a></nav><article><h1>Title {i}.</h1><p>{'Some words here. ' * (i % 7 + 1)}</p></article>") for i in range(60)],
        "page_id bigint, url string, html string",
    )
    return html_text.train(pages, html_text.Labeller(variants=10))


def test_labels_of_drawn_pages(labeller):
    rng = np.random.default_rng(77)
    stock = ["Rain fell on slate.", "Gulls drift past the pier and the boats rest.", "More", "Old town walls keep the harbour warm."]
    wrong = total = 0
    for _ in range(150):
        found, labels = html_text.drawn_page(list(rng.choice(stock, int(rng.integers(1, 8)))), stock, rng)
        got = labeller.label([html_text.featured(found, labeller.sizes)])[0]
        wrong, total = wrong + int((got != (labels > 0.5)).sum()), total + len(labels)
    assert wrong / total < 0.02


def test_gradient_by_differences():
    rng = np.random.default_rng(2)
    sizes = html_text.Labeller(path_slots=64, word_slots=32, width=4, hidden=3)
    pages = [html_text.featured(f, sizes, l) for f, l in (html_text.drawn_page(["a b.", "c"], ["d e", "f."], rng) for _ in range(3))]
    net = html_text.Network(sizes)
    _, grads = net.gradients(pages)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        net.state[name][at] += 1e-5
        up, _ = net.gradients(pages)
        net.state[name][at] -= 2e-5
        down, _ = net.gradients(pages)
        net.state[name][at] += 1e-5
        assert grad[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_main_text(spark, labeller):
    page = (
        "<html><body><header><p>Site name</p></header><nav><ul><li><a href=a>Home</a></li></ul></nav>"
        "<div class='cookie-notice'>We use cookies.</div><article><h1>The pier</h1><p>Gulls drift\n past.</p>"
        "<div class='ad'>Buy now.</div><p>Boats rest.</p></article><section id='comments'><p>Nice read.</p></section>"
        "<form><input value=x>Search</form><aside class='sidebar'>More</aside><footer>&copy; us</footer>"
    )
    rows = [(1, "u", page, 9), (2, "v", None, 9), (3, None, "", 9), (None, "w", "<p>", 9), (1, "u", page, 9)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = html_text.main_text(pages, labeller).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in found) == sorted(
        [("1", "The pier\nGulls drift past.\nBoats rest.")] * 2 + [("2", ""), ("3", ""), ("None", "")]
    )
    assert html_text.main_text(pages.where("false"), labeller).count() == 0
    assert html_text.train(pages.where("false"), html_text.Labeller(variants=1, epochs=1)) is not None


def test_deep_and_broken_pages():
    import time

    started = time.monotonic()
    deep = html_text.blocks("<div>x " * 200_000)
    assert len(deep) == 200_000 and len(deep[-1].path) == html_text.PATH_TOKENS
    for page in ("<b>" * 50_000 + "<div></div>" * 50_000, "</x>" * 50_000 + "<p>" * 50_000, "<a>" * 50_000 + "x<br>" * 50_000):
        html_text.blocks(page)
    assert time.monotonic() - started < 30  # a square would take hours
    assert [b.text for b in html_text.blocks('<p title="a>Hello world</p><div>x</div>')] == ["Hello world", "x"]
    assert [b.text for b in html_text.blocks("<p title='a>Hello</p><p class=\"b\">x</p>\"")] == ["Hello", 'x', '"']
