"""BPE encoding and decoding with a vocabulary file of a public tokenizer, in batched NumPy merge rounds.

The symbols of many words lie in one flat array. A round looks up every neighbouring pair by binary search among
the sorted pair keys, merges the pairs of lowest rank of every word, and takes out the words that have no pair
left. Words between white space are encoded once and remembered by their task within a bound of bytes.

Letters and numbers are those of the installed `regex` module's Unicode version. Handled are files with a Unicode form, white space and lower case as normalisers, a split pattern and byte-level
symbols, words that end in a suffix, and special tokens that are found in the raw text.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wordloom.llm.textbytes import map_texts

REMEMBERED_BYTES = 48 << 20  # of words that an encoder has learnt; each counts ENTRY_BYTES besides its own
ENTRY_BYTES = 400
BIT = 16
NO_RANK = np.iinfo(np.int32).max
ODD_SPACE = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next unused one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What encoding needs of the file; it is read on the driver and sent to the tasks."""

    tokens: list[str]
    pattern: str
    form: str | None
    lower: bool
    suffix: str
    special: dict[str, int]
    merges: list[tuple[str, str]]
    digest: str

    @staticmethod
    def read(path: str) -> Vocabulary:
        raw = Path(path).read_bytes()
        file = json.loads(raw)
        model, normal = file["model"], file["normalizer"]["normalizers"]
        kinds = [n["type"] for n in normal]
        known = {"NFC", "Replace", "Lowercase"}
        if model["type"] != "BPE" or not set(kinds) <= known or file["decoder"] is not None or model["unk_token"]:
            raise ValueError(f"{path}: this kind of vocabulary is not handled")
        vocabulary = model["vocab"]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        size = max([*vocabulary.values(), *special.values()]) + 1
        if size > 1 << BIT:
            raise ValueError(f"{path}: more than {1 << BIT} tokens")
        tokens = [""] * size
        for token, i in [*vocabulary.items(), *special.items()]:
            tokens[i] = token
        split = next(p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return Vocabulary(
            tokens, split["pattern"]["Regex"], "NFC" if "NFC" in kinds else None, "Lowercase" in kinds,
            model["end_of_word_suffix"] or "", special, merges, hashlib.sha256(raw).hexdigest(),
        )


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        ids = {t: i for i, t in enumerate(vocabulary.tokens)}
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int32)
        self.last = np.array([ids[s + vocabulary.suffix] for s in symbols], np.int32)
        keys = np.array([(ids[a] << BIT) + ids[b] for a, b in vocabulary.merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in vocabulary.merges], np.int32)
        self.split = regex.compile(vocabulary.pattern)
        self.special = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None
        self.plain = self.split.findall("ab, 'cd' x1!") == ["ab", ",", "'", "cd", "'", "x", "1", "!"]
        self.known: dict[str, tuple[bytes, str]] = {}
        self.known_bytes = 0

    def _pairs(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each symbol but the last; NO_RANK if there is none."""
        keys = (symbols[:-1].astype(np.int64) << BIT) + symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (word[:-1] == word[1:]), self.ranks[at], NO_RANK)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, ids in each word) from byte symbols and their number in each word."""
        n = len(lengths)
        word = np.repeat(np.arange(n), lengths)
        place = np.arange(len(symbols))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            ranks = np.append(self._pairs(symbols, word), NO_RANK) if len(symbols) > 1 else np.full(1, NO_RANK)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(word)])
            best = np.minimum.reduceat(ranks, starts)
            over = np.repeat(best == NO_RANK, counts)
            if over.any():
                done.append((word[over], place[over], symbols[over]))
                symbols, word, place, ranks = symbols[~over], word[~over], place[~over], ranks[~over]
                counts, best = counts[best != NO_RANK], best[best != NO_RANK]
            at = np.flatnonzero(ranks == np.repeat(best, counts))
            if not len(at):
                continue
            # Of pairs that overlap, as in a run of one symbol, every other one merges, from the left.
            fresh = np.r_[True, np.diff(at) != 1]
            run = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            at = at[run % 2 == 0]
            symbols[at] = self.merged[ranks[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, word, place = symbols[stays], word[stays], place[stays]
        if not done:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        owner, place, out = (np.concatenate(x) for x in zip(*done, strict=True))
        return out[np.argsort(place, kind="stable")], np.bincount(owner, minlength=n)

    def _normal(self, chunk: str) -> str:
        if chunk.isascii():
            return chunk.lower() if self.vocabulary.lower else chunk
        if self.vocabulary.form:
            chunk = unicodedata.normalize(self.vocabulary.form, chunk)
        # Letter by letter: a capital sigma has one small form here, at the end of a word too.
        return chunk.replace("Σ", "σ").lower() if self.vocabulary.lower else chunk

    def _words(self, chunk: str) -> list[str]:
        # Letters alone, or with one ASCII mark after them, are what the pattern would cut them into anyway.
        if chunk.isalpha():
            return [chunk]
        if self.plain and chunk[:-1].isalpha() and chunk.isascii() and not chunk[-1].isalnum():
            return [chunk[:-1], chunk[-1]]
        return self.split.findall(chunk)

    def learn(self, chunks: list[str]) -> None:
        """Encodes chunks without white space that are not known yet."""
        words, owner = [], []
        for i, chunk in enumerate(chunks):
            found = self._words(self._normal(chunk))
            words += found
            owner += [i] * len(found)
        words = [w.encode() for w in words]
        lengths = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        ids, counts = self.merge(symbols, lengths)
        per_chunk = np.bincount(np.array(owner, np.int64), counts, minlength=len(chunks)).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(per_chunk)])
        raw, cuts = ids.astype("<u4").tobytes(), (at * 4).tolist()
        names = [self.vocabulary.tokens[i] for i in ids.tolist()]
        at = at.tolist()
        for i, chunk in enumerate(chunks):
            self.known[chunk] = raw[cuts[i] : cuts[i + 1]], " ".join(names[at[i] : at[i + 1]])
            self.known_bytes += 2 * len(chunk) + 3 * (cuts[i + 1] - cuts[i]) + ENTRY_BYTES

    def chunks(self, text: str) -> list[str]:
        """The text between white space, special tokens apart."""

        def cut(part: str) -> list[str]:
            return part.split() if not ODD_SPACE.search(part) else [x for x in SPACE.split(part) if x]

        if self.special is None or not self.special.search(text):
            return cut(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [*cut(text[at : found.start()]), found[0]]
            at = found.end()
        return out + cut(text[at:])

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, the decoded text) of each text."""
        if self.known_bytes > REMEMBERED_BYTES:
            self.known.clear()
            self.known_bytes = 0
        for token, i in self.vocabulary.special.items():
            self.known[token] = i.to_bytes(4, "little"), token
        cut = [self.chunks(t) for t in texts]
        fresh = {c for chunks in cut for c in chunks if c not in self.known}
        if fresh:
            self.learn(list(fresh))
        out = []
        for chunks in cut:
            found = [self.known[c] for c in chunks]
            out.append((b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]])))
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by a space; ids beyond the vocabulary are left out."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist() if i < len(tokens)])


def _per_task(shared) -> Callable[[], Encoder]:
    """The encoder of a task, made when it is first asked for; it goes with the task, and with it what it has learnt."""
    made: list[Encoder] = []

    def encoder() -> Encoder:
        if not made:
            made.append(Encoder(shared.value))
        return made[0]

    return encoder


def round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep, ids (binary, little-endian unsigned 32-bit integers) and decoded (string) of every text.

    A null text is empty and has no ids. Every row is encoded by itself, whatever rows repeat it. A long text is encoded whole, in
    a slice of its own. Other columns are not read, whatever their names, and an empty table gives no rows.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    plain = docs.select(*[docs[k].alias(n) for k, n in zip(keep, names, strict=True)], docs[text].alias("_text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema if f.name != "_text")
    encoder = _per_task(docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = encoder().encode([t or "" for t in batch.column("_text").to_pylist()])
        columns = [batch.column(k) for k in names]
        columns += [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, [*names, "ids", "decoded"])

    out = map_texts(plain, "_text", work, f"{kinds}, ids binary, decoded string")
    return out.select(*[out[n].alias(k) for k, n in zip(keep, names, strict=True)], "ids", "decoded")


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep and ids of every text."""
    return round_trip(docs, path, keep, text).select(*keep, "ids")


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and decoded, from ids; null ids give an empty text."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.select(*keep).schema)
    encoder = _per_task(encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(path)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [encoder().decode(i or b"") for i in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(texts, pa.string())], [*keep, "decoded"])

    return map_texts(encoded.select(*keep, "ids"), "ids", work, f"{kinds}, decoded string")
