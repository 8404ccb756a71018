"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. Each round looks up every neighbouring pair by
binary search over the sorted pair keys of the merge table, takes each word's lowest rank, merges that
pair wherever it occurs in the word (left to right, not overlapping) and drops the finished words.
A vocabulary in which a merged token could take part in an earlier-ranked merge than the one that made
it merges one occurrence per word and round instead, which is always the reference order.

The vocabulary file is a parameter (a BPE ``tokenizer.json`` with word ends and byte-level symbols); its
bytes reach the tasks in a broadcast variable. A task keeps the encodings of distinct words in a table of
at most ``CACHE_WORDS`` entries, so repeated words cost one lookup.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ready

CACHE_WORDS = 150_000
#: Words that are encoded together.
SLICE_WORDS = 50_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


#: White space, letters and numbers among U+0000-U+00FF, after lower-casing.
_LATIN = {"\\s": "\\t-\\r \\x85\\xa0", "\\p{L}": "a-z\\xaa\\xb5\\xba\\xdf-\\xf6\\xf8-\\xff", "\\p{N}": "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"}


@lru_cache(maxsize=1)
def _unsure() -> regex.Pattern:
    """Letters and numbers of the pattern engine that are not assigned in Python's Unicode tables."""
    found = [m.start() for m in regex.finditer(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xD800, 0xE000), *range(0xE000, 0x110000)]))) if unicodedata.category(chr(m.start())) == "Cn"]
    ranges: list[list[int]] = []
    for i in found:
        if ranges and ranges[-1][1] == i - 1:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges or [[0x10FFFF, 0x10FFFF]]) + "]")


class Vocabulary:
    """Tables of a BPE tokenizer file, as arrays."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([vocab.get(s + self.suffix, -1) for s in symbols], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order, made[order]
        born = np.full(size, -1, np.int64)
        np.maximum.at(born, made, np.arange(len(pairs)))
        self.in_order = bool((born[left] < np.arange(len(pairs))).all() and (born[right] < np.arange(len(pairs))).all())
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        # the same pattern with its classes spelled out for texts of U+0000-U+00FF only, for the quicker engine
        for name, members in _LATIN.items():
            split = split.replace(name, members)
        self.latin = re.compile(split.replace("[[", "[").replace("]]", "]"))
        self.unsure = _unsure()
        self.careful = regex.compile(self.pattern.pattern.replace("[\\p{L}]", f"(?:(?!{self.unsure.pattern})\\p{{L}})").replace("[\\p{N}]", f"(?:(?!{self.unsure.pattern})\\p{{N}})").replace("[^\\s\\p{L}\\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|{self.unsure.pattern})"))
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and their bounds (length words + 1)."""
        data = [w.encode() for w in words]
        size = np.array([len(d) for d in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        word = np.repeat(np.arange(len(words)), size)
        sym = self.inner[raw]
        ends = np.cumsum(size) - 1
        sym[ends] = self.last[raw[ends]]
        known = sym >= 0
        sym, word = sym[known], word[known]
        done_sym, done_word = [], []
        nowhere = len(self.ranks)
        while len(sym) > 1:
            key = sym[:-1] << 32 | sym[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.where(hit, self.ranks[at], nowhere)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, nowhere], first)
            of = np.repeat(lowest, np.diff(np.r_[first, len(sym)]))
            open_ = of < nowhere
            take = np.flatnonzero((rank == of[:-1]) & open_[:-1])
            if not len(take):
                break
            if self.in_order:  # of a run of overlapping pairs, every other one
                run = np.flatnonzero(np.r_[True, np.diff(take) > 1])
                step = np.arange(len(take)) - np.repeat(run, np.diff(np.r_[run, len(take)]))
                take = take[step % 2 == 0]
            else:
                take = take[np.r_[True, word[take][1:] != word[take][:-1]]]
            sym[take] = self.made[at[take]]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            shut = ~open_
            done_sym.append(sym[shut])
            done_word.append(word[shut])
            keep &= open_
            sym, word = sym[keep], word[keep]
        sym = np.concatenate([*done_sym, sym])
        word = np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        return sym[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def pieces(self, text: str) -> list[str]:
        """The words of a text; special tokens stay as they are, with a mark in front."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            out += ["\0" + part] if k % 2 else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
            return self.latin.findall(text.lower())  # such texts are in NFC
        except UnicodeEncodeError:
            # lower case is taken character by character: no final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            return (self.careful if self.unsure.search(text) else self.pattern).findall(text)


class Coder:
    """Encodings of distinct words, kept up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"\0" + s: k for k, s in enumerate(self.v.special)}
        ids = np.array(list(self.v.special.values()), np.uint32)
        self.parts, self.flat = [ids], ids
        self.bounds = np.arange(len(ids) + 1)
        self.decoded: list[str] = list(self.v.special)

    def learn(self, words: list[str]) -> None:
        new = list(set(words).difference(self.index))
        if not new:
            return
        if len(self.index) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(set(words).difference(self.index))
        ids, bounds = self.v.encode_words(new)
        tokens = list(map(self.v.tokens.__getitem__, ids.tolist()))
        index, decoded = self.index, self.decoded
        for w, a, b in zip(new, bounds[:-1].tolist(), bounds[1:].tolist()):
            index[w] = len(decoded)
            decoded.append(" ".join(tokens[a:b]))
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entry and number of ids of each word, and the ids of all of them in a row."""
        self.learn(words)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        size = self.bounds[at + 1] - self.bounds[at]
        out = np.cumsum(size)
        where = np.arange(int(out[-1]) if len(out) else 0) + np.repeat(self.bounds[at] - (out - size), size)
        return at, size, self.flat[where]

    def decode(self, at: list[int]) -> str:
        """The decoded text of entries: tokens of the ids with single spaces between, as a tokenizer without a decoder gives."""
        return " ".join(filter(None, map(self.decoded.__getitem__, at)))

    def documents(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids and decoded text of each whole text. Words of several texts are encoded together, a very
        long text in parts of ``SLICE_WORDS`` words."""
        held: list[list[str]] = []
        count = 0
        for t in texts:
            words = self.v.pieces(t or "")
            if held and count + len(words) > SLICE_WORDS:
                yield from self._together(held)
                held, count = [], 0
            held.append(words)
            count += len(words)
        if held:
            yield from self._together(held)

    def _together(self, held: list[list[str]]) -> Iterator[tuple[np.ndarray, str]]:
        if len(held) == 1:
            parts = [(ids, self.decode(at.tolist())) for k in range(0, len(held[0]), SLICE_WORDS) for at, _, ids in [self.encode(held[0][k : k + SLICE_WORDS])]]
            yield np.concatenate([np.empty(0, np.uint32), *(p[0] for p in parts)]), " ".join(p[1] for p in parts if p[1])
            return
        at, size, ids = self.encode([w for words in held for w in words])
        entries = at.tolist()
        words_end = np.cumsum([len(w) for w in held])
        ids_end = np.r_[0, np.cumsum(size)][words_end]
        for a, b, i, j in zip([0, *words_end.tolist()], words_end.tolist(), [0, *ids_end.tolist()], ids_end.tolist()):
            yield ids[i:j], self.decode(entries[a:b])


@lru_cache(maxsize=1)
def _coder(raw: bytes) -> Coder:
    """One per Python worker, which may run many tasks."""
    return Coder(Vocabulary(raw))


def _coded(vocabulary, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                n, digest, plain, ids_out, text_out = [], [], [], [], []
                for ids, decoded in coder.documents(batch.column(1).slice(k, 128).to_pylist()):
                    n.append(len(ids))
                    digest.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    plain.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if full:
                        ids_out.append(ids.astype(np.int32))
                        text_out.append(decoded)
                columns = [batch.column(0).slice(k, 128), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(plain, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if full:
                    columns += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def bpe_encode_decode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = False) -> DataFrame:
    """Token ids of every whole text and the text decoded from them: (id, n_tokens, ids_sha256,
    decoded_sha256) and, with ``full``, ids (array of int) and decoded (string).

    One row per input row, in any order; repeated rows give repeated results. A null or empty text, or
    one of white space only, has no ids and an empty decoded text. Null ids are kept. An empty table
    gives an empty table; other columns are not read. Special tokens written in a text are taken as
    special tokens; no others are added. No shuffle.
    """
    spark = docs.sparkSession
    ready(spark)
    with open(vocabulary_path, "rb") as f:  # a file of an installed library on the driver; a few MB
        vocabulary = spark.sparkContext.broadcast(f.read())
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if full else "")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(_coded(vocabulary, full)), schema)
