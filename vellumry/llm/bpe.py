"""Byte-pair encoding by backtracking, and decoding by an offset table.

A word's encoding is found left to right in linear time. One Aho-Corasick pass
gives the longest vocabulary token from every place. A token may follow the one
before it only if merging the two tokens' symbols by rank would give just these
two tokens; that pair-compatibility is computed by undoing merges from the seam
and kept in a table. If no token of any length may follow, the last one is
taken back and shortened; a place that failed is never tried again. The result
is what applying the merges in rank order gives.

Words are cut as the tokenizer file says: NFC, white space ends a word, lower
case, then letters, single digits, contractions or runs of other characters.
A text of Latin-1 characters is lower-cased and cut into words at once, by the same
pattern with its classes written out. Of other texts, a run without white space is the
unit that is looked up, as no word crosses white space. Words and runs are encoded once for
each worker (their tables are bounded and start afresh when full). Special tokens in a text
are recognised as the library does. Letters, numbers and small letters are the library's, whose Unicode data are of another
version than Python's: what differs is listed below and tested for every code point.

Null texts count as empty; an empty text has no ids and decodes to "". Ids that the vocabulary
doesn't have decode to nothing. Repeated rows give equal rows, very long texts are encoded whole, an
empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Runs and words kept by each worker, and the longest kept.
CACHE_RUNS, CACHE_WORDS, CACHE_LENGTH = 400_000, 800_000, 64
#: A plain run: ASCII letters, then marks that start no contraction.
_PLAIN = re.compile(r"([a-z]+)([^a-z0-9'\x00-\x20\x7f<]+)?")
_FINAL = 0x10000  # added to the code of a word's last byte
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: White space for Python, not for the library.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

# Code points that newer Unicode data call letters or numbers and the library doesn't, and capitals that it
# lower-cases and Python may not yet (first, last, distance to the small letter).
NOT_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
NOT_NUMBERS = [(0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6)]
CAPITALS = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
]
_SMALL = {c: c + d for a, b, d in CAPITALS for c in range(a, b + 1)} | {ord("Σ"): ord("σ")}


def _pinned(pattern: str) -> str:
    """The pattern with letters and numbers as the library knows them, in sets of the regex module's version 1."""
    for name, out in ((r"\p{L}", NOT_LETTERS), (r"\p{N}", NOT_NUMBERS)):
        pattern = pattern.replace(name, "[" + name + "--[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in out) + "]]")
    return pattern


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _written_out(pattern: str) -> re.Pattern | None:
    """The pattern, for Latin-1 texts without separators, with its classes as lists of characters; None if it has others."""
    latin = [chr(k) for k in range(256) if chr(k) not in _SEPARATORS]
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(name, "".join(re.escape(c) for c in latin if regex.fullmatch(name, c)))
    return None if r"\p" in pattern.lower() else re.compile(pattern)


class _Table(dict):
    """Results by text; made on a miss, and all dropped when the table is full."""

    def __init__(self, make, most: int):
        super().__init__()
        self._make, self._most = make, most

    def __missing__(self, text: str) -> bytes:
        ids = self._make(text)
        if len(text) <= CACHE_LENGTH:
            if len(self) >= self._most:
                self.clear()
            self[text] = ids
        return ids


class Encoder:
    """Encoder and decoder of one tokenizer file with word ends."""

    def __init__(self, path: str, tables: tuple[int, int] = (CACHE_RUNS, CACHE_WORDS)):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not end:
            raise ValueError("a BPE vocabulary with word ends is needed")
        letters = _byte_letters()
        self._inner = {b: letters[b] for b in range(256)}
        vocab: dict[str, int] = model["vocab"]

        def symbols(token: str) -> str:
            return token[: -len(end) - 1] + chr(ord(token[-len(end) - 1]) + _FINAL) if token.endswith(end) and len(token) > len(end) else token

        # ranks: base symbols below all merges, merges in their order
        base = [x for c in letters for x in (c, c + end)]
        self._rank_token = base + [a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        rank = {t: k for k, t in enumerate(self._rank_token)}
        if len(rank) != len(self._rank_token):
            raise ValueError("a token has two merges")
        self._split = [(k, k) for k in range(len(base))]
        self._pair: dict[tuple[int, int], int] = {}
        for k, m in enumerate(model["merges"], len(base)):
            a, b = m if isinstance(m, list) else m.split(" ")
            self._split.append((rank[a], rank[b]))
            self._pair[rank[a], rank[b]] = k
        text = [symbols(t) for t in self._rank_token]
        self._len = [len(t) for t in text]
        self._id = [np.array([vocab[t]], "<u4").tobytes() for t in self._rank_token]
        self._find = ahocorasick.Automaton()
        for k, t in enumerate(text):
            self._find.add_word(t, k)
        self._find.make_automaton()
        of = {t: k for k, t in enumerate(text)}
        self._shorter = [next((of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in of), -1) for t in text]
        self._fits = lru_cache(1 << 19)(self._compatible)
        self._special = {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in spec["added_tokens"]}
        if any(re.search(r"\s", x) for x in self._special):
            raise ValueError("a special token with white space would be cut")
        self._special_re = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(_pinned(pattern), regex.V1)
        self._latin_words = _written_out(pattern)
        self._runs = _Table(self._run, tables[0])
        self._known = _Table(self._word_ids, tables[1])
        # decoding: the library joins the tokens' own strings with spaces, as this file has no decoder
        names = {i: t for t, i in vocab.items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        pieces = [(names[i] + " ").encode() if i in names else b"" for i in range(max(names) + 1)]
        self._piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._piece_len = np.array([len(p) for p in pieces], np.int32)
        self._piece_at = (np.cumsum(self._piece_len) - self._piece_len).astype(np.int32)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens gives exactly these two.

        Merges are undone from the seam, the later one first. A merge across the
        seam that ranks before the one just undone would have been taken instead;
        of equal ranks, the one further left comes first.
        """
        bound = len(self._split)
        while True:
            across = self._pair.get((left, right))
            if across is not None and across < bound:
                return False
            whole = self._split[left][0] == left, self._split[right][0] == right
            if all(whole):
                return True
            if whole[1] or (not whole[0] and left > right):
                bound, left = left, self._split[left][1]
            else:
                bound, right = right + 1, self._split[right][0]

    def word(self, letters: str) -> list[int]:
        """Ranks of the tokens of one word of byte letters, the last one marked."""
        n = len(letters)
        longest, size, fits = [-1] * n, self._len, self._fits
        for at, k in self._find.iter(letters):  # by end: the last one from a place is the longest
            longest[at + 1 - size[k]] = k
        token = longest[0]
        if size[token] == n:  # a merged token is what its own letters merge to
            return [token]
        out: list[int] = []
        bad: set[int] = set()
        pos, last = 0, -1
        while True:
            while token >= 0:
                stop = pos + size[token]
                if (last < 0 or fits(last, token)) and stop not in bad:
                    break
                token = self._shorter[token]
            if token >= 0:
                out.append(token)
                if stop == n:
                    return out
                pos, last, token = stop, token, longest[stop]
            else:
                if not out:
                    raise ValueError("no encoding")
                bad.add(pos)
                token = out.pop()
                pos -= size[token]
                last = out[-1] if out else -1
                token = self._shorter[token]

    def _word_ids(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isprintable() else "".join(map(self._inner.__getitem__, word.encode()))
        letters = letters[:-1] + chr(ord(letters[-1]) + _FINAL)
        return b"".join(map(self._id.__getitem__, self.word(letters)))

    def _run(self, run: str) -> bytes:
        """Ids of a run without white space."""
        if run.isascii():
            plain = _PLAIN.fullmatch(run.lower())
            if plain:
                word = run if plain[1] == run else plain[1]  # one string object for both tables
                return self._known[word] + self._known[plain[2]] if plain[2] else self._known[word]
        parts = self._special_re.split(run) if self._special_re and self._special_re.search(run) else [run]
        out = []
        for part in parts:
            if part in self._special:
                out.append(self._special[part])
                continue
            part = unicodedata.normalize("NFC", part).translate(_SMALL).lower()
            out.extend(map(self._known.__getitem__, self._words.findall(part)))
        return b"".join(out)

    def _simple(self, text: str) -> bool:
        """Whether a text has Latin-1 characters alone (so it is NFC, and lower case stays Latin-1), no separators and no special tokens."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return not any(c in text for c in _SEPARATORS) and not any(x in text for x in self._special)

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._latin_words and self._simple(text):
            return b"".join(map(self._known.__getitem__, self._latin_words.findall(text.lower())))
        runs = _SPACE.split(text) if _ODD_SPACE.search(text) else text.split()
        return b"".join(map(self._runs.__getitem__, runs))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text."""
        k = np.frombuffer(ids, "<u4")
        k = k[k < len(self._piece_len)]
        n = self._piece_len[k]
        if not n.sum():
            return b""
        ends = np.cumsum(n, dtype=np.int64)
        at = np.repeat(self._piece_at[k] - (ends - n), n)
        at += np.arange(ends[-1])
        return self._piece_bytes[at][:-1].tobytes()


@lru_cache(2)
def encoder(path: str, tables: tuple[int, int] = (CACHE_RUNS, CACHE_WORDS)) -> Encoder:
    """One encoder for each worker process, file and size of tables (runs, words)."""
    return Encoder(path, tables)


def release() -> None:
    """Free this worker's encoders; other operators call it first, as Spark hands workers on."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        gc.collect()  # an encoder and its table of pairs refer to each other
    with contextlib.suppress(OSError, AttributeError):  # where the C library can give freed memory back
        ctypes.CDLL(None).malloc_trim(0)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _digests(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path or tokenizer_path())
        for b in batches:
            n, first, second = [], [], []
            for t in b.column(1):
                ids = e.encode(t.as_py())
                n.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _encoded(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path or tokenizer_path())
        for b in batches:
            ids = [np.frombuffer(e.encode(t.as_py()), "<u4").astype(np.int32) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, ids array<int>); path names the tokenizer file on every executor."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encoded(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) -> (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path or tokenizer_path())
        for b in batches:
            texts = [e.decode(np.asarray(x.as_py() or [], "<u4").tobytes()).decode("utf-8", "replace") for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
