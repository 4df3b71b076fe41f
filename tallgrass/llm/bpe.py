"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A word's encoding is the one chain of tokens in which every two neighbours are compatible, that is, in which the
pair alone encodes to itself. So the encoder takes the longest token that matches (an Aho-Corasick automaton
over all tokens gives the longest match at every place of a word in one pass), checks it against the token before
it, falls back to shorter prefixes, and steps back where none fits; a place that failed once is never tried
again, which keeps it linear. Whether a pair is compatible follows from the merges' ranks and halves and is kept in
a table. Words recur, so each worker keeps the ids of words it has seen, up to a bound.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers.normalizers import NFC

from .common import BATCH_BYTES, arrow_type_names

END = ""
CACHE_WORDS, CACHE_PAIRS = 400_000, 1_000_000
#: White space as the tokenizer's patterns see it, a fixed value.
WS = r"\t-\r \x85\xa0  -     　"
_SPACE = re.compile(f"[{WS}]")
_MARKS = re.compile("[^\x00-\u02ff]")
# Letters, numbers and lower-case forms of Unicode 16, which the tokenizer goes by, that Unicode 15.1 lacks.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
NEW_LOWER = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x0264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5),
    (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x019B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
)


def char_class(points: set[int]) -> str:
    """The inside of a character class of these code points."""
    out: list[list[int]] = []
    for i in sorted(points):
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@lru_cache(maxsize=1)
def unicode_classes() -> tuple[str, str, str, dict[int, int]]:
    """Classes of letters and numbers as the tokenizer has them, of the code points where the regex library's differ or whose
    lower case does, and those lower-case forms."""
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    exact = {k: {i for i in points if unicodedata.category(chr(i))[0] == k} for k in "LN"}
    for k, ranges in (("L", NEW_LETTERS), ("N", NEW_NUMBERS)):
        exact[k].update(i for a, b in ranges for i in range(a, b + 1))
    lower = {i: c + i - a for a, b, c in NEW_LOWER for i in range(a, b + 1)}
    every = "".join(map(chr, points))
    doubtful = set(lower)
    for k in "LN":
        doubtful |= exact[k] ^ set(map(ord, regex.findall(rf"\p{{{k}}}", every)))
    return char_class(exact["L"]), char_class(exact["N"]), char_class(doubtful), lower


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next free code from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        parts = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        pattern = parts[0].replace(r"\s", WS)
        letters, numbers, doubtful, self.lower = unicode_classes()
        self.words = regex.compile(pattern)
        self.exact_words = regex.compile(pattern.replace(r"\p{L}", letters).replace(r"[\p{N}]", f"[{numbers}]").replace(r"\p{N}", numbers))
        self.doubtful = re.compile(f"[{doubtful}]")
        self.symbols = byte_symbols()
        size = max(*vocab.values(), *special.values()) + 1
        names = [""] * size
        for t, i in (*vocab.items(), *special.items()):
            names[i] = t
        blob = [n.encode() + b" " for n in names]
        self.at = np.cumsum([0, *map(len, blob)])
        self.blob = np.frombuffer(b"".join(blob), np.uint8)
        keys = {i: t[: -len(suffix)] + END if suffix and t.endswith(suffix) else t for t, i in vocab.items()}
        self.length = [len(keys.get(i, "")) for i in range(size)]
        self.left, self.right = list(range(size)), list(range(size))
        self.order = list(range(size))
        self.merged: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.merged[i << 32 | j] = k
            self.left[k], self.right[k], self.order[k] = i, j, len(vocab) + rank
        self.pairs: dict[int, bool] = {}
        self.find = ahocorasick.Automaton()
        by_key = {t: i for i, t in keys.items()}
        usable = [(t, i) for t, i in by_key.items() if i in self.merged_set() or len(t.replace(END, "")) == 1]
        known = dict(usable)
        self.shorter = [-1] * size
        for t, i in usable:
            self.find.add_word(t, (len(t), i))
            self.shorter[i] = next((known[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), -1)
        self.find.make_automaton()

    def merged_set(self) -> set[int]:
        """Ids that some merge makes."""
        if not hasattr(self, "_made"):
            self._made = set(self.merged.values())
        return self._made

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a and b side by side encode to themselves."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        """Undo the later merge of the two step by step; a merge across the border that would come first breaks the pair.

        A merge across beats the making of the left token if it ranks lower, of the right one if it does not rank higher.
        """
        rank, limit = self.order, 1 << 60
        while True:
            across = self.merged.get(a << 32 | b)
            if across is not None and rank[across] < limit:
                return False
            inner_a, inner_b = self.left[a] != a, self.left[b] != b
            if not inner_a and not inner_b:
                return True
            if inner_a and (not inner_b or rank[a] > rank[b]):
                limit, a = rank[a], self.right[a]
            else:
                limit, b = rank[b] + 1, self.left[b]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        s = "".join(map(self.symbols.__getitem__, word.encode())) + END
        n = len(s)
        longest = [-1] * n
        for end, (size, token) in self.find.iter(s):
            longest[end - size + 1] = token
        length, shorter = self.length, self.shorter
        usable = bytearray(b"\1") * (n + 1)
        usable[n - 1] = 0  # the end mark is no symbol of its own
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + length[token]
            if usable[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                usable[at] = 0
                token = out.pop()
                at -= length[token]
        return out

    def normal(self, text: str) -> str:
        """NFC and lower case, each character on its own. NFC is the tokenizers library's, whose Unicode version is older than Python's:
        marks that it does not know stay where they are. Below U+0300 nothing is composed or reordered."""
        if not text.isascii():
            if _MARKS.search(text):
                text = NFC().normalize_str(text)
            text = text.replace("Σ", "σ")
        return text.lower()

    def encode(self, text: str, cache: Cache) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out = []
        for i, part in enumerate(self.split_special.split(text) if self.split_special else [text]):
            if i % 2:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            for chunk in chunks(part):
                words, text = self.words, self.normal(chunk)
                if not text.isascii() and self.doubtful.search(text):
                    words, text = self.exact_words, text.translate(self.lower)
                out.extend(map(cache.__getitem__, words.findall(text)))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of ``ids`` joined by blanks, gathered through the offset table."""
        out = []
        for lo in range(0, len(ids), 1 << 18):
            part = ids[lo : lo + (1 << 18)]
            start, size = self.at[part], self.at[part + 1] - self.at[part]
            ends = np.cumsum(size)
            out.append(self.blob[np.repeat(start - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out)[:-1]


class Cache(dict):
    """Pre-token -> its ids as bytes."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.vocab.encode_word(word), "<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


def chunks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Pieces of about ``size`` characters, cut before white space, which no token spans."""
    lo = 0
    while len(text) - lo > size and (m := _SPACE.search(text, lo + size)):
        yield text[lo : m.start()]
        lo = m.start()
    yield text[lo:] if lo else text


@lru_cache(maxsize=2)
def loaded(path: str) -> tuple[Vocabulary, Cache]:
    """The vocabulary at ``path`` and its cache, once a worker."""
    v = Vocabulary(path)
    return v, Cache(v)


def encode_decode(df: DataFrame, path: str, column: str = "text") -> DataFrame:
    """``df`` with ``token_ids`` (binary: little-endian unsigned 32-bit) of the whole ``column`` and ``decoded`` (string).

    Null texts are empty; equal texts get equal ids; an empty table gives no rows. A very long text is encoded in pieces that are cut where no
    token can span, and stands in memory once with its ids. Control strings of the vocabulary in a text are encoded as their own ids. Columns with the
    output names are replaced. ``path`` is the tokenizer file's place on every executor.
    """
    df = df.drop("token_ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, cache = loaded(path)

        def out(b: pa.RecordBatch, ids: list, decoded: list) -> pa.RecordBatch:
            cols = [*b.columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary()).cast(pa.string())]
            return pa.RecordBatch.from_arrays(cols, [*b.schema.names, "token_ids", "decoded"])

        for b in batches:
            lo, ids, decoded, held = 0, [], [], 0
            for k, text in enumerate(b.column(column)):
                x = vocab.encode(text.as_py() or "", cache)
                ids.append(x)
                decoded.append(vocab.decode(np.frombuffer(x, "<u4").astype(np.int64)))
                held += len(x) + len(decoded[-1])
                if held >= 4 * BATCH_BYTES:
                    yield out(b.slice(lo, k + 1 - lo), ids, decoded)
                    lo, ids, decoded, held = k + 1, [], [], 0
            if ids:
                yield out(b.slice(lo), ids, decoded)

    return df.mapInArrow(run, arrow_type_names(df) + ", token_ids binary, decoded string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract query."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return digests(out)


def digests(out: DataFrame) -> DataFrame:
    """The contract's columns from ``encode_decode``'s."""
    return out.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
