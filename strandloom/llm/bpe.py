"""BPE encoding and decoding by forced-boundary splitting.

A merge makes a vocabulary token, so no token can span two neighbouring bytes that never stand
side by side inside any vocabulary token. Such byte pairs mark certain cuts: the fragments
between them are encoded independently, each once, and their ids are concatenated.

The vocabulary is a file of the public ``tokenizers`` format (byte-level BPE); its path is a
parameter. That library's own normaliser and pre-tokeniser decide what a word is; the merges are
done here. Special tokens found in a text become their ids, as in the library. Null texts count as
empty and give no ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.llm import common

CACHE_ENTRIES = 400_000
CACHED_CHARS = 64
SCANNED_CHARS = 64  # fragments up to this length are merged by scanning, longer ones with a heap

#: A pre-tokeniser that drops white space between words, and what it comes to for
#: texts of plain characters: ASCII and the Latin letters that NFC leaves alone and that have one
#: lower-case letter each.
WORDS_ONLY = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
PLAIN_TEXT = rf"[\x00-\x7f\u00a1\u00ab\u00bb\u00bf{LATIN}]*"
PLAIN_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^ \t-\ra-z0-9{LATIN}]+"
WORDS_ONLY_STEPS = ["NFC", "Replace", "Lowercase"]


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it
    is printable Latin-1, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    """One vocabulary. ``encode`` gives ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a plain BPE vocabulary is needed")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        chars = byte_chars()
        if missing := [c for c in chars if c not in self.vocab or c + self.suffix not in self.vocab]:
            raise ValueError(f"not a byte-level vocabulary: {missing[:3]}")
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.ranks = {(a, b): (k, a + b) for k, (a, b) in enumerate(pairs)}
        self.inside = set()
        for token in self.vocab:
            body = token[: len(token) - len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            self.inside.update(zip(body, body[1:], strict=False))
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"] if not t["normalized"]}
        if len(self.specials) < len(spec["added_tokens"]) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens of this kind aren't supported")
        self.special_split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        own = Tokenizer.from_file(path)
        self.normalizer, self.pre = own.normalizer, own.pre_tokenizer
        self.decoder = (spec.get("decoder") or {}).get("type")
        if self.decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {self.decoder} isn't supported")
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.specials.items()}
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pattern = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.words_only = steps == WORDS_ONLY_STEPS and pattern.get("pattern", {}).get("Regex") == WORDS_ONLY and pattern.get("behavior") == "Removed"
        self.plain_text, self.plain_words = re.compile(PLAIN_TEXT), re.compile(PLAIN_WORDS)
        self.of_char = {c: b for b, c in enumerate(chars)}
        bpe = self

        class Memo(dict):
            """Ids by key, of short keys; it starts anew when it is full."""

            def __init__(self, make):
                super().__init__()
                self.make = make

            def __missing__(self, key):
                value = self.make(key)
                if len(key) <= CACHED_CHARS:
                    if len(self) >= CACHE_ENTRIES:
                        self.clear()
                    self[key] = value
                return value

        self.words = Memo(bpe.plain_word_ids)  # by a plain word in lower case
        self.byte_words = Memo(bpe.word_ids)  # by a word in byte characters
        common.cache("bpe", self.words, self.byte_words)
        self.byte_map = str.maketrans({chr(b): c for b, c in enumerate(chars)})

    def fragment_ids(self, fragment: str, last: bool) -> bytes:
        """The merges of one fragment: always the lowest rank, leftmost first. last: it ends its word."""
        symbols: list[str] = list(fragment)
        if last:
            symbols[-1] += self.suffix
        if len(symbols) > SCANNED_CHARS:
            symbols = self.merged_by_heap(symbols)
        elif len(symbols) > 1:
            ranks, none = self.ranks, (1 << 60, "")
            found = [ranks.get(pair, none) for pair in zip(symbols, symbols[1:], strict=False)]
            while found and (best := min(found)) is not none:
                i = found.index(best)
                symbols[i] = best[1]
                del symbols[i + 1], found[i]
                if i:
                    found[i - 1] = ranks.get((symbols[i - 1], symbols[i]), none)
                if i < len(found):
                    found[i] = ranks.get((symbols[i], symbols[i + 1]), none)
        return array("I", map(self.vocab.__getitem__, symbols)).tobytes()

    def merged_by_heap(self, symbols: list) -> list[str]:
        """The same merges in n log n steps."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r[0], i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := self.ranks.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = self.ranks[a, b][1], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := self.ranks.get((symbols[i], symbols[k])):
                    heapq.heappush(heap, (r[0], i, symbols[i], symbols[k]))
            if (h := before[i]) >= 0 and (r := self.ranks.get((symbols[h], symbols[i]))):
                heapq.heappush(heap, (r[0], h, symbols[h], symbols[i]))
        return [s for s in symbols if s is not None]

    def cuts(self, word: str) -> list[str]:
        """The fragments of a word in byte characters."""
        inside, out, start = self.inside, [], 0
        for i, pair in enumerate(zip(word, word[1:], strict=False), 1):
            if pair not in inside:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def word_ids(self, word: str) -> bytes:
        """A word in byte characters."""
        parts = self.cuts(word)
        return b"".join(self.fragment_ids(p, k == len(parts) - 1) for k, p in enumerate(parts))

    def plain_word_ids(self, word: str) -> bytes:
        return self.word_ids(word.encode().decode("latin-1").translate(self.byte_map))

    def plain_ids(self, text: str) -> bytes:
        """A text without special tokens."""
        if self.words_only and (text.isascii() or self.plain_text.fullmatch(text)):
            return b"".join(map(self.words.__getitem__, self.plain_words.findall(text.lower())))
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        return b"".join([self.byte_words[w] for w, _ in self.pre.pre_tokenize_str(text)])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not any(s in text for s in self.specials):
            return self.plain_ids(text)
        out = []
        for part in self.special_split.split(text):
            if part in self.specials:
                out.append(array("I", [self.specials[part]]).tobytes())
            elif part:
                out.append(self.plain_ids(part))
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """As the library's decode(ids, skip_special_tokens=False): tokens joined by spaces where the
        file names no decoder, else their bytes as UTF-8. Unknown ids are passed over."""
        a = array("I")
        a.frombytes(ids or b"")
        tokens = self.tokens
        try:
            found = [tokens[i] for i in a]
        except KeyError:
            found = [tokens[i] for i in a if i in tokens]
        if self.decoder is None:
            return " ".join(found)
        parts: list[bytes] = []
        for t in found:
            known = all(c in self.of_char for c in t)
            parts.append(bytes(map(self.of_char.__getitem__, t)) if known else t.encode())
        return b"".join(parts).decode("utf-8", "replace")


VOCABULARY = "word_bpe_49k.json"


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """One instance a worker and vocabulary. A bare file name is one of the public tokenizers', found where the task runs."""
    return Bpe(path if os.sep in path else vocabulary(path))


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """All other columns, and n_tokens, ids array<int> of each whole text, and decoded_sha256 of the text that they decode to. Columns of df with these three names are
    replaced, and the text goes."""
    names = [c for c in df.columns if c not in (text_col, "n_tokens", "ids", "decoded_sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("bpe")
        bpe = load(path)
        for b in common.slices(batches):
            encoded = [bpe.encode(text.as_py()) for text in b.column(0)]
            offsets = np.cumsum([0, *(len(x) // 4 for x in encoded)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(encoded), np.int32)))
            sha = [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in encoded]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.diff(offsets).astype(np.int64)), lists, pa.array(sha, pa.string())], [*names, "n_tokens", "ids", "decoded_sha256"])

    rows = df.select(common.text_or_empty(text_col).alias(text_col), *[F.col(common.quoted(c)) for c in names])
    schema = rows.drop(text_col).schema
    for name, kind in (("n_tokens", T.LongType()), ("ids", T.ArrayType(T.IntegerType())), ("decoded_sha256", T.StringType())):
        schema = schema.add(name, kind)
    return common.over_arrow(rows, run, schema)


def decode(df: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of each list of ids; a null list gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("bpe")
        bpe = load(path)
        for b in common.slices(batches):
            texts = [bpe.decode(array("I", ids.as_py() or []).tobytes()) for ids in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes each whole text, then decodes the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("bpe")
        bpe = load(path)
        for b in common.slices(batches):
            n, of_ids, of_text = [], [], []
            for text in b.column(1):
                ids = bpe.encode(text.as_py())
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5(spark, sf_dir: str) -> DataFrame:
    """Every text of documents encoded and decoded again."""
    return round_trip(common.table(spark, sf_dir, "documents"), VOCABULARY)
