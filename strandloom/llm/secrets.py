"""Secret scans with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over byte trigrams that every match
must contain. The texts of a block are indexed by the trigrams that any rule asks for: a posting
list of texts a trigram. A rule's candidates come from intersecting and uniting posting lists;
only they are verified with the expression. Rules without mandatory trigrams are verified on every
text. Blocks are Arrow batches, so the index needs no shuffle and its size is bounded.

Positions are code points, ends exclusive. A null or empty text has no secrets. Matches of a rule
are leftmost and don't overlap; those of different rules may.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from re import _constants as sre
from re import _parser as sre_parser

from strandloom.llm import common


@dataclass(frozen=True)
class Rule:
    """A kind of secret. least: the smallest length of group (0: the match); shorter ones are dropped."""

    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 0
    mask: int = 0  # the group to mask in a text


#: The base kinds, in the order in which equal starts are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
#: Further kinds with public formats.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\s/:@]++:([^\s/:@]{3,}+)@", mask=1),
)
RULES = BASE + MORE

MOST_EXACT = 48  # strings that an exact set may hold before it is turned into trigrams

#: A query is True (no condition), a trigram, ("and", parts) or ("or", parts).
Query = bool | str | tuple


def conjunction(parts) -> Query:
    flat: list = []
    for p in parts:
        if p is True:
            continue
        flat += p[1] if isinstance(p, tuple) and p[0] == "and" else [p]
    flat = list(dict.fromkeys(flat))
    return True if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def disjunction(parts) -> Query:
    flat = list(dict.fromkeys(parts))
    return True if True in flat or not flat else flat[0] if len(flat) == 1 else ("or", tuple(flat))


def of_strings(strings) -> Query:
    """What a text holds that has one of the strings."""
    return disjunction([conjunction([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def characters(items) -> set[str] | None:
    """The few characters of a class, or None."""
    found: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            found.add(chr(arg))
        elif op is sre.RANGE and arg[1] - arg[0] < 16:
            found |= {chr(c) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= 16 else None


def analyse(parsed) -> tuple[set[str] | None, Query]:
    """(exact strings of the whole expression or None, what every match contains besides)."""
    runs: set[str] | None = {""}
    needs: list[Query] = []
    exact = True

    def close() -> None:
        nonlocal runs
        if runs and min(map(len, runs)) >= 3:
            needs.append(of_strings(runs))
        runs = None

    for op, arg in parsed:
        part, need = item(op, arg)
        needs.append(need)
        if part is not None and runs is not None and len(runs) * len(part) <= MOST_EXACT:
            runs = {a + b for a in runs for b in part}
        else:
            close()
            exact = False
            runs = part
    if exact:
        return runs, conjunction(needs)
    close()
    return None, conjunction(needs)


def item(op, arg) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {chr(arg)}, True
    if op is sre.IN:
        return characters(arg), True
    if op is sre.SUBPATTERN:
        return analyse(arg[3])
    if op is sre.BRANCH:
        parts = [analyse(p) for p in arg[1]]
        if all(e is not None for e, _ in parts) and sum(len(e) for e, _ in parts) <= MOST_EXACT:
            return set().union(*(e for e, _ in parts)), True
        return None, disjunction([conjunction([of_strings(e) if e is not None else True, q]) for e, q in parts])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, body = arg
        exact, need = analyse(body)
        if exact is not None and (low, high) == (0, 1):
            return exact | {""}, True
        if low == 0:
            return None, True
        if exact is not None and low == high == 1:
            return exact, need
        return None, conjunction([need, of_strings(exact) if exact is not None else True])
    if op is sre.AT:
        return {""}, True
    return None, True


def trigram_query(rule: Rule) -> Query:
    """The Boolean query of a rule over trigrams with A-Z in lower case."""
    exact, need = analyse(sre_parser.parse(rule.pattern, re.A))
    lower = lambda q: q.lower() if isinstance(q, str) else (q[0], tuple(map(lower, q[1]))) if isinstance(q, tuple) else q
    query = lower(conjunction([need, of_strings(exact) if exact is not None else True]))
    return True if any(not t.isascii() for t in trigrams(query)) else query


def trigrams(query: Query) -> set[str]:
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1])) if isinstance(query, tuple) else set()


@dataclass
class Index:
    """The index of one block of texts, and the rules that it serves."""

    rules: tuple[Rule, ...]
    queries: list[Query] = field(init=False)
    patterns: list[re.Pattern] = field(init=False)

    def __post_init__(self) -> None:
        self.queries = [trigram_query(r) for r in self.rules]
        self.patterns = [re.compile(r.pattern, re.A | (re.I if r.any_case else 0)) for r in self.rules]
        self.wanted = sorted(set().union(*map(trigrams, self.queries)))
        self.slots = np.zeros(1 << 24, np.uint8 if len(self.wanted) < 255 else np.uint16)
        for k, t in enumerate(self.wanted, 1):
            a, b, c = t.encode()
            self.slots[a << 16 | b << 8 | c] = k

    def postings(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """Sorted text numbers by trigram. A zero byte after each text keeps trigrams inside texts."""
        block = np.frombuffer(b"\0".join(texts).lower() + b"\0\0", np.uint8)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        code = block[:-2].astype(np.uint32)
        code <<= 8
        code |= block[1:-1]
        code <<= 8
        code |= block[2:]
        slot = self.slots[code]
        at = np.flatnonzero(slot)
        pairs = np.unique(slot[at].astype(np.int64) << 40 | np.searchsorted(ends, at, "right"))
        which, docs = pairs >> 40, pairs & (1 << 40) - 1
        edges = np.searchsorted(which, np.arange(1, len(self.wanted) + 2))
        return {t: docs[edges[k] : edges[k + 1]] for k, t in enumerate(self.wanted)}

    def candidates(self, query: Query, postings: dict[str, np.ndarray]) -> np.ndarray:
        if isinstance(query, str):
            return postings[query]
        if query[0] == "or":
            return np.unique(np.concatenate([self.candidates(q, postings) for q in query[1]]))
        found = None
        for part in sorted((self.candidates(q, postings) for q in query[1]), key=len):
            found = part if found is None else np.intersect1d(found, part, assume_unique=True)
            if not len(found):
                break
        return found

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int, int, int]]]:
        """By text: (start, rule, end, mask start, mask end), sorted."""
        out: list[list] = [[] for _ in texts]
        postings = self.postings([t.encode() for t in texts]) if self.wanted else {}
        for k, (rule, query, pattern) in enumerate(zip(self.rules, self.queries, self.patterns, strict=True)):
            for i in range(len(texts)) if query is True else self.candidates(query, postings).tolist():
                for m in pattern.finditer(texts[i]):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        out[i].append((m.start(), k, m.end(), *m.span(rule.mask)))
        for found in out:
            found.sort()
        return out


@lru_cache(maxsize=4)
def index(rules: tuple[Rule, ...]) -> Index:
    return Index(rules)


def listed(rules: tuple[Rule, ...], spans) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b, *_ in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, spans array<struct<kind, start, end, mask_start, mask_end>>) of each whole text, by start, then in the order of the rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("mask_start", pa.int32()), ("mask_end", pa.int32())]))
        for b in common.slices(batches):
            found = own.scan(b.column(1).to_pylist())
            rows = [[{"kind": rules[k].kind, "start": a, "end": e, "mask_start": m, "mask_end": n} for a, k, e, m, n in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], ["id", "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:int,end:int,mask_start:int,mask_end:int>>")


def redacted_text(text: str, spans, rules: tuple[Rule, ...]) -> str:
    """text with each secret replaced by its kind in brackets; where masks overlap, the leftmost (then the longest) one names it."""
    out, at = [], 0
    for a, neg_b, k in sorted((m, -n, k) for _, k, _, m, n in spans):
        b = -neg_b
        if a >= at:
            out += [text[at:a], f"[{rules[k].kind}]"]
            at = b
        elif b > at:
            at = b
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns, with the secrets in text_col masked. Null texts stay null."""
    names = df.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index(rules)
        for b in common.slices(batches):
            texts = b.column(at).to_pylist()
            found = own.scan([t or "" for t in texts])
            if any(found):
                texts = [redacted_text(t, s, rules) if s else t for t, s in zip(texts, found, strict=True)]
                b = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(b.columns)], schema=pa.schema([pa.field(f.name, pa.string()) if k == at else f for k, f in enumerate(b.schema)]))
            yield b

    return common.over_arrow(df.withColumn(text_col, F.col(text_col).cast("string")), run, df.schema)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: counts of the base kinds, the digest of their spans, and all spans as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index(RULES)
        for b in common.slices(batches):
            found = own.scan(b.column(1).to_pylist())
            base = [[s for s in spans if s[1] < len(BASE)] for spans in found]
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(len(BASE))]
            sha = [hashlib.sha256(listed(RULES, spans).encode()).hexdigest() for spans in base]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(sha, pa.string()), pa.array([listed(RULES, s) for s in found], pa.string())], ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string").withColumnRenamed("id", id_col)


def op3(spark, sf_dir: str) -> DataFrame:
    """Secrets in every text of documents."""
    return digest(common.table(spark, sf_dir, "documents"))
