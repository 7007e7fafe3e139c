"""Secret scans through a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived (an AND of
ORs of ANDs): every match must contain trigrams that satisfy it.  For each
slice of documents an inverted index of the trigrams that any rule asks for is
built over the ASCII-lower-cased bytes, the postings are intersected and
united as the query says, and the rule's pattern verifies the candidate
documents only.  A rule without mandatory trigrams scans every document.

Results per document: the spans of all rules as ``(kind, start, end)`` in code
points, end exclusive, ordered by start, then by the rules' order.  Matches of
one kind do not overlap; different kinds may.  Null and empty texts have no
spans.  The operator is row-wise: repeated rows, null ids, ties and further
columns pass through, and texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _parser as sre

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import packed
from strideframe.llm.stored import SMALL_BATCH_BYTES, small_batches

#: a set of alternatives larger than this is not followed further
MAX_ALTERNATIVES = 256


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``min_group`` drops matches whose group ``group`` is shorter."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    min_group: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The three base kinds, then formats that issuers of credentials publish.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Query: a tuple of clauses, all of which must hold; a clause is a set of
#: alternatives, one of which must hold; an alternative is a set of trigrams, all present.
Query = tuple[frozenset[frozenset[str]], ...]


def _grams(text: str) -> frozenset[str]:
    """Trigrams of the UTF-8 bytes, each byte written as the character of its number."""
    raw = text.encode("utf-8", "surrogatepass").decode("latin-1")
    return frozenset(raw[i : i + 3] for i in range(len(raw) - 2))


def _clause(texts: set[str]) -> Query:
    """What is known when one of ``texts`` must occur: nothing, if one of them has no trigram."""
    if not texts or any(not _grams(t) for t in texts):
        return ()
    return (frozenset(map(_grams, texts)),)


def _either(queries: list[Query]) -> Query:
    if any(not q for q in queries):
        return ()
    # one clause of each branch is enough to stay necessary; take the most telling
    best = [max(q, key=lambda c: min(len(a) for a in c)) for q in queries]
    return (frozenset().union(*best),)


def _lowered(code: int) -> str:
    return chr(code + 32 if 65 <= code <= 90 else code)


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """``(exact texts or None, query)`` of a sequence of parsed pattern nodes."""
    current: set[str] = {""}
    open_end = False  # something unknown stood before: ``current`` is only a part
    query: Query = ()
    for op, arg in nodes:
        texts, sub = _node(op, arg)
        if texts is None or len(current) * len(texts) > MAX_ALTERNATIVES:
            query += _clause(current) + sub
            if texts is not None:
                current, open_end = texts, True
            else:
                current, open_end = {""}, True
        else:
            current = {a + b for a in current for b in texts}
    if open_end:
        return None, query + _clause(current)
    return current, query


def _node(op, arg) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {_lowered(arg)}, ()
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(_lowered(value))
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                chars |= {_lowered(c) for c in range(value[0], value[1] + 1)}
            else:
                return None, ()
        return (chars, ()) if len(chars) <= 8 else (None, ())
    if op is sre.SUBPATTERN:
        return _walk(arg[3])
    if op is sre.BRANCH:
        found = [_walk(x) for x in arg[1]]
        if all(texts is not None for texts, _ in found):
            return set().union(*(texts for texts, _ in found)), ()
        return None, _either([q if texts is None else _clause(texts) for texts, q in found])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, inner = arg
        texts, sub = _walk(inner)
        if (low, high) == (0, 1) and texts is not None:
            return texts | {""}, ()
        if low == 0:
            return None, ()
        return None, sub + (_clause(texts) if texts is not None else ())
    if op is sre.AT:
        return {""}, ()
    return None, ()


def trigram_query(pattern: str) -> Query:
    """Necessary trigrams of any match, over ASCII-lower-cased text; ``()`` if there are none."""
    texts, query = _walk(sre.parse(pattern, re.ASCII))
    return _clause(texts) if texts is not None else query


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled().finditer, trigram_query(r.pattern)) for r in rules]
        grams = sorted({g for _, _, q in self.rules for c in q for a in c for g in a})
        self.code = {g: i + 1 for i, g in enumerate(grams)}
        self.table = np.zeros(1 << 24, np.int16)  # trigram of bytes -> number of an indexed trigram
        for g, i in self.code.items():
            raw = g.encode("latin-1")
            self.table[raw[0] << 16 | raw[1] << 8 | raw[2]] = i

    def postings(self, data: np.ndarray, offs: np.ndarray) -> dict[int, np.ndarray]:
        """Rows of each indexed trigram, sorted."""
        if len(data) < 3:
            return {}
        low = packed.LOWER[data].astype(np.int32)
        hits = self.table[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(hits)
        row = np.searchsorted(offs, at, "right") - 1
        keys = np.unique(hits[at].astype(np.int64) * len(offs) + row)
        gram, row = keys // len(offs), keys % len(offs)
        cuts = np.flatnonzero(np.diff(gram, prepend=-1))
        return {int(gram[a]): row[a:b] for a, b in zip(cuts, [*cuts[1:], len(gram)][: len(cuts)], strict=True)}

    def candidates(self, query: Query, post: dict[int, np.ndarray], n: int) -> np.ndarray:
        rows = np.ones(n, bool)
        none = np.zeros(0, np.int64)
        for clause in query:
            some = np.zeros(n, bool)
            for grams in clause:
                lists = sorted((post.get(self.code[g], none) for g in grams), key=len)
                found = lists[0]
                for other in lists[1:]:
                    if not len(found):
                        break
                    found = np.intersect1d(found, other, assume_unique=True)
                some[found] = True
            rows &= some
        return np.flatnonzero(rows)

    def scan(self, texts: list[str | None], data: np.ndarray, offs: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Per row the spans ``(start, rule number, end)`` in order."""
        post = self.postings(data, offs)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, finditer, query) in enumerate(self.rules):
            for row in self.candidates(query, post, len(texts)).tolist():
                for m in finditer(texts[row] or ""):
                    if m.end(rule.group) - m.start(rule.group) >= rule.min_group:
                        found[row].append((m.start(), k, m.end()))
        for spans in found:
            if len(spans) > 1:
                spans.sort()
        return found


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def find_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "secret_spans") -> DataFrame:
    """Add the array ``secret_spans`` of (kind, start, end); a column of that name is replaced."""
    kept = small_batches(docs.drop(out) if out != text else docs, SMALL_BATCH_BYTES)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.ArrayType(SPAN))])
    kinds = [r.kind for r in rules]
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = packed.held(f"secrets {rules}", lambda: Scanner(rules))
        for batch in batches:
            for part, data, offs in packed.slices(batch, text):
                found = scanner.scan(part.column(text).to_pylist(), data, offs)
                col = pa.array([[{"kind": kinds[k], "start": a, "end": b} for a, k, b in spans] for spans in found], arrow)
                yield pa.RecordBatch.from_arrays([*part.columns, col], names=schema.names)

    return kept.mapInArrow(run, schema)


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def digests(docs: DataFrame) -> DataFrame:
    """The result of ``op4``: counts and digest of the base kinds, and all spans."""
    found = find_secrets(docs.select("doc_id", "text")).drop("text")
    spans = F.col("secret_spans")
    base = [r.kind for r in BASE_RULES]
    return found.select(
        "doc_id",
        *[_count(spans, k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Replace every found span (overlapping ones as one) by ``mark``; other text stays as it is."""
    hidden = "secret_spans_"
    found = find_secrets(docs, text, rules, hidden)

    def add(acc: Column, s: Column) -> Column:
        # acc: the text so far and the first code point not yet copied
        fresh = s["start"] >= acc["at"]
        head = F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.when(fresh, head).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cleaned = F.aggregate(hidden, start, add, lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return found.withColumn(text, F.when(F.size(hidden) > 0, cleaned).otherwise(F.col(text))).drop(hidden)
