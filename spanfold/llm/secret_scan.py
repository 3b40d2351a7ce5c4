"""Secret scans: all rules as one automaton, one pass over the bytes of a text.

``find`` adds the spans (kind, start, end in code points, end exclusive) by start, then by
the order of the rules. ``redact`` puts a mark in their place. Spans of one rule do not
overlap; spans of two rules may.

Defined cases: a null or empty text has no spans (and stays null or empty when redacted);
a text of any length is read whole, in memory of its own size; repeated rows are rows of
their own; an input column named like a result column is replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (
    ArrayType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from spanfold.llm.automaton import Scanner, compile_rules
from spanfold.llm.common import tidy

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", LongType()),
            StructField("end", LongType()),
        ]
    )
)
MARK = "[SECRET]"


def any_case(word: str) -> str:
    """Each letter of a word or pattern in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # characters of a match, or of the value of an assignment
    value_only: bool = False


# What follows a key's first line: two header lines of encrypted keys, then everything up to
# the last line; without that (a key cut short) runs of 16 or more and one shorter run.
# Line ends may be spelled out, blanks or quotes.
_GAP = r"""([\x09-\x0d\x20"'>]|\\[nrt])"""
_PEM_REST = (
    rf"(({_GAP}*(Proc-Type|DEK-Info):\x20*[A-Za-z0-9,-]+)*"
    rf"(({_GAP}|[A-Za-z0-9+/=])*-----END [A-Z ]*PRIVATE KEY-----"
    rf"|({_GAP}*[A-Za-z0-9+/=]{{16,}})+({_GAP}+[A-Za-z0-9+/=]+)?))?"
)
# Three base rules, whose spans are agreed, and formats of well-known keys.
BASE = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign",
        "(" + any_case("password|passwd|secret|token|api_?key") + ")"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6, value_only=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    # a run of 24 or more, so that short runs in ordinary words are no matches to begin with
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", least=24),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("google", "AIza[A-Za-z0-9_-]+", least=30),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]+", least=18),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=20),
    Rule("bearer", any_case("bearer") + r"\x20+[A-Za-z0-9._~+/=-]+", least=23),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----" + _PEM_REST),
    Rule("url_password", r"[a-z]+://[^\x00-\x20/:@]+:[^\x00-\x20/@]+@"),
)

_CONTINUED = bytes(range(0x80, 0xC0))


def _long_enough(rule: Rule, match: bytes) -> bool:
    if rule.value_only:
        sign = min(at for at in (match.find(b":"), match.find(b"=")) if at >= 0)
        tail = match[sign + 1 :].lstrip(b" ")
        match = tail[1:] if tail[:1] in (b'"', b"'") else tail
    return len(match) >= rule.least


def spans_of(text: bytes, scanner: Scanner, rules: Sequence[Rule]) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes, sorted."""
    return sorted(
        (start, rule, end)
        for rule, start, end in scanner.spans(text)
        if _long_enough(rules[rule], text[start:end])
    )


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> dict[int, int]:
    """Offset in code points of every start and end, counted in one go."""
    found, at, count = {}, 0, 0
    for offset in sorted({o for start, _, end in spans for o in (start, end)}):
        count += len(text[at:offset].translate(None, _CONTINUED))
        found[offset], at = count, offset
    return found


def _redacted(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], MARK.encode()]
        at = max(at, end)
    return b"".join([*parts, text[at:]])


def _per_text(
    docs: DataFrame, text: str, column: str, result: DataType, rules: Sequence[Rule],
    value: Callable[[bytes, list[tuple[int, int, int]]], object],
) -> DataFrame:
    """``docs`` with ``column`` computed from the bytes of each text and its spans."""
    compiled = compile_rules(tuple(r.pattern for r in rules))
    rest = [c for c in docs.columns if c != column]
    frame = docs.select(*rest, F.col(text).cast("string").cast("binary").alias("_bytes"))
    arrow = to_arrow_type(result)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(compiled)
        for batch in batches:
            made = []
            for cell in batch.column(len(rest)):
                data = cell.as_py()
                made.append(value(data, spans_of(data or b"", scanner, rules)))
            columns = [*batch.columns[:-1], pa.array(made, arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, column])

    schema = StructType([*frame.drop("_bytes").schema.fields, StructField(column, result)])
    return frame.mapInArrow(tidy(read), schema)


def find(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``."""

    def value(data: bytes | None, spans: list[tuple[int, int, int]]) -> list[dict]:
        points = _code_points(data or b"", spans)
        return [
            {"kind": rules[rule].kind, "start": points[start], "end": points[end]}
            for start, rule, end in spans
        ]

    return _per_text(docs, text, "spans", SPANS, rules, value)


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` in the same columns, every span in ``text`` replaced by a mark."""

    def value(data: bytes | None, spans: list[tuple[int, int, int]]) -> str | None:
        return None if data is None else _redacted(data, spans).decode("utf-8", "replace")

    return _per_text(docs, text, text, StringType(), rules, value).select(*docs.columns)


def joined(spans, kinds: Sequence[str] | None = None):
    """Spans as text, ``kind:start:end`` joined by commas."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
