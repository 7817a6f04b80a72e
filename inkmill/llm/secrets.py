"""Secrets in texts, found by one automaton over all rules.

Every rule is a head, a class of characters and the least number of them: a match is the head and the longest run of
the class, and counts if the run is long enough. What belongs to a match behind its run, as the body of a key, is read
by a pattern of the rule. The rules are compiled together into one minimal automaton that reads
every byte of a text once and tells which rules may match somewhere; of a run behind a head it demands the first
``PROBE`` characters only, as longer counts of several rules would multiply its states. Only for those rules is the
text read again, by the rule's own automaton without a count: leftmost matches, longest, none inside another, too
short ones dropped afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .automaton import Automaton, compile_rules
from .common import keeps_columns, without

MASK = "[SECRET]"
PROBE = 4


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    tail: str
    least: int
    ignore_case: bool = False
    rest: str = ""  # pattern of what belongs to the match behind its run


# The body of a PEM block up to its END line, line ends also as escapes; without that line its headers and base64 lines.
_BODY = (r"(?:(?!-----BEGIN)[A-Za-z0-9+/=\s\\:,.-])*?-----END(?: [A-Z0-9]+)* PRIVATE KEY-----"
         r"|(?:[\r\n]++[A-Za-z-]++: [^\r\n]*+)*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{16,}+={0,2}+)*+")
# The three base rules.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=\\-]", 8, True),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
)
MORE = (
    Rule("github", "gh[opsur]_", "[A-Za-z0-9]", 30),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9\\-]", 10),
    Rule("pem", "-----BEGIN( [A-Z0-9]+)* PRIVATE KEY--", "-", 3, rest=_BODY),
)
RULES = BASE + MORE


def _compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton]]:
    every = compile_rules([(f"{r.head}{r.tail}{{{min(r.least, PROBE) if r.head else r.least},}}", r.ignore_case) for r in rules], True)
    return every, [compile_rules([(f"{r.head}{r.tail}+", r.ignore_case)], False) for r in rules]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...], every: Automaton, alone: list[Automaton]):
        self.rules, self.start = rules, every.rows()[0]
        self.alone = [a.rows()[0] for a in alone]
        self.rest = [re.compile(r.rest.encode()) if r.rest else None for r in rules]

    def rules_in(self, data: bytes) -> int:
        """Bit set of the rules that match somewhere: one look-up per byte."""
        row, found = self.start, 0
        for b in data:
            row = row[b]
            if row[256]:
                found |= row[256]
        return found

    def matches(self, data: bytes, rule: int) -> list[tuple[int, int]]:
        first, least, n = self.alone[rule], self.rules[rule].least, len(data)
        opens = [not first[b][257] for b in range(256)]
        spans, at = [], 0
        while at < n:
            if not opens[data[at]]:
                at += 1
                continue
            row, i, end, run = first, at, -1, 0
            while i < n:
                row = row[data[i]]
                if row[257]:
                    break
                i += 1
                if row[256]:
                    end, run = i, run + 1
            if end < 0:
                at += 1
                continue
            if run >= least:
                if self.rest[rule]:
                    end = self.rest[rule].match(data, end).end()
                spans.append((at, end))
            at = end
        return spans

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, in this order."""
        data = (text or "").encode("utf-8", "surrogatepass")
        found = self.rules_in(data)
        if not found:
            return []
        out = [(a, k, b) for k in range(len(self.rules)) if found >> k & 1 for a, b in self.matches(data, k)]
        if len(data) != len(text):
            # Code points before a byte, once for all ends in ascending order.
            place, count, last = {}, 0, 0
            for byte in sorted({x for a, _, b in out for x in (a, b)}):
                count += len(data[last:byte].decode("utf-8", "surrogatepass"))
                place[byte], last = count, byte
            out = [(place[a], k, place[b]) for a, k, b in out]
        return sorted(out)


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """The automata of a worker; compiling takes well under a second and gives the same arrays everywhere."""
    return Scanner(rules, *_compiled(rules))


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with each stretch of touching or overlapping spans replaced by the mask."""
    out, at = [], 0
    for start, _, end in spans:
        if start > at or not out:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


@keeps_columns("text_col")
def scan_secrets(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, n_base: int = len(BASE)) -> DataFrame:
    """Adds n_<kind> of each base rule, base_sha256 and spans.

    ``spans`` lists kind:start:end of all matches by start, then rule, comma-joined, in code points with the end
    exclusive; ``base_sha256`` is the digest of the same list of base rules only. A null or empty text has none.
    Columns of these names are replaced, all others stay; repeated rows stay repeated.
    """
    kinds = [r.kind for r in rules]
    names = [f"n_{k}" for k in kinds[:n_base]]
    kind = pa.struct([*[(n, pa.int64()) for n in names], ("base_sha256", pa.string()), ("spans", pa.string())])

    @F.arrow_udf("struct<" + ",".join(f"{n}:long" for n in names) + ",base_sha256:string,spans:string>")
    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = scanner(rules)
        for part in parts:
            rows = []
            for text in part.to_pylist():
                spans = own.spans(text)
                base = [s for s in spans if s[1] < n_base]
                listed = [",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in some) for some in (base, spans)]
                counts = {n: sum(k == i for _, k, _ in base) for i, n in enumerate(names)}
                rows.append(counts | {"base_sha256": sha256(listed[0].encode()).hexdigest(), "spans": listed[1]})
            yield pa.array(rows, kind)

    added = [f.name for f in kind]
    return without(df, *added).withColumn("_scan", scan(F.col(text_col))).withColumns({n: F.col("_scan")[n] for n in added}).drop("_scan")


def mask_secrets(df: DataFrame, text_col: str = "text", mask: str = MASK, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The table with secrets in the text replaced by ``mask``; a null text stays null, all other columns stay."""
    @F.arrow_udf("string")
    def cover(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = scanner(rules)
        for part in parts:
            texts = part.to_pylist()
            yield pa.array([masked(t, s, mask) if t and (s := own.spans(t)) else t for t in texts], pa.string())

    return df.withColumn(text_col, cover(F.col(text_col)))
