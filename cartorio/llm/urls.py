"""URL filter by host and path rules and a weighted vocabulary (operator 6).

An Aho-Corasick automaton finds all terms of the vocabulary in one pass over a url; a find counts only
between boundaries (ends of the url or characters other than a-z and 0-9). One strict term, or
``soft_needed`` different soft ones, reject. A rule, where one fits, decides instead.

Defined results: a null url has empty host and path, no rule and no term, and is allowed; urls without
``://`` likewise have empty host and path but are searched for terms; repeated rows are judged each for
itself; an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INSIDE = frozenset(LOWER + "0123456789")
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlPolicy:
    """What rejects a url. Terms are lower-case; a soft term weighs one ``soft_needed``-th."""

    rules: tuple[Rule, ...] = ()
    strict: tuple[str, ...] = (
        "adult", "camgirls", "casino", "escorts", "hentai", "malware", "phishing", "porn", "porno",
        "sexcams", "spam", "viagra", "warez", "xxx",
    )
    soft: tuple[str, ...] = (
        "ads", "bet", "bets", "bingo", "bonus", "cheap", "clicks", "crack", "dating", "deals",
        "discount", "farm", "free", "gambling", "jackpot", "keygen", "loans", "lottery", "nude",
        "pills", "poker", "popup", "promo", "sex", "slots", "track", "webcam", "win", "winner",
    )
    soft_needed: int = 2

    def __post_init__(self) -> None:
        if set(self.strict) & set(self.soft) or "" in (*self.strict, *self.soft):
            raise ValueError("terms must be non-empty and either strict or soft")


@dataclass
class Judge:
    """The policy made ready to judge; built once a task."""

    policy: UrlPolicy
    by_host: dict[str, list[Rule]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # Longest first; of equally long ones that of the longer host, then the one that blocks.
        order = sorted(
            self.policy.rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != BLOCK)
        )
        for rule in order:
            self.by_host.setdefault(rule.host, []).append(rule)
        self.rank = {id(rule): place for place, rule in enumerate(order)}
        self.automaton = ahocorasick.Automaton()
        for strict, terms in ((True, self.policy.strict), (False, self.policy.soft)):
            for term in terms:
                self.automaton.add_word(term, (term, strict))
        if len(self.automaton):
            self.automaton.make_automaton()

    def rule_for(self, host: str, path: str) -> Rule | None:
        found, suffix = [], host
        while True:
            fits = (r for r in self.by_host.get(suffix, ()) if path.startswith(r.path))
            if (rule := next(fits, None)) is not None:
                found.append(rule)
            _, dot, suffix = suffix.partition(".")
            if not dot:
                return min(found, key=lambda r: self.rank[id(r)], default=None)

    def hits(self, url: str) -> tuple[int, int]:
        """Different strict and soft terms of a lower-cased url."""
        if not len(self.automaton):
            return 0, 0
        found = set()
        for end, (term, strict) in self.automaton.iter(url):
            begin = end - len(term) + 1
            before, after = url[begin - 1 : begin] if begin else "", url[end + 1 : end + 2]
            if before not in INSIDE and after not in INSIDE:
                found.add((term, strict))
        strict = sum(is_strict for _, is_strict in found)
        return strict, len(found) - strict


def lowered(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return lowered(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged_urls(
    pages: DataFrame,
    policy: UrlPolicy = UrlPolicy(),
    keys: Sequence[str] = ("page_id",),
    url: str = "url",
) -> DataFrame:
    """The key columns, ``host``, ``path``, ``rule``, ``verdict``, ``strict_terms``, ``soft_terms``."""
    rows = pages.select(
        *keys, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        lowered(F.coalesce(F.col(url), F.lit(""))).alias("__url"),
    )
    out = T.StructType([*pages.select(*keys).schema, *T.StructType.fromDDL(
        "host string, path string, rule string, verdict string, strict_terms int, soft_terms int"
    )])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(policy)
        for batch in batches:
            host, path, urls = (batch.column(name) for name in ("host", "path", "__url"))
            rules = [judge.rule_for(*pair) for pair in zip(host.to_pylist(), path.to_pylist())]
            hits = [judge.hits(text) for text in urls.to_pylist()]
            verdicts = [
                rule.verdict if rule else
                BLOCK if strict or soft >= policy.soft_needed else ALLOW
                for rule, (strict, soft) in zip(rules, hits)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(key) for key in keys), host, path,
                 pa.array([rule and rule.text for rule in rules], pa.string()),
                 pa.array(verdicts, pa.string()),
                 pa.array([strict for strict, _ in hits], pa.int32()),
                 pa.array([soft for _, soft in hits], pa.int32())],
                names=out.names,
            )

    return rows.mapInArrow(task, out)
