"""URL rules: a fixed list of allow and block rules, and pattern rules found by their rarest token.

Every pattern rule names literal tokens (runs of letters and digits) that each URL it matches must contain.
How often each of these tokens occurs is counted over all URLs, and a rule is filed under its rarest one.
A URL's own tokens then fetch the few rules to try, and only those run their regular expression. The rules
are configuration held by the caller; pages are judged where they are read, and only token counts move.

Edge values: a null URL and one without ``://`` have an empty host and path. They fit no listed rule; a pattern
still sees a URL without ``://``. Rows with null or equal ids are judged each for itself. Very long URLs are judged
whole. An empty table gives an empty one, and without rules every URL is allowed. Other columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import type_of

_TOKEN = re.compile(r"[a-z0-9]+")
TOKEN_PATTERN = "[a-z0-9]+"


@dataclass(frozen=True)
class ListedRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased URL, and tokens without which it cannot match."""

    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path as the rules see them."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[end:]
    cut = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return _ascii_lower(rest[:end]), tail[:cut]


def _ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)


class ListedIndex:
    """Listed rules by host: a URL looks up its host and each parent domain."""

    def __init__(self, rules: Sequence[ListedRule]) -> None:
        self.by_host: dict[str, list[ListedRule]] = {}
        for rule in rules:
            self.by_host.setdefault(rule.host, []).append(rule)

    def longest(self, host: str, path: str) -> ListedRule | None:
        best, at = None, 0
        while host and at >= 0:
            for rule in self.by_host.get(host[at:], ()):
                if path.startswith(rule.path) and (best is None or self._order(rule) > self._order(best)):
                    best = rule
            at = host.find(".", at) + 1 or -1
        return best

    @staticmethod
    def _order(rule: ListedRule) -> tuple:
        return len(rule.text), rule.verdict == "block", rule.text


class PatternIndex:
    """Pattern rules by their rarest token, the first of equally rare ones in order of spelling."""

    def __init__(self, rules: Sequence[PatternRule], counts: dict[str, int]) -> None:
        self.by_token: dict[str, list[tuple[int, re.Pattern, str]]] = {}
        for place, rule in enumerate(rules):
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            self.by_token.setdefault(rarest, []).append((place, re.compile(rule.pattern), rule.verdict))

    def verdict(self, url: str, default: str) -> str:
        """The verdict of the first rule, in the order given, that matches."""
        text = _ascii_lower(url)
        found = {r for t in set(_TOKEN.findall(text)) if t in self.by_token for r in self.by_token[t]}
        for _, pattern, verdict in sorted(found, key=lambda r: r[0]):
            if pattern.search(text):
                return verdict
        return default


def token_counts(pages: DataFrame, tokens: set[str], url_column: str = "url") -> dict[str, int]:
    """In how many URLs each of the rules' tokens occurs; one row per token reaches the driver."""
    lower = F.translate(F.col(url_column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.array_intersect(F.array_distinct(F.regexp_extract_all(lower, F.lit(f"({TOKEN_PATTERN})"), F.lit(1))),
                              F.array(*[F.lit(t) for t in sorted(tokens)]))
    rows = pages.select(F.explode(found).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def judge(pages: DataFrame, listed: Sequence[ListedRule], patterns: Sequence[PatternRule], default: str = "allow",
          id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Per page: host, path, the longest listed rule that fits (or null), and a verdict."""
    counts = token_counts(pages, {t for r in patterns for t in r.tokens}, url_column) if patterns else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_host, by_token = ListedIndex(listed), PatternIndex(patterns, counts)
        for batch in batches:
            hosts, paths, rules, verdicts = [], [], [], []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                rule = by_host.longest(host, path)
                hosts.append(host)
                paths.append(path)
                rules.append(rule.text if rule else None)
                verdicts.append(rule.verdict if rule else by_token.verdict(url or "", default))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.string()) for c in (hosts, paths, rules, verdicts)]], names)

    names = [id_column, "host", "path", "rule", "verdict"]
    schema = f"`{id_column}` {type_of(pages, id_column)}, host string, path string, rule string, verdict string"
    return pages.select(id_column, url_column).mapInArrow(run, schema)
