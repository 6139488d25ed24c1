"""URL filters: host rules by longest match, and pattern rules indexed by their rarest literal token.

A URL's host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; its
path goes on to the next ``?``, ``#`` or the end. A host rule fits its host and all subdomains if the path starts with the
rule's; the longest rule that fits decides.

Where none fits, pattern rules do. Each is a regular expression; from it follow the literal tokens (runs of a-z and 0-9) that
any URL it matches must contain, for each of its alternatives. A rule is filed, for each alternative, under that of its
tokens which fewest URLs of the table have. A URL is cut into its distinct tokens, these fetch the candidate rules, and only those run their
expressions, on the lower-cased URL. A rule with an alternative without a literal token is a candidate for every URL.
Expressions mean the same here as in RE2: classes and boundaries are those of ASCII, and ``$`` is the very end.

Host rules are indexed by host: a URL's host asks for its ends of the lengths that rules have, whatever the number of rules.

Null URLs, and those without ``://``, have an empty host and path; no host rule fits, and a null URL matches no pattern: it is
allowed. Repeated rows give repeated rows. Columns other than id and URL are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from re import _constants as kinds
from re import _parser as expressions

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALLOW, BLOCK = "allow", "block"
_TOKEN = re.compile(r"[a-z0-9]+")
# The rules are sent to every task; a longer list than this is refused.
MOST_RULES = 200_000


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# An expression with more alternatives than this is taken as one without tokens.
MOST_ALTERNATIVES = 32
# Atoms of an alternative besides characters: something that is no part of a token, and anything at all.
_CLEAN, _ANY = object(), object()
_TOKEN_CHARACTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def _atoms(parsed) -> list[list]:
    """The alternatives of a parsed expression, as lists of atoms."""
    found: list[list] = [[]]
    for kind, value in parsed:
        if kind is kinds.LITERAL:
            options = [[chr(value)]]
        elif kind is kinds.SUBPATTERN:
            options = _atoms(value[3])
        elif kind is kinds.BRANCH:
            options = [o for branch in value[1] for o in _atoms(branch)]
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
            least, most, body = value
            inside = _atoms(body)
            options = [[]] if least == 0 else []
            options += inside if most == 1 else [[*o, _ANY, *o] for o in inside]
            if most != 1:
                options += [] if least > 1 else inside
        elif kind is kinds.AT and value in (kinds.AT_BOUNDARY, kinds.AT_BEGINNING, kinds.AT_BEGINNING_STRING, kinds.AT_END, kinds.AT_END_STRING):
            options = [[_CLEAN]]
        elif kind is kinds.IN and all(k is kinds.LITERAL and chr(v) not in _TOKEN_CHARACTERS for k, v in value):
            options = [[_CLEAN]]
        else:
            options = [[_ANY]]
        if len(found) * len(options) > MOST_ALTERNATIVES:
            found, options = [[]], [[_ANY]]
        found = [[*a, *b] for a, b in itertools.product(found, options)]
    return found


def _whole_tokens(atoms: list) -> frozenset[str]:
    """Runs of token characters with something else on both sides; what borders on anything at all is no proof."""
    out, run, proven = set(), "", False
    for atom in [*atoms, _ANY]:
        if isinstance(atom, str) and atom in _TOKEN_CHARACTERS:
            run += atom
            continue
        if run and proven and atom is not _ANY:
            out.add(run)
        run, proven = "", atom is not _ANY
    return frozenset(out)


@dataclass(frozen=True)
class PatternRule:
    """``pattern`` is searched in the lower-cased URL."""

    pattern: str
    verdict: str = BLOCK

    @cached_property
    def compiled(self) -> re.Pattern:
        # RE2's end is the very end, not also the place before a last line break
        return re.compile(re.sub(r"(?<!\\)\$", r"\\Z", self.pattern), re.ASCII)

    @cached_property
    def tokens(self) -> tuple[frozenset[str], ...]:
        """For each alternative the tokens that every match contains."""
        return tuple(dict.fromkeys(_whole_tokens(a) for a in _atoms(expressions.parse(self.pattern, re.ASCII))))


HOST_RULES = (
    HostRule("net", "/", BLOCK),
    HostRule("example.net", "/en/", ALLOW),
    HostRule("example.com", "/de/", BLOCK),
    HostRule("org", "/fr/", ALLOW),
)
PATTERN_RULES = tuple(
    PatternRule(p)
    for p in (
        r"://([^/?#]*\.)?spam-[^/?#]*",
        r"://[^/?#]*\bfarm\b[^/?#]*",
        r"://([^/?#]*\.)?(?:free-)?casino\b",
        r"://([^/?#]*[.-])?poker\b",
        r"://([^/?#]*[.-])?porn\b",
        r"://([^/?#]*[.-])?xxx\b",
        r"://([^/?#]*[.-])?adult\b",
        r"://([^/?#]*\.)?doubleclick\.",
        r"://ads?\.",
        r"/(?:wp-)?login\.php\b",
        r"/cgi-bin/",
        r"/(?:user|account)/signup\b",
        r"[?&]sessionid=",
        r"[?&]phpsessid=",
        r"[?&]replytocom=",
        r"/calendar/\d{4}/\d{2}\b",
        r"\.(?:exe)(?:[?#]|$)",
        r"\.(?:apk)(?:[?#]|$)",
    )
)


def host_of(url: Column) -> Column:
    """``://`` and what follows up to ``/``, ``?``, ``#`` or the end."""
    return F.translate(_behind(url, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return _behind(url, 2)


def _behind(url: Column, group: int) -> Column:
    # (?s): a URL with line breaks in it is one URL all the same
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


class HostIndex:
    """Host rules by host, the longest first; of rules of one length the first by name."""

    def __init__(self, rules: Sequence[HostRule]) -> None:
        self.by_host: dict[str, list[HostRule]] = {}
        for rule in rules:
            self.by_host.setdefault(rule.host, []).append(rule)
        self.lengths = sorted({len(h) for h in self.by_host}, reverse=True)

    def longest(self, host: str, path: str) -> HostRule | None:
        found = [
            rule
            for size in self.lengths
            if size <= len(host) and (size == len(host) or host[-size - 1] == ".")
            for rule in self.by_host.get(host[len(host) - size :], ())
            if path.startswith(rule.path)
        ]
        return min(found, key=lambda r: (-len(r.name), r.name), default=None)


def token_urls(urls: DataFrame, url_col: str, rules: Sequence[PatternRule]) -> dict[str, int]:
    """How many URLs of the table have each token of the rules."""
    wanted = sorted({t for r in rules for tokens in r.tokens for t in tokens})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{url_col}`")), F.lit("([a-z0-9]+)")))
    found = urls.select(F.explode(tokens).alias("token")).filter(F.col("token").isin(wanted)).groupBy("token").count()
    # at most one row for each token of the rules
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in found.collect()}


class PatternIndex:
    """Pattern rules filed under their rarest token."""

    def __init__(self, rules: Sequence[PatternRule], counts: dict[str, int]) -> None:
        self.always: list[int] = []
        self.by_token: dict[str, list[int]] = {}
        self.rules = [(r.compiled, r.verdict) for r in rules]
        self.patterns = [r.pattern for r in rules]
        for number, rule in enumerate(rules):
            if not all(rule.tokens):
                self.always.append(number)
                continue
            for rarest in {min(tokens, key=lambda t: (counts.get(t, 0), t)) for tokens in rule.tokens}:
                self.by_token.setdefault(rarest, []).append(number)

    def candidates(self, url: str) -> list[int]:
        found = set(self.always)
        for token in set(_TOKEN.findall(url)) & self.by_token.keys():
            found.update(self.by_token[token])
        return sorted(found)

    def first(self, url: str | None) -> int | None:
        """The first rule of the list that matches; the order of the list decides between rules."""
        if url is None:
            return None
        # A-Z only, as for hosts
        url = re.sub("[A-Z]+", lambda m: m[0].lower(), url)
        return next((n for n in self.candidates(url) if self.rules[n][0].search(url)), None)


def url_verdicts(
    urls: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    hosts: Sequence[HostRule] = HOST_RULES,
    patterns: Sequence[PatternRule] = PATTERN_RULES,
) -> DataFrame:
    """``id, host, path, rule, verdict`` and, for URLs that no host rule fits, the ``pattern`` that blocked or allowed them."""
    if len(hosts) + len(patterns) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    counts = token_urls(urls, url_col, patterns)
    url = F.col(f"`{url_col}`")
    split = urls.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, named = PatternIndex(patterns, counts), HostIndex(hosts)
        for batch in batches:
            urls, of, at = (batch.column(c).to_pylist() for c in ("url", "host", "path"))
            told = [named.longest(h, p) for h, p in zip(of, at, strict=True)]
            hits = [index.first(u) if r is None else None for u, r in zip(urls, told, strict=True)]
            final = [r.verdict if r else ALLOW if n is None else index.rules[n][1] for r, n in zip(told, hits, strict=True)]
            names = [None if n is None else index.patterns[n] for n in hits]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "host", "path")),
                    pa.array([r.name if r else None for r in told], pa.string()),
                    pa.array(final, pa.string()),
                    pa.array(names, pa.string()),
                ],
                names=["id", "host", "path", "rule", "verdict", "pattern"],
            )

    texts = [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict", "pattern")]
    out = T.StructType([T.StructField("id", split.schema["id"].dataType), *texts])
    return split.mapInArrow(run, out).withColumnRenamed("id", id_col)
