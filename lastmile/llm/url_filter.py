"""Operator 3: URL filters by a bit-parallel wildcard automaton.

All rules are compiled into one non-deterministic automaton whose states are
bits packed into 64-bit words (multiword Shift-And). One step per byte of a
URL advances all patterns at once: bits shift by one (with a carry between
words), are kept where the byte fits the next literal, and bits in front of a
wildcard stay where the byte fits the wildcard. The step is vectorised over a
batch of URLs with numpy, longest first, so a batch costs as many steps as its
longest URL has bytes and only the URLs that reach a step take part.

Canonical URL: the host (after the first ``://`` up to ``/``, ``?``, ``#`` or
the end, A-Z lower-cased), then the path (up to ``?``, ``#`` or the end).
In a glob ``*`` stands for any bytes but ``/`` and ``**`` for any bytes.

* A host-and-path rule ``example.net/en/`` becomes the globs ``example.net/en/**``
  and ``*.example.net/en/**``: the host itself and all its subdomains, with the
  rule's path as prefix. The longest rule that fits decides; of equally long
  ones a block decides, then the smaller by code points.
* Where no rule fits, the URL is blocked if a block glob fits and no allow
  glob does, else allowed.

Scale. Rules are configuration: their automaton, not data, travels to the
tasks (``MAX_STATES`` bits at most). Rows need no shuffle; only the id and URL
columns are read.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule and gets the globs' verdict on the empty string; empty tables give
no rows; repeated rows are judged alike; other columns pass through, and where
one is named as an output column, the output column replaces it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.common import table

#: Most automaton states; rules beyond that belong in a joined table.
MAX_STATES = 1 << 16

RESULT = "struct<host:string,path:string,rule:string,verdict:string>"


@dataclass(frozen=True)
class UrlRules:
    """``block`` and ``allow``: (host, path) rules; the globs judge the rest."""

    block: tuple[tuple[str, str], ...] = ()
    allow: tuple[tuple[str, str], ...] = ()
    block_globs: tuple[str, ...] = ()
    allow_globs: tuple[str, ...] = ()


@dataclass
class Automaton:
    """Shift-And tables of a list of globs; ``fits[i]`` are the final bits of glob i."""

    globs: list[str]
    words: int = 0
    start: np.ndarray = field(default=None, repr=False)
    step: np.ndarray = field(default=None, repr=False)
    stay: np.ndarray = field(default=None, repr=False)
    final: list[int] = field(default_factory=list)

    def __post_init__(self):
        literal: list[int] = []  # the byte that enters each state; -1: an entry state
        loops: list[int] = []  # 0 none, 1 any byte but "/", 2 any byte
        entry = []
        for glob in self.globs:
            entry.append(len(literal))
            literal.append(-1)
            loops.append(0)
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i] == ord("*"):
                    wide = raw[i : i + 2] == b"**"
                    loops[-1] = max(loops[-1], 2 if wide else 1)
                    i += 2 if wide else 1
                else:
                    literal.append(raw[i])
                    loops.append(0)
                    i += 1
            self.final.append(len(literal) - 1)
        if len(literal) > MAX_STATES:
            raise ValueError(f"{len(literal)} states; at most {MAX_STATES}")
        self.words = max(1, -(-len(literal) // 64))
        self.start = np.zeros(self.words, np.uint64)
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        for k in entry:
            self.start[k // 64] |= np.uint64(1 << k % 64)
        for k, (byte, loop) in enumerate(zip(literal, loops)):
            bit = np.uint64(1 << k % 64)
            if byte >= 0:
                self.step[byte, k // 64] |= bit
            if loop:
                self.stay[:, k // 64] |= bit
            if loop == 1:
                self.stay[ord("/"), k // 64] &= ~bit

    def run(self, strings: list[bytes]) -> np.ndarray:
        """State words after each string, one row a string."""
        length = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(-length, kind="stable")
        data = np.frombuffer(b"".join(strings), np.uint8)
        first = (np.cumsum(length) - length)[order]
        state = np.repeat(self.start[None, :], len(strings), axis=0)
        sorted_length = length[order]
        for t in range(int(length.max(initial=0))):
            n = int(np.searchsorted(-sorted_length, -t, side="left"))  # strings longer than t
            byte = data[first[:n] + t]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[byte]) | (now & self.stay[byte])
        out = np.empty_like(state)
        out[order] = state
        return out

    def fits(self, state: np.ndarray, glob: int) -> np.ndarray:
        k = self.final[glob]
        return (state[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1) == 1


_UPPER = {c: c + 32 for c in range(65, 91)}


def canonical(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or no ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host_end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    path = rest[host_end:]
    path_end = min((k for k in map(path.find, "?#") if k >= 0), default=len(path))
    return rest[:host_end].translate(_UPPER), path[:path_end]


def judge(urls, rules: UrlRules, automaton: Automaton | None = None) -> pd.DataFrame:
    """Host, path, rule and verdict of a batch of URLs."""
    ranked = sorted([(h + p, h, p, "block") for h, p in rules.block] + [(h + p, h, p, "allow") for h, p in rules.allow],
                    key=lambda r: (-len(r[0]), r[3] == "allow", r[0]))
    automaton = automaton or compile_rules(rules)
    parts = [canonical(u) for u in urls]
    state = automaton.run([(h + p).encode("utf-8", "surrogatepass") for h, p in parts])
    rule = np.full(len(parts), None, object)
    verdict = np.full(len(parts), None, object)
    for k, (name, _, _, says) in enumerate(ranked):
        hit = (automaton.fits(state, 2 * k) | automaton.fits(state, 2 * k + 1)) & np.equal(verdict, None)
        rule[hit], verdict[hit] = name, says
    at = 2 * len(ranked)
    blocked, allowed = (np.zeros(len(parts), bool) for _ in range(2))
    for k in range(len(rules.block_globs)):
        blocked |= automaton.fits(state, at + k)
    for k in range(len(rules.allow_globs)):
        allowed |= automaton.fits(state, at + len(rules.block_globs) + k)
    rest = np.equal(verdict, None)
    verdict[rest] = np.where(blocked & ~allowed, "block", "allow")[rest]
    return pd.DataFrame({"host": [h for h, _ in parts], "path": [p for _, p in parts], "rule": rule, "verdict": verdict})


def compile_rules(rules: UrlRules) -> Automaton:
    """One automaton: two globs a rule, best rule first, then the globs."""
    ranked = sorted([(h + p, h, p, "block") for h, p in rules.block] + [(h + p, h, p, "allow") for h, p in rules.allow],
                    key=lambda r: (-len(r[0]), r[3] == "allow", r[0]))
    for name, *_ in ranked:
        if "*" in name:
            raise ValueError(f"host-and-path rules hold no wildcard: {name}")
    globs = [g for _, h, p, _ in ranked for g in (f"{h}{p}**", f"*.{h}{p}**")]
    return Automaton(globs + list(rules.block_globs) + list(rules.allow_globs))


def filter_urls(pages: DataFrame, rules: UrlRules, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each URL."""
    automaton = compile_rules(rules)

    def batch(values: pd.Series) -> pd.DataFrame:
        return judge(values.where(values.notna(), None), rules, automaton)

    judged = F.pandas_udf(batch, RESULT)(F.col(url))
    found = pages.withColumn("__judged", judged)
    return found.withColumns({c: F.col("__judged")[c] for c in ("host", "path", "rule", "verdict")}).drop("__judged")


#: The contract's rules, and globs for hosts that no rule covers (fixed values).
CONTRACT_RULES = UrlRules(
    block=(("net", "/"), ("example.com", "/de/")),
    allow=(("example.net", "/en/"), ("org", "/fr/")),
    block_globs=("*casino*/**", "*free-bets*/**", "*spam-farm*/**", "*.xxx/**"),
)


def op3_url_filter(spark, sf_dir) -> DataFrame:
    """Contract query: the judgement of every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, CONTRACT_RULES).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
with cut as (
  select page_id, case when url is not null and instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), split as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut
), parts as (
  select page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from split
), rules(rule, rule_host, rule_path, says) as (
  values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), judged as (
  select page_id, host, path,
    (select arg_max(struct_pack(rule, says), length(rule)) from rules
     where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as best
  from parts
)
select page_id, host, path, best.rule as rule,
  coalesce(best.says, case when path <> '' and (contains(host, 'casino') or contains(host, 'free-bets') or contains(host, 'spam-farm') or ends_with(host, '.xxx'))
    then 'block' else 'allow' end) as verdict
from judged
"""
