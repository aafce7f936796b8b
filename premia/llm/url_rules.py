"""URL filters: pattern rules found by their rarest literal token.

Every rule is a regular expression over ``host + path`` with the literal tokens that any matching URL must hold as
whole tokens. Rules are filed under the one of their tokens that is rarest among the URLs at hand; the tokens of a URL
fetch candidate rules, and only those are run. Rules without a literal token are candidates for every URL.

Nulls and URLs without ``://`` have empty host and path, fit no rule and get the default verdict. Repeated rows are
judged one by one. An empty table gives an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from premia.llm.common import LOWER, UPPER, ascii_lower, ship

ship(__name__)

MAX_RULE_CHARS = 64_000_000
TOKEN = r"[0-9a-z]+"


@dataclass(frozen=True)
class Rule:
    """``listed`` rules name themselves in the result and win over patterns; among them the longest name wins.

    ``folded`` rules are searched in the URL with A-Z in lower case, where its tokens are cut, others in the URL as it is.
    """

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    listed: bool = field(default=True)
    folded: bool = field(default=False)


def place_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and all its subdomains if the path starts with ``path``."""
    whole = re.findall(TOKEN, host.lower()) + re.findall(rf"(?<=[^0-9a-z]){TOKEN}(?=[^0-9a-z])", path.lower())
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(dict.fromkeys(whole)))


def word_rule(verdict: str, words: str) -> Rule:
    """Fits hosts and paths that hold the hyphenated words, in lower case or not, delimited on both sides."""
    return Rule(words, verdict, rf"(?:^|[^0-9a-z]){re.escape(words)}(?:[^0-9a-z]|$)", tuple(re.findall(TOKEN, words)), False, True)


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = "://([^/?#]*)([^?#]*)"
    return (
        ascii_lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))),
        F.coalesce(F.regexp_extract(url, pattern, 2), F.lit("")),
    )


_FOLD = str.maketrans(UPPER, LOWER)


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """URLs per token, for the tokens of the rules only: as many rows as the rules have tokens."""
    if not tokens:
        return {}
    found = F.array_distinct(F.regexp_extract_all(ascii_lower(F.concat("host", "path")), F.lit(TOKEN), F.lit(0)))
    wanted = urls.select(F.explode(F.array_intersect(found, F.array(*map(F.lit, sorted(tokens))))).alias("token"))
    return {r["token"]: r["count"] for r in wanted.groupBy("token").count().collect()}


def rule_index(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by rarest token, and those without a token. Ties go to the token that sorts first."""
    index: dict[str, list[int]] = {}
    always = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            always.append(i)
    return index, always


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule (null if no listed one fits), verdict. ``rules`` is a list in the caller's memory."""
    if sum(len(r.regex) + len(r.name) for r in rules) > MAX_RULE_CHARS:
        raise ValueError(f"rules hold more than {MAX_RULE_CHARS} characters; they are sent to every task")
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    index, always = rule_index(rules, token_counts(urls, {t for r in rules for t in r.tokens}))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled: dict[int, re.Pattern] = {}
        for batch in batches:
            names, verdicts = [], []
            for key in batch["host"] + batch["path"]:
                low = key.translate(_FOLD)
                near = always + [i for t in dict.fromkeys(re.findall(TOKEN, low)) for i in index.get(t, ())]
                best: Rule | None = None
                for i in near:
                    if i not in compiled:
                        compiled[i] = re.compile(rules[i].regex)
                    rule = rules[i]
                    order = (rule.listed, len(rule.name), rule.name)
                    if (best is None or order > (best.listed, len(best.name), best.name)) and compiled[i].search(low if rule.folded else key):
                        best = rule
                names.append(best.name if best and best.listed else None)
                verdicts.append(best.verdict if best else default)
            yield batch.assign(rule=pd.Series(names, dtype=object, index=batch.index), verdict=verdicts)

    kind = urls.schema[0].dataType.simpleString()
    return urls.mapInPandas(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
