"""URL filters: rules by host and path, and for all other URLs a weighted vocabulary.

A rule names a host, with all its subdomains, and the beginning of a path; of the rules that fit the longest decides.
Where none fits, an Aho-Corasick automaton finds the vocabulary's terms in one pass over the lower-cased URL. A term
counts where no letter or digit adjoins it. Each distinct term adds its weight: one strict term is enough to
block, soft ones block together.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


class Term(NamedTuple):
    text: str
    strict: bool


#: Fixed values.
RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)
#: Words of adult, gambling, pharmacy, pirate and advertising pages.
STRICT_TERMS = (
    "porn", "porno", "xxx", "hentai", "escorts", "camgirls", "cheap-pills", "viagra", "cialis", "online-casino",
    "casino", "payday-loans", "warez", "keygen", "torrents", "malware", "phishing", "spam",
)
SOFT_TERMS = (
    "adult", "sex", "nude", "dating", "pills", "pharmacy", "cheap", "discount", "poker", "slots", "bet", "bets", "betting",
    "free", "loans", "bonus", "crack", "cracked", "free-download", "torrent", "ads", "track", "tracker", "banner", "popup",
    "click", "affiliate", "sponsored", "seo", "backlinks",
)
VOCABULARY = (*(Term(t, True) for t in STRICT_TERMS), *(Term(t, False) for t in SOFT_TERMS))
#: So many distinct soft terms weigh as much as a strict one.
SOFT_LIMIT = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = frozenset(_LOWER + "0123456789")


def lower_case(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; '' without one."""
    return lower_case(F.regexp_extract(_after_scheme(url), "^[^/?#]*+", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*+([^?#]*+)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """struct<rule, verdict> of the longest fitting rule; of equally long ones the first counts. NULL without one."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.host) - len(r.path))):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        found = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, found).otherwise(out)
    return out


def automaton(vocabulary: Sequence[Term]):
    """Aho-Corasick automaton whose values are the numbers of the terms; built in the task that uses it."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for number, term in enumerate(vocabulary):
        made.add_word(term.text, number)
    made.make_automaton()
    return made


def found_terms(url: str, machine, vocabulary: Sequence[Term]) -> dict[int, int]:
    """How often each term stands in a lower-cased URL with no letter or digit beside it."""
    counts: dict[int, int] = {}
    for last, number in machine.iter(url):
        first = last + 1 - len(vocabulary[number].text)
        if (first == 0 or url[first - 1] not in _WORD) and (last + 1 == len(url) or url[last + 1] not in _WORD):
            counts[number] = counts.get(number, 0) + 1
    return counts


def term_hits(url: Column, vocabulary: Sequence[Term] = VOCABULARY) -> Column:
    """struct<n_strict, n_soft, n_hits, terms>: distinct strict and soft terms, places of all, and the terms, sorted.

    A NULL URL is an empty one.
    """
    if not vocabulary:
        return F.struct(*(F.lit(0).cast("long").alias(c) for c in ("n_strict", "n_soft", "n_hits")), F.lit("").alias("terms"))
    kind = pa.struct([("n_strict", pa.int64()), ("n_soft", pa.int64()), ("n_hits", pa.int64()), ("terms", pa.string())])
    terms = [Term(t.text.translate(str.maketrans(_UPPER, _LOWER)), t.strict) for t in vocabulary]
    machines = []  # one per worker process

    @F.arrow_udf("struct<n_strict: long, n_soft: long, n_hits: long, terms: string>")
    def hits(urls: pa.Array) -> pa.Array:
        if not machines:
            machines.append(automaton(terms))
        rows = []
        for text in urls.to_pylist():
            counts = found_terms(text, machines[0], terms) if text else {}
            strict = sum(terms[k].strict for k in counts)
            rows.append({"n_strict": strict, "n_soft": len(counts) - strict, "n_hits": sum(counts.values()),
                         "terms": ",".join(sorted(terms[k].text for k in counts))})
        return pa.array(rows, kind)

    return hits(lower_case(url))


def judge(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[Rule] = RULES,
    vocabulary: Sequence[Term] = VOCABULARY, soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """One row per row: ``key``, host, path, rule, verdict, and the terms found.

    A null or empty URL, or one without ``://``, has an empty host and path, meets no rule, and its terms count. URLs of
    any length are read whole; repeated rows and null keys are rows like all others; columns besides the two are not used.
    """
    address = F.col(url)
    parts = pages.select(key, address, host_of(address).alias("host"), path_of(address).alias("path"))
    ruled = parts.select(
        key, "host", "path", fitting_rule(F.col("host"), F.col("path"), rules).alias("fitting"),
        term_hits(address, vocabulary).alias("hits"))
    rejected = (F.col("hits.n_strict") > 0) | (F.col("hits.n_soft") >= soft_limit)
    return ruled.select(
        key, "host", "path", F.col("fitting.rule").alias("rule"),
        F.coalesce("fitting.verdict", F.when(rejected, BLOCK).otherwise(ALLOW)).alias("verdict"),
        *(F.col(f"hits.{name}").alias(name) for name in ("n_strict", "n_soft", "n_hits", "terms")),
    )
