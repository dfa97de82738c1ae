"""URL filtering by site rules and by association rules mined from labelled URLs.

A URL is a set of tokens: its scheme, the domains it lies in, and the words of host, path, query and fragment,
each marked with the part it is from. Spark's FP-growth finds the combinations of tokens that are frequent
together with a bad label; those that are bad often enough become rules. A rule that says no more than a shorter
one goes. Rules are kept in an inverted index from token to rules, and a URL is blocked if it holds all tokens of one.

Site rules, given by hand, come first: of those whose host is the URL's or a domain above it, and whose path
starts the URL's, the longest one decides.

Tokens that stand in the same URLs are one. FP-growth lists every combination, which doubles with each token of a
URL; where URLs hold more tokens than it can take, or it finds too many rules, combinations grow by a token at a time
instead, and only those go on that can lead to a rule that says more than a shorter one. Both ways give the same
rules, and neither leaves any out. Matching takes all tokens of every URL.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.session import fresh_path, scratch

# Least share of all labelled URLs, and least number, that are bad and hold a rule's tokens.
MIN_SUPPORT, MIN_COUNT = 0.001, 10
# Least share of bad ones among the labelled URLs that hold them.
MIN_CONFIDENCE = 0.6
# Frequent tokens of a URL and rules up to which FP-growth is used; beyond, combinations are grown token by token.
MAX_ITEMS, MAX_RULES = 16, 20_000

BLOCK, ALLOW = "block", "allow"
_BAD = -1  # tokens are numbered from 0
_WORD = re.compile(r"[^\W_]+")
_SMALL = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class SiteRule:
    """A verdict on a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TokenRule:
    """Tokens that are bad together, the share of bad URLs among those with all of them, and of all URLs that are such."""

    tokens: frozenset[str]
    confidence: float
    support: float


def parts(url: str | None) -> tuple[str, str, str]:
    """Host, path, and what follows the path; all empty without a ``://``."""
    _, mark, rest = (url or "").partition("://")
    end = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    host, rest = rest[:end].translate(_SMALL), rest[end:]
    end = min((at for at in map(rest.find, "?#") if at >= 0), default=len(rest))
    return (host, rest[:end], rest[end:]) if mark else ("", "", "")


def domains(host: str, longest: int | None = None) -> Iterator[str]:
    """The host and the domains above it, shortest first; none beyond ``longest`` characters."""
    at = len(host)
    while host and at >= 0:
        at = host.rfind(".", 0, at)
        if longest is not None and len(host) - at - 1 > longest:
            return
        yield host[at + 1 :]


def tokens(url: str | None) -> set[str]:
    """The tokens of a whole URL; none without a ``://``."""
    host, path, rest = parts(url)
    if not url or "://" not in url:
        return set()
    query, _, fragment = rest.partition("#")
    found = {f"scheme:{url.partition('://')[0].lower()}"}
    labels = host.split(".")
    # A domain by its last labels: what lies deeper is told by the words.
    found.update(f"domain:{'.'.join(labels[-n:])}" for n in range(1, min(4, len(labels)) + 1) if host)
    for part, text in (("host", host), ("path", path), ("query", query), ("fragment", fragment)):
        found.update(f"{part}:{word}" for word in _WORD.findall(text.lower()))
    found.update(f"pair:{pair}" for pair in query[1:].lower().split("&") if pair)
    return found


class SiteRules:
    """Site rules by host."""

    def __init__(self, rules: Iterable[SiteRule]):
        self.by_host: dict[str, list[SiteRule]] = defaultdict(list)
        for rule in rules:
            self.by_host[rule.host].append(rule)
        self.longest = max(map(len, self.by_host), default=-1)

    def fitting(self, host: str, path: str) -> SiteRule | None:
        """The longest rule that fits; of two verdicts on the same name, to block."""
        fits = (
            rule for domain in domains(host, self.longest) for rule in self.by_host.get(domain, ()) if path.startswith(rule.path)
        )
        return max(fits, key=lambda rule: (len(rule.name), rule.verdict == BLOCK), default=None)


class TokenRules:
    """Token rules by token: an inverted index."""

    def __init__(self, rules: Iterable[TokenRule] = ()):
        self.rules: list[TokenRule] = []
        self.by_token: dict[str, list[int]] = defaultdict(list)
        for rule in rules:
            self.add(rule)

    def add(self, rule: TokenRule) -> None:
        for token in rule.tokens:
            self.by_token[token].append(len(self.rules))
        self.rules.append(rule)

    def matching(self, own: Iterable[str]) -> list[TokenRule]:
        """The rules all of whose tokens are among ``own`` (distinct)."""
        hits = Counter(number for token in own for number in self.by_token.get(token, ()))
        return [self.rules[number] for number, n in hits.items() if n == len(self.rules[number].tokens)]


def shortest(rules: Iterable[TokenRule]) -> list[TokenRule]:
    """Without the rules that hold all tokens of another one at least as confident."""
    kept = TokenRules()
    for rule in sorted(rules, key=lambda r: (len(r.tokens), -r.confidence, sorted(r.tokens))):
        if not any(other.confidence >= rule.confidence for other in kept.matching(rule.tokens)):
            kept.add(rule)
    return kept.rules


# --- mining -----------------------------------------------------------------------------


def _transactions(labelled: DataFrame) -> DataFrame:
    """url, bad and tokens of each labelled URL that has tokens."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([sorted(tokens(url)) for url in batch.column("url").to_pylist()], pa.list_(pa.string()))
            yield batch.append_column("tokens", found)

    rows = labelled.select(F.col("url").cast("string").alias("url"), F.col("bad").cast("boolean").alias("bad"))
    rows = rows.where(F.col("url").contains("://") & F.col("bad").isNotNull())
    return rows.mapInArrow(split, "url string, bad boolean, tokens array<string>")


def _ranked_tokens(split: DataFrame, least: int, share: float) -> list[str]:
    """Tokens of at least ``least`` bad URLs, greatest evidence first; of tokens that stand in the same URLs one.

    They are no more than the tokens of a URL divided by the support.
    """
    each = split.select(F.xxhash64("url").cast("decimal(38,0)").alias("row"), "bad", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.sum("row").alias("rows"))
    spread = F.sqrt(F.col("n") * F.lit(share * (1 - share)))
    evidence = F.abs(F.col("n_bad") - F.col("n") * F.lit(share)) / spread
    name = F.min(F.struct(F.length("token"), F.col("token").alias("token")))["token"]
    alike = counts.where(F.col("n_bad") >= least).groupBy("n", "n_bad", "rows").agg(name.alias("token"), F.first(evidence).alias("evidence"))
    return [row["token"] for row in alike.orderBy(F.desc("evidence"), "token").collect()]


def _by_level(picked: DataFrame, n: int, least: int, min_confidence: float) -> list[tuple[list[int], float, float]]:
    """Tokens, confidence and support of the rules of transactions (items, bad) that no shorter one makes needless, from combinations of 1, 2, ... tokens.

    A combination goes on if it is frequent with a bad label, holds some URL that isn't bad, and leaves fewer URLs
    than each of those with one token less, all of which went on: any longer one that doesn't is no more
    confident than a shorter one.
    """
    counts = (F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"))
    rows = picked.groupBy("items").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
    live = _written(rows.where(F.size("items") > 0), "transactions").withColumn("some", F.array().cast("array<int>"))
    found: list[tuple[list[int], float, float]] = []
    before = None
    while True:
        # A combination rises, so that it comes once; what is left of a row's tokens is all that it can grow by.
        following = F.transform(
            "items",
            lambda token, place: F.struct(
                F.concat("some", F.array(token)).alias("some"), F.slice("items", place + 2, F.size("items")).alias("items")
            ),
        )
        grown = live.select("n", "n_bad", F.explode(following).alias("next")).select("n", "n_bad", "next.some", "next.items")
        frequent = _written(grown.groupBy("some").agg(*counts).where(F.col("n_bad") >= least), "combinations")
        if before is not None:
            shorter = frequent.select("some", "n", F.explode("some").alias("token")).select(
                "some", "n", F.array_remove("some", F.col("token")).alias("part")
            )
            fewer = shorter.join(before.select(F.col("some").alias("part"), F.col("n").alias("n_part")), "part")
            parts_left = fewer.where("n_part > n").groupBy("some").count().where(F.col("count") == F.size("some"))
            frequent = _written(frequent.join(parts_left.select("some"), "some"), "combinations")
        confidence = (F.col("n_bad") / F.col("n")).alias("confidence")
        rules = frequent.where(confidence >= min_confidence).select("some", confidence, (F.col("n_bad") / n).alias("support"))
        found += [tuple(row) for row in rules.collect()]
        before = _written(frequent.where("n_bad < n"), "combinations")
        if before.isEmpty():
            return found
        live = _written(grown.where(F.size("items") > 0).join(before.select("some"), "some"), "live")


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_count: int = MIN_COUNT,
    max_items: int = MAX_ITEMS,
) -> list[TokenRule]:
    """Rules from ``labelled`` (url, bad); none if no URL, or every one, is bad.

    Rows without a label, a URL or a ``://`` are passed over; repeated rows count each. ``max_items`` is the number
    of frequent tokens of a URL up to which FP-growth is used; the rules don't depend on it.
    """
    split = _transactions(labelled)
    n, n_bad = split.agg(F.count("*"), F.count_if("bad")).first()
    if not 0 < n_bad < n:
        return []
    least = max(min_count, math.ceil(min_support * n))
    rank = {token: at for at, token in enumerate(_ranked_tokens(split, least, n_bad / n))}
    known = labelled.sparkSession.sparkContext.broadcast(rank)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [sorted(known.value[t] for t in own if t in known.value) for own in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.int32())), batch.column("bad")], ["items", "bad"])

    def named(rules: Iterable[tuple[list[int], float, float]]) -> list[TokenRule]:
        names = list(rank)
        return shortest(TokenRule(frozenset(names[t] for t in some), confidence, support) for some, confidence, support in rules)

    picked = split.mapInArrow(pick, "items array<int>, bad boolean")
    if (picked.agg(F.max(F.size("items"))).first()[0] or 0) <= max_items:
        marked = picked.select(F.when(F.col("bad"), F.array_append("items", F.lit(_BAD))).otherwise(F.col("items")).alias("items"))
        # A support is compared as a share; half a row less keeps rounding from losing a rule at the limit.
        model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(marked)
        rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(_BAD))).limit(MAX_RULES + 1).collect()
        if len(rules) <= MAX_RULES:
            return named((row["antecedent"], row["confidence"], row["support"]) for row in rules)
    with scratch(labelled.sparkSession, "token-rules"):
        return named(_by_level(picked, n, least, min_confidence))


# --- judging ----------------------------------------------------------------------------

_JUDGED = "page_id bigint, host string, path string, rule string, verdict string, matched string, confidence double"


def judge(pages: DataFrame, site_rules: Iterable[SiteRule], token_rules: list[TokenRule]) -> DataFrame:
    """page_id, host, path, rule, verdict, and the most confident token rule of every page, one row for each.

    ``rule`` is the site rule that decides, null if none fits; then a page is blocked if a token rule matches.
    A URL that is null, empty or without ``://`` has an empty host and path and no tokens, and is allowed; very long
    ones are taken whole. Repeated rows are judged each, a null id stays null, other columns are ignored; an
    empty table gives an empty result.
    """
    sites, rules = list(site_rules), list(token_rules)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_site, by_token = SiteRules(sites), TokenRules(rules)
        for batch in batches:
            found = []
            for url in batch.column("url").to_pylist():
                host, path, _ = parts(url)
                site = by_site.fitting(host, path)
                best = max(by_token.matching(tokens(url)), key=lambda r: (r.confidence, sorted(r.tokens)), default=None)
                verdict = site.verdict if site else BLOCK if best else ALLOW
                matched = (" ".join(sorted(best.tokens)), best.confidence) if best else (None, None)
                found.append((host, path, site.name if site else None, verdict, *matched))
            columns = [pa.array([row[n] for row in found], pa.string()) for n in range(5)]
            columns.append(pa.array([row[5] for row in found], pa.float64()))
            names = ["page_id", "host", "path", "rule", "verdict", "matched", "confidence"]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *columns], names)

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.mapInArrow(decide, _JUDGED)


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url and bad of the pages whose path ends in the number of a labelled document: of low quality, or toxic."""
    number = F.regexp_extract(F.col("url").cast("string"), r"^[^?#]*/([0-9]{1,18})(?:\.[A-Za-z]+)?/?(?:[?#]|$)", 1)
    judged = labels.groupBy(F.col("doc_id").cast("bigint").alias("number")).agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    numbered = pages.select(F.col("url").cast("string").alias("url"), F.when(number != "", number).cast("bigint").alias("number"))
    return numbered.join(judged, "number").select("url", "bad")
