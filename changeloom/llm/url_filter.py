"""URL filter: host and path rules first, a weighted vocabulary for the rest.

The vocabulary is searched with an Aho-Corasick automaton; a term counts only where no ASCII
letter or digit stands on either side of it. One strict term blocks, and so do ``soft_limit``
different soft terms. The terms are two lists, or a table (term, strict) read by :func:`read_terms`.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, and is judged
by the vocabulary (null: allow). Repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host with subdomains, start of the path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
STRICT = ("casino", "escort", "hentai", "jackpot", "malware", "porn", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "bets", "bonus", "cheap", "dating", "deals", "free", "loan", "pills", "poker", "slots", "win")
SOFT_LIMIT = 2
#: terms of a table that are sent to every task, at most
MOST_TERMS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES, verdict: bool = False) -> Column:
    """The longest rule that fits, or its verdict; null where none does."""
    out = F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.lit(kind if verdict else name + start)).otherwise(out)
    return out


def read_terms(table: DataFrame, most: int = MOST_TERMS) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Strict and soft terms of a table (term, strict), A-Z lower-cased; a term that is both is strict.

    Null and empty terms are passed over, null in ``strict`` is soft. More than ``most`` different terms are an
    error: the automaton is built in every task.
    """
    term = F.translate(F.col("term").cast("string"), _UPPER, _LOWER)
    strict = F.coalesce(F.col("strict").cast("boolean"), F.lit(False))
    terms = table.select(term.alias("term"), strict.alias("strict")).where("term <> ''")
    rows = terms.groupBy("term").agg(F.max("strict").alias("strict")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} terms")
    return tuple(sorted(r.term for r in rows if r.strict)), tuple(sorted(r.term for r in rows if not r.strict))


def _counter(strict: Sequence[str], soft: Sequence[str]):
    """Task code: adds the numbers of different strict and soft terms of each url."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = ahocorasick.Automaton()
        for term in (*strict, *soft):
            search.add_word(term, (len(term), term))
        if len(search):
            search.make_automaton()
        alnum = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        lower = str.maketrans(_UPPER, _LOWER)
        hard = frozenset(strict)
        for batch in batches:
            numbers: tuple[list[int], list[int]] = ([], [])
            for url in batch.column("url").to_pylist():
                found = set()
                text = (url or "").translate(lower)
                for last, (size, term) in search.iter(text) if len(search) else ():
                    begin = last - size + 1
                    if (begin == 0 or text[begin - 1] not in alnum) and (last + 1 == len(text) or text[last + 1] not in alnum):
                        found.add(term)
                numbers[0].append(len(found & hard))
                numbers[1].append(len(found - hard))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers[0], pa.int64()), pa.array(numbers[1], pa.int64())],
                names=["id", "url", "n_strict", "n_soft"],
            )

    return count


def filter_urls(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """One row per row: id, host, path, rule, n_strict, n_soft, verdict."""
    pages = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    kind = pages.schema["id"].dataType.simpleString()
    counted = pages.mapInArrow(_counter(tuple(strict), tuple(soft)), f"id {kind}, url string, n_strict long, n_soft long")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    by_terms = F.when((F.col("n_strict") > 0) | (F.col("n_soft") >= soft_limit), "block").otherwise("allow")
    return counted.select(
        F.col("id").alias(id_col),
        host.alias("host"),
        path.alias("path"),
        rule_of(host, path, rules).alias("rule"),
        "n_strict",
        "n_soft",
        F.coalesce(rule_of(host, path, rules, verdict=True), by_terms).alias("verdict"),
    )


def sql(rules=RULES, strict=STRICT, soft=SOFT, soft_limit=SOFT_LIMIT) -> str:
    """The same for DuckDB."""

    def case(verdict: bool) -> str:
        ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
        return "CASE " + " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v if verdict else h + p}'"
            for v, h, p in ordered
        ) + " END"

    def among(terms) -> str:
        inside = ", ".join(f"'{t}'" for t in terms)
        return f"len(list_filter(terms, lambda t: t IN ({inside})))"

    return f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
         list_distinct(string_split_regex(translate(url, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+')) AS terms
  FROM u
), q AS (
  SELECT *, {among(strict)} AS n_strict, {among(soft)} AS n_soft FROM p
)
SELECT page_id, host, path, {case(False)} AS rule, n_strict, n_soft,
       coalesce({case(True)}, CASE WHEN n_strict > 0 OR n_soft >= {soft_limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM q"""
