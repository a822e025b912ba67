"""Quality rules by weak supervision, with DataFrame functions only.

Rules vote for (1) or against (-1) a document or abstain (0). How often each pattern of votes occurs is
counted over all documents; there are at most 3 to the number of rules patterns, whatever the input.
Expectation-maximisation over these counts estimates each rule's accuracy on good documents (its votes
are for), its accuracy on bad ones (against) and the share of good documents, in one SQL expression. A
document's quality is the posterior probability of its pattern; it is kept from ``KEEP`` on.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. Windows of three words are found by hashes and compared
word by word.

Defined results: null and empty texts have no words and fail the base rules; with an empty table there are no
rows; repeated rows are judged (and counted) each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

# characters, as in a bracket of a regular expression
SYMBOLS = r"#*$%&|<>"
#: ASCII punctuation
PUNCTUATION = r"!-/:-@\[-`{-~"
BLANKS = r"\x20\x09-\x0D"
NOT_BLANK = r"[^\x20\x09-\x0D]"
#: bits for a window's place in its text, and in a text with more windows; the other bits are for its hash
PLACE_BITS, MOST_BITS = 24, 31
#: bits of a window's hash that are used; the result is the same with any
HASH_MASK = -1
ROUNDS = 20
KEEP = 0.5
#: starting values and limits of the estimates
FIRST_GOOD, FIRST_BAD = 0.98, 0.4
LEAST_GOOD, LEAST_BAD, MOST = 0.98, 0.1, 0.999
FIRST_SHARE = 0.8

#: name, condition of a vote for, condition of a vote against (SQL over the measures)
RULES = (
    ("words", "n_words >= 50", "n_words < 10"),
    ("word_length", "word_chars between 3 * n_words and 7 * n_words", "word_chars < 2 * n_words or word_chars > 9 * n_words"),
    ("symbols", "100 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    ("lines", "n_dup_lines = 0", "4 * n_dup_lines > n_lines"),
    ("repeats", "10 * n_repeat_words <= n_words", "3 * n_repeat_words > n_words"),
    ("capitals", "20 * n_capitals <= word_chars", "2 * n_capitals > word_chars"),
    ("punctuation", "100 * n_punct <= 6 * word_chars", "100 * n_punct > 10 * word_chars"),
    ("marks", "50 * n_marks <= n_words", "5 * n_marks > n_words"),
)


def _hashed(words: Column, i: Column) -> Column:
    whole = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    return whole if HASH_MASK == -1 else whole.bitwiseAND(F.lit(HASH_MASK))


def _covered(places: Column) -> Column:
    """Words in the 3-word windows that start at the given places, which are in order."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )


def _by_words(words: Column) -> Column:
    """Words in windows that occur twice or more, from the windows ordered by their words."""
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(3)], i.alias("i")),
        )
    )

    def again(all_: Column) -> Column:
        def same(x: Column, other: Column) -> Column:
            return F.coalesce((x["w0"] == other["w0"]) & (x["w1"] == other["w1"]) & (x["w2"] == other["w2"]), F.lit(False))

        kept = F.filter(all_, lambda x, j: same(x, F.get(all_, j + 1)) | same(x, F.get(all_, j - 1)))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    # the ordered array is worked out once, as the only element of an array
    return F.transform(F.array(windows), lambda all_: _covered(again(all_)))[0]


def _repeat_words(words: Column, ordered: Column, bits: int) -> Column:
    """Words in 3-word windows that occur twice or more, from the windows as :func:`_windows` has them.

    Where two different windows have one hash, the text's windows are ordered by their words instead."""
    hashed = F.shiftrightunsigned
    mask = F.lit((1 << bits) - 1)

    def collides(x: Column, i: Column) -> Column:
        other = F.get(ordered, i + 1)
        here, there = x.bitwiseAND(mask).cast("int"), other.bitwiseAND(mask).cast("int")
        equal = [F.get(words, here + k) == F.get(words, there + k) for k in range(3)]
        return F.coalesce((hashed(x, bits) == hashed(other, bits)) & ~(equal[0] & equal[1] & equal[2]), F.lit(False))

    def again(x: Column, i: Column) -> Column:
        """Equal hashes stand side by side; the words decide."""
        here = x.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

        def same(other: Column) -> Column:
            there = other.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
            equal = [F.get(words, here + k) == F.get(words, there + k) for k in range(3)]
            return (hashed(x, bits) == hashed(other, bits)) & equal[0] & equal[1] & equal[2]

        nothing = F.lit(False)
        return F.coalesce(same(F.get(ordered, i + 1)), nothing) | F.coalesce(same(F.get(ordered, i - 1)), nothing)

    places = F.sort_array(F.transform(F.filter(ordered, again), lambda x: x.bitwiseAND(mask).cast("int")))
    clash = F.size(F.filter(ordered, collides)) > 0
    return F.when(clash, _by_words(words)).otherwise(_covered(places))


def _windows(words: Column, bits: int) -> Column:
    """Hash (upper bits) and place (lower bits) of each 3-word window, ordered."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.shiftleft(_hashed(words, i), bits).bitwiseOR(
            i.cast("bigint")
        ),
    )
    return F.sort_array(hashes)


def _by_length(few: Column, many: Column, none: Column) -> Column:
    n = F.size("words") - 2
    return F.when(n < 2, none).when(n <= 1 << PLACE_BITS, few).otherwise(many)


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id and what the rules look at."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    rows = rows.select(
        "id",
        "text",
        F.array_remove(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK)).alias("lines"),
    )
    words, windows = F.col("words"), F.col("windows")
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("windows", _by_length(_windows(words, PLACE_BITS), _windows(words, MOST_BITS), none))

    def count(characters: str) -> Column:
        return F.regexp_count(text, F.lit(f"[{characters}]")).cast("bigint")

    return rows.select(
        "id",
        F.size("words").cast("bigint").alias("n_words"),
        (F.length(text) - count(BLANKS)).alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _by_length(
            _repeat_words(words, windows, PLACE_BITS), _repeat_words(words, windows, MOST_BITS), F.lit(0).cast("bigint")
        ).alias("n_repeat_words"),
        count("A-Z").alias("n_capitals"),
        count(PUNCTUATION).alias("n_punct"),
        count("!").alias("n_marks"),
    )


def votes(rules=RULES) -> list[Column]:
    return [
        F.when(F.expr(good), 1).when(F.expr(bad), -1).otherwise(0).cast("int").alias(f"vote_{name}") for name, good, bad in rules
    ]


def posterior(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> DataFrame:
    """Adds ``quality`` to distinct vote patterns with their count ``n``.

    All patterns are one array of one row (of bounded size); a round computes every pattern's posterior
    from the estimates and then the estimates from the posteriors.
    """
    k = len(names)
    one = patterns.groupBy().agg(
        F.sort_array(F.collect_list(F.struct(F.array(*names).alias("v"), F.col("n").cast("double").alias("n")))).alias("all")
    )
    every = F.col("all")
    first = F.struct(
        F.lit(FIRST_SHARE).alias("share"),
        F.array(*[F.lit(FIRST_GOOD)] * k).alias("good"),
        F.array(*[F.lit(FIRST_BAD)] * k).alias("bad"),
    )

    def quality(state: Column, v: Column) -> Column:
        log_odds = F.log(state["share"] / (1 - state["share"]))
        for j in range(k):
            good, bad = state["good"][j], state["bad"][j]
            log_odds = log_odds + F.when(v[j] == 1, F.log(good / (1 - bad))).when(
                v[j] == -1, F.log((1 - good) / bad)
            ).otherwise(0.0)
        return 1 / (1 + F.exp(-log_odds))

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda s, r: s + value(r))

    def improved(state: Column, _: Column) -> Column:
        rated = F.transform(
            every, lambda p: F.struct(p["v"].alias("v"), p["n"].alias("n"), quality(state, p["v"]).alias("q"))
        )

        def estimates(rows: Column) -> Column:
            share = (total(rows, lambda r: r["n"] * r["q"]) + 1) / (total(rows, lambda r: r["n"]) + 2)

            def accuracy(j: int, of, vote: int, first: float, least: float) -> Column:
                right = total(rows, lambda r: F.when(r["v"][j] == vote, of(r)).otherwise(0.0))
                cast = total(rows, lambda r: F.when(r["v"][j] != 0, of(r)).otherwise(0.0))
                return F.greatest(F.lit(least), F.least(F.lit(MOST), (right + 2 * first) / (cast + 2)))

            good = [accuracy(j, lambda r: r["n"] * r["q"], 1, FIRST_GOOD, LEAST_GOOD) for j in range(k)]
            bad = [accuracy(j, lambda r: r["n"] * (1 - r["q"]), -1, FIRST_BAD, LEAST_BAD) for j in range(k)]
            limited = F.greatest(F.lit(0.01), F.least(F.lit(0.99), share))
            return F.struct(limited.alias("share"), F.array(*good).alias("good"), F.array(*bad).alias("bad"))

        return F.element_at(F.transform(F.array(rated), estimates), 1)

    fitted = one.select("all", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, improved).alias("state"))
    rated = fitted.select("state", F.explode("all").alias("p"))
    return rated.select(
        *[F.col("p")["v"][j].alias(n) for j, n in enumerate(names)],
        F.round(quality(F.col("state"), F.col("p")["v"]), 6).alias("quality"),
    )


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row: id, measures, votes, quality, base_failed, kept."""
    measured = written(measures(df, id_col, text_col).select("*", *votes(rules)), "quality")
    names = [f"vote_{name}" for name, _, _ in rules]
    patterns = measured.groupBy(*names).agg(F.count("*").alias("n"))
    rated = F.broadcast(posterior(patterns, names, rounds))  # at most 3 ** len(rules) rows
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return measured.join(rated, names).select(
        F.col("id").alias(id_col),
        *[c for c in measured.columns if c not in ("id", *names)],
        *names,
        "quality",
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= KEEP)).alias("kept"),
    )


def sql(rules=RULES, rounds: int = ROUNDS) -> str:
    """The same for DuckDB, one pair of tables for each round."""
    k = range(len(rules))
    case = ",\n".join(
        f"CASE WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END AS v{j}" for j, (_, good, bad) in enumerate(rules)
    )
    vs = ", ".join(f"v{j}" for j in k)
    log_odds = "ln(share / (1 - share))" + "".join(
        f" + CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in k
    )
    quality = f"1 / (1 + exp(-({log_odds})))"
    start = ", ".join(f"{FIRST_GOOD}::DOUBLE AS g{j}, {FIRST_BAD}::DOUBLE AS b{j}" for j in k)
    steps = [f"e0 AS (SELECT {FIRST_SHARE}::DOUBLE AS share, {start})"]

    def accuracy(j: int, name: str, of: str, vote: int, first: float, least: float) -> str:
        right, cast = (f"sum(CASE WHEN v{j} {test} THEN {of} ELSE 0 END)" for test in (f"= {vote}", "<> 0"))
        return f"greatest({least}, least({MOST}, ({right} + {2 * first}) / ({cast} + 2)))::DOUBLE AS {name}{j}"

    for r in range(1, rounds + 1):
        accuracies = ", ".join(
            accuracy(j, "g", "n * q", 1, FIRST_GOOD, LEAST_GOOD) + ", " + accuracy(j, "b", "n * (1 - q)", -1, FIRST_BAD, LEAST_BAD)
            for j in k
        )
        steps.append(
            f"e{r} AS MATERIALIZED (SELECT greatest(0.01, least(0.99, (sum(n * q) + 1) / (sum(n) + 2)))::DOUBLE AS share, {accuracies}"
            f" FROM (SELECT *, {quality} AS q FROM pat, e{r - 1}))"
        )
    names = ", ".join(f"v{j} AS vote_{name}" for j, (name, _, _) in enumerate(rules))
    gone = lambda text, chars: f"length(regexp_replace({text}, '[{chars}]', '', 'g'))"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), tri AS (
  SELECT row, i, array_to_string(words[i : i + 2], ' ') AS t FROM d, unnest(range(1, len(words) - 1)) AS u(i)
), rep AS (
  SELECT row, count(DISTINCT i + o) AS n_repeat_words
  FROM (SELECT row, i FROM tri QUALIFY count(*) OVER (PARTITION BY row, t) > 1), (VALUES (0), (1), (2)) AS k(o)
  GROUP BY row
), m AS (
  SELECT row, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST({gone('text', BLANKS)} AS BIGINT) AS word_chars,
         CAST(length(text) - {gone('text', SYMBOLS)} AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(length(text) - {gone('text', 'A-Z')} AS BIGINT) AS n_capitals,
         CAST(length(text) - {gone('text', PUNCTUATION)} AS BIGINT) AS n_punct,
         CAST(length(text) - {gone('text', '!')} AS BIGINT) AS n_marks
  FROM d LEFT JOIN rep USING (row)
), vot AS MATERIALIZED (
  SELECT *, {case} FROM m
), pat AS MATERIALIZED (
  SELECT {vs}, CAST(count(*) AS DOUBLE) AS n FROM vot GROUP BY ALL
), {', '.join(steps)}
, f AS (
  SELECT *, round({quality}, 6) AS quality, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM vot, e{rounds}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, n_punct, n_marks, {names},
       quality, base_failed, NOT base_failed AND quality >= {KEEP} AS kept
FROM f"""
