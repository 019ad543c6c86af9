"""Quality rules: a table of thresholds compiled into one projection.

A rule names a ratio of measures and the range it must lie in; `verdict` turns the
table into one expression. Everything is built-in functions, so a whole text is
measured inside the JVM and no row moves.

Words are runs of anything but ASCII white space. A null or empty text has no
words: all measures are nought, the base check fails and it is not kept. Repeated
rows are judged each. Other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACES = "[\\x20\\x09-\\x0D]+"
_WORD = "[^\\x20\\x09-\\x0D]"
_SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

# Common short words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is it that for on with as was be this are by at from or an a "
    "der die das und ist nicht ein eine zu mit von den dem auf für im sich des als auch "
    "le la les de du des et est un une que qui dans pour sur pas par avec au en il elle ou "
    "el los las y en un una que es se no por con para del lo su al más como"
).split()


class Rule(NamedTuple):
    """`measure` per `per` must lie from `least` to `most`."""

    name: str
    measure: str
    per: str
    least: float
    most: float


# The thresholds.
RULES = [
    Rule("mean word length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols per word", "n_symbols", "n_words", 0.0, 0.1),
    Rule("stop words per word", "n_stop_words", "n_words", 0.05, 1.0),
    Rule("exclamations per word", "n_exclamations", "n_words", 0.0, 0.2),
    Rule("repeated lines per line", "n_dup_lines", "n_lines", 0.0, 0.5),
]


def _repeated(hashes: Column) -> tuple:
    """Words within windows found twice or more; `hashes` has the window that each word begins.

    Windows are ordered by hash, so that equal ones adjoin; then, in order of place, each
    repeated window counts the words that the one before it does not have.
    """
    by_hash = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))
    )

    def repeated(ordered: Column) -> Column:
        def alike(i: Column) -> Column:
            here = F.get(ordered, i)["h"]
            return (here == F.get(ordered, i - 1)["h"]) | (here == F.get(ordered, i + 1)["h"])

        return F.sort_array(
            F.transform(
                F.filter(
                    F.sequence(F.lit(0), F.size(ordered) - 1),
                    lambda i: F.coalesce(alike(i), F.lit(False)),
                ),
                lambda i: F.get(ordered, i)["i"],
            )
        )

    def words(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda state, i: F.struct(
                i.alias("last"), (state["n"] + F.least(F.lit(WINDOW), i - state["last"])).alias("n")
            ),
            lambda state: state["n"],
        )

    return by_hash, repeated, words


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and the measures of each row's text, all of them counts.

    Each array gets a column before it is used, so it is made once a row. Windows are told
    apart by 64-bit hash within their text.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    split = rows.select(
        "id", "text", F.array_remove(F.split("text", _SPACES), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.rlike(line, F.lit(_WORD))).alias("lines"),
    )
    hashed = split.select(
        "id",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(_SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.regexp_count("text", F.lit("!")).cast("bigint").alias("n_exclamations"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("words", lambda word: word.isin(STOP_WORDS))).cast("bigint")
        .alias("n_stop_words"),
        F.transform(
            F.slice("words", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))),
            lambda word, i: F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2)),
        ).alias("windows"),
    )
    # Few texts have a window twice; only theirs are ordered.
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    by_hash, repeated, words = _repeated(F.col("windows"))
    ordered = hashed.withColumn("ordered", F.when(some, by_hash))
    places = ordered.withColumn("places", F.when(F.col("ordered").isNotNull(), repeated(F.col("ordered"))))
    return places.select(
        "id", "n_words", "word_chars", "n_symbols", "n_exclamations", "n_lines", "n_dup_lines",
        "n_stop_words",
        F.when(F.col("places").isNull(), F.lit(0)).otherwise(words(F.col("places")))
        .cast("bigint").alias("n_repeat_words"),
    )


def verdict(rules: list[Rule] = RULES) -> Column:
    """True where every rule holds; a ratio to nought holds."""
    kept = F.lit(True)
    for rule in rules:
        ratio = F.col(rule.measure) / F.nullif(F.col(rule.per), F.lit(0))
        kept = kept & F.coalesce(ratio.between(rule.least, rule.most), F.lit(True))
    return kept


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    rules: list[Rule] = RULES,
) -> DataFrame:
    """id, the base measures, base_failed and kept."""
    return measured(docs, id_column, text_column).select(
        F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )


def sql(documents: str = "documents", rules: list[Rule] = RULES) -> str:
    """The same judgement in plain SQL."""
    words = ", ".join(f"'{word}'" for word in dict.fromkeys(STOP_WORDS))
    verdicts = " AND ".join(
        f"coalesce(m.{rule.measure} / nullif(m.{rule.per}, 0) BETWEEN {rule.least} AND {rule.most}, true)"
        for rule in rules
    )
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM {documents}),
    w AS (
        SELECT doc_id, text,
               list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
               list_filter(string_split(text, chr(10)),
                           lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM t
    ),
    g AS (
        SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
    ),
    r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
    c AS (
        SELECT doc_id, count(DISTINCT place) AS n
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM r WHERE n > 1) GROUP BY doc_id
    ),
    m AS (
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclamations,
               CAST(len(lines) AS BIGINT) AS n_lines,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               CAST(len(list_filter(words, lambda x: x IN ({words}))) AS BIGINT) AS n_stop_words,
               CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
        FROM w LEFT JOIN c ON w.doc_id = c.doc_id
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {verdicts} AS kept
    FROM m
    """
