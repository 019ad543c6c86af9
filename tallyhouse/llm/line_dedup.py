"""Line dedup: chunks of lines that are repeated anywhere in the corpus are removed.

A rolling hash over the hashes of `SPAN` adjoining lines chooses the chunk
boundaries, so they follow from content and survive a shift: two documents that
share a run of lines cut it at the same places. A line ends a chunk if its
rolling hash says so and that of the line before does not, so a chunk has two
lines or more, unless the text has one line. A chunk of several lines that also
lies at an earlier place, by (id, position), is removed; the first copy stays.
Chunks are found by hash and removed only after SHA-256 of their bytes agrees.

A chunk mixes the ends of a passage with its neighbours, so with `passage_words`
the lines of every run of two lines or more and over so many words that lies
contiguously at an earlier place are removed as well. From each line, forwards and
backwards, the shortest such run is a window; every line of a repeated run lies in
a window that lies wholly within the run, so to compare windows is enough, and what
is found does not depend on any boundary. A line without words counts as one word.

Only DataFrame functions are used. Ids order the documents, null after all
others. Repeated rows of one id are one document, and each comes back with the
same text; different texts of one id are ordered by their digest. Null and empty texts come back as they are; a text that loses all its
lines becomes empty. Other columns are carried along and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import fresh, stored

SPAN = 2
# The rolling hash chooses one line in so many; chunks have four or five lines on average.
EVERY = 3
LEAST_LINES = 2
# A repeated run of lines in the queries has more words than this.
PASSAGE_WORDS = 50

# Rolling hash: base and modulus of a polynomial, below 2^31 so that products fit a bigint.
_BASE = 1_000_003
_MODULUS = 2_147_483_647


def _chosen(hashes: Column) -> Column:
    """For each line whether the rolling hash that ends there chooses it."""

    def rolled(i: Column) -> Column:
        total = F.lit(0).cast("bigint")
        for back in reversed(range(SPAN)):
            value = F.pmod(F.coalesce(F.get(hashes, i - back), F.lit(0)), F.lit(_MODULUS))
            total = F.pmod(total * _BASE + value, F.lit(_MODULUS))
        return total

    return F.transform(hashes, lambda _, i: F.pmod(rolled(i), F.lit(EVERY)) == 0)


def _ends(chosen: Column) -> Column:
    """Index of the last line of each chunk; two lines at least lie before and after each cut."""
    last = F.size(chosen) - 1
    return F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == last)
        | (i.between(1, last - 2) & F.get(chosen, i) & ~F.get(chosen, i - 1)),
    )


def _start(ends: Column, i: Column) -> Column:
    return F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1) + 1)


def _cut(texts: DataFrame, text: Column) -> DataFrame:
    """`texts` with the lines of `text`, their hashes and the ends of its chunks; nulls for a null."""
    lines = texts.withColumn("lines", F.split(text, "\n", -1))
    hashed = lines.withColumn("hashes", F.transform("lines", lambda line: F.xxhash64(line)))
    chosen = hashed.withColumn("chosen", _chosen(F.col("hashes")))
    return chosen.withColumn("ends", _ends(F.col("chosen")))


def _weights(words: int) -> Column:
    """Words of each line, 1 at least; more than `words + 1` would not change a window."""
    blank = " \t\r\f\x0b"
    return F.transform(
        "lines",
        lambda line: F.least(
            F.size(F.split(F.btrim(line, F.lit(blank)), f"[{blank}]+")), F.lit(words + 1)
        ),
    )


def _reach(weights: Column, words: int) -> Column:
    """For each line, lines of the shortest window that begins there; 0 if there is none."""
    # Lines and words so far are one number: a window has at most 2 * (words + 1) words by then.
    unit, near = 4 * (words + 1), 4

    def done(total: Column) -> Column:
        return (total >= LEAST_LINES * unit) & (F.pmod(total, F.lit(unit)) > words)

    def further(part: Column, total: Column) -> Column:
        return F.aggregate(
            part, total, lambda so_far, n: F.when(done(so_far), so_far).otherwise(so_far + unit + n)
        )

    # Most windows end within a few lines, and none has more lines than words.
    few = F.transform(weights, lambda _, i: further(F.slice(weights, i + 1, near), F.lit(0)))
    all_of = F.transform(
        few,
        lambda total, i: F.when(done(total), total).otherwise(
            further(F.slice(weights, i + 1 + near, words + LEAST_LINES), total)
        ),
    )
    return F.transform(all_of, lambda total: F.when(done(total), F.floor(total / unit)).otherwise(0))


# A span of lines is one bigint, its first line and its length, as sets of numbers are hashed.
_LENGTH_BITS = 31


def _span(start: Column, n: Column) -> Column:
    return F.shiftleft(start.cast("bigint"), _LENGTH_BITS) + n.cast("bigint")


def _first_line(span: Column) -> Column:
    return F.shiftright(span, _LENGTH_BITS).cast("int")


def _length(span: Column) -> Column:
    return span.bitwiseAND(F.lit((1 << _LENGTH_BITS) - 1)).cast("int")


def _of(array: str, span: Column) -> Column:
    """The part of `array` that lies in the span."""
    return F.slice(F.col(array), _first_line(span) + 1, _length(span))


def _spans(texts: DataFrame, passage_words: int | None) -> DataFrame:
    """`texts` (with lines and ends of chunks) with the spans of chunks and windows, each once."""
    ends = F.col("ends")
    spans = F.transform(
        F.sequence(F.lit(0), F.size(ends) - 1),
        lambda i: _span(_start(ends, i), F.get(ends, i) - _start(ends, i) + 1),
    )
    if passage_words is not None:
        texts = texts.withColumn("weights", _weights(passage_words))
        texts = texts.withColumn("behind", F.reverse("weights"))
        texts = texts.withColumn("forwards", _reach(F.col("weights"), passage_words))
        texts = texts.withColumn("backwards", F.reverse(_reach(F.col("behind"), passage_words)))
        spans = F.concat(
            spans,
            F.transform("forwards", lambda n, i: _span(i, n)),
            F.transform("backwards", lambda n, i: _span(F.when(n > 0, i + 1 - n).otherwise(0), n)),
        )
    distinct = F.array_distinct(spans)
    return texts.withColumn("spans", F.filter(distinct, lambda span: _length(span) >= LEAST_LINES))


def _same(a: str, b: str) -> Column:
    return (F.col(f"a.{a}").eqNullSafe(F.col(f"b.{b}")))


def removed_lines(texts: DataFrame, passage_words: int | None = None) -> DataFrame:
    """Of `texts` (id, text): id, digest of the text, and the spans of lines to remove.

    Each step goes to the shared folder: places and hashes of all spans; hashes found twice; the
    SHA-256 of spans with such a hash, which are then compared. A span that a large part of the
    documents share is reduced in each task before it is shuffled, and the joins on hashes read
    stored tables on both sides, so Spark can split such a key. Of a span whose copies overlap
    in one text only those after the end of the first are removed.
    """
    keyed = texts.where("text IS NOT NULL").select("id", "text", F.xxhash64("text").alias("digest"))
    placed = _spans(_cut(keyed, F.col("text")), passage_words).select(
        "id", "digest",
        F.explode(F.transform("spans", lambda span: F.struct(
            span.alias("span"), F.xxhash64(_of("hashes", span)).alias("hash")
        ))).alias("place"),
    )
    places = stored(placed.select("id", "digest", "place.*"), "span-places")
    twice = stored(
        places.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"),
        "span-hashes",
    )
    wanted = (
        places.join(twice, "hash").groupBy("id", "digest")
        .agg(F.collect_set("span").alias("wanted"))
    )
    within = keyed.alias("a").join(
        wanted.alias("b"), _same("id", "id") & (F.col("a.digest") == F.col("b.digest"))
    ).select("a.id", "a.digest", F.split("a.text", "\n", -1).alias("lines"), "b.wanted")
    digests = F.transform("wanted", lambda span: F.struct(
        span.alias("span"), F.unhex(F.sha2(F.array_join(_of("lines", span), "\n"), 256)).alias("sha")
    ))
    suspects = stored(
        within.select("id", "digest", F.explode(digests).alias("found"))
        .select("id", "digest", "found.*"),
        "span-digests",
    )
    place = F.struct(F.col("id").isNull().alias("last"), "id", "digest", "span")
    firsts = stored(
        suspects.groupBy("sha").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("sha", "first"),
        "first-spans",
    )
    elsewhere = ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest")))
    after = _first_line(F.col("span")) >= _first_line(F.col("first.span")) + _length(F.col("span"))
    return (
        suspects.join(firsts, "sha").where(elsewhere | after)
        .groupBy("id", "digest").agg(F.collect_set("span").alias("removed"))
    )


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    counts: tuple[str, str] | None = None, passage_words: int | None = None,
) -> DataFrame:
    """`docs` with repeated chunks of lines, and repeated passages, taken out of `text_column`.

    `passage_words` is what a passage must exceed; without it only whole chunks are looked for.
    `counts` names two columns to add: the lines of a text and how many were removed.
    """
    removed = removed_lines(
        docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), passage_words
    )
    # The columns of `docs` travel as one struct, so that no name of theirs can clash.
    row = docs.select(F.struct("*").alias("row"))
    whole = row.select(
        "row", F.col("row")[id_column].alias("id"), F.xxhash64(F.col("row")[text_column]).alias("digest")
    )
    joined = whole.alias("a").join(
        removed.alias("b"), _same("id", "id") & (F.col("a.digest") == F.col("b.digest")), "left"
    ).select("row", "removed", F.col("row")[text_column].alias("text"))
    # Only texts that lose something are cut again.
    changed = F.when(F.col("removed").isNotNull(), F.col("text"))
    cut = joined.withColumn("lines", F.split(changed, "\n", -1))
    gone = F.flatten(F.transform("removed", lambda span: F.sequence(
        _first_line(span), _first_line(span) + _length(span) - 1
    )))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    left = F.transform(kept, lambda i: F.get("lines", i))
    rows = cut.withColumn("left", F.when(F.col("removed").isNotNull(), left))
    columns = [
        F.coalesce(F.array_join("left", "\n"), F.col("text")).alias(name) if name == text_column
        else F.col("row")[name].alias(name)
        for name in docs.columns
    ]
    measures = [
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)),
        F.coalesce(F.size("lines") - F.size("left"), F.lit(0)),
    ]
    added = [m.cast("bigint").alias(name) for m, name in zip(measures, counts or ())]
    return rows.select(*columns, *added)
