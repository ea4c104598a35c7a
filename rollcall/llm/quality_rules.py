"""Quality rules: counts of a text, and how far its distributions lie from
those of the languages.

Each text has a histogram of character classes and one of common words. The
references are the sums of these histograms over all documents of each
language found in ``lang``; its common words are the ``COMMON`` commonest of
all its documents. The Jensen-Shannon distance (square root of the divergence, base 2)
to the nearest language decides, with guards for short texts: the classes
count from ``least_chars`` characters, the words from ``least_words`` words.
How far a text can be by its words depends on the language: one that holds
none of the common words is at ``sqrt(sum / 2 + term(1, 1 - sum))``, ``sum``
being their share in the reference. The bound is a share of that. A language
that accepts the text comes before one that doesn't, however near. Where a
text of a language is expected to hold few of its common words (long words,
or no spaces), their lack says nothing and doesn't count against it there.

Only DataFrame functions are used, within the row: no text is shuffled, only
counts of words. The driver holds 7 + ``COMMON`` numbers a language.

A language needs ``least_docs`` documents and ``least_words`` words for a
reference; texts of smaller ones are judged by their characters against the
others' references, not by their words.

Defined results: null and empty texts have no words and fail the base rules.
Without a language of enough documents the distances are 0. Repeated rows
count each and are judged alike; rows without an id or a language are judged
as well; long texts are counted whole. Of equally common words the first in
order is listed, of equally near languages the lesser class distance counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import pick
from rollcall.session import written_table

CLASSES = {"lower": "[a-z]+", "upper": "[A-Z]+", "space": r"[\x20\x09-\x0D]+", "digit": "[0-9]+", "symbol": "[#*$%&|<>]+", "other_ascii": r"[\x00-\x7F]+"}
_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WIDTH = 3
COMMON = 30  # words in a language's reference
PARTS = 16


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))


def ends(values: str) -> str:
    """SQL: the last index of every run of equal values in a sorted array column."""
    return f"if(size({values}) = 0, array(), filter(sequence(0, size({values}) - 1), i -> i = size({values}) - 1 or {values}[i] <> {values}[i + 1]))"


def plain_word(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(".,;:!?")))


def commonest(counted: DataFrame) -> dict[str, dict[str, float]]:
    """By language, its ``COMMON`` commonest words and their numbers, from
    (lang, word, n). Every part of the words gives so many, the driver merges."""
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("word"), F.lit(PARTS))).orderBy(F.desc("n"), "word")
    found: dict[str, list] = {}
    for r in counted.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= COMMON).collect():
        found.setdefault(r["lang"], []).append((-r["n"], r["word"]))
    return {lang: {w: float(-n) for n, w in sorted(own)[:COMMON]} for lang, own in found.items()}


def listed_words(docs: DataFrame) -> list[str]:
    """The commonest words of all languages, from the words of all documents."""
    plain = pick(docs, text="string", lang="string").filter("lang is not null and text is not null")
    # As they are first: only different ones are trimmed and lower-cased.
    raw = plain.select("lang", F.explode(words(F.col("text"))).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    each = raw.select("lang", plain_word(F.col("w")).alias("word"), "n").filter("word <> ''").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return sorted({w for own in commonest(each).values() for w in own})


def features(docs: DataFrame) -> DataFrame:
    """The base counts of every document, its classes and its common words."""
    listed = listed_words(docs)
    plain = pick(docs, doc_id="bigint", text="string", lang="string").withColumn("text", F.coalesce("text", F.lit("")))
    rows = plain.withColumn("w", words(F.col("text"))).withColumn("n", F.size("w"))

    # Character classes: each is counted on what the ones before have left.
    classes, rows = [], rows.withColumn("left_0", F.col("text"))
    for i, pattern in enumerate(CLASSES.values()):
        rows = rows.withColumn(f"left_{i + 1}", F.regexp_replace(f"left_{i}", pattern, ""))
        classes.append((F.char_length(f"left_{i}") - F.char_length(f"left_{i + 1}")).cast("double"))
    classes.append(F.char_length(f"left_{len(CLASSES)}").cast("double"))

    # Hashes of the three-word windows; only texts with equal ones sort them.
    rows = rows.withColumn("h", F.expr("if(n < 3, array(), transform(sequence(0, n - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))"))
    rows = rows.withColumn("s", F.expr("if(size(array_distinct(h)) < size(h), sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i))), array_repeat(named_struct('x', 0L, 'i', 0), 0))"))
    again = "filter(transform(s, (e, i) -> if((i > 0 and s[i - 1].x = e.x) or (i < size(s) - 1 and s[i + 1].x = e.x), e.i, -1)), p -> p >= 0)"
    rows = rows.withColumn("p", F.expr(f"sort_array({again})"))
    covered = F.expr(f"if(size(p) = 0, 0L, aggregate(transform(p, (x, i) -> if(i = 0, {WIDTH}L, cast(least({WIDTH}, x - p[i - 1]) as bigint))), 0L, (a, x) -> a + x))")

    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_SPACES)) != "")
    common = F.filter(F.transform("w", plain_word), lambda x: x.isin(*listed))
    rows = rows.withColumn("lines", lines).withColumn("c", F.sort_array(common)).withColumn("e", F.expr(ends("c")))
    counts = F.expr("transform(e, (x, k) -> struct(c[x] as word, cast(x - if(k = 0, -1, e[k - 1]) as double) as n))")
    return rows.select(
        "doc_id",
        "lang",
        F.col("n").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.array(*classes).alias("classes"),
        counts.alias("common"),
    )


def references(rows: DataFrame, *, least_docs: int = 20, least_words: int = 1000) -> dict[str, tuple[list[float], dict[str, float]]]:
    """By language: shares of the character classes, and of its common words
    among all words. At most languages x (classes + words) numbers. Languages
    of fewer documents or words have no reference."""
    known = rows.filter(F.col("lang").isNotNull())
    enough = (F.count(F.when(F.col("n_words") > 0, 1)) >= least_docs) & (F.sum("n_words") >= least_words)
    total = known.groupBy("lang").agg(enough.alias("enough"), F.sum("n_words").alias("n"), F.array(*[F.sum(F.col("classes")[i]) for i in range(len(CLASSES) + 1)]).alias("classes"))
    # The words counted in the rows include the commonest of every language.
    common = commonest(known.select("lang", F.explode("common").alias("x")).groupBy("lang", "x.word").agg(F.sum("x.n").alias("n")))
    found = {}
    for r in total.filter("enough").collect():
        chars = sum(r["classes"])
        found[r["lang"]] = ([c / chars for c in r["classes"]], {w: n / r["n"] for w, n in common.get(r["lang"], {}).items()})
    return found


def term(p: Column, q: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence of p and q."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    return (part(p) + part(q)) / 2


def farthest(common: dict[str, float]) -> float:
    """The word distance of a text that holds none of the common words."""
    listed = sum(common.values())
    rest = max(0.0, 1 - listed)
    m = (1 + rest) / 2
    return math.sqrt(max(0.0, listed / 2 + (-math.log2(m) + (rest * math.log2(rest / m) if rest else 0.0)) / 2))


def known_in(share: Column):
    return lambda x: F.map_contains_key(share, x["word"])


def added(share: Column, n: Column):
    """What the common words of a text add over a text without any."""

    def step(sum: Column, x: Column) -> Column:
        q = F.element_at(share, x["word"])
        return sum + term(x["n"] / n, q) - q / 2

    return step


def distances(rows: DataFrame, reference: dict, *, most_class: float = 0.28, most_word: float = 0.8, least_chars: int = 200, least_words: int = 100, least_common: float = 10) -> DataFrame:
    """Adds class_distance and word_distance, to the language whose sum of both
    is least among those that accept the text, or among all; and far: whether
    none does. ``most_word`` is a share of the farthest word distance."""
    if not reference:
        return rows.withColumns({"class_distance": F.lit(0.0), "word_distance": F.lit(0.0), "far": F.lit(False)})
    add = lambda a, x: a + x
    root = lambda x: F.sqrt(F.greatest(x, F.lit(0.0)))
    one = []
    for lang in sorted(reference):
        classes, common = reference[lang]
        share = F.create_map(*[F.lit(x) for pair in common.items() for x in pair]) if common else F.create_map().cast("map<string,double>")
        one.append(F.struct(F.lit(lang).alias("lang"), F.array(*[F.lit(q) for q in classes]).alias("classes"), share.alias("common"), F.lit(float(sum(common.values()))).alias("listed"), F.lit(farthest(common)).alias("farthest")))
    chars = F.aggregate("classes", F.lit(0.0), add)
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    # Of a language that is named but has no reference, only the characters can be judged.
    unlisted = F.coalesce(~F.col("lang").isin(*reference), F.lit(False))

    def measured(ref: Column) -> Column:
        by_class = F.aggregate(F.zip_with("_shares", ref["classes"], term), F.lit(0.0), add)
        own = F.filter("common", known_in(ref["common"]))
        # A common word that the text lacks adds half its share; the words not listed are one bin.
        listed = F.aggregate(own, F.lit(0.0), lambda a, x: a + x["n"]) / n
        there = F.aggregate(own, F.lit(0.0), added(ref["common"], n))
        by_word = there + ref["listed"] / 2 + term(1 - listed, 1 - ref["listed"])
        few = unlisted | (n * ref["listed"] < least_common) & F.coalesce(F.col("lang") == ref["lang"], F.lit(False))
        return F.struct(root(by_class).alias("class_distance"), root(by_word).alias("word_distance"), ref["farthest"].alias("farthest"), few.alias("few"))

    def judged_by(x: Column) -> Column:
        far = ((F.col("word_chars") >= least_chars) & (x["class_distance"] > most_class)) | ((F.col("n_words") >= least_words) & ~x["few"] & (x["word_distance"] > most_word * x["farthest"]))
        return F.struct(far.alias("far"), (x["class_distance"] + x["word_distance"]).alias("sum"), x["class_distance"].alias("class_distance"), x["word_distance"].alias("word_distance"))

    names = rows.columns
    rows = rows.withColumn("_shares", F.transform("classes", lambda x: F.when(chars > 0, x / chars).otherwise(F.lit(0.0))))
    rows = rows.withColumn("_each", F.transform(F.array(*one), measured)).withColumn("near", F.array_min(F.transform("_each", judged_by)))
    return rows.select(*names, "near.class_distance", "near.word_distance", "near.far")


def judged(docs: DataFrame) -> DataFrame:
    """The counts of every document, base_failed and kept."""
    rows = written_table(docs.sparkSession, "quality-counts")(features(docs))
    rows = distances(rows, references(rows))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~F.col("far")).alias("kept"), "class_distance", "word_distance")


def query(docs: DataFrame) -> DataFrame:
    return judged(docs)
