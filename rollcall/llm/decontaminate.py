"""Benchmark passages in documents, by a positional inverted index.

The index holds (document, position, term) postings of the benchmark's terms
in all documents; it is written to the session's shared folder. Every window
of an item is looked up from its rarest term: the postings of that term, less
the term's place in the item, are alignments of the item with a document.
They are intersected with the postings of the window's second rarest term,
and those left with the postings of all the item's terms. A window whose
terms all lie at their places in an alignment is an exact phrase match; with
a ``slop``, terms may lie that many words off their places (proximity match).

Only DataFrame functions are used. Nothing is broadcast by a hint: the
benchmark's tables are written first, so that Spark knows their true sizes.

Defined results: null and empty texts, and documents without words, have no
windows and are not contaminated; items without words have no windows. Words in
windows of an item without an id are hit, but no item is named for them. Rows
that repeat a doc_id, or an item_id, are told apart by a hash of the text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import documents, pick, table, texts
from rollcall.session import written_table

WINDOW = 13
# Words of the contract, before A-Z are lower-cased: no ASCII character but 0-9, A-Z, a-z.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
KEY = ["doc", "copy"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def folded(word: Column) -> Column:
    """A-Z lower-cased and nothing else (``lower`` does just that in ASCII)."""
    return F.when(F.char_length(word) == F.octet_length(word), F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def keyed(docs: DataFrame) -> DataFrame:
    """texts() with a key that tells rows of the same doc_id apart."""
    return texts(docs).select("doc_id", "text", F.coalesce("doc_id", F.lit(-1)).alias("doc"), F.xxhash64("text").alias("copy"))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, place, term, width, size): the words of every item, and
    the width of its windows. ``item`` tells texts of the same item_id apart."""
    found = pick(items, item_id="bigint", text="string").filter("text is not null").distinct()
    found = found.select(F.xxhash64("item_id", "text").alias("item"), "item_id", words(F.col("text")).alias("words"))
    width = F.least(F.size("words"), F.lit(WINDOW))
    each = found.select("item", "item_id", width.alias("width"), F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))
    return each.select("item", "item_id", "place", folded(F.col("word")).alias("term"), "width", "size")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc, copy, pos, term) of every occurrence in docs of the given terms (term, word)."""
    each = keyed(docs).select(*KEY, F.posexplode(words(F.col("text"))).alias("pos", "word")).select(*KEY, "pos", folded(F.col("word")).alias("word"))
    return each.join(terms, "word").select(*KEY, "pos", "term")


def rarest(places: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, first, first_term, second, second_term): for every window the
    places of its rarest term and its second rarest. Windows with a term that
    no document has are gone."""
    counted = places.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    starts = F.sequence(F.greatest(F.lit(0), F.col("place") - F.col("width") + 1), F.least(F.col("place"), F.col("size") - F.col("width")))
    inside = counted.withColumn("start", F.explode(starts))
    ranked = inside.groupBy("item", "start").agg(F.array_sort(F.collect_list(F.struct("n", "place", "term"))).alias("by_n"), F.first("width").alias("width"))
    whole = ranked.filter(F.col("by_n")[0]["n"] > 0)
    second = F.when(F.size("by_n") > 1, F.col("by_n")[1]).otherwise(F.col("by_n")[0])
    return whole.select("item", F.col("by_n")[0]["place"].alias("first"), F.col("by_n")[0]["term"].alias("first_term"), second["place"].alias("second"), second["term"].alias("second_term")).distinct()


def matches(docs: DataFrame, items: DataFrame, *, slop: int = 0) -> DataFrame:
    """(doc, copy, item_id, at, starts, width): alignments of an item with a
    document (item place 0 lies at position ``at``) and the item places where
    the windows that match begin."""
    keep = written_table(docs.sparkSession, "positional-index")
    places = keep(item_terms(items).withColumn("word", F.col("term")).withColumn("term", F.xxhash64("term")))
    index = keep(postings(docs, keep(places.select("term", "word").distinct())))
    counts = keep(index.groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    pairs = keep(rarest(places.drop("word"), counts))

    off = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    first = pairs.select(F.col("first_term").alias("term"), "item", "first").distinct()
    aligned = index.join(first, "term").select(*KEY, "item", "first", (F.col("pos") - F.col("first")).alias("at"))
    # The second rarest terms are a small part of the index.
    seconds = pairs.select(F.col("second_term").alias("term")).distinct()
    wanted = aligned.join(pairs.select("item", "first", "second", "second_term"), ["item", "first"])
    wanted = wanted.select(*KEY, "item", "at", F.col("second_term").alias("term"), (F.col("at") + F.col("second")).alias("place"))
    wanted = wanted.select("*", off.alias("off")).withColumn("pos", F.col("place") + F.col("off")).drop("place", "off")
    left = keep(wanted.join(index.join(seconds, "term", "left_semi"), [*KEY, "pos", "term"]).select(*KEY, "item", "at").distinct())

    # Those few alignments against all terms of their items.
    every = left.join(places.select("item", "item_id", "place", "term", "width", "size"), "item")
    every = every.select("*", off.alias("off")).withColumn("pos", F.col("at") + F.col("place") + F.col("off"))
    there = index.join(left.select(*KEY).distinct(), KEY, "left_semi")
    met = every.join(there, [*KEY, "pos", "term"]).groupBy(*KEY, "item", "at").agg(F.array_sort(F.collect_set("place")).alias("met"), F.first("width").alias("width"), F.first("item_id").alias("item_id"))
    met = met.filter("size(met) >= width")
    begins = F.expr("filter(transform(sequence(0, size(met) - width), i -> if(met[i + width - 1] - met[i] = width - 1, met[i], -1)), p -> p >= 0)")
    return met.select(*KEY, "item_id", "at", begins.alias("starts"), "width").filter("size(starts) > 0")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: its words, those inside matching windows, the items
    they come from, and whether it counts as contaminated (a twentieth of its words)."""
    found = written_table(docs.sparkSession, "contamination")(matches(docs, items))
    covered = F.array_distinct(F.flatten(F.expr("transform(starts, s -> sequence(at + s, at + s + width - 1))")))
    hit = found.select(*KEY, F.explode(covered).alias("pos")).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    of = found.groupBy(*KEY).agg(F.collect_set("item_id").alias("items"))
    hits = hit.join(of, KEY)
    rows = keyed(docs).select("doc_id", *KEY, F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    listed = F.array_join(F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda i: i.cast("string"))), ",")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return rows.join(hits, KEY, "left").select(
        "doc_id",
        *KEY,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return report(docs, items).drop(*KEY)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't contaminated by the benchmark of ``sf_dir``."""
    plain = documents(docs)
    found = written_table(spark, "contaminated")(report(plain, table(spark, sf_dir, "benchmark")).filter("contaminated").select(*KEY))
    key = [F.coalesce("doc_id", F.lit(-1)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy")]
    return plain.select("*", *key).join(found, KEY, "left_anti").select(*plain.columns)


# Windows as strings: every 13 words of an item against every 13 words of a document.
SQL = r"""
with d as (select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
iw as (select distinct item_id, least(len(w), 13) as m, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') as win from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as s from b where len(w) > 0)),
widths as (select distinct m from iw),
dw as (select r, s, m, array_to_string(w[s:s + m - 1], ' ') as win from (select r, w, m, unnest(range(1, len(w) - m + 2)) as s from d, widths where len(w) >= m)),
h as (select dw.r, dw.s, dw.m, iw.item_id from dw join iw on dw.win = iw.win and dw.m = iw.m),
c as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + m)) as p from h) group by r),
i as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items from h group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
  sha256(coalesce(i.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 and 20 * coalesce(c.n_hit, 0) >= len(d.w) as contaminated
from d left join c using (r) left join i using (r)
"""
