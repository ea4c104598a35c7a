"""URL verdicts: rules first, gradient-boosted trees for the rest.

The rules (host, path prefix) judge the URLs they fit; those verdicts label
the training rows. The trees see lexical features only: lengths, depth, digit
ratio, entropy, parameter counts, how often the host's suffix and the first
path segment occur, and how labelled urls with them are judged, out of fold
and only where several rules judge them (else a rate would repeat the rule
that labels the row). Features are cut into at most 32 bins at their
quantiles; equal rows of bins are one weighted row, and each level of a tree
is one grouped sum of gradients over (leaf, feature, bin). Trees become
column expressions. No Python runs on the rows.

Defined results: null urls and those without ``://`` have empty host and path
and no rule; their verdict is the trees' on the empty url. Without a labelled
url of both kinds all unruled urls are allowed. Repeated rows are judged
alike, each on its own; long urls are read whole; rows without an id are
judged as well. Of equally good cuts the first feature's smallest bin is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import pick
from rollcall.session import written_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values of the contract: host, path prefix, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null. A rule's
    length is that of its text; equal ones can't both fit."""
    ordered = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r))
    found = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in ordered]
    return F.coalesce(*found)


def judged(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path, rule, ruled)."""
    plain = pick(pages, page_id="bigint", url="string").withColumn("url", F.coalesce("url", F.lit("")))
    host, path = parts(F.col("url"))
    split = plain.select("page_id", "url", host.alias("host"), path.alias("path"))
    fit = split.withColumn("fit", rule_of(F.col("host"), F.col("path")))
    return fit.select("page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"))


def counted(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character of the text's distribution of characters: the text
    against its distinct characters, of which there are few."""
    n = F.char_length(text)
    bits = F.aggregate(
        F.array_distinct(F.split(text, "")),
        F.lit(0.0),
        lambda sum, c: sum + F.when(c == "", F.lit(0.0)).otherwise(-(n - F.char_length(F.replace(text, c, F.lit("")))) / n * F.log2((n - F.char_length(F.replace(text, c, F.lit("")))) / n)),
    )
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def lexical(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with one double column per feature."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    features = {
        "url_length": F.char_length(url).cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "path_length": F.char_length(path).cast("double"),
        "labels": counted(host, r"\."),
        "depth": counted(path, "/"),
        "digit_ratio": counted(url, "[0-9]") / F.greatest(F.char_length(url), F.lit(1)),
        "hyphens": counted(url, "[-_]"),
        "host_entropy": entropy(host),
        "path_entropy": entropy(path),
        "parameters": F.when(query == "", F.lit(0.0)).otherwise(counted(query, "&") + 1),
        "fragment": F.when(F.locate("#", url) > 0, F.lit(1.0)).otherwise(0.0),
        "secure": F.when(url.startswith("https:"), F.lit(1.0)).otherwise(0.0),
        "extension": F.when(path.rlike(r"\.[A-Za-z0-9]{1,5}$"), F.lit(1.0)).otherwise(0.0),
    }
    suffix = F.regexp_extract(host, r"([^.]*\.[^.]*|[^.]*)$", 1)
    segment = F.regexp_extract(path, r"^/([^/]*)/", 1)
    out = rows.select("*", *[c.alias(f"f_{k}") for k, c in features.items()], suffix.alias("suffix"), segment.alias("segment"))
    return out, [f"f_{k}" for k in features]


FOLDS = 5


def fold() -> Column:
    """The fold of a row, by the hash of its id and url."""
    return F.pmod(F.xxhash64("page_id", "url"), F.lit(FOLDS))


def statistics(rows: DataFrame) -> DataFrame:
    """How labelled urls of each suffix, and of each first path segment, are
    judged, fold by fold, whether by several rules, and how many urls have it:
    (kind, name, several, block, known, count)."""
    both = [rows.select(F.lit(k).alias("kind"), F.col(k).alias("name"), "ruled", "rule", fold().alias("fold")) for k in ("suffix", "segment")]
    in_fold = lambda c: F.array(*[F.count(F.when(c & (F.col("fold") == i), 1)) for i in range(FOLDS)])
    return both[0].union(both[1]).groupBy("kind", "name").agg(
        F.coalesce(F.min("rule") < F.max("rule"), F.lit(False)).alias("several"),
        in_fold(F.col("ruled") == "block").alias("block"),
        in_fold(F.col("ruled").isNotNull()).alias("known"),
        F.log1p(F.count(F.lit(1)).cast("double")).alias("count"),
    )


def rate() -> Column:
    """Share of blocked among a name's labelled urls, smoothed towards one half.
    A labelled row doesn't see its own fold's labels, and a name that one rule
    alone has judged says nothing but the rule: it has one half."""
    own = F.when(F.col("ruled").isNotNull(), fold()).otherwise(F.lit(-1))
    others = lambda c: F.aggregate(F.transform(c, lambda x, i: F.when(i == own, F.lit(0).cast("bigint")).otherwise(x)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.when(F.col("several"), (others(F.col("block")) + 2) / (others(F.col("known")) + 4)).otherwise(F.lit(0.5))


# ---- trees ------------------------------------------------------------------


def bin_of(feature: str, cuts: list[float]) -> Column:
    """The number of cuts below the feature's value."""
    if not cuts:
        return F.lit(0).alias(feature)
    every = F.array(*[F.lit(float(x)) for x in cuts])
    return F.size(F.filter(every, lambda x: x < F.col(feature))).alias(feature)


def binned(features: list[str], cuts: dict[str, list[float]]) -> list[Column]:
    return [bin_of(f, cuts[f]) for f in features]


def leaf_expression(tree: dict, node: int = 1) -> Column:
    """Value of a tree ({node: (feature, bin) or value}) for a row of bins."""
    what = tree[node]
    if isinstance(what, float):
        return F.lit(what)
    return F.when(F.col(what[0]) <= what[1], leaf_expression(tree, 2 * node)).otherwise(leaf_expression(tree, 2 * node + 1))


def place_expression(tree: dict, node: int = 1) -> Column:
    """The open leaf (still without value) that a row of bins falls into."""
    what = tree.get(node)
    if what is None or isinstance(what, float):
        return F.lit(node)
    return F.when(F.col(what[0]) <= what[1], place_expression(tree, 2 * node)).otherwise(place_expression(tree, 2 * node + 1))


def grown(rows: DataFrame, features: list[str], margin: Column, *, depth: int, rate: float, l2: float = 1.0) -> dict:
    """One regression tree on the logistic loss's gradients; ``rows`` are binned
    and hold weights ``n`` and ``block``."""
    p = 1 / (1 + F.exp(-margin))
    graded = rows.select(*features, (F.col("n") * p - F.col("block")).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))
    tree: dict[int, object] = {}
    for level in range(depth + 1):
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("int").alias("bin")) for f in features])).alias("x")
        sums = graded.select(place_expression(tree).alias("node"), "g", "h", pairs).groupBy("node", "x.f", "x.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        # At most 2^depth leaves x features x bins rows.
        table: dict[int, dict[str, list]] = {}
        for r in sums.collect():
            table.setdefault(r["node"], {}).setdefault(r["f"], []).append((r["bin"], r["g"], r["h"]))
        for node, by in table.items():
            if node in tree or node.bit_length() != level + 1:
                continue
            one = next(iter(by.values()))
            g, h = sum(x[1] for x in one), sum(x[2] for x in one)
            best = (1e-6, None, None)
            for f in features if level < depth else ():
                left_g = left_h = 0.0
                for b, gb, hb in sorted(by.get(f, []))[:-1]:
                    left_g, left_h = left_g + gb, left_h + hb
                    gain = left_g**2 / (left_h + l2) + (g - left_g) ** 2 / (h - left_h + l2) - g**2 / (h + l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, b)
            tree[node] = (best[1], best[2]) if best[1] else float(-rate * g / (h + l2))
    return tree


class Trees:
    """Cuts, trees and start margin; ``margin()`` is a column over binned rows."""

    def __init__(self, features: list[str], cuts: dict[str, list[float]], start: float):
        self.features, self.cuts, self.start, self.trees = features, cuts, start, []

    def margin(self) -> Column:
        out = F.lit(self.start)
        for t in self.trees:
            out = out + leaf_expression(t)
        return out


def fit(rows: DataFrame, features: list[str], *, trees: int = 6, depth: int = 3, rate: float = 0.5, bins: int = 32) -> Trees | None:
    """Boosted trees from all rows with a rule's verdict (``ruled``)."""
    known = rows.filter("ruled is not null")
    marks = [i / bins for i in range(1, bins)]
    first = known.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("ruled") == "block", 1)).alias("block"), *[F.percentile_approx(f, F.array(*[F.lit(m) for m in marks]), F.lit(1000)).alias(f) for f in features]).first()
    if not 0 < first["block"] < first["n"]:
        return None
    model = Trees(features, {f: sorted(set(first[f])) for f in features}, math.log(first["block"] / (first["n"] - first["block"])))
    weighted = known.select(*binned(features, model.cuts), "ruled").groupBy(*features).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("ruled") == "block", 1)).alias("block"))
    weighted = written_table(rows.sparkSession, "url-bins")(weighted)
    for _ in range(trees):
        model.trees.append(grown(weighted, features, model.margin(), depth=depth, rate=rate))
    return model


def verdicts(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' probability of block."""
    keep = written_table(pages.sparkSession, "urls")
    rows, features = lexical(judged(pages))
    rows = keep(rows)
    stats = keep(statistics(rows))
    for kind in ("suffix", "segment"):
        own = stats.filter(F.col("kind") == kind).select(F.col("name").alias(kind), "several", "block", "known", F.col("count").alias(f"f_{kind}_count"))
        rows = rows.join(own, kind).withColumn(f"f_{kind}_rate", rate()).drop("several", "block", "known")
        features = [*features, f"f_{kind}_rate", f"f_{kind}_count"]
    model = fit(rows, features)
    if model is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("p_block"))
    scored = rows.select("page_id", "host", "path", "rule", "ruled", *binned(features, model.cuts))
    scored = scored.withColumn("p_block", 1 / (1 + F.exp(-model.margin())))
    learned = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "p_block")


def query(pages: DataFrame) -> DataFrame:
    return verdicts(pages)
