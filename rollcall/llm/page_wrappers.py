"""Main texts of web pages through wrappers that are inferred per host.

A wrapper is a regular expression without unions over tags and text slots,
written as a tree: an item is a text slot, an element with its items, or a group
of items, and may be optional or repeated. Pages are read as balanced streams of
tags (ends that pages leave out are put in). Equal neighbours of a page fold into
repeated items and groups. Then the streams of a host are aligned one after
another, element by element: where two differ, the nearest place is sought at
which one goes on as the other (cross search), and what lies between becomes
optional; where one goes on with what came before, the item becomes repeated; text
that differs makes a slot vary, text that is the same everywhere stays template.

The finished wrapper says which slots hold the main text: those in its articles
(or its main element), without navigation, forms, notices, adverts, comments and
the like, which are known by tag or by words of class, id and role. Pages without
either have the slots of the densest element that vary and aren't mostly links.
Each page is then read along its host's wrapper, and the texts of those slots are
its main text.

Wrappers of a host are merged in rounds: each task merges its pages, then groups
of ``FAN`` partial wrappers are merged until one per host is left, so that no
group grows with the host. A wrapper has a bounded size: an element with more than
``ITEMS`` different items, or whose wrapper has more than ``NODES``, is free: its
texts are kept or not as a whole, by the page's own tags.

Defined results: null and empty html give ''. A page without host (null url, or
no ``://``) counts to the host ''. Rows are kept as they are, repeated rows and null
ids too. White space is what Python's ``split`` takes for it (no-break spaces
too); ``br`` counts as white space. Where pages of a host differ so much that the
order of alignment matters, the order is that of the rows in their files. Further
columns of the input are not used.
"""

from __future__ import annotations

import html as entities
import json
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import Memo, pick, small
from rollcall.operators import skew
from rollcall.session import written_table

FAN = 32  # partial wrappers that are merged at a time
ITEMS, NODES, DEPTH, PERIOD = 64, 2000, 60, 4
HOSTS = 1000  # partial wrappers that a task holds

# What a tag is to a reader.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img picture source br".split()
)
IN_HEAD = frozenset("title meta link script style base noscript template".split())
# Never main text, whatever they hold.
NEVER = frozenset("head title script style noscript template iframe object svg canvas audio video map select textarea button datalist nav menu dialog xmp noembed noframes".split())
# Not main text, unless they hold both the article and most of the page.
SELDOM = frozenset("footer aside".split())
WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion notice notices cookie cookies consent gdpr comment comments commentlist disqus respond reply replies share sharing social related recommended newsletter".split()
)
ROLES = frozenset("navigation contentinfo complementary search menu menubar toolbar alert alertdialog dialog".split())
# Not main text, unless they hold the article or most of the page; headers of articles are.
HARDLY = frozenset("header form fieldset".split())
SOFT_WORDS = frozenset("header masthead banner subscribe signup login search popup modal overlay widget pagination pager toolbar".split())
# An open element of these ends where the next of its kind begins, up to the named parents.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select", "datalist"})}
ENDS |= {t: ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}) for t in ("thead", "tbody", "tfoot")}

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|(/?)([A-Za-z][^\s/>]*)[^>]*>|[!?/][^>]*(?:>|\Z)|[A-Za-z][^>]*\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# An item: its name, its items, whether optional, whether repeated, its occurrences, characters, characters in
# links, and a hash of its text (None where it varies). Names: "#" a text slot, "+" a group, "?" free content, else a
# tag and its label; behind a sign those that are never (!), seldom (-) or hardly (~) main text.
NAME, KIDS, OPTIONAL, REPEATED, TIMES, CHARS, LINKS, HASH = range(8)


def named(tag: str, attributes: str) -> str:
    """The name of an element's item."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    role, kind = found.get("role", "").strip().lower(), found.get("itemprop", "").lower()
    if "articlebody" in kind:
        tag = "article"
    elif role in ("main", "article"):
        tag = role
    words = [w.lower() for c in ("class", "id") for part in found.get(c, "").split() for w in _WORD.findall(part)]
    named_so = {w for i, w in enumerate(words) if i == 0 or words[i - 1] not in ("no", "has", "with", "without", "hide")}
    sign = ""
    if tag in ("html", "body"):
        pass
    elif tag in NEVER or "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        sign = "!"
    elif tag in SELDOM or role in ROLES or named_so & WORDS:
        sign = "-"
    elif tag in HARDLY or role in ("banner", "form") or named_so & SOFT_WORDS:
        sign = "~"
    # Labels without digits, so that numbered classes and ids don't make every page different.
    return f"{sign}{tag}|{'.'.join(words[:4])[:40]}"


class Reader:
    """Pages as trees: an element is [name, children], a text is a pair (text, characters in links)."""

    def __init__(self):
        self.names = Memo(lambda key: named(*key), 50_000)

    def __call__(self, page: str) -> list:
        root: list = ["page|", []]
        stack, tags = [root], [""]
        words: list[str] = []
        at = links = depth_a = 0
        search, names, unescape = _TAG.search, self.names, entities.unescape

        def flush():
            nonlocal links
            if words:
                text = " ".join("".join(words).split())
                if text:
                    stack[-1][1].append((text, min(links, len(text))))
                words.clear()
                links = 0

        while True:
            m = search(page, at)
            text = page[at : m.start()] if m else page[at:]
            if text:
                text = unescape(text) if "&" in text else text
                words.append(text)
                links += len(text) if depth_a else 0
            if not m:
                break
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag, ending = tag.lower(), m[1] or m[4]
            if tag in INLINE:
                if tag == "br":
                    words.append(" ")
                elif tag == "a":
                    depth_a = 0 if ending else 1
                continue
            flush()
            if ending:
                for i in range(len(tags) - 1, 0, -1):
                    if tags[i] == tag:
                        del stack[i:], tags[i:]
                        break
                    if tags[i] in ("td", "th", "table") and tag not in ENDS and tag not in ("table", "body", "html"):
                        break
                continue
            if tag in ("html", "body"):
                if tag == "body":
                    del stack[1:], tags[1:]
                continue
            if "head" in tags and tag not in IN_HEAD:
                i = tags.index("head")
                del stack[i:], tags[i:]
            if tags[-1] == "p":
                stack.pop(), tags.pop()
            if tag in ENDS:
                kind, parents = ENDS[tag]
                i = len(tags) - 1
                while i and tags[i] not in parents:
                    if tags[i] in kind:
                        del stack[i:], tags[i:]
                    i -= 1
            if tag in VOID:
                continue
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if len(stack) < DEPTH:
                element = [names[tag, m[3] or ""], []]
                stack[-1][1].append(element)
                stack.append(element)
                tags.append(tag)
        flush()
        return root


def fingerprint(text: str) -> int:
    return int.from_bytes(blake2b(text.encode(), digest_size=6).digest(), "little")


def item_of(node) -> list:
    """A page's element or text as an item, its repetitions folded."""
    if isinstance(node, tuple):
        return ["#", [], 0, 0, 1, len(node[0]), node[1], fingerprint(node[0])]
    kids = [item_of(k) for k in node[1]]
    own = fingerprint(",".join(str(k[HASH]) for k in kids)) if len(kids) != 1 else kids[0][HASH]
    return [node[0], fold(kids, True), 0, 0, 1, sum(k[CHARS] for k in kids), sum(k[LINKS] for k in kids), own]


def key(item: list) -> str:
    return item[NAME] if item[NAME] != "+" else "+" + ",".join(map(key, item[KIDS]))


def combined(a: list, b: list, same_page: bool = False) -> list:
    """Two items of one key as one; on one page their texts follow each other."""
    if same_page:
        text = fingerprint(f"{a[HASH]},{b[HASH]}")
    else:
        text = a[HASH] if a[HASH] == b[HASH] else None
    return [a[NAME], aligned(a[KIDS], b[KIDS], same_page), a[OPTIONAL] | b[OPTIONAL], a[REPEATED] | b[REPEATED], max(a[TIMES], b[TIMES]) if same_page else a[TIMES] + b[TIMES], a[CHARS] + b[CHARS], a[LINKS] + b[LINKS], text]


def fold(items: list, same_page: bool) -> list:
    """Items that repeat their neighbours, alone or as groups, become repeated ones."""
    for period in range(1, PERIOD + 1):
        if len(items) < 2 * period:
            break
        keys, out, i = [key(x) for x in items], [], 0
        while i < len(items):
            times = 1
            while keys[i : i + period] == keys[i + times * period : i + (times + 1) * period]:
                times += 1
            if times == 1:
                out.append(items[i])
                i += 1
                continue
            parts = items[i : i + period]
            for t in range(1, times):
                parts = [combined(a, b, same_page) for a, b in zip(parts, items[i + t * period : i + (t + 1) * period], strict=True)]
            if period == 1:
                parts[0][REPEATED] = 1
                out.append(parts[0])
            else:
                texts = None if any(p[HASH] is None for p in parts) else fingerprint(",".join(str(p[HASH]) for p in parts))
                out.append(["+", parts, 0, 1, max(p[TIMES] for p in parts), sum(p[CHARS] for p in parts), sum(p[LINKS] for p in parts), texts])
            i += times * period
        items = out
    return items


def optional(items: list) -> list:
    for x in items:
        x[OPTIONAL] = 1
    return items


def free(items: list) -> list:
    """Any content, as one item."""
    return ["?", [], 1, 1, max(x[TIMES] for x in items), sum(x[CHARS] for x in items), sum(x[LINKS] for x in items), None]


def aligned(a: list, b: list, same_page: bool = False) -> list:
    """Two runs of items as one run that both follow."""
    if a and a[0][NAME] == "?" or b and b[0][NAME] == "?":
        return [free(a + b)]
    keys_a, keys_b = [key(x) for x in a], [key(x) for x in b]
    if keys_a == keys_b:
        return [combined(x, y, same_page) for x, y in zip(a, b, strict=True)]
    out: list = []
    i = j = 0
    while i < len(a) and j < len(b):
        if keys_a[i] == keys_b[j]:
            out.append(combined(a[i], b[j], same_page))
            i, j = i + 1, j + 1
            continue
        # One occurrence of a group on the other side.
        if a[i][NAME] == "+" and [key(x) for x in a[i][KIDS]] == keys_b[j : j + len(a[i][KIDS])]:
            once = b[j : j + len(a[i][KIDS])]
            out.append(combined(a[i], ["+", once, 0, 1, 1, sum(x[CHARS] for x in once), sum(x[LINKS] for x in once), None], same_page))
            i, j = i + 1, j + len(once)
            continue
        if b[j][NAME] == "+" and [key(x) for x in b[j][KIDS]] == keys_a[i : i + len(b[j][KIDS])]:
            once = a[i : i + len(b[j][KIDS])]
            out.append(combined(["+", once, 0, 1, 1, sum(x[CHARS] for x in once), sum(x[LINKS] for x in once), None], b[j], same_page))
            i, j = i + len(once), j + 1
            continue
        # Cross search: the nearest place where one side goes on as the other.
        skip_a = keys_a.index(keys_b[j], i) - i if keys_b[j] in keys_a[i:] else None
        skip_b = keys_b.index(keys_a[i], j) - j if keys_a[i] in keys_b[j:] else None
        if skip_a is None and skip_b is None:
            out += optional([a[i], b[j]])
            i, j = i + 1, j + 1
        elif skip_b is None or skip_a is not None and skip_a <= skip_b:
            out += optional(a[i : i + skip_a])
            i += skip_a
        else:
            out += optional(b[j : j + skip_b])
            j += skip_b
    out += optional(a[i:] + b[j:])
    out = fold(out, same_page)
    return out if len(out) <= ITEMS else [free(out)]


def size(item: list) -> int:
    return 1 + sum(map(size, item[KIDS]))


def bounded(item: list) -> list:
    """The wrapper with at most NODES items: the deepest levels become free first."""

    def cut(x: list, depth: int):
        if depth == 0 and x[KIDS]:
            x[KIDS] = [free(x[KIDS])]
        for k in x[KIDS]:
            cut(k, depth - 1)

    for depth in range(DEPTH, 0, -1):
        if size(item) <= NODES:
            break
        cut(item, depth)
    return item


def merged(a: list | None, b: list) -> list:
    return b if a is None else bounded(combined(a, b))


# --- which slots hold the main text ---

SIGNS = "!-~"
DROP, KEEP, ELSE = 0, 1, 2  # ELSE: kept on pages without article and main element


def tag_of(item: list) -> str:
    return item[NAME].lstrip(SIGNS).split("|")[0]


def is_header(item: list) -> bool:
    return item[NAME][0] == "~" and (tag_of(item) == "header" or "header" in item[NAME].split("|")[1].split("."))


def judged(root: list) -> list:
    """The wrapper as [name, items, repeated, verdict]; verdicts stand at slots and free items."""
    total = max(1, root[CHARS])

    def holds(item: list, tags: tuple[str, ...]) -> bool:
        return any(tag_of(k) in tags and k[NAME][0] not in SIGNS or holds(k, tags) for k in item[KIDS])

    def out(item: list) -> bool:
        sign = item[NAME][0]
        if sign not in "-~":
            return sign == "!"
        most, article = 2 * item[CHARS] > total and not item[REPEATED], holds(item, ("article", "main"))
        return not (most and article if sign == "-" else most or article)

    def chars(item: list, tag: str) -> int:
        if out(item):
            return 0
        return item[CHARS] if tag_of(item) == tag else sum(chars(k, tag) for k in item[KIDS])

    articles, mains = chars(root, "article"), chars(root, "main")
    region = "article" if articles and 4 * articles >= mains else "main" if mains else ""

    def body(item: list) -> int:
        """Characters that vary and aren't links."""
        if item is not root and out(item):
            return 0
        if not item[KIDS]:
            return 0 if template(item) or 2 * item[LINKS] > item[CHARS] else item[CHARS]
        return sum(map(body, item[KIDS]))

    def template(item: list) -> bool:
        return item[HASH] is not None and root[HASH] is None and item[TIMES] > 1

    # Without article and main: down from the root while one element has most of the text and holds elements itself.
    densest = root
    while True:
        inner = [k for k in densest[KIDS] if k[NAME] not in ("#", "?") and not out(k) and any(x[NAME] not in ("#", "?") for x in k[KIDS])]
        best = max(inner, key=body, default=None)
        if best is None or 2 * body(best) <= body(densest):
            break
        densest = best

    def verdicts(item: list, inside: bool, dense: bool, heading: bool, in_article: bool) -> list:
        dropped = item is not root and out(item) and not (inside and is_header(item))
        dense = dense or item is densest
        tag = tag_of(item)
        if in_article and tag == "article" and not dropped:
            dropped = True  # an article in an article is a reader's comment
        if dropped:
            return [item[NAME], [], item[REPEATED], DROP]
        if tag == region:
            inside = True
            # Unless the outer one is nothing but the frame of the inner ones.
            inner = sum(chars(k, "article") for k in item[KIDS]) if tag == "article" else 0
            in_article = tag == "article" and 2 * inner < item[CHARS]
        heading = heading or bool(re.fullmatch("h[1-6]", tag))
        if not item[KIDS]:
            # Text that stands alike on many pages whose articles differ is template.
            notice = template(item) and item[TIMES] >= 10 and not heading
            kept = KEEP if inside and not notice else ELSE if not inside and dense and body(item) else DROP
            return [item[NAME], [], item[REPEATED], kept]
        kids = [verdicts(k, inside, dense, heading, in_article) for k in item[KIDS]]
        return [item[NAME], kids, item[REPEATED], KEEP if inside else ELSE if dense else DROP]

    return verdicts(root, False, False, False, False)


class Wrapper:
    """A judged wrapper, to read pages along."""

    def __init__(self, text: str):
        self.root = self._indexed(json.loads(text))

    def _indexed(self, item: list):
        """(places of each name among the items, the items, verdict); groups are replaced by what they hold."""
        flat: list = []

        def add(x, repeated):
            if x[0] == "+":
                for k in x[1]:
                    add(k, 1)
            else:
                flat.append((x[0], repeated or x[2], self._indexed(x)))

        for k in item[1]:
            add(k, 0)
        places: dict[str, list[int]] = {}
        for i, (name, _, _) in enumerate(flat):
            places.setdefault(name, []).append(i)
        return places, flat, item[3]

    def blocks(self, page: list) -> list[str]:
        found: list[tuple[int, str]] = []
        self._read(page, self.root, found)
        best = KEEP if any(v == KEEP for v, _ in found) else ELSE
        return [text for v, text in found if v == best]

    def _read(self, node: list, wrapper, found: list) -> None:
        places, items, verdict = wrapper
        if "?" in places:
            return self._free(node, items[places["?"][0]][2][2], found)
        at = 0
        for child in node[1]:
            name = "#" if isinstance(child, tuple) else child[0]
            where = places.get(name)
            if where is None:  # not in the wrapper: as the element that holds it
                if name == "#":
                    found.append((verdict, child[0]))
                elif name[0] not in SIGNS:
                    self._free(child, verdict, found)
                continue
            i = next((p for p in where if p >= at), where[0])
            at = i if items[i][1] else i + 1
            inner = items[i][2]
            if name == "#":
                found.append((inner[2], child[0]))
            elif inner[1] or inner[2] != DROP:
                self._read(child, inner, found)

    def _free(self, node: list, verdict: int, found: list) -> None:
        for child in node[1]:
            if isinstance(child, tuple):
                found.append((verdict, child[0]))
            elif child[0][0] not in SIGNS:
                self._free(child, verdict, found)


# --- on Spark ---


def host_of(url: Column) -> Column:
    """The host of a url, '' where there is none."""
    host = F.regexp_extract(url, r"^[^:]*?://([^/?#]*)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


def partial_wrappers(pages: DataFrame) -> DataFrame:
    """(host, n, wrapper): what each task makes of its pages of a host."""

    def work(batches):
        read = Reader()
        held: dict[str, list] = {}

        def sent():
            rows = [(h, n, json.dumps(w)) for h, (n, w) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], ["host", "n", "wrapper"])

        for batch in small(batches, 128):
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                n, wrapper = held.get(host, (0, None))
                held[host] = (n + 1, merged(wrapper, item_of(read(page))))
            if len(held) > HOSTS:
                yield sent()
        if held:
            yield sent()

    return pages.select("host", "html").mapInArrow(work, "host string, n bigint, wrapper string")


def one_per_host(parts: DataFrame, keep) -> DataFrame:
    """Merges the partial wrappers of each host in rounds of bounded groups."""

    def work(group: pa.Table) -> pa.Table:
        wrapper = None
        for text in sorted(group.column("wrapper").to_pylist(), key=lambda t: (-len(t), t)):
            wrapper = merged(wrapper, json.loads(text))
        return pa.table({"host": [group.column("host")[0].as_py()], "n": pa.array([sum(group.column("n").to_pylist())], pa.int64()), "wrapper": [json.dumps(wrapper)]})

    while True:
        most = parts.groupBy("host").agg(F.count(F.lit(1)).alias("parts")).agg(F.max("parts").alias("most")).first()["most"]
        if not most or most == 1:
            return parts
        dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(-(-most // FAN))))
        parts = keep(dealt.groupBy("host", "bucket").applyInArrow(work, "host string, n bigint, wrapper string"))


def judged_wrappers(wrappers: DataFrame) -> DataFrame:
    def work(batches):
        for b in batches:
            texts = [json.dumps(judged(json.loads(t)), separators=(",", ":")) for t in b.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("host"), b.column("n"), pa.array(texts, pa.string())], ["host", "n", "wrapper"])

    return wrappers.mapInArrow(work, "host string, n bigint, wrapper string")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    spark = pages.sparkSession
    work, result = written_table(spark, "page-wrappers"), written_table(spark, "page-wrappers-result")
    plain = pick(pages, page_id="bigint", url="string", html="string")
    plain = plain.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    try:
        wrappers = result(judged_wrappers(one_per_host(work(partial_wrappers(plain)), work)))
    finally:
        work.cleanup()

    def texts(batches):
        read, along = Reader(), Memo(Wrapper, 200)
        for batch in small(batches, 128):
            out = ["\n\n".join(along[w].blocks(read(page))) if page else "" for page, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    # One row per host on one side; a host with very many pages is split over tasks.
    hot = skew.hot_keys(wrappers, ["host"], "n", skew.rows_per_task(wrappers))
    found = skew.split_hot_join(plain, wrappers.select("host", "wrapper"), ["host"], hot, ["page_id", "url"])
    return found.mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages)
