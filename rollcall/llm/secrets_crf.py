"""Secrets in text: fixed patterns, and a linear-chain conditional random field.

The patterns (``base_spans``) give the sure finds. The CRF tags every token as
begin (B), inside (I) or outside (O) of a secret from its own shape, the
shapes of the two tokens before and the one after it, hashed words around it,
whether a word that names secrets is near before it, and features of the whole
text; Viterbi decodes the best tags. What of its finds no pattern find covers is
added as kind ``crf``.

It is trained here on windows around the patterns' finds and on windows of other
text. So that it learns what secrets look like and not the patterns again:

* the weight of a shape is the sum of the weights of what it is made of (signs,
  digits, cases, length, changes between them), which finds of one kind share
  with secrets of others;
* each window with a find also comes with its cue masked (the tokens before the
  secret and after it become ordinary ones), with the secret cut to 10 to 23
  characters, and with that after a naming word without signs between them;
* windows of other text in which a value stands after a naming word without
  being a pattern's find teach nothing: they may hold secrets.

Viterbi runs only where it can matter: where O beats B and I at a token by
more than any two transitions can give back, every best path has O there
(changing the tag to O raises any path's score), so the rest falls apart into
short runs between such tokens. The result is that of decoding whole texts.

Defined results: null and empty texts have no spans. Offsets are code points,
the end exclusive; texts of any length are tagged whole. Without training finds
the CRF adds nothing. Rows without an id or with another's id are searched and
learned from like any other; rows of one text teach once.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import Memo, bounded_examples, documents, learned, pick, small, texts
from rollcall.session import written_table

KINDS = ("assign", "access", "hex", "crf")
O, B, I = 0, 1, 2  # noqa: E741
REDACTED = "<SECRET>"

_ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token"))
_ASSIGN = re.compile(rf"""({_ANY_CASE}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # a run with at least 16 characters
_HEX = re.compile(r"[0-9a-f]{32,}")

_ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
_TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s+/.\-]")
_NAMING = ("pass", "pwd", "secret", "token", "key", "auth", "cred", "bearer", "private")  # parts of words that name secrets
_NAMES = re.compile("|".join(_NAMING))
_RUNS = re.compile(r"\d+|[a-z]+|[A-Z]+|[^\W\d_a-zA-Z]+")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of the patterns' finds, in order."""
    found = []
    low = text.lower() if ":" in text or "=" in text else ""
    if any(name in low for name in _ASSIGNED):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, *_ in spans)


# ---- features ---------------------------------------------------------------

END, NAMING = 0, 5  # the shapes beyond a text's ends, and of words that name secrets
N_SHAPES = 6 + 8 * 2 * 4 * 3
N_BINS = 256  # of hashed words; 0 is no word
BEFORE, AFTER = 4, 1  # how many tokens around one count


def coded(token: str) -> tuple[int, int]:
    """A token's shape and word. Shapes: signs, naming words, and words by what they
    hold, their length and how often digits and cases change in them."""
    low = token.lower()
    word = 1 + zlib.crc32(low.encode("utf-8", "surrogatepass")) % (N_BINS - 1)
    length = len(token)
    if length == 1 and not token.isalnum() and token not in "_+/.-":
        return {"=": 1, ":": 2, '"': 3, "'": 3}.get(token, 4), word
    letters = token.isalpha()
    digits = 0 if letters else sum(map(str.isdigit, token))
    if 2 < length < 24 and digits < 3 and _NAMES.search(low):
        return NAMING, word
    upper, lower = token != low, token != token.upper()
    runs = _RUNS.findall(token) if digits or (upper and lower) else ()
    # A capital before small letters is no change.
    changes = max(0, len(runs) - 1 - (len(runs) > 1 and len(runs[0]) == 1 and runs[0].isupper()))
    holds = (digits > 0) + 2 * lower + 4 * upper + 8 * (not letters and any(c in token for c in "+/_.-"))
    size = (length >= 8) + (length >= 14) + (length >= 24)
    return 6 + (holds * 4 + size) * 3 + (changes >= 2) + (changes >= 4), word


def shape(token: str) -> int:
    return coded(token)[0]


def encoded(chunk: str) -> bytes:
    """Two bytes, shape and word, for each token of a piece of text without white space."""
    if chunk.isalpha():
        return bytes(coded(chunk))
    out = bytearray()
    for token in _TOKEN.findall(chunk):
        out += bytes(coded(token))
    return bytes(out)


def looked_up(text: str, memo: Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shapes and words of the text's tokens, with the places beyond its ends,
    and whether a naming word is among the tokens before each."""
    both = b"".join((bytes(2 * BEFORE), *map(memo.__getitem__, text.split()), bytes(2 * AFTER)))
    both = np.frombuffer(both, dtype=np.uint8).reshape(-1, 2)
    return both[:, 0], both[:, 1], named(both[:, 0])


def named(codes: np.ndarray) -> np.ndarray:
    naming, cue = codes == NAMING, np.zeros(len(codes), dtype=np.uint8)
    if naming.any():
        for back in range(1, BEFORE + 1):
            cue[back:] |= naming[:-back]
    return cue


def text_kind(text: str) -> int:
    """Features of the whole text: assigns values, names secrets, has several
    lines, has signs of code, has addresses."""
    low = text.lower()
    return ("=" in text) + 2 * any(name in low for name in _NAMING) + 4 * ("\n" in text) + 8 * ("{" in text or ";" in text) + 16 * ("://" in text)


# Tables of weights: which array they look into (shapes, words, cue), and how far from the token.
LOOKS = {"own": (0, 0), "back": (0, -1), "back2": (0, -2), "next": (0, 1), "word": (1, -1), "word2": (1, -2), "word3": (1, -3), "word_next": (1, 1), "cue": (2, 0)}
SIZES = (N_SHAPES, N_BINS, 2)


def _made_of() -> dict[str, np.ndarray]:
    """What a token's own shape and the features of the text are made of (rows: values, columns: parts)."""
    own = []
    for code in range(N_SHAPES):
        x = max(0, code - 6)
        changes, size, holds = x % 3, x // 3 % 4, x // 12
        digit, lower, upper, sign = (holds >> i & 1 for i in range(4))
        mixed = digit and (lower or upper)
        word = [digit, lower, upper, sign, mixed, lower and upper, digit and not mixed, size > 0, size > 1, size > 2, changes > 0, changes > 1,
                mixed and size > 0, mixed and size > 1, changes > 0 and size > 0, changes > 1 and size > 1, sign and not digit]
        own.append([code == i for i in range(6)] + [code >= 6 and bool(f) for f in word])
    bits = [[True] + [bool(kind >> i & 1) for i in range(5)] for kind in range(32)]
    return {"own": np.array(own, dtype=float), "text": np.array(bits, dtype=float)}


MADE_OF = _made_of()
# Shapes of values that a naming word before them makes suspect: digits and letters, 8 or more.
_VALUE = (MADE_OF["own"][:, 6 + 12] > 0)


def emissions(arrays: tuple, a: int, b: int, kind: int, w: dict) -> np.ndarray:
    """Scores (token, tag) of the tokens from a to b."""
    at = BEFORE + a, BEFORE + b
    return sum(w[k][arrays[x][at[0] + d : at[1] + d]] for k, (x, d) in LOOKS.items()) + w["text"][kind]


# ---- training ---------------------------------------------------------------

AROUND = 12
BEYOND = -1  # the tag of places beyond a short text's end, which count for nothing


def windows(text: str, memo: Memo, step: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(shapes and words with their surroundings, tags, text kind) around each
    find as it is, with its cue masked, cut to a shorter secret, and so without
    the signs around it, and one window of ordinary text at every ``step`` tokens."""
    where = [m.span() for m in _TOKEN.finditer(text)]
    codes, words, cue = looked_up(text, memo)
    tags = np.zeros(len(where), dtype=np.int8)
    starts = np.array([a for a, _ in where], dtype=np.int64)
    found = {}
    for _, _, end, begin in base_spans(text):
        i, j = np.searchsorted(starts, begin), np.searchsorted(starts, end)
        i -= i == len(starts) or starts[i] > begin  # begins inside a token
        if i < j:
            tags[i], tags[i + 1 : j] = B, I
            found[int(i)] = int(j)
    size, kind, out = 2 * AROUND + 1, text_kind(text), []
    gap = max(0, size - len(where))  # a short text is filled up with places beyond it
    codes, words = np.pad(codes, (0, gap)), np.pad(words, (0, gap))
    suspect = np.append(_VALUE[codes] & (cue if not gap else np.pad(cue, (0, gap))).astype(bool), False)[BEFORE : BEFORE + len(where)] & (tags == O)
    tags = np.pad(tags, (0, gap), constant_values=BEYOND)

    def cut(m):
        a = max(0, min(m - AROUND, len(tags) - size))
        return codes[a : a + size + BEFORE + AFTER].copy(), words[a : a + size + BEFORE + AFTER].copy(), tags[a : a + size], kind

    def altered(i, j, masked=(), shorter=False):
        own, near, t, k = cut((i + j) // 2)
        first = BEFORE - max(0, min((i + j) // 2 - AROUND, len(tags) - size))  # the place of the text's first token
        around = [x + first for x in (*range(i - BEFORE, i), j) if 0 <= x + first < len(own)]
        around = [x for x in around if own[x] != END and own[x] in masked]
        own[around], near[around] = PLAIN, 0
        if shorter:
            token = text[where[i][0] : where[i][1]]
            own[first + i] = shape(token[: 10 + zlib.crc32(token.encode("utf-8", "surrogatepass")) % 14])
        return own, near, t, k & ~1 if NAMING not in masked else k & ~3

    for i, j in found.items():
        out += [cut((i + j) // 2), altered(i, j, EVERY), altered(i, j, (), True), altered(i, j, EVERY - {NAMING}, True)]
    for m in range(min(AROUND, len(where) - 1), len(where), step):
        a = max(0, min(m - AROUND, len(tags) - size))
        inside = tags[a : a + size]
        if not suspect[a : a + size].any() and not (inside > O).any():
            out.append(cut(m))
    return out


PLAIN = shape("plain")
EVERY = frozenset(range(N_SHAPES))


def trained(examples: list, rounds: int = 100, rate: float = 0.15, l2: float = 1e-3) -> dict:
    """Weights that maximise the windows' regularised conditional likelihood
    (forward-backward gradients, Adam steps)."""
    codes, words, tags, kinds = (np.array([e[i] for e in examples]) for i in range(4))
    n, size = tags.shape
    arrays = codes, words, np.array([named(c) for c in codes])
    slices = {k: arrays[x][:, BEFORE + d : BEFORE + d + size] for k, (x, d) in LOOKS.items()} | {"text": np.repeat(kinds[:, None], size, axis=1)}
    sizes = {k: SIZES[x] for k, (x, _) in LOOKS.items()} | {"text": len(MADE_OF["text"])}
    learned_of = {k: np.zeros((MADE_OF[k].shape[1] if k in MADE_OF else m, 3)) for k, m in sizes.items()} | {"step": np.zeros((3, 3))}

    def tables():
        return {k: MADE_OF[k] @ v if k in MADE_OF else v for k, v in learned_of.items()}

    there = tags != BEYOND
    tags = np.where(there, tags, O)
    one_hot = np.eye(3)[tags]
    seen_step = (np.eye(9)[3 * tags[:, :-1] + tags[:, 1:]] * there[:, 1:, None]).sum(axis=(0, 1)).reshape(3, 3)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in learned_of.items()}
    # Finds are rare among the windows' tokens: nothing is reweighted, the transitions carry their length.
    for r in range(1, rounds + 1):
        w = tables()
        e = sum(w[k][slices[k]] for k in slices)
        forward, backward, scale = np.empty_like(e), np.empty_like(e), np.exp(w["step"])
        x = np.exp(e - e.max(axis=2, keepdims=True))
        forward[:, 0] = x[:, 0] / x[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, size):
            f = (forward[:, t - 1] @ scale) * x[:, t]
            forward[:, t] = np.where(there[:, t, None], f / f.sum(axis=1, keepdims=True), forward[:, t - 1])
        backward[:, -1] = 1
        for t in range(size - 2, -1, -1):
            g = (backward[:, t + 1] * x[:, t + 1]) @ scale.T
            backward[:, t] = np.where(there[:, t + 1, None], g / g.sum(axis=1, keepdims=True), 1.0)
        p = forward * backward
        p /= p.sum(axis=2, keepdims=True)
        pairs = forward[:, :-1, :, None] * scale * (x[:, 1:] * backward[:, 1:])[:, :, None, :]
        pairs /= pairs.sum(axis=(2, 3), keepdims=True)
        gradient = {"step": seen_step - (pairs * there[:, 1:, None, None]).sum(axis=(0, 1))}
        off = ((one_hot - p) * there[:, :, None]).reshape(-1, 3)
        for k in slices:
            at = slices[k].reshape(-1)
            g = np.stack([np.bincount(at, off[:, y], minlength=sizes[k]) for y in range(3)], axis=1)
            gradient[k] = MADE_OF[k].T @ g if k in MADE_OF else g
        for k, g in gradient.items():
            v = learned_of[k]
            g = g / n - l2 * v
            m, q = moments[k]
            m += 0.1 * (g - m)
            q += 0.01 * (g * g - q)
            v += rate * (m / (1 - 0.9**r)) / (np.sqrt(q / (1 - 0.99**r)) + 1e-8)
    return tables()


def with_finds(docs: DataFrame) -> DataFrame:
    """(doc_id, label) of every text: a hash of it, and 1 if a pattern finds something."""

    def work(batches):
        for b in small(batches):
            label = [int(bool(base_spans(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(label, pa.int64())], ["doc_id", "label"])

    return docs.mapInArrow(work, "doc_id bigint, label bigint")


def fit(docs: DataFrame, *, limit: int = 4000, most_windows: int = 6000) -> dict | None:
    """CRF weights learned from at most ``limit`` texts, up to half of them
    from those with finds of all documents, and ``most_windows`` windows of
    them, those with finds first (the documented bounds of the fit); None if
    no pattern has a find in any document."""
    # By the text's hash: rows without an id or with another's count as well.
    keyed = texts(docs).select(F.xxhash64("text").alias("doc_id"), "text")
    marked = written_table(docs.sparkSession, "secrets-finds")(with_finds(keyed))
    half = limit // 2
    positive, rest = (bounded_examples(keyed, marked.filter(F.col("label") == x), "doc_id", "label", n) for x, n in ((1, half), (0, limit - half)))
    rows = positive.unionByName(rest)

    def learn(batches):
        memo, examples = Memo(encoded), []
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                examples += [(doc_id, i, x) for i, x in enumerate(windows(text, memo, 400))]
        examples.sort(key=lambda e: (not (e[2][2] == B).any(), e[1] > 2, hashlib.md5(str(e[0]).encode()).digest(), e[1]))
        examples = [x for *_, x in examples[:most_windows]]
        found = any((tags == B).any() for _, _, tags, _ in examples)
        return trained(examples) if found else None

    return learned(rows, learn, None)


# ---- decoding ---------------------------------------------------------------


def viterbi(e: np.ndarray, step: np.ndarray, before: int | None, after: int | None) -> np.ndarray:
    """Best tags of a run between two known tags (None at a text's end)."""
    score = e[0] + (0 if before is None else step[before])
    back = np.zeros(e.shape, dtype=np.int8)
    for t in range(1, len(e)):
        every = score[:, None] + step
        back[t] = every.argmax(axis=0)
        score = every.max(axis=0) + e[t]
    score = score + (0 if after is None else step[:, after])
    tags = np.empty(len(e), dtype=np.int8)
    tags[-1] = score.argmax()
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def slack(step: np.ndarray) -> float:
    """The most that the transitions around one token can gain when its tag is
    B or I instead of O."""
    gains = [0.0]
    for x in (B, I):
        into, out = step[:, x] - step[:, O], step[x] - step[O]
        gains += [into.max(), out.max(), into.max() + out.max()]
    return float(max(gains))


class Tagger:
    def __init__(self, w: dict):
        self.w, self.memo, self.slack = w, Memo(encoded), slack(w["step"])
        rivals = np.maximum  # of O: the better of B and I, feature by feature, is a bound of both
        self.lead = {k: (w[k][:, O] - rivals(w[k][:, B], w[k][:, I])).astype(np.float32) for k in (*LOOKS, "text")}
        # The least that all but a token's own shape, the cue and the text can add.
        self.least = sum(float(self.lead[k].min()) for k in LOOKS if k not in ("own", "cue"))

    def tags(self, text: str) -> np.ndarray | None:
        """The tags of the text's tokens; None if all are O."""
        arrays = looked_up(text, self.memo)
        n = len(arrays[0]) - BEFORE - AFTER
        if n <= 0:
            return None
        kind, lead, need = text_kind(text), self.lead, self.slack + 1e-3
        own = (lead["own"][arrays[0][BEFORE:-AFTER]] + lead["cue"][arrays[2][BEFORE:-AFTER]]) + lead["text"][kind]
        maybe = np.nonzero(own + self.least <= need)[0]
        for k, (x, d) in LOOKS.items():
            if k not in ("own", "cue") and len(maybe):
                own[maybe] += lead[k][arrays[x][maybe + BEFORE + d]]
        open_at = maybe[own[maybe] <= need]
        if not len(open_at):
            return None
        runs = np.split(open_at, np.nonzero(np.diff(open_at) > 1)[0] + 1)
        out = np.zeros(n, dtype=np.int8)
        for run in runs:
            a, b = int(run[0]), int(run[-1]) + 1
            e = emissions(arrays, a, b, kind, self.w)
            out[a:b] = viterbi(e, self.w["step"], O if a else None, O if b < n else None)
        return out if out.any() else None

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of what the CRF tags, merged from B to the last I."""
        tags = self.tags(text)
        if tags is None:
            return []
        where, found = [m.span() for m in _TOKEN.finditer(text)], []
        for i in np.nonzero(tags)[0].tolist():
            if found and tags[i] == I and tags[i - 1] != O:
                found[-1] = (found[-1][0], 3, where[i][1])
            else:
                found.append((where[i][0], 3, where[i][1]))
        return found


def outside(text: str, span: tuple, base: list) -> list[tuple[int, int, int]]:
    """The parts of a CRF span that no pattern's find covers, from their first
    token to their last; parts without a letter or digit are no secrets."""
    touching = [b for b in base if span[0] < b[2] and b[0] < span[2]]
    if not touching:
        return [span]
    parts, at = [], span[0]
    for a, _, b, *_ in [*touching, (span[2], 0, span[2])]:
        tokens = [m.span() for m in _TOKEN.finditer(text, at, max(at, a))]
        if tokens and any(map(str.isalnum, text[at:a])):
            parts.append((tokens[0][0], span[1], tokens[-1][1]))
        at = max(at, b)
    return parts


def all_spans(text: str, tagger: Tagger | None) -> tuple[list, list]:
    """The patterns' finds, and those with the CRF's further ones."""
    base = base_spans(text)
    more = [s for found in tagger.spans(text) for s in outside(text, found, base)] if tagger else []
    return base, sorted([*base, *more]) if more else base


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def find(docs: DataFrame, w: dict | None) -> DataFrame:
    """One row per document with its numbers of finds and all spans."""

    def work(batches):
        tagger = Tagger(w) if w else None
        for b in small(batches):
            rows = []
            for text in b.column("text").to_pylist():
                base, every = all_spans(text or "", tagger)
                kinds = [s[1] for s in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], *[pa.array(c, pa.string()) for c in cols[3:]]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(work, SCHEMA)


def redacted(text: str, spans: list) -> str:
    """The text with every span, or run of overlapping spans, replaced."""
    out, at = [], 0
    for a, _, b, *_ in spans:
        if b > at:
            out += [text[at:a], REDACTED] if a >= at else []
            at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, w: dict | None) -> DataFrame:
    """The documents with their secrets replaced; n_chars follows the new text."""
    plain = documents(docs)

    def work(batches):
        tagger = Tagger(w) if w else None
        for b in small(batches):
            texts, sizes = b.column("text").to_pylist(), b.column("n_chars").to_pylist()
            for i, text in enumerate(texts):
                spans = all_spans(text, tagger)[1] if text else []
                if spans:
                    texts[i] = redacted(text, spans)
                    sizes[i] = None if sizes[i] is None else len(texts[i])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), b.column("lang"), b.column("source"), pa.array(sizes, pa.int64())], b.schema.names)

    return plain.mapInArrow(work, plain.schema)


def query(docs: DataFrame) -> DataFrame:
    return find(docs, fit(docs))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return redact(docs, fit(docs))
