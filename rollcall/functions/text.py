"""Scalar key functions as Spark column expressions (JVM side, codegen'd).

Null and blank are the same value: every function maps null to ''.
Everything runs in the JVM; the NFKC step of ``norm_email`` calls its ICU, and
only for values that contain a non-ASCII character (see ``unicode.nfkc``).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import schema as S
from rollcall.functions.unicode import nfkc

# --- Fixed values: Python's whitespace set (str.strip / str.isspace / re \s) ---
# as code points: \t \n \v \f \r, FS GS RS US, space, NEL, NBSP, OGHAM SPACE MARK,
# EN QUAD .. HAIR SPACE, LINE SEPARATOR, PARAGRAPH SEPARATOR, NNBSP, MMSP,
# IDEOGRAPHIC SPACE.
WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# Zero-width characters deleted from emails: ZWSP, ZWNJ, ZWJ, BOM.
ZERO_WIDTH_CODEPOINTS = [0x200B, 0x200C, 0x200D, 0xFEFF]
# Characters stripped from both ends of an email after the mailto: prefix.
EMAIL_QUOTE_CHARS = "\"'<>"
# --- end of fixed values ---

WHITESPACE = "".join(map(chr, WHITESPACE_CODEPOINTS))
# Printable ASCII without space, quotes, angle brackets and colon: for such
# values NFKC, trimming, ``mailto:``/quote stripping and deletion are no-ops,
# so the email key is just the lower-cased value.
_PLAIN_EMAIL = r"^[!#-&(-9;=?-~]*\z"
_SPACED_ASCII = r"^[ -~]*\z"
EMAIL_DELETE = WHITESPACE + "".join(map(chr, ZERO_WIDTH_CODEPOINTS))

_NUMERIC = (T.FloatType, T.DoubleType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def _by_name(fn):
    """Build the expression once per column name: each is many JVM calls, and
    plans reuse the same keys. The expressions are kept on the context that
    they belong to and go with it."""

    @functools.wraps(fn)
    def wrapper(c, *args):
        if not isinstance(c, str):
            return fn(c, *args)
        from pyspark import SparkContext

        cache = vars(SparkContext._active_spark_context).setdefault("_rollcall_expressions", {})
        key = (fn.__name__, c, tuple(repr(a) for a in args))
        col = cache.get(key)
        if col is None:
            col = cache[key] = fn(c, *args)
        return col

    return wrapper


def _c(c) -> Column:
    return S.qcol(c) if isinstance(c, str) else c


@_by_name
def text(c) -> Column:
    """Null -> '', anything else as text."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def _strip_text(t: Column) -> Column:
    """Python ``str.strip()`` of a non-null string column.

    Fast path: trim spaces (cheap), and only when another whitespace
    character is left at either end run the full 29-character trim."""
    s = F.trim(t)
    ws = F.lit(WHITESPACE)
    # position('' , ws) is 1 too; the full trim of '' is '' anyway.
    other_ws = (F.position(F.substring(s, 1, 1), ws) > 0) | (F.position(F.substring(s, -1, 1), ws) > 0)
    return F.when(other_ws, F.btrim(s, ws)).otherwise(s)


@_by_name
def strip(c) -> Column:
    """Unicode trim with Python's whitespace set; null -> ''."""
    return _strip_text(text(c))


@_by_name
def fold(c) -> Column:
    """Trimmed and lower-cased (zone, local id, name comparisons)."""
    return F.lower(strip(c))


def norm_local(c) -> Column:
    return fold(c)


fold_name = fold


@_by_name
def norm_id(c, data_type: T.DataType | None = None) -> Column:
    """Global id key: trim, then drop a final ``.0`` when only digits precede it.

    Numeric inputs (ids read as floats) follow the float rule instead:
    NaN -> '', integral value -> integer text, anything else -> its text.
    """
    col = _c(c)
    if isinstance(data_type, _NUMERIC):
        integral = (col == F.floor(col)) & (F.abs(col) < F.lit(1e38))
        return (
            F.when(col.isNull() | F.isnan(col), F.lit(""))
            .when(integral, col.cast("decimal(38,0)").cast("string"))
            .otherwise(strip(col))
        )
    if isinstance(data_type, _INTEGRAL):
        return text(col)
    # One regex pass, but only over values that end in ``.0``.
    t = strip(col)
    return F.when(t.endswith(".0"), F.regexp_replace(t, r"^(\p{Nd}+)\.0\z", "$1")).otherwise(t)


@_by_name
def norm_email(c) -> Column:
    """Email key: NFKC, trim, lower, one ``mailto:`` dropped, trim, outer
    quote/angle characters dropped, trim, then every whitespace or zero-width
    character deleted wherever it is."""
    raw = text(c)
    # Slow path for everything else; each step reads its input once, so the
    # expression stays linear in size.
    ws = F.lit(WHITESPACE)
    s = F.lower(F.btrim(nfkc(raw), ws))
    s = F.regexp_replace(s, "^" + S.MAILTO_PREFIX, "")
    s = F.btrim(F.btrim(F.btrim(s, ws), F.lit(EMAIL_QUOTE_CHARS)), ws)
    full = F.translate(s, EMAIL_DELETE, "")
    # Printable ASCII with spaces: NFKC is a no-op and the space is the only
    # whitespace, so trimming is ``trim`` and deletion is ``replace``.
    m = F.lower(F.trim(raw))
    m = F.regexp_replace(m, "^" + S.MAILTO_PREFIX, "")
    m = F.replace(F.trim(F.btrim(F.trim(m), F.lit(EMAIL_QUOTE_CHARS))), F.lit(" "), F.lit(""))
    return (
        F.when(raw.rlike(_PLAIN_EMAIL), F.lower(raw))
        .when(raw.rlike(_SPACED_ASCII), m)
        .otherwise(full)
    )


@_by_name
def valid_email_predicate(c) -> Column:
    """Filter form: null for null input (dropped by ``filter``), so the
    ``contains('@')`` part pushes down to parquet as StringContains."""
    col = _c(c).cast("string")
    # Case-insensitive ``noemail@`` as Python's re.IGNORECASE sees it. Lower-
    # casing agrees except for dotted and dotless i, which take the regex.
    marker = F.lower(col).contains(S.NOEMAIL_MARKER) | (
        (col.contains("\u0130") | col.contains("\u0131")) & col.rlike("(?iu)" + S.NOEMAIL_MARKER)
    )
    return col.contains("@") & ~marker


@_by_name
def valid_email(c) -> Column:
    """Usable email: contains ``@`` and no ``noemail@`` (any case); null -> false.
    (Containing ``@`` already implies non-blank after trimming.)"""
    return F.coalesce(valid_email_predicate(c), F.lit(False))


@_by_name
def email_local_part(c) -> Column:
    """Text before the first ``@`` (all of it when there is none)."""
    return F.substring_index(text(c), "@", 1)


@_by_name
def strip_leading_zeros(c) -> Column:
    return F.regexp_replace(text(c), "^0+", "")


ACT_VALIDATE, ACT_NOOP, ACT_REMOVE = "validate", "noop", "remove"


@_by_name
def action_class(c) -> Column:
    """``ok`` (any case, trimmed) validates, blank is a no-op, anything else removes.
    ``c=None`` means the roster has no action column: every row validates."""
    if c is None:
        return F.lit(ACT_VALIDATE)
    a = strip(c)
    return (
        F.when(F.lower(a) == S.ACTION_OK, F.lit(ACT_VALIDATE))
        .when(a == "", F.lit(ACT_NOOP))
        .otherwise(F.lit(ACT_REMOVE))
    )


def in_zone(zone_col, zone: str) -> Column:
    """Row's zone equals ``zone`` after trimming and lower-casing both."""
    return fold(zone_col) == F.lit(str(zone).strip().lower())


def norm_id_of(df, name: str) -> Column:
    """``norm_id`` for a column of ``df``, choosing the rule by its type."""
    return norm_id(F.col(name), df.schema[name].dataType)
