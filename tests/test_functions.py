"""Scalar goldens for the key functions, including Unicode whitespace,
zero-width characters, NFKC and the order quirks of the email key."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.functions import (
    action_class,
    email_local_part,
    fold_name,
    norm_email,
    norm_id,
    norm_local,
    strip,
    strip_leading_zeros,
    valid_email,
)
from rollcall.functions.text import WHITESPACE


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


EMAIL_CASES = [
    (" mailto:Ann@X.com ", "ann@x.com"),
    ('"<mailto:a@b.c>"', "mailto:a@b.c"),
    ('< "a@b.c" >', '"a@b.c"'),
    ("a​@﻿b.c", "a@b.c"),
    ("a b@c.d", "ab@c.d"),
    ("\x1ca@b\x85", "a@b"),
    ('"<>"', ""),
    (None, ""),
    ("Ａ＠Ｂ．com", "a@b.com"),
    ("MAILTO:x@y.z", "x@y.z"),
    ("　mailto: q@r.s ", "q@r.s"),
]


def test_norm_email(spark):
    got = _eval(spark, [c[0] for c in EMAIL_CASES], norm_email)
    assert got == [c[1] for c in EMAIL_CASES]


def test_norm_email_properties_on_decorated_text(spark):
    """A key decorated in the ways that the rule undoes comes back as it was;
    no key holds white space or capitals, and a key of a plain value is stable."""
    import random

    rnd = random.Random(7)
    blank = lambda: "".join(rnd.choice(WHITESPACE) for _ in range(rnd.randint(0, 2)))
    inside = list(WHITESPACE) + ["​", "‌", "‍", "﻿"]
    wide = {c: chr(ord(c) + 0xFEE0) for c in "abcdxyz019@."}  # full-width forms, folded by NFKC
    keys, raw = [], []
    for _ in range(400):
        k = "".join(rnd.choice("abcdxyz019") for _ in range(rnd.randint(1, 6))) + "@" + "".join(rnd.choice("abc.xyz") for _ in range(rnd.randint(1, 6)))
        out = "".join((c.upper() if rnd.random() < 0.3 else wide.get(c, c) if rnd.random() < 0.3 else c) + (rnd.choice(inside) if rnd.random() < 0.2 else "") for c in k)
        out = "".join(rnd.choice("\"'<>") for _ in range(rnd.randint(0, 2))) + out + "".join(rnd.choice("\"'<>") for _ in range(rnd.randint(0, 2)))
        raw.append(blank() + rnd.choice(["", "mailto:", "MailTo:"]) + blank() + out + blank())
        keys.append(k)
    assert _eval(spark, raw, norm_email) == keys
    assert _eval(spark, keys, norm_email) == keys


ID_CASES = [
    ("12345.0", "12345"), (" 007 ", "007"), ("-5.0", "-5.0"), ("12345.00", "12345.00"),
    ("12.5", "12.5"), (".0", ".0"), ("E5.0", "E5.0"), (None, ""), (" 100.0　", "100"),
]


def test_norm_id(spark):
    assert _eval(spark, [c[0] for c in ID_CASES], norm_id) == [c[1] for c in ID_CASES]


def test_norm_id_numeric(spark):
    got = _eval(spark, [1e16, 12345.0, -5.0, 12.5, float("nan"), None], lambda c: norm_id(c, c_type()), "double")
    assert got == ["10000000000000000", "12345", "-5", "12.5", "", ""]


def c_type():
    from pyspark.sql.types import DoubleType

    return DoubleType()


def test_norm_local_and_fold(spark):
    assert _eval(spark, [" EUR-600101 ", None, " Ab "], norm_local) == ["eur-600101", "", "ab"]
    assert _eval(spark, ["  Lee ", None], fold_name) == ["lee", ""]


@pytest.mark.parametrize(
    "value,ok",
    [("a@b", True), (" ", False), ("", False), (None, False), ("noat", False),
     ("NoEmail@x", False), ("x-noemail@y", False), ("NOEMAİL@x", False)],
)
def test_valid_email(spark, value, ok):
    assert _eval(spark, [value], valid_email) == [ok]


def test_strip_is_python_strip(spark):
    values = [WHITESPACE + "x y" + WHITESPACE, "​x​", None, "\x1c\x1d"]
    assert _eval(spark, values, strip) == [(v or "").strip() for v in values]


def test_small_helpers(spark):
    assert _eval(spark, ["ab@c@d", "noat", ""], email_local_part) == ["ab", "noat", ""]
    assert _eval(spark, ["00111", "000", "10"], strip_leading_zeros) == ["111", "", "10"]
    assert _eval(spark, ["ok", " OK ", "", "  ", "Left", None], action_class) == [
        "validate", "validate", "noop", "noop", "remove", "noop"]


def _random_values(seed, alphabet, n=400, size=10):
    import random

    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, size))) for _ in range(n)] + [None]


def test_strip_random(spark):
    values = _random_values(1, list("ab ") + list(WHITESPACE) + ["​", "é"])
    assert _eval(spark, values, strip) == [(v or "").strip() for v in values]


def test_norm_id_random(spark):
    import random

    rnd = random.Random(2)
    digits = ["".join(rnd.choice("0123٣") for _ in range(rnd.randint(1, 6))) for _ in range(200)]
    other = ["x1", "1.5", "-7", "1.0.0", "a.0", ".0", "0.00", "1 .0"]
    blank = lambda: "".join(rnd.choice("\n\r ") for _ in range(rnd.randint(0, 2)))
    want = digits + other
    raw = [blank() + d + rnd.choice(["", ".0"]) + blank() for d in digits] + [blank() + o + blank() for o in other]
    got = _eval(spark, raw, norm_id)
    assert got[: len(digits)] == digits
    assert got[len(digits) :] == ["x1", "1.5", "-7", "1.0.0", "a.0", ".0", "0.00", "1 .0"] == want[len(digits) :]


def test_valid_email_by_hand(spark):
    """Values of known kinds in random dress: usable addresses, placeholders, and texts without an address."""
    rng = random.Random(3)
    spaces = ["", " ", "\t", "\u00a0 "]
    usable = ["a@b", "ann@corp.com", "@", "noemai@x", "no email@x", "noemail @x", "n\u00f6email@z", "x@noemail", "a@b@c"]
    placeholder = ["noemail@x", "NoEmail@corp.com", "x-NOEMAIL@y", "a@noemail@b", "noema\u0130l@x", "NOEMA\u0131L@y", "noemail@"]
    neither = ["", "noat", "noemail", "corp.com", "\u00a0"]
    dressed = [(rng.choice(spaces) + v + rng.choice(spaces), want) for group, want in ((usable, True), (placeholder, False), (neither, False)) for v in group * 4]
    assert _eval(spark, [v for v, _ in dressed] + [None], valid_email) == [want for _, want in dressed] + [False]
