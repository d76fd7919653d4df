from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomchain.functions import codecs as C


def one(spark, expression, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(expression(F.col("v")).alias("x")).collect()
    return [r.x for r in rows]


def test_big_integers(spark):
    text = ["0", "+007", "-0", "1e+18", "5e20", "1.5e18", "1.5e0", "12.345e1", "1e-3", "9" * 30, None, ""]
    want = ["0", "7", "0", "1" + "0" * 18, "5" + "0" * 20, "15" + "0" * 17, "1", "123", "0", "9" * 30, None, None]
    assert one(spark, C.big_integer, *text) == want
    assert not any(one(spark, C.is_bad_integer, *text))


def test_rendered_integers_keep_every_digit(spark):
    assert one(spark, C.rendered, str(2**256 - 1), "1.5e77", None, "", "007") == [str(2**256 - 1), "15" + "0" * 76, "", "", "7"]


def test_what_is_no_integer(spark):
    text = ["not-a-number", "1.2.3e10", "[]", "{}", "1.5", "5\n", ".e5", "1e401", " 1"]
    assert one(spark, C.big_integer, *text) == [None] * len(text)
    assert all(one(spark, C.is_bad_integer, *text))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(0, 40)), min_size=1, max_size=20))
def test_scientific_notation_truncates_like_decimals(spark, pairs):
    text = [f"{n // 1000}.{n % 1000:03d}e{e}" for n, e in pairs]
    assert one(spark, C.big_integer, *text) == [str(int(Decimal(n) * Decimal(10) ** (e - 3))) for n, e in pairs]


@pytest.mark.parametrize("text, want", [("", "00" * 20), ("0x", "00" * 20), ("0x0", "00" * 20), ("0x1234", "00" * 18 + "1234"), ("ab" * 20, "ab" * 20), ("0x" + "ab" * 21, "ab" * 20), ("0xGGGG", None), (None, "00" * 20)])
def test_hex_bytes(spark, text, want):
    got = one(spark, lambda v: C.hex_bytes(v, 20), text)[0]
    assert (bytes(got).hex() if got is not None else None) == want
    assert one(spark, lambda v: C.is_bad_hex(v, 20), text) == [want is None]


def test_nonce_and_unsigned(spark):
    assert bytes(spark.range(1).select(C.nonce_bytes(F.lit("18446744073709551615").cast("decimal(20,0)"))).first()[0]).hex() == "ff" * 8
    assert [None if x is None else int(x) for x in one(spark, C.unsigned64, "0", str(2**64 - 1), str(2**64), "-1")] == [0, 2**64 - 1, None, None]


def test_sum_of_256_bits(spark):
    df = spark.createDataFrame([(str(2**256 - 1),), (str(2**255),), ("5",)], "v string")
    assert df.select(C.sum_big(F.col("v"))).first()[0] == str(2**256 - 1 + 2**255 + 5)


def test_base64(spark):
    got = one(spark, C.base64_bytes, "aGk=", "", None, "%%")
    assert [None if x is None else bytes(x) for x in got] == [b"hi", b"", b"", None]


def test_checks_of_several_texts_are_those_of_each(spark):
    import itertools

    texts = [None, "", "0x", "7", "1|2", "ab" * 20, "ab" * 20 + "|zz", "0x" + "ab" * 20, "0xzz", "-3e5", "|"]
    rows = spark.createDataFrame(list(itertools.product(texts, texts, texts)), "a string, b string, c string")
    cols = [F.col(c) for c in "abc"]
    each = lambda f, join: join(join(f(cols[0]), f(cols[1])), f(cols[2]))
    either, both = (lambda x, y: x | y), (lambda x, y: x & y)
    pairs = [
        (C.any_bad_integer(cols), each(C.is_bad_integer, either)), (C.any_bad_hex([(c, 20) for c in cols]), each(lambda c: C.is_bad_hex(c, 20), either)),
        (C.all_fixed_hex([(c, 20) for c in cols]), each(lambda c: C.is_fixed_hex(c, 20), both)), (C.all_fixed_hex_of(F.array(*cols), 20), each(lambda c: C.is_fixed_hex(c, 20), both)),
    ]
    for several, single in pairs:
        assert rows.where(~several.eqNullSafe(single)).count() == 0
    assert spark.range(1).select(C.all_fixed_hex_of(F.array().cast("array<string>"), 20), C.all_fixed_hex_of(F.lit(None).cast("array<string>"), 20)).first()[:] == (True, True)
