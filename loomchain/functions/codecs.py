"""Column expressions of the decode job: hex and base64 bytes, exact big integers, nonces, times, defaults.

All of them are built-in expressions, so they stay inside generated code.  Bad input gives NULL, which the classification of
messages turns into an error class; nothing here fails a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits of 2**256 - 1.
MAX_DIGITS = 78
#: Largest shift that an exponent may ask for; beyond it no value fits 256 bits.
MAX_EXPONENT = 400

_CANONICAL = "^(0|[1-9][0-9]*)\\z"
_PLAIN = "^[+-]?[0-9]+\\z"
_SCIENTIFIC = "^([+-]?)([0-9]*)[.]?([0-9]*)[eE]([+-]?[0-9]{1,6})\\z"
#: Both forms, the exponent within its bound.
_DIGITS = "[+-]?([0-9]+|([0-9]+[.]?[0-9]*|[.][0-9]+)[eE](-[0-9]{1,6}|[+]?0{0,3}([0-3]?[0-9]{1,2}|400)))"
_NUMBER = f"^{_DIGITS}\\z"


def hex_bytes(text: Column, size: int) -> Column:
    """Fixed-size bytes: one leading 0x goes, short input is padded on the left, long input keeps its left part, none is zeros."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), "^0x", "")
    return F.try_to_binary(F.lpad(digits, 2 * size, "0"), F.lit("hex"))


def hex_text(value: Column) -> Column:
    """Bytes as lower-case hex with 0x."""
    return F.lower(F.concat(F.lit("0x"), F.hex(value)))


def is_fixed_hex(text: Column, size: int) -> Column:
    """0x and exactly so many bytes."""
    return F.coalesce(text.rlike(f"^0x[0-9a-fA-F]{{{2 * size}}}\\z"), F.lit(False))


def _canonical(sign: Column, digits: Column) -> Column:
    bare = F.regexp_replace(digits, "^0+", "")
    return F.when(bare == "", "0").otherwise(F.concat(F.when(sign == "-", "-").otherwise(""), bare))


def big_integer(text: Column) -> Column:
    """Decimal text without leading zeros or plus sign; scientific notation is shifted as text and truncated toward zero.

    NULL and the empty text give NULL, and so does anything that is not a number (see ``is_bad_integer``).
    """
    part = lambda i: F.regexp_extract(text, _SCIENTIFIC, i)
    exponent = part(4).try_cast("int")
    digits, length = F.concat(part(2), part(3)), F.length(part(2)) + exponent
    shifted = F.when(length <= 0, "0").otherwise(F.rpad(digits, F.greatest(length, F.lit(0)), "0"))
    return (
        F.when(text.rlike(_CANONICAL), text)  # as nearly all are
        .when(text.rlike(_PLAIN), _canonical(F.substring(text, 1, 1), F.regexp_replace(text, "^[+-]", "")))
        .when(text.rlike(_SCIENTIFIC) & (digits != "") & (exponent <= MAX_EXPONENT), _canonical(part(1), shifted))
    )


def is_bad_integer(text: Column) -> Column:
    """Neither absent nor a number, by one match: classification asks this of every integer of a message."""
    return F.coalesce((text != "") & ~text.rlike(_NUMBER), F.lit(False))


def is_bad_hex(text: Column, size: int) -> Column:
    """Where ``hex_bytes`` gives NULL: a character that is no hex digit in the part that is kept."""
    return F.coalesce(~text.rlike(f"(?s)^(0x)?([0-9a-fA-F]{{0,{2 * size - 1}}}|[0-9a-fA-F]{{{2 * size}}}.*)\\z"), F.lit(False))


def _joined(texts: list[Column]) -> Column:
    return F.concat_ws("|", *(F.coalesce(t, F.lit("")) for t in texts))


def any_bad_integer(texts: list[Column]) -> Column:
    """Whether one of them is bad, by one match where none is; a text that holds the separator fails that match and is asked alone."""
    some = is_bad_integer(texts[0])
    for t in texts[1:]:
        some = some | is_bad_integer(t)
    return ~_joined(texts).rlike("^" + "[|]".join([f"({_DIGITS})?"] * len(texts)) + "\\z") & some


def any_bad_hex(texts: list[tuple[Column, int]]) -> Column:
    """The same for ``is_bad_hex`` of texts with their sizes."""
    some = is_bad_hex(*texts[0])
    for t, size in texts[1:]:
        some = some | is_bad_hex(t, size)
    good = "[|]".join(f"(0x)?([0-9a-fA-F]{{0,{2 * size - 1}}}|[0-9a-fA-F]{{{2 * size}}}[^|]*)" for _, size in texts)
    return ~_joined([t for t, _ in texts]).rlike(f"^{good}\\z") & some


def all_fixed_hex(texts: list[tuple[Column, int]]) -> Column:
    """Whether each is 0x and exactly so many bytes, by one match."""
    return _joined([t for t, _ in texts]).rlike("^" + "[|]".join(f"0x[0-9a-fA-F]{{{2 * size}}}" for _, size in texts) + "\\z")


def all_fixed_hex_of(texts: Column, size: int) -> Column:
    """The same for all elements of an array, which may be empty."""
    one = f"0x[0-9a-fA-F]{{{2 * size}}}"
    return F.coalesce(F.size(texts) <= 0, F.lit(True)) | F.array_join(texts, "|", "-").rlike(f"^{one}([|]{one})*\\z")


def small_decimal(text: Column) -> Column:
    """The companion number of a big integer's text, where it fits 38 digits."""
    return text.try_cast("decimal(38,0)")


def rendered(text: Column) -> Column:
    """A big integer as messages carry it: its canonical digits, however many, and the empty text where there is none."""
    return F.coalesce(big_integer(text), F.lit(""))


def order_key(text: Column) -> Column:
    """Sorts non-negative big integers as text."""
    return F.lpad(text, MAX_DIGITS, "0")


def sum_big(text: Column) -> Column:
    """Exact sum of non-negative big integers of any size, as text: five limbs of 18 digits, carried at the end."""
    padded = F.lpad(text, 90, "0")
    limbs = [F.coalesce(F.sum(F.substring(padded, 1 + 18 * i, 18).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for i in range(5)]
    base = F.lit(10**18).cast("decimal(19,0)")
    carry, out = F.lit(0).cast("decimal(38,0)"), []
    for limb in reversed(limbs):
        now = (limb + carry).cast("decimal(38,0)")
        out.append(F.lpad((now % base).cast("string"), 18, "0"))
        carry = ((now - now % base) / base).cast("decimal(38,0)")
    return _canonical(F.lit(""), F.concat(carry.cast("string"), *reversed(out)))


def nonce_bytes(nonce: Column) -> Column:
    """An unsigned number as eight bytes."""
    return F.to_binary(F.lpad(F.conv(nonce.cast("string"), 10, 16), 16, "0"), F.lit("hex"))


def block_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.cast("bigint"))


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def or_zero(text: Column) -> Column:
    """Canonical text of a big integer that counts as zero when absent."""
    return F.coalesce(big_integer(text), F.lit("0"))


def base64_bytes(text: Column) -> Column:
    return F.try_to_binary(F.coalesce(text, F.lit("")), F.lit("base64"))


def unsigned64(text: Column) -> Column:
    """A big integer as an unsigned 64-bit number; NULL when out of range."""
    value = big_integer(text).try_cast("decimal(38,0)")
    return F.when((value >= 0) & (value < F.lit(str(1 << 64)).cast("decimal(20,0)")), value.cast("decimal(20,0)"))
