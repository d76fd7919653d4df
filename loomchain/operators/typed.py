"""Decoding that knows how a value was written: numbers, text and the rest are told apart.

Every leaf is read as VARIANT, whose type says what stood in the message.  Counts must be whole numbers, text must be text, and marks must be true or false; what is
written otherwise makes a message ``malformed_json``, as a typed reader has it.  Big integers may be either: as text they are read exactly, as a number they
go through a double, digits beyond its precision included.

Leaves that are absent or null have no type and are right.  Names that no message has are not looked at, whatever they hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomchain.operators import decode as D
from loomchain.sources import schemas as S

#: Big integers, which are text or numbers.
BIG = ("evmChainId", "number", "baseFeePerGas", "difficulty", "value", "gasPrice", "maxFeePerGas", "maxPriorityFeePerGas")
_COUNT = r"BIGINT|DECIMAL\(\d+,0\)|VOID"
#: Doubles below this are split into two longs exactly.
_SPLIT = float(1 << 125)


def _variants(kind: T.DataType) -> T.DataType:
    """The same shape with a VARIANT for each leaf."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _variants(f.dataType)) for f in kind.fields if f.name != S.CORRUPT])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_variants(kind.elementType))
    return T.VariantType()


def typed_blocks(messages: DataFrame) -> DataFrame:
    """Adds ``leaves``, the record with a VARIANT for each leaf; NULL if the message is no JSON of that shape."""
    shape = _variants(S.struct_of(S.BLOCK))
    shape.add(S.CORRUPT, T.StringType())
    return messages.select("*", F.explode(F.array(F.from_json("value", shape, {"columnNameOfCorruptRecord": S.CORRUPT}))).alias("leaves"))


def _wrong(leaf: Column, name: str, kind: T.DataType) -> Column:
    """Whether a leaf is there and not written as its kind asks."""
    if isinstance(kind, T.DecimalType | T.IntegralType):
        wanted = _COUNT
    elif isinstance(kind, T.BooleanType):
        wanted = "BOOLEAN|VOID"
    else:
        wanted = r"STRING|VOID|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)" if name in BIG else "STRING|VOID"
    return ~F.coalesce(F.schema_of_variant(leaf), F.lit("VOID")).rlike(f"^({wanted})$")


def _any_wrong(value: Column, name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        parts = [_any_wrong(value[f.name], f.name, f.dataType) for f in kind.fields if f.name != S.CORRUPT]
        found = parts[0]
        for p in parts[1:]:
            found = found | p
        return value.isNotNull() & found
    if isinstance(kind, T.ArrayType):
        of: Callable[[Column], Column] = lambda x: _any_wrong(x, name, kind.elementType)
        return F.coalesce(F.exists(value, of), F.lit(False))
    return _wrong(value, name, kind)


def mistyped() -> Column:
    """Whether a message with ``leaves`` has a leaf that is written as another type."""
    leaves = F.col("leaves")
    return leaves.isNull() | leaves[S.CORRUPT].isNotNull() | _any_wrong(leaves, "", S.struct_of(S.BLOCK))


def through_double(number: Column) -> Column:
    """The whole number of a double as text, all digits of the double; above 2**125 those of its shortest decimal form."""
    whole = F.when(number < 0, F.ceil(number.cast("double"))).otherwise(F.floor(number.cast("double")))
    size = F.abs(number)
    high = F.floor(size / float(1 << 62))
    low = size - high.cast("double") * float(1 << 62)
    exact = high.cast("decimal(19,0)") * F.lit(str(1 << 62)).cast("decimal(19,0)") + F.floor(low).cast("decimal(19,0)")
    text = F.concat(F.when(number < 0, "-").otherwise(""), exact.cast("decimal(38,0)").cast("string"))
    return F.when(size < float(1 << 62), whole.cast("bigint").cast("string")).when(size < _SPLIT, text).otherwise(D.C.big_integer(number.cast("string")))


def big_leaf(leaf: Column) -> Column:
    """A big integer of VARIANT as text that ``big_integer`` reads: text stays, a number goes through a double; NULL and the empty text are none."""
    kind = F.schema_of_variant(leaf)
    return F.when(kind == "STRING", F.try_variant_get(leaf, "$", "string")).when(kind != "VOID", through_double(F.try_variant_get(leaf, "$", "double")))


def classify(messages: DataFrame) -> DataFrame:
    """``decode.classify`` with types: mistyped messages are ``malformed_json``; missing values and broken JSON are so before."""
    known = D.classify(messages)
    found = typed_blocks(known)
    bad = F.when(F.col("error_class").isNull() | ~F.col("error_class").isin("nil_message", "malformed_json"), mistyped()).otherwise(F.lit(False))
    return found.withColumn("error_class", F.when(bad, "malformed_json").otherwise(F.col("error_class")))


def with_doubles(classified: DataFrame) -> DataFrame:
    """Big integers of the block that were numbers in the message, put through a double; those of transactions alike, in place."""
    block, leaves = F.col("block"), F.col("leaves")
    own = [n for n in BIG if n in {f.name for f in S.struct_of(S.BLOCK).fields}]
    fixed = block
    for n in own:
        fixed = fixed.withField(n, big_leaf(leaves[n]))
    inner = ("value", "gasPrice", "maxFeePerGas", "maxPriorityFeePerGas")

    def put(t: Column, x: Column) -> Column:
        for n in inner:
            t = t.withField(n, big_leaf(x[n]))
        return t

    txs = F.when(block["transactions"].isNotNull(), F.zip_with(block["transactions"], leaves["transactions"], put))
    return classified.withColumn("block", fixed.withField("transactions", txs)).drop("leaves")
