"""Exact decimals: typing, rescaling, texts and storage bytes.

Everything here is a JVM-side column expression. Overflow and bad text are
errors, never nulls, whether or not the session is in ANSI mode (the default).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, DoubleType, FloatType, StringType

from tablesync.operators.columns import quoted, resolve

# The widest decimal there is, and the widest stored at a fixed length.
MAX_PRECISION = 38
MAX_FIXED_PRECISION = 18
# Any decimal of this many digits survives a trip through a double.
MAX_DOUBLE_DIGITS = 15


def fixed_length(precision: int) -> int:
    """Bytes that hold every signed number of ``precision`` digits."""
    _check(precision, 0)
    return ((10**precision - 1).bit_length() + 8) // 8


def _check(precision: int | None, scale: int | None) -> None:
    if not precision or precision < 1 or scale is None or not 0 <= scale <= precision:
        raise ValueError(f"not a decimal type: decimal({precision},{scale})")
    if precision > MAX_PRECISION:
        raise ValueError(f"decimal({precision},{scale}) is wider than {MAX_PRECISION} digits")


def _decimal_columns(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    if columns is None:
        return [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    names = [resolve(df, c) for c in columns]
    for name in names:
        if not isinstance(df.schema[name].dataType, DecimalType):
            raise ValueError(f"column {name!r} is not a decimal")
    return names


def exact_or_fail(before: Column, after: Column, name: str, kind: str, compare_as: str | None = None) -> Column:
    """``after``, or an error where it is not the same value as ``before``."""
    same = after.cast(compare_as) if compare_as else after
    message = F.concat(F.lit(f"column {name}: "), before.cast("string"), F.lit(f" is not exact as {kind}"))
    return F.when(before.eqNullSafe(same), after).otherwise(F.raise_error(message))


def decimal_typed(
    df: DataFrame, types: Mapping[str, tuple[int, int]], as_string: bool = False
) -> DataFrame:
    """Columns as exact ``decimal(p,s)``.

    A value that would lose digits is an error: a decimal or text with too many
    digits, or a float that is not the nearest float of its decimal. A type wider
    than 38 digits is an error too, unless ``as_string`` keeps the column as text.
    """
    typed = {}
    for name, (precision, scale) in types.items():
        col = resolve(df, name)
        if as_string and precision is not None and precision > MAX_PRECISION:
            typed[col] = quoted(col).cast("string")
            continue
        _check(precision, scale)
        typed[col] = exact_decimal(df, col, precision, scale)
    return df.withColumns(typed)


def exact_decimal(df: DataFrame, col: str, precision: int, scale: int) -> Column:
    """The column as ``decimal(p,s)``; a value that would lose digits fails the job."""
    source, target = df.schema[col].dataType, f"decimal({precision},{scale})"
    value = quoted(col)
    if isinstance(source, DecimalType):
        return _rescaled(value, source, precision, scale, col)
    if isinstance(source, DoubleType) and precision <= MAX_DOUBLE_DIGITS:
        return _from_double(value, precision, scale, col)
    if isinstance(source, (FloatType, DoubleType)):
        return exact_or_fail(value, value.cast(target), col, target, source.simpleString())
    if isinstance(source, StringType):
        # parse with all the fraction digits there is room for, then drop only zeros
        wide = DecimalType(MAX_PRECISION, MAX_PRECISION - (precision - scale))
        fraction = F.rtrim(F.regexp_extract(value, r"\.(\d*)", 1), F.lit("0"))
        exponent = F.regexp_extract(value, r"[eE]([+-]?\d+)\s*$", 1).try_cast("int")
        too_long = F.length(fraction) - F.coalesce(exponent, F.lit(0)) > wide.scale
        parsed = value.try_cast(wide)
        message = F.concat(F.lit(f"column {col}: "), value, F.lit(f" is not exact as {target}"))
        checked = F.when(too_long | (value.isNotNull() & parsed.isNull()), F.raise_error(message)).otherwise(parsed)
        return _rescaled(checked, wide, precision, scale, col)
    return exact_or_fail(value, value.cast(target), col, target)


def _from_double(value: Column, precision: int, scale: int, name: str) -> Column:
    """Through a whole number of units rather than Spark's cast, which goes by way of text.

    A double stands for at most one decimal of 15 digits. Scaling it up is off by
    less than a quarter of a unit, so rounding finds that decimal's digits, and
    dividing them again gives the same double only if nothing was lost.
    """
    target = f"decimal({precision},{scale})"
    factor = F.lit(float(10**scale))
    units = F.rint(value * factor)
    # the range test also fails NaN, which equals itself here
    exact = (F.abs(units) < F.lit(float(10**precision))) & (units / factor == value)
    whole = units.cast("bigint").cast(f"decimal({precision},0)")
    message = F.concat(F.lit(f"column {name}: "), value.cast("string"), F.lit(f" is not exact as {target}"))
    return (
        F.when(exact, _scaled_down(whole, scale).cast(target))
        .when(value.isNotNull(), F.raise_error(message))
        .otherwise(F.lit(None).cast(target))
    )


def _scaled_down(whole: Column, scale: int) -> Column:
    if scale == 0:
        return whole
    return whole * F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale},{scale})")


def _rescaled(value: Column, source: DecimalType, precision: int, scale: int, name: str) -> Column:
    target = f"decimal({precision},{scale})"
    cast = value.cast(target)
    fits = scale >= source.scale and precision - scale >= source.precision - source.scale
    return cast if fits else exact_or_fail(value, cast, name, target)


def decimal_rescale_exact(df: DataFrame, types: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Set the scale of decimal columns: zeros may be added or dropped, other digits not.

    A plain cast would round 1.239 to 1.24 in silence.
    """
    scaled = {}
    for name, (precision, scale) in types.items():
        _check(precision, scale)
        (col,) = _decimal_columns(df, [name])
        scaled[col] = _rescaled(quoted(col), df.schema[col].dataType, precision, scale, col)
    return df.withColumns(scaled)


def decimal_layout(df: DataFrame) -> DataFrame:
    """How each decimal column is stored, and how much of that its values use.

    ``column_name, precision, scale, storage, byte_length, rows, nulls,
    digits_used``. One aggregate pass with map-side combining; ``byte_length`` is
    null where the length varies.
    """
    columns = _decimal_columns(df, None)
    if not columns:
        raise ValueError("no decimal columns")
    aggs = [F.count("*").alias("rows")]
    for i, name in enumerate(columns):
        aggs += [F.count(quoted(name)).alias(f"filled_{i}"), F.max(F.abs(quoted(name))).alias(f"top_{i}")]
    entries = []
    for i, name in enumerate(columns):
        kind = df.schema[name].dataType
        is_fixed = kind.precision <= MAX_FIXED_PRECISION
        digits = F.ltrim(F.regexp_replace(F.col(f"top_{i}").cast("string"), r"\.", ""), F.lit("0"))
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind.precision).alias("precision"),
                F.lit(kind.scale).alias("scale"),
                F.lit("FIXED" if is_fixed else "BYTES").alias("storage"),
                F.lit(fixed_length(kind.precision) if is_fixed else None).cast("int").alias("byte_length"),
                F.col("rows").alias("rows"),
                (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
                # null for an all-null column: greatest() would skip the null
                F.when(digits.isNotNull(), F.greatest(F.length(digits), F.lit(1))).alias("digits_used"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def plain_string(df: DataFrame, col: str) -> Column:
    """Digits without an exponent. ANSI mode's cast gives that, the other mode's does not."""
    ansi = df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    return _plain(quoted(col), df.schema[col].dataType, exponents=not ansi)


def _plain(value: Column, kind: DecimalType, exponents: bool) -> Column:
    """``exponents`` says that the session's cast to text may print them."""
    if not exponents:
        return value.cast("string")
    pattern = "0" + ("." + "0" * kind.scale if kind.scale else "")
    return F.call_function("format_number", value, F.lit(pattern))


def java_string(df: DataFrame, col: str) -> Column:
    """Like the plain string, but with an exponent where that would be below -6.

    That is: numbers under 0.000001 (zero included) of a scale above 6. All their
    digits stand in the fraction.
    """
    value, plain, scale = quoted(col), plain_string(df, col), df.schema[col].dataType.scale
    if scale <= 6:
        return plain
    digits = F.ltrim(F.substring_index(plain, ".", -1), F.lit("0"))
    digits = F.when(digits == "", "0").otherwise(digits)
    rest = F.substr(digits, F.lit(2))
    scientific = F.concat(
        F.when(plain.startswith("-"), "-").otherwise(""),
        F.left(digits, F.lit(1)),
        F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)),
        F.lit("E"),
        (F.length(digits) - 1 - F.lit(scale)).cast("string"),
    )
    return F.when(F.abs(value) < F.lit(Decimal("0.000001")), scientific).otherwise(plain)


def decimal_to_plain_string(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Decimal columns as plain text; all of them by default."""
    return df.withColumns({c: plain_string(df, c) for c in _decimal_columns(df, columns)})


def decimal_to_java_string(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Decimal columns as text that is scientific for tiny values."""
    return df.withColumns({c: java_string(df, c) for c in _decimal_columns(df, columns)})


def to_fixed(value: Column, precision: int, scale: int) -> Column:
    """Unscaled value as big-endian two's complement of the precision's fixed length."""
    if precision > MAX_FIXED_PRECISION:
        raise ValueError(f"only decimals up to {MAX_FIXED_PRECISION} digits have a fixed length")
    length = fixed_length(precision)
    unscaled = (value * F.lit(Decimal(10**scale)).cast(f"decimal({scale + 1},0)")).cast("bigint")
    if length == 8:
        return F.unhex(F.lpad(F.hex(unscaled), 16, "0"))
    # a one above the kept bytes makes hex() print all their digits, leading zeros too
    marker = 1 << (8 * length)
    digits = F.hex(unscaled.bitwiseAND(F.lit(marker - 1)).bitwiseOR(F.lit(marker)))
    return F.unhex(F.substring(digits, 2, 2 * length))


def from_fixed(value: Column, precision: int, scale: int) -> Column:
    """The inverse of :func:`to_fixed`, for any length.

    Bytes before the last eight may only repeat the sign. Empty bytes, and numbers that do not fit
    the type, are errors with and without ANSI mode.
    """
    if precision > MAX_FIXED_PRECISION:
        raise ValueError(f"only decimals up to {MAX_FIXED_PRECISION} digits have a fixed length")
    digits = F.hex(value)
    sign = F.when(F.left(digits, F.lit(1)) >= "8", "F").otherwise("0")
    padded = F.when(F.length(digits) < 16, F.lpad(digits, 16, sign)).otherwise(digits)
    last = F.right(padded, F.lit(16))
    surplus = F.left(padded, F.length(padded) - 16)
    only_sign = (F.replace(surplus, sign, F.lit("")) == "") & ((F.left(last, F.lit(1)) >= "8") == (sign == "F"))
    # base -10 reads the 16 digits as a signed number; all of them fit 19 digits
    unscaled = F.conv(last, 16, -10).cast("decimal(19,0)")
    limit = F.lit(Decimal(10**precision)).cast("decimal(19,0)")
    fits = (digits != "") & only_sign & (unscaled < limit) & (unscaled > -limit)
    text = F.concat(F.lit("bytes do not fit decimal("), F.lit(f"{precision},{scale}): "), digits)
    whole = F.when(digits.isNull() | fits, unscaled).otherwise(F.raise_error(text).cast("decimal(19,0)"))
    return _scaled_down(whole.cast("decimal(18,0)"), scale).cast(f"decimal({precision},{scale})")


# Half of 16 bytes is a long; above it stand multiples of this.
_LIMB = 2**64


def to_wide(value: Column, precision: int, scale: int) -> Column:
    """Unscaled value as 16 bytes of big-endian two's complement, for up to 38 digits."""
    unscaled = _unscaled(value, precision, scale)
    negative = unscaled < 0
    # -1 - v has the complement of v's bits; a plain minus sign would round to 34 digits
    rest = F.when(negative, F.lit(Decimal(-1)).cast("decimal(38,0)") - unscaled).otherwise(unscaled)
    limb = F.lit(Decimal(_LIMB)).cast("decimal(20,0)")
    high, low = F.call_function("div", rest, limb), (rest % limb).cast("decimal(20,0)")
    # a long holds the upper half of its unsigned range as numbers below zero
    above = F.when(low >= F.lit(Decimal(_LIMB // 2)).cast("decimal(20,0)"), limb).otherwise(F.lit(Decimal(0)).cast("decimal(20,0)"))
    # exclusive or with -1 is the complement
    mask = F.when(negative, F.lit(-1)).otherwise(F.lit(0)).cast("bigint")
    halves = [F.lpad(F.hex(part.bitwiseXOR(mask)), 16, "0") for part in (high, (low - above).cast("bigint"))]
    return F.unhex(F.concat(*halves))


def _unscaled(value: Column, precision: int, scale: int) -> Column:
    """The number without its point. Moving the point in the text keeps all 38 digits, a product would not."""
    if scale == 0:
        return value.cast("decimal(38,0)")
    kind = DecimalType(precision, scale)
    return F.regexp_replace(_plain(value, kind, exponents=True), r"[.]", "").cast("decimal(38,0)")


def from_wide(value: Column, precision: int, scale: int) -> Column:
    """Big-endian two's complement of any length as a decimal of up to 38 digits.

    The last 16 bytes are read as two longs and put together in decimal arithmetic. Longer values may only repeat the sign before them.
    Empty bytes, and numbers that do not fit the type, are errors with and without ANSI mode.
    """
    digits = F.hex(value)
    negative = F.substring(digits, 1, 1) >= "8"
    sign = F.when(negative, "F").otherwise("0")
    last = F.substring(F.concat(F.repeat(sign, F.lit(32)), digits), -32, 32)
    # hex digits of equal length and sign compare like the numbers they are
    top = 10**precision - 1
    in_range = F.when(negative, last >= f"{2**128 - top:032X}").otherwise(last <= f"{top:032X}")
    fits = (digits != "") & (F.length(F.ltrim(digits, sign)) <= 32) & in_range
    # base -10 reads 16 digits as a signed number. The halves of a number below zero are taken as both not above zero,
    # so that no step leaves 38 digits
    high = F.conv(F.substring(last, 1, 16), 16, -10).cast("bigint") + F.when(negative, F.lit(1)).otherwise(F.lit(0))
    borrowed = F.when(negative, F.lit(Decimal(_LIMB))).otherwise(F.lit(Decimal(0))).cast("decimal(20,0)")
    low = F.conv(F.substring(last, 17, 16), 16, 10).cast("decimal(20,0)") - borrowed
    whole = (high.cast("decimal(19,0)") * F.lit(Decimal(_LIMB)).cast("decimal(20,0)") + low).cast("decimal(38,0)")
    text = F.concat(F.lit("bytes do not fit decimal("), F.lit(f"{precision},{scale}): "), digits)
    checked = F.when(digits.isNull() | fits, whole).otherwise(F.raise_error(text).cast("decimal(38,0)"))
    if scale == 0:
        return checked.cast(f"decimal({precision},0)")
    # the point is placed in the text, as a product with 10**-scale would round
    return F.concat(checked.cast("string"), F.lit(f"E-{scale}")).cast(f"decimal({precision},{scale})")


#: A number as text: sign, digits, and a fraction; an exponent is not one of them.
_PLAIN_NUMBER = r"^\s*[+-]?(?:\d+(?:\.\d*)?|\.\d+)\s*$"
#: What may stand around it: Java's white space, and the line ends that its ``$`` may precede.
_AROUND = " \t\n\x0b\f\r\x85\u2028\u2029"


def number_order(value: Column, name: str = "number") -> Column:
    """A text that sorts bytewise as the numbers in ``value`` do, of any number of digits.

    The sign, the count of whole digits and the digits, without surplus zeros. Below zero every digit is
    taken from nine and the end is marked, so that greater magnitudes come first. Numbers that are equal get equal texts. Null stays null;
    text that is no plain number is an error.
    """
    # one pattern tells what is a number; trims take it apart, as a pattern's groups would go over each digit many times
    text = F.trim(value, F.lit(_AROUND))
    digits = F.ltrim(text, F.lit("+-"))
    before = F.substring_index(digits, ".", 1)
    whole, fraction = F.ltrim(before, F.lit("0")), F.rtrim(F.substr(digits, F.length(before) + 2), F.lit("0"))
    size = F.lpad(F.length(whole).cast("string"), 10, "0")
    magnitude = F.concat(size, whole, F.lit("."), fraction)
    zero = (whole == "") & (fraction == "")
    below = text.startswith("-") & ~zero
    opposite = F.concat(F.translate(magnitude, "0123456789", "9876543210"), F.lit("~"))
    bad = ~value.rlike(_PLAIN_NUMBER)
    message = F.concat(F.lit(f"column {name}: "), value, F.lit(" is no plain number"))
    first = F.when(bad, F.raise_error(message).cast("string")).when(below, "0").otherwise("1")
    return F.concat(first, F.when(below, opposite).otherwise(magnitude))


def decimal_to_fixed(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Decimal columns as their storage bytes: the precision's fixed length, above 18 digits always 16."""
    out = {}
    for c in _decimal_columns(df, columns):
        kind = df.schema[c].dataType
        to_bytes = to_fixed if kind.precision <= MAX_FIXED_PRECISION else to_wide
        out[c] = to_bytes(quoted(c), kind.precision, kind.scale)
    return df.withColumns(out)


def fixed_to_decimal(df: DataFrame, types: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Storage bytes back to decimals; null stays null."""
    out = {}
    for name, (precision, scale) in types.items():
        _check(precision, scale)
        col = resolve(df, name)
        if not isinstance(df.schema[col].dataType, BinaryType):
            raise ValueError(f"column {col!r} is not binary")
        from_bytes = from_fixed if precision <= MAX_FIXED_PRECISION else from_wide
        out[col] = from_bytes(quoted(col), precision, scale)
    return df.withColumns(out)


def string_to_decimal(df: DataFrame, types: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Numeric text to decimals; text that is no number, or has too many digits, is an error."""
    for name in types:
        if not isinstance(df.schema[resolve(df, name)].dataType, StringType):
            raise ValueError(f"column {name!r} is not text")
    return decimal_typed(df, types)
