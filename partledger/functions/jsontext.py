"""JSON text with the exact layout other tools expect, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _strip(text: Column, left: int, right: int) -> Column:
    return F.substring(text, F.lit(left + 1), F.length(text) - (left + right))


def json_string(value: Column) -> Column:
    """A quoted and escaped JSON string."""
    return _strip(F.to_json(F.array(value)), 1, 1)


def json_number(value: Column) -> Column:
    """A double in plain decimal notation from 1e-6 up to 1e21, else as ``1.5e300``.

    Whole numbers keep one decimal (``17.0``). Not-a-number and infinities have no
    JSON form and come out as quoted words.
    """
    text, size = value.cast("string"), F.abs(value)
    large = F.rtrim(text.try_cast("decimal(38,15)").cast("string"), F.lit("0"))
    small = F.rtrim(text.try_cast("decimal(38,25)").cast("string"), F.lit("0"))
    tiny_or_huge = F.replace(F.replace(text, F.lit(".0E"), F.lit("e")), F.lit("E"), F.lit("e"))
    infinite = F.isnan(value) | (size == float("inf"))
    return (
        F.when((value == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when(infinite, F.concat(F.lit('"'), text, F.lit('"')))
        .when((size >= 1e7) & (size < 1e21), F.regexp_replace(large, r"\.\z", ".0"))
        .when((size >= 1e-6) & (size < 1e-3), small)
        .otherwise(tiny_or_huge)
    )


def _scalar(value: Column, dtype: T.DataType) -> Column:
    """JSON text of one non-NULL value."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return json_number(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.concat(F.lit('"'), _writable(value, dtype), F.lit('"'))
    if isinstance(dtype, T.DecimalType):
        return value.cast("string")
    return _strip(F.to_json(F.array(value), _KEEP_NULLS), 1, 1)


def _writable(value: Column, dtype: T.DataType) -> Column:
    """The value in a form that ``to_json`` prints portably.

    Instants are printed in the session's zone, which the library sets to UTC.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.cast("string")
    return value


def _portable(name: str, value: Column, dtype: T.DataType) -> tuple[str, Column, T.DataType]:
    """The field in a type every engine prints alike.

    Decimals of up to 15 digits are exact as doubles; longer ones are kept as text.
    """
    if isinstance(dtype, T.FloatType):
        return name, value.cast("double"), T.DoubleType()
    if isinstance(dtype, T.DecimalType):
        if dtype.precision <= 15:
            return name, value.cast("double"), T.DoubleType()
        return name, value.cast("string"), T.StringType()
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.FloatType):
        return name, value.cast("array<double>"), T.ArrayType(T.DoubleType())
    return name, value, dtype


_PRINTED_OTHERWISE = (T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _children(dtype: T.DataType) -> list[T.DataType]:
    if isinstance(dtype, T.StructType):
        return [f.dataType for f in dtype.fields]
    if isinstance(dtype, T.ArrayType):
        return [dtype.elementType]
    return [dtype.valueType] if isinstance(dtype, T.MapType) else []


def _must_walk(dtype: T.DataType) -> bool:
    """Whether something inside a nested type is printed by ``to_json`` as other engines do not."""
    return any(isinstance(c, _PRINTED_OTHERWISE) or _must_walk(c) for c in _children(dtype))


def _is_plain(size: Column) -> Column:
    return (size == 0) | ((size >= 1e-3) & (size < 1e7))


def _by_field(fields: list[tuple[str, Column, T.DataType]]) -> Column:
    pieces = [
        F.concat(json_string(F.lit(name)), F.lit(":"), _json_text(value, dtype, pretty=False))
        for name, value, dtype in fields
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


def row_json(fields: list[tuple[str, Column, T.DataType]]) -> Column:
    """One compact JSON object per row; NULL fields are written, order is kept.

    A single ``to_json`` call writes the row unless a double would come out in
    exponent form, alone or in an array; such rows are put together field by field, and so
    are all rows with numbers, dates or times in other nested types. That branch sits inside a
    one-element ``transform``, which keeps it out of the generated method: a method
    over 8,000 bytecodes would never be compiled by the JVM.
    """
    fields = [_portable(*f) for f in fields]
    whole = F.to_json(
        F.struct(*[_writable(value, dtype).alias(name) for name, value, dtype in fields]), _KEEP_NULLS
    )
    rare = F.transform(F.array(F.lit(0)), lambda _: _by_field(fields))[0]
    floating = []
    for _, v, t in fields:
        if isinstance(t, T.DoubleType):
            floating.append(v.isNull() | _is_plain(F.abs(v)))
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.DoubleType):
            floating.append(v.isNull() | F.forall(v, lambda x: x.isNull() | _is_plain(F.abs(x))))
        elif _must_walk(t):
            return rare
    if not floating:
        return whole
    plain = F.lit(True)
    for test in floating:
        plain = plain & test
    return F.when(F.coalesce(plain, F.lit(False)), whole).otherwise(rare)


def pretty_json(value: Column, dtype: T.DataType) -> Column:
    """JSON with two-space indentation and ``"key": value``; NULLs are written."""
    return _json_text(value, dtype, pretty=True)


def _json_text(value: Column, dtype: T.DataType, pretty: bool, level: int = 0) -> Column:
    """JSON of any type, indented, or compact and then with portable numbers."""
    inner, outer = ("\n" + "  " * (level + 1), "\n" + "  " * level) if pretty else ("", "")
    colon = F.lit(": " if pretty else ":")
    if not pretty:
        _, value, dtype = _portable("", value, dtype)
    if isinstance(dtype, T.StructType):
        lines = []
        for f in dtype.fields:
            text = _json_text(value[f.name], f.dataType, pretty, level + 1)
            lines.append(F.concat(json_string(F.lit(f.name)), colon, text))
        text = F.concat(
            F.lit("{" + inner), F.concat_ws("," + inner, *lines), F.lit(outer + "}")
        )
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda x: _json_text(x, dtype.elementType, pretty, level + 1))
        text = F.when(F.size(value) == 0, F.lit("[]")).otherwise(
            F.concat(F.lit("[" + inner), F.array_join(items, "," + inner), F.lit(outer + "]"))
        )
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.concat(
                json_string(e["key"]), colon, _json_text(e["value"], dtype.valueType, pretty, level + 1)
            ),
        )
        text = F.when(F.size(entries) == 0, F.lit("{}")).otherwise(
            F.concat(F.lit("{" + inner), F.array_join(entries, "," + inner), F.lit(outer + "}"))
        )
    elif isinstance(dtype, T.StringType):
        text = json_string(value)
    else:
        text = _scalar(value, dtype)
    return F.coalesce(F.when(value.isNotNull(), text), F.lit("null"))
