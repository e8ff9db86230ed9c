"""Scalar helpers: rounding casts, sizes, text keys, array literals, messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Size units and the step between them.
SIZE_UNITS = ("bytes", "kB", "MB", "GB", "TB", "PB")
SIZE_STEP = 1024


def rounded_int(col: Column) -> Column:
    """Cast to int by rounding to nearest, halves to even; a plain cast truncates."""
    return F.rint(col).cast("int")


def round_double(col: Column, digits: int) -> Column:
    """`F.round` of a double, by arithmetic: about ten times faster than its decimals, which are used for large values and near ties only."""
    scale = 10.0 ** digits
    whole = F.rint(col * scale)
    clear = (F.abs(col * scale) < 1e12) & (F.abs(col * scale - whole) < 0.499)
    # adding 0.0 makes a negative zero positive, as decimals do
    return F.when(clear, whole / scale + 0.0).otherwise(F.round(col, digits))


def size_pretty(num_bytes: Column) -> Column:
    """Byte count as text, rounded half up, in the first unit that keeps it below
    ten of the next one."""
    size = num_bytes.cast("long")

    def halves(power: int) -> Column:
        return F.floor(F.abs(size) / F.lit(SIZE_STEP ** power // 2)).cast("long")

    out = F.when(F.abs(size) < 10 * SIZE_STEP, F.concat_ws(" ", size.cast("string"), F.lit(SIZE_UNITS[0])))
    for power, unit in enumerate(SIZE_UNITS[1:], start=1):
        text = F.concat_ws(" ", (F.signum(size).cast("long") * F.floor((halves(power) + 1) / 2).cast("long"))
                           .cast("string"), F.lit(unit))
        last = unit == SIZE_UNITS[-1]
        out = out.when(F.lit(True) if last else halves(power) < 20 * SIZE_STEP - 1, text)
    return F.when(size.isNotNull(), out)


def percent_saved(before: Column, after: Column) -> Column:
    """Share of the bytes saved, in percent, two decimals; null if nothing was there."""
    wide = "decimal(20,0)"
    ratio = F.try_divide(after.cast(wide), before.cast(wide))
    return F.round((F.lit(1) - ratio) * 100, 2).cast("decimal(10,2)")


def segment_key(col: Column, length: int = 2) -> Column:
    """Last characters of an address or transaction id: a low-cardinality layout key."""
    return F.right(col, F.lit(length))


def parse_array_literal(col: Column) -> Column:
    """``{a,"b,c",NULL}`` as an array of text.

    ``{}`` is the empty array. A quoted item may hold commas, braces and characters
    escaped by a backslash; an unquoted NULL in any case is null.
    """
    inner = F.regexp_extract(col, r"(?s)^\s*\{(.*)\}\s*$", 1)
    items = F.regexp_extract_all(F.concat(F.lit(","), inner), F.lit(r'(?s),(\s*"(?:[^"\\]|\\.)*"\s*|[^,]*)'), 1)
    bare = lambda x: F.regexp_replace(F.btrim(x), r'(?s)^"(.*)"$', "$1")
    item = lambda x: F.when(F.btrim(x).startswith('"'), F.regexp_replace(bare(x), r"(?s)\\(.)", "$1")).when(
        F.upper(F.btrim(x)) != "NULL", F.btrim(x))
    return (F.when(col.isNull(), F.lit(None).cast("array<string>"))
            .when(F.btrim(inner) == "", F.array().cast("array<string>"))
            .otherwise(F.transform(items, item)))


def parse_vector(col: Column) -> Column:
    """``[1.0, 0.5]`` as an array of doubles."""
    return F.from_json(col, "array<double>")


def chat_messages(system: str | Column, user: Column) -> Column:
    """Two-message document (system, user) as a JSON text."""
    system = F.lit(system) if isinstance(system, str) else system
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.to_json(F.array(message("system", system), message("user", user)))


def answer_text(response: Column) -> Column:
    """Text of the first choice in a chat response document."""
    return F.get_json_object(response, "$.choices[0].message.content")
