"""T5: column values as text the way the relational source prints them (what its driver's getString gives).

    boolean            t, f
    integers, decimals plain digits, decimals with their scale
    float, double      shortest digits; plain from 1e-4 up to 15 digits before the point (float: 6), else 1.5e+20, 2e-07;
                       NaN, Infinity, -Infinity
    date               2024-02-01
    timestamp          2024-02-01 10:00:00[.5] without trailing zeros; with a zone followed by its offset: +00, +05:30
    binary             \\x and hexadecimal digits
    array              {a,"b c",NULL}: elements quoted where they are empty, NULL, or hold a comma, brace, quote, backslash or space
    struct             (a,"b c",): fields likewise, null fields empty
    text               as it is; null stays null

Maps have no such form and become JSON. Everything is a native expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits before the point up to which a float or double is printed plainly.
PLAIN_DIGITS = {"float": 6, "double": 15}
#: Numbers below these have fewer significant digits than the JVM may print.
SMALL = {"float": 1e-36, "double": 1e-300}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _shortest(c: Column, t: Column, kind: str) -> Column:
    """The JVM's text of a positive number, or a shorter one that is still the same number: some JVMs print digits too many."""
    n = F.length(F.replace(F.split_part(t, F.lit("E"), F.lit(1)), F.lit(".")))
    tries = F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))),
                        lambda k: F.replace(F.upper(F.printf(F.concat(F.lit("%."), k.cast("string"), F.lit("e")), c)), F.lit("E+"), F.lit("E")))
    first = F.try_element_at(F.filter(tries, lambda s: s.try_cast(kind) == c), F.lit(1))
    long = (n > PLAIN_DIGITS[kind]) | (c < SMALL[kind])
    return F.when(long & (c > 0) & ~t.isin("NaN", "Infinity"), F.coalesce(first, t)).otherwise(t)


def _layout(p: Column, digits: int) -> Column:
    """Text of significant digits p.d with the exponent p.x of the first one."""
    d, x = p["d"], p["x"]
    n = F.length(d)
    plain = (F.when(x < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -x - 1), d))
             .when(n <= x + 1, F.rpad(d, x + 1, F.lit("0")))
             .otherwise(F.concat(F.substring(d, F.lit(1), x + 1), F.lit("."), F.substring(d, x + 2, n))))
    scientific = F.concat(F.substring(d, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise(""),
                          F.when(x < 0, F.lit("e-")).otherwise(F.lit("e+")),
                          F.when(F.abs(x) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(x).cast("string"))
    return F.when(d == "", F.lit("0")).when((x < -4) | (x >= digits), scientific).otherwise(plain)


def float_text(c: Column, kind: str) -> Column:
    """From the JVM's text (plain, or d.dddE[-]x) to significant digits and a decimal exponent, and from these to the source's form."""
    def parts(t: Column) -> Column:
        mantissa = F.split_part(t, F.lit("E"), F.lit(1))
        return F.struct(F.split_part(mantissa, F.lit("."), F.lit(1)).alias("whole"),
                        F.concat(F.split_part(mantissa, F.lit("."), F.lit(1)), F.split_part(mantissa, F.lit("."), F.lit(2))).alias("every"),
                        F.coalesce(F.split_part(t, F.lit("E"), F.lit(2)).try_cast("int"), F.lit(0)).alias("shift"))

    def digits(p: Column) -> Column:
        bare = F.ltrim(p["every"], F.lit("0"))              # zeros before the first significant digit go
        return F.struct(F.rtrim(bare, F.lit("0")).alias("d"),
                        (F.length(p["whole"]) - 1 - F.length(p["every"]) + F.length(bare) + p["shift"]).alias("x"))

    size = F.abs(c)
    body = _let(size.cast("string"), lambda t: _let(_shortest(size, t, kind), lambda s: _let(parts(s), lambda p: _let(
        digits(p), lambda q: _layout(q, PLAIN_DIGITS[kind])))))
    sign = F.when(c.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.when(F.isnan(c), F.lit("NaN")).when(size == float("inf"), F.concat(sign, F.lit("Infinity"))).otherwise(F.concat(sign, body))


def _zone_text(c: Column, time_zone: str) -> Column:
    """An instant on the zone's wall clock with its offset (+00, +05:30)."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    clock = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc)
    minutes = F.timestamp_diff("MINUTE", utc, clock)
    size = F.abs(minutes)
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    offset = F.concat(F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")), two(F.floor(size / 60)),
                      F.when(size % 60 != 0, F.concat(F.lit(":"), two(size % 60))).otherwise(F.lit("")))
    return F.concat(clock.cast("string"), offset)


def _quoted(t: Column, empty_is_null: bool) -> Column:
    """An element of an array (or, where null is empty, a field of a row), quoted where its text needs it."""
    special = r'[\\"{},\s]' if not empty_is_null else r'[\\"(),\s]'
    needs = (t == "") | t.rlike(special) | ((F.upper(t) == "NULL") if not empty_is_null else F.lit(False))
    # inside quotes an array escapes by a backslash, a row doubles quotes and backslashes
    escaped = F.regexp_replace(t, r'(["\\])', r'\\$1') if not empty_is_null else F.regexp_replace(t, r'(["\\])', r'$1$1')
    null = F.lit("" if empty_is_null else "NULL")
    return F.when(t.isNull(), null).when(needs, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(t)


def text_of(c: Column, kind: T.DataType, time_zone: str = "UTC") -> Column:
    """The text of a value of type ``kind``."""
    name = kind.typeName()
    if name == "boolean":
        return F.when(c, F.lit("t")).when(~c, F.lit("f"))
    if name in PLAIN_DIGITS:
        return float_text(c, name)
    if name == "timestamp":
        return _zone_text(c, time_zone)
    if name == "binary":
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    if name == "array":
        # an inner array is part of its outer one's braces and is not quoted
        inner = isinstance(kind.elementType, T.ArrayType)
        element = lambda t: F.coalesce(t, F.lit("NULL")) if inner else _quoted(t, False)
        each = lambda e: _let(text_of(e, kind.elementType, time_zone), element)
        return F.concat(F.lit("{"), F.array_join(F.transform(c, each), ","), F.lit("}"))
    if name == "struct":
        fields = [_let(text_of(c[f.name], f.dataType, time_zone), lambda t: _quoted(t, True)) for f in kind.fields]
        commas = [x for f in fields for x in (F.lit(","), f)][1:]
        return F.when(c.isNotNull(), F.concat(F.lit("("), *commas, F.lit(")")))
    if name in ("map", "variant"):
        return F.to_json(c)
    return c.cast("string")


def row_texts(rows: DataFrame, how: str = "database", time_zone: str = "UTC", row: str = "_row") -> dict[str, Column]:
    """Text of every column of the struct column ``row``. ``how`` "spark" gives Spark's cast instead."""
    fields = rows.schema[row].dataType.fields
    value = lambda f: F.col(f"`{row}`.`{f.name}`")
    return {f.name: value(f).cast("string") if how == "spark" else text_of(value(f), f.dataType, time_zone) for f in fields}
