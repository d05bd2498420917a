"""Column expressions that render or normalise values; all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paritas.functions.types import comparable, contains_map, is_floating, is_numeric


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def display_text(c: Column, dt: T.DataType) -> Column:
    """Human-readable text of a value, for long-form result rows (cast last, after native compares)."""
    if isinstance(dt, T.BinaryType):
        return F.hex(c)
    if contains_map(dt):
        return F.to_json(c)
    return c.cast("string")


def display_sql(expr: str, dt: T.DataType) -> str:
    """``display_text`` as SQL text over an expression string."""
    if isinstance(dt, T.BinaryType):
        return f"hex({expr})"
    if contains_map(dt):
        return f"to_json({expr})"
    return f"CAST({expr} AS STRING)"


def _shortest_sql(expr: str, dt: T.DataType) -> str:
    """Text of a float or double with as few digits as read back as itself. The JVM's own text may have
    more (4.9999999999999996E22 for 5E22), so long texts are tried with fewer digits: 15 or 16
    (6 to 8 for a float)."""
    kind, few = ("FLOAT", (6, 7, 8)) if isinstance(dt, T.FloatType) else ("DOUBLE", (15, 16))
    text = f"CAST({expr} AS STRING)"
    tries = "".join(f" WHEN try_cast(format_string('%.{n - 1}e', {expr}) AS {kind}) = {expr} THEN upper(format_string('%.{n - 1}e', {expr}))" for n in few)
    return f"CASE WHEN {text} RLIKE '[a-z]' OR length({text}) <= {few[0]} THEN {text}{tries} ELSE {text} END"


def _parts_sql(text: str) -> str:
    """Sign, bare digits and exponent of a number's plain or scientific text."""
    mantissa = f"regexp_replace({text}, '^-|E.*$', '')"
    fraction = f"split_part({mantissa}, '.', 2)"
    digits = f"ltrim('0', concat(split_part({mantissa}, '.', 1), {fraction}))"
    bare = f"rtrim('0', {digits})"
    power = f"coalesce(CAST(nullif(regexp_extract({text}, 'E(.*)$', 1), '') AS INT), 0) - length({fraction}) + length({digits}) - length({bare})"
    return f"CASE WHEN {bare} = '' THEN '0' ELSE concat(CASE WHEN startswith({text}, '-') THEN '-' ELSE '' END, {bare}, 'E', CAST({power} AS STRING)) END"


def exact_number_sql(expr: str, dt: T.DataType) -> str:
    """SQL text of the normal form of a number: sign, digits without zeros at either end, ``E``,
    exponent (``-25E-1``; zero is ``0``; ``NaN`` and infinities are their names).

    Two numbers of any types have the same form exactly when they name the same decimal number; a
    float or double names the one of the fewest digits that reads back as itself. So 0.1 is
    the same number as float, double and decimal, and equality is transitive over all types.
    The text is taken apart, never computed with: any precision, with ANSI mode or without.
    """
    if not is_floating(dt):
        return f"transform(array(CAST({expr} AS STRING)), t -> {_parts_sql('t')})[0]"
    return f"transform(array({_shortest_sql(expr, dt)}), t -> CASE WHEN t RLIKE '[a-z]' THEN t ELSE {_parts_sql('t')} END)[0]"


def exact_number_text(c: Column, dt: T.DataType) -> Column:
    """``exact_number_sql`` as a column expression."""
    text = c.cast("string")
    named = text.rlike("[a-z]")
    if is_floating(dt):
        kind, few = ("float", (6, 7, 8)) if isinstance(dt, T.FloatType) else ("double", (15, 16))
        short = F.when(named | (F.length(text) <= few[0]), text)
        for n in few:
            tried = F.format_string(f"%.{n - 1}e", c)
            short = short.when(tried.try_cast(kind) == c, F.upper(tried))
        text = short.otherwise(text)
    mantissa = F.regexp_replace(text, "^-|E.*$", "")
    fraction = F.split_part(mantissa, F.lit("."), F.lit(2))
    digits = F.ltrim(F.concat(F.split_part(mantissa, F.lit("."), F.lit(1)), fraction), F.lit("0"))
    bare = F.rtrim(digits, F.lit("0"))
    power = F.coalesce(F.nullif(F.regexp_extract(text, "E(.*)$", 1), F.lit("")).cast("int"), F.lit(0))
    power = power - F.length(fraction) + F.length(digits) - F.length(bare)
    form = F.when(bare == "", "0").otherwise(F.concat(F.when(text.startswith("-"), "-").otherwise(""), bare, F.lit("E"), power.cast("string")))
    return F.when(named, text).otherwise(form) if is_floating(dt) else form


def common_form(c: Column, dt: T.DataType, other: T.DataType) -> Column:
    """The value in the form in which it is compared with a value of the type ``other``: itself, exact text
    for two kinds of numbers, display text otherwise (a cast could fail under ANSI)."""
    if comparable(dt, other):
        return c
    return exact_number_text(c, dt) if is_numeric(dt) and is_numeric(other) else display_text(c, dt)


def sorted_maps(c: Column, dt: T.DataType) -> Column:
    """The value with every map, at any depth, as its entries sorted by key."""
    if not contains_map(dt):
        return c
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: sorted_maps(x, dt.elementType))
    if isinstance(dt, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[sorted_maps(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))
    entries = F.transform(F.map_entries(c), lambda e: F.struct(sorted_maps(e["key"], dt.keyType).alias("key"), sorted_maps(e["value"], dt.valueType).alias("value")))
    return F.array_sort(entries)


def canonical_text(c: Column, dt: T.DataType) -> Column:
    """Text that is equal exactly when the values are equal as group keys.

    -0.0 folds into 0.0 (Spark groups them together), instants render as epoch micros
    (a zoned rendering repeats an hour at a DST fall-back), binary as hex, maps as
    sorted entry arrays.
    """
    if is_floating(dt):
        return F.when(c == F.lit(0.0), F.lit(0.0).cast(dt)).otherwise(c).cast("string")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(dt, T.BinaryType):
        return F.hex(c)
    if contains_map(dt):
        return F.to_json(sorted_maps(c, dt))
    return c.cast("string")


def groupable(c: Column, dt: T.DataType, name: str) -> Column:
    """Maps cannot be grouped or set-compared; at any depth they become their sorted entries."""
    return sorted_maps(c, dt).alias(name)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def _ntz_micros(c: str) -> str:
    return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{_EPOCH_NTZ}', {c})"


def canonical_sql(c: str, dt: T.DataType, depth: int = 0) -> str:
    """SQL text of a value whose JSON is equal exactly when the values are equal as group keys: maps at any
    depth as entries sorted by key, -0.0 as 0.0, instants as micros (JSON shows no more than
    milliseconds), binary as hex. Parts without any of these stay as they are."""
    x = f"x{depth}"
    if isinstance(dt, T.MapType):
        key, value = (canonical_sql(f"{x}.{p}", t, depth + 1) for p, t in (("key", dt.keyType), ("value", dt.valueType)))
        return f"array_sort(transform(map_entries({c}), {x} -> named_struct('key', {key}, 'value', {value})))"
    if isinstance(dt, T.ArrayType):
        part = canonical_sql(x, dt.elementType, depth + 1)
        return c if part == x else f"transform({c}, {x} -> {part})"
    if isinstance(dt, T.StructType):
        parts = {f.name: (f"{c}.{quote(f.name)}", f.dataType) for f in dt.fields}
        made = {n: canonical_sql(e, t, depth) for n, (e, t) in parts.items()}
        if all(made[n] == e for n, (e, _) in parts.items()):
            return c
        names = {n: "'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in made}
        return f"CASE WHEN {c} IS NOT NULL THEN named_struct({', '.join(f'{names[n]}, {e}' for n, e in made.items())}) END"
    if is_floating(dt):
        return f"({c} + CAST(0 AS {dt.simpleString()}))"
    if isinstance(dt, T.TimestampType):
        return f"unix_micros({c})"
    if isinstance(dt, T.TimestampNTZType):
        return _ntz_micros(c)
    if isinstance(dt, T.BinaryType):
        return f"hex({c})"
    return c


def typed_key_sql(c: str, dt: T.DataType) -> tuple[str, str, str]:
    """Exact group key of column expression ``c`` as SQL text for three typed slots
    (l bigint, d double, s string).

    Integral, boolean, date and timestamp values go to ``l`` (days / epoch micros), float and
    double to ``d`` (grouping folds -0.0 into 0.0 and NaNs together), everything else to ``s``
    as text: nested values as JSON of their canonical form, which keeps ``["a, b"]`` and
    ``["a", "b"]`` apart. Numbers are never turned into text, so grouping many columns together
    stays cheap; NULL leaves all three slots NULL.
    """
    nl, nd, ns = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return f"CAST({c} AS BIGINT)", nd, ns
    if isinstance(dt, T.BooleanType):
        return f"CAST(CAST({c} AS INT) AS BIGINT)", nd, ns
    if isinstance(dt, T.DateType):
        return f"CAST(unix_date({c}) AS BIGINT)", nd, ns
    if isinstance(dt, T.TimestampType):
        return f"unix_micros({c})", nd, ns
    if isinstance(dt, T.TimestampNTZType):
        return _ntz_micros(c), nd, ns
    if is_floating(dt):
        return nl, f"CAST({c} AS DOUBLE)", ns
    if isinstance(dt, T.BinaryType):
        return nl, nd, f"hex({c})"
    if isinstance(dt, (T.MapType, T.ArrayType, T.StructType)):
        return nl, nd, f"to_json({canonical_sql(c, dt)})"
    return nl, nd, f"CAST({c} AS STRING)"
