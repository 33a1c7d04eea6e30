"""Column helpers: tolerant numbers, event clocks and address classes, all native expressions."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import constants as C

# Decimal text as Python's float() reads it: digit groups may be joined by "_".
_FLOAT = (
    r"(?i)^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$"
    r"|^[+-]?(inf|infinity|nan)$"
)


def has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def text_col(df: DataFrame, name: str, default: str | None = None) -> Column:
    """The column as text, or ``default`` where it is absent or null."""
    if not has(df, name):
        return F.lit(default).cast("string")
    c = F.col(f"`{name}`").cast("string")
    return c if default is None else F.coalesce(c, F.lit(default))


def safe_float_text(c: Column, default: float = 0.0) -> Column:
    """Text to double; anything that is not a number gives ``default``."""
    t = F.trim(c)
    ok = t.rlike(_FLOAT)
    return F.coalesce(F.when(ok, F.regexp_replace(t, "_", "").try_cast("double")), F.lit(float(default)))


def safe_float(df: DataFrame, name: str, default: float = 0.0) -> Column:
    """Column ``name`` as double, ``default`` where absent, null or not numeric."""
    if not has(df, name):
        return F.lit(float(default))
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return safe_float_text(c, default)
    return F.coalesce(c.try_cast("double"), F.lit(float(default)))


def finite(c: Column, default: float = 0.0) -> Column:
    """NaN and infinities to ``default``."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(default)).otherwise(c)


_OFFSET = r"(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$"


def _clock(c: Column, dtype: T.DataType, zone: str, hour_mode: str) -> Column:
    """One candidate column as a wall-clock timestamp_ntz; null where empty, zero or unreadable."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_timestamp_ntz(F.to_utc_timestamp(c, F.current_timezone())))
    if isinstance(dtype, T.StringType):
        if hour_mode == "offset":
            return F.regexp_replace(c, _OFFSET, "").try_cast("timestamp_ntz")
        instant = c.try_cast("timestamp")
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_timestamp_ntz(F.to_utc_timestamp(instant, F.current_timezone())))
    n = c.cast("double")
    if isinstance(dtype, T.IntegralType):
        n = F.when(n > 1e15, n / 1e9).when(n > 1e10, n / 1e3).otherwise(n)
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = base + F.make_dt_interval(secs=n.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), at)


def event_time(
    df: DataFrame,
    names: tuple[str, ...] = ("@timestamp", "timestamp", "eventtime"),
    zone: str = "UTC",
    hour_mode: str = "offset",
) -> Column:
    """Wall-clock time of the event: the first non-empty of ``names``.

    ISO text with an offset keeps its own hour (``hour_mode="offset"``) or is moved to ``zone``
    (``"utc"``). Integers are epoch seconds, milliseconds above 1e10, nanoseconds above 1e15.
    The first non-empty candidate decides: when it cannot be read the result is null.
    """
    out = None
    for name in reversed([n for n in names if has(df, n)]):
        c, dtype = F.col(f"`{name}`"), df.schema[name].dataType
        filled = c.isNotNull()
        if isinstance(dtype, T.StringType):
            filled = filled & (c != "")
        elif isinstance(dtype, T.NumericType):
            filled = filled & (c != 0)
        out = F.when(filled, _clock(c, dtype, zone, hour_mode)).otherwise(
            F.lit(None).cast("timestamp_ntz") if out is None else out
        )
    return F.lit(None).cast("timestamp_ntz") if out is None else out


def clock_seconds(c: Column) -> Column:
    """Whole seconds since 1970 of a timestamp or timestamp_ntz column."""
    return F.unix_seconds(c.cast("timestamp"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, for values that ``use`` mentions many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# The address expressions below are SQL text over a column or variable name: they are long, and
# one parsed text is far cheaper to build than hundreds of column objects.

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = "^" + "[.]".join([_OCTET] * 4) + r"\\z"


def _let_sql(value: str, var: str, body: str) -> str:
    return f"get(transform(array({value}), {var} -> {body}), 0)"


def _v4_number_sql(x: str) -> str:
    # Evaluated for every value, not under the test, so that the four parts share one split; the
    # int in between keeps the products of malformed numbers in range.
    parts = " + ".join(f"cast(try_cast(split_part({x}, '.', {i + 1}) as int) as bigint) * {256 ** (3 - i)}" for i in range(4))
    return f"(({parts}) * if({x} rlike '{_V4}', 1L, null))"


def _within_sql(x: str, nets: list[str], text: bool = False) -> str:
    spans = [ipaddress.ip_network(n) for n in nets]
    form = "'{:032x}'" if text else "{:d}"
    ends = [(form.format(int(s.network_address)), form.format(int(s.broadcast_address))) for s in spans]
    return "(" + " or ".join(f"{x} between {lo} and {hi}" for lo, hi in ends) + ")"


def _private_v4_sql(n: str) -> str:
    return f"({_within_sql(n, C.PRIVATE_V4)} and not {_within_sql(n, C.PRIVATE_V4_EXCEPT)})"


def _dotted_tail_sql(a: str) -> str:
    """``::ffff:1.2.3.4`` to ``::ffff:0102:0304``; null when the tail is no IPv4 address."""
    hexed = "lower(lpad(hex(n4), 8, '0'))"
    merged = f"concat(substring({a}, 1, length({a}) - length(tail)), substring({hexed}, 1, 4), ':', substring({hexed}, 5, 4))"
    return f"if(instr({a}, '.') = 0, {a}, {_let_sql(f"regexp_extract({a}, '([^:]*)$', 1)", 'tail', _let_sql(_v4_number_sql('tail'), 'n4', merged))})"


def _groups_sql(a: str) -> str:
    """The eight groups of an address, ``::`` filled with zeros."""
    side = lambda i: f"if(split_part({a}, '::', {i}) = '', cast(array() as array<string>), split(split_part({a}, '::', {i}), ':', -1))"
    filled = _let_sql(side(1), "g", _let_sql(side(2), "h", "concat(g, array_repeat('0', 8 - size(g) - size(h)), h)"))
    return f"if(instr({a}, '::') > 0, {filled}, split({a}, ':', -1))"


def _v6_hex_sql(x: str) -> str:
    """IPv6 text to 32 hex digits, null when malformed; a dotted tail and a zone id are allowed."""
    one_gap = "(instr(b, '::') = 0 or (instr(substring(b, instr(b, '::') + 2), '::') = 0 and size(filter(split(b, ':', -1), w -> w <> '')) <= 7))"
    ok = rf"b rlike '^[0-9a-f:]+\\z' and not contains(b, ':::') and {one_gap}"
    joined = r"if(size(e) = 8 and forall(e, w -> w rlike '^[0-9a-f]{1,4}\\z'), array_join(transform(e, w -> lpad(w, 4, '0')), ''), null)"
    read = f"if({ok}, {_let_sql(_groups_sql('b'), 'e', joined)}, null)"
    return _let_sql(f"lower(regexp_replace({x}, '%[^%]+$', ''))", "a", _let_sql(_dotted_tail_sql("a"), "b", read))


def private_v6_sql(x: str) -> str:
    """Class of an IPv6 address (malformed: false); null for text without a colon."""
    mapped = _let_sql("cast(conv(substring(hex6, 25, 8), 16, 10) as bigint)", "n6", _private_v4_sql("n6"))
    own = f"({_within_sql('hex6', C.PRIVATE_V6, True)} and not {_within_sql('hex6', C.PRIVATE_V6_EXCEPT, True)})"
    body = f"if(startswith(hex6, '00000000000000000000ffff'), {mapped}, {own})"
    return f"if(instr({x}, ':') > 0, coalesce({_let_sql(_v6_hex_sql(x), 'hex6', body)}, false), null)"


def ipv4_number(name: str) -> Column:
    """Dotted quad in column ``name`` to its 32-bit number; null unless four octets without leading zeros."""
    return F.expr(_v4_number_sql(f"`{name}`"))


def is_private_v4(name: str) -> Column:
    """Class of an address number column (``ipv4_number``); false where it is null."""
    return F.expr(f"coalesce({_private_v4_sql(f'`{name}`')}, false)")


def is_private_ip(name: str) -> Column:
    """True for private and reserved IPv4/IPv6 addresses in column ``name``; false for public,
    malformed or null."""
    v4 = _let_sql(_v4_number_sql(f"`{name}`"), "n0", _private_v4_sql("n0"))
    return F.expr(f"coalesce({private_v6_sql(f'`{name}`')}, {v4}, false)")
