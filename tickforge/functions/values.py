"""Small expressions on prices, strings and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a terminal's filling mode.
FILLING_BITS = {"FOK": 1, "IOC": 2, "BOC": 4}
#: Weekday names by number, Monday 0.
WEEKDAYS = {"monday": 0, "tuesday": 1, "wednesday": 2, "thursday": 3, "friday": 4, "saturday": 5, "sunday": 6}


#: Names of a terminal's codes, by number from 0.
CODES = {
    "swap_mode": ("DISABLED", "POINTS", "CURRENCY_SYMBOL", "CURRENCY_MARGIN", "CURRENCY_DEPOSIT", "INTEREST_CURRENT", "INTEREST_OPEN", "REOPEN_CURRENT", "REOPEN_BID"),
    "day": ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"),
    "margin_mode": ("netting", "exchange", "hedging"),
    "trade_mode": ("disabled", "longonly", "shortonly", "closeonly", "full"),
    "calc_mode": ("forex", "futures", "cfd", "cfdindex", "cfdleverage", "forex_no_leverage"),
}
#: What a code without a name is called.
UNNAMED = {"calc_mode": "OUTRO"}


def code_name(kind: str, code: Column) -> Column:
    names = F.array(*map(F.lit, CODES[kind]))
    return F.coalesce(F.when(code >= 0, F.get(names, code.cast("int"))), F.when(code.isNotNull(), UNNAMED.get(kind, "DESCONHECIDO")))


def price(scaled: Column, decimals: int) -> Column:
    """An integer price as a double; the divisor is a literal so the division is one IEEE operation."""
    return scaled / F.lit(float(10**decimals))


def spread(ask: Column, bid: Column) -> Column:
    return ask - bid


def side_sign(side: Column) -> Column:
    return F.when(side == "buy", F.lit(1)).when(side == "sell", F.lit(-1))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def same_number(a: Column, b: Column, rel: float = 1e-9, absolute: float = 1e-12) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def same_text(a: Column, b: Column) -> Column:
    return F.lower(F.trim(a)) == F.lower(F.trim(b))


def is_placeholder(text: Column) -> Column:
    return F.upper(text).contains("VERIFICAR")


def short_hash(text: Column, length: int = 12) -> Column:
    return F.substring(F.sha2(text, 256), 1, length)


def dice(sides: Column | int, *parts: Column) -> Column:
    """0 to sides - 1 by a digest of the parts, the same in every engine that has MD5."""
    digits = F.substring(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(sides) if isinstance(sides, int) else sides)


def filling_names(mask: Column) -> Column:
    return F.filter(F.array(*(F.when(mask.bitwiseAND(bit) != 0, F.lit(name)) for name, bit in FILLING_BITS.items())), lambda x: x.isNotNull())


def weekday_number(name: Column) -> Column:
    """Monday 0; null for null, an error for a name that is none."""
    known = F.create_map(*(F.lit(x) for pair in WEEKDAYS.items() for x in pair))
    at = F.try_element_at(known, F.lower(F.trim(name)))
    return F.when(name.isNull(), F.lit(None).cast("int")).when(at.isNotNull(), at).otherwise(F.raise_error(F.concat(F.lit("no weekday: "), name)).cast("int"))


def swap_usd_oz(points: Column, digits: Column) -> Column:
    """Swap points as a cost: the sign turns round, and + 0.0 makes -0 a plain 0."""
    return -points * F.pow(F.lit(10.0), -digits) + F.lit(0.0)


def plain_text(html: Column) -> Column:
    """Tags out, common entities resolved, blanks joined."""
    x = F.regexp_replace(html, "<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"), (" ", " ")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def file_url(base: str, template: str, instrument: Column, year: Column, month: Column, day: Column, hour: Column) -> Column:
    """A feed's address: months count from 0 there."""
    return F.concat(F.lit(base), F.format_string(template, instrument, year, month - 1, day, hour))
