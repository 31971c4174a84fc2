"""Column to column functions. All are built-in expressions, so they stay inside whole-stage codegen.

Spark 4 runs in ANSI mode, where a bad cast stops the job. Raw card data does contain such values, and the wanted
answer is NULL, hence ``try_cast`` throughout.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that must equal the ones consumers already filter on.
AGE_BANDS = [(18, "Under 18"), (35, "18-34"), (50, "35-49"), (65, "50-64")]
AGE_TOP = "65+"
INCOME_BANDS = [(30000, "Low Income"), (70000, "Middle Income")]
INCOME_TOP = "High Income"
CHIP_TOKENS = ["Yes", "yes"]
FRAUD_TOKEN = "YES"
DARK_WEB_TOKEN = "Yes"
MONTH_YEAR = "^([0-9]{1,2})/([0-9]{4})$"

DateLike = str | dt.date


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_lit(value: DateLike | Column) -> Column:
    """A DATE column from ISO text, a date or a column."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def money(text: Column | str, precision: int, scale: int) -> Column:
    """``$-1,234.50`` to DECIMAL; text that is still not a number becomes NULL."""
    return F.translate(col(text), "$,", "").try_cast(f"decimal({precision},{scale})")


def credit_limit(text: Column | str) -> Column:
    """Like ``money`` but drops every character a number cannot have, so ``USD 1,200.50`` parses."""
    return F.regexp_replace(col(text), "[^0-9.-]", "").try_cast("decimal(12,2)")


def _part(text: Column | str, group: int, low: int, high: int) -> Column:
    number = F.regexp_extract(col(text), MONTH_YEAR, group).try_cast("int")
    return F.when(number.between(low, high), number)


def month_of(text: Column | str) -> Column:
    """Month of ``M/YYYY``; NULL unless 1..12."""
    return _part(text, 1, 1, 12)


def year_of(text: Column | str) -> Column:
    """Year of ``M/YYYY``; NULL unless 1900..2100."""
    return _part(text, 2, 1900, 2100)


def expired(year: Column | str, month: Column | str, as_of: DateLike) -> Column:
    """NULL if a part is unknown, else whether that month ended before the month of ``as_of``."""
    now = date_lit(as_of)
    # NULL propagates through the sum, which gives the three-valued result without a branch.
    return (col(year) * 12 + col(month)) < (F.year(now) * 12 + F.month(now))


def age_at(moment: DateLike | Column, birth_year: Column | str) -> Column:
    """Calendar-year difference; birthdays are not considered."""
    when = moment if isinstance(moment, Column) else date_lit(moment)
    return F.year(when) - col(birth_year)


def _band(value: Column, bands: list[tuple[int, str]], top: str) -> Column:
    limit, name = bands[0]
    chain = F.when(value < limit, name)
    for limit, name in bands[1:]:
        chain = chain.when(value < limit, name)
    return chain.otherwise(top)


def age_group(age: Column | str) -> Column:
    """An unknown age falls into the top band."""
    return _band(col(age), AGE_BANDS, AGE_TOP)


def income_group(income: Column | str) -> Column:
    """An unknown income falls into the top band."""
    return _band(col(income), INCOME_BANDS, INCOME_TOP)


def token_flag(text: Column | str, tokens: list[str]) -> Column:
    """True for one of the exact tokens, else False (never NULL)."""
    return F.coalesce(col(text).isin(tokens), F.lit(False))


def chip_flag(text: Column | str) -> Column:
    return token_flag(text, CHIP_TOKENS)


def dark_web_flag(text: Column | str) -> Column:
    return token_flag(text, [DARK_WEB_TOKEN])


def fraud_flag(text: Column | str, token: str = FRAUD_TOKEN) -> Column:
    return token_flag(text, [token])


def error_flag(text: Column | str) -> Column:
    """Any text counts as an error, the empty one included."""
    return col(text).isNotNull()


def spending_ratio(amount: Column | str, limit: Column | str) -> Column:
    """Share of the limit used; 0 when there is no positive limit, NULL when the ratio does not fit."""
    ratio = (col(amount) / col(limit)).try_cast("decimal(10,4)")
    return F.when(col(limit) > 0, ratio).otherwise(F.lit(0).cast("decimal(10,4)"))


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(col(text), F.lit(""))


def typed(text: Column | str, kind: str) -> Column:
    """Staged text to ``kind``: empty or unreadable text is NULL."""
    return blank_to_null(text).try_cast(kind)


def or_zero(value: Column | str) -> Column:
    return F.coalesce(col(value), F.lit(0))


def sum_if(value: Column, condition: Column) -> Column:
    """Sum over the rows that meet the condition; 0, not NULL, when none does."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("decimal(18,4)")))


def negative_part(positive: Column | str, total: Column | str) -> Column:
    """Sum of the absolute negative amounts, from the sum of the positive ones and of all.

    Decimal sums are the costly part of a summary, and this one is exact without a pass of its own.
    """
    return col(positive) - F.coalesce(col(total), F.lit(0).cast("decimal(18,4)"))


def surrogate_key(*parts: Column | str) -> Column:
    """64-bit key that depends on the row only, so reruns and retried tasks give the same one."""
    return F.xxhash64(*(col(part) for part in parts))


def whole_units(amount: Column | str) -> Column:
    """DECIMAL to INT, cutting the fraction towards zero."""
    return col(amount).try_cast("int")


def base_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def as_text(binary: Column | str) -> Column:
    return col(binary).cast("string")


def json_text(document: Column | str, path: str) -> Column:
    return F.get_json_object(col(document), path)


def json_long(document: Column | str, path: str) -> Column:
    return json_text(document, path).try_cast("bigint")


def month_start(moment: Column | str) -> Column:
    return F.trunc(col(moment), "month")
