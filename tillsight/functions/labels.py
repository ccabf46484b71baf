"""Display texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts read as a holiday.
HOLIDAY_TOKENS = ["TRUE", "1", "YES"]


def holiday_label(c: str | Column, rule: str = "token") -> Column:
    """'TRUE' / 'FALSE' for a holiday flag.

    ``token``: the text is one of the holiday tokens, any case.
    ``truthy``: any value that a scripting language takes as true, so the text 'FALSE' is 'TRUE'.
    ``equals``: the flag is exactly true.
    """
    c = F.col(c) if isinstance(c, str) else c
    if rule == "token":
        hit = F.upper(c.cast("string")).isin(HOLIDAY_TOKENS)
    elif rule == "truthy":
        text = c.cast("string")
        hit = F.when(F.typeof(c) == "boolean", text == "true").otherwise(F.length(text) > 0)
    elif rule == "equals":
        hit = (F.typeof(c) == "boolean") & (c.cast("string") == "true")
    else:
        raise ValueError(f"unknown holiday rule {rule!r}")
    return F.when(hit, F.lit("TRUE")).otherwise(F.lit("FALSE"))


def dept_label(separator: str = "\n", dept: str = "dept_id", store: str = "store_id") -> Column:
    """'Dept 3<separator>(Store 7)'."""
    return F.concat(F.lit("Dept "), F.col(dept).cast("string"), F.lit(f"{separator}(Store "),
                    F.col(store).cast("string"), F.lit(")"))


def fixed(c: Column, digits: int, commas: bool = True) -> Column:
    """Number with fixed decimals, half-even like the usual report formatters."""
    text = F.format_number(c.cast("double"), digits)
    return text if commas else F.translate(text, ",", "")


def money(c: str | Column, unit: str = "", digits: int = 0, missing: str | None = None) -> Column:
    """'$1,234M' and the like; the value must already be in that unit."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.concat(F.lit("$"), fixed(c, digits), F.lit(unit))
    return text if missing is None else F.coalesce(text, F.lit(missing))


def percent(c: str | Column, digits: int = 1) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(fixed(c, digits, commas=False), F.lit("%"))
