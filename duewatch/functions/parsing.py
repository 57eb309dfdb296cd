"""Column expressions that read dirty text. Values that do not parse become null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PLACEHOLDER = "___"
UNKNOWN = "Unknown"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
DATE_LAYOUTS = ["yyyy-MM-dd", "dd-MM-yyyy", "MM-dd-yyyy"]
BLANK_CREDIT_MIX = ["_", "", "NA", "NaN"]


def whole_number(value: Column) -> Column:
    """Text or number to int, dropping the fraction ('3.5' gives 3)."""
    return value.try_cast("double").try_cast("int")


def decimal_number(value: Column) -> Column:
    return value.try_cast("double")


def calendar_date(value: Column) -> Column:
    return value.try_cast("date")


def trim_underscores(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"^_+|_+$", ""))


def masked_ssn(value: Column) -> Column:
    """A well-formed number stays, everything else turns into the placeholder."""
    return F.coalesce(F.when(value.rlike(SSN_PATTERN), value), F.lit(PLACEHOLDER))


def clean_occupation(value: Column) -> Column:
    return F.coalesce(F.nullif(trim_underscores(value), F.lit("")), F.lit(PLACEHOLDER))


def parsed_age(value: Column, repair: bool = False) -> Column:
    """Age as a number. ``repair`` reads '28_' as 28; without it such ages are null."""
    if repair:
        return decimal_number(trim_underscores(F.trim(value)))
    return whole_number(F.trim(value)).cast("double")


def stripped_number(value: Column, kind: str = "double", cap: float | None = None) -> Column:
    """Digits and dots only, as a number, at most ``cap``. A sign is stripped too."""
    digits = F.regexp_replace(value.cast("string"), "[^0-9.]", "")
    number = whole_number(digits) if kind == "int" else decimal_number(digits)
    if cap is None:
        return number
    return F.when(number.isNotNull(), F.least(number, F.lit(cap).cast(kind)))


def history_months(value: Column) -> Column:
    """'12 Years and 3 Months' as 147. A missing part counts 0, null stays null."""

    def part(unit: str) -> Column:
        found = F.regexp_extract(value, rf"(\d+)\s+{unit}", 1)
        return F.when(found == "", F.lit(0)).otherwise(whole_number(found))

    return (part("Years") * 12 + part("Months")).cast("int")


def keyword_level(value: Column, keywords: list[str]) -> Column:
    """1-based place of the first keyword found in any case, 0 when there is none."""
    hits = [F.when(F.lower(value).contains(word), F.lit(place)) for place, word in enumerate(keywords, 1)]
    return F.coalesce(*hits, F.lit(0))


def clean_credit_mix(value: Column) -> Column:
    return F.when(value.isNull() | value.isin(BLANK_CREDIT_MIX), F.lit(UNKNOWN)).otherwise(F.initcap(value))


def yes_no(value: Column) -> Column:
    return F.when(value.isin("Yes", "No"), value).otherwise(F.lit(UNKNOWN))


def loan_items(value: Column) -> Column:
    """The listed loan types. 'and' is a separator wherever it stands, inside words too."""
    parts = F.transform(F.split(F.regexp_replace(value, "and", ","), ","), lambda item: F.trim(item))
    return F.filter(parts, lambda item: ~item.isin("", "Not Specified"))


def loan_item_words(value: Column) -> Column:
    """As ``loan_items`` with 'and' as a whole word only, each type once, null as empty."""
    parts = F.transform(F.split(F.regexp_replace(value, r"\band\b", ","), ","), lambda item: F.trim(item))
    kept = F.filter(parts, lambda item: (item != "") & (F.lower(item) != "not specified"))
    return F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<string>"))


def dash_separated(value: Column) -> Column:
    return F.regexp_replace(value, "[./]", "-")


def flexible_date(value: Column) -> Column:
    """The first layout that fits, tried in the order of ``DATE_LAYOUTS``."""
    text = dash_separated(value)
    return F.coalesce(*[F.try_to_date(text, layout) for layout in DATE_LAYOUTS])
