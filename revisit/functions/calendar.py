"""Column expressions over dates and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revisit.config import DATETIME_FORMATS, ISO_8601, Settings
from revisit.functions.text import strip


def parse_datetime(value: Column, formats: tuple[tuple[str, str], ...] = DATETIME_FORMATS) -> Column:
    """Text in one of the listed shapes as a time without zone; anything else is null.

    Two-digit years follow POSIX: 69 to 99 are in the 1900s.
    """
    text = F.upper(strip(value.cast("string")))
    parsed = F.lit(None).cast("timestamp_ntz")
    for shape, pattern in reversed(formats):
        if pattern == ISO_8601:
            moment = text.try_cast("timestamp_ntz")
        else:
            moment = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
            if "yyyy" not in pattern:
                century_back = moment - F.expr("INTERVAL 100 YEARS")
                moment = F.when(F.year(moment) >= 2069, century_back).otherwise(moment)
        parsed = F.when(text.rlike(shape), moment).otherwise(parsed)
    return parsed


def month_of(day: Column) -> Column:
    """`YYYY-MM` of a date."""
    return F.substring(day.cast("date").cast("string"), 1, 7)


def iso_text(moment: Column) -> Column:
    """A time as ISO text with a `T`."""
    return F.date_format(moment.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")


def period_label(month: Column, settings: Settings) -> Column:
    """Whether a month lies before, in or after the intervention month."""
    before, during, after = settings.period_labels
    return (
        F.when(month < settings.intervention_month, F.lit(before))
        .when(month == settings.intervention_month, F.lit(during))
        .otherwise(F.lit(after))
    )


def partial_month_flag(month: Column, settings: Settings) -> Column:
    return flag(month.isin(*settings.partial_months))


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """Rounded share; null when the base is 0."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)), places)


def money(value: Column, settings: Settings) -> Column:
    """Money for summing: kept to `money_scale` places, so the order of addition does not matter.

    Nothing is rounded to cents here. A sum has 10 digits more than a value. What is not finite or
    too large for a value is null.
    """
    return value.try_cast(f"decimal(28,{settings.money_scale})")
