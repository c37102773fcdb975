"""Column expressions over text: names, identifiers, durations, numbers, labels."""

from __future__ import annotations

import functools
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from revisit.config import CLIENT_KEY_HEX_DIGITS, CLIENT_KEY_PREFIX, WALK_IN_SPELLINGS, WALK_IN_TOKEN

# --- Fixed values: patterns and formats that decide the results. -------------
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"  # Unicode white space and the four ASCII separators
INTEGRAL_FLOAT_ID = r"(?U)^(\d+)\.0$"
DURATION = r"^(?:(\d+)h:)?(\d+)min$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
LARGEST_NUMBER = 1e18  # larger ones, infinity too, are no amounts and no counts
NOT_ALPHANUMERIC = r"[^A-Za-z0-9]+"
NOT_YET_ELIGIBLE = "Not yet eligible"
NO_RATE = "—"
# -----------------------------------------------------------------------------


# The same characters one by one, from the interpreter's own data.
WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())


def strip(value: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(value, F.lit(WHITESPACE))


def blank_to_null(value: Column) -> Column:
    """For values that are cheap to read twice; also usable inside lambdas."""
    return F.when(value != "", value)


@functools.cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Unicode case folding as (from, to) for one-to-one letters plus the expansions.

    The tables are derived from the interpreter's own Unicode data.
    """
    singles, expansions = [], {}
    for code in range(sys.maxunicode + 1):
        letter = chr(code)
        folded = letter.casefold()
        if folded == letter:
            continue
        if len(folded) == 1:
            singles.append((letter, folded))
        else:
            expansions[letter] = folded
    return "".join(a for a, _ in singles), "".join(b for _, b in singles), expansions


def casefold(value: Column, exact: bool = True) -> Column:
    """Caseless form of a text, without leaving the JVM.

    Pure ASCII takes `lower`. Other text is translated letter by letter, and only
    text with a letter that expands (like the sharp s) is taken apart.
    """
    if not exact:
        return F.lower(value)
    source, target, expansions = _fold_tables()
    translated = F.translate(value, source, target)
    pairs = F.str_to_map(F.lit(";".join(f"{a}={b}" for a, b in expansions.items())), F.lit(";"), F.lit("="))
    expanded = F.array_join(
        F.transform(F.split(translated, ""), lambda c: F.coalesce(F.element_at(pairs, c), c)), ""
    )
    has_expansion = value.rlike("[" + "".join(expansions) + "]")
    return (
        F.when(F.octet_length(value) == F.char_length(value), F.lower(value))
        .when(has_expansion, expanded)
        .otherwise(translated)
    )


def normalize_client_name(value: Column, walk_in_spellings: tuple[str, ...] = WALK_IN_SPELLINGS) -> Column:
    """Collapse white space, keep case, map walk-in spellings to one token; blank is null.

    One chain of calls, so the text is scanned once however often the result is used.
    """
    collapsed = F.trim(F.regexp_replace(value, WHITESPACE_RUN, " "))
    spellings = "|".join(rf"\Q{s}\E" for s in walk_in_spellings)
    return F.nullif(F.regexp_replace(collapsed, f"(?iu)^(?:{spellings})$", WALK_IN_TOKEN), F.lit(""))


def make_client_key(normalized_name: Column, first_visit: Column) -> Column:
    """Deterministic surrogate key of (name, first visit day); null when either is null."""
    # `concat` is null as soon as one part is null, which is the wanted rule.
    identity = F.concat(normalized_name, F.lit("|"), F.to_date(first_visit).cast("string"))
    return F.concat(F.lit(CLIENT_KEY_PREFIX), F.substring(F.sha2(identity, 256), 1, CLIENT_KEY_HEX_DIGITS))


def normalize_identifier(value: Column) -> Column:
    """Identifiers stay text; a spreadsheet's `.0` on a whole number is removed."""
    return F.nullif(F.regexp_replace(strip(value.cast("string")), INTEGRAL_FLOAT_ID, "$1"), F.lit(""))


def parse_duration_minutes(value: Column) -> Column:
    """`2h:15min` or `45min` as minutes; any other text is null."""
    text = strip(value)
    hours = F.nullif(F.regexp_extract(text, DURATION, 1), F.lit(""))
    minutes = F.regexp_extract(text, DURATION, 2)
    # As 64-bit numbers of at most 12 digits nothing can overflow; what is no 32-bit number in the end is null.
    fits = (F.coalesce(F.length(hours), F.lit(0)) <= 12) & (F.length(minutes) <= 12)
    total = F.coalesce(hours.try_cast("long"), F.lit(0)) * 60 + minutes.try_cast("long")
    return F.when(text.rlike(DURATION) & fits, total).try_cast("int")


def parse_number(value: Column) -> Column:
    """Plain decimal text as double; currency signs, separators, suffixes and numbers out of range give null."""
    text = strip(value.cast("string"))
    number = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(number) < LARGEST_NUMBER), number)


def parse_whole_number(value: Column) -> Column:
    """Like `parse_number`, for counts; a fractional value is null."""
    number = parse_number(value)
    return F.when(number == F.floor(number), number.try_cast("long"))


def rejected(text: Column, value: Column) -> Column:
    """Whether a cell has a text that could not be read as a value."""
    return text.isNotNull() & (strip(text) != "") & value.isNull()


def snake_case(value: Column) -> Column:
    """Report header text as a column name."""
    spelled = F.regexp_replace(F.regexp_replace(strip(value), "&", " and "), "[/-]", " ")
    return F.lower(F.regexp_replace(F.regexp_replace(spelled, NOT_ALPHANUMERIC, "_"), "^_+|_+$", ""))


def month_label(month: Column) -> Column:
    """`YYYY-MM` as month name and year."""
    return F.date_format(F.to_date(F.concat(month, F.lit("-01"))), "MMMM yyyy")


def percent_text(rate: Column) -> Column:
    """A rate as percentage text with one decimal, rounding the binary value half to even.

    Spark's own formatting rounds the shortest decimal text half up, which differs on
    ties. Near a tie both subtractions below are exact, so the sign of `excess` is too.
    """
    percent = rate * 100.0
    below = F.floor(percent * 10.0)
    middle = (below * 2 + 1).cast("double")
    excess = (percent * 16.0 - middle) + percent * 4.0
    round_up = (excess > 0) | ((excess == 0) & (below % 2 == 1))
    tenths = below + F.when(round_up, 1).otherwise(0)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))


def repeat_rate_text(rate: Column, repeated: Column, eligible: Column) -> Column:
    """A cohort rate with its numerator and base, so that readers can check it."""
    audited = F.concat(
        percent_text(rate), F.lit(" ("), repeated.cast("string"), F.lit(" of "),
        eligible.cast("string"), F.lit(" eligible)"),
    )
    return (
        F.when(eligible == 0, F.lit(NOT_YET_ELIGIBLE)).when(rate.isNull(), F.lit(NO_RATE)).otherwise(audited)
    )
