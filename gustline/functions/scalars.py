"""Column expressions for typing, cleaning and derived values. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import contract as K

# --- fixed values: the tokens a spreadsheet-style reader treats as missing -----
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# --- fixed values: damage text --------------------------------------------------
NO_DAMAGE_TOKENS = ("", "nan", "NaN", "None", "--", "N/A")
DAMAGE_SUFFIXES = {"K": 1e3, "M": 1e6, "B": 1e9}

WHITESPACE = " \t\n\r\x0b\x0c"


# --- fixed values: the only words that are numbers, and the letters they end with
ODD_NUMBER = r"^(?:[^xX]*[0-9.]|[+-]?(?i:inf|infinity|nan))$"
NUMBER_WORD_ENDS = "fFyYnN"
USUAL_TIME = r"^\d{2}-[A-Za-z]{3}-\d{2} \d{2}:\d{2}:[0-5]\d\z"
MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
MONTH_NUMBERS = "01 02 03 04 05 06 07 08 09 10 11 12 "  # at the same places
EVENT_TIME = r"^(\d{1,2})-([A-Za-z]{3})-(\d{1,2}) +(\d{1,2}):(\d{1,2}):(\d{1,2})$"


def strict_double(text: Column) -> Column:
    """Text to double, NULL when it is not a number.

    The JVM parser throws on dirty cells, which costs far more than looking at the last
    character first; it passes over white space at both ends itself, so a cell is only stripped
    if it ends with some, or like a word that is a number. The parser also takes "1d", "1f"
    and hexadecimal floats; those are not numbers in a data file.
    """
    last = F.right(text, F.lit(1))
    plain = last.isin(*"0123456789.") & ~text.contains("x") & ~text.contains("X")
    odd = last.isin(*WHITESPACE, *NUMBER_WORD_ENDS) & F.btrim(text, F.lit(WHITESPACE)).rlike(ODD_NUMBER)
    return F.when(plain | odd, text.try_cast("double"))


def negative_number(text: Column) -> Column:
    """True for a number below zero; parses only cells with a minus in them."""
    return F.coalesce(text.contains("-") & (strict_double(text) < 0), F.lit(False))


def zero_filled(value: Column) -> Column:
    """NULL and NaN become 0.0; infinities stay."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def coerced(text: Column) -> Column:
    return zero_filled(strict_double(text))


def whole_key(value: Column) -> Column:
    """Double to bigint, half-even, NULL when missing or out of range."""
    number = F.rint(value)
    # 2^63 as a double would come out as the largest bigint
    return F.when((number >= -(2.0**63)) & (number < 2.0**63), number.cast("bigint"))


def integer_key(text: Column) -> Column:
    """Text to bigint through double, half-even, NULL when unreadable or out of range."""
    return whole_key(strict_double(text))


def text_or_unknown(text: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(K.UNKNOWN))


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TOKENS), text)


def filled_then_stripped(text: Column) -> Column:
    """Fill first and strip second, so a cell of blanks ends up empty, not 'Unknown'."""
    filled = F.coalesce(missing_to_null(text), F.lit(K.UNKNOWN))
    return F.btrim(filled, F.lit(WHITESPACE))


def event_time(text: Column) -> Column:
    """``01-APR-24 10:40:00`` to a timestamp, NULL when unreadable.

    Blanks around it, several between date and time, and one-digit parts are read too. Two-digit years pivot at 69 (69 is 1969); the JVM formatter alone reads 2000-2099.
    The shape shown is put together from its places, which is cheaper than the formatter; all others go there.
    """
    def place(start: int, length: int = 2) -> Column:
        return F.substring(text, start, length)

    found = F.position(F.upper(place(4, 3)), F.lit(MONTHS))
    month = F.when(found % 3 == 1, F.substr(F.lit(MONTH_NUMBERS), found, F.lit(2)))
    century = F.when(place(8) >= "69", "19").otherwise("20")
    made = F.concat(century, place(8), F.lit("-"), month, F.lit("-"), place(1), place(10, 9)).try_cast("timestamp")
    return F.when(text.rlike(USUAL_TIME), made).otherwise(_formatted_time(text))


def _formatted_time(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITESPACE))

    def part(group: int) -> Column:
        return F.lpad(F.regexp_extract(trimmed, EVENT_TIME, group), 2, "0")

    clock = F.concat_ws(":", part(4), part(5), part(6))
    whole = F.concat(F.concat_ws("-", part(1), F.regexp_extract(trimmed, EVENT_TIME, 2), part(3)), F.lit(" "), clock)
    # the usual shape needs no rebuilding
    plain = trimmed.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{2} \d{1,2}:\d{2}:\d{2}$")
    shaped = F.when(plain, trimmed).when(trimmed.rlike(EVENT_TIME), whole)
    parsed = F.try_to_timestamp(shaped, F.lit(K.EVENT_TIME_FORMAT))
    two_digit_year = F.substring(F.split_part(shaped, F.lit("-"), F.lit(3)), 1, 2)
    century = F.make_interval(years=F.lit(100))
    return F.when(two_digit_year >= "69", parsed - century).otherwise(parsed)


def damage_usd(text: Column) -> Column:
    """``$1.5M``, ``200K``, ``$2B`` or plain digits to dollars; anything else is 0.0."""
    stripped = F.btrim(text, F.lit(WHITESPACE))
    bare = F.upper(F.translate(stripped, "$,", ""))
    factor = F.lit(1.0)
    for suffix, size in DAMAGE_SUFFIXES.items():
        factor = F.when(bare.endswith(suffix), F.lit(size)).otherwise(factor)
    number = strict_double(F.regexp_replace(bare, "[KMB]$", ""))
    return F.when(
        stripped.isin(*NO_DAMAGE_TOKENS), F.lit(0.0)
    ).otherwise(F.coalesce(number * factor, F.lit(0.0)))


def safe_number(value: Column) -> Column:
    """Anything to double, 0.0 when unreadable; NaN passes through."""
    return F.coalesce(strict_double(value.cast("string")), F.lit(0.0))


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on the binary value, as array libraries do."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def region_flag(text: Column, mode: str = "numeric") -> Column:
    """``numeric``: coerced number, so ``Y`` is 0.0. ``yes_no``: ``Y`` and ``1`` are 1.0."""
    if mode == "numeric":
        return coerced(text)
    if mode == "yes_no":
        yes = F.upper(F.trim(text)).isin("Y", "YES")
        return F.when(yes, F.lit(1.0)).otherwise(coerced(text))
    raise ValueError(f"flag mode must be 'numeric' or 'yes_no', not {mode!r}")


def short_label(name: Column, state: Column) -> Column:
    return F.concat(F.substring(name, 1, 24), F.lit(" ("), state, F.lit(")"))


def risk_verdict(probability: Column) -> dict[str, Column]:
    """Label, rounded probability, confidence band and message for one score."""
    p = probability
    share = F.format_string("%.2f%%", p * 100.0)
    high = p >= 0.5
    # --- fixed values: labels, bands and messages
    return {
        "risk_label": F.when(high, K.HIGH).otherwise("Medium/Low Risk"),
        "risk_probability": half_even(p, 4),
        "confidence": F.when((p >= 0.75) | (p <= 0.25), "High")
        .when((p >= 0.60) | (p <= 0.40), "Medium")
        .otherwise("Low"),
        "message": F.when(
            high,
            F.concat(F.lit("Utility flagged as HIGH RISK (probability: "), share,
                     F.lit("). Recommend infrastructure review.")),
        ).otherwise(
            F.concat(F.lit("Utility classified as lower risk (probability: "), share,
                     F.lit("). Monitor storm exposure."))
        ),
    }


def unit_hash(*cols: Column) -> Column:
    """A value in [0, 1) that depends only on the given columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))
