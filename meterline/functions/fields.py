"""Strict field parsers as column expressions.

The accepted texts are those of a strict integer, double and date-time parser,
which differ from a plain Spark cast at the edges:

* integers: no decimals, no blanks inside, a leading ``+`` is fine;
* doubles: ``NaN`` and ``Infinity`` only in that spelling;
* date-times: exactly six fraction digits or none, the same form in both
  fields of a trip; a day past the end of its month means the last day, and
  ``24:00:00`` means the next midnight.

Fields of one type are cast together, as an array. That keeps the generated
method of the parsing stage below the 8,000 bytes above which the JVM does not
compile it, and the edge cases are only looked at in the rows that have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Everything up to and including the space counts as blank at either end.
BLANKS = "".join(chr(code) for code in range(33))
FIRST_NON_BLANK = chr(33)
DELETE = chr(127)
INFINITY = float("inf")

# Accepted shapes. The year 0000 is not a year of the era.
WHOLE = r"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"
MOMENT = WHOLE + r"(?:\.[0-9]{6})?"
PAIR_SHAPE = rf"^{MOMENT},{MOMENT}\z"

# A not-a-number or infinity among joined fields in a spelling other than the accepted one.
BLANK_RUN = r"[\x00-\x20]*+"
ODD_SPELLING = (
    rf"(?:^|,){BLANK_RUN}(?![+-]?(?:NaN|Infinity){BLANK_RUN}(?:,|\z))"
    rf"[+-]?(?i:nan|inf|infinity){BLANK_RUN}(?:,|\z)"
)

# Days past the end of a month: years whose February has 29 days, and all others.
LEAP_YEAR = r"(?:[0-9]{2}(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)"
MONTH_ENDS = [
    (r"-(04|06|09|11)-31 ", r"-$1-30 "),
    (rf"(?<![0-9])({LEAP_YEAR})-02-3[01] ", r"$1-02-29 "),
    (rf"(?<![0-9])(?!{LEAP_YEAR})([0-9]{{4}})-02-(?:29|3[01]) ", r"$1-02-28 "),
    (r" 24:00:00(\.000000)?(?![.0-9])", r" 00:00:00$1"),
]


def trimmed(text: Column) -> Column:
    """The text without blanks at both ends.

    Trimming a set of characters copies the text, so it is done only when the
    first or last character is a blank (sorts before the first non-blank).
    """
    clean = (text >= FIRST_NON_BLANK) & (F.substring(text, -1, 1) >= FIRST_NON_BLANK)
    return F.when(clean, text).otherwise(F.trim(text, F.lit(BLANKS)))


def split_fields(line: Column) -> Column:
    """Fields between commas; quotes mean nothing, empty fields at the end do not count."""
    whole = F.when(line.endswith(","), F.rtrim(line, F.lit(","))).otherwise(line)
    return F.split(whole, ",")


def strict_ints(texts: Column, line: Column) -> Column:
    """Each text as an int or NULL.

    The cast itself drops the blanks at both ends. It would drop DEL as well,
    which is no blank: lines with one have it replaced by something it rejects.
    """
    marked = F.replace(F.array_join(texts, ",", "?"), F.lit(DELETE), F.lit("?"))
    plain = texts.try_cast("array<int>")
    return F.when(
        F.contains(line, F.lit(DELETE)), F.split(marked, ",").try_cast("array<int>")
    ).otherwise(plain)


def strict_doubles(texts: Column) -> Column:
    """Each text as a double or NULL.

    The cast also takes nan, inf and the like. When a result is not finite the
    texts are looked at, and one wrong spelling voids them all.
    """
    numbers = texts.try_cast("array<double>")
    finite = (F.array_max(numbers) < INFINITY) & (F.array_min(numbers) > -INFINITY)
    # NULL, from no number at all, is as good as finite.
    odd = (~finite) & F.array_join(texts, ",").rlike(ODD_SPELLING)
    return F.when(F.coalesce(odd, F.lit(False)), F.lit(None)).otherwise(numbers)


def with_strict_times(frame: DataFrame, first: str, second: str, times: str) -> DataFrame:
    """Add the array ``times`` of two trimmed date-time columns.

    It is NULL when their forms are wrong or differ. The steps are columns of
    their own, as the last one needs the middle one twice.
    """
    one, two = F.col(first), F.col(second)
    pair = F.concat(one, F.lit(","), two)
    shaped = pair.rlike(PAIR_SHAPE) & (F.length(one) == F.length(two))
    mended = pair
    for wrong, right in MONTH_ENDS:
        mended = F.regexp_replace(mended, wrong, right)

    def with_midnight(place: int, text: Column) -> Column:
        moment = F.get("_moved", F.lit(place))
        next_day = moment + F.expr("INTERVAL '1' DAY")
        return F.when(F.substring(text, 12, 2) == "24", next_day).otherwise(moment)

    plain = frame.withColumn(
        "_plain", F.when(shaped, F.array(one, two).try_cast("array<timestamp_ntz>"))
    )
    refused = F.get("_plain", F.lit(0)).isNull() | F.get("_plain", F.lit(1)).isNull()
    moved = plain.withColumn(
        "_moved",
        F.when(
            F.col("_plain").isNotNull() & refused,
            F.split(mended, ",").try_cast("array<timestamp_ntz>"),
        ),
    )
    return moved.withColumn(
        times,
        F.when(F.col("_moved").isNull(), F.col("_plain")).otherwise(
            F.array(with_midnight(0, one), with_midnight(1, two))
        ),
    ).drop("_plain", "_moved")
