"""Card number expressions. All are plain columns, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INVALID_PAN = "InvalidPANError"


def normalise(pan: Column) -> Column:
    """Drop whitespace and hyphens."""
    return F.regexp_replace(pan, r"(?U)[\s\-]", "")


def luhn_valid(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def pan_error(digits: Column) -> Column:
    """First structural fault of a normalised card number, or null. Never quotes the number."""
    return (
        F.when(~digits.rlike(r"^[0-9]+\z"), F.lit("PAN contains non-digit characters"))
        .when(
            ~F.length(digits).isin(15, 16),
            F.concat(
                F.lit("PAN length "),
                F.length(digits).cast("string"),
                F.lit(" is invalid (expected 15 or 16 digits)"),
            ),
        )
        .when(~luhn_valid(digits), F.lit("Luhn check failed"))
    )


def card_bin(digits: Column) -> Column:
    return F.substring(digits, 1, 6)


def card_last4(digits: Column) -> Column:
    return F.right(digits, F.lit(4))


def masked_display(digits: Column) -> Column:
    """First six and last four digits around one star per hidden digit."""
    return F.concat(
        card_bin(digits),
        F.repeat(F.lit("*"), F.length(digits) - 10),
        card_last4(digits),
    )


def with_check_digit(partial: Column, length: int) -> Column:
    """Append the Luhn digit to a number of ``length`` digits."""
    total = F.lit(0)
    for position in range(length):
        digit = F.substring(partial, length - position, 1).cast("int")
        if position % 2 == 0:
            digit = digit * 2
            digit = F.when(digit > 9, digit - 9).otherwise(digit)
        total = total + digit
    return F.concat(partial, F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))
