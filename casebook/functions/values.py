"""Cleaning of single values, keys and arrays."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.constants import BLANKS, INVALID_ID_PREFIXES, INVALID_IDS


def null_if_in(value: Column, unwanted: Iterable) -> Column:
    """Null for the listed values, everything else as it is."""
    return F.when(value.isin(list(unwanted)), None).otherwise(value)


def null_if_blank(value: Column) -> Column:
    """Null for empty text and the spellings of "null"."""
    return null_if_in(value, BLANKS)


def has_text(value: Column) -> Column:
    """Neither null, empty nor a spelling of "null"."""
    return value.isNotNull() & ~value.isin(list(BLANKS))


def starts_with_any(value: Column, prefixes: Iterable[str]) -> Column:
    """The text starts with one of the prefixes."""
    found = F.lit(False)
    for prefix in prefixes:
        found = found | value.startswith(prefix)
    return found


def check_digit_ok(number: Column) -> Column:
    """Ten digits whose last one is the modulus-11 check digit of the first nine.

    The first nine digits are weighted 10 down to 2. The check digit is 11 minus the remainder by
    11, where 11 counts as 0; a remainder that would ask for 10 has no valid digit.
    """
    digit = [F.ascii(F.substring(number, i, 1)) - 48 for i in range(1, 11)]
    total = sum((digit[i] * (10 - i) for i in range(1, 9)), digit[0] * 10)
    return number.rlike("^[0-9]{10}$") & ((F.lit(11) - total % 11) % 11 == digit[9])


def valid_id(
    number: Column,
    deny: Iterable[str] = INVALID_IDS,
    deny_prefixes: Iterable[str] = INVALID_ID_PREFIXES,
) -> Column:
    """Check digit right, not on the deny list, no denied prefix; false for null."""
    ok = check_digit_ok(number) & ~number.isin(list(deny))
    return F.coalesce(ok & ~starts_with_any(number, deny_prefixes), F.lit(False))


def hash_key(*parts: Column | str, null_token: str | None = None) -> Column:
    """SHA-256 (hex) of the parts joined by ``||``.

    Nulls are left out and arrays are spliced in element by element, so that ``[120, null]`` and
    ``[null, 120]`` give the same key. ``null_token`` writes that token for a null part instead.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    if not columns:
        raise ValueError("a key needs at least one column")
    if null_token is not None:
        columns = [F.coalesce(c.cast("string"), F.lit(null_token)) for c in columns]
    return F.sha2(F.concat_ws("||", *columns), 256)


def split_codes(text: Column, delimiter: str = ",") -> Column:
    """Delimited text to an array, spaces removed first; null stays null."""
    return F.split(F.translate(text, " ", ""), delimiter)


def joined(array: Column) -> Column:
    """An array as comma text; null stays null."""
    return F.when(array.isNotNull(), F.array_join(array, ","))


def present(array: Column) -> Column:
    """The non-null elements, repeats kept."""
    return F.filter(array, lambda x: x.isNotNull())
