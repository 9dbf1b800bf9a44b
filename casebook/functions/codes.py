"""Code lists and the flags made from them."""

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.constants import (
    CARDIOVASCULAR_CODES,
    CONDITION_CODES,
    NO_MATCH,
    NON_PRIMARY,
    OTHER_CAUSE,
    OUTCOME_CODES,
    RESOLUTION_CODES,
)


def invert(flags: Mapping[str, Iterable[str]]) -> dict[str, str]:
    """``{flag: codes}`` to ``{code: flag}``; a later flag wins a shared code."""
    return {code: flag for flag, codes in flags.items() for code in codes}


def lookup(value: Column, mapping: Mapping[str, str]) -> Column:
    """The mapped value or null. For lists of fixed, short length; join a table beyond that."""
    literal = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return F.try_element_at(literal, value)


def code_map(value: Column, flags: Mapping[str, Iterable[str]]) -> Column:
    """The flag whose code list holds the value, else null."""
    return lookup(value, invert(flags))


def code_level(column_name: str) -> int:
    """The code level (2, 3 or 4) stated in a column name such as ``DIAG_4_01`` or ``DIAG2_01``."""
    found = re.search(r"([234])_", column_name)
    if not found:
        raise ValueError(f"no code level 2, 3 or 4 in column name {column_name}")
    return int(found.group(1))


def normalise_code(code: Column, level: int) -> Column:
    """Spaces removed, cut to two characters (level 2) or three (levels 3 and 4)."""
    return F.substring(F.translate(code, " ", ""), 1, 2 if level == 2 else 3)


def any_code_matches(codes: Column, wanted: Iterable[str]) -> Column:
    """An array element equals a wanted code, or a wanted code followed by one digit."""
    pattern = f"^({'|'.join(re.escape(c) for c in wanted)})[0-9]?$"
    return F.exists(codes, lambda x: F.coalesce(x.rlike(pattern), F.lit(False)))


def flag_by_primary_or_any(
    primary: Column,
    codes: Column,
    flags: Mapping[str, Iterable[str]] = OUTCOME_CODES,
    listed: Iterable[str] = CARDIOVASCULAR_CODES,
    legacy: bool = False,
) -> Column:
    """Flag of the primary code; else "non primary" if any code is listed; else "no match".

    Codes of the array are compared by their first three characters. ``legacy`` compares them as
    they are, which misses four-character codes.
    """
    compared = codes if legacy else F.transform(codes, lambda x: F.substring(x, 1, 3))
    overlap = F.arrays_overlap(compared, F.array(*(F.lit(c) for c in listed)))
    return F.coalesce(
        code_map(primary, flags), F.when(overlap, F.lit(NON_PRIMARY)), F.lit(NO_MATCH)
    )


def flag_by_prefix(
    code: Column,
    flags: Mapping[str, Iterable[str]] = OUTCOME_CODES,
    default: str = OTHER_CAUSE,
) -> Column:
    """Flag whose prefixes fit the code. The last fitting flag wins; none gives the default."""
    matches = [
        F.when(code.rlike(f"^({'|'.join(prefixes)})"), F.lit(flag))
        for flag, prefixes in flags.items()
    ]
    return F.coalesce(*reversed(matches), F.lit(default))


def assoc_flag(flag: Column, codes_text: Column, name: str, codes: Iterable[str]) -> Column:
    """1 where the main flag is another one (or null) but the code text holds one of the codes."""
    other = flag.isNull() | (flag != name)
    return F.when(other & codes_text.rlike("|".join(codes)), 1).otherwise(0)


def diagnosis(
    cluster: Column, code: Column, conditions: Mapping[str, Iterable[str]] = CONDITION_CODES
) -> Column:
    """Condition a journal row diagnoses: by its cluster, else by its own code, else null."""
    return F.coalesce(code_map(cluster, conditions), code_map(code, conditions))


def resolution(cluster: Column, resolutions: Mapping[str, str] = RESOLUTION_CODES) -> Column:
    """Condition a journal row declares resolved, else null."""
    return lookup(cluster, {c: condition for condition, c in resolutions.items()})
