"""Hospital episodes: extraction over years and stores, and preparation."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.constants import INVALID_CODE, LINK
from casebook.functions.codes import flag_by_primary_or_any
from casebook.functions.values import split_codes
from casebook.operators.filters import primary_code_filter
from casebook.operators.links import eligible_only, link_inner, link_left
from casebook.operators.quality import require_unique
from casebook.operators.shaping import (
    add_source_label,
    concat_code_columns,
    normalise_code,
    restore_full_code,
)
from casebook.operators.spells import spell_bounds
from casebook.sources.readers import union_yearly

Years = Mapping[str, DataFrame]


def hospital_extract(
    main: tuple[Years, Years],
    sensitive: tuple[Years, Years],
    start: int,
    end: int,
    link_key: str,
    columns: Sequence[str] | None = None,
    sensitive_columns: Sequence[str] | None = None,
    spells: tuple[Years, Years] | None = None,
    spell_columns: tuple[str, str] = ("episode_key", "spell_id"),
    year_column: str = "fyear",
    renames: Mapping[str, str] | None = None,
    sensitive_start: int | None = None,
) -> DataFrame:
    """Episodes of several years with their identifiers and, for admissions, spell ids.

    Each of ``main``, ``sensitive`` and ``spells`` is an (old store, new store) pair of yearly
    tables. ``sensitive_start`` reads fewer years of identifiers. A spell id table that repeats an
    episode would multiply it, so its keys are checked (this runs a job) and a repeat raises.
    """
    records = union_yearly(*main, start, end, renames=renames)
    first = start if sensitive_start is None else sensitive_start
    people = union_yearly(*sensitive, first, end, renames=renames, drop=[year_column])
    linked = link_inner(records, people, [link_key], columns, sensitive_columns)
    if spells is None:
        return linked
    ids = union_yearly(*spells, start, end, columns=spell_columns, renames=renames)
    require_unique(ids, [spell_columns[0]], "spell ids")
    return link_left(linked, ids, [spell_columns[0]])


def hospital_prep(
    df: DataFrame,
    dataset: str,
    code: str,
    code_list: str,
    admitted: bool = False,
    numbered_prefix: str | None = None,
    coded_only: bool = False,
    eligible: DataFrame | None = None,
    legacy: bool = False,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Codes cleaned and listed; for admissions also outcome flags and spell dates.

    The code column's name states its level. ``numbered_prefix`` builds the code list from numbered
    columns. ``eligible`` restricts to eligible people: a spell's dates come from all of
    its episodes, also from those whose identifiers do not match. ``store`` writes the cleaned episodes and
    reads them back, since those of admissions are read several times.
    """
    if numbered_prefix:
        df = concat_code_columns(df, code_list, numbered_prefix)
    clean = normalise_code(df, code, INVALID_CODE)
    if coded_only:
        clean = primary_code_filter(clean, code)
    clean = store(clean) if store else clean
    # Lists and flags are made after the join with the spell dates, which shuffles the codes as text.
    if admitted:
        listed = spell_bounds(clean, people=eligible)
    else:
        listed = clean if eligible is None else eligible_only(clean, eligible)
    listed = listed.withColumn(code_list, split_codes(F.col(code_list)))
    if admitted:
        flag = flag_by_primary_or_any(F.col(code), F.col(code_list), legacy=legacy)
        dates = [c for c in listed.columns if c not in clean.columns]
        flagged = listed.withColumn("flag", flag)
        listed = flagged.select(*(c for c in flagged.columns if c not in dates), *dates)
    full = restore_full_code(listed, code)
    full = full.withColumnsRenamed({code: "code", code_list: "code_array"})
    if eligible is not None:
        full = full.select(*LINK, *(c for c in full.columns if c not in LINK))
    return add_source_label(full, dataset)


def eligible_people(cohort: DataFrame) -> DataFrame:
    """The distinct people of the cohort (or of :func:`casebook.plans.cohort.with_journal`)."""
    return cohort.select(*LINK).distinct()
