"""Death registrations."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.constants import FIRST_DATE, LINK, OUTCOME_CODES
from casebook.functions.codes import assoc_flag, flag_by_prefix
from casebook.functions.dates import parse_date
from casebook.functions.values import hash_key
from casebook.operators.filters import current_not_cancelled, plausible_dates, region_filter
from casebook.operators.latest import dedup_deaths
from casebook.operators.links import eligible_only
from casebook.operators.shaping import add_source_label, coalesce_id

DATES = ("date_of_death", "birth_date", "registration_date")


def cause_flags(
    df: DataFrame,
    code: str = "code",
    codes_text: str = "code_array",
    flags: Mapping[str, Iterable[str]] = OUTCOME_CODES,
) -> DataFrame:
    """Add the flag of the underlying cause, and a 0/1 column per flag for the other causes."""
    flagged = df.withColumn("flag", flag_by_prefix(F.col(code), flags))
    others = {
        f"flag_assoc_{name.lower()}": assoc_flag(F.col("flag"), F.col(codes_text), name, listed)
        for name, listed in flags.items()
    }
    return flagged.withColumns(others)


def deaths(
    raw: DataFrame,
    dataset: str,
    last,
    first=FIRST_DATE,
    primary_place: str = "residence",
    fallback_place: str = "location",
    eligible: DataFrame | None = None,
    flags: Mapping[str, Iterable[str]] = OUTCOME_CODES,
) -> DataFrame:
    """One death per person, with cause flags and a record id that outlives a corrected record.

    Expects ``death_id, confirmed_id, unconfirmed_id, birth_date, date_of_death,
    registration_date`` (dates as text), ``sex, code, code_array, residence, location, current,
    cancelled``.
    """
    here = region_filter(raw, primary_place, fallback_place)
    current = current_not_cancelled(here, "current", "cancelled")
    dated = current.withColumns({c: parse_date(F.col(c)) for c in DATES})
    plausible = plausible_dates(dated, "birth_date", "date_of_death", first, last)
    known = coalesce_id(plausible, "person_id", "confirmed_id", "unconfirmed_id")
    if eligible is not None:
        known = eligible_only(known, eligible)
    one = dedup_deaths(known, LINK, "date_of_death", "registration_date", "death_id")
    flagged = cause_flags(one, flags=flags).withColumnRenamed("death_id", "record_id_assoc")
    return add_source_label(flagged, dataset).select(
        *LINK, "dataset", "sex", "date_of_death", "flag", "code", "code_array", "residence",
        "location", hash_key(*LINK).alias("record_id"), "record_id_assoc",
        *(f"flag_assoc_{name.lower()}" for name in flags),
    )
