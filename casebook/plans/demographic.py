"""One ethnicity per person, completed from other sources where the cohort has none."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.constants import LINK, UNKNOWN_ETHNICITY
from casebook.operators.filters import events_of, from_year
from casebook.operators.latest import latest_prefer_non_null, null_conflicts, priority_source
from casebook.operators.links import eligible_only, ref_map_inner
from casebook.operators.shaping import add_source_label, null_if_in, union_all
from casebook.plans.labels import LABELS, Labels

DAY = "record_start_date"
VALUE = "ethnicity"
KEYS = (*LINK, "dataset")
COLUMNS = (*KEYS, DAY, VALUE)


def known_values(cohort_events: DataFrame) -> DataFrame:
    """The cohort's own newest value per person; null where it has none or contradicts itself."""
    rows = null_if_in(cohort_events.select(*COLUMNS), VALUE, UNKNOWN_ETHNICITY)
    newest = latest_prefer_non_null(rows, KEYS, DAY, VALUE)
    return null_conflicts(newest, [*KEYS, DAY], VALUE)


def candidates(
    journal: DataFrame,
    hospital: Sequence[DataFrame],
    ref: DataFrame,
    labels: Labels = LABELS,
) -> DataFrame:
    """Dated known values per person from the journal and the hospital sources.

    ``ref`` has (ref_code, ethnicity) rows and says which journal codes state a value.
    """
    rows = journal.select(*LINK, F.col("journal_date").alias(DAY), "code")
    stated = add_source_label(ref_map_inner(rows, ref, "code", "ref_code"), labels.journal)
    every = union_all([df.select(*COLUMNS) for df in (stated, *hospital)])
    return null_if_in(every, VALUE, UNKNOWN_ETHNICITY).where(F.col(VALUE).isNotNull())


def demographic(
    events: DataFrame,
    journal: DataFrame,
    outpatient: DataFrame,
    emergency: DataFrame,
    ref: DataFrame,
    emergency_from: int,
    labels: Labels = LABELS,
    legacy: bool = False,
) -> DataFrame:
    """One row per cohort member, with ``enhanced_ethnicity_flag`` 1 where others were asked.

    The other sources are cut to people with an unknown value first. Their newest value needs no
    search per source: the newest day over all sources is the newest day of each source on it.
    """
    own = known_values(events_of(events, labels.cohort, labels.cohort_category))
    unknown = own.where(F.col(VALUE).isNull())
    admitted = events_of(events, labels.admitted, labels.episode_category)
    hospital = [admitted, outpatient, from_year(emergency, DAY, emergency_from)]
    asked = eligible_only(candidates(journal, hospital, ref, labels), unknown)
    single = priority_source(asked, LINK, DAY, "dataset", VALUE, labels.priority, legacy)
    found = single.withColumnsRenamed({c: f"_{c}" for c in COLUMNS if c not in LINK})
    missing = F.col(VALUE).isNull()
    filled = {
        c: F.when(missing, F.col(f"_{c}")).otherwise(F.col(c)) for c in COLUMNS if c not in LINK
    }
    flag = F.when(missing, 1).otherwise(0).alias("enhanced_ethnicity_flag")
    columns = [filled[c].alias(c) if c in filled else F.col(c) for c in COLUMNS]
    return own.join(found, list(LINK), "left").select(*columns, flag)
