"""Products fit for sharing."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.constants import NO_MATCH
from casebook.operators.filters import curate_events
from casebook.operators.shaping import add_hash_key, generalise_birth_date
from casebook.plans.labels import LABELS, Labels
from casebook.sources.writers import export_csv_ready


def curated_events(
    events: DataFrame, labels: Labels = LABELS, drop: Sequence[str] = ("birth_date",)
) -> DataFrame:
    """Events of the listed datasets and categories, without irrelevant hospital events."""
    kept = curate_events(events, labels.datasets, labels.categories, labels.admitted, drop)
    return export_csv_ready(kept)


def curated_patients(
    patients: DataFrame, key: str = "patient_key", drop: Sequence[str] = ()
) -> DataFrame:
    """Patients with the year of birth only and a key hashed over all columns."""
    keyed = add_hash_key(patients, key, patients.columns)
    return export_csv_ready(generalise_birth_date(keyed).drop(*drop))


def broken_rules(
    events: DataFrame,
    patients: DataFrame,
    labels: Labels = LABELS,
    events_dropped: Sequence[str] = ("birth_date",),
    patients_dropped: Sequence[str] = (),
) -> DataFrame:
    """(rule, rows) for every rule of sharing, with the number of rows that break it.

    Rules on columns count 1 when broken. One pass over each table.
    """
    return broken_event_rules(events, labels, events_dropped).unionByName(
        broken_patient_rules(patients, patients_dropped)
    )


def broken_event_rules(
    events: DataFrame, labels: Labels = LABELS, dropped: Sequence[str] = ("birth_date",)
) -> DataFrame:
    """The rules about events."""
    hospital = F.col("dataset") == labels.admitted
    return _rules(
        events.agg(
            F.count_if(~F.col("dataset").isin(list(labels.datasets))).alias("events_dataset"),
            F.count_if(~F.col("category").isin(list(labels.categories))).alias("events_category"),
            F.count_if(hospital & (F.col("flag") == NO_MATCH)).alias("events_flag"),
            F.lit(sum(c in events.columns for c in dropped)).alias("events_columns"),
        )
    )


def broken_patient_rules(patients: DataFrame, dropped: Sequence[str] = ()) -> DataFrame:
    """The rules about patients."""
    if "birth_year" in patients.columns:
        bad_year = F.count_if(~F.col("birth_year").rlike("^[0-9]{4}$"))
    else:
        bad_year = F.count("*")
    gone = [*dropped, "birth_date"]
    return _rules(
        patients.agg(
            bad_year.alias("patients_birth_year"),
            F.lit(sum(c in patients.columns for c in gone)).alias("patients_columns"),
        )
    )


def _rules(row: DataFrame) -> DataFrame:
    pairs = F.array(
        *(F.struct(F.lit(c).alias("rule"), F.col(c).cast("bigint").alias("rows"))
          for c in row.columns)
    )
    return row.select(F.explode(pairs).alias("_pair")).select("_pair.*")
