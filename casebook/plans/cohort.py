"""Extract snapshots to a cohort table and a journal."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.constants import INVALID_ID_PREFIXES, INVALID_IDS, LINK
from casebook.functions.values import hash_key
from casebook.operators.filters import drop_null_rows, filter_values, keep_valid_ids
from casebook.operators.latest import dedup_ladder, dedup_latest_entry
from casebook.operators.links import ref_lookup
from casebook.operators.quality import require_unique
from casebook.operators.shaping import add_hash_key, make_array, rename_map, union_all

TIE_COLUMNS = ("practice", "sex", "lsoa", "ethnicity", "time_stamp", "meta_practice")
JOURNAL_COLUMNS = (
    "person_id", "birth_date", "cohort", "extract_date", "sex", "lsoa", "ethnicity", "extract_id",
)
ENTRY_COLUMNS = ("journal_date", "code", "value1", "value2")


def extract(
    annual: DataFrame,
    quarterly: DataFrame,
    cohorts: Iterable[str],
    key_columns: Sequence[str],
    key: str = "extract_id",
    column: str = "cohort",
) -> DataFrame:
    """Both extracts cut to the eligible cohorts, with a hashed key."""
    wanted = list(cohorts)
    both = union_all([filter_values(df, column, wanted) for df in (annual, quarterly)])
    return add_hash_key(both, key, key_columns)


def linked_rows(
    df: DataFrame,
    deny: Iterable[str] = INVALID_IDS,
    deny_prefixes: Iterable[str] = INVALID_ID_PREFIXES,
) -> DataFrame:
    """Rows with a valid id and no null key."""
    valid = keep_valid_ids(df, LINK[0], deny=deny, deny_prefixes=deny_prefixes)
    return drop_null_rows(valid, LINK)


def with_journal(df: DataFrame) -> DataFrame:
    """Extract rows whose people :func:`clean_extract` keeps, without its sort.

    The row that it keeps of a person and extract holds the newest dated journal entry, so there is one
    exactly where any row has a dated entry (unless columns are named that must not be null).
    """
    return linked_rows(df).where(F.array_max(F.col("journal.journal_date")).isNotNull())


def clean_extract(
    df: DataFrame,
    keys: Sequence[str] = (*LINK, "extract_date"),
    tie_columns: Sequence[str] = TIE_COLUMNS,
    deny: Iterable[str] = INVALID_IDS,
    deny_prefixes: Iterable[str] = INVALID_ID_PREFIXES,
    no_nulls_in: Sequence[str] = (),
    key_columns: Sequence[str] = (),
    key: str = "extract_id",
) -> DataFrame:
    """Valid ids only, no null keys, one row per person and extract.

    ``key_columns`` are those that the hashed key was made from by :func:`extract`; it is then left
    out of the shuffle and made again.
    """
    keyed = linked_rows(df, deny, deny_prefixes)
    return dedup_ladder(
        keyed, keys, "extract_date", "journal", "journal_date", tie_columns, no_nulls_in,
        {key: hash_key(*key_columns)} if key_columns else None,
    )


def cohort_table(clean: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """The row per person and extract, without the journal."""
    renamed = rename_map(clean, names or {"extract_id": "cohort_id"})
    return renamed.select(
        *LINK, "practice", "cohort", "extract_date", "age", "sex", "lsoa", "ethnicity", "cohort_id"
    )


def journal_table(
    clean: DataFrame,
    ref: DataFrame | None,
    columns: Sequence[str] = JOURNAL_COLUMNS,
    entry: Sequence[str] = ENTRY_COLUMNS,
    newest: bool = True,
    years: int | None = None,
    hashed: bool = False,
    identified: bool = True,
) -> DataFrame:
    """One row per journal entry, from the newest extract that holds it, with its code cluster.

    ``ref`` has (ref_code, cluster, active) rows. ``years`` keeps entries of that many years before
    their extract; by default all are kept. ``hashed`` says that every extract id is a key made by
    :func:`extract`: it is then shuffled as 32 bytes, which sort like its 64 letters. Without ``identified``
    there is no ``journal_id``, and extract ids are not read: with one row per person and extract date, as
    :func:`clean_extract` gives, they decide nothing.
    """
    if not identified:
        columns, hashed = [c for c in columns if c != "extract_id"], False
    if hashed:
        clean = clean.withColumn("extract_id", F.unhex("extract_id"))
    rows = clean.select(*columns, F.explode("journal").alias("_entry"))
    rows = rows.select(*columns, *(f"_entry.{c}" for c in entry))
    if years is not None:
        rows = rows.where(F.col("journal_date") > F.add_months("extract_date", -12 * years))
    rows = make_array(rows, "code_array", entry[2:])
    keys = [*LINK, "journal_date", "code", "code_array"]
    journal = dedup_latest_entry(rows, keys, "extract_date", newest, ties=["extract_id"] if identified else [])
    if hashed:
        journal = journal.withColumn("extract_id", F.lower(F.hex("extract_id")))
    if ref is not None:
        journal = ref_lookup(journal, ref, "code", "ref_code", "active")
    if not identified:
        return journal
    journal = add_hash_key(journal, "journal_id", [*_id_parts(journal), "extract_id"])
    return journal.drop("extract_id")


def _id_parts(journal: DataFrame) -> list[str]:
    """What a journal id is hashed from, besides the extract id."""
    parts = ("cohort", "extract_date", "code", "journal_date", "code_array", "cluster")
    return [c for c in parts if c in journal.columns]


def require_unique_entries(entries: DataFrame) -> DataFrame:
    """Raise where journal ids would repeat, for entries without them. This runs a job.

    Extract ids are unique, so ids repeat where a person's extract repeats the parts hashed with it.
    """
    text = F.concat_ws("||", *_id_parts(entries))
    key = F.struct(*LINK, "extract_date", text)
    require_unique(entries.select(key.alias("journal_id")), ["journal_id"], "journal")
    return entries
