"""A full run: every product is written once and read back as the input of the next."""

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame

from casebook.constants import FIRST_READING_DATE, LINK
from casebook.functions.values import hash_key
from casebook.operators.quality import require_unique
from casebook.operators.spells import spell_members
from casebook.plans import cohort as cohort_plan
from casebook.plans import curation, journal
from casebook.plans import demographic as demographic_plan
from casebook.plans import events as events_plan
from casebook.plans import patient as patient_plan
from casebook.plans import report as report_plan
from casebook.plans.deaths import deaths
from casebook.plans.hospital import eligible_people, hospital_prep
from casebook.plans.labels import LABELS, Labels
from casebook.session import shared_dir
from casebook.sources.writers import keep


def _ruled(df: DataFrame, broken: DataFrame) -> DataFrame:
    """The frame, unless rows of it break a rule."""
    found = broken.where("rows > 0").select("rule").collect()
    if found:
        raise RuntimeError(f"rules of sharing are broken: {', '.join(sorted(r.rule for r in found))}")
    return df


PRODUCTS = (
    "extract", "clean_extract", "cohort", "journal", "people", "episodes", "deaths", "readings",
    "diagnoses", "events", "spell_members", "demographic", "patient_base", "patient", "curated_events", "curated_patients",
    "unexpected_values", "report", "metrics",
)


@dataclass(frozen=True)
class Sources:
    """Inputs of a run.

    The hospital frames are results of ``hospital_extract`` with canonical column names; ``codes``
    names the code and code-list columns of the admitted episodes.
    """

    annual: DataFrame
    quarterly: DataFrame
    admitted: DataFrame
    outpatient: DataFrame
    emergency: DataFrame
    deaths: DataFrame
    cluster_ref: DataFrame
    ethnicity_ref: DataFrame
    codes: tuple[str, str] = ("DIAG_4_01", "DIAG_4_CONCAT")


@dataclass
class Run:
    """The products of some sources, each an attribute that is written when first asked for.

    A product is written below ``out`` (a shared folder by default) and read back, so that what
    follows starts from a table. Keys that must be unique are checked before a product is published; a
    repeated key, or a failed row of the report, raises. ``seconds`` holds the time of each write.

    A second run with the same ``out`` takes over the products whose inputs and plans are the same, also
    those that a run finished before it died, and makes the others. ``observed`` holds the counts that the
    report needs, gathered while a product is written.
    """

    sources: Sources
    cohorts: Sequence[str]
    extract_key: Sequence[str]
    last_death: object
    emergency_from: int
    first_reading: object = FIRST_READING_DATE
    tie_columns: Sequence[str] = cohort_plan.TIE_COLUMNS
    labels: Labels = LABELS
    out: str | None = None
    seconds: dict[str, float] = field(default_factory=dict)
    observed: dict[str, dict] = field(default_factory=dict)

    def _keep(
        self, name: str, df: DataFrame, unique: Sequence[str] = (), by: Sequence[str] = (),
        observed: dict[str, Column] | None = None, derived: dict[str, Column] | None = None,
        staged: Callable[[Callable[[DataFrame], DataFrame]], DataFrame] | None = None,
    ) -> DataFrame:
        """Write a product; ``derived`` columns follow from the others and are added when it is read.

        ``staged`` makes the same rows by way of stored stages, which are removed when the product is written.
        """
        whole = lambda rows: rows.withColumns(derived) if derived else rows
        self.out = self.out or shared_dir(df.sparkSession, "run")
        began = time.perf_counter()
        check = (lambda rows: require_unique(whole(rows), unique, name)) if unique else None
        written, self.observed[name], new = keep(
            df.drop(*(derived or ())), f"{self.out}/{name}", by, observed, check, staged
        )
        if new:
            self.seconds[name] = time.perf_counter() - began
        return whole(written).select(*df.columns)

    @property
    def _extract_id(self) -> dict[str, Column]:
        """The hashed key of the extract, which is stored with the products that lack its parts only."""
        return {"extract_id": hash_key(*self.extract_key)}

    @cached_property
    def extract(self) -> DataFrame:
        """Both extracts, eligible cohorts only."""
        s = self.sources
        df = cohort_plan.extract(s.annual, s.quarterly, self.cohorts, self.extract_key)
        return self._keep("extract", df, ["extract_id"], derived=self._extract_id)

    @cached_property
    def clean_extract(self) -> DataFrame:
        """One row per person and extract, with the nested journal."""
        df = cohort_plan.clean_extract(
            self.extract, tie_columns=self.tie_columns, key_columns=self.extract_key
        )
        return self._keep("clean_extract", df, derived=self._extract_id)

    @cached_property
    def cohort(self) -> DataFrame:
        """One row per person and extract."""
        return self._keep("cohort", self.cohort_rows, ["cohort_id"])

    @property
    def cohort_rows(self) -> DataFrame:
        """The same rows from the clean extract, which is stored and has all of them; not written again."""
        return cohort_plan.cohort_table(self.clean_extract)

    @cached_property
    def journal(self) -> DataFrame:
        """One row per journal entry."""
        df = cohort_plan.journal_table(
            self.clean_extract, self.sources.cluster_ref, hashed=True
        )
        return self._keep("journal", df, ["journal_id"])

    @cached_property
    def entries(self) -> DataFrame:
        """The journal for other products: as it is if it was asked for, else written without its ids.

        That is no product of its own. Repeated ids raise in both cases.
        """
        if "journal" in self.__dict__:
            return self.journal
        df = cohort_plan.journal_table(self.clean_extract, self.sources.cluster_ref, identified=False)
        return keep(df, f"{self.out}/entries", check=cohort_plan.require_unique_entries)[0]

    @cached_property
    def people(self) -> DataFrame:
        """The people of the cohort; they are known before it is made."""
        return self._keep("people", eligible_people(cohort_plan.with_journal(self.extract)))

    @cached_property
    def episodes(self) -> DataFrame:
        """Hospital episodes of the cohort."""
        people = self.people

        def prepared(store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
            return hospital_prep(
                self.sources.admitted, self.labels.admitted, *self.sources.codes, admitted=True,
                eligible=people, store=store,
            )

        return self._keep("episodes", prepared(), ["record_id"], staged=prepared)

    @cached_property
    def deaths(self) -> DataFrame:
        """Deaths in the cohort."""
        df = deaths(
            self.sources.deaths, self.labels.deaths, self.last_death, eligible=self.people
        )
        return self._keep("deaths", df, ["record_id"])

    @cached_property
    def readings(self) -> DataFrame:
        """Blood-pressure readings."""
        df = journal.blood_pressure(self.entries, self.labels.readings, self.first_reading)
        key = {"record_id": journal.reading_id()}
        return self._keep("readings", df, ["record_id"], derived=key)

    @cached_property
    def diagnoses(self) -> DataFrame:
        """Diagnosis dates per person."""
        return self._keep("diagnoses", journal.diagnosis(self.entries), LINK)

    @cached_property
    def events(self) -> DataFrame:
        """The events table, stored by dataset and category."""
        df = events_plan.events(
            self.cohort_rows, self.episodes, self.deaths, self.readings, self.labels
        )
        counts = report_plan.events_counts(df, self.labels)
        return self._keep("events", df, ["record_id"], ["dataset", "category"], counts)

    @cached_property
    def demographic(self) -> DataFrame:
        """One ethnicity per person."""
        df = demographic_plan.demographic(
            self.events, self.entries, self.sources.outpatient, self.sources.emergency,
            self.sources.ethnicity_ref, self.emergency_from, self.labels,
        )
        return self._keep("demographic", df, LINK)

    @cached_property
    def patient(self) -> DataFrame:
        """The patient table."""
        df = patient_plan.patient(
            self.events, self.diagnoses, self.demographic, self.labels, self.patient_base
        )
        return self._keep("patient", df, LINK, observed=report_plan.patient_counts(df, self.cohorts))

    @cached_property
    def patient_base(self) -> DataFrame:
        """The newest cohort event of each person."""
        return self._keep("patient_base", patient_plan.base(self.events, self.labels))

    @cached_property
    def spell_members(self) -> DataFrame:
        """The episodes of each spell as rows."""
        return self._keep("spell_members", spell_members(self.episodes))

    @cached_property
    def curated_events(self) -> DataFrame:
        """Events for sharing; broken rules raise."""
        df = self._keep("curated_events", curation.curated_events(self.events, self.labels))
        return _ruled(df, curation.broken_event_rules(df, self.labels))

    @cached_property
    def curated_patients(self) -> DataFrame:
        """Patients for sharing; broken rules raise."""
        df = curation.curated_patients(self.patient)
        written = self._keep("curated_patients", df, ["patient_key"])
        return _ruled(written, curation.broken_patient_rules(written))

    @cached_property
    def unexpected_values(self) -> DataFrame:
        """Every unexpected group value; the report's messages name the first of them."""
        df = report_plan.unexpected_values(self.events, self.patient, self.cohorts, self.labels)
        return self._keep("unexpected_values", df)

    @cached_property
    def report(self) -> DataFrame:
        """The report on events and patients."""
        events, patients = self.events, self.patient
        df = report_plan.report(events, patients, self.cohorts, self.labels, self.observed["events"], self.observed["patient"])
        written = self._keep("report", df)
        if not report_plan.failures(written).isEmpty():
            raise RuntimeError("the report has failures: see the report table")
        return written

    @cached_property
    def metrics(self) -> DataFrame:
        """Counts of the products, times of the writes so far, and rows about the whole run.

        The cohort and the journal belong to it, though nothing else needs the first of them. So it is written
        last, and takes no room beside the shuffles of the events.
        """
        self.journal  # noqa: B018
        df = report_plan.run_metrics(self.events, self.patient, self.demographic)
        self.cohort  # noqa: B018
        times = report_plan.timing_rows(df.sparkSession, self.seconds)
        return self._keep("metrics", df.unionByName(times))

    def all(self) -> dict[str, DataFrame]:
        """Every product by name."""
        return {name: getattr(self, name) for name in PRODUCTS}
