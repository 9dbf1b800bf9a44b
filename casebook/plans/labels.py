"""Names the products give to their sources."""

from dataclasses import dataclass

from casebook.constants import EPISODE, SPELL


@dataclass(frozen=True)
class Labels:
    """Dataset and category labels of the events table, and the source priority."""

    cohort: str = "cohort"
    cohort_category: str = "cohort_extract"
    readings: str = "readings"
    readings_category: str = "bp"
    admitted: str = "admitted"
    episode_category: str = EPISODE
    spell_category: str = SPELL
    deaths: str = "deaths"
    deaths_category: str = "death"
    journal: str = "journal"
    emergency: str = "emergency"
    outpatient: str = "outpatient"

    @property
    def priority(self) -> tuple[str, ...]:
        """Which source's value counts when several have one on the same day."""
        return (self.journal, self.admitted, self.emergency, self.outpatient)

    @property
    def datasets(self) -> tuple[str, ...]:
        """Datasets of the events table."""
        return (self.cohort, self.readings, self.admitted, self.deaths)

    @property
    def categories(self) -> tuple[str, ...]:
        """Categories of the events table."""
        return (
            self.cohort_category,
            self.readings_category,
            self.episode_category,
            self.spell_category,
            self.deaths_category,
        )


LABELS = Labels()
