"""Silver layer: validated, time-normalised, deduplicated events and their dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.operators.dedup import exact_dedup
from hearthline.operators.near_duplicates import drop_near_duplicates
from hearthline.operators.quality import quality_metrics, stage_counters, stage_counts
from hearthline.operators.validate import rejected_events, valid_events, with_rejection_reason
from hearthline.schemas import ARRIVAL, BRONZE, IDENTITY, SIMILARITY_THRESHOLD
from hearthline.session import staged


@dataclass(frozen=True)
class SilverOptions:
    """How events are cleansed; the defaults suit the device messages."""

    lenient_times: bool = True
    device_type_mode: str = "none"
    near_duplicates: bool = True
    threshold: float = SIMILARITY_THRESHOLD
    case_insensitive: bool = True
    match_timestamp: bool = True
    order: Sequence[str] = field(default_factory=lambda: list(ARRIVAL))


class Silver:
    """The outputs of the layer, each built when it is first asked for."""

    def __init__(self, bronze: DataFrame, processed_at: str, options: SilverOptions):
        self._judged = with_rejection_reason(bronze, options.lenient_times)
        self._stamp = F.lit(processed_at).alias("_silver_processed_at")
        self._options = options
        names = [f.name for f in BRONZE.fields]
        extra = [c for c in bronze.columns if c not in names]
        self._columns = [c for c in names if c in self._judged.columns] + extra

    @cached_property
    def valid(self) -> DataFrame:
        """Accepted events before deduplication."""
        return valid_events(self._judged, self._options.device_type_mode)

    @cached_property
    def exact(self) -> DataFrame:
        """Accepted events without exact copies, written to the shared folder: what counters and later steps read."""
        return staged(exact_dedup(self.valid, self._options.order, IDENTITY), "exact-events")

    @cached_property
    def events(self) -> DataFrame:
        """Silver events. Writing the exact ones and looking for near duplicates runs jobs first."""
        return without_near_duplicates(self.exact, self._options).select(*self._columns, self._stamp)

    @cached_property
    def dead_letters(self) -> DataFrame:
        """Rejected rows with the reason."""
        return rejected_events(self._judged).select(*self._columns, self._stamp, "_rejection_reason")

    def counters(self, by: Sequence[str] = ()) -> DataFrame:
        """Wide counters of the stages, of all or per load, as sums that can be added up."""
        return stage_counters(self._judged, self.exact, self.events, by)

    def stages_for(self, events: DataFrame) -> DataFrame:
        """Rows per stage, with the silver events given, for example as read back from their table."""
        return stage_counts(self._judged, self.exact, events)

    @property
    def stages(self) -> DataFrame:
        return self.stages_for(self.events)

    @property
    def metrics(self) -> DataFrame:
        return quality_metrics(self.stages)


def without_near_duplicates(exact: DataFrame, options: SilverOptions) -> DataFrame:
    """What near duplicates leave of a written table of one event per identity."""
    if not options.near_duplicates:
        return exact
    return drop_near_duplicates(
        exact, options.threshold, options.case_insensitive, options.match_timestamp, options.order, is_exact=True
    )


def deduplicated(valid: DataFrame, options: SilverOptions) -> DataFrame:
    """Valid events without duplicates; whole events are shuffled once."""
    return without_near_duplicates(staged(exact_dedup(valid, options.order, IDENTITY), "exact-events"), options)


def build_silver(bronze: DataFrame, processed_at: str, options: SilverOptions = SilverOptions()) -> Silver:
    """Silver events, dead letters and row counts per stage of a bronze table."""
    return Silver(bronze, processed_at, options)
