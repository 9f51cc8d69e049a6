"""Extracts of a target drug's cohort from the OMOP-shaped tables.

:class:`Cohort` stages narrow tables once: the target-drug set, the index days,
the outpatient days of their persons, one row per person with the first and
last outpatient exposure, and one row per person and outpatient day inside the
window. A window filter followed by a visit join is the same as a join with
those days, so the visits are read once, and every extract reads its event
table once and matches it with them on person and date.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrocohort.functions.scalars import safe_date
from retrocohort.operators import concepts as C
from retrocohort.operators import events as E
from retrocohort.operators import exposure as X
from retrocohort.operators.persons import merge_covariates
from retrocohort.sources.schemas import EXTRACTS, require_columns
from retrocohort.sources.sinks import Saves
from retrocohort.sources.tables import CdmTables
from retrocohort.staging import BROADCAST_BYTES, Bloom, Lookup, bloom, lookup, side_by_side, stage, stored


@dataclass(frozen=True)
class CohortParams:
    """What to study: the target drug, the biomarker and the thresholds.

    The upper bound depends on the biomarker and so has no default.
    """

    drug_concept_id: int
    biomarker_concept_id: int
    upper_bound_biomarker: float
    lower_bound_biomarker: float = 0
    visit_concept_id: int = E.OUTPATIENT_VISIT
    window_months: int = 12
    broadcast_bytes: int = BROADCAST_BYTES


def drug_concepts(cdm: CdmTables, params: CohortParams) -> DataFrame:
    return C.concept_set(
        cdm.get("concept"), cdm.get("concept_ancestor"), params.drug_concept_id, C.DRUG_DOMAIN
    )


def biomarker_concepts(cdm: CdmTables, params: CohortParams) -> DataFrame:
    return C.concept_set(
        cdm.get("concept"),
        cdm.get("concept_ancestor"),
        params.biomarker_concept_id,
        C.MEASUREMENT_DOMAIN,
    )


class Cohort:
    """Staged tables shared by the extracts; each is written when first needed."""

    def __init__(self, cdm: CdmTables, params: CohortParams):
        self.cdm = cdm
        self.params = params

    def _lookup(self, df: DataFrame, label: str) -> Lookup:
        return lookup(df, label, self.params.broadcast_bytes)

    def _visits(self) -> DataFrame:
        return E.outpatient_visits(self.cdm.get("visit_occurrence"), self.params.visit_concept_id)

    @cached_property
    def drug_set(self) -> Lookup:
        return self._lookup(drug_concepts(self.cdm, self.params).select("concept_id").distinct(), "drug_set")

    @cached_property
    def biomarker_set(self) -> Lookup:
        return self._lookup(
            biomarker_concepts(self.cdm, self.params).select("concept_id").distinct(), "biomarker_set"
        )

    @cached_property
    def wanted_drugs(self) -> Lookup:
        """The indication drugs and the target drugs."""
        wanted = X.wanted_drugs(self.cdm.get("indication_ancestor"), self.drug_set.table)
        return self._lookup(wanted, "wanted_drugs")

    @cached_property
    def index_days(self) -> Lookup:
        """Distinct person and date of the target-drug exposures, any visit type."""
        index = X.index_exposures(
            self.cdm.get("drug_exposure"), self.drug_set, self.params.drug_concept_id
        )
        return self._lookup(
            index.select("person_id", "drug_exposure_start_date").distinct(), "index_days"
        )

    @cached_property
    def persons(self) -> Lookup:
        """Persons with an index day."""
        found = self.index_days.table.select("person_id").distinct()
        return Lookup(found, True) if self.index_days.small else self._lookup(found, "index_persons")

    @cached_property
    def visits(self) -> DataFrame:
        """Outpatient days of the persons, with the number of visits on each; the only scan of visits.

        No window reaches further than ``window_months`` from an index day.
        """
        visits, months = self._of_persons(self._visits()), abs(self.params.window_months)
        if ends := self.index_days.ends.get("drug_exposure_start_date"):
            first, last = F.add_months(F.lit(ends[0]), -months), F.add_months(F.lit(ends[1]), months)
            visits = visits.where(F.col("visit_start_date").between(first, last))
        return stage(E.visit_days(visits.join(self.persons.side, "person_id", "left_semi")), "visits")

    @cached_property
    def person_filter(self) -> Bloom | None:
        """A Bloom filter of the persons, where they are too many to be sent to the executors."""
        if self.persons.small:
            return None
        return bloom(self.persons, "person_id", self.params.broadcast_bytes)

    def _of_persons(self, events: DataFrame) -> DataFrame:
        """Events that may be of the persons; what remains of others goes with the join behind it."""
        return self.person_filter.keep(events, "person_id") if self.person_filter else events

    @cached_property
    def ranges(self) -> Lookup:
        """Per person the first and last outpatient exposure and the window around the first."""
        days = self.index_days.side.withColumnRenamed("drug_exposure_start_date", "visit_start_date")
        at_visits = self.visits.join(days, ["person_id", "visit_start_date"], "left_semi").select(
            "person_id",
            F.lit(int(self.params.drug_concept_id)).cast("long").alias("drug_concept_id"),
            F.col("visit_start_date").alias("drug_exposure_start_date"),
        )
        return self._lookup(X.with_window(X.exposure_span(at_visits), self.params.window_months), "ranges")

    def _of_ranges(self, *columns: str) -> Lookup:
        ranges = self.ranges
        return Lookup(ranges.table.select(*columns), ranges.small, ranges.ends, ranges.n_rows)

    @property
    def span(self) -> Lookup:
        """First and last outpatient exposure per person."""
        return self._of_ranges("person_id", "drug_concept_id", "first_drug_exposure", "last_drug_exposure")

    @property
    def window(self) -> Lookup:
        """Date range per person."""
        return self._of_ranges("person_id", "start_date", "end_date")

    @cached_property
    def days(self) -> Lookup:
        """Outpatient days inside the window, with the window's dates and the number of visits."""
        found = E.in_window(self.visits, self.window, "visit_start_date")
        return self._lookup(found, "days")

    @cached_property
    def dates(self) -> Lookup:
        """The dates of the days; there are never more than the calendar has."""
        return self._lookup(self.days.table.groupBy("visit_start_date").agg(F.sum("n_visits").alias("n_visits")), "dates")

    def at_days(self, events: DataFrame, date_column: str, once: bool) -> DataFrame:
        """Events on an outpatient day in the window, with the window's dates.

        ``once`` gives distinct rows; otherwise a row appears once per visit,
        unfolded last. The dates of the days filter the scan, and prune the
        partitions of a table partitioned by date. Persons that fit a broadcast
        drop the events of others there as well, and a Bloom filter of the
        persons does where they do not; the days join is a broadcast or a
        shuffle on person and date. Repeats collapse before a shuffle, and
        after a broadcast has filtered them.
        """
        events = self.days.within(events, date_column, "visit_start_date")
        if not self.days.small:
            if self.window.small:
                events = events.join(F.broadcast(self.window.table.select("person_id")), "person_id", "left_semi")
            else:
                events = self._of_persons(events)
            if self.dates.small:
                dates = self.dates.table.where(F.col("n_visits") > 0).select(F.col("visit_start_date").alias(date_column))
                events = events.join(F.broadcast(dates), date_column, "left_semi")
            events = events.distinct() if once else events
        found = E.at_outpatient_visit(events, self.days, date_column, keep_duplicates=not once)
        return found.distinct() if once and self.days.small else found


def _cohort(cdm: CdmTables, params: CohortParams, cohort: Cohort | None) -> Cohort:
    return cohort or Cohort(cdm, params)


def covariates_extract(
    cdm: CdmTables, params: CohortParams, cohort: Cohort | None = None
) -> DataFrame:
    """Covariates and exposure span of everyone with an outpatient exposure.

    The span only holds persons with an index exposure, so the persons need no
    join with the exposures of their own.
    """
    cohort = _cohort(cdm, params, cohort)
    persons = cdm.get("person").select(
        "person_id",
        F.to_date("birth_datetime").alias("dob"),
        "gender_concept_id",
        "race_concept_id",
    )
    return merge_covariates(persons, cohort.span.side)


def drugs_extract(
    cdm: CdmTables, params: CohortParams, cohort: Cohort | None = None, selected: bool = False
) -> DataFrame:
    """Distinct outpatient drug exposures inside the window.

    ``selected`` keeps the indication drugs and the target drugs; their ids
    filter the exposures before any other join.
    """
    cohort = _cohort(cdm, params, cohort)
    exposures = E.mapped_exposures(cdm.get("drug_exposure"))
    if selected:
        exposures = E.of_concepts(exposures, "drug_concept_id", cohort.wanted_drugs)
    found = cohort.at_days(exposures, "drug_exposure_start_date", once=True)
    return found.select(*EXTRACTS["drugs"].fieldNames())


def biomarkers_extract(
    cdm: CdmTables, params: CohortParams, cohort: Cohort | None = None
) -> DataFrame:
    """Bounded biomarker values on outpatient days inside the window.

    A value appears once per outpatient visit on its day, as the visit join
    has no deduplication after it.
    """
    cohort = _cohort(cdm, params, cohort)
    values = E.bounded_values(
        E.of_concepts(cdm.get("measurement"), "measurement_concept_id", cohort.biomarker_set),
        params.upper_bound_biomarker,
        params.lower_bound_biomarker,
    )
    found = cohort.at_days(values, "measurement_date", once=False)
    return found.select(*EXTRACTS["biomarkers"].fieldNames())


def conditions_extract(
    cdm: CdmTables, params: CohortParams, cohort: Cohort | None = None
) -> DataFrame:
    """Distinct coded diagnoses on outpatient days inside the window."""
    cohort = _cohort(cdm, params, cohort)
    codes = stored(cdm.get("comorbidity_codes"), params.broadcast_bytes)
    coded = E.with_codes(cdm.get("condition_occurrence"), codes)
    return cohort.at_days(coded, "condition_date", once=True).select(
        *EXTRACTS["conditions"].fieldNames()
    )


def extract(
    kind: str, cdm: CdmTables, params: CohortParams, cohort: Cohort | None = None
) -> DataFrame:
    """The extract named ``kind``: covariates, drugs (selected), biomarkers or conditions."""
    if kind == "covariates":
        return covariates_extract(cdm, params, cohort)
    if kind == "drugs":
        return drugs_extract(cdm, params, cohort, selected=True)
    if kind == "biomarkers":
        return biomarkers_extract(cdm, params, cohort)
    if kind == "conditions":
        return conditions_extract(cdm, params, cohort)
    raise ValueError(f"unknown extract type {kind!r}")


def resumable(cdm: CdmTables, params: CohortParams, root: str, version: str = "") -> Saves:
    """Saves for :func:`save_extracts` that a new application goes on with.

    Names come from the tables' files, the parameters that decide about rows,
    and ``version``, which a caller changes with anything else that matters,
    such as the definition of a bound DataFrame.
    """
    chosen = {k: v for k, v in asdict(params).items() if k != "broadcast_bytes"}
    return Saves(cdm.spark, root, {"params": chosen, "tables": cdm.digest(), "version": version})


def save_extracts(
    cdm: CdmTables,
    params: CohortParams,
    cohort: Cohort | None = None,
    kinds: Sequence[str] = ("covariates", "drugs", "biomarkers"),
    save: Callable[[DataFrame, str], DataFrame] = stage,
) -> dict[str, DataFrame]:
    """Save several extracts at once; ``save`` gets each extract and its kind.

    The shared tables are built first, those that do not need each other at
    once. The extracts then run as concurrent jobs, as the tail of one leaves
    room for the next. Extracts that ``save`` has from an earlier application
    (:func:`resumable`) are read, and nothing is staged for them.
    """
    cohort = _cohort(cdm, params, cohort)
    wanted = kinds
    earlier = {kind: save.done(kind) for kind in kinds} if isinstance(save, Saves) else {}
    kinds = [kind for kind in wanted if earlier.get(kind) is None]
    if not kinds:
        return {kind: earlier[kind] for kind in wanted}
    cohort.drug_set  # what the steps that run side by side have in common
    steps = [lambda: cohort.days if set(kinds) - {"covariates"} else cohort.ranges]
    steps += [lambda: cohort.wanted_drugs] if "drugs" in kinds else []
    steps += [lambda: cohort.biomarker_set] if "biomarkers" in kinds else []
    side_by_side(cdm.spark, steps)

    def saved(kind: str) -> DataFrame:
        return save(extract(kind, cdm, params, cohort), kind)

    made = dict(zip(kinds, side_by_side(cdm.spark, [partial(saved, k) for k in kinds]), strict=True))
    return {kind: made[kind] if kind in made else earlier[kind] for kind in wanted}


_EXTRACT_DATES = {
    "covariates": ("dob", "first_drug_exposure", "last_drug_exposure"),
    "drugs": ("start_date", "end_date", "drug_exposure_start_date"),
    "biomarkers": ("start_date", "measurement_date", "end_date"),
}


def _normalize(df: DataFrame, kind: str) -> DataFrame:
    names = [name.lower() for name in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"the {kind} columns differ only in case: {df.columns}")
    df = df.toDF(*names)
    require_columns(df, list(_EXTRACT_DATES[kind]), kind)
    return df.withColumns({name: safe_date(name) for name in _EXTRACT_DATES[kind]})


def normalize_extracts(
    covariates: DataFrame, drugs: DataFrame, biomarkers: DataFrame
) -> dict[str, DataFrame]:
    """Lower-case names and real dates; the bundle's keys are r_c, r_d and r_b."""
    return {
        "r_c": _normalize(covariates, "covariates"),
        "r_d": _normalize(drugs, "drugs"),
        "r_b": _normalize(biomarkers, "biomarkers"),
    }
