"""The fixture scenario: the whole engine run over the landing derived from the test tables.

Every run is the chain of ``steps.py``, the one the jobs run. Frames that several outputs of a run
share are staged while the plan is built (an action); single-batch and reporting queries stage
nothing. Registration carries only the columns the group fold reads, unless a query needs the
whole ``file_events`` rows (``wide``).

* single batch - all landing rows registered, refreshed and evaluated at ``NOW1``;
* two runs     - the landing split by minute of the modification time (``< 30`` is
  run 1, the rest run 2). Run 1 registers, refreshes, evaluates and dispatches at
  ``NOW1``; run 2 does the same at ``NOW2`` against run 1's stored tables, which
  exercises every prior-state operator (keyed appends, upsert, sticky status,
  first-writer-wins, duplicates, skipped dispatches);
* replay       - dispatch re-run over run 1's READY state after its dispatch rows were
  written but before the groups were marked (the repair path).

Arrival time is the file's modification time, so results do not depend on the clock.
``filegate.plans.oracle`` restates the same scenario in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filegate.functions.rules import timestamp_literal
from filegate.operators import audit, groups, parse, register
from filegate.plans.steps import FOLD_COLUMNS, DispatchStep, EvaluateStep, IngestOptions, IngestStep
from filegate.schemas import DISPATCH_SCHEMA, FILE_EVENTS_SCHEMA, GROUPS_SCHEMA
from filegate.sources.fixture import derived_landing

# --- Fixed scenario parameters ------------------------------------------------------
NOW1 = "1999-06-01 00:20:00"
NOW2 = "1999-06-01 01:20:00"
TIMEOUT_MINUTES = 30
SPLIT_MINUTE = 30
DISPATCH_LIMIT = 100
# ---------------------------------------------------------------------------------------

BY_MODIFICATION = IngestOptions(arrival="modification")


def _ntz_schema(schema):
    """The control-table schema with NTZ timestamps (the test tables' type)."""
    from pyspark.sql import types as T

    return T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType,
                          f.nullable)
            for f in schema.fields
        ]
    )


class Run:
    """One ingest -> evaluate -> dispatch run against stored tables."""

    def __init__(self, batch: DataFrame, now, stored_events: DataFrame, stored_state: DataFrame,
                 stored_dispatch: DataFrame, columns: Sequence[str] | None, stage: bool):
        self.now, self.stored_events = now, stored_events
        self.stored_state, self.stored_dispatch = stored_state, stored_dispatch
        self.ingest = IngestStep(batch, now, stored_events.select("file_business_key"), BY_MODIFICATION,
                                 columns=columns, stage=stage)

    @cached_property
    def file_events(self) -> DataFrame:
        """The ``file_events`` table after this run (keyed append)."""
        return self.stored_events.unionByName(self.ingest.inserted)

    @cached_property
    def evaluate(self) -> EvaluateStep:
        return EvaluateStep(self.stored_state, register.valid_events(self.file_events), TIMEOUT_MINUTES, self.now)

    @cached_property
    def dispatch(self) -> DispatchStep:
        return DispatchStep(self.evaluate.evaluated, self.file_events, self.stored_dispatch, self.now)

    @cached_property
    def audit_rows(self) -> DataFrame:
        """Audit rows of the run (before the keyed append)."""
        events = audit.union_events(
            [self.ingest.audit_events, self.evaluate.audit_events, self.dispatch.audit_events])
        return audit.prepare_audit(events, self.now)


class TwoRuns:
    """Run 2 over the tables that run 1 leaves."""

    def __init__(self, scenario: FixtureScenario, columns: Sequence[str] | None, stage: bool = True):
        s = scenario
        schema = _ntz_schema(FILE_EVENTS_SCHEMA)
        if columns:
            schema = type(schema)([f for f in schema.fields if f.name in columns])
        early = F.minute("modificationTime") < SPLIT_MINUTE
        self.first = Run(s.landing.where(early), s.now1, s.spark.createDataFrame([], schema),
                         s.empty(GROUPS_SCHEMA), s.empty(DISPATCH_SCHEMA), columns, stage)
        self.scenario, self.columns, self.stage, self.early = scenario, columns, stage, early

    @cached_property
    def second(self) -> Run:
        """The second run (its stored state stages the first run's)."""
        s, r = self.scenario, self.first
        return Run(s.landing.where(~self.early), s.now2, r.file_events, r.dispatch.final_state,
                   r.dispatch.dispatch_table, self.columns, self.stage)

    @cached_property
    def registered(self) -> IngestStep:
        """The second run's ingest alone: nothing but the first run's keys is needed for it."""
        s = self.scenario
        return IngestStep(s.landing.where(~self.early), s.now2, self.first.file_events.select("file_business_key"),
                          BY_MODIFICATION, columns=self.columns, stage=self.stage)

    @cached_property
    def all_events(self) -> DataFrame:
        """``file_events`` after both runs."""
        return self.first.file_events.unionByName(self.registered.inserted)

    @cached_property
    def audit_table(self) -> DataFrame:
        """Audit after both runs: run 2 appends only ids run 1 did not store."""
        first = self.first.audit_rows
        second = self.second.audit_rows.join(first.select("audit_id"), "audit_id", "left_anti")
        return first.unionByName(second)


class FixtureScenario:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.now1 = timestamp_literal(NOW1, ntz=True)
        self.now2 = timestamp_literal(NOW2, ntz=True)

    def empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], _ntz_schema(schema))

    @cached_property
    def landing(self) -> DataFrame:
        return derived_landing(self.spark, self.sf_dir)

    # --- single batch ------------------------------------------------------------------
    @cached_property
    def parsed(self) -> DataFrame:
        return parse.with_parsed_metadata(self.landing, self.now1, arrival="modification")

    @cached_property
    def events(self) -> DataFrame:
        return parse.build_file_events(self.landing, self.now1, arrival="modification")

    @cached_property
    def strict_events(self) -> DataFrame:
        return parse.build_file_events(self.landing, self.now1, arrival="modification", strict=True,
                                       strict_manifest=True)

    def _batch(self, columns: Sequence[str]) -> IngestStep:
        none = self.empty(FILE_EVENTS_SCHEMA).select("file_business_key")
        return IngestStep(self.landing, self.now1, none, BY_MODIFICATION, columns=columns, stage=False)

    @cached_property
    def deduped(self) -> DataFrame:
        """Survivor per key with the columns the registration reports use."""
        return self._batch(["file_business_key", "arrived_at", "source_modification_time", "file_path",
                            "file_size"]).deduped

    @cached_property
    def batch(self) -> EvaluateStep:
        """The whole landing in one batch, evaluated against no state; nothing is staged."""
        events = self._batch(FOLD_COLUMNS).deduped
        return EvaluateStep(self.empty(GROUPS_SCHEMA), register.valid_events(events), TIMEOUT_MINUTES, self.now1,
                            stage=False)

    @cached_property
    def registration(self) -> IngestStep:
        """The whole landing registered in one batch, whole rows."""
        none = self.empty(FILE_EVENTS_SCHEMA).select("file_business_key")
        return IngestStep(self.landing, self.now1, none, BY_MODIFICATION, stage=False)

    # --- two runs ----------------------------------------------------------------------
    @cached_property
    def runs(self) -> TwoRuns:
        """Both runs, registration limited to what the group fold reads."""
        return TwoRuns(self, FOLD_COLUMNS)

    @cached_property
    def wide(self) -> TwoRuns:
        """Both runs with whole ``file_events`` rows."""
        return TwoRuns(self, None)

    @cached_property
    def run_feeds(self) -> list[DataFrame]:
        """The valid events that each run registered: what its evaluate would read."""
        return [register.valid_events(step.inserted) for step in (self.runs.first.ingest, self.runs.registered)]

    @staticmethod
    def partials(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        return groups.span_partials(events), groups.bitmap_partials(events), groups.announced_partials(events)

    def listing(self, *columns: str) -> TwoRuns:
        """Both runs with the given file columns and nothing staged, for queries that read few of them."""
        order = [c for c in FOLD_COLUMNS[:4] if c not in columns]
        return TwoRuns(self, [*order, *columns], stage=False)

    # --- replay of the dispatch step -------------------------------------------------------
    @cached_property
    def replays(self) -> list[DispatchStep]:
        """The dispatch steps of both runs run again: their rows were written, their groups not marked."""
        r1, r2 = self.runs.first, self.runs.second
        return [DispatchStep(r1.evaluate.evaluated, None, r1.dispatch.dispatch_table, self.now1),
                DispatchStep(r2.evaluate.evaluated, None, r2.dispatch.dispatch_table, self.now2)]
