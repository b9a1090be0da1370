"""Spark relations of the mapped survey, built lazily per (session, folder)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietband import config as C
from quietband.functions import times
from quietband.operators import enrichment as E
from quietband.operators import health as H
from quietband.operators import incremental as I
from quietband.operators.membership import inventory
from quietband.plans.views import VIEWS
from quietband.session import WIDE_PLANS, scratch_path
from quietband.sources.run_tree import tasks
from verification.mapping import SERIES, SPARK

ALL_FIELDS = [f for candidates in C.FIELD_CANDIDATES.values() for f in candidates]


class Lazily(Mapping):
    """Relations by name, each made when it is first asked for."""

    def __init__(self, names: Iterable[str], make: Callable[[str], DataFrame]):
        self._names, self._make, self._made = tuple(names), make, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._derived: dict[str, DataFrame] = {}
        # The session is given, and frames are the widest rows there are.
        for key, value in WIDE_PLANS.items():
            spark.conf.set(key, value)

    def _sql(self, text: str) -> DataFrame:
        return self.spark.sql(text.replace("FROM ev", "FROM quietband_ev"))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    @cached_property
    def ev(self) -> DataFrame:
        # Dealt over tasks first, since all that follows is work on each event and a file of a few megabytes would be one task.
        self.table("events").repartition(tasks(self.spark)).createOrReplaceTempView("quietband_events")
        rows = self.stored("events", self.spark.sql(SPARK.base().replace("FROM events", "FROM quietband_events")))
        rows.createOrReplaceTempView("quietband_ev")
        return rows

    def mapped(self, text: str) -> DataFrame:
        self.ev.createOrReplaceTempView("quietband_ev")
        return self._sql(text)

    def stored(self, label: str, rows: DataFrame) -> DataFrame:
        """The relation as a written table, so queries start from parquet as jobs do."""
        path = self.scratch(label)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @cached_property
    def frequencies(self) -> DataFrame:
        return self.stored("frequencies", self.mapped(SPARK.frequencies()))

    @cached_property
    def observations(self) -> DataFrame:
        return self.stored("observations", self.mapped(SPARK.observations()))

    @cached_property
    def frames(self) -> DataFrame:
        return self.stored("frames", self.mapped(SPARK.frames()))

    @cached_property
    def captures(self) -> DataFrame:
        return self.stored("captures", self.mapped(SPARK.captures()))

    @cached_property
    def runs(self) -> DataFrame:
        return self.stored("runs", self.mapped(SPARK.runs()))

    def stored_once(self, label: str, build) -> DataFrame:
        """A relation that is costly to map, stored at first use."""
        if label not in self._derived:
            self._derived[label] = self.stored(label, build())
        return self._derived[label]

    # --- Registry, health and manifests ---------------------------------------------------

    @cached_property
    def registry(self) -> DataFrame:
        return self.runs.select(
            "name", F.concat(F.lit("/survey/"), "name").alias("path"), "is_dir", "instrument_ok",
            "frequencies_ok", "aggregate_ok", "run_status", "started_utc",
        )

    @cached_property
    def classified(self) -> DataFrame:
        return inventory(self.registry, SERIES)

    @cached_property
    def clock(self) -> DataFrame:
        """The hour of the last run as the time slots are expected up to."""
        return self.runs.agg(F.max(times.run_time(F.col("run_id"))).alias("now"))

    @cached_property
    def slots(self) -> DataFrame:
        return H.expected_slots(self.clock, SERIES)

    @cached_property
    def health(self) -> DataFrame:
        return H.build_run_health(self.classified, self.slots)

    @cached_property
    def manifests(self) -> DataFrame:
        return self.runs.where("has_manifest").select("run_id", "status", "schema_id", "extractor_version")

    # --- Derived tables ---------------------------------------------------------------------

    @cached_property
    def finished(self) -> DataFrame:
        return self.classified.where(F.col("eligible") & (F.col("attempt_state") != C.RUNNING))

    @cached_property
    def run(self) -> DataFrame:
        error = F.when(F.col("status") != "succeeded", F.concat(F.lit("stage "), "status"))
        status = self.manifests.select("run_id", F.col("status").alias("extraction_status"), error.alias("error"))
        return E.run_table(self.finished, status, SERIES)

    @cached_property
    def identity_errors(self) -> DataFrame:
        return self.stored("identity_errors", E.identity_errors(self.frames))

    @cached_property
    def identified(self) -> DataFrame:
        """Frames as the derived layer takes them: a run with a frame without identity has none."""
        return E.identified_frames(self.frames, self.identity_errors)

    @cached_property
    def rnr(self) -> DataFrame:
        return E.rnr_records(self.identified)

    @cached_property
    def load(self) -> DataFrame:
        return E.bss_load_records(self.identified)

    @cached_property
    def capabilities(self) -> DataFrame:
        return E.ie_capabilities(self.identified)

    @cached_property
    def available(self) -> DataFrame:
        names = F.array(*[F.lit(f) for f in ALL_FIELDS])
        at = (F.col("event_id") % len(ALL_FIELDS)).cast("int")
        return self.mapped(f"SELECT {SPARK.run_id()} AS run_id, event_id FROM ev").select(
            "run_id", F.get(names, at).alias("field")
        )

    @cached_property
    def resolution(self) -> DataFrame:
        return E.resolve_fields(self.runs.select("run_id"), self.available)

    @cached_property
    def derived(self) -> Mapping[str, DataFrame]:
        return Lazily(C.DERIVED_TABLES, self.derived_table)

    def derived_table(self, name: str) -> DataFrame:
        """A table of the derived layer; the ones computed from frames are stored once."""
        if name in ("run", "frequencies", "observations"):
            return getattr(self, name)
        attribute = {"ie_capabilities": "capabilities", "bss_load": "load", "field_resolution": "resolution"}
        return self.stored_once(name, lambda: getattr(self, attribute.get(name, name)))

    def staged_table(self, name: str) -> DataFrame:
        """A derived table as the manifests admit it."""
        return I.gated(self.derived_table(name), self.manifests, name)

    @cached_property
    def staged(self) -> Mapping[str, DataFrame]:
        return Lazily(C.DERIVED_TABLES, self.staged_table)

    @cached_property
    def views(self) -> Mapping[str, DataFrame]:
        return Lazily(VIEWS, lambda name: VIEWS[name](self.staged, self.health))
