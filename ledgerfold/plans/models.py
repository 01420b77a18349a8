"""The graph of models.  Models are functions of their parents; several as-of moments can exist at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ledgerfold.envelope import COLUMNS, FOREVER
from ledgerfold.operators import folds
from ledgerfold.plans import marts, quality
from ledgerfold.sources.registry import registry


@dataclass(frozen=True)
class Model:
    parents: tuple[str, ...]
    build: Callable[..., DataFrame]
    table: bool = True


def staged(log: DataFrame) -> DataFrame:
    return log.select(*COLUMNS, *[c for c in ("record_date",) if c in log.columns])


MODELS: dict[str, Model] = {
    "stg_events": Model(("event_log",), lambda c, log: staged(log), table=False),
    "current_state": Model(("stg_events",), lambda c, log: folds.fold_state(log)),
    "point_in_time": Model(("stg_events",), lambda c, log: folds.fold_state(log, c.as_of)),
    "history": Model(("stg_events",), lambda c, log: folds.history(log)),
    "aggregates": Model(("stg_events",), lambda c, log: folds.aggregates(log)),
    "source_event_counts": Model(("stg_events", "registry"), lambda c, log, r: folds.source_event_counts(log, r), table=False),
    "fda_shortage_current": Model(("stg_events",), lambda c, log: marts.shortage_current(log)),
    "gscpi_series": Model(("stg_events",), lambda c, log: marts.index_series(log)),
    "duty_rate_current": Model(("stg_events",), lambda c, log: marts.duty_rates(log)),
    "duty_rate_as_of": Model(("stg_events",), lambda c, log: marts.duty_rates(log, c.as_of)),
    "trade_asymmetry": Model(("stg_events",), lambda c, log: marts.trade_asymmetry(log)),
    "reconciliation_report": Model(("trade_asymmetry",), lambda c, t: marts.reconciliation_report(t)),
    "lot_current_location": Model(("stg_events",), lambda c, log: marts.lot_location(log)),
    "chain_of_custody": Model(("stg_events",), lambda c, log: marts.chain_of_custody(log)),
}


@dataclass
class Build:
    """One build over a log.  path: where tables are written (None: nothing is, plans are composed lazily)."""

    log: DataFrame
    as_of: str = FOREVER
    path: str | None = None
    made: dict[str, DataFrame] = field(default_factory=dict)

    def get(self, name: str) -> DataFrame:
        """The model, after its parents."""
        if name not in self.made:
            self.made[name] = self._make(name)
        return self.made[name]

    def _make(self, name: str) -> DataFrame:
        spark = self.log.sparkSession
        if name == "event_log":
            return self.log
        if name == "registry":
            return registry(spark)
        model = MODELS[name]
        df = model.build(self, *[self.get(p) for p in model.parents])
        if self.path and model.table:
            df.write.mode("overwrite").parquet(f"{self.path}/{name}")
            df = spark.read.schema(df.schema).parquet(f"{self.path}/{name}")
        df.createOrReplaceTempView(name)
        return df

    def run(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.get(n) for n in names or MODELS}

    def violations(self) -> DataFrame:
        """check, violations of every assertion about the log and its models."""
        tables = self.run("current_state", "history", "duty_rate_current", "duty_rate_as_of", "trade_asymmetry")
        return quality.log_summary(self.get("stg_events")).unionAll(quality.summary(quality.model_checks(tables)))
