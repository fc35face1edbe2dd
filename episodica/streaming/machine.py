"""Runs as a state machine over a stream: log pieces and exits in, states, metrics and retries out; and metrics joined to the run registry.

Input of `run_machine`: run_name, piece (0, 1, ... within the run, over all attempts), text (a piece of the log, cut anywhere, or null),
code (an attempt's exit code, or null).  A run's state is small: the attempt, how it stands, the last metrics, the line that
isn't complete yet, and pieces that came before their turn.  An attempt that is silent for longer than the timeout fails;
a failed run is tried again until its budget is spent.  The outcome doesn't depend on how the log is cut or batched.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..executors import ship
from ..functions import text
from ..tables import forget, written

EVENTS = "run_name string, piece long, text string, code int"
STATES = "run_name string, attempt int, state string, failures int, category string, step long, loss double, samples_per_second double, lines long"
#: Characters at a log's end in which a failure is looked for.
TAIL = 2_000_000
_STATE = "data string"
_STEP = re.compile(text.STEP_LINE)
_MEMORY = re.compile(text.OUT_OF_MEMORY)


class Run:
    """One run's state; kept as JSON between batches."""

    def __init__(self, data: str | None = None) -> None:
        self.attempt, self.state, self.failures, self.category = 1, "running", 0, None
        self.step = self.loss = self.rate = None
        self.rest, self.chars, self.memory_at, self.lines, self.next, self.early = "", 0, -1, 0, 0, {}
        if data:
            self.__dict__ |= json.loads(data)

    def saved(self) -> str:
        return json.dumps(self.__dict__)

    def take(self, piece: int, said: str | None, code: int | None, budget: int) -> None:
        """A piece in its turn; one that comes early waits, one that comes again is passed over."""
        if piece >= self.next:
            self.early[str(piece)] = (said, code)
        while (now := self.early.pop(str(self.next), None)) is not None:
            self.next += 1
            if now[0]:
                self._read(now[0])
            if now[1] is not None:
                self.end(now[1], budget)

    def _read(self, said: str) -> None:
        if self.state in ("completed", "blocked"):
            return
        if self.state == "failed":  # the log goes on: another attempt
            self.attempt, self.state, self.category = self.attempt + 1, "running", None
            self.rest, self.chars, self.memory_at = "", 0, -1
        *whole, self.rest = (self.rest + said).split("\n")
        for line in whole:
            self._line(line)
            self.chars += len(line) + 1

    def _line(self, line: str) -> None:
        self.lines += 1
        if "mem_gb:" in line and (found := _STEP.findall(line)):
            step, loss, _, rate, _ = found[-1]
            self.step, self.loss, self.rate = int(step), _number(loss), _number(rate)
        for m in _MEMORY.finditer(line):
            self.memory_at = self.chars + m.start()

    def end(self, code: int, budget: int, timed_out: bool = False) -> None:
        if self.state in ("completed", "blocked"):
            return
        if self.state == "failed":  # another attempt, which said nothing
            self.attempt, self.chars, self.memory_at = self.attempt + 1, 0, -1
        if self.rest:
            self._line(self.rest)
            self.chars, self.rest = self.chars + len(self.rest), ""
        code = code if code >= 0 else 128 - code
        if code == 0 and not timed_out:
            self.state, self.category = "completed", None
            return
        near = self.memory_at >= max(0, self.chars - TAIL)
        self.category = "timeout" if timed_out else "oom" if near else "signal" if code >= 128 else "trainer_error"
        self.failures += 1
        self.state = "failed" if self.attempt < budget else "blocked"

    def row(self, name: str) -> dict:
        return {
            "run_name": name, "attempt": self.attempt, "state": self.state, "failures": self.failures, "category": self.category, "step": self.step, "loss": self.loss,
            "samples_per_second": self.rate, "lines": self.lines,
        }


def _number(said: str) -> float | None:
    try:
        return float(said)
    except ValueError:
        return None


def _frame(rows: list[dict]) -> pd.DataFrame:
    names = [c.split()[0] for c in STATES.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"step": "Int64"})


def run_machine(events: DataFrame, budget: int = 3, silence_ms: int = 3_600_000) -> DataFrame:
    """Each run's state whenever it changes (update mode).  `events`: a stream of EVENTS."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    ship(events.sparkSession)

    def step(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = Run(state.get[0] if state.exists else None)
        if state.hasTimedOut:
            if run.state == "running":
                run.end(1, budget, True)
        else:
            rows = pd.concat(list(pieces)).sort_values("piece")
            for r in rows.itertuples():
                run.take(int(r.piece), None if pd.isna(r.text) else r.text, None if pd.isna(r.code) else int(r.code), budget)
        state.update((run.saved(),))
        if run.state == "running":
            state.setTimeoutDuration(silence_ms)
        yield _frame([run.row(key[0])])

    return events.groupBy("run_name").applyInPandasWithState(step, STATES, _STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)


def run_table(events: DataFrame, budget: int = 3) -> DataFrame:
    """The same of a table of events: each run's last state, its pieces read in order, a batch of rows at a time."""
    ship(events.sparkSession)

    def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, name = Run(), None
        for rows in it:
            for r in rows.itertuples():
                if r.run_name != name:
                    if name is not None:
                        yield _frame([run.row(name)])
                    run, name = Run(), r.run_name
                run.take(int(r.piece), None if pd.isna(r.text) else r.text, None if pd.isna(r.code) else int(r.code), budget)
        if name is not None:
            yield _frame([run.row(name)])

    return events.repartition("run_name").sortWithinPartitions("run_name", "piece").mapInPandas(read, STATES)


def latest(states: DataFrame) -> DataFrame:
    """Of all rows that a machine gave, each run's last."""
    last = F.max_by(F.struct(*(c for c in states.columns if c != "run_name")), F.struct("lines", "failures", "attempt", F.col("state") != "running"))
    return states.groupBy("run_name").agg(last.alias("s")).select("run_name", "s.*")


class RegistryJoin:
    """Rows of a stream joined to the run registry, a batch at a time, for `foreachBatch`.

    The registry is read anew for each batch.  A row whose run isn't registered yet waits in a table beside the result and is tried
    again with every later batch.  A batch writes folders of its own, so that one that runs twice replaces what it wrote."""

    def __init__(self, registry: Callable[[SparkSession], DataFrame], root: str, key: str = "run_name") -> None:
        self.registry, self.root, self.key = registry, root.rstrip("/"), key

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number and self._there(spark, f"waiting/batch={number - 1}"):
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{self.root}/waiting/batch={number - 1}"))
        rows, known = written(rows, "batch"), self.registry(spark)
        rows.join(known, self.key).write.mode("overwrite").parquet(f"{self.root}/joined/batch={number}")
        rows.join(known, self.key, "left_anti").write.mode("overwrite").parquet(f"{self.root}/waiting/batch={number}")
        forget(rows)

    def _there(self, spark: SparkSession, name: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/_SUCCESS")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def result(self, spark: SparkSession, schema: str | T.StructType) -> DataFrame:
        """What has been joined so far."""
        return spark.read.schema(schema).parquet(f"{self.root}/joined").drop("batch")
