"""Several outputs of a micro-batch, handed over as one.

Each output is first written aside, in full. Then one record is put into the
ledger, which counts the rows of every output: that is the commit, and it
covers all outputs. Only then do outputs move to where readers see them, each
as a folder of its own, and a second record says that this is done too.

A batch that Spark replays starts where the last attempt ended. Without its
ledger record nothing was visible, and all is written again. With the record
the outputs stand aside or have moved already; what has not, moves. So readers
see a batch's folder once and never changed, whenever the job is stopped.

Outputs that are no folders (a topic, a store) cannot stand aside. They are
written after the commit, and again if the job stops before the second record:
at least once, as their sinks have it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.streaming import StreamingQuery

from tickflow.files import Files
from tickflow.sinks.write import each_batch

LEDGER_SCHEMA = "query string, batch long, output string, rows long"
Step = Callable[[str], None]


class HandOver:
    """Writes micro-batches of one query to ends by name, which have a `path` (or None) and `write(rows, folder in it)`."""

    def __init__(self, spark: SparkSession, ledger: str, query: str, ends: Mapping, at_step: Step | None = None):
        self.files, self.ledger, self.query, self.ends = Files(spark), ledger, query, ends
        self.at_step = at_step or (lambda step: None)
        for end in ends.values():
            if end.path is not None:
                self.files.make_folder(end.path)

    def write(self, parts: Mapping[str, DataFrame], counts: Mapping[str, int], batch_id: int) -> None:
        part = f"query={self.query}/batch={batch_id}"
        record = f"{self.ledger}/query={self.query}-batch={batch_id}.json"
        done = f"{self.ledger}/done/query={self.query}-batch={batch_id}"
        if self.files.exists(done):
            return
        if not self.files.exists(record):
            for name, end in self.ends.items():
                if end.path is not None:
                    end.write(parts[name], f"_aside/{part}")
                    self.at_step(f"{name} aside")
            self.files.write_whole(record, "\n".join(json.dumps(
                {"query": self.query, "batch": batch_id, "output": name, "rows": counts.get(name, 0)}) for name in self.ends))
            self.at_step("committed")
        for name, end in self.ends.items():
            if end.path is None:
                end.write(parts[name])
            elif not self.files.exists(f"{end.path}/{part}"):
                self.files.move(f"{end.path}/_aside/{part}", f"{end.path}/{part}")
            self.at_step(f"{name} seen")
        self.files.write_whole(done, "")


def hand_over_stream(
    df: DataFrame, column: str, outputs: Mapping[str, tuple], checkpoint: str, available_now: bool = False,
    interval: str | None = None, at_step: Step | None = None,
) -> StreamingQuery:
    """One query for several outputs: `outputs` has, per value of the column, its end and what makes rows ready for it.

    The ledger is in the checkpoint. `at_step` is told each step, by name, as it is done.
    """
    ends = {name: end for name, (end, _) in outputs.items()}
    open_ledger = []

    def write(batch: DataFrame, counts: Mapping[str, int], batch_id: int) -> None:
        if not open_ledger:
            spark = batch.sparkSession
            query = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
            open_ledger.append(HandOver(spark, ledger_of(checkpoint), query, ends, at_step))
        parts = {name: ready(batch.filter(F.col(column) == name)) for name, (_, ready) in outputs.items()}
        open_ledger[0].write(parts, counts, batch_id)

    return each_batch(df, column, list(outputs), write, checkpoint, available_now, interval)


def ledger_of(checkpoint: str) -> str:
    return f"{checkpoint}/handed-over"


def handed_over(spark: SparkSession, ledger: str) -> DataFrame:
    """Rows per query, batch and output that were committed."""
    return spark.read.schema(LEDGER_SCHEMA).json(f"{ledger}/*.json").select("query", "batch", "output", F.col("rows"))
