"""The arrival gate: a book starts once every subject has arrived anew.

The stream follows the control rows of all subjects. Its state, per gate, is
what has arrived since the last book: the stamps of each subject's newest load,
received or still pending. The load that completes the set fires the gate, once,
and puts every subject back to pending; loads that come later count for the next
book. A control row that is written again (a rerun, a repaired or replayed load)
is no arrival: a subject only arrives with stamps above its last ones.

State and consumed files are kept by the checkpoint, so an arrival counts once
whichever micro-batch it comes in. A firing has a number; what it starts is told
that number and may be told it again after a lost driver, with the same stamps.

All rows of a gate are one key's, and few: a row per load.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierbook.schemas import LOAD_REPORT_SCHEMA
from tierbook.sources.log import Log
from tierbook.sources.storage import make_folder

FIRING_SCHEMA = T.StructType(
    [
        T.StructField("gate", T.StringType()),
        T.StructField("firing", T.LongType()),
        T.StructField("assunto", T.StringType()),
        T.StructField("ts_proc", T.StringType()),
        T.StructField("ts_file_generation", T.StringType()),
        T.StructField("qtd_registros", T.LongType()),
    ]
)


def _gate(subjects: Sequence[str]) -> Callable:
    """The state function; state: (firings so far, per subject newest stamps and whether received, as JSON)."""
    subjects = tuple(subjects)

    def arrive(key: tuple, frames: Iterator, state) -> Iterator:
        import json

        import pandas as pd

        fired, known = (state.get[0], json.loads(state.get[1])) if state.exists else (0, {})
        # subject -> [stamps, rows, received]
        rows = pd.concat(list(frames)).sort_values(["ts_proc", "ts_file_generation", "version", "assunto"], na_position="first")
        out = []
        for r in rows.itertuples():
            stamps = [r.ts_proc, r.ts_file_generation]
            if r.assunto in known and stamps <= known[r.assunto][0]:
                continue
            known[r.assunto] = [stamps, int(r.qtd_registros), True]
            if all(s in known and known[s][2] for s in subjects):
                fired += 1
                for s in subjects:
                    out.append((key[0], fired, s, *known[s][0], known[s][1]))
                    known[s][2] = False
        state.update((fired, json.dumps(known)))
        names = ["gate", "firing", "assunto", "ts_proc", "ts_file_generation", "qtd_registros"]
        yield pd.DataFrame(out, columns=names).astype({"firing": "int64", "qtd_registros": "int64"})

    return arrive


def gate_stream(spark: SparkSession, control_dirs: dict[str, str], gate: str = "book") -> DataFrame:
    """The firings as a stream: a row per subject of each."""
    rows = None
    for subject, folder in control_dirs.items():
        make_folder(spark, folder)  # the subject may never have been loaded yet
        one = spark.readStream.schema(LOAD_REPORT_SCHEMA).option("ignoreMissingFiles", "true").parquet(folder)
        one = one.where(F.col("assunto") == subject).select("assunto", "ts_proc", "ts_file_generation", "qtd_registros", F.coalesce("version", F.lit(0)).alias("version"))
        rows = one if rows is None else rows.union(one)
    keyed = rows.withColumn("gate", F.lit(gate))
    return keyed.groupBy("gate").applyInPandasWithState(
        _gate(tuple(control_dirs)), FIRING_SCHEMA, "fired long, known string", "append", "NoTimeout"
    )


def firings(spark: SparkSession, log_dir: str) -> DataFrame:
    """All firings so far, a row per subject of each."""
    return Log(spark, log_dir, FIRING_SCHEMA).rows().select(*FIRING_SCHEMA.fieldNames()).distinct()


def run_gate(
    spark: SparkSession,
    control_dirs: dict[str, str],
    checkpoint_dir: str,
    log_dir: str,
    on_fire: Callable[[int, list], None] | None = None,
    gate: str = "book",
) -> None:
    """Take in all control rows that are there, then stop.

    ``on_fire`` gets the number and the rows of each firing before it is
    logged; it should be idempotent for a number, as a replay repeats it.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "1")  # one key; the state has as many parts as this

    def fire(batch: DataFrame, batch_id: int) -> None:
        rows = sorted(batch.collect(), key=lambda r: (r["firing"], r["assunto"]))  # a row per subject and firing
        log = Log(spark, log_dir, FIRING_SCHEMA)
        done = {r["firing"] for r in log.rows().where(F.col("gate") == gate).select("firing").distinct().collect()}
        for number in sorted({r["firing"] for r in rows} - done):
            own = [r for r in rows if r["firing"] == number]
            if on_fire is not None:
                on_fire(number, own)
            log.append_all([r.asDict() for r in own])

    query = (
        gate_stream(session, control_dirs, gate)
        .writeStream.foreachBatch(fire)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
