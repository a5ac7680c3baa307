"""Requests to providers that fail and have to be paced: geocoders, models.

A request is a row with a key; its outcome is a row too: the value, or the reason why there is none, and how many
attempts that took. A provider that raises costs its own row. Outcomes can be kept in a shared folder by key, wave by
wave, so a run that is started again asks for what has no value yet and for nothing else.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOTHING = "no results"


@dataclass(frozen=True)
class Pace:
    """How a provider may be asked.

    ``tasks`` ask at once, all of them together once in ``seconds`` (each waits ``tasks`` times as long between two of its
    requests). A request that raises is tried ``attempts`` times, after ``backoff`` seconds, then twice that and so on. A
    wave has ``wave`` requests at most, up to the variance of a hash; only where outcomes are kept.
    """

    tasks: int = 2
    seconds: float = 0.0
    attempts: int = 3
    backoff: float = 0.0
    wave: int = 10_000


def outcomes(requests: DataFrame, key: str, provider: Callable[[dict], dict | None], value: T.StructType, pace: Pace = Pace()) -> DataFrame:
    """``key``, the fields of ``value``, error, attempts: a row for each row of ``requests``, evaluated when it is read.

    ``provider`` gets a request's columns and gives the fields, or None for no result (which is not tried again).
    """
    kind = requests.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *value.fields, T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType())])
    names = [f.name for f in value]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free = 0.0
        for pdf in frames:
            rows = []
            for request in pdf.to_dict("records"):
                found, error, n = None, None, 0
                while n < max(1, pace.attempts):
                    time.sleep(max(0.0, free - time.monotonic()))
                    free = time.monotonic() + pace.seconds * pace.tasks
                    n += 1
                    try:
                        found, error = provider(request), None
                        break
                    except Exception as e:  # noqa: BLE001  whatever a provider raises concerns this request alone
                        error = f"{type(e).__name__}: {e}"[:300]
                        if n < pace.attempts:
                            time.sleep(pace.backoff * 2 ** (n - 1))
                if error is None and found is None:
                    error = NOTHING
                rows.append((request[key], *[(found or {}).get(c) for c in names], error, n))
            yield pd.DataFrame(rows, columns=[f.name for f in schema]).astype(object)

    return requests.repartition(max(1, pace.tasks), key).mapInPandas(run, schema)


def ask(requests: DataFrame, key: str, provider: Callable[[dict], dict | None], value: T.StructType, pace: Pace = Pace(), *, path: str | None = None) -> DataFrame:
    """Outcomes of requests, one for each key; rows of one key count as one request, those without a key as none.

    With ``path`` they are kept there, and asked for in waves: what a wave has found is not asked for again by a later
    call, whatever ended this one; requests without a value are. Without it the provider is asked whenever the
    result is read.
    """
    fields = [c for c in requests.columns if c != key]
    one = requests.where(F.col(key).isNotNull()).groupBy(key)
    one = one.agg(F.min(F.struct(*fields)).alias("_r")).select(key, "_r.*") if fields else one.agg(F.count(F.lit(1))).select(key)
    if path is None:
        return outcomes(one, key, provider, value, pace)
    spark = requests.sparkSession
    schema = outcomes(one, key, provider, value, pace).schema
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    waves = max(1, -(-one.count() // pace.wave))
    for wave in range(waves):
        due = one.where(F.pmod(F.xxhash64(key), F.lit(waves)) == wave)
        if files.exists(folder):
            due = due.join(spark.read.schema(schema).parquet(path).where("error is null").select(key), key, "left_anti")
        outcomes(due, key, provider, value, pace).write.mode("append").parquet(path)
    told = spark.read.schema(schema).parquet(path)
    rest = [c for c in told.columns if c != key]
    # Of a key's outcomes that with a value counts, else one of the others.
    best = told.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col("error").isNull(), "attempts")).alias("_o")).select(key, "_o.*")
    return best.join(one.select(key), key, "left_semi")
