"""Serving state: upsert, inactivation, missed-run counters, deletion. State and batch in, new state out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIFE = {"last_seen_at": "string", "last_seen_run_id": "string", "is_active": "boolean", "missing_full_runs": "int", "first_seen_at": "string", "inactive_at": "string"}


def step(state: DataFrame | None, batch: DataFrame, run_id: str, run_ts: str, *, full_run: bool, policy: str = "hard", most_missed: int = 2, id: str = "entity_id") -> DataFrame:
    """LIFE-1..5: the state after a run.

    Seen rows take the batch's values, keep fields that the batch lacks and become active. On a full run, unseen
    rows become inactive; under ``hard`` their counter grows and those at ``max(1, most_missed)`` go. A partial
    run ages nothing. Rows without an id are dropped; of rows repeated in the batch the largest stays.
    Column ``change``: inserted, modified, same, inactivated, aged, kept.
    """
    batch = batch.where(F.col(id).isNotNull())
    fields = [c for c in batch.columns if c != id]
    new = batch.groupBy(id).agg(F.max(F.struct(*fields)).alias("b")) if fields else batch.distinct().withColumn("b", F.struct(F.lit(1)))
    if state is None:
        state = batch.where("false").withColumns({c: F.lit(None).cast(k) for c, k in LIFE.items()})
    if "change" in state.columns:
        state = state.drop("change")
    s = state.withColumns({c: F.lit(None).cast(k) for c, k in LIFE.items() if c not in state.columns})
    old = s.select(id, F.struct(*[c for c in s.columns if c != id]).alias("o"))
    both = old.join(new, id, "full")
    seen, known = F.col("b").isNotNull(), F.col("o").isNotNull()
    kept = [c for c in s.columns if c != id and c not in LIFE and c not in fields]
    ages = ~seen & F.lit(full_run)
    missed = F.when(seen, 0).when(ages & F.lit(policy == "hard"), F.coalesce("o.missing_full_runs", F.lit(0)) + 1).otherwise(F.col("o.missing_full_runs"))
    was_active = F.coalesce("o.is_active", F.lit(False))
    same = F.lit(True)
    for c in fields:
        same = same & (F.col(f"o.{c}").eqNullSafe(F.col(f"b.{c}")) if c in s.columns else F.col(f"b.{c}").isNull())
    out = both.select(
        id,
        *[F.when(seen, F.col(f"b.{c}")).otherwise(F.col(f"o.{c}") if c in s.columns else F.lit(None)).alias(c) for c in fields],
        *[F.col(f"o.{c}").alias(c) for c in kept],
        F.when(seen, F.lit(run_ts)).otherwise(F.col("o.last_seen_at")).alias("last_seen_at"),
        F.when(seen, F.lit(run_id)).otherwise(F.col("o.last_seen_run_id")).alias("last_seen_run_id"),
        F.when(seen, True).when(ages, False).otherwise(F.col("o.is_active")).alias("is_active"),
        missed.cast("int").alias("missing_full_runs"),
        F.coalesce("o.first_seen_at", F.lit(run_ts)).alias("first_seen_at"),
        F.when(seen, F.lit(None).cast("string")).when(ages & was_active, F.lit(run_ts)).otherwise(F.col("o.inactive_at")).alias("inactive_at"),
        F.when(seen & ~known, "inserted").when(seen & same, "same").when(seen, "modified").when(ages & was_active, "inactivated").when(ages & F.lit(policy == "hard"), "aged").otherwise("kept").alias("change"),
    )
    return out.where(F.coalesce(F.col("missing_full_runs") < max(1, most_missed), F.lit(True)) | F.lit(not full_run) | F.lit(policy != "hard"))


def counters(state: DataFrame) -> DataFrame:
    """AGG-12: rows by what happened to them."""
    return state.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def is_full_run(asked: list[str], every: tuple[str, ...], dry_run: bool = False) -> bool:
    """LIFE-4, SET-5: all sources were asked for, and it was no rehearsal."""
    return not dry_run and set(asked) == set(every)


def missed_streak(history: DataFrame, id: str, run: str, runs: DataFrame) -> DataFrame:
    """WIN-4: (id, streak): how many of the latest runs in a row an id is missing from."""
    last = history.groupBy(id).agg(F.max(run).alias(run))
    nth = Window.orderBy(F.desc(run))  # a row for each run
    ages = runs.select(run).distinct().select(run, (F.row_number().over(nth) - 1).cast("long").alias("streak"))
    return last.join(ages, run).select(id, "streak")


# Columns of the catalog by which vectors are filtered when they are searched.
FILTERS = ("entity_type", "tipo", "fuente", "fecha_inicio", "distrito", "precio")


def vector_step(state: DataFrame | None, vectors: DataFrame, catalog: DataFrame, run_id: str, run_ts: str, *, full_run: bool, policy: str = "hard", most_missed: int = 2, id: str = "entity_id") -> DataFrame:
    """LIFE-5, SNK-11: the state of the vectors after a run, by the rules of :func:`step`; each with its catalog row's filter columns.

    Only vectors with an embedding enter; a vector without a catalog row has null filters.
    """
    columns = [c for c in FILTERS if c in catalog.columns]
    batch = vectors.where("embedding is not null").select(id, "embedding", *[c for c in ("model_name",) if c in vectors.columns])
    one = catalog.groupBy(id).agg(F.max(F.struct(*columns)).alias("f")).select(id, "f.*") if columns else catalog.select(id).distinct()
    return step(state, batch.join(one, id, "left"), run_id, run_ts, full_run=full_run, policy=policy, most_missed=most_missed, id=id)
