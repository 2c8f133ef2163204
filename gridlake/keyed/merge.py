"""Resolving a change log into the table's current rows (T5, T8; §2.9).

A change log is a DataFrame of data rows plus two columns: ``_commit_time``
(17-digit string, one value per commit) and ``_op``, one kind per commit:

* ``O`` overwrite (a create: the table is replaced by this commit's rows),
* ``I`` bulk insert (rows added as they are, duplicates kept),
* ``U`` upsert (one row per key replaces what the table holds for it),
* ``D`` delete (key columns only).

The snapshot rules, per key:

1. commits before the newest ``O`` commit are dropped;
2. rows at or before the key's newest ``D`` commit are dropped;
3. within one commit only the key's best ``U`` row counts (greatest
   ordering value, NULL lowest, then greatest tie-break);
4. a ``U`` row *fires* always (mode ``commit``), or (mode ``event``) when its
   ordering value is at least the greatest ordering value among the key's
   surviving rows of earlier commits;
5. the key's rows are its last firing ``U`` row plus the ``I``/``O`` rows of
   later commits (all surviving ``I``/``O`` rows if no ``U`` fired).

Plan shape (why it survives a key holding a third of the table):

* The log is *aggregated* (combined in the input tasks) to one narrow row per
  (key, commit): its greatest ordering value. That is all the rules need, and
  its number of rows per key is the number of commits.
* A key's commits are folded, in order, to its *state*: the newest delete, and
  the commit of the last firing ``U`` row. Two narrow exchanges, no payload.
* The states are joined back to the log on the key, a join whose skewed
  partitions AQE splits (or which is a broadcast if the states are few), and the
  rows are filtered by them. What is left of ``U`` rows, one commit per key,
  is cut to the best row inside the tasks before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.operators.dedupe import latest_per_key, order_key

COMMIT = "_commit_time"
OP = "_op"
OVERWRITE, INSERT, UPSERT, DELETE = "O", "I", "U", "D"
MODES = ("event", "commit")


def _as_list(x: Sequence[str] | str | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def newest_overwrite(commits: DataFrame) -> Column:
    """Scalar subquery: the newest ``O`` commit time of a commit list
    (columns ``_commit_time``, ``_op``), or ``''`` when there is none."""
    newest = commits.where(F.col(OP) == F.lit(OVERWRITE)).select(F.coalesce(F.max(COMMIT), F.lit("")))
    return newest.scalar()


def since_last_overwrite(log: DataFrame, start: str | Column | None = None) -> DataFrame:
    """Rule 1. ``start`` is the newest overwrite commit, best taken from the
    commit list (an overwrite with no rows still counts): a string, or a
    scalar-subquery column from ``newest_overwrite``, which stays lazy. Without it, it is
    taken from the rows themselves.
    """
    if start is None:
        start = newest_overwrite(log.select(COMMIT, OP))
    if isinstance(start, str):
        return log.where(F.col(COMMIT) >= F.lit(start)) if start else log
    return log.where(F.col(COMMIT) >= start)


def _ordering_value(ordering: Sequence[str]) -> Column:
    """Greatest ordering value of a group, NULL lowest.

    With one ordering column plain ``max`` already ranks NULL lowest (it
    ignores NULLs) and keeps the aggregate hash-based; several columns need
    the struct form.
    """
    if len(ordering) == 1:
        return F.max(ordering[0])
    return F.max(order_key(ordering))


def key_states(log: DataFrame, key: Sequence[str], ordering: Sequence[str], mode: str) -> DataFrame:
    """One row per key: ``_cd`` the newest delete (or ''), ``_cu`` the commit of the last firing ``U`` row (or '').

    ``_cd`` counts for rows of every kind, ``_cu`` only after it.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    none = F.lit("")
    is_d = F.col(OP) == F.lit(DELETE)
    if mode == "commit":  # the last U commit fires if it comes after the newest delete
        last = lambda what: F.coalesce(F.max(F.when(what, F.col(COMMIT))), none)
        states = log.groupBy(*key).agg(last(is_d).alias("_cd"), last(F.col(OP) == F.lit(UPSERT)).alias("_cu"))
        return states.withColumn("_cu", F.when(F.col("_cu") > F.col("_cd"), F.col("_cu")).otherwise(none))
    per_commit = log.groupBy(*key, COMMIT, OP).agg(_ordering_value(ordering).alias("_mo"))
    commits = F.array_sort(F.collect_list(F.struct(F.col(COMMIT).alias("c"), F.col(OP).alias("op"), F.col("_mo").alias("mo"))))
    kind = per_commit.schema["_mo"].dataType.simpleString()
    start = F.struct(none.alias("cd"), none.alias("cu"), F.lit(None).cast(kind).alias("most"))

    def step(state: Column, x: Column) -> Column:
        # A U row whose value is NULL doesn't reach an earlier value that isn't.
        fires = (x["op"] == F.lit(UPSERT)) & F.coalesce(state["most"].isNull() | (x["mo"] >= state["most"]), F.lit(False))
        deleted = F.struct(x["c"].alias("cd"), none.alias("cu"), F.lit(None).cast(kind).alias("most"))
        kept = F.struct(
            state["cd"].alias("cd"), F.when(fires, x["c"]).otherwise(state["cu"]).alias("cu"), F.greatest(state["most"], x["mo"]).alias("most")
        )
        return F.when(x["op"] == F.lit(DELETE), deleted).otherwise(kept)

    folded = per_commit.groupBy(*key).agg(commits.alias("_commits"))
    return folded.select(*key, F.aggregate("_commits", start, step).alias("_s")).select(*key, F.col("_s.cd").alias("_cd"), F.col("_s.cu").alias("_cu"))


def resolve(
    log: DataFrame,
    key: Sequence[str] | str,
    ordering: Sequence[str] | str,
    tiebreak: Sequence[str] | str = (),
    mode: str = "event",
    start: str | Column | None = None,
    one_per_overwrite: bool = False,
) -> DataFrame:
    """The table's rows after applying the change log (rules 1-5).

    Output columns are the log's columns (``_commit_time`` and ``_op``
    included), each row as it was written. A row with a NULL key fails the
    job: such rows are refused when they are written, so here one is a fault
    of the log that must not pass in silence. ``one_per_overwrite`` is for a
    log with raw batches in its overwrites: of an ``O`` commit, too, only the
    key's best row counts then, as a create would keep it.
    """
    keys, ords, ties = _as_list(key), _as_list(ordering), _as_list(tiebreak)
    return _resolved(_keyed(since_last_overwrite(log, start), keys), keys, ords, ties, mode, one_per_overwrite)


def resolve_since(
    log: DataFrame,
    key: Sequence[str] | str,
    ordering: Sequence[str] | str,
    tiebreak: Sequence[str] | str,
    mode: str,
    start: str | Column | None,
    begin: str,
    recent: DataFrame | None = None,
    one_per_overwrite: bool = False,
) -> DataFrame:
    """The table's rows that commits after ``begin`` wrote.

    Only keys with such a commit can have such rows, so the commits of the
    other keys are left out of the fold, and only rows after ``begin`` are
    joined with the states: what lies before is read for its narrow columns
    alone. ``recent`` gives the rows after ``begin`` where a cheaper scan has
    them (partitions, row groups); they are filtered all the same.
    """
    keys, ords, ties = _as_list(key), _as_list(ordering), _as_list(tiebreak)
    live = _keyed(since_last_overwrite(log, start), keys)
    late = live if recent is None else _keyed(since_last_overwrite(recent.select(live.columns), start), keys)
    late = late.where(F.col(COMMIT) > F.lit(begin))
    states = key_states(live.join(late.select(*keys).distinct(), keys, "left_semi"), keys, ords, mode)
    return _of_states(late, states, keys, ords, ties, one_per_overwrite)


def _resolved(live: DataFrame, keys: list[str], ords: list[str], ties: list[str], mode: str, one_per_overwrite: bool) -> DataFrame:
    return _of_states(live, key_states(live, keys, ords, mode), keys, ords, ties, one_per_overwrite)


def _of_states(rows: DataFrame, states: DataFrame, keys: list[str], ords: list[str], ties: list[str], one_per_overwrite: bool) -> DataFrame:
    """The rows that the states of their keys leave; of ``U`` rows the key's best one (rule 3)."""
    op, commit = F.col(OP), F.col(COMMIT)
    cols = rows.columns
    # A state is joined once for U rows and once for the others: so both sides are exchanged for the
    # join, and AQE can split the log's partition of a hot key, which it can't beside an aggregate.
    is_u = op == F.lit(UPSERT)
    twice = states.withColumn("_u", F.explode(F.array(F.lit(True), F.lit(False))))
    joined = rows.where(op != F.lit(DELETE)).withColumn("_u", is_u).join(twice, [*keys, "_u"])
    left = joined.where(F.when(is_u, commit == F.col("_cu")).otherwise((commit > F.col("_cd")) & (commit > F.col("_cu"))))
    # Rows of which all count get a number each, so that one ranking serves both kinds, in the join's partitions.
    single = op.isin(UPSERT, OVERWRITE) if one_per_overwrite else is_u
    own = F.when(~single, F.monotonically_increasing_id())
    return latest_per_key(left.withColumn("_own", own), [*keys, "_u", COMMIT, "_own"], ords, ties).select(*cols)


def _keyed(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``log``, failing at run time on a row whose key is NULL."""
    from gridlake.keyed.ops import refuse_null_keys

    return refuse_null_keys(log, keys)
