"""A keyed-table change log derived from the ``events`` table.

The keyed-table operators need a stream of commits; the driver's tables have
none, so one is derived from ``events`` (key ``user_id``, ordering ``ts`` or
``value``, tie-break ``event_id``):

* each day of events is a set of commits, one per operation kind, with
  commit time ``yyyyMMdd`` + a two-digit slot + ``0000000`` (17 digits);
* days of the month in ``OVERWRITE_DAYS`` are table (re)creations: that day's
  events in an ``O`` commit (slot 01), raw: a read keeps the best row of a key,
  as a create does (``one_per_overwrite``). Only the first day is one, so every
  later day can affect an answer;
* on other days ``signup``/``purchase`` events are bulk inserts (``I``,
  slot 02), ``click``/``view`` events are upserts (``U``, slot 03) and
  ``error`` events delete their key (``D``, slot 04).

The log is a projection of ``events``, so it grows with the table. A commit's day is its
events' day, so bounds on commits are put on ``ts`` too, where the scan can use
them; so is the day of the newest overwrite, which is found first, by a scan of
``ts`` alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.keyed.merge import COMMIT, DELETE, INSERT, OP, OVERWRITE, UPSERT
from gridlake.operators.dedupe import latest_per_key
from gridlake.plans.racing import read_tpch

OVERWRITE_DAYS = (1,)
INSERT_TYPES = ("signup", "purchase")
UPSERT_TYPES = ("click", "view")
SLOTS = {OVERWRITE: "01", INSERT: "02", UPSERT: "03", DELETE: "04"}
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
KEY = "user_id"
TIEBREAK = "event_id"


def commit_time(ts_col: str, op: F.Column) -> F.Column:
    slot = F.when(op == F.lit(OVERWRITE), F.lit(SLOTS[OVERWRITE]))
    for o in (INSERT, UPSERT, DELETE):
        slot = slot.when(op == F.lit(o), F.lit(SLOTS[o]))
    return F.concat(F.date_format(F.col(ts_col), "yyyyMMdd"), slot, F.lit("0000000"))


def _is_overwrite_day() -> F.Column:
    return F.dayofmonth("ts").isin(*OVERWRITE_DAYS)


def _op_of_event() -> F.Column:
    return (
        F.when(_is_overwrite_day(), F.lit(OVERWRITE))
        .when(F.col("event_type").isin(*INSERT_TYPES), F.lit(INSERT))
        .when(F.col("event_type").isin(*UPSERT_TYPES), F.lit(UPSERT))
        .otherwise(F.lit(DELETE))
    )


def _events(spark: SparkSession, sf_dir: str, upto: str | None = None) -> DataFrame:
    """The events of commits up to ``upto``: a bound on ``ts`` that reaches the scan."""
    ev = read_tpch(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    if upto:
        day = f"{upto[:4]}-{upto[4:6]}-{upto[6:8]}"
        ev = ev.where(F.col("ts") < F.expr(f"timestamp '{day}' + interval 1 day"))
    return ev


def events_commits(spark: SparkSession, sf_dir: str, upto: str | None = None) -> DataFrame:
    """The commit list (``_commit_time``, ``_op``) of the derived log: a
    two-column aggregate, much cheaper than the log itself."""
    ev = _events(spark, sf_dir, upto)
    op = _op_of_event()
    commits = ev.select(commit_time("ts", op).alias(COMMIT), op.alias(OP)).distinct()
    return commits.where(F.col(COMMIT) <= F.lit(upto)) if upto else commits


def newest_overwrite_day(spark: SparkSession, sf_dir: str, upto: str | None = None) -> str | None:
    """The day of the newest overwrite, one value for the driver."""
    day = _events(spark, sf_dir, upto).where(_is_overwrite_day()).agg(F.max(F.to_date("ts"))).first()[0]
    return day.isoformat() if day else None


def events_log(spark: SparkSession, sf_dir: str, upto: str | None = None) -> DataFrame:
    """The log's rows of commits up to ``upto``, from the newest overwrite on: what it replaced isn't read."""
    ev = _events(spark, sf_dir, upto)
    newest = newest_overwrite_day(spark, sf_dir, upto)
    if newest:
        ev = ev.where(F.col("ts") >= F.expr(f"timestamp '{newest}'"))
    log = ev.withColumn(OP, _op_of_event()).withColumn(COMMIT, commit_time("ts", F.col(OP))).withColumn("year", F.year("ts"))
    return log.where(F.col(COMMIT) <= F.lit(upto)) if upto else log


def recent_log(log: DataFrame, begin: str) -> DataFrame:
    """The log's rows of commits after ``begin``; its day bounds the scan."""
    day = f"{begin[:4]}-{begin[4:6]}-{begin[6:8]}"
    return log.where((F.col("ts") >= F.expr(f"timestamp '{day}'")) & (F.col(COMMIT) > F.lit(begin)))


def create_batch(spark: SparkSession, sf_dir: str, ordering: str = "ts") -> DataFrame:
    """A create batch de-duplicated by key (T1, A4): every event, one row per user."""
    ev = read_tpch(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    return latest_per_key(ev, KEY, ordering, TIEBREAK)
