"""MERGE INTO expressed as DataFrame operations.

``classify`` joins the current table with a change batch and labels every
row with the outcome of the merge clauses; ``merged_table`` and
``merge_changes`` read the labelled frame.  Outcome table:

=========  ==========  ======================  ===============================
target     source      clause                  result
=========  ==========  ======================  ===============================
yes        no          --                      kept unchanged
yes        yes         ``delete_when``         removed (checked first)
yes        yes         ``update_when``         source values, ``created_at``
                                               kept, ``updated_at = now``
yes        yes         neither                 kept unchanged
no         yes         ``insert_when``         inserted, both audit times = now
no         yes         otherwise               ignored
=========  ==========  ======================  ===============================

Keys match by plain equality, so rows with a NULL key never match: target
rows with a NULL key are kept, source rows with a NULL key are inserted when
``insert_when`` allows.  The dedup before a merge leaves at most one
NULL-key source row per group; a table that still gathers many can ask for
a salt column that spreads them over many shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import ts_lit

SRC, TGT = "s__", "t__"
OUTCOME = "_merge"
KEEP, UPDATE, INSERT, DELETE, IGNORE = "keep", "update", "insert", "delete", "ignore"
AUDIT = ("created_at", "updated_at")


def src(name: str) -> Column:
    """A source-batch column inside a merge condition."""
    return F.col(SRC + name)


def tgt(name: str) -> Column:
    """A target-table column inside a merge condition."""
    return F.col(TGT + name)


def _lit_ts(now) -> Column:
    if isinstance(now, Column):
        return now
    if now is None:
        return F.localtimestamp()
    return ts_lit(now)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def _no_null_key(df: DataFrame, keys: Sequence[str], prefix: str = "") -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(prefix + k).isNotNull()
    return cond


def _salt(df: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """0 for rows with a full key; a deterministic 1..NULL_SALTS otherwise.

    It is an extra equi-join key: NULL-key rows still never match (their
    key equality is NULL), but they spread over many hash partitions instead
    of one.  It is a hash of the row, so a recomputed task routes every row
    to the same partition again.
    """
    return (F.when(_no_null_key(df, keys, prefix), F.lit(0))
             .otherwise(F.lit(1) + F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]),
                                          F.lit(NULL_SALTS))))


NULL_SALTS = 1024


def classify(target: DataFrame | None, source: DataFrame, keys: Sequence[str], *,
             columns: Sequence[str] | None = None,
             delete_when: Column | None = None,
             update_when: Column | None = None,
             insert_when: Column | None = None,
             now=None, check_unique: bool = False,
             spread_null_keys: bool = False) -> DataFrame:
    """Full outer join of table and batch, one labelled row per outcome.

    ``columns`` are the payload columns written to the table (default: the
    source columns).  Conditions refer to ``src(...)`` / ``tgt(...)``;
    ``update_when`` and ``insert_when`` default to always.  ``target=None``
    is an empty table: no join, every source row is an insert candidate.
    The result has ``t__*`` and ``s__*`` columns, the target's audit
    columns, and ``_merge``.

    The join is on the keys alone, so a source already hash-partitioned by
    them (the dedup window) is not shuffled again.  ``spread_null_keys``
    adds the salt key for tables that collect many NULL-key rows (it costs
    that reuse).
    """
    columns = list(columns or [c for c in source.columns])
    if check_unique:
        assert_unique(source, keys)
    s = _prefixed(source, SRC).withColumn("_s", F.lit(True))
    if target is None:
        joined = s.select("*", *[F.lit(None).cast(source.schema[c].dataType).alias(TGT + c)
                                 for c in columns],
                          *[F.lit(None).cast("timestamp_ntz").alias(TGT + a) for a in AUDIT],
                          F.lit(None).cast("boolean").alias("_t"))
    else:
        t = _prefixed(target.select(*columns, *AUDIT), TGT).withColumn("_t", F.lit(True))
        on = None
        for k in keys:
            eq = F.col(TGT + k) == F.col(SRC + k)
            on = eq if on is None else on & eq
        if spread_null_keys:
            t = t.withColumn("_salt_t", _salt(t, keys, TGT))
            s = s.withColumn("_salt_s", _salt(s, keys, SRC))
            on = on & (F.col("_salt_t") == F.col("_salt_s"))
        joined = t.join(s, on, "full_outer").drop("_salt_t", "_salt_s")

    has_t = F.col("_t").isNotNull()
    has_s = F.col("_s").isNotNull()
    dele = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    upd = F.coalesce(update_when, F.lit(False)) if update_when is not None else F.lit(True)
    ins = F.coalesce(insert_when, F.lit(False)) if insert_when is not None else F.lit(True)
    outcome = (F.when(has_t & ~has_s, KEEP)
                .when(has_t & has_s & dele, DELETE)
                .when(has_t & has_s & upd, UPDATE)
                .when(has_t & has_s, KEEP)
                .when(ins, INSERT)
                .otherwise(IGNORE))
    return (joined.withColumn(OUTCOME, outcome)
                  .withColumn("_now", _lit_ts(now))
                  .drop("_t", "_s"))


def merged_table(classified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table after the merge: kept, updated and inserted rows."""
    o = F.col(OUTCOME)
    from_src = o.isin(UPDATE, INSERT)
    out = [F.when(from_src, F.col(SRC + c)).otherwise(F.col(TGT + c)).alias(c)
           for c in columns]
    out.append(F.when(o == INSERT, F.col("_now"))
                .otherwise(F.col(TGT + "created_at")).alias("created_at"))
    out.append(F.when(from_src, F.col("_now"))
                .otherwise(F.col(TGT + "updated_at")).alias("updated_at"))
    return classified.filter(o.isin(KEEP, UPDATE, INSERT)).select(*out)


def merge_changes(classified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows the merge changed, with ``_op`` INSERT / UPDATE / DELETE.

    Inserted and updated rows carry the new values, deleted rows the values
    they had; this is what a history table appends for the commit.
    """
    o = F.col(OUTCOME)
    from_src = o.isin(UPDATE, INSERT)
    out = [F.when(from_src, F.col(SRC + c)).otherwise(F.col(TGT + c)).alias(c)
           for c in columns]
    out.append(F.upper(o).alias("_op"))
    return classified.filter(o.isin(UPDATE, INSERT, DELETE)).select(*out)


def merge(target: DataFrame | None, source: DataFrame, keys: Sequence[str], *,
          columns: Sequence[str] | None = None, delete_when: Column | None = None,
          update_when: Column | None = None, insert_when: Column | None = None,
          now=None, check_unique: bool = False,
          spread_null_keys: bool = False) -> DataFrame:
    """``MERGE INTO target USING source`` returning the new table."""
    columns = list(columns or source.columns)
    c = classify(target, source, keys, columns=columns, delete_when=delete_when,
                 update_when=update_when, insert_when=insert_when, now=now,
                 check_unique=check_unique, spread_null_keys=spread_null_keys)
    return merged_table(c, columns)


def assert_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a merge source holds two rows for one key.

    A partial+final hash aggregate; only one offending key reaches the driver.
    """
    dup = (source.filter(_no_null_key(source, keys))
                 .groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"merge source has duplicate keys, e.g. {dup[0].asDict()}")


def update_where(df: DataFrame, cond: Column, assignments: dict, now=None,
                 touch: str | None = None) -> DataFrame:
    """``UPDATE t SET col = value WHERE cond`` as a projection.

    ``assignments`` maps column names to Columns or literals; no other column
    changes (a column default does not fire on UPDATE).  When ``touch``
    names an existing column it is set to ``now`` on the updated rows.
    """
    hit = F.coalesce(cond, F.lit(False))
    sets = {k: (v if isinstance(v, Column) else F.lit(v)) for k, v in assignments.items()}
    if touch and touch in df.columns and touch not in sets:
        sets[touch] = _lit_ts(now)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in sets:
            c = F.when(hit, sets[f.name].cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)
