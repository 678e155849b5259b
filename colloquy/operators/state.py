"""Table changes as pure functions ``(base, changes) -> new table``.

Plain parquet tables have no MERGE; each function returns the next version
and ``sources.io.write_version`` persists it next to the previous one. Keyed
de-duplication uses ``min_by``/``max_by`` aggregates (partial aggregation on
the map side), so a key repeated by a third of a batch does not pile up in
one task the way a ``row_number`` window over that key would.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import answer_status


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def keep_by_order(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                  last: bool = True, by_hash: bool = False) -> DataFrame:
    """One row per key, the last (or first) by ``order``. Where only a
    whole-numbered order stands beside the key, its plain maximum (or minimum; a
    NULL comes before all) is a hash aggregate; else the rows are sorted.
    ``by_hash`` sorts by a hash of the key before the key itself: keys that begin
    alike ('Proposal ..') are slow to compare."""
    key, order = _list(key), _list(order)
    rest = [c for c in df.columns if c not in key]
    if rest == order and len(rest) == 1 and df.schema[rest[0]].dataType.typeName() in ("integer", "long"):
        one = F.col(rest[0])
        top = F.max(one) if last else F.when(F.count(one) == F.count(F.lit(1)), F.min(one))
        return df.groupBy(*key).agg(top.alias(rest[0])).select(*df.columns)
    ordk = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if last else F.min_by
    first = [F.xxhash64(*key).alias("_h")] if by_hash else []
    agg = df.groupBy(*first, *key).agg(pick(F.struct(*rest), ordk).alias("_r"))
    return agg.select(*key, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def insert_if_absent(base: DataFrame, changes: DataFrame, key: str | Sequence[str],
                     order: str | Sequence[str] | None = None) -> DataFrame:
    """Add the rows of ``changes`` whose key is not in ``base``; a key
    repeated inside the batch keeps its first row by ``order`` (without one,
    the smallest row by its columns from left to right)."""
    key = _list(key)
    order = [c for c in base.columns if c not in key] if order is None else order
    ch = keep_by_order(changes, key, order, last=False).select(*base.columns) if order else \
        changes.select(*base.columns).distinct()
    new = ch.join(base.select(*key), key, "left_anti")
    return base.unionByName(new)


def update_by_key(base: DataFrame, updates: DataFrame, key: str | Sequence[str],
                  columns: Iterable[str] | None = None,
                  order: str | Sequence[str] | None = None) -> DataFrame:
    """``UPDATE base SET cols = updates.cols WHERE key matches``. A match
    flag (not coalesce) decides, so NULL can be written. Of several updates
    for one key the last by ``order`` counts (without one, the greatest by the
    updated columns), so a base row is never multiplied."""
    key = _list(key)
    cols = list(columns) if columns is not None else [c for c in updates.columns if c not in key]
    need = list(dict.fromkeys([*key, *cols, *_list(order or [])]))
    one = keep_by_order(updates.select(*need), key, order or cols) if cols else updates.select(*key).distinct()
    u = one.select(*key, *[F.col(c).alias(f"_u_{c}") for c in cols]).withColumn("_m", F.lit(True))
    j = base.join(u, key, "left")
    out = [F.when(F.col("_m"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
           if c in cols else F.col(c) for c in base.columns]
    return j.select(*out)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """D3: ``DELETE WHERE predicate``; a NULL predicate keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def hide_downvoted(qa: DataFrame, votes: DataFrame, threshold: int = 3) -> DataFrame:
    """D4 = J13 + A3 + D2: ``hidden = 1`` for visible Q&A rows that have a
    vote row with ``downvotes >= threshold``."""
    from .joins import votes_on_qa
    hit = (votes_on_qa(votes, qa, threshold).select("message_id").distinct()
           .withColumn("hidden", F.lit(1)))
    return update_by_key(qa, hit, "message_id", ["hidden"])


def record_answers(staging: DataFrame, qa: DataFrame, answers: DataFrame,
                   stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """D9 (+ F19, P4): answers (message_id, question, answer, model, logs?)
    -> (new staging with ``answered`` 1/0, new Q&A with the answered rows
    inserted when absent, ``is_relevant = 1, hidden = 0``). A failed reply (NULL,
    or a ``status`` other than 'ok') answers nothing: its staging row stays as
    it is and no Q&A row is written. P4: when the Q&A
    table has ``created_at`` / ``updated_at`` columns they are filled with
    ``stamp`` (default: the current timestamp)."""
    no, ans = answer_status("answer")
    failed = F.col("answer").isNull()
    if "status" in answers.columns:
        failed = failed | ~F.coalesce(F.col("status") == "ok", F.lit(False))
    a = answers.filter(~failed).withColumn("_no", no).withColumn("answer", ans)
    for c in ("created_at", "updated_at"):
        if c in qa.columns and c not in a.columns:
            a = a.withColumn(c, stamp if stamp is not None else F.current_timestamp())
    flags = a.select("message_id", F.when(F.col("_no") == 1, 0).otherwise(1).alias("answered"))
    new_staging = update_by_key(staging, flags, "message_id", ["answered"])
    ins = a.filter(F.col("_no") == 0)
    add = ins.select(*[ins[c] if c in ins.columns else
                       (F.lit(1) if c == "is_relevant" else F.lit(0) if c == "hidden"
                        else F.lit(None)).cast(qa.schema[c].dataType).alias(c)
                       for c in qa.columns])
    return new_staging, insert_if_absent(qa, add, "message_id")


def changed_rows(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """New keys -> the full row; known keys -> key + only changed
    fields (others NULL) + ``changed`` names; unchanged keys -> nothing.
    Columns absent from ``old`` count as NULL there."""
    cols = [c for c in new.columns if c != key]
    o = old.select(key, *[(F.col(c) if c in old.columns else F.lit(None).cast(new.schema[c].dataType))
                          .alias(f"_o_{c}") for c in cols]).withColumn("_known", F.lit(True))
    j = new.join(o, key, "left")
    diff = {c: ~F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in cols}
    changed = F.filter(F.array(*[F.when(diff[c], F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    known = F.col("_known").isNotNull()
    out = j.select(key, *[F.when(~known | diff[c], F.col(c)).alias(c) for c in cols],
                   F.when(known, changed).otherwise(F.array(*[F.lit(c) for c in cols])).alias("changed"),
                   F.when(known, "update").otherwise("insert").alias("kind"))
    return out.filter(F.size("changed") > 0)
