"""Table mutation as joins: upsert, delete, cascade, soft delete, key assignment.

Tables are plain parquet, so every function returns the table's new content; the
caller writes it to a fresh path and switches over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions.dates import Moment, moment
from venuelake.operators.ranking import rank_rows
from venuelake.operators.skew import skew_join
from venuelake.session import durable


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_columns: list[str] | None = None,
) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key, or are added.

    With ``update_columns`` a matched row takes only these from ``source``. Columns that
    ``source`` lacks are null in added rows. A key that ``source`` repeats raises, whatever
    columns are asked for; rows with a null in the key match nothing, so they may repeat.
    One full outer join reads each side once; rows without a key stay out of it. The old rows come out
    of a generator: two key columns that are different constants would make the join's condition false,
    and a full outer join without equal columns compares every row with every other.
    """
    nullable = [c for c in target.columns if c not in keys]
    rest = [c for c in source.columns if c not in keys]
    news = source.where(~_any_null(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(F.lit(1).alias("_one"), *rest)).alias("_new")
    )
    old = F.struct(*keys, F.struct(F.lit(1).alias("_one"), *nullable).alias("_old"))
    olds = target.where(~_any_null(keys)).select(F.inline(F.array(old)))
    both = olds.join(news, keys, "full_outer")
    taken = set(rest if update_columns is None else update_columns)

    def once(column: Column) -> Column:
        # In every column, so that no choice of columns can drop the check.
        error = F.raise_error(F.lit(f"upsert source repeats a key of {keys}"))
        return F.when(F.col("_rows") > 1, error).otherwise(column)

    def value(name: str) -> Column:
        old = F.col("_old").getField(name)
        new = F.col("_new").getField(name) if name in rest else F.lit(None).cast(target.schema[name].dataType)
        if update_columns is None:
            return F.when(F.col("_new").isNotNull(), new).otherwise(old)
        if name not in taken:
            return F.when(F.col("_old").isNotNull(), old).otherwise(new)
        return F.when(F.col("_new").isNotNull(), new).otherwise(old)

    # A filter on the count, which also runs when no column is read.
    checked = both.where(once(F.lit(True)))
    joined = checked.select(*[(F.col(c) if c in keys else value(c)).alias(c) for c in target.columns])
    without_key = source.where(_any_null(keys))
    return joined.unionByName(target.where(_any_null(keys))).unionByName(without_key, allowMissingColumns=True).select(
        *target.columns
    )


def replace_groups(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of a key in ``target`` give way to its rows in ``source``."""
    kept = skew_join(target, source.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate does not hold; unknown (null) counts as not holding."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_keys(df: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """Rows whose ``column`` is not among the keys in the only column of ``gone``."""
    keys = gone.toDF(column)
    return skew_join(df, keys, [column], "left_anti").select(*df.columns)


def cascade_delete(
    parent: DataFrame,
    key: str,
    predicate: Column,
    children: dict[str, tuple[DataFrame, str]],
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delete rows of ``parent`` and the rows of each child that refer to them.

    The keys are written down first: they must not change when the parent is
    rewritten, and each child reads them again.
    """
    gone = durable(parent.where(predicate).select(key).distinct())
    kept = {name: delete_keys(df, column, gone) for name, (df, column) in children.items()}
    return delete_where(parent, predicate), kept


def mark_closed(
    restaurants: DataFrame, closed: DataFrame, as_of: Moment = None,
    key: str = "go_key", closed_key: str = "place_id",
) -> DataFrame:
    """Set the closed flag (0/1) and closing time from the keys in ``closed``."""
    names = closed.select(F.col(closed_key).alias(key)).distinct().withColumn("_closed", F.lit(1))
    flag = F.coalesce(F.col("_closed"), F.lit(0))
    columns = [c for c in restaurants.columns if c not in ("closed", "closed_time")]
    return restaurants.join(names, key, "left").select(
        *columns,
        flag.alias("closed"),
        F.when(flag == 1, moment(as_of).cast("timestamp")).alias("closed_time"),
    )


def lookup_key(
    values: DataFrame, dictionary: DataFrame, column: str, key: str, default: int = schemas.UNKNOWN_KEY
) -> DataFrame:
    """Add the key of each value from a dictionary table; ``default`` for unknown values."""
    known = dictionary.groupBy(column).agg(F.min(key).alias(key))
    found = skew_join(values, known, [column], "left")
    return found.withColumn(key, F.coalesce(F.col(key), F.lit(default)))


def append_new_keys(dictionary: DataFrame, values: DataFrame, column: str, key: str) -> DataFrame:
    """The dictionary with the unknown values added under the keys that follow its largest."""
    fresh = (
        values.select(column).where(F.col(column).isNotNull()).distinct()
        .join(dictionary.select(column), column, "left_anti")
    )
    ranked = rank_rows(fresh, [], [column], [], row_number="_place")
    largest = F.coalesce(dictionary.agg(F.max(key)).scalar(), F.lit(-1))
    added = ranked.select(column, (F.col("_place") + largest).alias(key))
    return dictionary.select(column, key).distinct().unionByName(added)


def assign_keys(
    rows: DataFrame, existing: DataFrame, match: list[str], order: list[str], key: str = "key"
) -> DataFrame:
    """Give each row the key that ``existing`` holds for its ``match`` columns, else a new one.

    New keys follow the largest existing one (or start at 0) in the sort order of the
    ``order`` columns, which must tell the rows apart.
    """
    joined = rows.join(existing.select(*match, key), match, "left")
    old = joined.where(F.col(key).isNotNull())
    new = rank_rows(joined.where(F.col(key).isNull()).drop(key), [], order, [], row_number="_place")
    largest = F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(-1))
    fresh = new.withColumn(key, F.col("_place") + largest).drop("_place")
    return old.unionByName(fresh)
