"""What several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.shared import scratch_path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Leave out columns that a result replaces; names are compared without case."""
    gone = {name.lower() for name in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in gone])


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(row_id: Column | str, text: Column | str) -> Column:
    """128 bits that stand for an id and a text; null differs from empty."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.concat(F.coalesce(row_id.cast("string"), F.lit("-")),
                                  F.coalesce(F.concat(F.lit(":"), text), F.lit("")))))


def uniform(*cells: Column) -> Column:
    """A number in [0, 1) that depends on the given cells only."""
    return F.shiftrightunsigned(F.xxhash64(*cells), 11) / F.lit(float(1 << 53))


#: Keys with more than this share of all rows are hot: there are at most ``1 / HOT_KEYS`` of them.
HOT_KEYS = 1e-4


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """Inner or left join of rows with a stored table of groups, whose column ``count`` has the size of each.

    Groups of more than ``HOT_KEYS`` of all rows are so few that they are broadcast, and their rows stay where
    they are. The rows of the others are dealt by key; none of these groups is large.
    """
    hot = F.col(count) > total * HOT_KEYS
    few = F.broadcast(groups.where(hot).withColumn("_hot", F.lit(True)))
    known = rows.join(few, keys, "left")
    rest = known.where(F.col("_hot").isNull()).select(*rows.columns)
    return known.where("_hot").drop("_hot").unionByName(rest.join(groups.where(~hot), keys, how))
