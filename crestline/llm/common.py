"""Pieces that several training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word, as a Java regular expression. (To extract words is several times faster than to split at what is between them.)
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot if it holds more than a HOT_KEYS-th of all rows (so there are fewer such keys), and more than LEAST_HOT rows.
HOT_KEYS, LEAST_HOT = 100_000, 1000


def text_of(col: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs of characters other than the six separators."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def key_of(col: str) -> Column:
    """A grouping key that is never null and keeps null apart from every string."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("-"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """`df`, computed and stored in the shared checkpoint folder, with its lineage cut.

    The folder is the one named by spark.checkpoint.dir; only where that is unset and Spark runs in one
    process (tests) a temporary one is made.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder for intermediate tables")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    out = df.checkpoint(eager=True)
    # Shuffle files of what was cut stay on disk until the driver finds that nothing refers to them.
    gc.collect()
    context._jvm.System.gc()
    return out


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """What runs within hands Python workers at most `rows` rows at a time, which bounds what texts take there; the session's own setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def computed_once(df: DataFrame) -> DataFrame:
    """`df`, with its columns behind a barrier: filters above are not pushed below it, where they would compute costly columns again."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def hot_keys(counts: DataFrame, keys: list[str], total: int) -> DataFrame | None:
    """The keys that hold more than a HOT_KEYS-th of `total` rows by `counts` (keys and m), so HOT_KEYS of them at most, and into
    how many parts (_parts) the rows of each are dealt, so that a part holds no more than that; None if there are none."""
    if total <= LEAST_HOT:
        return None
    most = max(total // HOT_KEYS, LEAST_HOT)
    found = counts.where(F.col("m") > most).select(*keys, F.ceil(F.col("m") / most).cast("int").alias("_parts"))
    rows = found.collect()
    return counts.sparkSession.createDataFrame(rows, found.schema) if rows else None


def joined(rows: DataFrame, table: DataFrame, keys: list[str], spread: Column, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """The join of `rows` with `table` (few rows a key) by `keys`, which aren't null; rows of the `hot` keys are dealt to their parts by `spread`.

    The table's row of a hot key is copied for each part: all copies together are no more than HOT_KEYS and the hot keys.
    """
    if hot is None:
        return rows.join(table, keys, how)
    parts = F.broadcast(hot)
    dealt = rows.join(parts, keys, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    every = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    copied = table.join(parts, keys, "left").withColumn("_salt", F.explode(every)).drop("_parts")
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns of a row; a null counts, and so does where it stands."""
    from pyspark.sql import types as T

    def plain(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        return F.to_json(F.struct(col)) if "map<" in field.dataType.simpleString() else col

    return F.xxhash64(*[x for f in df.schema.fields for x in (plain(f), F.col(f"`{f.name}`").isNull())])


def give_back() -> None:
    """Returns a Python worker's freed memory to the system, so that a worker that waits for its next task is small."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def fresh(columns: list[str], name: str) -> str:
    """A column name like `name` that clashes with none of `columns`."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, `column`) of each labelled document once; null, other than 0 or 1, and contradicting labels are left out."""
    usable = labels.select("doc_id", F.col(column).cast("int").alias(column)).where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    found = usable.groupBy("doc_id").agg(F.min(column).alias(column), F.max(column).alias("_most"))
    return found.where(F.col(column) == F.col("_most")).drop("_most")
