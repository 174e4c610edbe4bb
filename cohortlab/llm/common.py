"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.session import checkpoint_dir

#: White space between words: space and \t \n \v \f \r.
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows per Arrow batch; texts can be long, so a batch stays a few MB.
ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: small Arrow batches (bounded
    Python memory on long texts), shuffle files dropped when the job that
    wrote them ends, and a checkpoint folder (the configured one; a fresh one
    only in local mode)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    checkpoint_dir(spark)
    return spark


def saved(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read
    back: cuts the lineage, survives lost executors, and later reads prune
    columns.  The files stay until :func:`release` or the owner of that folder
    deletes them."""
    spark = prepare(df.sparkSession)
    path = f"{checkpoint_dir(spark)}/cohortlab-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(df: DataFrame):
    """Hadoop file system and folder of a :func:`saved` frame."""
    spark = df.sparkSession
    files = df.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if not folder.rsplit("/", 1)[-1].startswith("cohortlab-"):
        return None, None
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def release(*frames: DataFrame) -> None:
    """Delete the files of :func:`saved` frames that nothing reads any more:
    what was made from them has been written."""
    for df in frames:
        fs, path = _folder(df)
        if path is not None:
            fs.delete(path, True)


def saved_bytes(df: DataFrame) -> int:
    """Size of the files of a :func:`saved` frame."""
    fs, path = _folder(df)
    return 0 if path is None else fs.getContentSummary(path).getLength()


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text: maximal runs without ASCII white space.  Null: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), "")


def n_words(text: Column) -> Column:
    """Number of words of a text as long; null: 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def matching(df: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi", most: int = 8 << 20) -> DataFrame:
    """Semi or anti join (null-safe) of a large frame with saved distinct
    ``keys``.  Keys whose files hold at most ``most`` bytes are broadcast, so
    the large frame stays where it is; beyond that Spark shuffles both."""
    small = keys.select(*[F.col(c).alias(f"_key_{c}") for c in on])
    if saved_bytes(keys) <= most:
        small = F.broadcast(small)
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    return df.join(small, same, how)


def hide(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed to ``_in0``, ``_in1``, ..., and the new
    name of each: whatever the caller's columns are called, they can't clash
    with an operator's own."""
    names = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def show(df: DataFrame, names: dict[str, str], *results: str) -> DataFrame:
    """The caller's columns under their names again, but for those that are
    called like a result, then the results."""
    taken = {r.lower() for r in results}
    return df.select(*[F.col(new).alias(old) for old, new in names.items() if old.lower() not in taken], *results)
