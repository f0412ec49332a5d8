"""Sinks and persistence (S4, S5, S8, S9, S10) and the lineage cut used between stages.

All writes go through the DataFrame writer; nothing passes through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    Used where a stage output is read several times (the panel feeds the windows, the
    department means and three encodings): the expensive upstream joins run once, and a
    lost executor re-reads checkpoint files instead of recomputing them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_panel(panel: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long panel as parquet, one directory per store (partition pruning on read)."""
    panel.write.mode(mode).partitionBy("store_id").parquet(path)


NOT_BUILT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _read_partitioned(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """The table under ``path`` with its partition column as text ("01" stays "01"); None
    if nothing is there.  Any other fault (permissions, network) is raised."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as exc:
        if exc.getCondition() in NOT_BUILT:
            return None
        raise
    fields = [T.StructField(f.name, T.StringType() if f.name == column else f.dataType) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def existing_partitions(spark: SparkSession, path: str, column: str = "store_id") -> DataFrame:
    """Values of ``column`` that already have a partition directory under ``path``."""
    table = _read_partitioned(spark, path, column)
    return spark.createDataFrame([], f"{column} string") if table is None else table.select(column).distinct()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place for a table under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


MANIFEST = "_manifest"


def _checked(df: DataFrame, column: str) -> DataFrame:
    """Rows and an order-free checksum per value of ``column``."""
    others = sorted(c for c in df.columns if c != column)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in others]).cast("decimal(38,0)")
    return df.groupBy(F.col(column).cast("string").alias(column)).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(row).alias("checksum"))


def committed(spark: SparkSession, path: str, column: str = "store_id") -> DataFrame | None:
    """(column, n_rows, checksum) of the stores whose write was finished; None if the table
    has no manifest.  A store written again counts by its last entry."""
    where = f"{path.rstrip('/')}/{MANIFEST}"
    place = spark._jvm.org.apache.hadoop.fs.Path(where)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    found = spark.read.schema(f"{column} string, n_rows long, checksum decimal(38,0), at timestamp").parquet(where)
    return found.groupBy(column).agg(F.max_by("n_rows", "at").alias("n_rows"), F.max_by("checksum", "at").alias("checksum"))


def _commit(spark: SparkSession, path: str, entries: DataFrame) -> None:
    entries.withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{path.rstrip('/')}/{MANIFEST}")


def write_features_resumable(features: DataFrame, path: str, column: str = "store_id", stores: list[str] | None = None) -> DataFrame:
    """Write only the stores that are not committed yet (resume after an interruption).

    A store counts as built once the manifest names it with the rows and the checksum that
    were read back after its files were in place, so what a broken run left under its
    partition is written anew.  Dynamic partition overwrite replaces only the partitions being
    written; finished stores are never rewritten.  ``stores`` names the wanted ones;
    without it the feature plan is run once for their list.  Returns the stores written.
    """
    spark = features.sparkSession
    schema = f"{column} string"
    if committed(spark, path, column) is None:  # an empty manifest marks the table as one with commits
        _commit(spark, path, spark.createDataFrame([], f"{schema}, n_rows long, checksum decimal(38,0)"))
    done = committed(spark, path, column).select(column)
    wanted = features.select(F.col(column).cast("string")).distinct() if stores is None else spark.createDataFrame([(s,) for s in stores], schema)
    # the list of missing stores is fixed before writing (one value per store: bounded)
    todo = [r[0] for r in wanted.join(done, column, "left_anti").collect()]
    if todo:
        (features.filter(F.col(column).cast("string").isin(todo))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(column).parquet(path))
        written = _read_partitioned(spark, path, column)
        if written is not None:
            _commit(spark, path, _checked(written.filter(F.col(column).isin(todo)), column))
    return spark.createDataFrame([(v,) for v in todo], schema)


def verify_features(spark: SparkSession, path: str, column: str = "store_id") -> DataFrame:
    """(column, n_rows, checksum, intact) of every committed store: whether its files still
    hold what was committed."""
    table, known = _read_partitioned(spark, path, column), committed(spark, path, column)
    if table is None or known is None:
        raise FileNotFoundError(f"no committed features under {path}")
    now = _checked(table, column).select(column, F.col("n_rows").alias("_n"), F.col("checksum").alias("_c"))
    return known.join(now, column, "left").select(
        column, "n_rows", "checksum", (F.col("n_rows").eqNullSafe(F.col("_n")) & F.col("checksum").eqNullSafe(F.col("_c"))).alias("intact"))


def read_features(spark: SparkSession, path: str, stores: list[str] | None = None) -> DataFrame:
    """Feature scan with store pruning; raises if nothing has been built.  Of a table
    with a manifest only committed stores are read."""
    df = _read_partitioned(spark, path, "store_id")
    known = committed(spark, path)
    if known is not None:
        have = [r[0] for r in known.select("store_id").collect()]  # one value per store
        stores = [s for s in have if not stores or s in stores]
        df = df if have else None
    if df is None:
        raise FileNotFoundError(f"no feature files under {path}; build the features first")
    return df.filter(F.col("store_id").isin(stores)) if stores or known is not None else df


LAYOUT = "_layout"


def write_series_table(df: DataFrame, path: str, buckets: int | None = None, key: str = "id", order: str = "date",
                       column: str = "store_id") -> DataFrame:
    """S4/S6 for frames that are read again by series: one directory per store and in it one
    file per bucket of ``key``, sorted by (``key``, ``order``).  Windows, groups and joins by
    ``key`` on the table that is returned need no exchange.  ``buckets`` should follow the
    data (bytes of the table / 128 MB); by default it is the session's shuffle partitions.
    Each write is a new version; the layout, written last, names the one that is read, so a
    broken write leaves the earlier version in place."""
    spark, place, version = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, key).write.option("path", f"{place}/{version}")
       .partitionBy(column).bucketBy(buckets, key).sortBy(key, order).saveAsTable(f"series_{version}"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(f"series_{version}").schema.fields)
    layout = spark.createDataFrame([(version, columns, column, key, order, buckets)],
                                   "version string, columns string, store string, key string, sorted string, buckets int")
    layout.withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{place}/{LAYOUT}")
    return spark.table(f"series_{version}")


def read_series_table(spark: SparkSession, path: str, stores: list[str] | None = None) -> DataFrame:
    """The last finished version of ``write_series_table``, its buckets known to the planner;
    only the directories of ``stores`` are read.  Raises if no write was finished."""
    place = path.rstrip("/")
    try:
        layout = spark.read.parquet(f"{place}/{LAYOUT}").orderBy(F.desc("at")).first()
    except AnalysisException as exc:
        if exc.getCondition() in NOT_BUILT:
            raise FileNotFoundError(f"no finished table under {path}") from exc
        raise
    name = f"series_{layout['version']}"
    if not spark.catalog.tableExists(name):
        where = f"{place}/{layout['version']}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({layout['columns']}) USING parquet PARTITIONED BY (`{layout['store']}`) "
                  f"CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`, `{layout['sorted']}`) INTO {layout['buckets']} BUCKETS "
                  f"LOCATION '{where}'")
        spark.catalog.recoverPartitions(name)
    table = spark.table(name)
    return table.filter(F.col(layout["store"]).isin(stores)) if stores else table


def write_forecast_csv(wide: DataFrame, path: str) -> None:
    """Wide forecast (id, F1..Fh) as CSV with a header."""
    wide.write.mode("overwrite").option("header", True).csv(path)


def read_forecast_csv(spark: SparkSession, path: str, horizon: int = 28) -> DataFrame:
    schema = "id string, " + ", ".join(f"F{h} double" for h in range(1, horizon + 1))
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def save_encoding_stats(stats: dict[str, DataFrame], path: str) -> None:
    """The three encoding tables as parquet (reloaded at inference)."""
    for name, df in stats.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_encoding_stats(spark: SparkSession, path: str, names=("item_store_enc", "dept_store_enc", "cat_store_enc")):
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
