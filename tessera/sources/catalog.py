"""Names for plans: temp views, global temp views, tables stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def temp_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def global_view(df: DataFrame, name: str) -> str:
    """Register ``name`` in the global temporary database (``global_temp`` unless the
    session names another), visible to every session of this app.
    ``createOrReplace``: a second registration must not fail."""
    df.createOrReplaceGlobalTempView(name)
    db = df.sparkSession.conf.get("spark.sql.globalTempDatabase", "global_temp")
    return f"{db}.{name}"


def query_from_new_session(spark: SparkSession, sql: str) -> DataFrame:
    """Run ``sql`` in a fresh session (own temp views and conf, same context)."""
    return spark.newSession().sql(sql)


def create_table(spark: SparkSession, name: str, ddl: str, location: str, fmt: str = "parquet") -> str:
    """``CREATE TABLE name (ddl) USING fmt LOCATION location`` -- the table data
    lives in the shared folder, so any executor can read and write it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING {fmt} LOCATION '{location}'")
    return name


def load_table(spark: SparkSession, name: str, source: DataFrame, overwrite: bool = True) -> str:
    """Bulk-load ``source`` into table ``name`` (columns matched by position, as
    ``INSERT`` does)."""
    source.write.insertInto(name, overwrite=overwrite)
    return name


def store_bucketed(df: DataFrame, name: str, keys: list[str], path: str, buckets: int | None = None) -> str:
    """Store ``df`` as table ``name`` in ``buckets`` buckets by ``keys``, each sorted by them.

    A join or an aggregate on ``keys`` reads the stored side in place: no exchange, and a sort-merge
    join needs no sort where a bucket is one file, which the shuffle before the write sees to. ``buckets`` is
    the session's number of shuffle partitions if not given, so that the other side of a join
    is shuffled to the stored one's buckets and not both to a third number."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *keys).write.option("path", path).format("parquet")
     .bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]).saveAsTable(name))
    return name


def drop_tables(spark: SparkSession, prefix: str) -> list[str]:
    """Drop the current database's tables that begin with ``prefix`` and whose folder is gone (another
    application's scratch), so that no name outlives its data; returns the names."""
    gone = []
    for t in spark.catalog.listTables():
        if not t.isTemporary and t.name.startswith(prefix):
            place = spark.sql(f"DESCRIBE FORMATTED {t.name}").filter("col_name = 'Location'").first()
            folder = spark._jvm.org.apache.hadoop.fs.Path(place["data_type"])
            if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
                spark.sql(f"DROP TABLE IF EXISTS {t.name}")
                gone.append(t.name)
    return gone
