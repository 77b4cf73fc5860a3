"""Parquet and JSON tables: checked loads, published writes, resumable batched writes."""

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfade.schemas import SCHEMAS
from crossfade.session import shared_dir
from crossfade.sources import manifest

RAW_TABLES = ("tracks", "catalog_names", "interactions")
PREPROCESSED_TABLES = ("items", "tracks_catalog_clean", "events")

METRIC_NAMES = ("precision@k", "recall@k", "ndcg@k", "novelty@k", "diversity@k")
_METRIC_STRUCT = T.StructType([T.StructField(name, T.DoubleType()) for name in METRIC_NAMES])
EVALUATION_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("evaluation_date", T.StringType()),
        T.StructField("total_users", T.LongType()),
        T.StructField("evaluated_users", T.LongType()),
        T.StructField("metrics", T.MapType(T.StringType(), _METRIC_STRUCT)),
    ]
)


def require_columns(df: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    """Fail at plan time when a table lacks a key column."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"table {table!r} lacks columns: {', '.join(missing)}")
    return df


def _read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"table {table!r} not found at {path}") from error


def load_table(
    spark: SparkSession, root: str, table: str, columns: list[str] | None = None
) -> DataFrame:
    """Lazy scan of ``root/table.parquet`` with its columns checked and cast to the schema.

    ``columns`` narrows the scan; without it all columns of the schema are kept. Columns the
    schema does not know are dropped, so they never reach the parquet reader.
    """
    schema = SCHEMAS[table]
    names = columns or schema.names
    df = require_columns(_read_parquet(spark, f"{root}/{table}.parquet", table), names, table)
    present = df.schema
    return df.select(
        *(
            F.col(name)
            if present[name].dataType == schema[name].dataType
            else F.col(name).cast(schema[name].dataType).alias(name)
            for name in names
        )
    )


def load_raw(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tracks, catalog_names, interactions)."""
    tracks, names, interactions = (load_table(spark, root, table) for table in RAW_TABLES)
    return tracks, names, interactions


def write_table(df: DataFrame, root: str, table: str) -> DataFrame:
    """Write ``root/table.parquet`` and return it as read back, which also cuts the lineage."""
    path = f"{root}/{table}.parquet"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


LOOKUP_ROWS = 1 << 20  # rows in one file of a table for lookups


def write_for_lookup(
    df: DataFrame, root: str, table: str, key: str, order: Iterable[str] = (), rows: int = LOOKUP_ROWS
) -> DataFrame:
    """Write ``root/table.parquet`` in ranges of (key, *order), sorted, with a Bloom filter on the key in every row
    group, and beside it ``table.ranges.parquet``: file, rows, and the lowest and highest key of each.

    The number of files follows the number of rows; a key with very many rows is cut by ``order``. Read it whole as any
    table, or a key with ``lookup``. Runs jobs.
    """
    written = materialize(df)
    files = -(-written.count() // rows) or 1
    path, by = f"{root}/{table}.parquet", [key, *order]
    written.repartitionByRange(files, *by).sortWithinPartitions(*by).write.mode("overwrite").option(
        f"parquet.bloom.filter.enabled#{key}", "true"
    ).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")
    ranges = found.groupBy(file).agg(F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
    ranges.orderBy("low").coalesce(1).write.mode("overwrite").parquet(f"{root}/{table}.ranges.parquet")
    return found


def lookup(spark: SparkSession, root: str, table: str, key: str, value) -> DataFrame:
    """The rows of one key of a table from ``write_for_lookup``: only files whose range holds the key are opened,
    and in them the filter reaches the row groups."""
    ranges = _read_parquet(spark, f"{root}/{table}.ranges.parquet", f"{table}.ranges")
    value = F.lit(value)
    files = [r["file"] for r in ranges.filter((F.col("low") <= value) & (F.col("high") >= value)).collect()]
    whole = _read_parquet(spark, f"{root}/{table}.parquet", table)
    if not files:
        return whole.limit(0)
    paths = [f"{root}/{table}.parquet/{file}" for file in files]
    return spark.read.schema(whole.schema).parquet(*paths).filter(F.col(key) == value)


def existing_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The table if it was written completely, which its ``_SUCCESS`` file shows, else None."""
    if "_SUCCESS" not in manifest.folders(spark, f"{root}/{table}.parquet"):
        return None
    return spark.read.parquet(f"{root}/{table}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: the input is computed once however often the
    result is used, the lineage is cut, and Spark knows the exact size. Runs a job."""
    path = f"{shared_dir(df.sparkSession)}/crossfade/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


AREAS = ("data", "recommendations")


def _check_area(area: str) -> None:
    if area not in AREAS:
        raise ValueError(f"unknown area {area!r}, use 'data' or 'recommendations'")


def publish(df: DataFrame, root: str, area: str, table: str) -> str:
    """Write under one of the two published prefixes; ``root`` may be any Hadoop URI."""
    _check_area(area)
    path = f"{root}/recsys/{area}/{table}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def publish_run(
    spark: SparkSession, root: str, published: dict[tuple[str, str], DataFrame], about: dict | None = None
) -> int:
    """Publish the tables of a run, {(area, table): rows}, all at once; returns the number of the record.

    Every table goes to a folder of its own below its prefix. Readers (``published_table``) see them when
    one commit record, written last, names them; until then they see the run before as a whole. What an earlier run
    published and this one does not stays readable. ``about`` (parameters, models) is kept with the record.
    """
    for area, _ in published:
        _check_area(area)
    number, before = manifest.latest(spark, f"{root}/recsys")
    places = dict(before.get("tables", {}))
    for (area, table), df in published.items():
        place = f"{area}/{table}/{uuid.uuid4().hex}.parquet"
        df.write.parquet(f"{root}/recsys/{place}")
        places[f"{area}/{table}"] = place
    return manifest.commit(spark, f"{root}/recsys", {"tables": places, "about": about or {}}, number)


def published_table(spark: SparkSession, root: str, area: str, table: str) -> DataFrame:
    """A table as the last published run has it."""
    _check_area(area)
    place = manifest.latest(spark, f"{root}/recsys")[1].get("tables", {}).get(f"{area}/{table}")
    if place is None:
        raise FileNotFoundError(f"table {table!r} is not published under {root}/recsys/{area}")
    return _read_parquet(spark, f"{root}/recsys/{place}", table)


def step_report(spark: SparkSession, root: str, tables: Iterable[str]) -> DataFrame:
    """Rows and columns of each table a step had to write; a missing table is an error."""
    report = None
    for table in tables:
        df = _read_parquet(spark, f"{root}/{table}.parquet", table)
        row = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(table).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).cast("long").alias("n_columns"),
        )
        report = row if report is None else report.unionByName(row)
    if report is None:
        raise ValueError("no table named")
    return report


def write_in_buckets(
    keys: DataFrame,
    key: str,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    buckets: int = 28,
    per_run: int = 4,
    made_with: dict | None = None,
) -> DataFrame:
    """Build a large keyed result in key buckets, so that a failed run goes on where it stopped.

    ``build`` maps a slice of ``keys`` to result rows. Every run writes ``per_run`` buckets at a
    time and then notes them in a commit record; buckets in the last record are skipped. A run cut short
    before its record is simply written again (overwritten, not appended). The record holds the key,
    the number of buckets and ``made_with`` (parameters, the model's id); going on with others is an error, since
    rows would be lost, doubled or come from two models.
    """
    spark = keys.sparkSession
    about = {"key": key, "buckets": buckets, "made_with": made_with or {}}
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    number, record = manifest.latest(spark, path)
    changed = sorted(name for name in about if record and record[name] != about[name])
    if changed:
        raise ValueError(f"{path} was begun with other {', '.join(changed)}")
    finished = set(record.get("finished", []))
    todo = [b for b in range(buckets) if b not in finished]
    for start in range(0, len(todo), per_run):
        part = todo[start : start + per_run]
        rows = build(keys.filter(bucket.isin(part)))
        rows.withColumn("bucket", bucket).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("bucket").parquet(f"{path}/rows")
        finished.update(part)
        number = manifest.commit(spark, path, about | {"finished": sorted(finished)}, number)
    return spark.read.parquet(f"{path}/rows").drop("bucket")


def evaluation_document(metrics: DataFrame, model: str, k: int, evaluated_on: str) -> DataFrame:
    """One JSON-shaped row from a metrics row (see ``operators.evaluate.evaluate``)."""
    values = F.struct(
        *(F.col(name.replace("@", "_at_")).alias(name) for name in METRIC_NAMES)
    )
    return metrics.select(
        F.lit(model).alias("model_name"),
        F.lit(evaluated_on).alias("evaluation_date"),
        "total_users",
        "evaluated_users",
        F.create_map(F.lit(f"k={k}"), values).alias("metrics"),
    )


def write_evaluation(document: DataFrame, root: str, model: str) -> str:
    path = f"{root}/evaluation_{model}.json"
    document.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_evaluations(spark: SparkSession, root: str, models: Iterable[str]) -> DataFrame:
    """All evaluation documents found under ``root``; models without one are left out."""
    found = None
    for model in models:
        try:
            df = spark.read.schema(EVALUATION_SCHEMA).json(f"{root}/evaluation_{model}.json")
        except AnalysisException:
            continue
        found = df if found is None else found.unionByName(df)
    if found is None:
        raise FileNotFoundError(f"no evaluation documents under {root}")
    return found
