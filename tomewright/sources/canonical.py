"""Canonical datasets as JSON lines: strict reads, deterministic writes, all-or-nothing publication."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewright.functions.identity import sorted_fields
from tomewright.sources.schemas import KEYS, OMITTED, TABLES


@dataclass
class Dataset:
    books: DataFrame
    documents: DataFrame
    toc: DataFrame
    sources: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession) -> "Dataset":
        return cls(**{n: spark.createDataFrame([], s) for n, s in TABLES.items()})

    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in TABLES}

    def persisted(self) -> "Dataset":
        """The same tables, kept after their first use, for plans that read them many times."""
        return Dataset(**{n: df.persist() for n, df in self.tables().items()})

    def union(self, other: "Dataset") -> "Dataset":
        return Dataset(**{n: df.unionByName(getattr(other, n)) for n, df in self.tables().items()})


def files(spark: SparkSession, path: str):
    """Hadoop's file system and path for any store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = files(spark, path)
    return fs.exists(p)


def dataset_exists(spark: SparkSession, folder: str) -> bool:
    """All four tables or none; a part of them is an error."""
    found = [n for n in TABLES if exists(spark, f"{folder}/{n}.jsonl")]
    if found and len(found) < len(TABLES):
        raise ValueError(f"incomplete dataset in {folder}: only {', '.join(found)}")
    return bool(found)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Blank lines are skipped; a malformed line or an unknown field is an error when the row is read."""
    schema = TABLES[name]
    lines = spark.read.text(f"{folder}/{name}.jsonl").where(F.length(F.trim("value")) > 0)
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    extra = F.array_except(F.json_object_keys("value"), known)
    checked = F.when(F.size(extra) > 0, F.raise_error(F.concat(F.lit(f"{name}: unknown field "), extra[0]))).otherwise(F.col("value"))
    return lines.select(F.from_json(checked, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_dataset(spark: SparkSession, folder: str) -> Dataset:
    return Dataset(**{n: read_table(spark, folder, n) for n in TABLES})


def json_lines(df: DataFrame, name: str) -> DataFrame:
    """One JSON line a row: keys sorted, nulls explicit except for the optional fields."""
    full = F.to_json(sorted_fields(F.struct(*[c for c in df.columns]), df.select(F.struct(*df.columns).alias("x")).schema["x"].dataType), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    for field in OMITTED[name]:
        full = F.when(F.col(field).isNull(), F.replace(full, F.lit(f'"{field}":null,'), F.lit(""))).otherwise(full)
    return df.select(KEYS[name], full.alias("value"))


def write_dataset(dataset: Dataset, folder: str) -> None:
    """Stage all four tables, then swap them in; the old ones come back if a swap fails."""
    spark = dataset.books.sparkSession
    stage, backup = f"{folder}/_staging-{uuid.uuid4().hex}", f"{folder}/_backup-{uuid.uuid4().hex}"
    for name, df in dataset.tables().items():
        json_lines(df, name).repartitionByRange(KEYS[name]).sortWithinPartitions(KEYS[name]).select("value").write.text(f"{stage}/{name}.jsonl")
    fs, _ = files(spark, folder)
    path = lambda x: files(spark, x)[1]
    fs.mkdirs(path(backup))
    moved: list[str] = []
    try:
        for name in TABLES:
            if fs.exists(path(f"{folder}/{name}.jsonl")):
                fs.rename(path(f"{folder}/{name}.jsonl"), path(f"{backup}/{name}.jsonl"))
            moved.append(name)
            if not fs.rename(path(f"{stage}/{name}.jsonl"), path(f"{folder}/{name}.jsonl")):
                raise OSError(f"could not publish {name}")
    except Exception:
        for name in moved:
            fs.delete(path(f"{folder}/{name}.jsonl"), True)
            if fs.exists(path(f"{backup}/{name}.jsonl")):
                fs.rename(path(f"{backup}/{name}.jsonl"), path(f"{folder}/{name}.jsonl"))
        raise
    finally:
        fs.delete(path(stage), True)
        fs.delete(path(backup), True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, create-only, no cell that a spreadsheet takes for a formula."""
    from tomewright.functions.text import formula_safe

    safe = [formula_safe(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name) for f in df.schema]
    df.select(*safe).write.mode("errorifexists").option("header", True).csv(path)


def read_review(spark: SparkSession, path: str, columns: list[str], key: list[str]) -> DataFrame:
    """A labelled CSV: exactly these columns, no ragged row, no repeated key."""
    head = spark.read.option("header", True).csv(path)
    if sorted(head.columns) != sorted(columns):
        raise ValueError(f"expected the columns {columns}, found {head.columns}")
    rows = spark.read.option("header", True).option("mode", "FAILFAST").schema(", ".join(f"`{c}` string" for c in head.columns)).csv(path)
    if not rows.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated rows for {key}")
    return rows
