"""Sources and result files: tab-separated tables without quoting, lists of ids, tables of scores, JSON and archives."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("entity_id", "business_name", "business_address", "country")
_TSV = {"sep": "\t", "header": "true", "quote": "", "escape": "", "emptyValue": "", "nullValue": "\u0000", "encoding": "UTF-8", "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; an empty cell is "", never null; quotes and backslashes are ordinary characters."""
    df = spark.read.options(**_TSV).csv(path)
    strip = [F.regexp_replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), "\r$", "").alias(c.rstrip("\r")) for c in df.columns]
    return df.select(*strip)


def read_source(spark: SparkSession, directory: str, split: str, n: int) -> DataFrame:
    """{directory}/{split}/{split}_source{n}.tsv: the columns of COLUMNS, ids and country trimmed, and source = n.

    A missing column is an error.
    """
    path = f"{directory}/{split}/{split}_source{n}.tsv"
    df = read_tsv(spark, path)
    if lacking := [c for c in COLUMNS if c not in df.columns]:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    trim = lambda c: F.regexp_replace(c, "^\\s+|\\s+$", "").alias(c)
    return df.select(trim("entity_id"), "business_name", "business_address", trim("country"), F.lit(n).cast("tinyint").alias("source"))


def truth_pairs(rows: DataFrame, order: str | None = None) -> DataFrame:
    """(s1_id, pos, t_id): the comma lists of (source1_entity_id, matched_entity_ids), ids trimmed, blanks left out.

    An entity without a match gives one row with null pos and t_id. Of several rows of an entity the last by `order`
    counts; without an order, the one whose list is largest in the order of text.
    """
    s1 = F.trim("source1_entity_id")
    last = F.max(F.struct(*([order] if order else []), F.coalesce("matched_entity_ids", F.lit("")).alias("l"))).alias("r")
    ids = F.filter(F.transform(F.split("r.l", ","), lambda x: F.regexp_replace(x, "^\\s+|\\s+$", "")), lambda x: x != "")
    return rows.groupBy(s1.alias("s1_id")).agg(last).select("s1_id", F.posexplode_outer(ids).alias("pos", "t_id"))


def read_ground_truth(spark: SparkSession, directory: str) -> DataFrame:
    return truth_pairs(read_tsv(spark, f"{directory}/train/train_ground_truth.tsv"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id): the distinct ids of a source file, trimmed; short lines and blanks are left out."""
    return read_tsv(spark, path).select(F.trim("entity_id").alias("entity_id")).where("entity_id <> ''").distinct()


def read_lists(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(s1_id, ids): the distinct ids of each row of a result file, not trimmed, blanks left out."""
    ids = F.filter(F.array_distinct(F.split(F.col(column), ",")), lambda x: x != "")
    return read_tsv(spark, path).select(F.col("source1_entity_id").alias("s1_id"), ids.alias("ids"))


def id_lists(s1: DataFrame, pairs: DataFrame, score: str, column: str) -> DataFrame:
    """(source1_entity_id, column): for every id of s1 (s1_id) its targets joined by commas, best score first, each once;
    "" without any."""
    best = pairs.groupBy("s1_id", "t_id").agg(F.max(score).alias("__p"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("__p")).alias("p"), "t_id")))  # the candidates of one entity, bounded by k
    lists = best.groupBy("s1_id").agg(F.array_join(F.transform(order, lambda x: x["t_id"]), ",").alias(column))
    return s1.select("s1_id").distinct().join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def write_tsv(df: DataFrame, path: str, single: bool = False) -> None:
    """Writes without quoting; `single` puts a small table (reports, examples) into one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").options(**_TSV).csv(path)


def cached(spark: SparkSession, path: str, make) -> DataFrame:
    """The Parquet table at path, made first by make() where it is absent."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_scores(pairs: DataFrame, path: str, p: str = "p") -> None:
    """Every scored pair as (s1, t, p), p in single precision."""
    pairs.select(F.col("s1_id").alias("s1"), F.col("t_id").alias("t"), F.col(p).cast("float").alias("p")).write.mode("overwrite").parquet(path)


def write_json(value: object, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, default=str), encoding="utf-8")


def read_json(path: str) -> object:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def build_zip(out: str, required: list[str], folders: dict[str, str], skip: tuple[str, ...] = (".pyc", ".parquet", "__pycache__", ".git")) -> str:
    """An archive of the files of folders (name in the archive to folder); an error where a required file is absent."""
    if lacking := [f for f in required if not Path(f).is_file()]:
        raise FileNotFoundError(", ".join(lacking))
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in required:
            z.write(f, Path(f).name)
        for name, folder in folders.items():
            for f in sorted(Path(folder).rglob("*")):
                if f.is_file() and not any(s in f.parts or f.name.endswith(s) for s in skip):
                    z.write(f, f"{name}/{f.relative_to(folder)}")
    return out
