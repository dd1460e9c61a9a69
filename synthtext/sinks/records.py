"""Record, metric and sample writers (K1-K9).

Appends go through Spark's commit protocol: every task writes its own part
file and the job commits them together, so concurrent writers never lose rows
(the reference rewrites a whole Parquet file per batch) and a retried task
leaves no duplicates.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("jsonl", "csv", "parquet")


def check_format(fmt: str) -> str:
    """K4: case-insensitive output format name."""
    f = fmt.lower()
    if f not in FORMATS:
        raise ValueError(f"Unsupported output format: {fmt}")
    return f


def records_path(out_dir: str, run_id: str) -> str:
    """K9: one folder per run; part files are named by the commit protocol."""
    return f"{out_dir.rstrip('/')}/records/run_id={run_id}"


#: stands for null in CSV files: every value is quoted, so "" is an empty text
CSV_NULL = "\u0001null\u0001"
#: how CSV files are read, records and prompts alike: "" is an empty text, an empty cell or
#: the marker is null
CSV_READ = {"header": True, "multiLine": True, "escape": '"', "nullValue": CSV_NULL, "emptyValue": "",
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_records(df: DataFrame, path: str, fmt: str = "jsonl", mode: str = "append") -> None:
    """K1-K3: records as JSON lines (null fields kept), CSV (header, nested
    ``parameters`` as JSON text, white space, line ends and empty texts kept) or
    Parquet."""
    f = check_format(fmt)
    if f == "jsonl":
        df.write.mode(mode).option("ignoreNullFields", False).json(path)
    elif f == "csv":
        nested = (T.StructType, T.ArrayType, T.MapType)
        flat = df.select(*[
            F.coalesce(F.to_json(c.name, {"ignoreNullFields": "false"}) if isinstance(c.dataType, nested)
                       else F.col(c.name).cast("string"), F.lit(CSV_NULL)).alias(c.name) for c in df.schema.fields])
        flat.write.mode(mode).options(header=True, escape='"', quoteAll=True, emptyValue="", ignoreLeadingWhiteSpace=False,
                                      ignoreTrailingWhiteSpace=False).csv(path)
    else:
        df.write.mode(mode).parquet(path)


def read_records(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """Read back what ``write_records`` wrote (CSV gets ``parameters`` parsed)."""
    f = check_format(fmt)
    if f == "jsonl":
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.json(path)
    if f == "parquet":
        return spark.read.parquet(path)
    df = spark.read.options(**CSV_READ).csv(path)
    if schema is None:
        return df
    cols = []
    for fld in schema.fields:
        c = F.col(fld.name)
        if isinstance(fld.dataType, (T.StructType, T.ArrayType, T.MapType)):
            cols.append(F.from_json(c, fld.dataType).alias(fld.name))
        else:
            cols.append(c.cast(fld.dataType).alias(fld.name))
    return df.select(*cols)


def write_metrics_snapshot(metrics: DataFrame, path: str) -> None:
    """K5: the final metrics of a run as one JSON object, overwritten."""
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_metric_events(events: DataFrame, path: str) -> None:
    """K6: long ``(batch_id, name, value)`` metric events of one run, replacing
    those of an earlier try."""
    events.write.mode("overwrite").parquet(path)


def write_samples(samples: DataFrame, path: str) -> None:
    """K7: logged sample rows of one run."""
    samples.write.mode("overwrite").parquet(path)


def run_config_frame(spark: SparkSession, run_id: str, config: dict) -> DataFrame:
    """K8: the resolved run configuration as a one-row ``(run_id, config_json)``."""
    return spark.createDataFrame([(run_id, json.dumps(config, sort_keys=True))], "run_id string, config_json string")


def write_run_config(spark: SparkSession, run_id: str, config: dict, path: str) -> None:
    run_config_frame(spark, run_id, config).drop("run_id").write.mode("overwrite").parquet(path)
