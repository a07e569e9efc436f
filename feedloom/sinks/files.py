"""File sinks; every writer is a distributed Spark write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_json_lines(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "append") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_job_artifact(df: DataFrame, root: str, job_id: str) -> str:
    """Entries of one run below ``root/job_id=…``; a retried run replaces its own
    folder and leaves other runs alone."""
    path = f"{root}/job_id={job_id}"
    df.write.mode("overwrite").json(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that cannot hold them."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*(
        F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat_columns(df).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_query_csv(df: DataFrame, path: str) -> str:
    """The whole result of a query as CSV files below ``path``; the path back."""
    write_csv(df, path)
    return path


def preview(df: DataFrame, rows: int) -> str:
    """Up to ``rows`` rows as CSV text, for a caller that shows a result. Says in a
    last line when the result has more; the whole is ``write_query_csv``'s."""
    flat = flat_columns(df)
    head = flat.limit(rows + 1).select(F.to_csv(F.struct("*"), {"quote": '"', "escape": '"'}).alias("line")).collect()
    names = ['"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n\r') else c for c in flat.columns]
    more = [f"# more than {rows} rows"] if len(head) > rows else []
    return "\n".join([",".join(names), *(r.line for r in head[:rows]), *more])
