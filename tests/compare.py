"""Run queries beside their SQL equivalents and compare the results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True, na_position="first")


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """What differs, or an empty string; values must be equal to the last bit."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {list(spark_frame.columns)} and {list(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} and {len(sql_frame)} rows"
    left, right = normal(spark_frame), normal(sql_frame)
    for column in left.columns:
        if {str(left[column].dtype), str(right[column].dtype)} == {"float64", "Int64"}:
            # Long with nulls, which the two libraries hand over as different types.
            left[column], right[column] = (f[column].astype("Int64") for f in (left, right))
        if left[column].dtype != right[column].dtype and len(left):
            return f"{column}: {left[column].dtype} and {right[column].dtype}"
        same = (left[column] == right[column]).fillna(False)
        same |= left[column].isna() & right[column].isna()
        if not same.all():
            i = (~same).idxmax()
            return (
                f"{column}: {(~same).sum()} rows, first\n{left.loc[i].to_dict()}\n"
                f"{right.loc[i].to_dict()}"
            )
    return ""


def main(folder: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.perf_counter()
        try:
            result = query(spark, folder).toPandas()
        except Exception as error:  # noqa: BLE001
            print(f"FAIL  {name}: {str(error)[:1500]}")
            continue
        seconds = time.perf_counter() - started
        if name not in oracles:
            print(f"rows  {name}: {len(result)} rows, {seconds:.2f} s")
            print(result.head(5).to_string())
            continue
        try:
            expected = connection.execute(oracles[name]).df()
        except Exception as error:  # noqa: BLE001
            print(f"SQL   {name}: {str(error)[:1500]}")
            continue
        wrong = differences(result, expected)
        print(f"{'DIFF' if wrong else 'ok':5} {name}: {len(result)} rows, {seconds:.2f} s {wrong}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
