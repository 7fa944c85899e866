"""The same functions, callable from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# SQL bodies are inlined by Catalyst, so SQL callers get the native plan too.
SQL_FUNCTIONS = {
    "epoch_days_to_date": """
        CREATE OR REPLACE TEMPORARY FUNCTION epoch_days_to_date(days DOUBLE)
        RETURNS DATE
        RETURN CASE WHEN CAST(days AS INT) > 0
                    THEN date_add(DATE'1960-01-01', CAST(days AS INT))
                    ELSE DATE'1900-01-01' END
    """,
    "epoch_ms_to_ts": """
        CREATE OR REPLACE TEMPORARY FUNCTION epoch_ms_to_ts(ms BIGINT)
        RETURNS TIMESTAMP
        RETURN timestamp_millis(ms)
    """,
    "is_blank": """
        CREATE OR REPLACE TEMPORARY FUNCTION is_blank(value STRING)
        RETURNS BOOLEAN
        RETURN value IS NULL OR trim(value) = ''
    """,
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions of this package in the session."""
    for statement in SQL_FUNCTIONS.values():
        spark.sql(statement)
    return sorted(SQL_FUNCTIONS)
