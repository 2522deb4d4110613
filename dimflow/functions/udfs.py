"""The four date/number conversions, as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# ``to_timestamp`` cannot parse milliseconds that touch the seconds, hence the dot.
DEFINITIONS = {
    "datetoint": "(v DATE) RETURNS BIGINT RETURN CAST(date_format(v, 'yyyyMMdd') AS BIGINT)",
    "inttodate": "(v BIGINT) RETURNS DATE RETURN to_date(CAST(v AS STRING), 'yyyyMMdd')",
    "timestamptoint": (
        "(v TIMESTAMP) RETURNS BIGINT RETURN CAST(date_format(v, 'yyyyMMddHHmmssSSS') AS BIGINT)"
    ),
    "inttotimestamp": (
        "(v BIGINT) RETURNS TIMESTAMP RETURN to_timestamp("
        "concat(substring(CAST(v AS STRING), 1, 14), '.', substring(CAST(v AS STRING), 15, 3)), "
        "'yyyyMMddHHmmss.SSS')"
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    for name, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(DEFINITIONS)
