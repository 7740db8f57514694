"""Session SQL functions that metric definitions may call.  All are SQL expressions, no Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession



def _two_digit_year(parsed: str) -> str:
    """Two-digit years from 69 on belong to the 1900s."""
    return f"if({parsed} >= DATE'2069-01-01', add_months({parsed}, -1200), {parsed})"


_SHORT = "CAST(try_to_timestamp(substr(x, 1, 15), 'M/d/yy H:mm') AS DATE)"

# Function names and date formats that metric catalogues rely on.
SQL_FUNCTIONS = {
    "getDateS": ("STRING", "DATE", "try_to_date(x, 'M/d/yyyy')"),
    "getDateH": ("STRING", "DATE", _two_digit_year("try_to_date(x, 'M-d-yy')")),
    "doubleToInt": ("DOUBLE", "INT", "try_cast(x AS INT)"),
    "getOnlyDate": (
        "STRING",
        "STRING",
        "date_format(try_to_timestamp(substr(x, 1, 19), 'yyyy-MM-dd HH:mm:ss'), 'MM-dd-yyyy')",
    ),
    "correctFormatDate": (
        "STRING",
        "STRING",
        "date_format(try_to_date(substr(x, 1, 10), 'M/d/yyyy'), 'MM/dd/yyyy')",
    ),
    "getOnlyDate2": (
        "STRING",
        "STRING",
        f"date_format({_two_digit_year(_SHORT)}, 'MM/dd/yyyy')",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, (arg, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {arg}) RETURNS {result} RETURN {body}")
