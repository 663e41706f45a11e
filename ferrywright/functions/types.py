"""Source types to Spark types, for three dialects, over catalogs of any size."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source type -> Spark type, by dialect. Types with a precision are decided by rules below.
ORACLE = {
    "VARCHAR2": "string", "NVARCHAR2": "string", "VARCHAR": "string", "STRING": "string", "CHAR": "string", "NCHAR": "string", "CLOB": "string", "NCLOB": "string", "LONG": "string",
    "BLOB": "binary", "RAW": "binary", "LONG RAW": "binary", "BFILE": "binary", "ROWID": "string", "UROWID": "string", "DATE": "timestamp_ntz", "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP WITH TIME ZONE": "timestamp", "TIMESTAMP WITH LOCAL TIME ZONE": "timestamp", "INTERVAL YEAR TO MONTH": "interval year to month", "INTERVAL DAY TO SECOND": "interval day to second",
    "FLOAT": "double", "DOUBLE PRECISION": "double", "REAL": "float", "BINARY_FLOAT": "float", "BINARY_DOUBLE": "double", "INTEGER": "int", "INT": "int", "SMALLINT": "smallint", "DEC": "decimal(38,0)",
    "DECIMAL": "decimal(38,0)", "BOOLEAN": "boolean", "XMLTYPE": "string", "SDO_GEOMETRY": "geometry", "ST_GEOMETRY": "geometry",
}
MYSQL = {
    "TINYINT": "smallint", "SMALLINT": "smallint", "MEDIUMINT": "int", "INT": "int", "INTEGER": "int", "BIGINT": "bigint", "TINYINT UNSIGNED": "smallint", "SMALLINT UNSIGNED": "int",
    "MEDIUMINT UNSIGNED": "int", "INT UNSIGNED": "bigint", "BIGINT UNSIGNED": "decimal(20,0)", "FLOAT": "float", "DOUBLE": "double", "DECIMAL": "decimal(38,10)", "BOOL": "boolean", "BOOLEAN": "boolean",
    "CHAR": "string", "VARCHAR": "string", "TINYTEXT": "string", "TEXT": "string", "MEDIUMTEXT": "string", "LONGTEXT": "string", "TINYBLOB": "binary", "BLOB": "binary", "MEDIUMBLOB": "binary",
    "LONGBLOB": "binary", "BINARY": "binary", "VARBINARY": "binary", "ENUM": "string", "SET": "array<string>", "DATE": "date", "DATETIME": "timestamp_ntz", "TIMESTAMP": "timestamp_ntz",
    "TIME": "interval day to second", "YEAR": "smallint", "BIT": "binary", "JSON": "string", "GEOMETRY": "geometry", "POINT": "geometry", "POLYGON": "geometry",
}
TSQL = {
    "TINYINT": "smallint", "SMALLINT": "smallint", "INT": "int", "BIGINT": "bigint", "BIT": "boolean", "DECIMAL": "decimal(38,0)", "NUMERIC": "decimal(38,0)", "MONEY": "decimal(19,4)", "SMALLMONEY": "decimal(10,4)",
    "FLOAT": "double", "REAL": "float", "DATE": "date", "SMALLDATETIME": "timestamp_ntz", "DATETIME": "timestamp_ntz", "DATETIME2": "timestamp_ntz", "DATETIMEOFFSET": "timestamp", "TIME": "interval day to second",
    "CHAR": "string", "VARCHAR": "string", "TEXT": "string", "NCHAR": "string", "NVARCHAR": "string", "NTEXT": "string", "BINARY": "binary", "VARBINARY": "binary", "IMAGE": "binary", "UNIQUEIDENTIFIER": "string",
    "ROWVERSION": "binary", "TIMESTAMP": "binary", "XML": "string", "HIERARCHYID": "string", "SQL_VARIANT": "string", "SYSNAME": "string", "GEOGRAPHY": "geometry", "GEOMETRY": "geometry",
}
DIALECTS = {"oracle": ORACLE, "mysql": MYSQL, "tsql": TSQL}


def numeric_type(precision: Column, scale: Column, default: str = "bigint") -> Column:
    """The Spark type of NUMBER(p, s). Whole numbers take the narrowest integer, 19 digits a decimal, as they pass a long."""
    p, s = precision, F.coalesce(scale, F.lit(0))
    capped = F.least(p, F.lit(38)).cast("string")
    return (
        F.when(p.isNull(), F.lit(default))
        .when((s == 0) & (p < 5), "smallint").when((s == 0) & (p <= 9), "int").when((s == 0) & (p < 19), "bigint").when(s == 0, F.concat(F.lit("decimal("), capped, F.lit(",0)")))
        .when(s > p, F.concat(F.lit("decimal(38,"), F.least(s, F.lit(38)).cast("string"), F.lit(")")))
        .when(s < 0, F.concat(F.lit("decimal("), F.least(p - s, F.lit(38)).cast("string"), F.lit(",0)")))
        .when(p <= 6, "float").when(p <= 15, "double").otherwise(F.concat(F.lit("decimal("), capped, F.lit(","), s.cast("string"), F.lit(")")))
    )


def map_types(catalog: DataFrame, dialect: str = "oracle", overrides: dict[str, str] | None = None, default_number: str = "bigint") -> DataFrame:
    """Add ``spark_type`` and ``needs_review`` to a catalog with data_type, data_precision, data_scale, data_length.

    The map is a literal of a few dozen entries; RAW of 16 or 32 bytes is a UUID; a
    NUMBER without precision and an unknown type need review.
    """
    names = DIALECTS[dialect] | (overrides or {})
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in names.items()))
    plain = F.upper(F.trim(F.regexp_replace("data_type", r"\s*\(\s*\d+(\s*,\s*\d+)?\s*\)", "")))
    number = plain.isin("NUMBER", "NUMERIC", "DECIMAL", "DEC") & ~plain.isin(*(overrides or {"": ""}))
    uuid = plain.isin("RAW") & F.col("data_length").isin(16, 32)
    known = F.try_element_at(table, plain)
    return catalog.withColumns(
        {
            "spark_type": F.when(number, numeric_type(F.col("data_precision"), F.col("data_scale"), default_number)).when(uuid, "string").otherwise(F.coalesce(known, F.lit("string"))),
            "needs_review": F.coalesce((number & F.col("data_precision").isNull()) | (~number & known.isNull()), F.lit(False)),
        }
    )


def narrow_numeric(df: DataFrame, declared: dict[str, tuple[int, int]]) -> DataFrame:
    """Cast declared NUMBER(p, s) columns, but only those whose largest value fits and that have no more decimals than declared; one pass of aggregates decides."""
    rounded = [F.max(F.abs(F.col(c).cast("decimal(38,12)") - F.round(F.col(c).cast("decimal(38,12)"), s))).alias(f"_lost_{c}") for c, (_, s) in declared.items()]
    limits = df.agg(*[F.max(F.abs(F.col(c))).cast("double").alias(c) for c in declared], *rounded).first() if declared else None
    casts = {}
    for c, (p, s) in declared.items():
        kind = "smallint" if s == 0 and p < 5 else "int" if s == 0 and p <= 9 else "bigint" if s == 0 and p < 19 else f"decimal({min(p, 38)},{s})"
        if limits[c] is None or (limits[c] < 10.0 ** (p - s) and not limits[f"_lost_{c}"]):
            casts[c] = F.col(c).cast(kind)
    return df.withColumns(casts)
