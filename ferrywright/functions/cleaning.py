"""Cleaning and typing of columns while tables move."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for true and false.
TRUE_WORDS = ("yes", "y", "1", "true", "enabled")
FALSE_WORDS = ("no", "n", "0", "false", "disabled")
# Accented letters and their plain ones.
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüýÿñçÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÝÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUYNC"


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the listed columns, in the table's order; names are compared without case."""
    wanted = {c.lower() for c in columns}
    return df.select(*[c for c in df.columns if c.lower() in wanted])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wanted = {c.lower() for c in columns}
    return df.select(*[c for c in df.columns if c.lower() not in wanted])


def rename(df: DataFrame, mapping: Mapping[str, str] | None = None, preserve_case: bool = False) -> DataFrame:
    """Rename columns; other names become lower case, and dots underscores."""
    named = {k.lower(): v for k, v in (mapping or {}).items()}
    return df.toDF(*[named.get(c.lower(), (c if preserve_case else c.lower()).replace(".", "_")) for c in df.columns])


def as_boolean(column: Column, extra_true: Sequence[str] = (), extra_false: Sequence[str] = ()) -> Column:
    """Coded texts as boolean; anything else is null."""
    word = F.lower(F.trim(column.cast("string")))
    return F.when(word.isin(*TRUE_WORDS, *map(str.lower, extra_true)), True).when(word.isin(*FALSE_WORDS, *map(str.lower, extra_false)), False)


def fix_zero_date(column: Column, replacement: str | None = None) -> Column:
    """Dates such as 0000-00-00 as null or as a given one; other texts as timestamps, bad ones null."""
    zero = column.startswith("0000-00-00")
    return F.when(zero, F.lit(replacement).cast("timestamp")).otherwise(F.try_to_timestamp(column))


def transform_values(df: DataFrame, expressions: Mapping[str, str | Column]) -> DataFrame:
    """Replace columns by SQL expressions or Columns."""
    return df.withColumns({c: F.expr(e) if isinstance(e, str) else e for c, e in expressions.items()})


def modify_type(df: DataFrame, kinds: Mapping[str, str], separator: str = ",") -> DataFrame:
    """Force types; a text becomes an array by splitting at ``separator``, a composite by its fields in order, nulls kept."""
    have = {f.name: f.dataType for f in df.schema.fields}
    change = {}
    for c, kind in kinds.items():
        if kind.startswith("array<") and isinstance(have[c], T.StringType):
            change[c] = F.when(F.length(c) > 0, F.split(c, f"\\Q{separator}\\E")).otherwise(F.when(F.col(c).isNotNull(), F.array())).cast(kind)
        elif kind.startswith("array<") and isinstance(have[c], T.StructType):
            # A composite of like fields: its fields in order.
            change[c] = F.when(F.col(c).isNotNull(), F.array(*[F.col(c)[f.name] for f in have[c].fields])).cast(kind)
        else:
            change[c] = F.col(c).try_cast(kind)
    return df.withColumns(change)


def trim_char(column: Column, side: str = "both", character: str = " ") -> Column:
    trim = {"both": F.trim, "leading": F.ltrim, "trailing": F.rtrim}[side.lower()]
    return trim(column, F.lit(character))


def empty_as_null(column: Column) -> Column:
    """An empty text is a null, as one dialect has it."""
    return F.nullif(column, F.lit(""))


def is_null_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit("")) == ""


def drop_large_objects(df: DataFrame, names: Sequence[str] = (), binary: bool = True) -> DataFrame:
    """Leave out binary columns and the named ones."""
    return df.select(*[f.name for f in df.schema.fields if not (binary and isinstance(f.dataType, T.BinaryType)) and f.name not in names])


def truncate_fraction(column: Column) -> Column:
    return F.date_trunc("second", column)


def fix_century(year: Column, pivot: int = 49) -> Column:
    """Two-digit years: below the pivot 20xx, else 19xx; others stay."""
    return F.when(year < 0, year).when(year < pivot, year + 2000).when(year < 100, year + 1900).otherwise(year)


def raw_to_uuid(column: Column) -> Column:
    """16 raw bytes as the canonical form 8-4-4-4-12."""
    return F.regexp_replace(F.lower(F.hex(column)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def build_struct(df: DataFrame, name: str, columns: Sequence[str], as_array: bool = False) -> DataFrame:
    """Several columns as one struct or array in their place."""
    made = F.array(*columns) if as_array else F.struct(*columns)
    return df.withColumn(name, made).drop(*[c for c in columns if c != name])


def add_generated(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Virtual columns, in order, so that later ones may use earlier ones."""
    for c, e in expressions.items():
        df = df.withColumn(c, F.expr(e))
    return df


def normalise_float(column: Column) -> Column:
    """Texts of numbers, with the spellings of not-a-number and infinity."""
    word = F.upper(F.trim(column))
    return F.when(word == "NAN", F.lit(float("nan"))).when(word.isin("INF", "+INF", "INFINITY", "+INFINITY"), F.lit(float("inf"))).when(word.isin("-INF", "-INFINITY"), F.lit(float("-inf"))).otherwise(word.try_cast("double"))


def decode_text(column: Column, charset: str) -> Column:
    """Binary in a given encoding as text."""
    return F.decode(column, charset)


def case_insensitive(column: Column) -> Column:
    return F.collate(column, "UTF8_LCASE")


def unaccent(column: Column, lower: bool = True) -> Column:
    plain = F.translate(column, ACCENTED, PLAIN)
    return F.lower(plain) if lower else plain


def eq_or_null(column: Column, value) -> Column:
    """``= value`` where a null value asks for nulls."""
    return column.isNull() if value is None else column == value


def changed(old: Column, new: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~old.eqNullSafe(new)
