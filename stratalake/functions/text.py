"""Text columns: cleaning, whitelists, formatting, pattern tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Units of readable sizes, powers of 1024.
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]


def clean_text(df: DataFrame, upper: Sequence[str] = (), lower: Sequence[str] = (), plain: Sequence[str] = ()) -> DataFrame:
    """Trim the named columns and bring them to upper or lower case."""
    cleaned = {c: F.upper(F.trim(c)) for c in upper}
    cleaned |= {c: F.lower(F.trim(c)) for c in lower}
    cleaned |= {c: F.trim(c) for c in plain}
    return df.withColumns(cleaned)


def empty_to_null(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def title_case(col: Column) -> Column:
    """Capitalise every run of ASCII letters and digits; all other characters separate words."""
    pieces = F.regexp_extract_all(col, F.lit("([A-Za-z0-9]+|[^A-Za-z0-9]+)"), 1)
    return F.array_join(F.transform(pieces, lambda w: F.when(w.rlike("^[A-Za-z0-9]"), _capital(w)).otherwise(w)), "")


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substr(word, F.lit(2))))


def whitelist(col: Column, values: Sequence[str], default: str, case=F.upper) -> Column:
    """``case(col)`` when it is one of ``values``, else ``default``."""
    folded = case(col)
    return F.when(folded.isin(*values), folded).otherwise(F.lit(default))


def contains_ci(col: Column, needle: str) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(col), F.lit(needle.lower()))


def first_tags(col: Column, n: int = 5) -> Column:
    """At most the first ``n`` entries of an array."""
    return F.slice(col, 1, n)


def snippet(col: Column, length: int = 100) -> Column:
    """Fixed-position text snippet."""
    return F.substring(col, 1, length)


def readable_size(size: Column) -> Column:
    """Bytes with two decimals in the largest unit that leaves at least 1."""
    number = size.cast("double")
    out = F.concat(F.format_string("%.2f", number), F.lit(" " + SIZE_UNITS[0]))
    for power, unit in enumerate(SIZE_UNITS[1:], start=1):
        scale = float(1024**power)
        out = F.when(F.abs(number) >= scale, F.concat(F.format_string("%.2f", number / scale), F.lit(" " + unit))).otherwise(out)
    return out


def percent_of(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, NULL when the whole is 0."""
    return F.round(F.try_divide(part * F.lit(100), whole), digits)


def format_cells(df: DataFrame) -> DataFrame:
    """Display text of every column: thousands separators, 2 decimals (4 below 1), dates to the day, a dash for NULL."""

    def shown(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            text = F.when(F.abs(col) >= 1, F.format_number(col, 2)).otherwise(F.format_string("%.4f", col.cast("double")))
        elif isinstance(kind, T.DecimalType):
            text = F.format_number(col, 2)
        elif isinstance(kind, T.IntegralType):
            text = F.format_number(col, 0)
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(col, "yyyy-MM-dd")
        else:
            text = col.cast("string")
        return F.coalesce(text, F.lit("—")).alias(field.name)

    return df.select([shown(f) for f in df.schema.fields])


def parse_timestamp(col: Column) -> Column:
    """Best-effort parse: NULL for text that is no timestamp."""
    return F.try_to_timestamp(col.cast("string"))


def unwrap_payload(col: Column, row_schema: T.StructType) -> Column:
    """Row struct of a change message, which is either the row itself or ``{"payload": row}``.

    Text that is no JSON object, an empty object and a payload that is no object or an empty one give NULL.
    """
    parsed = F.try_parse_json(col)
    inner = F.try_variant_get(parsed, "$.payload", "variant")
    shape = F.schema_of_variant(F.coalesce(inner, parsed))
    wrapped = F.from_json(col, T.StructType([T.StructField("payload", row_schema)]))["payload"]
    row = F.when(inner.isNotNull(), wrapped).otherwise(F.from_json(col, row_schema))
    return F.when(shape.startswith("OBJECT<") & (shape != "OBJECT<>"), row)


def question_key(agent: Column, text: Column) -> Column:
    """MD5 of ``agent:text`` with the text trimmed and in lower case."""
    return F.md5(F.concat_ws(":", agent, F.lower(F.trim(text))))
