"""Operators on comma lists and on packed ``key=value|key=value`` text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_lists(df: DataFrame, column: str) -> DataFrame:
    """Strip one leading and one trailing comma."""
    return df.withColumn(column, F.regexp_replace(F.col(column), r"^,|,\z", ""))


def explode_ids(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row per number in a comma list; empty and non-numeric items are dropped.

    Null lists give no row. Repeated numbers give repeated rows.
    """
    some = F.filter(F.split(F.col(column), ","), lambda item: item != "")
    items = df.where(F.col(column).isNotNull()).withColumn(out, F.explode(some))
    return items.withColumn(out, F.col(out).try_cast("bigint")).where(F.col(out).isNotNull())


def kv_value(packed: Column, field: str) -> Column:
    """Value of the first readable ``field=value`` pair, else null.

    A pair is readable when its value is not empty and holds no further ``=``
    (a run of ``=`` at its very end is ignored).
    """
    pattern = rf"(?:^|\|){re.escape(field)}=([^=|]+)=*(?=\||\z)"
    return F.nullif(F.regexp_extract(packed, pattern, 1), F.lit(""))


def unpack_kv(df: DataFrame, column: str, fields: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Add one text column per field of a packed column (``{field: output column}``)."""
    names = fields if isinstance(fields, Mapping) else {f: f for f in fields}
    return df.withColumns({out: kv_value(F.col(column), f) for f, out in names.items()})


def set_kv(df: DataFrame, column: str, field: str, value: Column | str) -> DataFrame:
    """Replace the value of the first pair named ``field``; order is kept.

    Text without that field stays as it is, but for bars at its end.
    """
    new = F.lit(value) if isinstance(value, str) else value.cast("string")
    pairs = F.split(F.rtrim(F.col(column), F.lit("|")), r"\|")
    names = F.transform(pairs, lambda pair: F.substring_index(pair, "=", 1))
    place = F.array_position(names, F.lit(field))
    replaced = F.transform(
        pairs,
        lambda pair, i: F.when(i + 1 == place, F.concat(F.lit(f"{field}="), new)).otherwise(pair),
    )
    return df.withColumn(column, F.array_join(replaced, "|"))


#: Characters that structure packed text, and how they are written inside values. The sign that
#: begins a code comes first: coded first and decoded last, so codes are read as they were written.
CODES = (("%", "%25"), ("|", "%7C"), ("=", "%3D"), (",", "%2C"))
#: A missing value or item, a list of one empty item, a missing list; no coded text has them.
MISSING, BLANK, NO_LIST = "%00", "%01", "%02"


def encode(value: Column) -> Column:
    """Text without bars, equal signs and commas, from which ``decode`` gives the value back."""
    coded = value.cast("string")
    for sign, code in CODES:
        coded = F.replace(coded, F.lit(sign), F.lit(code))
    return F.coalesce(coded, F.lit(MISSING))


def decode(coded: Column) -> Column:
    """The value of coded text: null stays apart from empty text."""
    value = coded
    for sign, code in reversed(CODES):
        value = F.replace(value, F.lit(code), F.lit(sign))
    return F.when(coded != MISSING, value)


def encode_list(values: Column) -> Column:
    """A list of texts as one, with commas between coded items; any items, also null and empty ones.

    The list itself may also be null or empty (empty text).
    """
    items = F.array_join(F.transform(values, encode), ",")
    only_blank = (F.size(values) == 1) & (F.element_at(values, 1) == "")
    return F.when(values.isNull(), NO_LIST).when(only_blank, BLANK).otherwise(items)


def decode_list(coded: Column) -> Column:
    """The list of texts that ``encode_list`` was given."""
    none = F.array().cast("array<string>")
    items = F.transform(F.split(coded, ","), decode)
    some = F.when(coded == BLANK, F.array(F.lit(""))).when(coded == "", none).otherwise(items)
    return F.when(coded != NO_LIST, some)


def pack_exact(df: DataFrame, fields: Mapping[str, str], out: str = "packed") -> DataFrame:
    """Pack columns as :func:`pack_kv` does, so that :func:`unpack_exact` gives back what they hold.

    Columns of lists of texts are packed by item. Field names hold no bar and no equal sign.
    """
    if any(set(field) & set("|=") for field in fields):
        raise ValueError(f"field names with a bar or an equal sign: {sorted(fields)}")

    def coded(name: str) -> Column:
        is_list = isinstance(df.schema[name].dataType, T.ArrayType)
        return encode_list(F.col(name).cast("array<string>")) if is_list else encode(F.col(name))

    pairs = [F.concat(F.lit(f"{field}="), coded(name)) for field, name in fields.items()]
    return df.withColumn(out, F.concat_ws("|", *pairs))


def unpack_exact(
    df: DataFrame, column: str, fields: Mapping[str, str], lists: Sequence[str] = ()
) -> DataFrame:
    """Add a text column per field (``{field: output column}``) of text from :func:`pack_exact`;
    those of the fields in ``lists`` hold lists of texts. A field that is not there gives null."""
    # A part without an equal sign is no pair; codes have none.
    pairs = F.filter(F.split(F.col(column), r"\|"), lambda pair: F.contains(pair, F.lit("=")))
    values = F.map_from_entries(
        F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1), F.substring_index(p, "=", -1)))
    )
    read = {
        out: (decode_list if field in lists else decode)(F.try_element_at(values, F.lit(field)))
        for field, out in fields.items()
    }
    return df.withColumns(read)


def pack_kv(df: DataFrame, fields: Mapping[str, str], out: str = "packed") -> DataFrame:
    """Pack columns into ``field=value|…`` text (``{field: column}``); null values pack as empty."""
    pairs = [
        F.concat(F.lit(f"{field}="), F.coalesce(F.col(name).cast("string"), F.lit("")))
        for field, name in fields.items()
    ]
    return df.withColumn(out, F.concat_ws("|", *pairs))
