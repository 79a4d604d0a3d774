"""Column expressions shared by the operators.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "before", "after", "seconds_between", "date_hour", "format_date",
    "format_time", "parse_time", "date_key", "parse_date_key", "minute_key",
    "minute_key_parts", "today", "yesterday", "round_half_up", "is_empty",
    "is_not_empty", "pad2", "concat_long_string", "json_field",
    "group_concat_distinct", "ids_from_csv", "ids_to_csv", "area_level",
    "product_status", "AREA_LEVELS",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- DT-1 .. DT-8: time ----------------------------------------------------

def before(t1, t2) -> Column:
    return col_of(t1) < col_of(t2)


def after(t1, t2) -> Column:
    return col_of(t1) > col_of(t2)


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", col_of(start), col_of(end))


def date_hour(ts) -> Column:
    """``yyyy-MM-dd_HH``."""
    return F.date_format(col_of(ts), "yyyy-MM-dd_HH")


def format_date(ts) -> Column:
    return F.date_format(col_of(ts), "yyyy-MM-dd")


def format_time(ts) -> Column:
    return F.date_format(col_of(ts), "yyyy-MM-dd HH:mm:ss")


def parse_time(text) -> Column:
    """Parse ``yyyy-MM-dd H:mm:ss``; a one-digit hour is accepted."""
    return F.try_to_timestamp(col_of(text), F.lit("yyyy-MM-dd H:mm:ss"))


def date_key(ts) -> Column:
    """``yyyyMMdd``."""
    return F.date_format(col_of(ts), "yyyyMMdd")


def parse_date_key(text) -> Column:
    return F.to_date(col_of(text), "yyyyMMdd")


def minute_key(ts) -> Column:
    """``yyyyMMddHHmm``."""
    return F.date_format(col_of(ts), "yyyyMMddHHmm")


def minute_key_parts(key) -> tuple[Column, Column, Column]:
    """Cut a ``yyyyMMddHHmm`` key into (date, hour, minute) strings."""
    k = col_of(key)
    return F.substring(k, 1, 8), F.substring(k, 9, 2), F.substring(k, 11, 2)


def today() -> Column:
    return F.current_date()


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)


# --- NUM-1, STR-1, STR-3 --------------------------------------------------

def round_half_up(x, scale: int = 2) -> Column:
    """Half-up rounding of the decimal form of ``x`` (Spark ``round``)."""
    return F.round(col_of(x), scale)


def is_empty(c) -> Column:
    return F.coalesce(col_of(c).cast("string"), F.lit("")) == ""


def is_not_empty(c) -> Column:
    return ~is_empty(c)


def pad2(c) -> Column:
    """Two-character text as it is, any other with one "0" before it."""
    text = col_of(c).cast("string")
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


# --- UDF-1, UDF-2, UDAF-1 and list helpers --------------------------------

def concat_long_string(v1, v2, sep: str = ":") -> Column:
    return F.concat_ws(sep, col_of(v1).cast("string"), col_of(v2))


def json_field(js, field: str) -> Column:
    """Top-level JSON field as a string (an integer 0 reads as "0")."""
    return F.get_json_object(col_of(js), f"$.{field}")


def group_concat_distinct(c, sep: str = ",") -> Column:
    """Aggregate: distinct non-null values, sorted, joined by ``sep``.

    ``collect_set`` is partially aggregated before the shuffle, so a hot
    group only ever carries its distinct values, never its rows.
    """
    return F.array_join(F.array_sort(F.collect_set(col_of(c))), sep)


def ids_from_csv(c) -> Column:
    """``"1,2,2"`` -> ``[1, 2, 2]``; NULL stays NULL."""
    return F.split(col_of(c), ",").cast("array<bigint>")


def ids_to_csv(c) -> Column:
    return F.array_join(col_of(c).cast("array<string>"), ",")


# --- PRJ-4, PRJ-5 ----------------------------------------------------------

# Area name -> area level. Any other area is "D_Level".
AREA_LEVELS = {
    "华北": "A_Level",
    "华东": "A_Level",
    "华中": "B_Level",
    "华南": "B_Level",
    "西南": "C_Level",
    "西北": "C_Level",
}
DEFAULT_AREA_LEVEL = "D_Level"


def area_level(area, levels: dict[str, str] | None = None,
               default: str = DEFAULT_AREA_LEVEL) -> Column:
    levels = AREA_LEVELS if levels is None else levels
    a = col_of(area)
    expr = None
    for level in dict.fromkeys(levels.values()):
        names = [k for k, v in levels.items() if v == level]
        cond = a.isin(names)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def product_status(extend_info) -> Column:
    """"Self" when ``product_status`` is 0, else "Third Party"."""
    return F.when(json_field(extend_info, "product_status") == "0", F.lit("Self")) \
        .otherwise(F.lit("Third Party"))
