from .clean import (
    CLOSED_TIME,
    DAY_CODES,
    as_col,
    ascii_only,
    event_flag,
    first_filled,
    id_levels,
    iso_to_timestamp_text,
    last_token,
    later_date,
    parse_hours,
    parse_money,
    parse_percent,
    path_levels,
    quoted,
    recode,
    scrub_text,
    split_key_label,
    split_on_marker,
    to_flag,
    unknown_if_null,
    unquote,
)
from .sqlfuncs import SQL_FUNCTIONS, register_sql_functions

__all__ = [n for n in dir() if not n.startswith("_")]
