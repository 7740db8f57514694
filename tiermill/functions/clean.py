"""Column-to-column cleaning helpers.

Every helper takes a Column (or a column name) and returns native Column expressions, so a
projection built from them stays inside one whole-stage-codegen span.  ANSI mode stays on:
text that does not parse becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday codes used in opening-hours text, in week order.
DAY_CODES = {
    "Monday": "M",
    "Tuesday": "T",
    "Wednesday": "W",
    "Thursday": "R",
    "Friday": "F",
    "Saturday": "S",
    "Sunday": "U",
}
CLOSED_TIME = "00:00 AM"
CLOCK = r"(?:1[0-2]|0?[1-9]):[0-5][0-9] [AP][Mm]"


def as_col(c: Column | str) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Back-tick a name so dots, bars and percent signs in report headers stay literal."""
    return "`" + name.replace("`", "``") + "`"


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(as_col(c).cast("string")) != "", as_col(c)) for c in cols])


def to_flag(
    c: Column | str,
    true: Sequence[str],
    false: Sequence[str] = (),
    other: Column | None = None,
) -> Column:
    """Yes/no text to 1/0; anything outside both sets becomes ``other`` (null by default)."""
    text = F.lower(F.trim(as_col(c).cast("string")))
    flag = F.when(text.isin([t.lower() for t in true]), F.lit(1))
    if false:
        flag = flag.when(text.isin([f.lower() for f in false]), F.lit(0))
    return flag.otherwise(other) if other is not None else flag


def recode(c: Column | str, mapping: Mapping[str, str | None]) -> Column:
    """Replace listed values, leave everything else (null included) as it is."""
    col = as_col(c)
    out = None
    for old, new in mapping.items():
        out = F.when(col == old, F.lit(new)) if out is None else out.when(col == old, F.lit(new))
    return col if out is None else out.otherwise(col)


def later_date(candidate: Column, reference: Column) -> Column:
    """``candidate`` only when it lies after ``reference``."""
    return F.when(candidate > reference, candidate)


def parse_money(c: Column | str, dtype: str = "decimal(15,2)", negative_parens: bool = False) -> Column:
    """``$1,234.50`` / ``(1,234.50)`` text to a decimal.

    Parentheses are dropped without changing the sign unless ``negative_parens`` is set.
    """
    col = as_col(c).cast("string")
    value = F.regexp_replace(col, r"[()$,%\s]", "").try_cast(dtype)
    if negative_parens:
        value = F.when(col.rlike(r"^\s*\(.*\)\s*$"), -value).otherwise(value)
    return value


def parse_percent(c: Column | str, dtype: str = "decimal(8,4)", always: bool = False) -> Column:
    """``35%`` to 0.35.  Text without a percent sign is a plain number unless ``always``."""
    col = as_col(c).cast("string")
    number = F.regexp_replace(col, r"[()$,%\s]", "").try_cast("decimal(28,10)")
    fraction = (number / F.lit(100)).try_cast(dtype)
    if always:
        return fraction
    return F.when(col.contains("%"), fraction).otherwise(number.try_cast(dtype))


def split_key_label(c: Column | str) -> tuple[Column, Column]:
    """``"101 Main Street"`` to (``"101"``, ``"Main Street"``); no label gives ``''``."""
    parts = F.split(F.trim(as_col(c)), " ", 2)
    label = F.when(as_col(c).isNotNull(), F.coalesce(F.get(parts, F.lit(1)), F.lit("")))
    return F.get(parts, F.lit(0)), label


def last_token(c: Column | str) -> Column:
    return F.element_at(F.split(F.trim(as_col(c)), " "), -1)


def split_on_marker(c: Column | str, marker: str) -> tuple[Column, Column]:
    """Text before and after the first ``marker``; the second part is null without a marker."""
    col = as_col(c)
    after = F.when(col.contains(marker), F.split_part(col, F.lit(marker), F.lit(2)))
    return F.split_part(col, F.lit(marker), F.lit(1)), after


def parse_hours(c: Column | str, days: Mapping[str, str] = DAY_CODES) -> dict[str, Column]:
    """Opening-hours text to ``<Day>OpenTime`` / ``<Day>CloseTime`` columns."""
    col = as_col(c)
    out: dict[str, Column] = {}
    for day, code in days.items():
        pattern = rf"{code}: (?:Closed|({CLOCK})-({CLOCK}))"
        closed = F.regexp_extract(col, pattern, 0).endswith("Closed")
        for group, part in ((1, "Open"), (2, "Close")):
            found = F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))
            out[f"{day}{part}Time"] = F.when(closed, F.lit(CLOSED_TIME)).otherwise(found)
    return out


def id_levels(c: Column | str, width: int, depth: int) -> list[Column]:
    """Prefixes of an id that carries ``width`` characters per level; null below its own level."""
    col = as_col(c).cast("string")
    return [F.when(F.length(col) > (i - 1) * width, F.substring(col, 1, i * width)) for i in range(1, depth + 1)]


def path_levels(c: Column | str, sep: str, depth: int) -> list[Column]:
    """Trimmed elements of ``A >> B >> C``; null past the end of the path."""
    parts = F.split(as_col(c), r"\Q" + sep + r"\E")
    return [F.trim(F.get(parts, F.lit(i))) for i in range(depth)]


def scrub_text(df: DataFrame, cols: Sequence[str], pattern: str = r"[\r\n]") -> DataFrame:
    """Replace line breaks (or any character class) by a space in the given columns, in one projection."""
    return df.withColumns({c: F.regexp_replace(as_col(c), pattern, " ") for c in cols})


def ascii_only(c: Column | str) -> Column:
    """Double quotes become spaces, characters outside ASCII are dropped."""
    return F.regexp_replace(F.translate(as_col(c), '"', " "), r"[^\x00-\x7F]", "")


def unquote(c: Column | str) -> Column:
    """Double quotes become spaces, null becomes empty text."""
    return F.coalesce(F.translate(as_col(c), '"', " "), F.lit(""))


def iso_to_timestamp_text(c: Column | str) -> Column:
    """``2018-01-07T10:11:12.345`` to ``2018-01-07 10:11:12``."""
    return F.translate(F.substring(as_col(c), 1, 19), "T", " ")


def event_flag(c: Column | str, insert: str = "Inserted", update: str = "Updated") -> Column:
    """Source row event to the delivery flag: I for inserts, C for updates, null otherwise."""
    return F.when(as_col(c) == insert, F.lit("I")).when(as_col(c) == update, F.lit("C"))


def unknown_if_null(c: Column | str, unknown: int = -2) -> Column:
    return F.coalesce(as_col(c), F.lit(unknown))
