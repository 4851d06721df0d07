"""Column functions of the warehouse: null-safe arithmetic, labels, clocks, keys. All are native expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Play-by-play event codes and their names.
EVENT_NAMES = {
    1: "field_goal_made", 2: "field_goal_missed", 3: "free_throw", 4: "rebound", 5: "turnover", 6: "foul", 7: "violation",
    8: "substitution", 9: "timeout", 10: "jump_ball", 11: "ejection", 12: "period_start", 13: "period_end",
}


def ratio(x: Column, y: Column) -> Column:
    """x / y as a double; null where y is 0 or either is null."""
    return F.try_divide(x.cast("double"), y.cast("double"))


def code_name(code: Column, names: dict, other: str = "unknown") -> Column:
    """A code's name by a CASE chain; anything else, null too, gives `other`."""
    out = None
    for k, v in names.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out.otherwise(other)


def season_label(year: Column) -> Column:
    """'2023-24' for the season that starts in 2023."""
    y = year.cast("int")
    return F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(F.pmod(y + 1, F.lit(100)).cast("string"), 2, "0"))


def season_of(day: Column) -> Column:
    """Season label of a date; seasons start in October."""
    return season_label(F.year(day) - F.when(F.month(day) < 10, 1).otherwise(0))


def normal_season(text: Column) -> Column:
    """A season label from 'YYYY', a five-digit id 'tYYYY', 'YYYY-YY' or an ISO date; null for other text."""
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}$"), text)
        .when(text.rlike(r"^\d{4}$"), season_label(text.try_cast("int")))
        .when(text.rlike(r"^\d{5}$"), season_label(F.substring(text, 2, 4).try_cast("int")))
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), season_of(F.substring(text, 1, 10).try_cast("date")))
    )


def season_id(label: Column, kind: str = "2") -> Column:
    """'2023-24' to the five-digit id '22023'."""
    return F.concat(F.lit(kind), F.substring(label, 1, 4))


def clock_minutes(text: Column) -> Column:
    """Minutes from 'MM:SS', 'HH:MM:SS' or a number; null for anything else."""
    p = F.split(text, ":")
    num = lambda i: F.try_element_at(p, F.lit(i)).try_cast("double")
    return F.when(F.size(p) == 1, num(1)).when(F.size(p) == 2, num(1) + num(2) / 60).when(F.size(p) == 3, num(1) * 60 + num(2) + num(3) / 60)


def height_inches(text: Column) -> Column:
    """Inches from 'feet-inches'."""
    return F.split_part(text, F.lit("-"), F.lit(1)).try_cast("int") * 12 + F.split_part(text, F.lit("-"), F.lit(2)).try_cast("int")


def position_group(text: Column) -> Column:
    """Guard, Forward or Center by the first letter; else Other."""
    c = F.upper(F.substring(F.trim(text), 1, 1))
    return F.when(c == "G", "Guard").when(c == "F", "Forward").when(c == "C", "Center").otherwise("Other")


def court(x: Column, y: Column) -> tuple[Column, Column]:
    """Shot coordinates in tenths of a foot to feet, rotated by 90 degrees."""
    return y / 10.0, -x / 10.0


def text_key(*cols: Column) -> Column:
    """A positive 31-bit key of text columns; callers check collisions where keys must be unique."""
    return F.pmod(F.xxhash64(F.concat_ws("|", *cols)), F.lit(2147483647)) + 1


def availability(year: Column, kind: Column, first_year: dict[str, int]) -> Column:
    """'supported', or 'upstream_unavailable' for a season before its type's first year."""
    out = F.lit("supported")
    for k, y in first_year.items():
        out = F.when((kind == k) & (year < y), "upstream_unavailable").otherwise(out)
    return out


def snake_case(name: str, aliases: dict[str, str] | None = None) -> str:
    """UPPER or camelCase to snake_case, then an alias if there is one."""
    s = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name.strip()) if not name.isupper() else name.strip()
    s = re.sub(r"[^0-9a-zA-Z]+", "_", s).lower().strip("_")
    return (aliases or {}).get(s, s)


def snake_names(names: list[str], aliases: dict[str, str] | None = None) -> list[str]:
    """Canonical names of a header; a name that would collide keeps its plain snake_case form, or gets a number."""
    out: list[str] = []
    for n in names:
        c = snake_case(n, aliases)
        c = c if c not in out else snake_case(n)
        k, base = 2, c
        while c in out:
            c, k = f"{base}_{k}", k + 1
        out.append(c)
    return out
