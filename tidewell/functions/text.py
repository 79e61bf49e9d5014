"""Labels, display texts and name formatting."""

from __future__ import annotations

import datetime as dt
import urllib.parse

from pyspark.sql import Column, functions as F

from .. import fixed_values as fixed


def one_decimal(value: Column) -> Column:
    """Text with one decimal, rounded half to even on the stored value."""
    return F.call_function("format_number", value.cast("double"), F.lit("0.0"))


def temperature_text(celsius: Column) -> Column:
    """Mark and value, such as '🔥 31.5°C'."""
    shown = F.concat(one_decimal(celsius), F.lit("°C"))
    marked = None
    for limit, mark in fixed.TEMPERATURE_MARKS:
        text = F.concat(F.lit(mark + " "), shown)
        hit = celsius < F.lit(limit)
        marked = F.when(hit, text) if marked is None else marked.when(hit, text)
    return F.when(
        celsius.isNotNull(),
        marked.otherwise(F.concat(F.lit(fixed.TEMPERATURE_MARK_ABOVE + " "), shown)),
    )


def completeness_label(percent: Column) -> Column:
    return F.when(percent >= fixed.GOOD_PERCENT, F.lit("Good")).otherwise(F.lit("Needs Attention"))


def quality_mark(percent: Column) -> Column:
    return F.when(percent >= fixed.GOOD_PERCENT, F.lit("✅")).otherwise(F.lit("⚠️"))


def gate_label(passed: Column) -> Column:
    return F.when(F.coalesce(passed, F.lit(False)), F.lit("PASSED")).otherwise(F.lit("FAILED"))


def run_state(last_run: Column) -> Column:
    return F.when(last_run.isNotNull(), F.lit("Ready")).otherwise(F.lit("No runs yet"))


def title(name: Column) -> Column:
    """'wind_speed' as 'Wind Speed'."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def shown_moment(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def name_list(names: Column) -> Column:
    """'London, Paris' as an array of trimmed names."""
    return F.transform(F.split(names, ","), lambda n: F.trim(n))


def stamp(moment: dt.datetime) -> str:
    """Run stamp used in batch names."""
    return moment.strftime("%Y%m%d_%H%M%S")


def stamp_of(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def day_path(moment: dt.datetime, style: str = "hive") -> str:
    """Date part of a lake path, Hive style or plain."""
    if style == "plain":
        return moment.strftime("%Y/%m/%d")
    return moment.strftime("year=%Y/month=%m/day=%d")


def partition_value(path: str, column: str) -> str | None:
    """Value of a partition column in the name of a file; None if it has none."""
    for part in path.split("/"):
        name, mark, value = part.partition("=")
        if mark and name == column:
            return urllib.parse.unquote(value)
    return None


def day_of_path(path: Column) -> Column:
    """Date held in a lake path of either style; NULL if it has none or it is no date."""
    hive = r"(?:^|/)(?:year=)?(\d{4})/(?:month=)?(\d+)/(?:day=)?(\d+)/"
    parts = [F.regexp_extract(path, hive, i) for i in (1, 2, 3)]
    padded = F.concat_ws(
        "-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0")
    )
    plausible = (F.length(parts[1]) <= 2) & (F.length(parts[2]) <= 2) & (parts[0] != "")
    return F.when(plausible, padded.try_cast("date"))


def alert_text(status: Column, run_id: Column, reason: Column, stats: list[tuple[str, Column]]) -> Column:
    """Lines of one alert: headline, reason if any, counts."""
    mark = F.when(status == "blocked", F.lit("🛑")).otherwise(F.lit("❌"))
    head = F.concat(mark, F.lit(" *Pipeline "), F.upper(status), F.lit("* — run `"), run_id, F.lit("`"))
    pairs = [F.concat(F.lit(name + "="), value.cast("string")) for name, value in stats]
    tail = F.concat(F.lit("_"), F.concat_ws(", ", *pairs), F.lit("_"))
    return F.concat_ws("\n", head, F.nullif(reason, F.lit("")), tail)
