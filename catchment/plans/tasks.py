"""Task history by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from catchment.operators import access, cleaning

# Text columns of a task that are cleaned.
TEXT_COLUMNS = ("StageName", "Sub_Line_of_Business")


def task_history(
    tasks: DataFrame, days: int, today: dt.date, stamp: str = "CreatedDate", text: tuple[str, ...] = TEXT_COLUMNS
) -> DataFrame:
    """Tasks of the last days with their text cleaned. One range filter stands for the daily slices."""
    return cleaning.clean_text_columns(access.slice_by_day(tasks, stamp, days, today), *text)
