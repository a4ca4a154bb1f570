"""Japan-time texts and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.base import col, strip

TOKYO = "Asia/Tokyo"


def jst_epoch_ms(text: Column | str, strict: bool = True) -> Column:
    """Epoch milliseconds of a Japan-time text: date, date and minute, or date and second.

    Other text is an error, or NULL when not ``strict``.
    """
    text = F.replace(strip(text), F.lit("T"), F.lit(" "))
    ok = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}(:\d{1,2})?)?$")
    dated = F.when(text.rlike(":.*:"), text).when(text.rlike(":"), F.concat(text, F.lit(":00"))).otherwise(
        F.concat(text, F.lit(" 00:00:00")))
    millis = F.when(ok, F.unix_millis(F.concat(dated, F.lit("+09:00")).try_cast("timestamp")))
    if not strict:
        return millis
    bad = F.raise_error(F.concat(F.lit("not a Japan-time date: "), text)).cast("bigint")
    return F.when(F.length(text) > 0, F.coalesce(millis, bad))


def jst_day_label(time: Column | str, is_text: bool = False) -> Column:
    """``M月d日`` in Japan time, without leading zeros; NULL when there is no time.

    TIMESTAMP is an instant, TIMESTAMP_NTZ is read as UTC, ISO text as UTC unless it names a zone.
    """
    time = col(time)
    if is_text:
        local = F.convert_timezone(None, F.lit(TOKYO), time.try_cast("timestamp").cast("timestamp_ntz"))
    else:
        local = F.convert_timezone(F.lit("UTC"), F.lit(TOKYO), time.cast("timestamp_ntz"))
    return F.concat(F.month(local).cast("string"), F.lit("月"), F.dayofmonth(local).cast("string"), F.lit("日"))
