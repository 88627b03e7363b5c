"""Column expressions for typed values: never an error, NULL for what does not parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for a missing value on the topic.
NULL_TEXT = "null"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_long(value: Column | str) -> Column:
    """Whole number; a fraction is cut off (``1.5`` is 1), other text is NULL.

    The strict cast takes no fraction, so texts it refuses get a second look.
    """
    text = _col(value)
    fraction = r"^(\s*[+-]?)(\d*)\.\d*\s*$"
    whole = F.concat(F.regexp_extract(text, fraction, 1), F.lit("0"), F.regexp_extract(text, fraction, 2))
    return F.coalesce(text.try_cast("bigint"), F.when(text.rlike(fraction), whole).try_cast("bigint"))


def to_short(value: Column | str) -> Column:
    return _col(value).try_cast("smallint")


def to_date(value: Column | str) -> Column:
    return _col(value).try_cast("date")


def to_flag(value: Column | str) -> Column:
    """xs:boolean: ``true``, ``false``, ``1`` or ``0``; a cast would take ``y`` and others too."""
    text = F.trim(_col(value))
    return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)


def to_local_time(value: Column | str) -> Column:
    """xs:dateTime without a zone."""
    return _col(value).try_cast("timestamp_ntz")


class Typed:
    """Makes typed columns and remembers for each whether its text could not be read."""

    def __init__(self) -> None:
        self._lost: list[Column] = []

    def __call__(self, cast, value: Column | str, name: str) -> Column:
        text = _col(value)
        typed = cast(text)
        self._lost.append(F.when(text.isNotNull() & typed.isNull(), F.lit(name)))
        return typed.alias(name)

    def malformed(self) -> Column:
        """The names of the columns that are NULL because their text is malformed."""
        return present(self._lost).alias("malformed")


def present(names: list[Column]) -> Column:
    """The texts that are not NULL, as an array. Most often there are none, which is told first, because
    the search for them is not compiled."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(*names).isNull(), none).otherwise(F.array_compact(F.array(*names)))


def to_int(value: Column | str) -> Column:
    return _col(value).try_cast("int")


def blank_null_text(value: Column | str) -> Column:
    """NULL for exactly the text ``null``; any other text is kept, ``NULL`` included."""
    return F.nullif(_col(value), F.lit(NULL_TEXT))


def clock_today(value: Column | str) -> Column:
    """Clock time on the processing day, in the session zone (what a plain cast gives)."""
    return _col(value).try_cast("timestamp")


def clock_on(date: Column | str, value: Column | str) -> Column:
    """Clock time ``HH:MM[:SS]`` on a given date, as a local timestamp.

    An empty text must not become midnight, hence the ``nullif``.
    """
    clock = F.nullif(_col(value), F.lit(""))
    return F.concat(_col(date).cast("string"), F.lit(" "), clock).try_cast("timestamp_ntz")


def near(moment: Column | str, reference: Column | str) -> Column:
    """Move a timestamp by a day if it lies more than twelve hours from the reference."""
    moment, reference = _col(moment), _col(reference)
    half_day, day = F.expr("INTERVAL '12' HOUR"), F.expr("INTERVAL '1' DAY")
    return (
        F.when(moment < reference - half_day, moment + day)
        .when(moment > reference + half_day, moment - day)
        .otherwise(moment)
    )


def clock_seconds(value: Column | str) -> Column:
    """Seconds after midnight of ``HH:MM[:SS]``, NULL if it is not a valid clock time."""
    moment = clock_on(F.lit("1970-01-01"), value)
    return (F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)).cast("int")


def activity_codes(value: Column | str) -> Column:
    """Split a text of one to six two-character codes; the codes keep their spaces."""
    text = _col(value)
    starts = F.sequence(F.lit(1), F.length(text) - 1, F.lit(2))
    codes = F.transform(starts, lambda at: text.substr(at, F.lit(2)))
    return F.when(F.length(text) >= 2, codes)
