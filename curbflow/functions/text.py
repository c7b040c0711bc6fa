"""Text forms of points, times and topics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbflow.schemas import ISO_MILLIS, SPACE_MILLIS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_point(x: Column | str, y: Column | str) -> Column:
    """``[x,y]``; a null coordinate makes the text null."""
    return F.concat(F.lit("["), _col(x).cast("string"), F.lit(","), _col(y).cast("string"), F.lit("]"))


def parse_point(text: Column | str) -> Column:
    """``array<double>`` from ``[x,y]``; null when the text is not a list of numbers."""
    return F.from_json(_col(text), "array<double>")


def iso_millis(text: Column | str) -> Column:
    """``date time`` text to ``dateTtime``; quotes and anything after the time go."""
    parts = F.split(F.replace(_col(text), F.lit('"'), F.lit("")), " ")
    return F.concat(F.get(parts, 0), F.lit("T"), F.get(parts, 1))


def iso_text(ts: Column | str) -> Column:
    """A timestamp as ISO text with milliseconds."""
    return F.date_format(_col(ts), ISO_MILLIS)


def arrival_text(ts: Column | str) -> Column:
    """A timestamp as ``date time`` text with milliseconds, the form of the messages."""
    return F.date_format(_col(ts), SPACE_MILLIS)


def doc_type(topic: Column | str) -> Column:
    """The topic without its last letter: documents of ``cars`` are of type ``car``."""
    topic = _col(topic)
    return F.substring(topic, F.lit(1), F.length(topic) - 1)


def to_vector(*columns: Column | str) -> Column:
    """A dense vector as ``array<double>``; null when a component is null."""
    parts = [_col(c).cast("double") for c in columns]
    present = parts[0].isNotNull()
    for part in parts[1:]:
        present = present & part.isNotNull()
    return F.when(present, F.array(*parts))
