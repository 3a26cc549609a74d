"""Dates, numbers, boxes and vectors as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_year(*values: Column) -> Column:
    """The year that the first of the values to begin with four digits begins with."""
    return F.coalesce(*[F.when(v.rlike("^[0-9]{4}"), F.substring(v, 1, 4).cast("int")) for v in values])


def first_with_source(named: dict[str, Column]) -> tuple[Column, Column]:
    """The first value that is not null or empty, and the name it goes by."""
    full = {k: F.nullif(v, F.lit("")) for k, v in named.items()}
    return F.coalesce(*full.values()), F.coalesce(*[F.when(v.isNotNull(), F.lit(k)) for k, v in full.items()])


def date_in_name(name: Column, floor: int = 1990, ceiling: int = 2100) -> Column:
    """A date that a file name holds, as YYYYMMDD, YYYY-MM-DD or DD.MM.YYYY, in this order; null if it is implausible."""
    found = F.coalesce(
        F.nullif(F.regexp_extract(name, r"(?<!\d)((?:19|20)\d{2})([01]\d)([0-3]\d)(?!\d)", 0), F.lit("")),
        F.nullif(F.regexp_replace(F.regexp_extract(name, r"(?<!\d)(?:19|20)\d{2}-[01]\d-[0-3]\d(?!\d)", 0), "-", ""), F.lit("")),
        F.nullif(F.regexp_replace(F.regexp_extract(name, r"(?<!\d)[0-3]\d\.[01]\d\.(?:19|20)\d{2}(?!\d)", 0), r"(\d{2})\.(\d{2})\.(\d{4})", "$3$2$1"), F.lit("")),
    )
    day = F.try_to_date(found, "yyyyMMdd")
    return F.when(F.year(day).between(floor, ceiling), day)


def moment_in_name(name: Column) -> Column:
    """YYYYMMDD_HHMMSS in a file name; a day alone is no moment."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(name, r"(?<!\d)\d{8}_\d{6}(?!\d)", 0), F.lit("")), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def day_span(first: Column, last: Column) -> Column:
    """Days from first to last, both counted."""
    return F.datediff(last, first) + 1


def turned(angle: Column, by: Column) -> Column:
    return F.pmod(angle + by, F.lit(360))


def turned_box(box: Column, quarters: Column) -> Column:
    """A box (x, y, w, h as shares of the frame) after so many quarter turns clockwise."""
    x, y, w, h = (F.element_at(box, i) for i in (1, 2, 3, 4))
    q = F.pmod(quarters, F.lit(4))
    return F.when(q == 1, F.array(1 - y - h, x, h, w)).when(q == 2, F.array(1 - x - w, 1 - y - h, w, h)).when(q == 3, F.array(y, 1 - x - w, h, w)).otherwise(F.array(x, y, w, h))


def overlap(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x, y, w, h); 0 if both are empty."""
    w = F.greatest(F.lit(0.0), F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1]))
    union = a[2] * a[3] + b[2] * b[3] - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def same_shape(w1: Column, h1: Column, w2: Column, h2: Column, within: float = 0.03) -> Column:
    """Whether two frames have the same aspect ratio, up to a share."""
    return F.abs(F.log((w1 / h1) / (w2 / h2))) <= within


def sample_offsets(seconds: Column) -> Column:
    """Where to look into a film: its middle if short, else 3, 5 or 8 evenly spread places."""
    n = F.when(seconds < 10, 1).when(seconds < 60, 3).when(seconds < 600, 5).otherwise(8)
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.round(seconds * (2 * k - 1) / (2 * n), 6))


def segments(seconds: Column, length: int = 1200) -> Column:
    """Starts of the pieces of a fixed length that cover every second."""
    return F.when(seconds > 0, F.sequence(F.lit(0).cast("long"), (F.ceil(seconds).cast("long") - 1), F.lit(length).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector is null or zero."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size)


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)
