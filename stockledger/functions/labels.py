"""Report labels ``<year> - <entity>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value of the original report: separator between year and entity.
LABEL_SEPARATOR = " - "


def year_entity_label(year: str | Column, entity: str | Column) -> Column:
    """Text label; sorts as text, so ``2019 - 13`` comes before ``2019 - 8``.

    A null entity gives a null label.
    """
    y = F.col(year) if isinstance(year, str) else year
    e = F.col(entity) if isinstance(entity, str) else entity
    return F.concat(y.cast("string"), F.lit(LABEL_SEPARATOR), e.cast("string"))
