"""Every operator as a query over the given tables, with the same answer in SQL."""

from lakeops.catalog import (  # noqa: F401
    aggregates, evaluation, features, files, joins, merges, models, ranks, reports, scalars, sets, shapes, texts,
)
from lakeops.catalog.base import REGISTRY  # noqa: F401
