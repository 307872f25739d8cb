"""Every query by name, with the SQL text that states its result independently.

The queries run on the tables of a data folder; :mod:`views` shapes those
tables into the posts, trips, movies and staff the analyses read.
"""

from corvane.catalogue import (  # noqa: F401  (importing registers the queries)
    aggregates,
    catalog_tables,
    filters,
    files,
    joins,
    loaders,
    ordering,
    projections,
    scalars,
    social,
    staff,
    trips,
    typed,
)
from corvane.catalogue.registry import oracle_sql, queries  # noqa: F401
