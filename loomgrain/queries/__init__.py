"""All registered queries; importing this package fills the registry."""

from loomgrain.queries import (  # noqa: F401
    aggregates,
    controls,
    dataflow,
    generators,
    joins,
    ordering,
    projections,
    scalars,
    sinks,
    sources,
    windows,
)
from loomgrain.queries.registry import QUERIES, Tables, runner  # noqa: F401
