from .metrics import (
    DIMENSIONS,
    Metric,
    MetricEngine,
    parse_depends,
    publish_catalog,
    publish_values,
    read_catalog,
)
from ..staging import shared_folder, stage

__all__ = [n for n in dir() if not n.startswith("_")]
