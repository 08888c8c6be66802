"""All registered queries."""

from workload import checks, files, inputs, joins, layers, layout, normalising, streams, vendors
from workload.base import ORACLES, QUERIES
from workload.layers import flagship

__all__ = ["ORACLES", "QUERIES", "checks", "files", "flagship", "inputs", "joins", "layers", "layout", "normalising", "streams", "vendors"]
