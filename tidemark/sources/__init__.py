"""Raw-zone sources: schemas, the file registry and the CSV readers."""

from .csv import read_csv, read_source, write_csv
from .registry import REGISTRY, SourceSpec, reference_sources, transaction_sources

__all__ = ["read_csv", "read_source", "write_csv", "REGISTRY", "SourceSpec",
           "reference_sources", "transaction_sources"]
