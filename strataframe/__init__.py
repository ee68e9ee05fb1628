"""Grouped, self-describing text deliveries as typed, keyed Spark DataFrames."""

from strataframe.errors import DeliveryError
from strataframe.operators.dictionary import read_dictionary, relationships, seed_dictionary
from strataframe.operators.group_table import Layout
from strataframe.operators.materialise import export_group, materialise
from strataframe.sources.audit import accepted_files, ingest_audit
from strataframe.sources.delivery import Delivery, read_group, read_group_text
from strataframe.sources.section_index import build_section_index, read_group_indexed

__all__ = [
    "Delivery", "DeliveryError", "Layout", "accepted_files", "build_section_index", "export_group",
    "ingest_audit", "materialise", "read_dictionary", "read_group", "read_group_indexed",
    "read_group_text", "relationships", "seed_dictionary",
]
