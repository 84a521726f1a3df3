"""Stored tables, document readers and the derived retention-domain views."""

from .domain import Domain
from .tables import (RAW_ACTIVITY_SCHEMA, RAW_ONBOARDING_SCHEMA, read_json_documents, read_table)

__all__ = ["Domain", "RAW_ACTIVITY_SCHEMA", "RAW_ONBOARDING_SCHEMA", "read_json_documents", "read_table"]
