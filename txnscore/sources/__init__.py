"""Sources and sinks: driver tables, raw/processed feature tables, JSON publishing, Kafka options."""

from .tables import read_table  # noqa: F401
from .files import (is_materialized, materialize_if_missing, scan_features, scan_raw,  # noqa: F401
                    write_features)
from .publish import publish_json, to_json_messages  # noqa: F401
