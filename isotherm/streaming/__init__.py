"""Streaming: incremental, checkpointed ingest of newly arriving station files.

The analyses themselves are batch jobs over the clean store; the only
streaming part is getting files into that store batch by batch.
"""

from isotherm.streaming.incremental_ingest import start_incremental_ingest

__all__ = ["start_incremental_ingest"]
