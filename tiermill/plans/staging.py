"""Kept as a name for ``tiermill.staging``."""

from ..staging import discard, shared_folder, stage  # noqa: F401
