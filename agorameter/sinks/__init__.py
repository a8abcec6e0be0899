"""Batch writers. Streaming writers are in ``agorameter.streaming``."""
