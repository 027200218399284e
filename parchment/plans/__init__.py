"""Incremental plans and the snapshot store they act on."""
