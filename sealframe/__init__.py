"""Distributed measurement tables with cell-level encryption, as DataFrame jobs."""
