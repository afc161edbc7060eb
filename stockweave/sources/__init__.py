"""Landed feeds, the snapshot history, snapshot documents and exports."""
