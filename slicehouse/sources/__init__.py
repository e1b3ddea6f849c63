"""Scans: relational tables, warehouse tables and manifests."""
