"""Writers: warehouse tables, CSV exports, stamped snapshots."""
