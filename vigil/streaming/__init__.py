"""Structured Streaming entry points.

The reference has no streams; its only cross-site boundary is result files that each
site drops into a shared folder and that are merged later.  ``site_results`` re-expresses
that exchange as an incremental file-source stream (``availableNow`` trigger, state in
the cluster's checkpoint folder), so a re-run only reads files that arrived since."""

from .site_results import merge_site_files, site_table_from_merged

__all__ = ["merge_site_files", "site_table_from_merged"]
