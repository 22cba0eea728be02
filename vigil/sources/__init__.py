from .io import SCHEMAS, by_name, load_table, quarantined_site_lines, read_site_results, register, unregister, harmonise_v1, to_ntz
from .sinks import write_row_level, write_shareable, write_site_files

__all__ = ["SCHEMAS", "load_table", "read_site_results", "register", "unregister", "by_name", "harmonise_v1", "to_ntz",
           "write_row_level", "write_shareable", "write_site_files", "quarantined_site_lines"]
