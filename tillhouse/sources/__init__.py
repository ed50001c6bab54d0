from tillhouse.sources.jdbc import read_jdbc_table
from tillhouse.sources.logs import parse_json_lines, read_json_log
from tillhouse.sources.tables import list_tables, read_table

__all__ = ["list_tables", "parse_json_lines", "read_jdbc_table", "read_json_log", "read_table"]
