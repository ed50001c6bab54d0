from tillhouse.sinks.jdbc import export_database, write_jdbc_table
from tillhouse.sinks.tables import create_database, save_table

__all__ = ["create_database", "export_database", "save_table", "write_jdbc_table"]
