from shoplens.sources.tables import TABLES, read_table, Tables  # noqa: F401
