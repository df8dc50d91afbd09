"""Reading and writing: CSV folders, tables, dictionaries, exports."""
