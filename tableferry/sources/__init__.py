"""Where tables are read from and written to: files, CSV exports, JDBC databases."""
