"""Feeds, configs, stored tables, JDBC reads and synthetic rows."""
