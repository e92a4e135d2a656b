"""The engine's operators as queries over the star-schema test tables, with SQL equivalents."""
