"""The layer builds: silver tables, star schema, validation, marts, and the stored warehouse."""
