"""The model bound to tables, and the reports and load order on top of it."""
