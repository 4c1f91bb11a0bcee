"""The operators and plans applied to whole tables, each with an independent SQL statement."""
