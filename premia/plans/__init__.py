"""Plans over whole tables: dimension and fact loads, reports."""
