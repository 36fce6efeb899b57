"""The end-user analyses, from table to written results."""
