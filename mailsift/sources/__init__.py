"""Where files come from."""
