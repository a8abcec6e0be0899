"""The registered queries: every operator over the given tables, with its SQL twin."""
