"""Relational operators over the canonical trade table, each a lazy DataFrame expression."""
