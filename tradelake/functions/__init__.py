"""Scalar column functions: code parsing, exact ratios and JSON value coercion."""
