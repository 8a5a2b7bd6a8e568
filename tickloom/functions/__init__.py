"""Column-level vocabulary: window primitives, recurrences, indicators, scalar helpers."""
