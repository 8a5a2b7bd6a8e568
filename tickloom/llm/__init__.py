"""Operators of a training-data pipeline: filters, de-duplication, scans, token counts, packing, chat."""
