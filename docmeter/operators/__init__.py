"""Operators over records, evaluations, texts, pages and ordered nodes."""
