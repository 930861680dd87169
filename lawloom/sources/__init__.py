"""Readers and writers of landed files: records, laws, articles, pages, registers."""
