"""Readers and writers: CSV feed, layer tables, messages, the derived feed."""
