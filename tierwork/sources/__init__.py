"""Readers and writers: delimited files, named tables, file layout, the shared work folder."""
