"""Readers and writers: corpora, tokenizer tables, the printable text format."""
