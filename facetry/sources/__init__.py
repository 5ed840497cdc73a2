"""Readers and writers: review and score tables, line lists, word vectors, kept artifacts."""
