"""Readers: comment dumps, word lists, lexicon, vocabulary, fixtures."""
