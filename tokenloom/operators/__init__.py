"""DataFrame operators: text, pairs, vocabulary, encode/decode, windows, vectors."""
