"""Training-data operators: mixing, chat, archives, fingerprints, search, language ID, tokens."""
