"""Message logs, dictionaries and the inputs derived from the test tables."""
