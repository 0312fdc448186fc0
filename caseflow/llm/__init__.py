"""Training-data operators: mixing, decontamination, deduplication, filters, tokens, archives, chats."""
