"""Operators that prepare training data: tokens, personal data, decontamination, near copies, language, lines, shards, neighbours, chats."""
