"""Operators for preparing training data: duplicates, tokens, languages, secrets, licences, chats and packing."""
