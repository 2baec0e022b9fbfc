"""Operators for preparing training data: search, tokens, licences, duplicates, mixing, chat, PII, toxicity, archives."""
