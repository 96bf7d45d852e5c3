"""Operators for building training corpora: tokenising, language, duplicates, extraction, rules, mixing."""
