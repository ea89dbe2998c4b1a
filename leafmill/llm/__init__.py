"""Training-data operators: dedup, extraction, mixing, quality, decontamination, language ID, chat.

Nothing else in the library imports this subpackage.
"""
