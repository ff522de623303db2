"""Operations of a training-data pipeline: archives, quality, near-duplicates, toxicity, language, chat, mixing, tokens.

Nothing outside this subpackage imports it.
"""
