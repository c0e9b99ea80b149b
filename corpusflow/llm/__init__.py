"""Operations of a training-data pipeline: search, filtering, deduplication, tokens, formatting."""
