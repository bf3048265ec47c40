"""Operations on training-data corpora. Nothing outside this package imports it."""
