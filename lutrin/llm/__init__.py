"""Operations on text, vectors and pages for preparing training data."""
