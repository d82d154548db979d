from parley.functions.text import (
    ANALYZER_STOPWORDS,
    STOPWORDS,
    is_stopword,
    normalize,
    raw_terms,
    remove_stopwords,
    tokenize,
)

__all__ = [
    "ANALYZER_STOPWORDS",
    "STOPWORDS",
    "is_stopword",
    "normalize",
    "raw_terms",
    "remove_stopwords",
    "tokenize",
]
