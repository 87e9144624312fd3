from corpusvec.sinks.rows import (
    embedding_csv,
    ordered_token_csv,
    similar_words_yaml,
    vocabulary_rows,
    word_count_csv,
    yaml_entry,
)
from corpusvec.sinks.writers import write_numbered_shards, write_packed_shards, write_shards, write_text

__all__ = [
    "embedding_csv",
    "ordered_token_csv",
    "similar_words_yaml",
    "vocabulary_rows",
    "word_count_csv",
    "write_numbered_shards",
    "write_packed_shards",
    "write_shards",
    "write_text",
    "yaml_entry",
]
