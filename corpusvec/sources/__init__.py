from corpusvec.sources.rows import (
    embedding_rows,
    positioned_words_from_lines,
    token_rows,
)
from corpusvec.sources.text import lines_of_files, numbered_lines, packed_shards, read_documents, read_lines
from corpusvec.sources.vocabulary_file import read_vocabulary_file

__all__ = [
    "embedding_rows",
    "lines_of_files",
    "numbered_lines",
    "packed_shards",
    "positioned_words_from_lines",
    "read_documents",
    "read_lines",
    "read_vocabulary_file",
    "token_rows",
]
