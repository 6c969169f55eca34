"""Where vocabulary files are found: a path, or the name of a file of the installed public vocabularies."""

from __future__ import annotations

import os


def vocabulary_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(name: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer
