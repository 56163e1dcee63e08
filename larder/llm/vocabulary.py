"""Where public vocabularies lie."""

from __future__ import annotations

TOKENIZER = "word_bpe_49k.json"


def tokenizer_file(name: str = TOKENIZER) -> str:
    """The path of a vocabulary, which is installed beside its library on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
