"""Production parameters of the registered queries."""

import public_tokenizers

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
PACK_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
CAPACITY = 4_096
WORDS = 4  # per shingle in the query
PIPELINE_WORDS = 5
COMPONENTS = 4
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
