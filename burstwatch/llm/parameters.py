"""Production parameters that queries and the pipeline share."""

import public_tokenizers

#: Rank file, pattern and end-of-text string of the byte-level vocabulary.
VOCAB = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, "<|endoftext|>")
#: The model whose tokens are counted, and the most tokens a document should have.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4_096
#: Tokens of a packed sequence, and the identifier after each of its documents.
WINDOW, PACK_END = 2_048, 1
#: Identifier after each document of the token files.
FILE_END = 0
#: Queries of the searches (rows whose vec_id is divisible by this), and their answers.
QUERY_STEP, TOP = 50, 5
