"""Column -> Column operators: text clean-up, tokens, safe ratios."""

from synthtext.functions.ratios import safe_div, throughput_columns
from synthtext.functions.text import (
    clean_whitespace,
    deduplicate_sentences,
    preview,
    remove_incomplete_sentence,
    simple_post_process,
    split_sentences,
    truncate_text,
    ustrip,
)
from synthtext.functions.tokens import count_tokens, tokenize, truncate_tokens, udf_tokenizer

__all__ = [
    "clean_whitespace",
    "count_tokens",
    "deduplicate_sentences",
    "preview",
    "remove_incomplete_sentence",
    "safe_div",
    "simple_post_process",
    "split_sentences",
    "throughput_columns",
    "tokenize",
    "truncate_text",
    "truncate_tokens",
    "udf_tokenizer",
    "ustrip",
]
